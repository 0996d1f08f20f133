from datetime import date

import pytest

from farebox import ReportWindow


def test_window_of_an_id():
    window = ReportWindow.from_id(600)
    assert (window.first_hour, window.first_day, window.top_k) == (0, 1, 16)
    assert window.hours == [0, 1, 2, 3]
    assert window.days == [1, 2, 3]
    assert len(window.dates) == 36


@pytest.mark.parametrize("number", [0, 1, 23, 24, 274, 3120, 99999])
def test_window_ranges(number):
    window = ReportWindow.from_id(number)
    assert 0 <= window.first_hour <= 23 and 1 <= window.first_day <= 25 and 10 <= window.top_k <= 20
    assert len(window.hours) == 4 and len(window.days) == 3


def test_hours_run_over_midnight():
    assert ReportWindow(22, 1, 10).hours == [0, 1, 22, 23]
    assert ReportWindow(46, 1, 10).hours == [0, 1, 22, 23]


@pytest.mark.parametrize(("day", "days"), [(26, [26, 27, 28]), (27, [27, 28]), (28, [28])])
def test_days_stop_at_28(day, days):
    assert ReportWindow(0, day, 10).days == days


def test_days_a_month_lacks_are_left_out():
    dates = ReportWindow(0, 30, 10).dates
    assert date(2024, 1, 30) in dates and not [d for d in dates if d.month == 2 and d.day > 28]


@pytest.mark.parametrize("day", [1, 25, 27, 28, 30])
def test_spans_cover_exactly_the_dates(day):
    window = ReportWindow(0, day, 10)
    covered = [date.fromordinal(n) for a, b in window.date_spans for n in range(a.toordinal(), b.toordinal())]
    assert covered == window.dates
    assert all(a[1] < b[0] for a, b in zip(window.date_spans, window.date_spans[1:]))
