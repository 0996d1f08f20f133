"""The slice of time and the K that narrow every report."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

# A report is narrowed by an integer id.
HOURS_PER_DAY = 24
DAY_CYCLE = 25
TOP_CYCLE = 11
SMALLEST_TOP = 10
WINDOW_HOURS = 4
WINDOW_DAYS = 3
LAST_COMMON_DAY = 28
DATED_YEAR = 2024


@dataclass(frozen=True)
class ReportWindow:
    """Hours of day, days of month and K of one run.

    The values reach the plan as literals, so Catalyst can fold them and push
    them into scans; nothing is shipped as a broadcast variable.
    """

    first_hour: int
    first_day: int
    top_k: int
    hour_count: int = WINDOW_HOURS

    @classmethod
    def from_id(cls, number: int) -> ReportWindow:
        return cls(
            first_hour=number % HOURS_PER_DAY,
            first_day=number % DAY_CYCLE + 1,
            top_k=number % TOP_CYCLE + SMALLEST_TOP,
        )

    @property
    def hours(self) -> list[int]:
        """Consecutive hours of day, running over midnight where needed."""
        start = self.first_hour % HOURS_PER_DAY
        return sorted({hour % HOURS_PER_DAY for hour in range(start, start + self.hour_count)})

    @property
    def days(self) -> list[int]:
        """Days of month; the later ones never pass the last day every month has."""
        later = (min(self.first_day + step, LAST_COMMON_DAY) for step in range(1, WINDOW_DAYS))
        return sorted({self.first_day, *later})

    @property
    def dates(self) -> list[date]:
        """The days of month in each month of the dated year, where they exist."""
        start = date(DATED_YEAR, 1, 1)
        calendar = (start + timedelta(days=n) for n in range((date(DATED_YEAR + 1, 1, 1) - start).days))
        wanted = set(self.days)
        return [day for day in calendar if day.day in wanted]

    @property
    def date_spans(self) -> list[tuple[date, date]]:
        """``dates`` as half-open spans: adjoining days share one span."""
        spans: list[tuple[date, date]] = []
        for day in self.dates:
            following = day + timedelta(days=1)
            if spans and spans[-1][1] == day:
                spans[-1] = (spans[-1][0], following)
            else:
                spans.append((day, following))
        return spans
