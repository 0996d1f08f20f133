"""Suffix-array dedup against a plain dictionary of all windows, and the suffix sorting against plain sorting."""

from __future__ import annotations

import random

import numpy as np
import pytest
from farebox.llm.queries import QUERIES
from farebox.llm.suffix_array import anchored_runs, common_prefixes, equal_windows, suffix_order
from farebox.llm.suffix_dedup import remove_repeated_substrings
from odd import odd_rows, sentence


def plain(rows, length=100):
    """(doc_id, n_bytes, kept, spans) of every row; equal rows are one document, rows of one id with other texts are not given here."""
    texts = {(i is None, i or 0, (t or "").encode()) for i, t in rows}
    seen, out = set(), {}
    for late, i, data in sorted(texts):
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - length + 1):
            window = data[k : k + length]
            if window in seen:
                gone[k : k + length] = True
            seen.add(window)
        edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(int)))
        out[late, i, data] = (len(data), bytes(np.frombuffer(data, np.uint8)[~gone]), list(zip(edges[::2].tolist(), edges[1::2].tolist())))
    return sorted([(i, *out[i is None, i or 0, (t or "").encode()]) for i, t in rows], key=repr)


def results(df):
    return sorted([(r["doc_id"], r["n_bytes"], bytes(r["kept"]), [tuple(x) for x in r["spans"]]) for r in df.collect()], key=repr)


def passages():
    """Texts that share passages beginning and ending anywhere, periodic texts, and one sentence in ever new surroundings."""
    draw = random.Random(3)
    common = sentence(1000, 25)
    rows = [(n, sentence(n, 40)) for n in range(60)]
    for n in range(60, 160):
        source = rows[draw.randrange(len(rows))][1]
        cut, size = draw.randrange(max(len(source) - 10, 1)), draw.randrange(60, 260)
        rows.append((n, sentence(n, 12) + source[cut : cut + size] + sentence(-n, draw.randrange(1, 20))))
    rows += [(n, sentence(n, 9) + common + sentence(-n, 9)) for n in range(200, 260)]
    rows += [(n, sentence(n, 9) + common[:70] + sentence(-n, 9)) for n in range(260, 300)]
    rows += [(300, "=" * 5000), (301, "ab" * 300), (302, "x" + "abc" * 200), (303, rows[5][1] + rows[5][1]), (304, "ü" * 400 + "x"), (305, "y" * 99), (306, "z" * 100), (307, "z" * 101)]
    return rows


@pytest.mark.parametrize("hot_bytes", [1 << 22, 3000])
def test_shared_passages_equal_plain_windows(spark, hot_bytes):
    rows = passages()
    frame = spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(6)
    assert results(remove_repeated_substrings(frame, hot_bytes=hot_bytes)) == plain(rows)


@pytest.mark.parametrize("length", [7, 33])
def test_other_lengths(spark, length):
    rows = passages()[100:]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert results(remove_repeated_substrings(frame, length=length)) == plain(rows, length)


def test_odd_documents(spark, odd):
    rows = [(r[0], r[1]) for r in odd_rows()]
    found = remove_repeated_substrings(odd.repartition(4))
    assert found.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("kept", "binary"), ("spans", "array<struct<start:bigint,stop:bigint>>")]
    one_version = [r for r in rows if r[0] is not None]
    assert results(found.filter("doc_id IS NOT NULL")) == plain(one_version)
    lengths = sorted(len((t or "").encode()) for i, t in rows if i is None)
    assert sorted(r["n_bytes"] for r in found.filter("doc_id IS NULL").collect()) == lengths


def test_query_equals_plain_windows(spark, data):
    import hashlib

    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted((i, n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest()) for i, n, kept, spans in plain(rows))
    found = QUERIES["op11_suffix_dedup"](spark, data)
    assert found.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string")]
    assert sorted(map(tuple, found.collect())) == want
    assert sum(r[2] for r in want) > 1000


def test_empty(spark, no_documents):
    assert remove_repeated_substrings(no_documents).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert results(remove_repeated_substrings(nothing)) == [(1, 0, b"", []), (2, 0, b"", [])]


def test_texts_stay_where_they_are_when_findings_join(spark, data):
    plan = QUERIES["op11_suffix_dedup"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan


def test_suffix_order_and_prefixes():
    draw = random.Random(1)
    for trial in range(150):
        kinds = draw.choice([1, 2, 4, 200])
        text = bytes(draw.randrange(kinds) for _ in range(draw.randrange(1, 150))) + b"\xff"
        data = np.frombuffer(text, np.uint8)
        want = sorted(range(len(text)), key=lambda k: text[k:])
        order = suffix_order(data, 200)
        assert order.tolist() == want
        wanted = np.array([draw.random() < 0.3 for _ in text])
        assert suffix_order(data, 200, wanted).tolist() == [k for k in want if wanted[k]]
        shared = common_prefixes(data, order, 30)[1:].tolist()
        for a, b, n in zip(want[:-1], want[1:], shared):
            m = next((k for k in range(30) if max(a, b) + k >= len(text) or text[a + k] != text[b + k]), 30)
            assert n == m or max(a, b) + m >= len(text)


def test_equal_windows():
    strings = [b"abcdefgh", b"xbcdefyy", b"bcde", b"aaaaaa"]
    of, at, group = equal_windows(strings, 4)
    found = {}
    for o, a, g in zip(of.tolist(), at.tolist(), group.tolist()):
        found.setdefault(g, set()).add((o, a))
    assert sorted(map(sorted, found.values())) == [[(0, 1), (1, 1), (2, 0)], [(0, 2), (1, 2)], [(3, 0), (3, 1), (3, 2)]]
    assert len(equal_windows([], 4)[0]) == len(equal_windows([b"abc", b""], 4)[0]) == 0


def test_equal_windows_lie_in_runs_of_equal_value():
    draw = random.Random(2)
    for trial in range(20):
        texts = ["".join(draw.choice("abc") for _ in range(draw.randrange(80))).encode() for _ in range(30)]
        data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.r_[0, np.cumsum([len(t) for t in texts])]
        first, count, value, again = anchored_runs(data, offsets, 9, 3, 5)
        windows = {}
        for f, c, v, r in zip(first.tolist(), count.tolist(), value.tolist(), again.tolist()):
            for k in range(f, f + c):
                windows.setdefault(bytes(data[k : k + 9]), []).append((v, f, r))
        assert sum(map(len, windows.values())) == sum(max(len(t) - 8, 0) for t in texts)
        assert all(len({v for v, _, _ in x}) == 1 for x in windows.values())
        assert all(r for x in windows.values() for v, f, r in x if sum(y[1] == f for y in x) > 1)
