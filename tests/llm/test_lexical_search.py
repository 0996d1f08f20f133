"""Ranked lexical search against its SQL and against plain Python."""

from __future__ import annotations

import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest
from compare import assert_same_rows
from farebox.llm.lexical_search import Corpus, Heaps, search_documents
from farebox.llm.queries import ORACLES, QUERIES
from odd import odd_rows, sentence

NAME = "op13_lexical_search"


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, k):
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n, total = len(counts), sum(x[2] for x in counts)
    holding = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in {tuple(x) for x in items}:
        scores = []
        for i, c, size in counts:
            m = 75 + 25 * size * n // total
            score = sum(q * floor(1000 * log((2 * n + 2) / (2 * holding[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in Counter(plain_terms(text)).items() if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def test_query_equals_sql(spark, data):
    assert assert_same_rows(QUERIES[NAME](spark, data), data, ORACLES[NAME]) > 20


def test_odd_documents_equal_sql(spark, odd_folder):
    assert_same_rows(QUERIES[NAME](spark, odd_folder), odd_folder, ORACLES[NAME])


ITEMS = [(1, sentence(1)), (1, sentence(1)), (1, "ü" * 50_000), (2, None), (3, ""), (4, "?! --"), (None, sentence(2) + " " + sentence(2)), (5, "same LINE here here"), (6, "nowhere at all 😀"), (7, " nbsp é")]


@pytest.mark.parametrize("pack_bytes", [1 << 20, 30_000])
def test_packs_and_odd_items_equal_plain_python(spark, odd, pack_bytes):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    found = search_documents(odd, items, k=4, pack_bytes=pack_bytes)
    assert found.dtypes == [("item_id", "int"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, found.collect()), key=repr) == plain_search([(r[0], r[1]) for r in odd_rows()], ITEMS, 4)


def test_many_equal_documents(spark):
    docs = [(n, sentence(n % 3)) for n in range(4000, 0, -1)]
    items = [(n, sentence(n)) for n in range(5)]
    found = search_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), spark.createDataFrame(items, "item_id long, text string"), k=20)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_search(docs, items, 20)


def test_empty_tables(spark, odd, no_documents):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert search_documents(no_documents, items).count() == 0
    assert search_documents(odd, items.limit(0)).count() == 0


def test_long_documents_of_a_large_corpus_stay_within_integers():
    corpus = Corpus(10**12, 10**15, np.zeros(1, np.int64))
    assert corpus.m(np.array([10**9])).tolist() == [75 + 25 * 10**9 * 10**12 // 10**15]


def test_a_heap_keeps_the_best_whatever_the_order():
    draw = np.random.default_rng(1)
    item, score, doc = draw.integers(0, 3, 5000), draw.integers(1, 40, 5000), draw.permutation(5000)
    heaps = Heaps(3, 7)
    heaps.most = 50
    for k in range(0, 5000, 100):
        good = score[k : k + 100] >= heaps.bar[item[k : k + 100]]
        heaps.offer(item[k : k + 100][good], score[k : k + 100][good], np.zeros(good.sum(), int), doc[k : k + 100][good])
    want = [sorted(zip(-score[item == i], doc[item == i]))[:7] for i in range(3)]
    assert [(-s, d) for _, s, _, d in heaps.trim().tolist()] == [x for part in want for x in part]
