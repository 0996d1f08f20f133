import re
from collections import defaultdict

import numpy as np
import pytest
from odd import DOCUMENTS, row, sentence
from farebox.llm.components import components
from farebox.llm.ngram_join import HeavyHitters, matches_needed, similar_documents
from farebox.llm.scratch import Steps

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text):
    words = WORD.findall((text or "").encode().translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_force(rows):
    """(doc_id, n, component) of every row by comparing all pairs of distinct sets that share a shingle."""
    sets = [frozenset(shingles(text)) for _, text in rows]
    distinct = list(dict.fromkeys(s for s in sets if s))
    parent = list(range(len(distinct)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(distinct):
        for x in s:
            holders[x].append(i)
    for pair in {(a, b) for held in holders.values() for a in held for b in held if a < b}:
        a, b = (distinct[i] for i in pair)
        if 100 * len(a & b) >= 80 * len(a | b):
            parent[find(pair[0])] = find(pair[1])
    root = {s: find(i) for i, s in enumerate(distinct)}
    low: dict = {}
    for (doc_id, _), s in zip(rows, sets, strict=True):
        if s and doc_id is not None:
            low[root[s]] = min(low.get(root[s], doc_id), doc_id)
    return sorted(((d, len(s), low.get(root[s]) if s else d) for (d, _), s in zip(rows, sets, strict=True)), key=repr)


def check(df, **options):
    got = sorted(((x.doc_id, x.n_shingles, x.component_id) for x in similar_documents(df, **options).collect()), key=repr)
    want = brute_force([(x.doc_id, x.text) for x in df.select("doc_id", "text").collect()])
    assert got == want
    return got


def test_documents(spark):
    got = check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert any(d != c for d, _, c in got)


def test_odd_documents(odd, no_documents):
    check(odd)
    assert similar_documents(no_documents).collect() == []


def near_copies(text, count, edits, seed):
    draw = np.random.default_rng(seed)
    for k in range(count):
        words = text.split()
        for at in draw.integers(0, len(words), edits):
            words[at] = f"edit{k}x{at}"
        yield " ".join(words)


@pytest.fixture(scope="module")
def crowded(spark):
    """A large group of near copies, exact copies, chains of links, pairs at the very threshold, and a common passage."""
    texts = list(near_copies(sentence(7, 200), 150, 3, 1)) + [sentence(8, 100)] * 80
    texts += list(near_copies(sentence(9, 120), 60, 5, 2))
    passage = sentence(10, 60)
    texts += [f"{passage} {sentence(200 + k, k % 40 + 1)}" for k in range(90)]
    base = sentence(11, 300).split()
    texts += [" ".join(base[k * 9 : k * 9 + 200]) for k in range(10)]
    words = [f"w{k}" for k in range(400)]
    for n in (40, 44, 45, 46, 47, 84):
        texts += [" ".join(words[: n + 4]), " ".join(words[: n - n // 9 + 4] + [f"v{k}" for k in range(n // 9)])]
    return spark.createDataFrame([row(k, t, "s") for k, t in enumerate(texts)], DOCUMENTS)


def test_crowded_groups(crowded):
    got = check(crowded)
    assert sum(c == 0 for _, _, c in got) > 50


def test_more_parts_and_batches_change_nothing(spark, crowded):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        check(crowded.repartition(13))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_prefix_lengths():
    assert matches_needed(100, np.array([2] * 20)) == (0, 0)  # the 80 shingles of its own fill the prefix of 21, less one
    assert matches_needed(100, np.array([2] * 79)) == (0, 0)
    need, length = matches_needed(100, np.array([2] * 100))
    assert length == 100 - 80 + need
    assert matches_needed(100, np.array([1000] * 100))[0] > 1
    assert matches_needed(1, np.array([3])) == (1, 1)


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (200, 150), (150, 175)] + [(300, k) for k in range(301, 340)]
    labels = {x.node: x.label for x in components(spark.createDataFrame(edges, "a long, b long"), Steps(spark), "t").collect()}
    assert all(labels[k] == 0 for k in range(61))
    assert labels[101] == 100 and labels[200] == labels[175] == 150 and labels[339] == 300


def test_different_sets_of_one_key_are_told_apart(crowded):
    """With keys of 5 bits nearly all sets share one with others; the other half of the digest tells."""
    check(crowded, key_bits=5)


def test_long_texts_with_a_common_passage(spark):
    passage = sentence(1, 120)
    texts = [f"{sentence(100 + k, 900)} {passage} {sentence(500 + k, 900)}" for k in range(40)]
    check(spark.createDataFrame([row(k, t, "s") for k, t in enumerate(texts)], DOCUMENTS).repartition(3))


def test_heavy_hitters_are_kept_and_never_too_high():
    draw = np.random.default_rng(3)
    hitters, true = HeavyHitters(500), defaultdict(int)
    for batch in range(40):
        tokens = np.r_[np.arange(20), draw.integers(100, 100_000, 2000)].astype(np.uint64)
        token, times = np.unique(tokens, return_counts=True)
        for t, n in zip(token.tolist(), times.tolist()):
            true[t] += n
        hitters.add(token, times)
    got = dict(zip(hitters.tokens.tolist(), hitters.times.tolist()))
    assert len(got) <= 500 and all(n <= true[t] for t, n in got.items())
    lost = 2 * 40 * 2020 / 500
    assert all(got.get(t, 0) >= true[t] - lost for t in range(20))
    exact = HeavyHitters(10_000)
    exact.add(np.array([3, 5], np.uint64), np.array([2, 1]))
    exact.add(np.array([5, 9], np.uint64), np.array([4, 1]))
    assert dict(zip(exact.tokens.tolist(), exact.times.tolist())) == {3: 2, 5: 5, 9: 1}
