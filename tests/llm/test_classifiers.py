import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from odd import sentence
from pyspark.sql import functions as F
from farebox.llm.queries import QUERIES
from farebox.llm.quality import QualitySettings, held_out, learn, score_quality, text_features, train_quality
from farebox.llm.toxicity import differences, score_toxicity, toxicity_of, train_toxicity, word_grams

SMALL = QualitySettings(bits=16)


def accuracy(rows, labels):
    known = [(labels[x.doc_id], x.predicted) for x in rows if x.held_out and x.doc_id in labels]
    assert len(known) > 50
    return np.mean([a == b for a, b in known])


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = {x.doc_id: x.quality for x in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op10_quality"](spark, folder).collect()
    assert len(rows) == 1000
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 3 == 1) for x in rows)
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in rows)
    assert accuracy(rows, labels) > 0.95


def test_quality_does_not_read_held_out_labels(spark, odd):
    ids = [x for x in range(1, 12)]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    turned = spark.createDataFrame([(i, 1 - i % 2 if zlib.crc32(str(i).encode()) % 3 == 1 else i % 2) for i in ids], "doc_id long, quality int")
    one, two = (train_quality(odd, x.filter(~held_out(3, 1)), SMALL) for x in (labels, turned))
    assert np.array_equal(one, two) and np.any(one)


def test_quality_of_odd_documents(spark, odd, no_documents):
    labels = spark.createDataFrame([(1, 1), (1, 0), (6, 0), (8, 1), (None, 1), (77, 1), (4, None), (5, 3)], "doc_id long, quality int")
    weights = train_quality(odd, labels, SMALL)
    assert np.array_equal(weights, train_quality(odd.repartition(5), labels, SMALL))
    rows = score_quality(odd, weights, keep=("doc_id", "text", "score", "label")).collect()
    assert len(rows) == odd.count() and all(0 <= x.score <= 1 for x in rows)
    empty = {x.score for x in rows if not (x.text or "").strip()}
    assert len(empty) == 1 and empty.pop() == pytest.approx(1 / (1 + np.exp(-float(weights[-1]))))
    by_text: dict = {}
    for x in rows:
        assert by_text.setdefault(x.text, x.score) == x.score
    assert score_quality(no_documents, weights).collect() == []
    for docs, known in ((odd, labels.limit(0)), (no_documents, labels)):
        assert {x.score for x in score_quality(odd, train_quality(docs, known, SMALL)).collect()} == {0.5}


def test_features_do_not_depend_on_the_batch():
    texts = ["One two two. THREE!!", None, "", "x", "ünï cödé 12 ab12", "a " * 3000]
    whole = [np.sort(at[owner == i]) for n, at, owner, _ in text_features(pa.array(texts), 16) for i in range(n)]
    alone = [np.sort(next(text_features(pa.array([x], pa.string()), 16))[1]) for x in texts]
    assert all(np.array_equal(a, b) for a, b in zip(whole, alone, strict=True))


def toxic_corpus(n=900):
    draw = random.Random(3)
    rows = []
    for i in range(n):
        words, toxic = sentence(1000 + i, draw.randrange(20, 120)).split(), draw.random() < 0.2
        for _ in range(draw.randrange(2, 5) if toxic else 0):
            words.insert(draw.randrange(len(words)), "vequ" + "".join(draw.choice("aeiorstn") for _ in range(3)))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_finds_rare_forms(spark):
    rows = toxic_corpus()
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(x[0], x[2]) for x in rows], "doc_id long, toxic int")
    scored = score_toxicity(docs, train_toxicity(docs, labels.filter(~held_out(4, 2)))).collect()
    truth = {x[0]: x[2] for x in rows}
    held = [x for x in scored if zlib.crc32(str(x.doc_id).encode()) % 4 == 2]
    assert len(held) > 150
    assert np.mean([(x.score >= 0.3) == truth[x.doc_id] for x in held]) > 0.97


def test_toxicity_of_odd_documents(spark, odd, no_documents):
    rows = toxic_corpus(300)
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(x[0], x[2]) for x in rows] + [(None, 1), (0, None), (99999, 1), (1, 7)], "doc_id long, toxic int")
    model = train_toxicity(docs, labels)
    scored = score_toxicity(odd, model, keep=("doc_id", "text", "score", "n")).collect()
    assert len(scored) == odd.count() and all(0 <= x.score <= 1 for x in scored)
    assert len({x.score for x in scored if not (x.text or "").strip()}) == 1
    assert score_toxicity(no_documents, model).collect() == []
    one_class = train_toxicity(docs, labels.filter("toxic = 0"))
    assert {round(x.score, 6) for x in score_toxicity(odd, one_class).collect()} == {round(0.5 / (labels.filter("toxic = 0").count() + 1), 6)}
    assert {x.score for x in score_toxicity(odd, train_toxicity(no_documents, labels.limit(0))).collect()} == {0.5}


def test_grams_are_padded_and_end():
    key, word = word_grams(np.frombuffer(b"abz", np.uint8), np.array([0, 2]), np.array([2, 1]))
    assert [int(k).to_bytes(6, "big") for k in key] == [b"\0\0\0\0\0a", b"\0\0\0\0ab", b"\0\0\0ab ", b"\0\0\0\0\0z", b"\0\0\0\0z "]
    assert word.tolist() == [0, 0, 0, 1, 1]


def test_rare_grams_stay_in_the_model_of_a_large_corpus(spark):
    # 8 million toxic gram counts: a gram of 4 texts lies under a millionth of them, and an expression of these texts is still known.
    counts = spark.range(2_000_000).select((F.col("id") + (1 << 40)).alias("gram"), F.lit(4).alias("toxic"), F.lit(4).alias("ordinary"))
    rare = spark.createDataFrame([(0x7A7A71, 4, 0)], "gram long, toxic int, ordinary int")
    grams, contexts = differences(counts.union(rare), 8_000_004, 8_000_000)
    assert grams.filter(F.col("gram") == 0x7A7A71).first().value > 0
    assert grams.count() == 2_000_001 and contexts.filter(F.col("context") == 0x7A7A).count() == 1


def test_rows_keep_their_texts_over_slices(spark):
    rows = toxic_corpus(200)
    docs = spark.createDataFrame([(i % 50, text, k) for k, (i, text, _) in enumerate(rows)], "doc_id long, text string, n int")
    model = train_toxicity(docs, spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int"))
    whole = {x.n: x.score for x in score_toxicity(docs.coalesce(1), model, ("n",)).collect()}
    parts = {x.n: x.score for x in score_toxicity(docs.repartition(7), model, ("n",)).collect()}
    assert whole.keys() == parts.keys() == set(range(200)) and all(abs(whole[n] - parts[n]) < 1e-9 for n in whole)


def test_repeated_ids_count_once_with_one_text_and_are_bounded(spark):
    """One labelled id repeated without end trains like one row; with ever new texts no more than the sample is learned."""
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    one = spark.createDataFrame([(1, "good words here"), (2, "bad bad bad")], "doc_id long, text string")
    many = one.union(spark.range(20_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("good words here").alias("text")))
    few = QualitySettings(bits=12, sample=10)
    assert np.array_equal(train_quality(one, labels, few), train_quality(many.repartition(6), labels, few))
    texts = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("word"), F.col("id").cast("string")).alias("text"))
    first = texts.withColumn("tie", F.xxhash64("text")).orderBy("tie").limit(10).select("doc_id", "text")
    assert np.array_equal(train_quality(texts, labels, few), train_quality(first, labels, few))


def plain_ftrl(rows, settings):
    """Follow-the-regularised-leader in plain Python over (label, {slot: value})."""
    from math import exp, sqrt

    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= settings.l1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return (sign * settings.l1 - z[i]) / ((settings.beta + sqrt(n[i])) / settings.alpha + settings.l2)

    for _ in range(settings.passes):
        for label, x in rows:
            w = {i: weight(i) for i in x}
            p = 1 / (1 + exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - label) * v
                step = (sqrt(n.get(i, 0.0) + g * g) - sqrt(n.get(i, 0.0))) / settings.alpha
                z[i], n[i] = z.get(i, 0.0) + g - step * w[i], n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def test_training_equals_plain_follow_the_regularised_leader():
    draw = random.Random(4)
    settings = QualitySettings(bits=6)
    rows = []
    for _ in range(60):
        slots = sorted(draw.sample(range(64), 8))
        rows.append((draw.randrange(2), np.array(slots, np.int32), np.array([draw.choice([0.25, 0.5, 1.0]) for _ in slots], np.float16)))
    got = learn(rows * settings.passes, settings)
    want = plain_ftrl([(y, dict(zip(s.tolist(), v.astype(float).tolist())) | {64: 1.0}) for y, s, v in rows], settings)
    assert np.allclose(got, [want.get(i, 0.0) for i in range(65)], atol=1e-6)


def test_the_toxicity_query(spark):
    """On sf0.01 a few hundred labels are all there is to learn from; sizes and rules are what is checked, and that toxic texts stand out."""
    folder = "/root/testdata/sf0.01"
    labels = {x.doc_id: x.toxic for x in spark.read.parquet(f"{folder}/labels.parquet").collect() if x.toxic is not None}
    rows = QUERIES["op2_toxicity"](spark, folder).collect()
    assert len(rows) == 1000 and all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in rows)
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.3) for x in rows)
    held = [(x.score, labels[x.doc_id]) for x in rows if x.held_out and x.doc_id in labels]
    above = [a > b for a, y in held for b, z in held if y > z]
    assert np.mean(above) > 0.85


def test_repeated_ids_in_toxicity_training(spark):
    rows = toxic_corpus(200)
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(x[0], x[2]) for x in rows], "doc_id long, toxic int")
    many = docs.union(spark.range(100_000).select(F.lit(rows[0][0]).cast("long").alias("doc_id"), F.lit(rows[0][1]).alias("text")))
    scored = toxicity_of(many.repartition(6), labels)
    assert scored.count() == 100_200 and scored.filter("doc_id = 0").select("score").distinct().count() == 1


def plain_differences(texts, order=6, discount=0.75):
    """Log-likelihood differences of grams and contexts from plain counts: interpolated Kneser-Ney with shared backoff."""
    from collections import Counter
    from math import log

    counts = {0: Counter(), 1: Counter()}
    for text, label in texts:
        for word in set(text.split()):
            data = b"\0" * (order - 1) + word.encode() + b" "
            counts[label].update(data[k : k + order] for k in range(len(data) - order + 1))
    totals = [sum(counts[c].values()) for c in (0, 1)]
    least = min(totals)
    o, t = ({g: n * least / totals[c] for g, n in counts[c].items()} for c in (0, 1))
    grams = set(o) | set(t)
    p = {g: t.get(g, 0) + o.get(g, 0) for g in grams}

    def context(table):
        every, free = Counter(), Counter()
        for g in grams:
            every[g[:-1]] += table.get(g, 0)
            free[g[:-1]] += min(table.get(g, 0), discount)
        return every, free

    (all_t, free_t), (all_o, free_o), (all_p, free_p) = map(context, (t, o, p))
    n4 = Counter(g[-4:] for g in grams)
    n1, n3, kinds = Counter(), Counter(), Counter()
    for g, n in n4.items():
        n1[g[-1:]] += n
        n3[g[:-1]] += n
        kinds[g[:-1]] += 1
    value = {}
    for g in grams:
        c, short = g[:-1], g[-4:]
        middle = (max(n4[short] - discount, 0) + discount * kinds[short[:-1]] * n1[g[-1:]] / len(grams)) / n3[short[:-1]]
        shared = (max(p[g] - discount, 0) + free_p[c] * middle) / all_p[c]
        seen = [(max(x.get(g, 0) - discount, 0) + free[c] * shared) / every[c] if every[c] > 0 else shared for x, every, free in ((t, all_t, free_t), (o, all_o, free_o))]
        value[g] = log(seen[0] / seen[1])
    return value, counts


def test_differences_equal_plain_kneser_ney(spark):
    draw = random.Random(8)
    texts = [(" ".join(draw.choice(["stone", "stoned", "river", "rivers", "vequor", "vequal", "at"]) for _ in range(6)), draw.randrange(2)) for _ in range(60)]
    want, counts = plain_differences(texts)
    rows = [(int.from_bytes(g, "big"), counts[1][g], counts[0][g]) for g in want]
    frame = spark.createDataFrame(rows, "gram long, toxic long, ordinary long")
    grams, _ = differences(frame, sum(counts[1].values()), sum(counts[0].values()))
    got = {int(x.gram).to_bytes(6, "big"): x.value for x in grams.collect()}
    kept = {g for g in want if max(counts[0][g], counts[1][g]) >= 3}
    assert got.keys() == kept and len(kept) > 20
    assert all(abs(got[g] - want[g]) < 1e-9 for g in kept)
