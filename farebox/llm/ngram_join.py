"""Jaccard self-join on word shingles with adaptive multi-match prefixes, down to connected components.

Texts are lower-cased (A-Z), cut into words, and turned into their set of distinct five-word shingles (64-bit hashes; a
shorter text is one shingle of all its words). Texts link when 100 * intersection >= 80 * union.

1. ``Classes``: texts with equal sets share a key (64 bits of the set's MD5), and from here on a class counts as one. Where different sets
   share a key, their other 64 bits tell, and these become their keys; so classes are told apart by 128 bits.
2. ``Frequencies``: every task sends the shingles of the classes it met, packed by range of their hashes; a range counts in
   how many classes each shingle is, and sends those found in two or more on to their classes. Shingles of a single
   class cannot be shared and stop there. The few found in over a ``HOT`` part of the classes (at most average set size /
   HOT, hence a bounded table) get their counts from the tasks' own summaries of heavy hitters and skip the ranges, so no range holds a hot shingle.
3. ``Prefixes``: with its shingles in order of frequency (rare first), a class with n shingles needs a common shingle
   among its first n - t + 1 with any partner, t = ceil(0.8 n); more generally l common ones among its first n - t + l.
   Each class picks the l from 1 to 8 with the least estimated cost (postings read, plus verifications of the classes that share l
   of them). Two classes are candidates if they share at least the smaller l of the two.
4. ``Stars``: for every prefix shingle, a class of similar size with few shingles of its own leads (an original rather than an edited
   copy); each class is verified against the leader it shares most with. Large groups of near copies fall together here, with one
   comparison for each class.
5. ``Rest``: where a prefix shingle still joins classes of different components, all those pairs with enough common prefix
   shingles are verified. Pairs within a component are never made, and no link between components is lost.

Shingles are compared by 48 bits of their hashes, which two unrelated texts of 1,000 words agree in with a chance of 1 to 280 million.

Nulls, empty texts and texts without words have no shingles: ``n_shingles`` 0, linked with nothing. Repeated rows and equal texts are in one
component. A NULL id takes part, but never names a component unless all ids of it are NULL. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.buffers import by_text, lower_ascii, pieces_of, run_hashes, slices, span_hashes, text_bytes, word_spans
from farebox.llm.components import components
from farebox.llm.scratch import Steps

WORDS = 5
PERCENT = 80
HOT = 1 / 1024
RANGE_TOKENS = 2_000_000
MOST_MATCHES = 8
SUMMARY = 1 << 18  # shingles that a task's summary of heavy hitters holds
VERIFY_COST = 20


class HeavyHitters:
    """Times of the most frequent shingles of a task, from any number of batches in bounded memory.

    When the summary is full, every count is lowered by the least that makes room (Misra and Gries), so a
    count is too low by at most twice the shingles seen divided by ``size``, and never too high.
    """

    def __init__(self, size: int = SUMMARY):
        self.size, self.tokens, self.times = size, np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def cut(self, tokens: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(tokens) > self.size:
            times = times - np.partition(times, len(tokens) - self.size - 1)[len(tokens) - self.size - 1]
        return tokens[times > 0], times[times > 0]

    def add(self, tokens: np.ndarray, times: np.ndarray) -> None:
        tokens, times = self.cut(tokens, times)
        both, which = np.unique(np.r_[self.tokens, tokens], return_inverse=True)
        total = np.bincount(which, np.r_[self.times, times], minlength=len(both)).astype(np.int64)
        self.tokens, self.times = self.cut(both, total)


def shingle_sets(column: pa.Array, key_bits: int = 64, clashing: np.ndarray | None = None) -> tuple[list[int], list[int], np.ndarray, np.ndarray]:
    """Per text of a batch its class key (0: no shingles) and the other half of its digest, the sets end to end, and their sizes.

    A key in ``clashing`` is replaced by the other half.
    """
    data, offsets = text_bytes(column)
    keys, others, sets, sizes = [], [], [], []
    clashes = set() if clashing is None else set(clashing.tolist())
    for start, stop in slices(offsets):
        part, at = lower_ascii(data[offsets[start] : offsets[stop]]), offsets[start : stop + 1] - offsets[start]
        starts, lengths, owner = word_spans(part, at)
        hashes, texts = run_hashes(span_hashes(part, starts, lengths), owner, WORDS)
        bounds = by_text(texts, stop - start)
        for i in range(stop - start):
            own = np.unique(hashes[bounds[i] : bounds[i + 1]])
            digest = hashlib.md5(own.tobytes()).digest()
            key, other = (int.from_bytes(x, "little", signed=True) for x in (digest[:8], digest[8:]))
            key >>= 64 - key_bits
            keys.append((other if key in clashes else key) if len(own) else 0)
            others.append(other)
            sets.append(own)
            sizes.append(len(own))
    return keys, others, np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.array(sizes, np.int64)


def first_of_each(keys: list[int], sizes: np.ndarray) -> np.ndarray:
    """The first text of every class in a batch."""
    _, first = np.unique(np.array(keys, np.int64), return_index=True)
    return first[sizes[first] > 0]


def classes_of(docs: DataFrame, doc_id: str, key_bits: int) -> DataFrame:
    """Rows (doc_id, key, other, n) for the texts, and rows (token, times) for shingles that are frequent within a task."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hitters, classes, kind_of_id = HeavyHitters(), 0, None
        for batch in (piece for whole in batches for piece in pieces_of(whole, 1)):
            keys, others, tokens, sizes = shingle_sets(batch.column(1), key_bits)
            kind_of_id = batch.column(0).type
            ends = np.cumsum(sizes)
            first = first_of_each(keys, sizes)
            pieces = [tokens[ends[i] - sizes[i] : ends[i]] for i in first]
            if pieces:
                hitters.add(*np.unique(np.concatenate(pieces), return_counts=True))
            classes += len(first)
            n = len(keys)
            columns = [pa.array([k if size else None for k, size in zip(keys, sizes.tolist(), strict=True)], pa.int64()), pa.array(others, pa.int64()), pa.array(sizes)]
            yield pa.record_batch([batch.column(0), *columns, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names)
        often = (hitters.times >= 8) & (hitters.times >= HOT * classes / 2)
        if often.any():
            m = int(often.sum())
            columns = [pa.array(hitters.tokens[often].view(np.int64)), pa.array(hitters.times[often])]
            yield pa.record_batch([pa.nulls(m, kind_of_id), *[pa.nulls(m, pa.int64())] * 3, *columns], names)

    names = ["doc_id", "key", "other", "n", "token", "times"]
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, f"doc_id {kind}, key long, other long, n long, token long, times long")


def short(tokens: np.ndarray) -> bytes:
    """The upper 48 bits of 64-bit hashes, six bytes each."""
    return np.ascontiguousarray((tokens >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def long(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return out.view(np.int64).ravel()


def place(hashes: np.ndarray, parts: int) -> np.ndarray:
    """An even part number from the upper half of a 64-bit hash; it does not fall along the hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def token_rows(docs: DataFrame, parts: int, hot: Broadcast, key_bits: int) -> DataFrame:
    """Packed (part, keys, sizes, which, tokens, counts): ``which`` numbers each token's class in ``keys``.

    Rows of hot tokens have their frequencies in ``counts``; their part follows from the class.
    """
    names = ["part", "keys", "sizes", "which", "tokens", "counts"]
    binary = pa.binary()

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), *[binary] * 5]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, frequency, clashing = hot.value
        for batch in (piece for whole in batches for piece in pieces_of(whole, 0)):
            keys, _, tokens, sizes = shingle_sets(batch.column(0), key_bits, clashing)
            ends, first, key = np.cumsum(sizes), first_of_each(keys, sizes), np.array(keys, np.int64)
            if not len(first):
                continue
            owner = np.repeat(first, sizes[first])
            token = np.concatenate([tokens[ends[i] - sizes[i] : ends[i]] for i in first])
            order = np.argsort(token)
            owner, token = owner[order], token[order]
            spot = np.minimum(np.searchsorted(known, token), max(len(known) - 1, 0))
            is_hot = known[spot] == token if len(known) else np.zeros(len(token), bool)
            rows: list[tuple] = []

            def add(part: int, own: np.ndarray, tok: np.ndarray, counts: bytes | None, rows=rows, key=key, sizes=sizes) -> None:
                used, which = np.unique(own, return_inverse=True)
                rows.append((part, key[used].tobytes(), sizes[used].astype(np.int32).tobytes(), which.astype(np.uint32 if len(used) > 65535 else np.uint16).tobytes(), short(tok), counts))

            cold_owner, cold = owner[~is_hot], token[~is_hot]
            bounds = np.searchsorted(place(cold, parts), np.arange(parts + 1))
            for part in np.flatnonzero(np.diff(bounds)):
                s = slice(bounds[part], bounds[part + 1])
                add(int(part), cold_owner[s], cold[s], None)
            if is_hot.any():
                own, tok, counts = owner[is_hot], token[is_hot], frequency[spot[is_hot]]
                target = place(key[own].view(np.uint64), parts)
                order = np.argsort(target, kind="stable")
                bounds = np.searchsorted(target[order], np.arange(parts + 1))
                for part in np.flatnonzero(np.diff(bounds)):
                    s = order[bounds[part] : bounds[part + 1]]
                    add(int(part), own[s], tok[s], counts[s].astype(np.int32).tobytes())
            for i in range(0, len(rows), 64):
                yield packed(rows[i : i + 64])

    schema = "part int, keys binary, sizes binary, which binary, tokens binary, counts binary"
    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def shared_rows(ranges: DataFrame, parts: int) -> DataFrame:
    """From the token rows of each range the shingles of two or more classes, packed by part of the class's key."""
    names = ["part", "keys", "sizes", "tokens", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sizes, tokens, counts = [], [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                which = np.frombuffer(row["which"], np.uint16 if len(row["keys"]) <= 8 * 65536 else np.uint32)
                keys.append(np.frombuffer(row["keys"], np.int64)[which])
                sizes.append(np.frombuffer(row["sizes"], np.int32)[which])
                tokens.append(long(row["tokens"]))
                counts.append(np.frombuffer(row["counts"], np.int32) if row["counts"] else np.zeros(len(which), np.int32))
        if not keys:
            return
        key, size, token, count = map(np.concatenate, (keys, sizes, tokens, counts))
        order = np.lexsort((key, token))
        key, size, token, count = key[order], size[order], token[order], count[order]
        new = np.ones(len(key), bool)
        new[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
        key, size, token, count = key[new], size[new], token[new], count[new]
        first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        classes = np.diff(np.r_[first, len(token)])
        count = np.where(count > 0, count, np.repeat(classes, classes))
        keep = count > 1
        key, size, token, count = key[keep], size[keep], token[keep], count[keep]
        target = place(key.view(np.uint64), parts)
        order = np.argsort(target, kind="stable")
        bounds = np.searchsorted(target[order], np.arange(parts + 1))
        rows = []
        for part in np.flatnonzero(np.diff(bounds)):
            s = order[bounds[part] : bounds[part + 1]]
            rows.append((int(part), key[s].tobytes(), size[s].tobytes(), short(token[s].view(np.uint64) << np.uint64(16)), count[s].astype(np.int32).tobytes()))
        for i in range(0, len(rows), 64):
            columns = zip(*rows[i : i + 64], strict=True)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, [pa.int32(), *[pa.binary()] * 4], strict=True)], names)

    return ranges.mapInArrow(run, "part int, keys binary, sizes binary, tokens binary, counts binary")


def matches_needed(n: int, counts: np.ndarray) -> tuple[int, int]:
    """(l, length of the prefix among the shared shingles) of least estimated cost; (0, 0) if no partner is possible."""
    least = -(-PERCENT * n // 100)
    alone = n - len(counts)
    best, cost = (0, 0), None
    partners = np.cumsum(counts - 1)
    for matches in range(1, min(MOST_MATCHES, least) + 1):
        length = min(n - least + matches - alone, len(counts))
        if length < matches:
            return 0, 0
        reads = float(partners[length - 1])
        now = reads + VERIFY_COST * reads / matches
        if cost is None or now < cost:
            best, cost = (matches, length), now
    return best


def prefixes(shared: DataFrame) -> DataFrame:
    """Per class that may have partners: (key, n, need, shared, rest, prefix, tokens).

    ``tokens`` are all its shared shingles, packed, ``shared`` is their number, and ``rest`` how many lie behind the prefix.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sizes, tokens, counts = [], [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                keys.append(np.frombuffer(row["keys"], np.int64))
                sizes.append(np.frombuffer(row["sizes"], np.int32))
                tokens.append(long(row["tokens"]))
                counts.append(np.frombuffer(row["counts"], np.int32))
        if not keys:
            return
        key, size, token, count = map(np.concatenate, (keys, sizes, tokens, counts))
        order = np.lexsort((token, count, key))
        key, size, token, count = key[order], size[order], token[order], count[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        rows = []
        for start, stop in zip(first.tolist(), [*first[1:].tolist(), len(key)], strict=True):
            n = int(size[start])
            need, length = matches_needed(n, count[start:stop])
            if need:
                own = np.sort(token[start:stop]).view(np.uint64) << np.uint64(16)
                rows.append((int(key[start]), n, need, stop - start, stop - start - length, token[start : start + length].tolist(), short(own)))
            if len(rows) == 512:
                yield made(rows)
                rows = []
        if rows:
            yield made(rows)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [*[pa.int64()] * 5, pa.list_(pa.int64()), pa.binary()]
        columns = zip(*rows, strict=True)
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    names = ["key", "n", "need", "shared", "rest", "prefix", "tokens"]
    return shared.mapInArrow(run, "key long, n long, need long, shared long, rest long, prefix array<long>, tokens binary")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, by the intersection of their whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for row in batch.to_pylist():
                left, right = long(row["tokens"]), long(row["other"])
                if len(left) > len(right):
                    left, right = right, left
                spot = np.minimum(np.searchsorted(right, left), len(right) - 1)
                both = int((right[spot] == left).sum())
                if 100 * both >= PERCENT * (row["n"] + row["m"] - both):
                    links.append((row["a"], row["b"]))
            if links:
                a, b = zip(*links, strict=True)
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    one = sets.select(F.col("key").alias("a"), "n", "tokens")
    two = sets.select(F.col("key").alias("b"), F.col("n").alias("m"), F.col("tokens").alias("other"))
    sized = pairs.join(one.select("a", "n"), "a").join(two.select("b", "m"), "b")
    fitting = sized.filter(100 * F.least("n", "m") >= PERCENT * F.greatest("n", "m")).select("a", "b")
    return fitting.join(one, "a").join(two, "b").select("a", "b", "n", "m", "tokens", "other").mapInArrow(run, "a long, b long")


def overlap_needed(n: str, m: str) -> Column:
    return F.ceil(PERCENT * (F.col(n) + F.col(m)) / (100 + PERCENT))


def star_pairs(postings: DataFrame, steps: Steps) -> DataFrame:
    """For each class the leader that it shares most prefix shingles with.

    Among classes of similar size that share a shingle, the one leads whose own shingles are least (an original rather than an
    edited copy), and the smallest key among such.
    """
    kind = F.floor(F.log("n") / F.log(F.lit(100 / PERCENT))).cast("long")
    own = (F.col("n") - F.col("shared")) / F.col("n")
    sorted_by = postings.select("token", "key", "n", "shared", kind.alias("kind"), own.alias("own"))
    leader = F.min(F.struct("own", "key", F.col("n").alias("m"), F.col("shared").alias("shared2"))).alias("leader")
    leaders = sorted_by.groupBy("token", "kind").agg(leader, F.count("*").alias("rows")).filter("rows > 1")
    leaders = steps.keep(leaders.select("token", "kind", F.col("leader.key").alias("leader"), "leader.m", "leader.shared2"), "leaders")
    led = sorted_by.join(leaders, ["token", "kind"]).filter("key <> leader")
    led = led.filter(F.least("shared", "shared2") >= overlap_needed("n", "m")).groupBy("key", "leader").agg(F.count("*").alias("times"))
    best = led.groupBy("key").agg(F.max(F.struct("times", -F.col("leader"))).alias("best"))
    return best.select(F.col("key").alias("a"), (-F.col("best.col2")).alias("b"))


def open_postings(postings: DataFrame, labels: DataFrame, steps: Steps) -> DataFrame:
    """The postings of the shingles that still join different components, with the class's ``label`` and the ``main`` one.

    The main component of a shingle is the one that most of its classes are in.
    """
    named = postings.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    named = steps.keep(named, "named")
    sizes = named.groupBy("token", "label").agg(F.count("*").alias("rows"))
    mixed = sizes.groupBy("token").agg(F.max(F.struct("rows", "label")).alias("top"), F.count("*").alias("labels")).filter("labels > 1")
    mixed = steps.keep(mixed.select("token", F.col("top.label").alias("main")), "mixed")
    return steps.keep(named.join(mixed, "token"), "open")


def rest_pairs(open_rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of classes in different components that share enough prefix shingles.

    One of the two is outside of the main component, so a large component costs one comparison for each class outside it. The first
    common shingle of a pair that links lies early among the shared ones of both, as the whole overlap follows it; only such places are
    joined. Then all common prefix shingles are counted: at least the smaller ``need``, and so many that the ``rest`` of the class
    whose prefix ends first can make up for what the overlap still lacks.
    """
    columns = ("key", "n", "shared", "pos", "label")
    other = open_rows.select("token", *[F.col(c).alias(f"{c}2") for c in columns], (F.col("label") == F.col("main")).alias("in_main"))
    overlap = overlap_needed("n", "n2")
    fits = (F.col("label") != F.col("label2")) & (F.col("in_main") | (F.col("key") < F.col("key2")))
    fits &= 100 * F.least("n", "n2") >= PERCENT * F.greatest("n", "n2")
    fits &= (F.col("shared") - F.col("pos") >= overlap) & (F.col("shared2") - F.col("pos2") >= overlap)
    early = open_rows.filter("label <> main").filter(F.col("shared") - F.col("pos") >= F.ceil(PERCENT * F.col("n") / 100))
    met = early.join(other, "token").filter(fits).select(F.least("key", "key2").alias("a"), F.greatest("key", "key2").alias("b")).distinct()
    one = sets.select(F.col("key").alias("a"), "n", "need", "rest", "prefix")
    two = sets.select("key", *[F.col(c).alias(f"{c}2") for c in ("n", "need", "rest", "prefix")]).withColumnRenamed("key", "b")
    both = met.join(one, "a").join(two, "b")
    least = F.greatest(F.least("need", "need2"), overlap - F.greatest("rest", "rest2"))
    return both.filter(F.size(F.array_intersect("prefix", "prefix2")) >= least).select("a", "b")


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", key_bits: int = 64) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text). The smallest id of a component names it; ids may be of any ordered type."""
    spark = docs.sparkSession
    steps = Steps(spark)
    found = steps.keep(classes_of(docs, doc_id, key_bits), "classes")
    members = found.filter("n IS NOT NULL")
    # With 64 bits, 10^10 different sets share a few keys by chance: a short list, whatever the table.
    clashes = members.filter("key IS NOT NULL").groupBy("key").agg(F.min("other").alias("low"), F.max("other").alias("high")).filter("low <> high")
    clashing = [r["key"] for r in clashes.select("key").collect()]
    key = F.when(F.col("key").isin(clashing), F.col("other")).otherwise(F.col("key")) if clashing else F.col("key")
    members = members.select("doc_id", key.alias("key"), "n")
    tokens, texts = members.agg(F.sum("n"), F.count("key")).first()
    hot = found.filter("token IS NOT NULL").groupBy("token").agg(F.sum("times").alias("times"))
    # At most (average set size / HOT) shingles are in so many classes: their counts add up to the number of all shingles.
    often = hot.filter(F.col("times") >= HOT * (texts or 0)).toPandas().sort_values("token")
    token, times = often["token"].to_numpy(np.int64).view(np.uint64), often["times"].to_numpy(np.int64)
    order = np.argsort(token)
    sent = spark.sparkContext.broadcast((token[order], times[order], np.array(clashing, np.int64)))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(tokens or 0) // RANGE_TOKENS), 1)
    ranges = token_rows(docs, parts, sent, key_bits).repartitionById(parts, "part")
    shared = shared_rows(ranges, parts).repartitionById(parts, "part")
    sets = steps.keep(prefixes(shared), "sets")
    postings = steps.keep(sets.select(F.posexplode("prefix").alias("pos", "token"), "key", "n", "shared"), "postings")
    links = steps.keep(verified(star_pairs(postings, steps), sets), "star-links")
    labels = components(links, steps, "stars")
    more = steps.keep(verified(rest_pairs(open_postings(postings, labels, steps), sets), sets), "rest-links")
    if not more.isEmpty():
        named = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
        ends = more.join(named, "a", "left").join(named.toDF("b", "lb"), "b", "left")
        between = ends.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).distinct()
        merged = components(between, steps, "rest")
        via = labels.join(merged.toDF("label", "final"), "label", "left").select("node", F.coalesce("final", "label").alias("label"))
        labels = steps.keep(via.union(merged).groupBy("node").agg(F.min("label").alias("label")), "labels")
    classes = members.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("low"))
    named = steps.keep(classes.join(labels.withColumnRenamed("node", "key"), "key", "left").select("key", "low", F.coalesce("label", "key").alias("label")), "named-classes")
    lowest = steps.keep(named.groupBy("label").agg(F.min("low").alias("component_id")), "lowest")
    ids = steps.keep(named.join(lowest, "label").select("key", "component_id"), "ids")
    joined = members.join(ids, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select(F.col("doc_id").alias(doc_id), F.col("n").alias("n_shingles"), component.alias("component_id"))
