"""The operators of this package as queries over the given tables, and the SQL that those must equal which SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm.fingerprints import fingerprint_edits
from farebox.llm.html_text import extract_text
from farebox.llm.lexical_search import LEXICAL_SQL, search_documents
from farebox.llm.line_dedup import LINES_SQL, drop_boilerplate
from farebox.llm.mixing import MIX_SQL, mix_sources
from farebox.llm.ngram_join import similar_documents
from farebox.llm.passage_dedup import PASSAGES_SQL, remove_passages
from farebox.llm.quality import held_out, quality_of
from farebox.llm.sentencepiece_bpe import encode_documents
from farebox.llm.suffix_dedup import remove_repeated_substrings
from farebox.llm.topk import top_k
from farebox.llm.toxicity import toxicity_of
from farebox.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_documents(table(spark, sf_dir, "documents"), piece_model_path())
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality_of(docs, labels)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(3, 1).alias("held_out"), "score", predicted)


@query
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLES["op5_mix_sources"] = MIX_SQL


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_boilerplate(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_dropped")


ORACLES["op6_line_dedup"] = LINES_SQL


@query
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))


@query
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
    places = F.array_join(F.transform("removed", lambda x: F.concat_ws("-", x.start, x.end)), ",")
    return cut.select("doc_id", "n_removed", "text", places.alias("removed"))


ORACLES["op7_substring_dedup"] = PASSAGES_SQL


@query
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extract_text(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLES["op4_top_k"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity_of(docs, labels.filter(~held_out(4, 2)))
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "score", predicted)


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op13_lexical_search"] = LEXICAL_SQL


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


@query
def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeated_substrings(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x.stop - x.start)
    kept = F.sha2("kept", 256).alias("kept_sha256")
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), kept)
