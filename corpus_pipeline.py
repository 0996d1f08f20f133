"""From raw documents to token ids: quality, boilerplate lines, near copies, mixture, tokens.

``run`` applies the stages of ``STAGES`` in order; each is written as Parquet and read again as the input of the next.
Stages hand on the columns of ``documents``; the last one returns token ids. Every stage works on all rows it is given.

1. quality: a document stays if the classifier, trained on the labels of the corpus, scores it 0.5 or more.
2. lines: boilerplate lines of a source go; ``n_chars`` is that of the text that stays.
3. near copies: of every group of linked documents the one with the smallest id stays (rows without an id come last, then the text's
   hash decides), and of repeated rows one. Documents without words are linked with nothing and stay.
4. mixture: each document is repeated as often as its source's target weight says; one that is taken zero times goes.
5. tokens: ids of every text, begin and end included.

A row is known by its id and its text together: rows without an id go like others where they copy something, and rows that share an id
but hold unlinked texts all stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm.line_dedup import drop_boilerplate
from farebox.llm.mixing import mix_sources
from farebox.llm.ngram_join import similar_documents
from farebox.llm.quality import quality_of
from farebox.llm.queries import piece_model_path, table
from farebox.llm.scratch import shared_folder
from farebox.llm.sentencepiece_bpe import encode_documents

ORACLE_SQL = None  # the classifier and the tokens are beyond SQL; the tests compare with a plain version


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = quality_of(docs, table(spark, sf_dir, "labels"), tuple(docs.columns), score="__score")
    return scored.filter(F.col("__score") >= 0.5).select(*docs.columns)


def cut_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_boilerplate(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    version = F.xxhash64(F.col("text").cast("string"))
    row = F.struct(F.col("doc_id").isNull().alias("late"), F.coalesce("doc_id", F.lit(0)).alias("id"), version.alias("version"))
    groups = similar_documents(docs.select(row.alias("__row"), "text"), "__row")
    kept = groups.filter("__row = component_id").select("__row.late", "__row.id", "__row.version").distinct()
    kept = kept.select(F.when(~F.col("late"), F.col("id")).alias("__id"), F.col("version").alias("__version"))
    stays = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (version == F.col("__version")), "left_semi")
    if stays.groupBy("doc_id", version).count().filter("count > 1").isEmpty():
        return stays
    # Equal rows need no order; of rows that differ in other columns alone the first in their order stays.
    return stays.groupBy("doc_id", version.alias("__version")).agg(F.min(F.struct(*[c for c in docs.columns if c != "doc_id"])).alias("__row")).select(
        *[F.col("doc_id") if c == "doc_id" else F.col(f"__row.{c}") for c in docs.columns]
    )


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mix_sources(docs).filter("copies > 0")
    return mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*docs.columns)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = encode_documents(docs, piece_model_path(), keep=("doc_id", "source"))
    ids = F.col("ids")
    return encoded.select("doc_id", "source", (F.octet_length(ids) / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", keep_quality),
    ("lines", cut_boilerplate),
    ("near_copies", drop_near_copies),
    ("mixture", mix),
    ("tokens", to_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
