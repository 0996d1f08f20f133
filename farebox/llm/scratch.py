"""Tables that a job writes between its steps, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


MOST_BUCKETS = 100_000  # Spark takes no more by default


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, on whose file system every executor reads and writes.

    Only a local session, whose executor is the driver, may leave the setting out.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = f"file://{tempfile.gettempdir()}/farebox-local"
    return f"{top.rstrip('/')}/farebox-{uuid.uuid4().hex}"


class Steps:
    """Intermediate tables of one run: written once, read again, dropped when no later step needs them.

    A written table ends the lineage, so a lost executor costs at most the step that runs, and a step whose
    rows depend on how the input was split is computed only once.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, shared_folder(spark)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("errorifexists").option("compression", "zstd").parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def bucketed(self, df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
        """Like ``keep``, in so many buckets by ``column``: joins on it don't shuffle this table again.

        The session's catalog knows it by a name of its own; its files lie with the other tables.
        """
        buckets = min(buckets, MOST_BUCKETS)
        full = f"farebox_{uuid.uuid4().hex}"
        df.write.bucketBy(buckets, column).option("compression", "zstd").option("path", f"{self.folder}/{name}").saveAsTable(full)
        return self.spark.table(full)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
