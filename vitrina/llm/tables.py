"""Scratch tables in the cluster's shared folder, and small plan helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where none is set, a local master gets a temporary one; a cluster an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="vitrina-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


#: Rows in a file of a scratch table whose number of rows is about known.
FILE_ROWS = 50_000


class Scratch:
    """A table written to the shared folder, so that a lost executor costs no lineage; gone at the end of the session.

    ``rows``, if about known, keeps small tables in few files, whatever the number of shuffle partitions.
    """

    def __init__(self, df: DataFrame, rows: int | None = None):
        spark = df.sparkSession
        if rows is not None:
            df = df.coalesce(rows // FILE_ROWS + 1)
        self.path = f"{scratch_dir(spark)}/vitrina-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(self.path)
        self._system().deleteOnExit(self._path())
        self.df = spark.read.schema(df.schema).parquet(self.path)

    def _path(self):
        return SparkSession.active()._jvm.org.apache.hadoop.fs.Path(self.path)

    def _system(self):
        return self._path().getFileSystem(SparkSession.active().sparkContext._jsc.hadoopConfiguration())

    def drop(self) -> None:
        self._system().delete(self._path(), True)


def saved(df: DataFrame, rows: int | None = None) -> DataFrame:
    return Scratch(df, rows).df


class Bucketed:
    """A scratch table dealt by a column, so that what is grouped or joined by that column meets it without moving it."""

    def __init__(self, df: DataFrame, column: str, buckets: int):
        spark = df.sparkSession
        self.name, self.path = f"vitrina_{uuid.uuid4().hex}", f"{scratch_dir(spark)}/vitrina-{uuid.uuid4().hex}"
        df.write.format("parquet").bucketBy(buckets, column).option("path", self.path).saveAsTable(self.name)
        self.df = spark.table(self.name)

    def drop(self) -> None:
        spark = self.df.sparkSession
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def texts(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id and text (null: empty) and the named columns, whatever else the table has."""
    return docs.select("doc_id", F.coalesce(docs["text"], F.lit("")).alias("text"), *keep)


def broadcast_value(spark: SparkSession, value):
    """Ships a value whose size is bounded by construction."""
    return spark.sparkContext.broadcast(value)
