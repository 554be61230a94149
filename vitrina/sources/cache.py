"""Read-through caches: answers of a slow, paid service kept as an append-only Parquet table.

Every answer is written before it is used, so that a lost executor never leads to a second call for a
committed answer. Failures are kept too, with their error; they are not served and are tried again.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def scratch_path(spark: SparkSession) -> str:
    """A new path in the folder that spark.checkpoint.dir names. Where none is set, a local master gets a temporary folder; a cluster an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="vitrina-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/vitrina-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """df as a written table: cuts the lineage of loops and pins the answers of a provider. It goes with the session."""
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    written = spark._jvm.org.apache.hadoop.fs.Path(path)
    written.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(written)
    return spark.read.schema(df.schema).parquet(path)


def answers(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if exists(spark, path) else None


def read_through(rows: DataFrame, key: list[str], path: str, call: Callable[[DataFrame], DataFrame], cap: int | None = None, order: str = "row_id") -> DataFrame:
    """rows with ok, value and error of their key, from the cache at ``path`` or from ``call``.

    ``call`` adds ok, value and error to the rows it is given. Keys not held are called in order until
    ``cap`` calls succeeded; failures do not count. Rows that no call was left for are not returned. A key
    that occurs in several rows is called once. Rows of one place in the order go by their key.
    """
    spark = rows.sparkSession
    held = answers(spark, path)
    misses = rows if held is None else rows.join(held.filter("ok").select(*key), key, "left_anti")
    first = F.row_number().over(Window.partitionBy(*key).orderBy(order))
    place = F.struct(F.col(order), *[F.col(c) for c in key if c != order])
    misses = saved(misses.withColumn("__n", first).filter("__n = 1").drop("__n").withColumn("__place", place))
    done, after, run = 0, None, uuid.uuid4().hex
    while cap is None or done < cap:
        turn = misses if after is None else misses.filter(F.col("__place") > F.struct(*[F.lit(x) for x in after]).cast(misses.schema["__place"].dataType))
        if cap is not None:
            turn = turn.orderBy("__place").limit(cap - done)
        batch = uuid.uuid4().hex
        call(turn.drop("__place")).select(*dict.fromkeys([*key, order]), "ok", "value", "error", F.lit(run).alias("run"), F.lit(batch).alias("batch")).write.mode("append").parquet(path)
        n, good, last = spark.read.parquet(path).filter(F.col("batch") == batch).agg(F.count("*"), F.count_if("ok"), F.max(place)).first()
        if cap is None or n < cap - done:
            break
        done, after = done + good, last
    found = answers(spark, path)
    if found is None:
        return rows.limit(0).select("*", F.lit(True).alias("ok"), F.lit("").alias("value"), F.lit("").alias("error"))
    found = found.filter(F.col("ok") | (F.col("run") == run))
    best = found.groupBy(*key).agg(F.max_by(F.struct("ok", "value", "error"), F.col("ok")).alias("a"))
    return rows.join(best, key).select(*rows.columns, "a.ok", "a.value", "a.error")
