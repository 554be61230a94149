"""The ledger as a stream: calls of each UTC day, as batch reports count them, kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.operators.reports import LEDGER
from vitrina.sources.cache import scratch_path


def follow(spark: SparkSession, path: str, files: int = 100) -> DataFrame:
    """New ledger files as they come, ``files`` of them a batch; ts becomes a timestamp."""
    return spark.readStream.schema(LEDGER).option("maxFilesPerTrigger", files).json(path).withColumn("ts", F.to_timestamp("ts"))


def daily_calls(events: DataFrame, lateness: str = "2 days") -> DataFrame:
    """day, kind and n; the state of a day goes once ``lateness`` has passed."""
    days = events.withWatermark("ts", lateness).groupBy(F.window("ts", "1 day").alias("w"), "kind").agg(F.count("*").alias("n"))
    return days.select(F.to_date("w.start").alias("day"), "kind", "n")


def run_available(stream: DataFrame) -> DataFrame:
    """Runs an aggregated stream over what there is now, and returns its last full result."""
    spark = stream.sparkSession
    out = scratch_path(spark)

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    query = stream.writeStream.outputMode("complete").option("checkpointLocation", out + "-state").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
