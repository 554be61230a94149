"""The event ledger: JSON lines, one file a batch, only ever appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.operators.reports import LEDGER
from vitrina.sources.cache import exists


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All events; none where there is no ledger yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).json(path)


def append_events(events: DataFrame, path: str) -> None:
    """Appends events (kind and any further ledger columns), stamped with the UTC second."""
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    names = [f.name for f in T._parse_datatype_string(LEDGER).fields if f.name != "ts"]
    events.select(now.alias("ts"), *[c for c in names if c in events.columns]).write.mode("append").json(path)
