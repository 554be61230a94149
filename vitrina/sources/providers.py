"""Calls to outside services (search, judge, image fetch, reachability) from executors.

A provider is two callables: ``connect()`` makes a client, once a partition, and ``fetch(client, row)``
answers a row (a dict) with text. ``Retry`` asks for another attempt after 1, 2, 4 ... seconds; any other
exception fails the row at once. A failed row never fails its task: Spark would call, and pay, again.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

ATTEMPTS = 4


class Retry(Exception):
    """A passing failure: too many requests, a server's error, a broken connection."""


def attempt(fetch: Callable[[Any, dict], str], client: Any, row: dict, attempts: int = ATTEMPTS, sleep: Callable[[float], None] = time.sleep) -> tuple[bool, str | None, str | None, int]:
    error = None
    for n in range(attempts):
        try:
            return True, fetch(client, row), None, n + 1
        except Retry as e:
            error = str(e)[:200]
            sleep(2**n)
        except Exception as e:  # one row's failure is its own
            return False, None, str(e)[:200], n + 1
    return False, None, error, attempts


def call(rows: DataFrame, connect: Callable[[], Any], fetch: Callable[[Any, dict], str], attempts: int = ATTEMPTS, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """rows with ok, value (text), error and attempts."""
    schema = T.StructType([*rows.schema.fields, T.StructField("ok", T.BooleanType()), T.StructField("value", T.StringType()), T.StructField("error", T.StringType()), T.StructField("attempts", T.IntegerType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = None
        for batch in batches:
            client = connect() if client is None else client
            got = [attempt(fetch, client, r, attempts, sleep) for r in batch.to_dict("records")]
            yield batch.assign(**{c: [g[i] for g in got] for i, c in enumerate(("ok", "value", "error", "attempts"))})

    return rows.mapInPandas(run, schema)
