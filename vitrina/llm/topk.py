"""Exact k nearest binary codes by incremental multi-index hashing.

A vector's code has the sign bits of its components. Codes are cut in segments; the index has a row for
each code and segment. A query probes every segment value within a radius that grows step by step. After
radius s in all of m segments every code within distance m (s + 1) - 1 has been probed (a code farther
than s in each segment is at least m (s + 1) away), so a query is done when its k-th verified distance is
no more than that.

Scale: equal codes are one row of the index with their least k + 1 ids, which is all that can be among the
k nearest by (distance, id), so copies in any number cost nothing, and each task passes on no more than so many of a code; of a query's candidates at most k + 1
codes are kept from step to step for the same reason. Queries and index meet in merge joins by segment
value: probes grow with the radius, which Spark's estimate of their size does not see, so that it would
broadcast them.

Edge cases: a null vector or one of another length has no code, is nobody's neighbour and finds none; ties
go to the lesser id; a query is not its own neighbour, but its copies are; fewer than k vectors give fewer
rows; repeated rows of one id count once; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrina.llm.tables import Scratch


def sign_code(vector: str | Column, bits: int = 64) -> Column:
    """Bit i is set if component i is over zero; null unless there are exactly ``bits`` components."""
    v = F.col(vector) if isinstance(vector, str) else vector
    flags = F.transform(v, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return F.when(F.size(v) == bits, F.aggregate(flags, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x)))


def _segment_values(code: Column, bits: int, segments: int) -> Column:
    width = bits // segments
    return F.array(*[F.shiftrightunsigned(code, width * j).bitwiseAND(F.lit((1 << width) - 1)) for j in range(segments)])


def segments_for(n: int, bits: int = 64) -> int:
    """Segments of about log2(n) bits, so that a segment value has about one of n codes."""
    return min((s for s in range(2, bits // 2 + 1) if bits % s == 0), key=lambda s: abs(bits / s - math.log2(max(n, 2))))


def nearest_codes(vectors: DataFrame, queries: DataFrame, k: int = 10, bits: int = 64, segments: int | None = None) -> DataFrame:
    """For each query id its k nearest vectors: query_id, neighbour_id, distance, rank.

    Both tables have columns id and code. ``bits`` is a multiple of ``segments``, which by default follow from
    the number of distinct codes.
    """
    most = k + 1
    first = Window.partitionBy("code").orderBy("id")
    least = vectors.select("id", "code").filter("id is not null and code is not null").distinct().withColumn("n", F.row_number().over(first)).filter(F.col("n") <= most)
    codes = Scratch(least.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")))
    segments = segments or segments_for(codes.df.count(), bits)
    width = bits // segments
    index = Scratch(codes.df.select("code", F.size("ids").alias("n"), F.col("ids")[0].alias("least"), F.posexplode(_segment_values(F.col("code"), bits, segments)).alias("segment", "value")))
    asked = queries.select("id", "code").filter("id is not null and code is not null").distinct()
    open_ = Scratch(asked.select(F.col("code").alias("q")).distinct())
    best = Window.partitionBy("q").orderBy("distance", "least")
    found, done = None, []
    for radius in range(width + 1):
        masks = F.array(*[F.lit(sum(1 << b for b in bs)).cast("long") for bs in combinations(range(width), radius)])
        probes = open_.df.select("q", F.posexplode(_segment_values(F.col("q"), bits, segments)).alias("segment", "value")).select("q", "segment", "value", F.explode(masks).alias("mask"))
        probes = probes.select("q", "segment", F.col("value").bitwiseXOR(F.col("mask")).alias("value"))
        new = probes.hint("merge").join(index.df, ["segment", "value"]).select("q", "code", "n", "least", F.bit_count(F.col("q").bitwiseXOR(F.col("code"))).alias("distance"))
        every = (new if found is None else new.unionByName(found.df.join(open_.df, "q", "left_semi"))).distinct()
        step = Scratch(every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most).drop("rank"))
        reach = step.df.withColumn("sofar", F.sum("n").over(best)).filter(F.col("sofar") >= most).groupBy("q").agg(F.min("distance").alias("kth"))
        covered = segments * (radius + 1) - 1
        finished = Scratch(reach.filter(F.col("kth") <= covered).select("q"))
        done.append(step.df.join(finished.df, "q", "left_semi"))
        rest = Scratch(open_.df.join(finished.df, "q", "left_anti"))
        open_.drop()
        found, open_ = step, rest
        if open_.df.isEmpty():
            break
    done.append(found.df.join(open_.df, "q", "left_semi"))
    hits = done[0]
    for d in done[1:]:
        hits = hits.unionByName(d)
    pairs = asked.select(F.col("id").alias("query_id"), F.col("code").alias("q")).join(hits.select("q", "code", "distance"), "q").join(codes.df, "code")
    near = pairs.select("query_id", F.explode("ids").alias("neighbour_id"), "distance").filter("query_id <> neighbour_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "neighbour_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k)
