"""Quality by hierarchical empirical Bayes.

A document's own evidence, a logistic regression on the shape of its text, is combined with what is known
of its site: the share of good labelled documents on its host, shrunk toward the global share, and on its
path within the host, shrunk toward the host's. How strongly sparse sites shrink is estimated from how far
sites differ beyond chance (method of moments on grouped counts). In log-odds the site moves the
document's evidence by its posterior's distance from the global prior.

Scale: one pass over the texts leaves a few numbers a document; labels and sites are joined to those, never
to texts. Site statistics are aggregates combined before the shuffle; documents meet them by salted keys,
so a site with a third of all documents is spread over many tasks. The regression is fitted on at most
``sample`` labelled rows.

Edge cases: null or empty texts have no evidence of their own but the regression's for empty texts; very long
texts are whole; null host or path is a site of its own; without labels of both kinds every document gets the
(smoothed) prior; repeated labels of a doc_id count as good if any is; repeated rows of documents give a row
each, and equal scores are no tie to break; further columns are kept out of the result unless named; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.llm import arrays as A
from vitrina.llm.tables import saved
from vitrina.llm.toxicity import logistic

FEATURES = ("log_words", "mean_word", "upper", "digits", "symbols", "spaces", "distinct_words", "repeated_next", "longest_run", "line_ends")
SALTS = 16
_KIND = np.zeros(256, np.int8)  # 1 lower case or other letters, 2 upper case, 3 digit, 4 white space, 5 closing marks, 6 symbol
_KIND[:] = 6
_KIND[[*range(97, 123), *range(128, 256)]] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[[9, 10, 11, 12, 13, 32]] = 4
_KIND[[33, 39, 44, 45, 46, 58, 59, 63]] = 5
_KIND[33] = 6


def shape(column: pa.Array) -> np.ndarray:
    """The FEATURES of each text; an empty text has zeros."""
    data, offsets = A.text_bytes(column)
    n, size = len(column), np.maximum(np.diff(offsets), 1)
    out = np.zeros((n, len(FEATURES)))
    if not len(data):
        return out
    kinds = _KIND[data]

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(flags, dtype=np.int64)]
        return total[offsets[1:]] - total[offsets[:-1]]

    letters = np.maximum(per_text((kinds == 1) | (kinds == 2)), 1)
    lowered, low_offsets = A.text_bytes(column, lower=True)
    starts, ends, at = A.words(lowered, low_offsets)
    hashes = A.span_hash(A.prefix_hash(lowered), starts, ends)
    words = np.diff(at)
    doc = np.repeat(np.arange(n), words)
    both = np.unique((doc.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20)))
    distinct = np.bincount((both >> np.uint64(44)).astype(np.int64), minlength=n)
    again = np.bincount(doc[1:][(hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])], minlength=n)
    change = np.r_[True, (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])] if len(hashes) else np.zeros(0, bool)
    runs = np.flatnonzero(change)
    longest = np.zeros(n)
    np.maximum.at(longest, doc[runs], np.diff(np.r_[runs, len(hashes)]))
    some = np.maximum(words, 1)
    out[:] = np.c_[
        np.log1p(words), np.bincount(doc, ends - starts, n) / some, per_text(kinds == 2) / letters, per_text(kinds == 3) / size, per_text(kinds == 6) / size,
        per_text(kinds == 4) / size, distinct / some, again / some, np.log1p(longest) / np.log1p(some + 1), per_text(data == 10) / size,
    ]
    return out


def text_shapes(docs: DataFrame, *keep: str) -> DataFrame:
    """The named columns and an array of the FEATURES of each text."""
    rows = docs.select(*keep, F.coalesce("text", F.lit("")).alias("text"))
    names = [f.name for f in rows.schema if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.slices(batches, limit=1 << 20):
            x = shape(batch.column("text"))
            ends = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], names=[*names, "x"])

    schema = rows.drop("text").schema.add("x", T.ArrayType(T.DoubleType()))
    return rows.mapInArrow(run, schema)


def strength(groups: DataFrame, prior: float, n: str = "n", good: str = "good", mean: str | None = None) -> float:
    """Pseudo-counts of the prior by which groups shrink: large if groups differ no more than chance would."""
    around = F.col(mean) if mean else F.lit(prior)
    chance, spread, total, squares = groups.agg(
        F.sum(around * (1 - around)), F.sum(F.col(n) * F.pow(F.col(good) / F.col(n) - around, 2)), F.sum(n), F.sum(F.col(n) * around * (1 - around))
    ).first()
    if not total or not squares:
        return 1.0
    within = squares / total
    excess = (spread - chance) / total
    return float(np.clip(within / excess - 1, 1.0, 1e4)) if excess > 0 else 1e4


def quality(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", threshold: float = 0.5, sample: int = 20_000, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns to keep, evidence, host_share, path_share, score (posterior that the document is good) and kept.

    ``host`` and ``path`` name the columns of documents that tell the site and the section of it.
    """
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max((F.col("quality") > 0).cast("int")).alias("y"))
    sites = (F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"))
    own = [F.struct(*keep).alias("own")] if keep else []
    shaped = saved(text_shapes(docs, "doc_id", *sites, *own))
    seen = saved(shaped.join(known, "doc_id"))
    picked = seen.select("x", "y", "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).toPandas()
    total, good = seen.agg(F.count("*"), F.sum("y")).first()
    prior = ((good or 0) + 1) / (total + 2)
    base = float(np.log(prior / (1 - prior)))
    evidence = F.lit(base)
    if picked["y"].nunique() == 2:
        x = np.stack(picked["x"].to_numpy())
        middle, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
        w = logistic((x - middle) / scale, picked["y"].to_numpy(), ridge=1.0)
        slope = w[:-1] / scale
        evidence = F.aggregate(F.zip_with("x", F.array(*map(F.lit, slope.tolist())), lambda a, b: a * b), F.lit(float(w[-1] - middle @ slope)), lambda a, b: a + b)
    by_path = seen.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("y").alias("good"))
    by_path = saved(by_path)
    by_host = by_path.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    k_host = strength(by_host, prior)
    hosts = by_host.select("host", ((F.col("good") + k_host * prior) / (F.col("n") + k_host)).alias("host_share"))
    nested = saved(by_path.join(hosts, "host"))
    k_path = strength(nested, prior, mean="host_share")
    paths = nested.select("host", "path", ((F.col("good") + k_path * F.col("host_share")) / (F.col("n") + k_path)).alias("path_share"))

    def salted(t: DataFrame) -> DataFrame:
        return t.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    out = shaped.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    out = out.join(salted(hosts), ["host", "salt"], "left").join(salted(paths), ["host", "path", "salt"], "left")
    host_share = F.coalesce("host_share", F.lit(prior))
    path_share = F.coalesce("path_share", host_share)
    score = 1 / (1 + F.exp(-(F.col("evidence") + F.log(path_share / (1 - path_share)) - base)))
    return out.withColumn("evidence", evidence).select("doc_id", *[F.col(f"own.`{c}`").alias(c) for c in keep], "evidence", host_share.alias("host_share"), path_share.alias("path_share"), score.alias("score"), (score >= threshold).alias("kept"))
