"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again for the next.

1. quality classifier: documents that it rejects go.
2. MinHash near-dedup: one document of each class stays, the one with the least doc_id.
3. benchmark decontamination: documents that leak an item go.
4. secret scans: secrets in texts become a mark; n_chars follows.
5. BPE encoding and decoding: ids of each text, and whether they decode to it exactly.

Every stage works on all rows its predecessor kept. The first three judge rows, not ids: a row is known by its
doc_id (null or not) and a hash of its text, language and source, so that rows with a null or a repeated doc_id are judged by their own
texts, and near-dedup keeps one of equal rows. Null texts, empty tables and further columns are as in the
operators' modules.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.llm import chunked_bpe, decontaminate, near_dup, quality, secrets
from vitrina.llm.tables import saved


def _key(docs: DataFrame) -> Column:
    """A row's doc_id as text that sorts as the number does (null last), with a hash of what it is judged by behind it."""
    i = docs["doc_id"].cast("long")
    number = F.when(i < 0, F.concat(F.lit("a"), F.lpad(i.bitwiseXOR(F.lit(-(2**63))).cast("string"), 19, "0"))).when(i >= 0, F.concat(F.lit("b"), F.lpad(i.cast("string"), 19, "0"))).otherwise("c")
    parts = [F.coalesce(F.md5(docs[c].cast("binary")), F.lit("none")) for c in ("text", "lang", "source")]
    return F.concat_ws(":", number, F.md5(F.concat(*parts).cast("binary")))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(_key(docs).alias("doc_id"), "text")


def _rows(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of docs whose key is (left_semi) or is not (left_anti) among the keys: key and row."""
    named = docs.select(_key(docs).alias("key"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return named.join(keys.select(F.col("doc_id").alias("key")).distinct(), "key", how)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality.quality(docs.select("doc_id", "text", "source", "lang", _key(docs).alias("key")), spark.read.parquet(f"{sf_dir}/labels.parquet"), keep=("key",))
    return _rows(docs, judged.filter("not kept").select(F.col("key").alias("doc_id")), "left_anti").select("row.*")


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    first = near_dup.near_duplicates(_keyed(docs)).filter("kept")
    return _rows(docs, first, "left_semi").dropDuplicates(["key"]).select("row.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    leaked = decontaminate.leaks(_keyed(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _rows(docs, leaked, "left_anti").select("row.*")


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs).withColumn("n_chars", F.length("text").cast("long"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chunked_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_stage),
    ("near_dup", near_dup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("bpe", bpe_stage),
]

#: SQL has neither the classifier nor the tokeniser; tests/llm/test_pipeline.py compares every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return saved(STAGES[-1][1](spark, docs, sf_dir))
