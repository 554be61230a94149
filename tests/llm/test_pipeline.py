"""The pipeline at the edges, and each stage against a plain version on what the stage before it kept."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vitrina.llm import decontaminate, near_dup, quality, secrets

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What goes into each stage and comes out of it: documents, some of them odd, and one column more."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.orderBy("doc_id").first()
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    odd = [(None, first.text, first.lang, first.source, 1), (None, first.text, first.lang, first.source, 1), (None, None, None, None, None), (10**6, "", None, "x", 0), (-5, first.text + " more", first.lang, first.source, 1), (first.doc_id, "another text under a known id with enough words to stand alone", "en", "x", 1), (None, f"so it goes {item} and on it goes", "en", "src1", 1), (10**6 + 1, "password = abcdefgh1234 " + "plain words " * 3, "en", "src1", 1)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("base", F.lit("b")).withColumn("key", F.lit(1))
    out, path = [docs], tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SF).write.parquet(f"{path}/{name}")
        out.append(spark.read.parquet(f"{path}/{name}"))
    return out


def test_stages_return_the_columns_of_documents(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_quality_stage(spark, stages):
    docs = stages[0]
    judged = {(r.doc_id, r.x): r.kept for r in quality.quality(docs.withColumn("x", F.md5(F.coalesce("text", F.lit("none")))), spark.read.parquet(f"{SF}/labels.parquet"), keep=("x",)).collect()}
    want = [r for r in docs.withColumn("x", F.md5(F.coalesce("text", F.lit("none")))).collect() if judged[r.doc_id, r.x]]
    assert sorted((r.doc_id or 0, r.text or "") for r in want) == sorted((r.doc_id or 0, r.text or "") for r in stages[1].collect())


def test_near_dup_stage_keeps_one_of_each_class(stages):
    before, after = stages[1].collect(), stages[2].collect()
    words = lambda t: " ".join(re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").lower()))
    kept = [words(r.text) for r in after if words(r.text)]
    assert len(kept) == len(set(kept))
    left = {words(r.text) for r in before} - set(kept) - {""}
    sets = {w: {tuple(w.split()[k : k + 5]) for k in range(max(1, len(w.split()) - 4))} for w in left | set(kept)}
    for w in left:  # what is gone has a near copy, perhaps over another that is gone
        assert any(len(sets[w] & sets[x]) / len(sets[w] | sets[x]) > 0.6 for x in sets if x != w)
    ids = {}
    for r in before:
        ids.setdefault(words(r.text), []).append(r.doc_id if r.doc_id is not None else 2**62)
    assert all((r.doc_id if r.doc_id is not None else 2**62) == min(ids[words(r.text)]) or min(ids[words(r.text)]) < 0 or words(r.text) == "" for r in after)


def test_decontamination_stage(spark, stages):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    numbered = stages[2].withColumn("doc_id", F.monotonically_increasing_id()).collect()
    again = spark.createDataFrame([(i, r.text) for i, r in enumerate(numbered)], "doc_id long, text string")
    bad = {r.doc_id for r in decontaminate.leaks(again, bench).collect()}
    assert bad and sorted(r.text or "" for i, r in enumerate(numbered) if i not in bad) == sorted(r.text or "" for r in stages[3].collect())


def test_secrets_stage(spark, stages):
    before, after = stages[3].collect(), stages[4].collect()
    odd = [(1, "password = abcdefgh1234 and more", "en", "x", 1, "b", 1), (1, None, None, None, None, None, None)]
    assert [(r.text, r.n_chars, r.base) for r in corpus_pipeline.secrets_stage(spark, spark.createDataFrame(odd, stages[3].schema), SF).collect()] == [("[secret] and more", 17, "b"), (None, None, None)]
    assert len(before) == len(after) and all(r.n_chars == (None if r.text is None else len(r.text)) for r in after)
    pattern = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    assert not [r for r in after for m in pattern.finditer(r.text or "") if len(m[2]) >= 8]


def test_bpe_stage(stages):
    after = stages[5].collect()
    assert len(after) == stages[4].count() and all(r.exact and r.n_tokens == len(r.ids) for r in after)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "n_tokens", "ids", "exact"} <= set(out.columns) and 0 < out.count() < spark.read.parquet(f"{SF}/documents.parquet").count()


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
    assert near_dup and secrets
