"""The queries of this package, over whole tables, with production parameters; and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.llm import chunked_bpe, decontaminate, near_dup, quality, repeats, secrets, topk, toxicity, unigram_trie, urls

#: The rules of op9 as (action, host, path).
URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
NEIGHBOURS = 10


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table, dealt anew if it lies in fewer partitions (of one row group, say) than there are cores."""
    rows, cores = _table(spark, sf_dir, "documents"), spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.select(F.spark_partition_id().alias("p")).distinct().count() < cores else rows


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram_trie.token_counts(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunked_bpe.digests(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_documents(spark, sf_dir))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = _table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), topk.sign_code("embedding").alias("code"))
    return topk.nearest_codes(codes, codes.filter("id % 100 = 0"), NEIGHBOURS)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))
    return found.withColumn("similarity", F.round("similarity", 6))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(_documents(spark, sf_dir))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_verdicts(_table(spark, sf_dir, "pages"), URL_RULES)


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_documents(spark, sf_dir)).drop("spans")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_token_counts, op2_bpe, op3_near_duplicates, op4_top_k, op5_toxicity, op6_decontamination, op7_quality, op8_secrets, op9_url_filters, op10_repeats)
    return {f.__name__: f for f in found}


_OP4 = f"""
WITH bits AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = 64 AND vec_id IS NOT NULL),
codes AS (SELECT DISTINCT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS code FROM bits),
pairs AS (
  SELECT q.vec_id AS query_id, v.vec_id AS neighbour_id, CAST(hamming(q.code, v.code) AS INTEGER) AS distance
  FROM codes q JOIN codes v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank FROM pairs)
SELECT query_id, neighbour_id, distance, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= {NEIGHBOURS}
"""

_OP6 = r"""
WITH RECURSIVE
d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x00-\x2f\x3a-\x60\x7b-\x7f]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x00-\x2f\x3a-\x60\x7b-\x7f]+'), lambda w: w <> '') AS w FROM benchmark),
ds AS (SELECT doc_id, list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) AS s FROM d WHERE len(w) >= 5),
bs AS (SELECT item_id, len(w) AS n_words, list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) AS s FROM b WHERE len(w) >= 5),
weights AS (SELECT shingle, 1 + ln((SELECT count(*) FROM bs)::DOUBLE / count(*)) AS weight FROM (SELECT item_id, unnest(list_distinct(s)) AS shingle FROM bs) GROUP BY shingle),
dp AS (SELECT doc_id, unnest(s) AS shingle, unnest(range(0, len(s))) AS pos FROM ds),
bp AS (SELECT item_id, n_words, unnest(s) AS shingle, unnest(range(0, len(s))) AS place FROM bs),
aligned AS (SELECT DISTINCT doc_id, n_words, greatest(pos - place, 0) AS a FROM dp JOIN bp USING (shingle)),
spans AS (SELECT *, lead(a) OVER (PARTITION BY doc_id, n_words ORDER BY a) AS b FROM aligned),
starts AS (SELECT DISTINCT doc_id, n_words, unnest(range(greatest(a - 2, 0), CASE WHEN b - a <= n_words THEN b ELSE a + 2 END + 1)) AS start FROM spans),
wins AS (
  SELECT doc_id, item_id, n_words, start, list_distinct(ds.s[start + 1:start + n_words - 4]) AS own, list_distinct(bs.s) AS its
  FROM starts JOIN ds USING (doc_id) JOIN bs USING (n_words)),
long AS (
  SELECT doc_id, item_id, n_words, start, unnest(list_distinct(list_concat(own, its))) AS shingle, own, its FROM wins WHERE len(own) > 0),
sims AS (
  SELECT doc_id, item_id, n_words, start,
    sum(CASE WHEN list_contains(its, shingle) AND list_contains(own, shingle) THEN weight ELSE 0 END)
    / sum(CASE WHEN list_contains(its, shingle) THEN weight ELSE 1 + ln((SELECT count(*) FROM bs)::DOUBLE) END) AS similarity
  FROM long LEFT JOIN weights USING (shingle) GROUP BY ALL)
SELECT doc_id, item_id, round(max(similarity), 6) AS similarity, CAST(arg_max(start, (similarity, -start)) AS INTEGER) AS start_word, CAST(max(n_words) AS INTEGER) AS n_words
FROM sims WHERE similarity >= 0.8 GROUP BY doc_id, item_id
"""

_OP9 = r"""
WITH RECURSIVE
p AS (SELECT page_id, url, html,
  translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
rules(action, h, pre) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
hits AS (SELECT page_id, url, p.host, p.path, h || pre AS rule, action FROM p LEFT JOIN rules ON (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, pre)),
ruled AS (SELECT page_id, url, any_value(host) AS host, any_value(path) AS path, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action FROM hits GROUP BY page_id, url),
normal AS (SELECT DISTINCT url, '//' || regexp_replace(host, '^www\.|:(80|443)$', '', 'g') || regexp_replace(path, '(/|/index\.html?|\.html?)$', '')
  || regexp_replace(regexp_replace(coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*(\?[^#]*)?', 1), ''), '(?i)([?&])((utm_[a-z]+|gclid|fbclid)=[^&]*&?)+', '\1', 'g'), '[?&]+$', '') AS form
  FROM p WHERE contains(url, '://')),
links AS (SELECT url, regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS target FROM p WHERE contains(coalesce(html, ''), 'canonical')),
edges AS (SELECT url AS a, form AS b FROM normal UNION SELECT form, url FROM normal UNION SELECT url, target FROM links WHERE target <> '' UNION SELECT target, url FROM links WHERE target <> ''),
reach(a, b) AS (SELECT DISTINCT url, url FROM ruled WHERE action IS NULL AND url IS NOT NULL UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
voted AS (SELECT r.a AS url, bool_or(x.action = 'allow') AS allowed FROM reach r JOIN ruled x ON x.url = r.b AND x.action IS NOT NULL GROUP BY r.a)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN allowed THEN 'allow' WHEN NOT allowed THEN 'block' END, 'allow') AS verdict,
  action IS NULL AND allowed IS NOT NULL AS by_alias
FROM ruled LEFT JOIN voted USING (url)
"""


def oracle_sql() -> dict[str, str]:
    """Those that SQL expresses on whole tables; the others are tested by brute force in tests/llm."""
    return {"op4_top_k": _OP4, "op6_decontamination": _OP6, "op9_url_filters": _OP9}
