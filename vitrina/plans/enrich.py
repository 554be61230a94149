"""The whole enrichment of a catalog: search, prefilter, selection, ladder, output and reports, over given services."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.functions import images, names, prompts, rules
from vitrina.operators import candidates, ladder, reports, selection
from vitrina.sources import cache, http, ledger, providers

#: A candidate's columns.
POOL = ("ref", "pos", "link", "title", "width", "height", "thumbnail_link", "display_link")


@dataclass
class Services:
    """What makes a client, once a partition, and answers a row with it; see ``providers.call``."""

    search: Callable[[], Any] = http.ImageSearch
    images: Callable[[], http.Images] = http.Images
    judge: Callable[[], Any] = http.Judge


@dataclass
class Enriched:
    pools: DataFrame
    audit: DataFrame
    selections: DataFrame
    attempts: DataFrame


class Enrichment:
    """Runs the stages for a normalised catalog (row_id, ref, marca, nombre_limpio, categoria, cse_profile, presentacion)."""

    def __init__(self, spark: SparkSession, cache_dir: str, services: Services, model: str = "gemini-2.5-flash", keep: int = rules.KEEP):
        self.spark, self.dir, self.services, self.model, self.keep = spark, cache_dir.rstrip("/"), services, model, keep

    def search(self, rows: DataFrame, cap: int | None) -> DataFrame:
        """Candidates of rows of row_id, ref, rung, query, cse_profile, marca; answers are kept by what they depend on."""
        asked = rows.withColumn("params", http.search_params(F.col("cse_profile"), F.col("marca"))).withColumn("key", names.cache_key("ref", F.col("rung"), "cse_profile"))
        client = self.services.search

        def call(t: DataFrame) -> DataFrame:
            got = cache.saved(providers.call(t, client, lambda c, row: c.fetch(row)))
            ledger.append_events(got.filter("ok").select(F.lit(reports.SEARCH).alias("kind"), "ref", "query", F.col("cse_profile").alias("profile"), F.lit(False).alias("geo"), "attempts"), f"{self.dir}/events")
            self._log_retries(got, "cse_retry")
            return got

        found = cache.read_through(asked, ["key"], f"{self.dir}/search", call, cap).filter("ok")
        return candidates.parse_candidates(found.select("ref", F.col("value").alias("response"))).select(*POOL)

    def _log_retries(self, got: DataFrame, kind: str) -> None:
        tries = got.filter((F.col("attempts") > 1) | ~F.col("ok")).select("ref", F.col("error"), F.explode(F.sequence(F.lit(1), F.greatest(F.col("attempts") - F.col("ok").cast("int"), F.lit(1)))).alias("attempt"))
        ledger.append_events(tries.select(F.lit(kind).alias("kind"), "ref", F.col("attempt").cast("int").alias("attempt"), F.coalesce("error", F.lit("retried")).alias("error")), f"{self.dir}/events")

    def score(self, pool: DataFrame) -> DataFrame:
        """The pool with bg_score and phash of its thumbnails."""
        seen = cache.saved(http.thumbnails(pool, client=self.services.images)).select(F.col("link").alias("__t"), images.image_scores("image").alias("s"))
        return pool.join(seen, F.col("thumbnail_link") == F.col("__t"), "left").withColumns({"bg_score": F.coalesce("s.bg_score", F.lit(0.0)), "phash": F.col("s.phash")}).drop("s", "__t")

    def measured(self, pool: DataFrame) -> DataFrame:
        """Sizes of the pictures behind links that a rewrite makes of low-resolution candidates."""
        low = pool.filter(candidates.drop_reason() == "resolucion_baja")
        tried = low.select(F.explode(F.array(names.upscale_marketplace("link"), names.upscale_uploads("link"))).alias("link")).filter("link is not null")
        seen = cache.saved(http.thumbnails(tried, "link", self.services.images))
        return seen.filter("image is not null").select("link", F.col("image.width").alias("width"), F.col("image.height").alias("height"))

    def prefilter(self, pool: DataFrame) -> DataFrame:
        """The audit of every row; a link is tested only until ``keep`` are reachable. Pools audited before are served from the cache."""
        pool, path = cache.saved(pool), f"{self.dir}/prefilter"
        row = F.struct("pos", "link", "thumbnail_link", "width", "height", "display_link", F.lit(self.keep))
        keys = cache.saved(pool.groupBy("ref").agg(F.sha2(F.to_json(F.array_sort(F.collect_list(row))), 256).alias("key")))
        held = cache.answers(self.spark, path)
        todo = keys if held is None else keys.join(held.select("ref", "key").distinct(), ["ref", "key"], "left_anti")
        fresh = cache.saved(pool.join(todo.select("ref"), "ref", "left_semi").select(*pool.columns))
        reach = lambda t: http.reached(t, self.keep, client=self.services.images)
        audit = candidates.prefilter_audit(fresh, self.measured(fresh), self.score, reach, self.keep)
        audit.join(keys, "ref").select(*audit.columns, "key").write.mode("append").parquet(path)
        return cache.saved(self.spark.read.parquet(path).join(keys, ["ref", "key"], "left_semi").select(*audit.columns))

    def judge(self, rows: DataFrame) -> DataFrame:
        """response and attempts of rows with images, which are sent with their prompt; what was judged before is served from the cache."""
        asked = rows.withColumn("prompt", prompts.judge_prompt(n=F.size("images"))).withColumn("__key", F.sha2(F.to_json(F.struct("ref", "prompt", F.transform("usable", lambda c: c["link"]).alias("links"), F.lit(self.model).alias("model"))), 256))
        client = self.services.judge
        used = "struct<text:string,prompt_tokens:int,output_tokens:int,thoughts_tokens:int,total_tokens:int>"

        def call(t: DataFrame) -> DataFrame:
            got = cache.saved(providers.call(t, client, lambda c, row: c.fetch(row)).withColumn("answer", F.from_json("value", used)))
            ledger.append_events(got.filter("ok").select(F.lit(reports.MODEL).alias("kind"), "ref", F.lit(self.model).alias("model"), "attempts", *[F.col(f"answer.{c}").alias(c) for c in ("prompt_tokens", "output_tokens", "thoughts_tokens", "total_tokens")]), f"{self.dir}/events")
            self._log_retries(got, "gemini_retry")
            return got.withColumn("value", F.when(F.col("ok"), F.to_json(F.struct(F.col("answer.text").alias("text"), "attempts"))))

        found = cache.read_through(asked, ["__key"], f"{self.dir}/select", call).withColumn("answer", F.from_json("value", "struct<text:string,attempts:int>"))
        return found.select(*[c for c in rows.columns if c not in ("response", "attempts")], F.when(F.col("ok"), F.col("answer.text")).alias("response"), F.col("answer.attempts").alias("attempts"))

    def select(self, catalog: DataFrame, kept: DataFrame, rung: int, cap: int | None) -> DataFrame:
        """A selection for each row; at most ``cap`` of those with candidates, in order, are judged."""
        asked = catalog
        if cap is not None:
            turn = catalog.join(kept.select("ref").distinct(), "ref", "left_semi").orderBy("row_id").limit(cap).select("ref", F.lit(True).alias("__turn"))
            asked = catalog.join(turn, "ref", "left").join(kept.select("ref", F.lit(True).alias("__has")).distinct(), "ref", "left").filter("__turn or __has is null").drop("__turn", "__has")
        links = kept.select("link").unionByName(kept.select(F.col("thumbnail_link").alias("link")))
        fetched = cache.saved(http.full_images(links, client=self.services.images))
        return cache.saved(selection.select_images(asked, kept, fetched, self.judge, rung))

    def run(self, catalog: DataFrame, rung: int = 1, max_queries: int | None = None, max_calls: int | None = None) -> Enriched:
        """Searches and judges every product, and climbs the ladder with those without a good image; each step has the caps."""
        n = catalog.count()
        queries, calls = (n if c is None else c for c in (max_queries, max_calls))
        rows = cache.saved(catalog.withColumn("rung", F.lit(rung)).withColumn("query", names.build_query(F.col("rung"), "ref", "marca", "nombre_limpio")))
        pools = cache.saved(self.search(rows, queries))
        audit = self.prefilter(pools)
        kept = audit.filter("status = 'kept'")
        first = self.select(rows, kept, rung, calls)
        audits, chosen = [audit], [first]

        def search(asked: DataFrame) -> DataFrame:
            return self.search(asked.join(rows.select("ref", "cse_profile", "marca"), "ref"), None)

        def judge(pool: DataFrame) -> DataFrame:
            step = pool.select("ref").distinct().join(rows.drop("query"), "ref").withColumn("query", F.lit(""))
            new = self.select(step, pool, 0, None)
            chosen.append(new)
            bad = selection.condemned(new, "candidatos_evaluados").groupBy("ref").agg(F.collect_set("link").alias("condemned"))
            return new.filter("pasadas_gemini = 1").select("ref", "flags").join(bad, "ref", "left").withColumn("condemned", F.coalesce("condemned", F.array().cast("array<string>")))

        def again(pool: DataFrame) -> DataFrame:
            done = self.prefilter(pool)
            audits.append(done)
            return done.filter("status = 'kept'")

        bad = selection.condemned(first, "candidatos_evaluados").groupBy("ref").agg(F.collect_set("link").alias("condemned"))
        state = first.join(bad, "ref", "left").select("ref", "flags", F.coalesce("condemned", F.array().cast("array<string>")).alias("condemned"), F.col("pasadas_gemini").alias("passes"), F.col("intento_cse").alias("rung"), F.col("query_cse").alias("query"))
        pools, state, attempts = ladder.escalate(rows, pools, cache.saved(state), search, judge, max_queries=queries, max_calls=calls, prefilter=again)
        last = self._last(chosen).drop("intento_cse", "query_cse", "pasadas_gemini")
        marks = state.select("ref", F.col("rung").alias("intento_cse"), F.col("query").alias("query_cse"), F.col("passes").alias("pasadas_gemini"))
        return Enriched(pools, self._last(audits), cache.saved(last.join(marks, "ref")), attempts)

    def _last(self, steps: list[DataFrame]) -> DataFrame:
        """Of each ref the rows of the last step that has any."""
        out = steps[0]
        for step in steps[1:]:
            out = out.join(step.select("ref").distinct(), "ref", "left_anti").select(*out.columns).unionByName(step.select(*out.columns))
        return out


def summary(spark: SparkSession, catalog: DataFrame, done: Enriched, cache_dir: str) -> str:
    """What the run came to, as text."""
    found = reports.funnel(catalog.select("ref"), done.pools, done.audit.filter("status = 'kept'"), done.selections)
    total = reports.funnel_summary(found).first().asDict()
    costs = reports.cost_report(ledger.read_ledger(spark, f"{cache_dir}/events"))
    lines = [f"{k}: {v}" for k, v in total.items()] + [f"{r.what} {r.value}: {r.n}" for r in reports.funnel_counts(found).collect()]
    lines += [json.dumps(r.asDict()) for r in costs.collect()] + [f"total USD {reports.cost_total(costs).first().total_usd:.4f}"]
    return "\n".join(lines)
