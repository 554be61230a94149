"""Verdicts of the image judge: picks, condemned links, flags, and who needs another try."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EVALUATIONS = "array<struct<imagen:int,producto_correcto:boolean,unidades_visibles:int,marca:string,evidencia_marca:string,scores:struct<resolucion:int,fondo:int,estado:int,empaque:int,limpieza:int>,descartada:boolean,razon:string>>"
VERDICT = f"struct<evaluaciones:{EVALUATIONS},seleccion:int,ranking:array<int>,confianza:string,comentario:string>"


def parse_verdict(json: str | Column) -> Column:
    """A malformed verdict is null, not an error."""
    return F.from_json(json, VERDICT)


def resolve_pick(pick: Column, n: Column, ranking: Column) -> Column:
    """The pick if there is such an image; else, if one was given, the first in the ranking that there is."""
    good = F.filter(ranking, lambda r: (r >= 1) & (r <= n))
    return F.when((pick >= 1) & (pick <= n), pick).when(pick.isNotNull(), F.get(good, F.lit(0)))


def _resolved(candidates: Column, number: Column) -> Column:
    """The candidate with that number, from 1; null if there is none."""
    return F.when(number >= 1, F.get(candidates, number - 1))


def resolve_verdicts(judged: DataFrame, verdict: str = "verdict", candidates: str = "usable", by_thumbnail: str | None = "via_thumb") -> DataFrame:
    """The columns of ``judged`` and what the verdict on its candidates (an array of structs with link) means.

    ``n_evaluadas``, ``evaluaciones``, ``confianza`` (baja if none is given), ``comentario``,
    ``seleccion_imagen`` and ``seleccion`` (the pick and its candidate), ``ranking_imagenes`` and
    ``ranking_candidatos`` (without numbers that no image has), ``candidatos_evaluados`` (links), ``flags``.
    A null verdict stands for an empty pool: nothing picked, low confidence. ``by_thumbnail`` names an array
    of booleans, parallel to the candidates: whether an image was judged by its thumbnail.
    """
    v, usable = F.col(verdict), F.col(candidates)
    count = F.coalesce(F.size(usable), F.lit(0))
    ranking = F.coalesce(v["ranking"], F.array().cast("array<int>"))
    pick = resolve_pick(v["seleccion"], count, ranking)
    rows = judged.withColumns(
        {
            "n_evaluadas": F.when(v.isNull(), 0).otherwise(count),
            "evaluaciones": F.coalesce(v["evaluaciones"], F.from_json(F.lit("[]"), EVALUATIONS)),
            "confianza": F.coalesce(v["confianza"], F.lit("baja")),
            "comentario": F.coalesce(v["comentario"], F.lit("")),
            "seleccion_imagen": pick,
            "seleccion": _resolved(usable, pick),
            "ranking_imagenes": ranking,
            "ranking_candidatos": F.transform(F.filter(ranking, lambda n: (n >= 1) & (n <= count)), lambda n: _resolved(usable, n)),
            "candidatos_evaluados": F.when(v.isNull(), F.array().cast("array<string>")).otherwise(F.transform(usable, lambda c: c["link"])),
        }
    )
    none, low = F.col("seleccion").isNull(), F.col("confianza") == "baja"
    its = F.filter("evaluaciones", lambda e: e["imagen"] == F.col("seleccion_imagen"))
    unsure = F.coalesce(F.try_element_at(its, F.lit(-1))["marca"] == "no_verificable", F.lit(False)) & ~none  # the last of repeated evaluations counts
    small = F.coalesce(F.get(F.col(by_thumbnail), F.col("seleccion_imagen") - 1), F.lit(False)) & ~none if by_thumbnail else F.lit(False)
    told = ((none, "sin_imagen"), (none | low, "necesita_fallback"), (unsure, "revisar_marca"), (small, "descarga_thumbnail"))
    return rows.withColumn("flags", F.array_compact(F.array(*[F.when(when, flag) for when, flag in told])))


def usable_images(kept: DataFrame, fetched: DataFrame, key: str = "ref") -> DataFrame:
    """One row a ref with its candidates that have an image, in order of rank: usable, images, via_thumb.

    ``fetched`` has link and image (bytes; null where the fetch failed) of full images and thumbnails alike. A
    candidate without either is left out, so images are numbered by what can be shown, not by rank.
    """
    full = fetched.select(F.col("link").alias("__f"), F.col("image").alias("__full"))
    thumb = fetched.select(F.col("link").alias("__t"), F.col("image").alias("__thumb"))
    both = kept.join(full, F.col("link") == F.col("__f"), "left").join(thumb, F.col("thumbnail_link") == F.col("__t"), "left")
    fields = [c for c in kept.columns if c != key]
    row = F.struct("rank", F.struct(*fields).alias("c"), F.coalesce("__full", "__thumb").alias("image"), F.col("__full").isNull().alias("small"))
    lists = both.filter(F.coalesce("__full", "__thumb").isNotNull()).groupBy(key).agg(F.array_sort(F.collect_list(row), lambda x, y: x["rank"] - y["rank"]).alias("r"))
    part = lambda name: F.transform("r", lambda x: x[name])
    return lists.select(key, part("c").alias("usable"), part("image").alias("images"), part("small").alias("via_thumb"))


def select_images(rows: DataFrame, kept: DataFrame, fetched: DataFrame, judge: Callable[[DataFrame], DataFrame], rung: int = 1, query: str = "query", key: str = "ref") -> DataFrame:
    """A selection for every row: the judge's verdict resolved, or an empty one where there is no image to show.

    ``judge`` is given rows with images and adds ``response`` (JSON) and ``attempts``; a product whose judge
    failed (null response) gets no row, so that it is tried again. ``pasadas_gemini`` is 1 where a judge was asked.
    """
    held = usable_images(kept, fetched, key)
    pooled = kept.select(key).distinct().withColumn("__pool", F.lit(True))
    every = rows.join(held, key, "left").join(pooled, key, "left")
    shown = judge(every.filter("usable is not null")).withColumn("verdict", parse_verdict("response")).filter("verdict is not null")
    why = F.when(F.col("__pool").isNull(), "pool vacio tras el pre-filtro").otherwise("ninguna imagen del pool se pudo descargar")
    empty = every.filter("usable is null").withColumns({"response": F.lit(None).cast("string"), "attempts": F.lit(None).cast("int"), "verdict": parse_verdict(F.lit(None).cast("string")), "__why": why})
    both = shown.withColumn("__why", F.lit(None).cast("string")).unionByName(empty, allowMissingColumns=True)
    out = resolve_verdicts(both).withColumn("comentario", F.coalesce("__why", "comentario"))
    marks = {"intento_cse": F.lit(rung), "query_cse": F.col(query), "intentos": F.col("attempts"), "pasadas_gemini": F.col("response").isNotNull().cast("int")}
    return out.withColumns(marks).drop("images", "verdict", "response", "attempts", "__pool", "__why")


def condemned(verdicts: DataFrame, links: str = "links", evaluations: str = "evaluaciones") -> DataFrame:
    """ref and link of images found to show another product or brand."""
    each = verdicts.select("ref", links, F.explode(evaluations).alias("e"))
    bad = (~F.coalesce("e.producto_correcto", F.lit(True))) | (F.coalesce("e.marca", F.lit("")) == "incorrecta")
    return each.filter(bad & (F.col("e.imagen") >= 1) & (F.col("e.imagen") <= F.size(links))).select("ref", F.get(links, F.col("e.imagen") - 1).alias("link")).distinct()


def needs_fallback(flags: str | Column) -> Column:
    f = F.col(flags) if isinstance(flags, str) else flags
    return f.isNull() | F.arrays_overlap(f, F.array(F.lit("sin_imagen"), F.lit("necesita_fallback")))


def budget_cap(rows: DataFrame, cap: int, miss: str = "miss", order: str = "row_id", range_rows: int = 500_000) -> DataFrame:
    """Rows served: cached ones, and misses in order until ``cap`` of them.

    The running count is by ranges of the order, of about ``range_rows`` rows where the order is dense, so that no
    task sorts all rows; what stands before each range is a table of one row a range.
    """
    n = F.col(miss).cast("int")
    low, high, count = rows.agg(F.min(order), F.max(order), F.count("*")).first()
    ranges = max(64, count // range_rows)
    width = max(1, ((high or 0) - (low or 0)) // ranges + 1)
    parted = rows.withColumn("__b", F.floor((F.col(order) - (low or 0)) / width))
    sums = parted.groupBy("__b").agg(F.sum(n).alias("__n"))
    before = sums.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    running = F.sum(n).over(Window.partitionBy("__b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return parted.join(before, "__b").withColumn("used", F.col("__before") + running).filter((n == 0) | (F.col("used") <= cap)).drop("__b", "__before")
