"""The prototype's variants: its queries, tiered pools, metadata filter, shortlist and verdict order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrina.functions import rules

# Patterns of a presentation and of a box count.
PRESENTATION = r"(?i)(\d+(?:[.,]\d+)?)\s*(L|LT|LTS|ML|GAL)\b"
BOX = r"(?i)X\s*\d+\s*UN[DI]*"


def presentation(name: str) -> Column:
    return F.concat(F.regexp_extract(name, PRESENTATION, 1), F.upper(F.regexp_extract(name, PRESENTATION, 2)))


def without_box(name: str) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.col(name), BOX, ""), r"\s+", " "))


def fallback_query(ref: str, brand: str, name: str) -> Column:
    return F.concat(F.lit('"'), F.col(brand), F.lit('" '), F.col(name), F.lit(' product with reference "'), F.col(ref).cast("string"), F.lit('" white background'))


def tiered_pool(found: DataFrame, target: int = 20, key: str = "ref") -> DataFrame:
    """The first ``target`` links of tiers 0 and 1; tier 2 joins a pool of under half of that, then tier 3.

    ``found`` has tier and pos (the order in a tier) and url; empty urls go and the first of equal ones stays.
    """
    first = found.filter("url <> ''").withColumn("__n", F.row_number().over(Window.partitionBy(key, "url").orderBy("tier", "pos"))).filter("__n = 1").drop("__n")
    per = Window.partitionBy(key)
    strict, relaxed = F.sum((F.col("tier") <= 1).cast("int")).over(per), F.sum((F.col("tier") <= 2).cast("int")).over(per)
    need = F.when(strict >= target // 2, 1).when(relaxed >= target // 2, 2).otherwise(3)
    used = first.withColumn("__need", need).filter(F.col("tier") <= F.col("__need")).drop("__need")
    return used.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("tier", "pos", "url"))).filter(F.col("rank") <= target)


def metadata_reason(brand: str = "brand", min_side: int = 300, low: float = 0.6, high: float = 1.7) -> Column:
    """Why the prototype drops a candidate (width, height, domain, title, snippet, context); null if it stays."""
    size = F.concat(F.col("width").cast("string"), F.lit("x"), F.col("height").cast("string"))
    text = F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("title", "snippet", "context")]))
    name = F.lower(brand)
    rivals = F.filter(F.array(*map(F.lit, rules.PROTOTYPE_RIVALS)), lambda r: (r != name) & F.contains(text, r))
    bad = F.exists(F.array(*map(F.lit, rules.PROTOTYPE_BAD_DOMAINS)), lambda d: F.contains(F.col("domain"), d))
    return (
        F.when(F.least("width", "height") < min_side, F.concat(F.lit("low_res "), size))
        .when(~(F.col("width") / F.greatest("height", F.lit(1))).between(low, high), "bad_aspect_ratio")
        .when(bad, F.concat(F.lit("bad_domain "), "domain"))
        .when(~F.contains(text, name), "brand_not_in_text")
        .when(F.size(rivals) >= 2, F.concat(F.lit("multi_rival_brand "), F.array_join(rivals, ", ")))
    )


def shortlist(pool: DataFrame, k: int = 6, key: str = "ref") -> DataFrame:
    """The k whitest of a pool that ``candidates.dedupe_by_hash(order=struct(pos))`` thinned; images that failed go."""
    order = [F.desc("bg_white"), F.desc(F.col("width") * F.col("height")), F.col("pos")]
    return pool.filter("phash is not null").withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("rank") <= k)


def winners(judged: DataFrame, key: str = "ref") -> DataFrame:
    """winner (the first that is alive) and alternatives (second and third) of each ref's qualified images.

    ``judged`` has place, url, alive and the judge's criteria; without a qualified image both are empty.
    """
    fit = F.col("correct_brand") & F.col("correct_quantity") & F.col("not_packaging_only") & F.col("url").isNotNull()
    row = F.struct((~F.col("white_or_mono_bg")).alias("w"), (~F.col("new_condition")).alias("n"), (-F.col("score")).alias("s"), "place", "url", "alive")
    ranked = judged.groupBy(key).agg(F.array_sort(F.collect_list(F.when(F.coalesce(fit, F.lit(False)), row))).alias("r"))
    live = F.filter("r", lambda x: F.coalesce(x["alive"], F.lit(False)))
    return ranked.select(key, F.get(live, F.lit(0))["url"].alias("winner"), F.array_join(F.transform(F.slice("r", 2, 2), lambda x: x["url"]), ";").alias("alternatives"))
