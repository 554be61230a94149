"""Candidate images: parsing, ordered dedup, filters, ranking. A pool is rows of one ``ref`` in order of ``pos``.

The greedy folds walk the rows of a pool in order and hold what is kept of it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from itertools import pairwise
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.functions import names, rules
from vitrina.sources.cache import saved

ITEM = "struct<link:string,title:string,displayLink:string,image:struct<width:int,height:int,thumbnailLink:string>>"


def parse_candidates(responses: DataFrame, json: str = "response") -> DataFrame:
    """One row for each item of a raw search response, with its place; missing fields are empty or null."""
    items = F.coalesce(F.from_json(json, f"struct<items:array<{ITEM}>>")["items"], F.array().cast(f"array<{ITEM}>"))
    flat = responses.select(*[c for c in responses.columns if c != json], F.posexplode(items).alias("pos", "i"))
    text = lambda c: F.coalesce(c, F.lit(""))
    return flat.select(*[c for c in flat.columns if c != "i"], text(F.col("i.link")).alias("link"), text(F.col("i.title")).alias("title"), F.col("i.image.width").alias("width"), F.col("i.image.height").alias("height"), text(F.col("i.image.thumbnailLink")).alias("thumbnail_link"), text(F.col("i.displayLink")).alias("display_link"))


def _several(pools, values):
    """Of rows sorted by pool, which stand in a pool that has one of these values (of numbers from 0; -1 for none) twice."""
    import numpy as np

    has = values >= 0
    pairs, n = np.unique(pools[has] * (values.max(initial=0) + 1) + values[has], return_counts=True)
    several = np.zeros(pools[-1] + 1, bool)
    several[pairs[n > 1] // (values.max(initial=0) + 1)] = True
    return several[pools]


def _numbers(column, but: str | None = None):
    """A number for each different value of an Arrow column, -1 for null and for ``but``."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    if pa.types.is_null(column.type):
        return np.full(len(column), -1)
    coded = column.dictionary_encode()
    at = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    return at if but is None else np.where(pc.equal(column, but).fill_null(True).to_numpy(zero_copy_only=False), -1, at)


def _links_meet(pools, link, thumb):
    return _several(pools, _numbers(link)) | _several(pools, _numbers(thumb, ""))


def _hashes_meet(pools, hashes):
    import numpy as np

    return _several(pools, np.where(hashes.is_null().to_numpy(zero_copy_only=False), -1, 0))


def _fold(pool: DataFrame, order: Column, needs: tuple[str, ...], judge: Callable[[], Callable[..., bool]], meet: Callable[..., Any], key: str, dealt: bool = False) -> DataFrame:
    """The pool with ``repeat``: what a new ``judge`` of each pool says of its rows' ``needs``, in order.

    Rows pass in the order of a sort, so no pool is gathered: a worker holds what the judge keeps of one. Rows that are
    ``dealt`` come from a fold by narrow steps only, so that each pool is in one partition already. Of pools that lie
    whole within a batch of rows, the judge walks only those in which rows ``meet``; no other can have a repeat.
    """
    schema = T.StructType([*pool.schema.fields, T.StructField("repeat", T.BooleanType())])
    names_ = pool.columns
    plain = isinstance(pool.schema[key].dataType, T.StringType | T.IntegralType)

    def walk(batches):
        import numpy as np
        import pyarrow as pa

        now, says = object(), None
        for batch in batches:
            n = batch.num_rows
            told, at = np.zeros(n, bool), np.arange(n)
            if plain and n:
                keys = _numbers(batch.column(key))
                pools = np.concatenate([[0], np.cumsum(keys[1:] != keys[:-1])])
                # The last pool may go on in the next batch, the first may have begun in the one before.
                at = np.flatnonzero(meet(pools, *(batch.column(c) for c in needs)) | (pools == pools[-1]) | (pools == 0))
            some = pa.array(at)
            for i, k, *row in zip(at.tolist(), *(batch.column(c).take(some).to_pylist() for c in (key, *needs)), strict=True):
                if k != now:
                    now, says = k, judge()
                told[i] = says(*row)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names_), pa.array(told)], [*names_, "repeat"])

    rows = pool.withColumn("__o", order)
    return (rows if dealt else rows.repartition(key)).sortWithinPartitions(key, "__o", *names_).drop("__o").mapInArrow(walk, schema)


def _link_judge() -> Callable[[str | None, str | None], bool]:
    links, thumbs = set(), set()

    def repeats(link: str | None, thumb: str | None) -> bool:
        if link in links or thumb in thumbs:
            return True
        if link is not None:
            links.add(link)
        if thumb:
            thumbs.add(thumb)
        return False

    return repeats


def _hash_judge(distance: int) -> Callable[[int | None], bool]:
    """Two hashes of at most so many different bits agree in one of one more pieces; a hash is compared with those only."""
    seen, near, ends = set(), {}, [64 * i // (distance + 1) for i in range(distance + 2)]

    def repeats(h: int | None) -> bool:
        if h is None:
            return False
        if h in seen:  # as the first of its hash, which was kept or is like a kept one
            return True
        seen.add(h)
        h &= 2**64 - 1
        pieces = [(i, h >> low & (1 << high - low) - 1) for i, (low, high) in enumerate(pairwise(ends))]
        if any((h ^ k).bit_count() <= distance for p in pieces for k in near.get(p, ())):
            return True
        for p in pieces:
            near.setdefault(p, []).append(h)
        return False

    return repeats


def url_repeats(pool: DataFrame, key: str = "ref", pos: str = "pos") -> DataFrame:
    """``repeat``, greedily: same link as a kept row, or the same thumbnail unless it is empty. Links may be empty."""
    return _fold(pool, F.col(pos), ("link", "thumbnail_link"), _link_judge, _links_meet, key)


def visual_repeats(pool: DataFrame, key: str = "ref", order: Column | None = None, distance: int = rules.HASH_DISTANCE, dealt: bool = False) -> DataFrame:
    """``repeat``, greedily, larger areas first: Hamming distance of ``phash`` to a kept row; a null hash never repeats."""
    order = order if order is not None else F.struct((-F.col("width") * F.col("height")).alias("a"), F.col("pos"))
    return _fold(pool, order, ("phash",), partial(_hash_judge, distance), _hashes_meet, key, dealt)


def dedupe_by_url(pool: DataFrame, key: str = "ref", pos: str = "pos") -> DataFrame:
    return url_repeats(pool, key, pos).filter("not repeat").drop("repeat")


def dedupe_by_hash(pool: DataFrame, key: str = "ref", order: Column | None = None, distance: int = rules.HASH_DISTANCE) -> DataFrame:
    return visual_repeats(pool, key, order, distance).filter("not repeat").drop("repeat")


def blocked(domain: str | Column, domains: tuple[str, ...] = rules.BLOCKED_DOMAINS) -> Column:
    d = F.lower(F.col(domain) if isinstance(domain, str) else domain)
    return F.coalesce(F.exists(F.array(*map(F.lit, domains)), lambda b: F.contains(d, b)), F.lit(False)) if domains else F.lit(False)


def drop_reason(min_side: int = rules.MIN_SIDE, max_ratio: float = rules.MAX_RATIO) -> Column:
    """Why a candidate goes, the first that holds; null if it stays."""
    w, h = F.coalesce("width", F.lit(0)), F.coalesce("height", F.lit(0))
    link = F.coalesce("link", F.lit(""))
    return (
        F.when(~(link.startswith("http://") | link.startswith("https://")), "url_invalido")
        .when(F.least(w, h) < min_side, "resolucion_baja")
        .when(F.greatest(w, h) / F.greatest(F.least(w, h), F.lit(1)) > max_ratio, "aspect_ratio_extremo")
        .when(blocked("display_link"), "dominio_bloqueado")
    )


def reason_detail(reason: str | Column) -> Column:
    """The reason with what it is about: 40 characters of the link, the size, or the domain."""
    r = F.col(reason) if isinstance(reason, str) else reason
    size = F.concat(F.coalesce("width", F.lit(0)).cast("string"), F.lit("x"), F.coalesce("height", F.lit(0)).cast("string"))
    about = F.when(r == "url_invalido", F.substring(F.coalesce("link", F.lit("")), 1, 40)).when(r.isin("resolucion_baja", "aspect_ratio_extremo"), size).when(r == "dominio_bloqueado", F.coalesce("display_link", F.lit("")))
    return F.concat_ws(" ", r, about)


def recover_resolution(pool: DataFrame, measured: DataFrame, min_side: int = rules.MIN_SIDE, max_ratio: float = rules.MAX_RATIO) -> DataFrame:
    """Low-resolution rows take the first rewritten link that ``measured`` (link, width, height) shows to pass; ``recovered`` marks them."""
    big = measured.filter((F.least("width", "height") >= min_side) & (F.greatest("width", "height") / F.greatest(F.least("width", "height"), F.lit(1)) <= max_ratio))
    big = big.groupBy("link").agg(F.max_by(F.struct("width", "height"), F.struct(F.col("width") * F.col("height"), "width")).alias("size"))
    one, two = (big.select(F.col("link").alias(f"l{i}"), F.col("size").alias(f"s{i}")) for i in (1, 2))
    low = drop_reason(min_side, max_ratio) == "resolucion_baja"
    tried = pool.join(one, F.col("l1") == names.upscale_marketplace("link"), "left").join(two, F.col("l2") == names.upscale_uploads("link"), "left")
    tried = tried.withColumn("recovered", F.coalesce(low & F.coalesce("l1", "l2").isNotNull(), F.lit(False)))
    size = F.coalesce("s1", "s2")
    new = {"link": F.coalesce("l1", "l2"), "width": size["width"], "height": size["height"]}
    return tried.withColumns({c: F.when(F.col("recovered"), x).otherwise(F.col(c)) for c, x in new.items()}).drop("l1", "l2", "s1", "s2")


def hard_filters(pool: DataFrame, measured: DataFrame | None = None, min_side: int = rules.MIN_SIDE, max_ratio: float = rules.MAX_RATIO) -> DataFrame:
    """The pool with ``recovered`` and ``reason``; a recovered row stays whatever its domain."""
    rows = recover_resolution(pool, measured, min_side, max_ratio) if measured is not None else pool.withColumn("recovered", F.lit(False))
    return rows.withColumn("reason", F.when(~F.col("recovered"), drop_reason(min_side, max_ratio)))


def rank_topk(pool: DataFrame, k: int = rules.KEEP, key: str = "ref", priority: tuple[str, ...] = rules.PRIORITY_DOMAINS) -> DataFrame:
    """The k best: priority domains, then score, then area, then place."""
    order = [F.desc("__p"), F.desc("bg_score"), F.desc(F.col("width") * F.col("height")), F.col("pos")]
    ranked = pool.withColumn("__p", blocked("display_link", priority)).withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.filter(F.col("rank") <= k).drop("__p")


def merge_pools(base: DataFrame, extra: DataFrame, key: str = "ref") -> DataFrame:
    """base, then what extra has that base lacks; repeats inside extra stay."""
    new = extra.join(base.select(key, "link").distinct(), [key, "link"], "left_anti").select(*base.columns)
    last = base.groupBy(key).agg((F.max("pos") + 1).alias("__n"))
    return base.unionByName(new.join(last, key, "left").withColumn("pos", F.col("pos") + F.coalesce("__n", F.lit(0))).drop("__n"))


def exclude(pool: DataFrame, condemned: DataFrame, key: str = "ref") -> DataFrame:
    return pool.join(condemned.select(key, "link").distinct(), [key, "link"], "left_anti").select(*pool.columns)


def public(pool: DataFrame) -> DataFrame:
    """The pool without what only the prefilter needs: the hash and columns whose names begin with an underscore."""
    return pool.select(*[c for c in pool.columns if not c.startswith("_") and c != "phash"])


def prefilter(pool: DataFrame, k: int = rules.KEEP) -> DataFrame:
    """The k best kept rows of each pool that is scored already, where every link is reachable."""
    linked = url_repeats(pool)
    hard = hard_filters(linked.filter("not repeat").drop("repeat")).filter("reason is null").drop("recovered", "reason")
    return rank_topk(visual_repeats(hard, dealt=True).filter("not repeat").drop("repeat"), k)


def prefilter_audit(pool: DataFrame, measured: DataFrame | None = None, score: Callable[[DataFrame], DataFrame] | None = None, reach: Callable[[DataFrame], DataFrame] | None = None, k: int = rules.KEEP, key: str = "ref", hold: Callable[[DataFrame], DataFrame] = saved) -> DataFrame:
    """Every row of the pools with n_input (its pool's size), status, reason and rank.

    Cheap tests come first: repeated links, metadata (with recovery of small images), then thumbnails
    (``score`` adds bg_score and phash, and is given only rows that passed), looks, rank, and reachability:
    ``reach`` adds ``alive`` to ranked rows. Status is kept (the k first alive), dropped (with a reason),
    unreachable (before the k-th) or trimmed (behind it). ``hold`` keeps what several of these are taken from, so
    that each test is made once.
    """
    sized = pool.join(pool.groupBy(key).agg(F.count("*").alias("n_input")), key)
    linked = hold(url_repeats(sized, key))
    hard = hard_filters(linked.filter("not repeat").drop("repeat"), measured)
    scored = hard.filter("reason is null").drop("bg_score", "phash") if score else hard.filter("reason is null")
    seen = hold(visual_repeats(score(scored) if score else scored, key))
    order = [F.desc(blocked("display_link", rules.PRIORITY_DOMAINS)), F.desc("bg_score"), F.desc(F.col("width") * F.col("height")), F.col("pos")]
    ranked = seen.filter("not repeat").withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    tested = (reach(ranked) if reach else ranked.withColumn("alive", F.lit(True))).withColumn("alive", F.coalesce("alive", F.lit(False)))
    so_far = F.sum(F.col("alive").cast("int")).over(Window.partitionBy(key).orderBy("rank"))
    judged = tested.withColumn("__n", so_far).withColumn("status", F.when(F.col("__n") - F.col("alive").cast("int") >= k, "trimmed").when(F.col("alive"), "kept").otherwise("unreachable"))
    columns = [*pool.columns, "n_input"]

    def told(rows: DataFrame, status, reason, rank=None) -> DataFrame:
        has = [F.col(c) if c in rows.columns else F.lit(None).cast(pool.schema[c].dataType).alias(c) for c in columns]
        number = rank if rank is not None else F.lit(None)
        return rows.select(*has, status.alias("status"), reason.cast("string").alias("reason"), number.cast("int").alias("rank"))

    dropped = F.lit("dropped")
    out = told(linked.filter("repeat"), dropped, F.lit("duplicado_url")).unionByName(told(hard.filter("reason is not null"), dropped, reason_detail("reason")))
    out = out.unionByName(told(seen.filter("repeat"), dropped, F.lit("duplicado_visual")))
    return out.unionByName(told(judged, F.col("status"), F.lit(None), F.when(F.col("status") == "kept", F.col("__n")).otherwise(F.col("rank"))))
