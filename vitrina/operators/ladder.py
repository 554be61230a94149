"""The fallback ladder: laxer queries, rung by rung, for products without a good image.

All pending products climb a rung together, so a rung is one search, one prefilter and one judge plan
whatever their number. ``escalate`` spends its caps rung by rung (all of rung 2 before rung 3), in order of
row_id; ``escalate_in_order`` product by product, in batches too small for a cap to cut one short.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrina.functions import names
from vitrina.operators import candidates, selection
from vitrina.sources.cache import answers, saved

LOG = "ref {ref}, rung int, n_new long, n_kept long, flags string, outcome string"
#: Outcomes that needed a search, and those that needed a judge.
JUDGED = ("resuelto", "sigue_pendiente")

RUNGS = (2, 3)


#: Outcomes after which a product climbs no further rung.
CUT = ("omitido_cap_cse", "omitido_cap_gemini", "error_red")


def _first(rows: DataFrame, left: int) -> DataFrame:
    """The refs of the first ``left`` rows, marked by ``fits``."""
    return saved(rows.orderBy("row_id", "ref").limit(left).select("ref").distinct().withColumn("fits", F.lit(True)))


def _grown(base: DataFrame, found: DataFrame, turn: DataFrame) -> DataFrame:
    """What ``candidates.merge_pools`` gives for the refs of ``turn``, in one pass over rows dealt by ref.

    ``__new``: whether a row was found now; ``__bad``: whether its link is condemned; ``__n``: the new rows of its ref
    that are not. A ref's condemned links come as a row of its own among its candidates, so that nothing is joined and
    all is read off one sort: of a link, the rows held before stand first.
    """
    by = Window.partitionBy("ref").orderBy("link", "__new")
    whole, so_far = (by.rowsBetween(Window.unboundedPreceding, to) for to in (Window.unboundedFollowing, Window.currentRow))
    new, link = F.col("__new"), F.col("link")
    both = base.select(*found.columns, F.lit(False).alias("__new")).unionByName(found.withColumn("__new", F.lit(True)))
    told = turn.filter("lead").select("ref", F.col("condemned").alias("__c"))
    each = both.unionByName(told, allowMissingColumns=True).filter("ref is not null").repartition("ref")
    last, held = F.max(F.when(~new, F.col("pos"))), F.last(F.when(~new, link), ignorenulls=True)
    each = each.withColumns({"__c": F.first("__c", ignorenulls=True).over(whole), "__last": last.over(whole), "__held": held.over(so_far)})
    each = each.filter(F.col("__c").isNotNull() & (~new | (new & (link.isNull() | ~link.eqNullSafe(F.col("__held"))))))
    each = each.withColumn("__bad", F.coalesce(F.array_contains("__c", link), F.lit(False)))
    shifted = F.when(new, F.col("pos") + F.coalesce(F.col("__last") + 1, F.lit(0))).otherwise(F.col("pos"))
    return each.select(*[shifted.alias(c) if c == "pos" else c for c in found.columns], "__new", "__bad", F.count_if(new & ~F.col("__bad")).over(whole).alias("__n"))


def escalate(catalog: DataFrame, pools: DataFrame, verdicts: DataFrame, search: Callable[[DataFrame], DataFrame], judge: Callable[[DataFrame], DataFrame], rungs: tuple[int, ...] = RUNGS, max_queries: int | None = None, max_calls: int | None = None, prefilter: Callable[[DataFrame], DataFrame] = candidates.prefilter) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The pools, verdicts and log after the ladder.

    ``catalog``: row_id, ref, marca, nombre_limpio. ``pools``: ref, pos, link and the rest of a candidate.
    ``verdicts``: ref, flags, condemned (links), passes, rung, query. ``search`` answers rows of ref, rung and
    query with candidates; ``judge`` answers kept candidates with ref, flags and condemned. A product
    without a verdict is pending. The log has ref, rung, n_new, n_kept, flags of the verdict (- for none) and outcome.

    One table has a row for each product: its names, its verdict and how its last rung went. Products of a rung
    are among those of the rung before, so the candidates of these are all that a rung needs of the pools. Of rows of
    one ref the first is its ``lead``.
    """
    if not rungs:
        return pools, verdicts, _empty_log(catalog)
    none = F.array().cast("array<string>")
    first = F.row_number().over(Window.partitionBy("ref").orderBy("row_id")) == 1
    listed = catalog.select("row_id", "ref", "marca", "nombre_limpio", F.lit(True).alias("listed"), first.alias("lead"))
    judged = verdicts.select("ref", "flags", F.coalesce("condemned", none).alias("condemned"), "passes", "rung", "query", F.lit(True).alias("told"))
    state = saved(listed.join(judged, "ref", "full").withColumns({"condemned": F.coalesce("condemned", none), "passes": F.coalesce("passes", F.lit(0)), "listed": F.coalesce("listed", F.lit(False)), "told": F.coalesce("told", F.lit(False)), "cut": F.lit(False)}))
    base, log, queries, calls = pools, [], 0, 0
    for rung in rungs:
        open_ = F.col("listed") & selection.needs_fallback("flags") & ~F.col("cut")
        if max_queries is None:
            now = state.withColumns({"turn": open_, "capped": F.lit(False)})
        elif max_queries > queries:
            fits = F.col("fits").isNotNull()
            now = state.join(_first(state.filter(open_), max_queries - queries), "ref", "left").withColumns({"turn": open_ & fits, "capped": open_ & ~fits}).drop("fits")
        else:  # nothing is left to climb with
            log.append(state.filter(open_).select("ref", F.lit(rung).alias("rung"), *_untried()))
            break
        query = names.build_query(F.lit(rung), "ref", "marca", "nombre_limpio")
        turn = now.filter("turn")
        found = search(turn.select("row_id", "ref", F.lit(rung).alias("rung"), query.alias("query"))).select(*pools.columns)
        base = saved(_grown(base, found, turn))  # the one place that reads the answers, and so what pins them
        pools = pools.unionByName(base.filter("__new").select(*pools.columns))
        kept = saved(prefilter(base.filter("not __bad and __n > 0").select(*pools.columns)))
        asked, may = kept, F.lit(True)
        if max_calls is not None:
            some = _first(turn.join(kept.select("ref"), "ref", "left_semi"), max(max_calls - calls, 0))
            asked, may = kept.join(some, "ref", "left_semi"), F.col("fits").isNotNull()
            now = now.join(some, "ref", "left")
        new = judge(asked).select("ref", F.col("flags").alias("f"), F.col("condemned").alias("c"))
        counts = base.select("ref", F.col("__n").alias("n_new"), F.lit(0).alias("k")).unionByName(kept.select("ref", F.lit(0).cast("long").alias("n_new"), F.lit(1).alias("k")))
        counts = counts.groupBy("ref").agg(F.max("n_new").alias("n_new"), F.sum("k").alias("n_kept"))
        told = now.drop("n_new", "n_kept", "f", "outcome").join(counts, "ref", "left").join(new, "ref", "left").withColumns({n: F.when(F.col("turn"), F.coalesce(n, F.lit(0))) for n in ("n_new", "n_kept")})
        outcome = F.when(F.col("n_new") == 0, "sin_candidatos_nuevos").when(F.col("n_kept") == 0, "prefiltro_vacio").when(~may, "omitido_cap_gemini").when(F.col("f").isNull(), "error_red").when(selection.needs_fallback("f"), "sigue_pendiente").otherwise("resuelto")
        told = told.withColumn("outcome", F.when(F.col("turn"), outcome).when(F.col("capped"), F.lit("omitido_cap_cse")))
        # Every queried product carries its last rung; those judged carry the fresh flags as well.
        state = saved(
            told.select(
                "row_id", "ref", "marca", "nombre_limpio", "listed", "lead", F.coalesce("f", "flags").alias("flags"), F.array_union("condemned", F.coalesce("c", none)).alias("condemned"), (F.col("passes") + F.col("f").isNotNull().cast("int")).alias("passes"),
                F.when(F.col("turn"), F.lit(rung)).otherwise(F.col("rung")).alias("rung"), F.when(F.col("turn"), F.coalesce(query, "query")).otherwise(F.col("query")).alias("query"), (F.col("told") | F.col("turn")).alias("told"),
                (F.col("cut") | F.coalesce(F.col("outcome").isin(*CUT), F.lit(False))).alias("cut"), "n_new", "n_kept", "f", "outcome",
            )
        )
        joined_flags = F.when(F.col("f").isNotNull(), F.coalesce(F.nullif(F.array_join("f", ", "), F.lit("")), F.lit("-")))
        done = state.filter("outcome is not null")
        log.append(done.select("ref", F.lit(rung).alias("rung"), "n_new", "n_kept", F.when(F.col("outcome") != "omitido_cap_cse", joined_flags).alias("flags"), "outcome"))
        if max_queries is not None or max_calls is not None:
            used = done.agg(F.count_if(F.col("outcome") != "omitido_cap_cse"), F.count_if((F.col("n_kept") > 0) & ~F.col("outcome").isin("omitido_cap_cse", "omitido_cap_gemini"))).first()
            queries, calls = queries + used[0], calls + used[1]
    return pools, state.filter("told").select(*verdicts.columns), _all(log)


def _nothing(kind: str, name: str) -> Column:
    return F.lit(None).cast(kind).alias(name)


def _untried() -> tuple[Column, ...]:
    """What the log says of a product that no query was left for."""
    return _nothing("long", "n_new"), _nothing("long", "n_kept"), _nothing("string", "flags"), F.lit("omitido_cap_cse").alias("outcome")


def _empty_log(catalog: DataFrame) -> DataFrame:
    return catalog.sparkSession.createDataFrame([], LOG.format(ref=catalog.schema["ref"].dataType.simpleString()))


def _all(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more)
    return out


def escalate_in_order(catalog: DataFrame, pools: DataFrame, verdicts: DataFrame, search, judge, rungs: tuple[int, ...] = RUNGS, max_queries: int = 20, max_calls: int = 20, **more) -> tuple[DataFrame, DataFrame, DataFrame]:
    """As ``escalate``, but each product climbs all its rungs before the next one begins, as far as the caps go.

    A product needs at most a query and a call a rung, so as many products as the caps hold that often climb
    together; what they leave unused goes to the next batch. Only judged images count as calls.
    A product that is tried takes a query at least, so those that can be tried are as many as there are queries, and
    the tables of these are taken out once.
    """
    pending = saved(catalog.select("row_id", "ref").join(verdicts.select("ref", "flags"), "ref", "left").filter(selection.needs_fallback("flags")).select("row_id", "ref"))
    if not rungs:
        return pools, verdicts, _empty_log(catalog)
    heads = saved(pending.orderBy("row_id").limit(max(max_queries, 0)))
    own = lambda t, some: t.join(some.select("ref"), "ref", "left_semi").select(*t.columns)
    top = heads.agg(F.max("row_id")).first()[0]
    near = [] if top is None else [saved(own(t, heads)) for t in (catalog.filter(F.col("row_id") <= top), pools, verdicts)]
    done, after = [], None
    while near and max_queries > 0:
        caps = [c // len(rungs) for c in (max_queries, max_calls) if c > 0]
        rest = heads if after is None else heads.filter(F.col("row_id") > after)
        batch = saved(rest.orderBy("row_id").limit(max(1, min(caps))))
        last, n = batch.agg(F.max("row_id"), F.count("*")).first()
        if not n:
            break
        step = escalate(*[own(t, batch) for t in near], search, judge, rungs, max_queries, max_calls, **more)
        used = step[2].agg(F.count_if(F.col("outcome") != "omitido_cap_cse"), F.count_if(F.col("outcome").isin(*JUDGED))).first()
        done.append((batch, *step))
        max_queries, max_calls, after = max_queries - used[0], max_calls - used[1], last
    untried = pending if after is None else pending.filter(F.col("row_id") > after)
    log = [*[d[3] for d in done], untried.select("ref", F.lit(rungs[0]).alias("rung"), *_untried())]
    if not done:
        return pools, verdicts, _all(log)
    climbed = _all([d[0].select("ref") for d in done])
    others = lambda t: t.join(climbed, "ref", "left_anti").select(*t.columns)
    return _all([others(pools), *[d[1] for d in done]]), _all([others(verdicts), *[d[2] for d in done]]), _all(log)


def to_keep(log: DataFrame) -> DataFrame:
    """Refs whose ladder may be kept: some image was judged, and no error cut it short."""
    by = log.groupBy("ref").agg(F.max(F.col("outcome").isin(*JUDGED)).alias("judged"), F.max(F.col("outcome") == "error_red").alias("failed"))
    return by.filter("judged and not failed").select("ref")


def escalate_kept(path: str, catalog: DataFrame, pools: DataFrame, verdicts: DataFrame, *args, climb: Callable = escalate, **more) -> tuple[DataFrame, DataFrame, DataFrame]:
    """As ``climb``, but products whose ladder is kept at ``path`` are served from there, and new ones are kept."""
    spark = catalog.sparkSession
    held = [answers(spark, f"{path}/{part}") for part in ("pools", "verdicts", "log")]
    if held[2] is None:
        known = None
        todo = catalog
    else:
        wanted = verdicts.select("ref", "flags")
        known = saved(held[2].select("ref").distinct().join(catalog.select("ref"), "ref", "left_semi").join(wanted, "ref", "left").filter(selection.needs_fallback("flags")).select("ref"))
        todo = catalog.join(known, "ref", "left_anti").select(*catalog.columns)
    fresh = lambda t: t if known is None else t.join(known, "ref", "left_anti").select(*t.columns)
    new = climb(todo, fresh(pools), fresh(verdicts), *args, **more)
    keep = saved(to_keep(new[2]))
    for part, table in zip(("pools", "verdicts", "log"), new, strict=True):
        table.join(keep, "ref", "left_semi").select(*table.columns).write.mode("append").parquet(f"{path}/{part}")
    if known is None:
        return new
    return tuple(n.unionByName(h.join(known, "ref", "left_semi").select(*n.columns)) for n, h in zip(new, held, strict=True))


def rescued(log: DataFrame) -> DataFrame:
    return log.agg(F.count_if(F.col("outcome") == "resuelto").alias("rescued"), F.count_distinct("ref").alias("tried"))
