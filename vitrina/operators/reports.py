"""Reports over the event ledger and the funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.functions import rules

LEDGER = "ts string, kind string, ref string, query string, profile string, geo boolean, attempts int, attempt int, error string, model string, prompt_tokens int, output_tokens int, thoughts_tokens int, total_tokens int"


SEARCH, MODEL, RETRIES = "cse_call", "gemini_call", ("cse_retry", "gemini_retry")


def prices(spark) -> DataFrame:
    return spark.createDataFrame([(m, i, o) for m, (i, o) in rules.MODEL_PRICES.items()], "model string, usd_in double, usd_out double")


def search_cost(events: DataFrame, free: int = rules.FREE_SEARCHES, usd_per_1000: float = rules.USD_PER_1000_SEARCHES) -> DataFrame:
    """Searches, those beyond each UTC day's free ones, and their price."""
    days = events.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    billable = F.coalesce(F.sum(F.greatest(F.col("n") - free, F.lit(0))), F.lit(0))
    return days.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("calls"), billable.alias("billable"), F.bround(billable / 1000 * usd_per_1000, 4).alias("cost_usd"))


def model_cost(calls: DataFrame, prices: DataFrame) -> DataFrame:
    """Calls, tokens and price by model; a model without a price has none, a call without a model is not counted."""
    used = calls.filter("model is not null").groupBy("model").agg(F.count("*").alias("calls"), F.sum(F.coalesce("prompt_tokens", F.lit(0))).alias("tokens_in"), F.sum(F.coalesce("output_tokens", F.lit(0)) + F.coalesce("thoughts_tokens", F.lit(0))).alias("tokens_out"))
    cost = F.bround((F.col("tokens_in") * F.col("usd_in") + F.col("tokens_out") * F.col("usd_out")) / 1e6, 4)
    return used.join(prices, "model", "left").select("model", "calls", "tokens_in", "tokens_out", cost.alias("cost_usd"))


def cost_report(events: DataFrame, model_prices: DataFrame | None = None, free: int = rules.FREE_SEARCHES, usd_per_1000: float = rules.USD_PER_1000_SEARCHES) -> DataFrame:
    """A line for the searches and one for each model: servicio, llamadas, tokens, costo_usd, nota."""
    found = search_cost(events.filter(F.col("kind") == SEARCH), free, usd_per_1000)
    none = F.lit(None).cast("long")
    searches = found.select(F.lit("CSE").alias("servicio"), F.col("calls").alias("llamadas"), none.alias("tokens_entrada"), none.alias("tokens_salida"), F.col("cost_usd").alias("costo_usd"), F.concat(F.col("billable").cast("string"), F.lit(f" facturables tras {free} gratis/dia")).alias("nota"))
    known = model_prices if model_prices is not None else prices(events.sparkSession)
    used = model_cost(events.filter(F.col("kind") == MODEL), known)
    return searches.unionByName(used.select(F.col("model").alias("servicio"), F.col("calls").alias("llamadas"), F.col("tokens_in").alias("tokens_entrada"), F.col("tokens_out").alias("tokens_salida"), F.col("cost_usd").alias("costo_usd"), F.lit("salida incluye thinking tokens").alias("nota")))


def cost_total(report: DataFrame) -> DataFrame:
    """The sum of known prices, and the numbers of searches and of model calls."""
    calls = lambda searches: F.coalesce(F.sum(F.when((F.col("servicio") == "CSE") == searches, F.col("llamadas"))), F.lit(0))
    return report.agg(F.coalesce(F.sum(F.nanvl("costo_usd", F.lit(0.0))), F.lit(0.0)).alias("total_usd"), calls(True).alias("searches"), calls(False).alias("model_calls"))


def retries(events: DataFrame, kinds: tuple[str, ...] = RETRIES) -> DataFrame:
    """Retries by kind and error, most first; those without an error are not counted."""
    return events.filter(F.col("kind").isin(*kinds) & F.col("error").isNotNull()).groupBy("kind", "error").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "kind", "error")


def one_per_ref(selection: DataFrame, order: str | None = None) -> DataFrame:
    """The last selection of each ref by ``order`` (or by its text, where there is no order)."""
    by = F.struct(order, F.to_json(F.struct("*"))) if order else F.to_json(F.struct("*"))
    return selection.groupBy("ref").agg(F.max_by(F.struct(*[c for c in selection.columns if c != "ref"]), by).alias("s")).select("ref", "s.*")


def funnel(rows: DataFrame, searched: DataFrame, kept: DataFrame, selections: DataFrame) -> DataFrame:
    """For each row's ref its candidates found, kept and judged, whether one was selected, confidence and flags.

    ``selections`` has ref, n_evaluadas, seleccion (null: none), confianza and flags; a ref without one gets - .
    """
    n = lambda t, name: t.groupBy("ref").agg(F.count("*").alias(name))
    one = one_per_ref(selections.select("ref", "n_evaluadas", F.col("seleccion").isNotNull().alias("seleccionada"), "confianza", F.array_join("flags", ", ").alias("flags")))
    out = rows.join(n(searched, "n_cse"), "ref", "left").join(n(kept, "n_prefiltro"), "ref", "left").join(one, "ref", "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_cse", "n_prefiltro", "n_evaluadas")]
    return out.select("ref", *zero, F.coalesce("seleccionada", F.lit(False)).alias("seleccionada"), F.coalesce("confianza", F.lit("-")).alias("confianza"), F.coalesce(F.nullif("flags", F.lit("")), F.lit("-")).alias("flags"))


def funnel_summary(f: DataFrame) -> DataFrame:
    """Products, those with an image, and where the others were lost; zeros for no products."""
    hit = F.coalesce(F.sum(F.col("seleccionada").cast("int")), F.lit(0))
    return f.agg(
        F.count("*").alias("productos"), hit.alias("con_imagen"), (F.count("*") - hit).alias("sin_imagen"),
        F.bround(F.coalesce(hit / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)), 3).alias("tasa_exito"),
        F.count_if(F.col("n_cse") == 0).alias("perdidos_pool_cse_vacio"),
        F.count_if((F.col("n_cse") > 0) & (F.col("n_prefiltro") == 0)).alias("perdidos_prefiltro_vacio"),
        F.count_if((F.col("n_prefiltro") > 0) & ~F.col("seleccionada")).alias("perdidos_gemini_descarto"),
    )


def funnel_counts(f: DataFrame) -> DataFrame:
    """Products by confidence and by flag: what (confianza or flags), value, n."""
    by = f.select(F.lit("confianza").alias("what"), F.col("confianza").alias("value"))
    flags = f.filter("flags <> '-'").select(F.lit("flags").alias("what"), F.explode(F.split("flags", ", ")).alias("value"))
    return by.unionByName(flags).groupBy("what", "value").agg(F.count("*").alias("n")).orderBy("what", F.desc("n"), "value")


#: The output's columns behind the catalog's own, in order.
WIDE = ("imagen_url", "imagen_local", "categoria", "termino_busqueda", "perfil_cse_usado", "intento_cse", "query_cse", "pasadas_gemini", "reintentos_api_gemini", "confianza", "flags", "razon_gemini")


def output(catalog: DataFrame, selections: DataFrame, local: DataFrame | None = None) -> DataFrame:
    """A row for each catalog row, in its columns and those of WIDE; what no selection gives is empty.

    ``selections`` has ref, seleccion (a struct with link), intento_cse, query_cse, pasadas_gemini, intentos,
    confianza, flags and comentario; ``local`` has ref and imagen_local. A name that the catalog has already
    (categoria, termino_busqueda) is not repeated but moves behind.
    """
    text = lambda c: F.col(c).cast("string")
    one = one_per_ref(selections.select("ref", text("seleccion.link").alias("imagen_url"), text("intento_cse").alias("intento_cse"), "query_cse", text("pasadas_gemini").alias("pasadas_gemini"), text("intentos").alias("reintentos_api_gemini"), "confianza", F.array_join("flags", ", ").alias("flags"), F.col("comentario").alias("razon_gemini")))
    rows = catalog.join(one, "ref", "left")
    rows = rows.join(local.groupBy("ref").agg(F.max("imagen_local").alias("imagen_local")), "ref", "left") if local is not None else rows.withColumn("imagen_local", F.lit(""))
    rows = rows.withColumn("perfil_cse_usado", F.col("cse_profile") if "cse_profile" in catalog.columns else F.lit(""))
    return rows.select(*[c for c in catalog.columns if c not in WIDE], *[F.coalesce(F.col(c) if c in rows.columns else F.lit(None), F.lit("")).alias(c) for c in WIDE])
