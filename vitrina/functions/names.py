"""Name normalisation as Column expressions: nothing here leaves generated JVM code."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from vitrina.functions import rules

_ACCENTED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
_PLAIN = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy"
#: ASCII, the letters above, and characters near them that have no decomposition or are combining marks.
_SIMPLE = f"^[\\x00-\\x7f{_ACCENTED}¡¢£¤¥¦§©«¬®°±¶·»¿ÆÐ×ØÞßæð÷øþ\\u2013\\u2014\\u2018\\u2019\\u201c\\u201d\\u20ac\\u0300-\\u034e\\u0350-\\u036f]*$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


@F.pandas_udf(StringType())
def _decomposed(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)))


def strip_accents(c: str | Column) -> Column:
    """Compatibility decomposition (NFKD) without combining marks.

    Text of Latin letters stays in generated code, and plain ASCII (as many bytes as characters) is not even looked
    through; only other text is sent to Python, in Arrow batches.
    """
    ascii_ = F.octet_length(_col(c)) == F.char_length(_col(c))
    plain = F.regexp_replace(F.translate(_col(c), _ACCENTED, _PLAIN), r"[\u0300-\u034e\u0350-\u036f]", "")
    simple = _col(c).rlike(_SIMPLE)
    return F.when(ascii_, _col(c)).when(_col(c).isNull() | simple, plain).otherwise(_decomposed(F.when(~ascii_ & ~simple, _col(c))))


def _spaced(c: str | Column, typos: tuple[tuple[str, str], ...]) -> Column:
    spaced = F.regexp_replace(F.upper(F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")), r"(?U)\s+", " ")
    return reduce(lambda x, t: F.regexp_replace(x, *t), typos, spaced)


def clean_basic(c: str | Column, typos: tuple[tuple[str, str], ...] = rules.TYPOS) -> Column:
    return strip_accents(_spaced(c, typos))


def expand_abbreviations(c: str | Column, words: dict[str, str] = rules.ABBREVIATIONS) -> Column:
    table = F.create_map(*[F.lit(x) for pair in words.items() for x in pair]) if words else F.create_map().cast("map<string,string>")
    return F.array_join(F.transform(F.filter(F.split(_col(c), r"(?U)\s+"), lambda t: t != ""), lambda t: F.coalesce(F.try_element_at(table, t), t)), " ")


def pack(c: str | Column, pattern: str = rules.PACK) -> Column:
    return F.trim(F.regexp_extract(_col(c), pattern, 0))


def volume(c: str | Column, pattern: str = rules.VOLUME) -> Column:
    found = F.regexp_extract(_col(c), pattern, 1)
    return F.when(found != "", F.concat(F.upper(found), F.lit("L"))).otherwise("")


def strip_case_multiplier(name: str | Column, confirmed: Column, pattern: str = rules.CASE_MULTIPLIER) -> Column:
    """Without the first case multiplier behind a volume, where a volume is confirmed."""
    return F.when(confirmed != "", F.regexp_replace(_col(name), pattern, "$1$2")).otherwise(_col(name))


def viscosity(c: str | Column, pattern: str = rules.VISCOSITY) -> Column:
    return F.upper(F.regexp_extract(_col(c), pattern, 0))


def tire_size(c: str | Column, pattern: str = rules.TIRE) -> Column:
    return F.upper(F.regexp_extract(_col(c), pattern, 0))


def platform_code(c: str | Column, pattern: str = rules.CODE) -> Column:
    return F.regexp_extract(_col(c), pattern, 1)


def search_term(clean: str | Column, brand: str | Column) -> Column:
    """The clean name, and the brand behind it unless it is in there already."""
    b = strip_accents(F.upper(F.trim(F.coalesce(_col(brand), F.lit("")))))
    return F.when((b != "") & ~F.contains(_col(clean), b), F.trim(F.concat_ws(" ", _col(clean), b))).otherwise(_col(clean))


def _mapped(c: str | Column, table: dict[str, str]) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), _col(c)), F.lit("")) if table else F.lit("")


def normalize(df: DataFrame, name: str = "nombre", brand: str = "marca", given: rules.Rules = rules.DEFAULT) -> DataFrame:
    """The catalog with the ten normalised columns."""
    # A column of its own, as accents are looked for and taken off in several places.
    spaced = df.withColumn("nombre_original", F.trim(F.col(name))).withColumn("__spaced", _spaced(F.coalesce(F.col(name), F.lit("")), given.typos))
    words = spaced.withColumn("__full", expand_abbreviations(strip_accents("__spaced"), given.abbreviations)).drop("__spaced")
    sized = words.withColumns({"pack": pack("__full", given.pack), "litraje": volume("__full", given.volume)})
    stripped = sized.withColumn("nombre_limpio", F.trim(F.regexp_replace(strip_case_multiplier("__full", F.col("litraje"), given.case_multiplier), r"(?U)\s+", " ")))
    return stripped.withColumns(
        {
            "pack_ambiguo": (F.col("pack") != "") & (F.col("litraje") == ""),
            "viscosidad": viscosity("nombre_limpio", given.viscosity),
            "medida_llanta": tire_size("nombre_limpio", given.tire),
            "vehiculo_code_raw": platform_code("nombre_limpio", given.code),
            "vehiculo_code": _mapped(platform_code("nombre_limpio", given.code), given.vehicle_codes),
            "termino_busqueda": search_term("nombre_limpio", brand),
        }
    ).drop("__full")


def build_query(rung: Column, ref: str, brand: str, clean: str) -> Column:
    """Rung 1 quotes reference and brand, rung 2 does not, rung 3 is the clean name."""
    return F.when(rung == 1, F.concat(F.lit('"'), ref, F.lit('" "'), brand, F.lit('"'))).when(rung == 2, F.concat_ws(" ", ref, brand)).otherwise(F.col(clean))


def profile_params(profile: Column, brand: Column) -> Column:
    return F.when(profile == rules.WHITE_DOMINANT, F.create_map(F.lit("imgDominantColor"), F.lit("white"))).when(profile == rules.EXACT_BRAND, F.create_map(F.lit("exactTerms"), brand)).otherwise(F.create_map().cast("map<string,string>"))


def safe_key(c: str | Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_replace(F.trim(_col(c)), r"[^A-Za-z0-9._-]+", "_"), F.lit("")), F.lit("unknown"))


def cache_key(ref: str, rung: Column, profile: str, geo: str | None = None) -> Column:
    """Raw reference and a hash of everything that changes the answer."""
    return F.sha2(F.to_json(F.struct(F.col(ref).alias("ref"), rung.alias("rung"), F.col(profile).alias("profile"), F.lit(geo).alias("geo"))), 256)


def upscale_marketplace(url: str | Column) -> Column:
    u = _col(url)
    return F.when(F.contains(u, F.lit("mlstatic.com")), F.nullif(F.regexp_replace(u, r"-[A-Z](\.\w+)$", "-F$1"), u))


def upscale_uploads(url: str | Column) -> Column:
    u = _col(url)
    return F.when(F.contains(u, F.lit("wp-content/uploads")), F.nullif(F.regexp_replace(u, r"-\d+x\d+(?=\.\w+$)", ""), u))


def keyword_pattern(keywords: tuple[str, ...]) -> str:
    """A keyword not behind an ASCII letter; anything may follow."""
    return r"(?<![A-Za-z])(?:" + "|".join(rf"\Q{k}\E" for k in keywords) + ")"


def classify(c: str | Column, given: rules.Rules = rules.DEFAULT) -> Column:
    """The first category with a keyword in the name."""
    first = reduce(lambda w, r: w.when(_col(c).rlike(keyword_pattern(r[1])), r[0]), given.categories, F.when(F.lit(False), F.lit(None)))
    return first.otherwise(given.other)


def categorize(df: DataFrame, name: str = "nombre_limpio", given: rules.Rules = rules.DEFAULT) -> DataFrame:
    """Adds categoria, cse_profile and presentacion (how the category is to be shown; for the judge's prompt)."""
    profile = F.when(F.col("categoria").isin(*given.exact_brand), rules.EXACT_BRAND).otherwise(rules.BASELINE)
    return df.withColumn("categoria", classify(name, given)).withColumn("cse_profile", profile).withColumn("presentacion", _mapped("categoria", given.presentations))


def coverage(df: DataFrame, key: str = "categoria") -> DataFrame:
    """Rows by category, most first."""
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key)


def coverage_summary(df: DataFrame, key: str = "categoria") -> DataFrame:
    """Rows, distinct categories, and rows that no rule took."""
    return df.agg(F.count("*").alias("n"), F.count_distinct(key).alias("categories"), F.count_if(F.col(key) == rules.OTHER).alias("backlog"))


def backlog(df: DataFrame, key: str = "categoria", name: str = "nombre_limpio") -> DataFrame:
    """The names that no rule took, in order."""
    return df.filter(F.col(key) == rules.OTHER).select("ref", name).orderBy(name, "ref")
