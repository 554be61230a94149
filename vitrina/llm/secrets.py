"""Secret scans with DataFrame operations only.

Fixed patterns find secrets by their form or by the name they are assigned to. Character Markov models add
what has neither: a long token is a secret if its characters follow each other as in random strings
rather than as in ordinary identifiers, by the log-likelihood ratio of two first-order models. Each model is
the product of two chains, one of the characters without their case and one of their kinds (capital, small,
digit, sign), so that words need not be seen in every spelling. They are trained on labelled samples: random
strings in the usual alphabets, and identifiers put together from common words in the usual styles. A part of
the samples is held out: the ratio from which a token is a secret is the least that at most one in
``FALSE_ALARMS`` of the held-out identifiers reaches, and LEAST_RATIO at least.

Places are code points, end exclusive. They come from the lengths of matches and of the gaps between them,
each match tied to where the last one ended, so a text is read a fixed number of times. One projection, no
shuffle: every text stays in its task.

Edge cases: a null or empty text has no spans; a match that is too short is dropped but still hides what
it overlaps, as in a scan from the left; spans of different kinds may overlap, but an added one overlaps
none of the fixed; equal starts are listed in the order of KINDS; very long texts are whole; every input row, repeated
or not, gives a row; an empty table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: The patterns and least lengths of the kinds, in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Tokens that the models judge: long, with letters and digits.
TOKEN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{16,}"
LEAST_VALUE = 8
#: The log-likelihood ratio, in nats, that a secret has at least, and the share of held-out identifiers, one in so many, that may reach the threshold.
LEAST_RATIO, FALSE_ALARMS = 8.0, 500
#: The states of the two chains.
CHARACTERS, CLASSES = "abcdefghijklmnopqrstuvwxyz0123456789+/_-", "Aa0+"
#: A labelled sample of ordinary identifiers is put together from these.
WORDS = """account action address admin agent alpha amount api archive array asset async audio author backup base batch beta
billing binary block body boundary branch browser buffer build cache calendar category center channel chart client
cloud cluster code collection color column command comment company complete component config connection content
context control count country create current customer dashboard data database date default delete delivery deploy
description detail device digest directory display document domain download draft editor element email enable engine
entry error event example export feature field file filter folder format frame function gallery global graph group
handler header height history home image import index info input install instance interface internal invoice item job
journal keyboard label language layout level library license link list local location login manager market master
media member memory menu message method mobile model module monitor name network notification number object option
order output package page panel parameter parent password path payment pending performance person picture platform
player plugin policy popular position preview primary private process product profile program project property""".split()


def _spans(text: Column, pattern: str, kind: int, value_group: bool = False) -> Column:
    """Array of (start, end, kind) of the pattern's matches from the left; value_group: only long values."""
    tied = r"(?s)\G(.*?)(" + pattern + ")"
    gaps, hits = F.regexp_extract_all(text, F.lit(tied), F.lit(1)), F.regexp_extract_all(text, F.lit(tied), F.lit(2))
    sizes = F.zip_with(gaps, hits, lambda g, h: F.struct(F.length(g).alias("gap"), F.length(h).alias("size"), F.lit(LEAST_VALUE).alias("value")))
    if value_group:
        values = F.regexp_extract_all(text, F.lit(tied), F.lit(3))
        sizes = F.zip_with(sizes, values, lambda s, v: F.struct(s["gap"].alias("gap"), s["size"].alias("size"), F.length(v).alias("value")))
    span = "struct<start:int,end:int,kind:int>"
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("spans"))

    def step(done: Column, s: Column) -> Column:
        start = done["at"] + s["gap"]
        new = F.array(F.struct(start.alias("start"), (start + s["size"]).alias("end"), F.lit(kind).alias("kind")).cast(span))
        return F.struct((start + s["size"]).alias("at"), F.when(s["value"] >= LEAST_VALUE, F.concat(done["spans"], new)).otherwise(done["spans"]).alias("spans"))

    return F.aggregate(sizes, empty, step, lambda done: done["spans"])


def _none() -> Column:
    return F.array().cast("array<struct<start:int,end:int,kind:int>>")


def labelled_samples(spark: SparkSession, n: int = 3000) -> DataFrame:
    """Labelled strings: random (1) in hexadecimal, base 64, base 62 and base 36, and identifiers (0) in seven styles."""
    i = F.col("id")
    digest = F.sha2(i.cast("string"), 256)
    base64 = lambda seed: F.base64(F.unhex(F.sha2(F.concat(digest, F.lit(seed)), 256)))
    words = F.array(*map(F.lit, WORDS))
    w = [F.get(words, F.pmod(F.xxhash64(i, F.lit(k)), F.lit(len(WORDS))).cast("int")) for k in range(4)]
    big = [F.initcap(x) for x in w]
    number = F.pmod(F.xxhash64(i, F.lit(9)), F.lit(3000)).cast("string")
    random = F.array(digest, F.regexp_replace(base64("a"), "=", ""), F.upper(F.conv(F.substring(digest, 1, 15), 16, 36)), F.substring(F.regexp_replace(base64("b"), "[+/=]", ""), 1, 24), F.upper(F.substring(F.regexp_replace(base64("c"), "[+/=]", ""), 1, 20)), F.substring(F.translate(base64("d"), "+/=", "-_"), 1, 32))
    plain = F.array(F.concat_ws("_", *w[:3], number), F.concat_ws("-", w[0], w[1], number), F.concat(w[0], *big[1:3], number), F.concat(*big[:3], F.substring(number, 1, 1)), F.upper(F.concat_ws("_", *w[:3], number)), F.concat_ws("/", w[2], w[1], F.concat(w[3], number)), F.concat(w[0], big[1], F.substring(number, 1, 1), big[2], big[3]))
    rows = spark.range(n)
    return rows.select(F.lit(1).alias("label"), F.explode(random).alias("string")).unionByName(rows.select(F.lit(0).alias("label"), F.explode(plain).alias("string")))


def _classes(token: Column) -> Column:
    """The token with every character replaced by its kind."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(token, "[^A-Za-z0-9]", "+"), "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")


class Models:
    """The log-likelihood ratio of each pair of states, for both chains, and the threshold."""

    def __init__(self, characters: list[float], classes: list[float], threshold: float = LEAST_RATIO):
        self.characters, self.classes, self.threshold = characters, classes, threshold

    def ratio(self, token: Column) -> Column:
        """A token's log-likelihood ratio, random to ordinary."""
        return _chain(F.lower(token), CHARACTERS, self.characters) + _chain(_classes(token), CLASSES, self.classes)


def _chain(token: Column, states: str, table: list[float]) -> Column:
    code = F.transform(F.split(token, ""), lambda c: F.call_function("instr", F.lit(states), c) - 1)
    pairs = F.zip_with(F.slice(code, F.lit(1), F.size(code) - 1), F.slice(code, F.lit(2), F.size(code) - 1), lambda a, b: F.get(F.array(*map(F.lit, table)), a * len(states) + b))
    return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))


def _pair_ratios(strings: DataFrame, states: str, smoothing: float) -> list[float]:
    """The log of how much likelier each state follows another in strings of label 1 than of label 0, row by row."""
    n = len(states)
    places = F.sequence(F.lit(1), F.length("string") - 1)
    pairs = strings.filter(F.length("string") > 1).select("label", F.explode(F.transform(places, lambda i: F.substring(F.col("string"), i, F.lit(2)))).alias("pair"))
    counts = [[smoothing] * (n * n) for _ in range(2)]
    for label, pair, many in pairs.groupBy("label", "pair").count().collect():  # at most two rows for each pair of states
        a, b = states.find(pair[0]), states.find(pair[1])
        if a >= 0 and b >= 0:
            counts[label][a * n + b] += many
    rows = [[sum(c[a * n : (a + 1) * n]) for a in range(n)] for c in counts]
    return [round(math.log(counts[1][k] / rows[1][k // n]) - math.log(counts[0][k] / rows[0][k // n]), 3) for k in range(n * n)]


def train(samples: DataFrame, smoothing: float = 20.0) -> Models:
    """Models of three quarters of labelled strings (label, string), and the threshold that the rest calls for."""
    held = F.pmod(F.xxhash64("string"), F.lit(4)) == 0
    seen = samples.filter(~held)
    found = Models(_pair_ratios(seen.withColumn("string", F.lower("string")), CHARACTERS, smoothing), _pair_ratios(seen.withColumn("string", _classes(F.col("string"))), CLASSES, smoothing))
    least = samples.filter(held & (F.col("label") == 0)).agg(F.percentile(found.ratio(F.col("string")), F.lit(1 - 1 / FALSE_ALARMS))).first()[0]
    found.threshold = max(LEAST_RATIO, math.ceil(least or 0))
    return found


def secret_spans(docs: DataFrame, models: Models | None = None) -> DataFrame:
    """row (a struct of the columns of docs), text (null: empty), and arrays of (start, kind number, end): base and added; likely: base ones that the models call random too."""
    models = models or train(labelled_samples(docs.sparkSession))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    t = F.col("text")
    named = F.when(t.rlike(ASSIGN), _spans(t, ASSIGN, 0, True)).otherwise(_none())
    keys = F.when(t.contains("AKIA"), _spans(t, ACCESS, 1)).otherwise(_none())
    hexes = F.when(t.rlike(HEX), _spans(t, HEX, 2)).otherwise(_none())
    tokens = F.when(t.rlike(TOKEN), _spans(t, TOKEN, 3)).otherwise(_none())
    found = rows.select("*", named.alias("s0"), keys.alias("s1"), hexes.alias("s2"), tokens.alias("s3"))
    base = F.array_sort(F.transform(F.concat("s0", "s1", "s2"), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    found = found.select("*", base.alias("base"))
    judged = F.filter("s3", lambda s: models.ratio(F.substring(t, s["start"] + 1, s["end"] - s["start"])) >= models.threshold)
    found = found.select("*", F.when(F.size("s3") > 0, judged).otherwise(F.slice("s3", 1, 0)).alias("random"))
    meets = lambda x, y: (x["start"] < y["end"]) & (x["end"] > y["start"])
    free = F.filter("random", lambda s: ~F.exists("base", lambda b: meets(b, s)))
    added = F.when(F.size("random") > 0, F.transform(free, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))).otherwise(F.slice("base", 1, 0))
    likely = F.when(F.size("random") > 0, F.filter("base", lambda b: F.exists("random", lambda s: meets(b, s)))).otherwise(F.slice("base", 1, 0))
    return found.select("row", "text", "base", added.alias("added"), likely.alias("likely"))


def _listed(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def secrets(docs: DataFrame, models: Models | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov (added spans), n_likely (base spans that the models confirm)."""
    found = secret_spans(docs, models)

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return found.select("row.doc_id", *map(count, range(3)), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_markov"), F.size("likely").cast("long").alias("n_likely"))


def redacted(docs: DataFrame, mark: str = "[secret]", models: Models | None = None) -> DataFrame:
    """docs, in its own columns, with every span in text replaced by ``mark``; overlapping spans become one."""
    found = secret_spans(docs, models)
    spans = F.array_sort(F.concat("base", "added"))
    t = F.col("text")

    def step(done: Column, s: Column) -> Column:
        gap = F.when(s["start"] > done["at"], F.substring(t, done["at"] + 1, s["start"] - done["at"])).otherwise("")
        put = F.when(s["start"] >= done["at"], F.lit(mark)).otherwise("")
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.concat(done["out"], gap, put).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(spans, start, step, lambda done: F.concat(done["out"], F.substring(t, done["at"] + 1, F.length(t))))
    text = F.when(F.col("row.text").isNull(), F.lit(None).cast("string")).when(F.size(spans) > 0, clean).otherwise(t)
    return found.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
