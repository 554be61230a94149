"""Benchmark decontamination with DataFrame operations only.

A benchmark item is leaked by a document if a window of as many words as the item has is at least 0.8
similar to it, by weighted Jaccard similarity of five-word shingles: a shingle of the item weighs by how
few items have it, any other the most. Windows are fingerprinted by SimHash; fingerprints meet the items'
in eight blocks of eight bits, of which one must differ in two bits at most if all differ in RADIUS at
most, so every fingerprint within RADIUS is found; the exact similarity then decides. At similarity 0.8
two fingerprints differ in about ten bits, and RADIUS is four and a half standard deviations above.

Scale: a window that shares no shingle with any item cannot be similar to one, so windows begin where a
shared shingle aligns them with an item, up to SLACK words off, or between two such places that are not farther
apart than the item is long (insertions and deletions move what follows them; any other window loses words of the
item to gain others'). Documents are scanned for shared shingles, of which only places are kept, and the documents that
have some are then cut into windows. The items' tables and the places asked for are broadcast if they have been counted to
hold at most BROADCAST entries, and joined by shuffle otherwise. A passage in very many documents costs each of them its
own few windows and no more.

Edge cases: null or empty texts and texts without words match nothing; an item of fewer than five words is
one shingle of all its words; very long texts and items are whole; a window cut by the document's end is compared as it
is; of equally similar windows the first counts; repeated items and repeated rows of documents give one row per
(doc_id, item_id), texts under one doc_id are judged apart; rows without doc_id are ignored; empty tables give an empty
result; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrina.llm.tables import saved

SIZE = 5
RADIUS, BLOCKS, BLOCK_RADIUS = 23, 8, 2
SLACK = 2
#: Entries (rows, or what a row's array or map holds; some 32 bytes each) up to which a table is sent to every executor.
BROADCAST = 1_000_000
#: Everything in ASCII but letters and digits parts words.
SEPARATORS = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def word_hashes(text: str | Column) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.transform(F.array_remove(F.split(F.lower(F.coalesce(t, F.lit(""))), SEPARATORS), ""), lambda w: F.xxhash64(w))


def shingle_hashes(words: str, size: int) -> Column:
    """Hashes of runs of ``size`` words of an array column; none if there are fewer."""
    w = F.col(words)
    whole = F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, size)]))
    return F.slice(whole, F.lit(1), F.greatest(F.size(w) - (size - 1), F.lit(0)))


def simhash(shingles: str, lane: int = 16) -> Column:
    """64 bits, each the majority among the shingles': sums in lanes of so many bits, which the number of shingles must fit."""
    mask, zero = F.lit(sum(1 << lane * k for k in range(64 // lane))), F.lit(0).cast("long")

    def lane_sum(j: int) -> Column:
        return F.aggregate(F.col(shingles), zero, lambda a, x: a + F.shiftrightunsigned(x, j).bitwiseAND(mask))

    def majority(sums: Column, j: Column) -> Column:
        over = [F.shiftrightunsigned(sums, lane * k).bitwiseAND(F.lit((1 << lane) - 1)) * 2 > F.size(shingles) for k in range(64 // lane)]
        return reduce(lambda a, b: a.bitwiseOR(b), [F.when(o, F.call_function("shiftleft", F.lit(1 << lane * k).cast("long"), j)).otherwise(zero) for k, o in enumerate(over)])

    bits = F.transform(F.array(*map(lane_sum, range(lane))), majority)
    return F.aggregate(bits, zero, lambda a, x: a.bitwiseOR(x))


def _blocks(fingerprint: str) -> Column:
    return F.array(*[F.shiftrightunsigned(fingerprint, 8 * b).bitwiseAND(F.lit(255)) for b in range(BLOCKS)])


def _small(table: DataFrame, entries: Column | None = None) -> DataFrame:
    """The table, marked to be broadcast if it has been counted to be small enough."""
    n = table.agg(F.sum(entries) if entries is not None else F.count("*")).first()[0] or 0
    return F.broadcast(table) if n <= BROADCAST else table


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """item (a key), item_id, n_words, size (words a shingle) and its shingles."""
    words = benchmark.filter("item_id is not null").select("item_id", F.xxhash64("item_id", "text").alias("item"), word_hashes("text").alias("words")).filter(F.size("words") > 0).dropDuplicates(["item"])
    sized = words.withColumn("n_words", F.size("words")).withColumn("size", F.least("n_words", F.lit(SIZE)))
    return saved(sized.withColumn("shingles", reduce(lambda other, k: F.when(F.col("size") == k, shingle_hashes("words", k)).otherwise(other), range(1, SIZE), shingle_hashes("words", SIZE))).drop("words"))


def _starts(rows: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """doc_id, text_hash and the places at which windows of n_words begin, for items of so many words a shingle."""
    places = _small(saved(items.filter(F.col("size") == size).select("n_words", F.posexplode("shingles").alias("offset", "shingle")).distinct()))
    # outer: a plain explode makes Spark infer a filter on the array's size, which repeats the whole expression inside itself
    own = rows.select("doc_id", "text_hash", shingle_hashes("words", size).alias("all")).select("doc_id", "text_hash", F.posexplode_outer("all").alias("at", "shingle"))
    aligned = own.join(places, "shingle").groupBy("doc_id", "text_hash", "n_words", F.greatest(F.col("at") - F.col("offset"), F.lit(0)).alias("start")).agg(F.lit(1).alias("one"))
    follows = F.lead("start").over(Window.partitionBy("doc_id", "text_hash", "n_words").orderBy("start"))
    spans = aligned.select("doc_id", "text_hash", "n_words", "start", follows.alias("next"))
    last = F.when(F.col("next") - F.col("start") <= F.col("n_words"), F.col("next")).otherwise(F.col("start") + SLACK)
    each = spans.select("doc_id", "text_hash", "n_words", F.explode(F.sequence(F.greatest(F.col("start") - SLACK, F.lit(0)), last)).alias("start")).distinct()
    return each.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("n_words", "start")).alias("asked"))


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8) -> DataFrame:
    """doc_id, item_id, similarity, start_word (0-based) and n_words of the best window of each leaked item."""
    items = benchmark_items(benchmark)
    n_items, longest = items.agg(F.count("*"), F.max("n_words")).first()
    lane = 16 if (longest or 0) < 1 << 16 else 32
    weights = items.select("item", F.explode(F.array_distinct("shingles")).alias("shingle"))
    rare = weights.groupBy("shingle").agg((1 + F.log(F.lit(float(max(n_items, 1))) / F.count("*"))).alias("weight"))
    weighed = weights.join(rare, "shingle").groupBy("item").agg(F.map_from_entries(F.collect_list(F.struct("shingle", "weight"))).alias("weights"))
    full = items.withColumn("print", simhash("shingles", lane)).join(weighed, "item").select("item", "item_id", "n_words", "print", "weights", F.aggregate(F.map_values("weights"), F.lit(0.0), lambda a, x: a + x).alias("total"))
    most = 1 + F.log(F.lit(float(max(n_items, 1))))
    near = F.array(*[F.lit(sum(1 << b for b in bs)).cast("long") for r in range(BLOCK_RADIUS + 1) for bs in combinations(range(8), r)])
    probes = full.select("item", "n_words", F.col("print").alias("its"), F.posexplode(_blocks("print")).alias("block", "value")).select("item", "n_words", "its", "block", F.explode(F.transform(near, lambda m: F.col("value").bitwiseXOR(m))).alias("value"))
    probes, full = _small(saved(probes)), _small(saved(full.select("item", "item_id", "weights", "total")), F.size("weights"))
    rows = docs.filter("doc_id is not null").select("doc_id", F.xxhash64("text").alias("text_hash"), word_hashes("text").alias("words"))
    windows = None
    for size in sorted(r[0] for r in items.select("size").distinct().collect()):  # five sizes at most
        asked = _small(saved(_starts(rows, items, size)), F.size("asked"))
        cut = rows.join(asked, ["doc_id", "text_hash"]).select("doc_id", "text_hash", "asked", shingle_hashes("words", size).alias("all"))
        each = cut.select("doc_id", "text_hash", "all", F.explode_outer("asked").alias("w")).select("doc_id", "text_hash", "w.n_words", "w.start", F.slice("all", F.col("w.start") + 1, F.col("w.n_words") - (size - 1)).alias("shingles"))
        each = each.filter(F.size("shingles") > 0)
        windows = each if windows is None else windows.unionByName(each)
    if windows is None:
        return docs.sparkSession.createDataFrame([], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {benchmark.schema['item_id'].dataType.simpleString()}, similarity double, start_word int, n_words int")
    prints = windows.withColumn("print", simhash("shingles", lane))
    parts = prints.select("doc_id", "text_hash", "n_words", "start", "shingles", "print", F.posexplode(_blocks("print")).alias("block", "value"))
    met = parts.join(probes, ["n_words", "block", "value"]).filter(F.bit_count(F.col("print").bitwiseXOR(F.col("its"))) <= RADIUS)
    met = met.groupBy("doc_id", "text_hash", "item", "n_words", "start").agg(F.first("shingles").alias("shingles")).join(full, "item")
    own = F.array_distinct("shingles")
    shared = F.array_intersect(own, F.map_keys("weights"))
    both = F.aggregate(shared, F.lit(0.0), lambda a, x: a + F.try_element_at("weights", x))
    similarity = both / (F.col("total") + most * (F.size(own) - F.size(shared)))
    found = met.withColumn("similarity", similarity).filter(F.col("similarity") >= threshold)
    best = F.max_by(F.struct(F.col("start").alias("start_word"), "n_words"), F.struct("similarity", -F.col("start")))
    return found.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"), best.alias("best")).select("doc_id", "item_id", "similarity", "best.*")
