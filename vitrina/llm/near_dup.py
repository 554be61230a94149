"""MinHash near-deduplication with improved consistent weighted sampling (ICWS).

Shingles of five words carry TF-IDF weights. Each text gets ICWS samples [Ioffe 2010], grouped in bands;
texts that agree on a band are in one bucket, and a pair of a bucket is a link if its weighted Jaccard
similarity is at least 0.8. Classes are the connected components of the links.

Scale. A smoothed IDF is flat below a document frequency of one in ``RARE``, so only shingles above it
need a table, and of those there are at most RARE times the mean number of shingles a document: that
bound does not grow with the corpus, and so the table is broadcast. Document frequencies come from all
documents, as packed sorted blocks of hashes dealt out by hash range. From there on the work is on
distinct texts, known by a 128-bit hash of their words, and only those in a bucket with another are
tokenised again. Buckets with the same members are one. Members are dealt in cells of about CELL; a
cell compares its pairs that the links so far do not join already, the likeliest first, and returns only
links that join two components. Buckets of several cells, where they are still of several components, are
then compared across cells: each member outside the bucket's largest component with all members. So every
two texts of a bucket end in one component or have been compared: no link is lost, and no list of pairs is
ever made. A pair whose samples agree too seldom for the threshold, by five standard deviations, is
not verified; 21 bands of 6 miss 0.2 % of pairs that are exactly at 0.8.

Edge cases: a null or empty text, or one without words, has no shingles and is a class of its own; a
text of fewer than five words is one shingle; very long texts are whole; equal texts share a class; of
several texts under one doc_id the one with the least hash counts; rows without doc_id are ignored; a
class is named by its least doc_id; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm import arrays as A
from vitrina.llm.components import connected_components
from vitrina.llm.tables import Scratch, broadcast_value, saved, texts

U64 = np.uint64
#: A shingle in fewer than one of so many documents has the full weight.
RARE = 1024
#: A document frequency of this share halves, roughly, what a shingle weighs.
SMOOTH = 0.05
BANDS, ROWS = 21, 6
IDF_LEVELS = 12
#: Four bits of each sample are compared before a pair is verified. At similarity 0.8 about 102 of them
#: agree, with a standard deviation of 4.4.
SAMPLES, AGREE = BANDS * ROWS, 81
#: Shingles in a block and in a hash range, rows in a cell and, about, in a group of cells.
UNIT, RANGE, CELL, GROUP = 1 << 21, 1 << 23, 512, 2048
POOL = 1 << 16
_KEYS = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, (2, SAMPLES), dtype=U64) * U64(2) + U64(1)
_SAMPLE_TABLES: dict[int, np.ndarray] = {}


def class_weight(weight_class: np.ndarray) -> np.ndarray:
    """Weight of (term-frequency level, document-frequency level), packed as tf * IDF_LEVELS + df."""
    tf, df = np.divmod(np.asarray(weight_class).astype(np.int64), IDF_LEVELS)
    share = np.where(df == 0, 0.0, 2.0 ** (df - 1) / RARE)
    return (1.0 + tf) * np.log1p(1.0 / (share + SMOOTH)) / np.log1p(1.0 / SMOOTH)


def weight_classes(counts: np.ndarray, levels: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(counts).astype(np.int64), 20) * IDF_LEVELS + levels


def frequent_shingles(docs: DataFrame, size: int = 5) -> DataFrame:
    """Shingles (44-bit hash) of at least one in RARE documents, two at least: columns shingle and df."""
    n_docs, n_chars = docs.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    ranges = max(16, n_chars // (6 * RANGE) + 1)
    least = max(2, n_docs / RARE)
    step = -(-(1 << A.SHINGLE_BITS) // ranges)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def packed() -> pa.RecordBatch:
            ids = np.sort(np.concatenate(held))
            cuts = np.searchsorted(ids, np.arange(ranges + 1, dtype=U64) * U64(step))
            some = [r for r in range(ranges) if cuts[r] < cuts[r + 1]]
            return pa.record_batch({"part": pa.array(some, pa.int32()), "n": pa.array([int(cuts[r + 1] - cuts[r]) for r in some], pa.int64()), "ids": pa.array([A.pack_sorted(ids[cuts[r] : cuts[r + 1]] - U64(r * step)) for r in some], pa.binary())})

        for batch in A.slices(batches):
            held.append(A.shingle_counts(batch.column("text"), size)[1])
            n += len(held[-1])
            if n >= UNIT:
                yield packed()
                held, n = [], 0
        if n:
            yield packed()

    def count(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        ids = np.sort(np.concatenate([A.unpack_sorted(x, n) for x, n in zip(blocks["ids"], blocks["n"], strict=True)]))
        first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        n = np.diff(np.r_[first, len(ids)])
        keep = n >= least
        return pd.DataFrame({"shingle": (ids[first[keep]] + U64(int(key[0]) * step)).astype(np.int64), "df": n[keep]})

    return texts(docs).select("text").mapInArrow(blocks, "part int, n long, ids binary").groupBy("part").applyInPandas(count, "shingle long, df long")


def frequency_table(docs: DataFrame, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The frequent shingles in order and their levels; bounded, see the module's text."""
    found = frequent_shingles(docs, size).toPandas().sort_values("shingle")
    level = 1 + np.floor(np.log2(np.maximum(found["df"].to_numpy() * RARE / max(1, docs.count()), 1))).astype(np.int64)
    return found["shingle"].to_numpy().astype(U64), np.minimum(level, IDF_LEVELS - 1)


def weighted_shingles(hashes: np.ndarray, at: np.ndarray, table: tuple[np.ndarray, np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each document, given its words' hashes, its distinct shingles in order: document, shingle, weight class."""
    doc, ids, counts = A.distinct_shingles(hashes, at, size)
    known, level = table
    levels = np.zeros(len(ids), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, ids), len(known) - 1)
        levels = np.where(known[at] == ids, level[at], 0)
    return doc, ids, weight_classes(counts, levels)


def _sample_table(weight_class: int) -> np.ndarray:
    """ICWS values of a weight for each entry of the pool of random triples (r, c, beta).

    The high 24 bits hold ln a, in order; the low 40 bits a hash of the quantised weight t, so that two
    weights of one shingle agree in a sample only if ICWS gives both the same (shingle, t).
    """
    if weight_class not in _SAMPLE_TABLES:
        rng = np.random.Generator(np.random.PCG64(11))
        r, c, beta = rng.gamma(2.0, 1.0, POOL), rng.gamma(2.0, 1.0, POOL), rng.random(POOL)
        t = np.floor(np.log(class_weight(weight_class)) / r + beta)
        a = np.log(c) - r * (t - beta) - r
        order = np.clip((a + 40.0) * ((1 << 24) / 80.0), 0, (1 << 24) - 1).astype(U64)
        _SAMPLE_TABLES[weight_class] = (order << U64(40)) | (A.mix(t.astype(np.int64).astype(U64)) >> U64(24))
    return _SAMPLE_TABLES[weight_class]


def signatures(doc: np.ndarray, ids: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents that have shingles, and for each a row of band hashes and four bits of each sample."""
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.empty(0, np.int64)
    bands, last = np.zeros((len(first), BANDS), U64), np.zeros((len(first), SAMPLES), np.uint8)
    if len(first):
        present, row = np.unique(classes, return_inverse=True)
        table = np.concatenate([_sample_table(int(c)) for c in present])
        row = (row * POOL).astype(U64)
        spread, low = A.mix(ids), U64((1 << 40) - 1)
        for k in range(SAMPLES):
            z = (spread ^ _KEYS[0, k]) * _KEYS[1, k]
            sample = np.minimum.reduceat(table[(z >> U64(48)) + row] ^ (z & low), first)
            bands[:, k // ROWS] = A.mix(bands[:, k // ROWS] ^ (sample & low)) + U64(k // ROWS)
            last[:, k] = (A.mix(sample & low) & U64(15)).astype(np.uint8)
    return doc[first], bands, last[:, ::2] | (last[:, 1::2] << 4)


def _keys(hashes: np.ndarray, at: np.ndarray) -> pa.Array:
    """A 128-bit hash of each document's words; null without words."""
    data, ends = hashes.tobytes(), (8 * at).tolist()
    return pa.array([hashlib.blake2b(data[a:b], digest_size=16).digest() if b > a else None for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())


def signed(docs: DataFrame, table, size: int = 5) -> DataFrame:
    """doc_id, a key that equal word sequences share, the band hashes and the packed samples (null without words)."""
    held = broadcast_value(docs.sparkSession, table)
    rows = texts(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.slices(batches):
            hashes, at = A.word_hashes(batch.column("text"))
            doc, bands, last = signatures(*weighted_shingles(hashes, at, held.value, size))
            lists: list = [None] * batch.num_rows
            samples: list = [None] * batch.num_rows
            for d, b, x in zip(doc.tolist(), bands.view(np.int64).tolist(), last, strict=True):
                lists[d], samples[d] = b, x.tobytes()
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "copy": _keys(hashes, at), "bands": pa.array(lists, pa.list_(pa.int64())), "samples": pa.array(samples, pa.binary())})

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, copy binary, bands array<long>, samples binary")


def vectors(docs: DataFrame, table, size: int = 5) -> DataFrame:
    """For each document with words its key and its shingles with their weight classes, packed and in order."""
    held = broadcast_value(docs.sparkSession, table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.slices(batches):
            hashes, at = A.word_hashes(batch.column("text"))
            doc, ids, classes = weighted_shingles(hashes, at, held.value, size)
            both = ((ids >> U64(4)) << U64(8)) | classes.astype(U64)
            at_doc = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            yield pa.record_batch({"copy": _keys(hashes, at), "vec": pa.array([A.pack(both[at_doc[i] : at_doc[i + 1]], 6) for i in range(batch.num_rows)], pa.binary())})

    return texts(docs).select("text").mapInArrow(run, "copy binary, vec binary")


def _unpacked(vec: bytes) -> tuple[np.ndarray, np.ndarray, float]:
    x = A.unpack(vec, 6)
    w = class_weight(x & U64(255))
    return x >> U64(8), w, float(w.sum())


def _similarity(x: tuple, y: tuple) -> float:
    at = np.minimum(np.searchsorted(x[0], y[0]), len(x[0]) - 1)
    hit = x[0][at] == y[0]
    shared = float(np.minimum(x[1][at[hit]], y[1][hit]).sum())
    return shared / (x[2] + y[2] - shared)


def similarity(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two packed vectors; 0 if one is empty."""
    return _similarity(_unpacked(a), _unpacked(b)) if a and b else 0.0


def _cell_links(copies: list, c: list, samples: np.ndarray, vecs: list, across: np.ndarray | None, threshold: float) -> list[tuple]:
    """Links that join components, among the rows of a cell or (across) of its rows with those that are marked."""
    names = {x: k for k, x in enumerate(dict.fromkeys(c))}
    up = list(range(len(names)))
    comp = np.array([names[x] for x in c])
    held: dict[int, tuple] = {}
    out = []

    def top(k: int) -> int:
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return k

    def vec(i: int) -> tuple:
        if i not in held:
            held[i] = _unpacked(vecs[i])
        return held[i]

    one, two = (np.arange(len(copies)),) * 2 if across is None else (np.flatnonzero(~across), np.flatnonzero(across))
    for i in two.tolist():
        others = one[(comp[one] != comp[i]) & ((one > i) if across is None else True)]
        if not len(others):
            continue
        x = samples[others] ^ samples[i]
        same = ((x & 15) == 0).sum(1) + ((x >> 4) == 0).sum(1)
        for k in np.argsort(-same, kind="stable").tolist():
            if same[k] < AGREE:
                break
            j = int(others[k])
            a, b = top(comp[i]), top(comp[j])
            if a != b and _similarity(vec(i), vec(j)) >= threshold:
                up[max(a, b)] = min(a, b)
                out.append((copies[i], copies[j]))
    return out


def _links(rows: DataFrame, samples: DataFrame, vecs: DataFrame, threshold: float) -> DataFrame:
    """Links a, b of rows (bucket, cell, copy, c, across); cells meet Python in groups of about GROUP rows."""
    groups = max(1, -(-rows.count() // GROUP))
    full = rows.withColumn("part", F.pmod(F.xxhash64("bucket", "cell"), F.lit(groups)).cast("int")).join(vecs.hint("merge"), "copy").join(samples.hint("merge"), "copy")

    def compare(table: pa.Table) -> pa.Table:
        key = pd.DataFrame({"bucket": table.column("bucket").to_numpy(), "cell": table.column("cell").to_pylist()}).groupby(["bucket", "cell"], sort=False).indices
        copy, c, vec, sample, across = (table.column(x).to_pylist() for x in ("copy", "c", "vec", "samples", "across"))
        out = []
        for at in key.values():
            at = at.tolist()
            own = np.frombuffer(b"".join(sample[i] for i in at), np.uint8).reshape(len(at), -1)
            marks = np.array([bool(across[i]) for i in at]) if across[at[0]] is not None else None
            out += _cell_links([copy[i] for i in at], [c[i] for i in at], own, [vec[i] for i in at], marks, threshold)
        return pa.table({k: pa.array([x[i] for x in out], pa.binary()) for i, k in enumerate("ab")})

    return full.groupBy("part").applyInArrow(compare, "a binary, b binary")


def _labelled(rows: DataFrame, near: DataFrame) -> DataFrame:
    """rows with c, the component of copy so far."""
    return rows.join(near, F.col("copy") == F.col("node"), "left").withColumn("c", F.coalesce("component", "copy")).drop("node", "component")


def _across(members: DataFrame, near: DataFrame, n: int) -> DataFrame:
    """Rows for _links: in each bucket of several cells its members outside the largest component, with all of it."""
    rows = saved(_labelled(members.filter(F.col("n") > CELL), near), n)
    counted = rows.groupBy("bucket", "c").agg(F.count("*").alias("k")).groupBy("bucket").agg(F.max(F.struct("k", "c")).alias("most"))
    mixed = rows.join(counted, "bucket").filter(F.col("most.k") < F.col("n"))
    blocks, chunks = F.ceil(F.col("n") / CELL).cast("int"), F.ceil((F.col("n") - F.col("most.k")) / CELL).cast("int")
    mixed = mixed.select("bucket", "copy", "c", blocks.alias("blocks"), chunks.alias("chunks"), (F.col("c") != F.col("most.c")).alias("odd"), F.xxhash64("copy").alias("h"))
    cell = lambda x, y: F.concat_ws("x", x, y).alias("cell")
    as_row = mixed.select("bucket", "copy", "c", F.pmod("h", "blocks").alias("x"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("y")).select("bucket", cell("x", "y"), "copy", "c", F.lit(False).alias("across"))
    as_odd = mixed.filter("odd").select("bucket", "copy", "c", F.pmod("h", "chunks").alias("y"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("x")).select("bucket", cell("x", "y"), "copy", "c", F.lit(True).alias("across"))
    return as_row.unionByName(as_odd)


def near_duplicates(docs: DataFrame, threshold: float = 0.8, size: int = 5) -> DataFrame:
    """One row per doc_id: its class (the least doc_id in it), the class's size, and whether it stands for it."""
    docs = docs.filter("doc_id is not null")
    table = frequency_table(docs, size)
    sig = saved(signed(docs, table, size))
    n = sig.count()
    own = saved(sig.groupBy("doc_id").agg(F.min("copy").alias("copy")), n)
    distinct = Scratch(sig.filter("copy is not null").groupBy("copy").agg(F.first("bands").alias("bands"), F.first("samples").alias("samples"), F.min("doc_id").alias("doc_id")), n)
    spread = distinct.df.select("copy", F.explode("bands").alias("bucket"))
    crowded = spread.groupBy("bucket").agg(F.count("*").alias("n"), *[F.bit_xor(F.xxhash64("copy", F.lit(k))).alias(f"m{k}") for k in (1, 2)]).filter("n > 1")
    apart = crowded.groupBy("n", "m1", "m2").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    members = Scratch(spread.join(apart, "bucket"), n)
    wanted = members.df.select("copy").distinct()
    samples = Scratch(distinct.df.join(wanted, "copy", "left_semi").select("copy", "samples", "doc_id"), n)
    n = samples.df.count()
    picked = docs.join(samples.df.select("doc_id").distinct(), "doc_id", "left_semi")
    vecs = Scratch(vectors(picked, table, size).join(samples.df.select("copy"), "copy", "left_semi").groupBy("copy").agg(F.first("vec").alias("vec")), 8 * n)
    cells = members.df.select("bucket", F.pmod(F.xxhash64("copy"), F.ceil(F.col("n") / CELL)).cast("string").alias("cell"), "copy", F.col("copy").alias("c"), F.lit(None).cast("boolean").alias("across"))
    marks = samples.df.select("copy", "samples")
    near = connected_components(_links(cells, marks, vecs.df, threshold), "a", "b", n)
    rest = Scratch(_across(members.df, near, n), n)
    if not rest.df.isEmpty():
        more = _links(rest.df, marks, vecs.df, threshold)
        near = connected_components(more.unionByName(near.select(F.col("node").alias("a"), F.col("component").alias("b"))), "a", "b", n)
    for t in (rest, vecs, samples, members, distinct):
        t.drop()
    return _classes(own, near)


def _classes(own: DataFrame, near: DataFrame) -> DataFrame:
    """The rows of the result from doc_id and copy, and the components of copies. Sizes are summed over distinct texts first."""
    per = _labelled(own.filter("copy is not null").groupBy("copy").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), near)
    per = saved(per, own.count())
    classes = per.groupBy("c").agg(F.min("first").alias("class_id"), F.sum("n").alias("class_size"))
    named = per.join(classes, "c").select("copy", "class_id", "class_size")
    out = own.filter("copy is not null").join(named, "copy").select("doc_id", "class_id", "class_size")
    out = out.unionByName(own.filter("copy is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size")))
    return out.withColumn("kept", F.col("doc_id") == F.col("class_id"))
