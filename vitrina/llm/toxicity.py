"""Toxicity by class-conditional Kneser-Ney character models.

Two models of the bytes of lower-cased words, one of toxic and one of ordinary labelled texts, each with
contexts of ORDER - 1 bytes. What a class has not seen it takes, as Kneser-Ney does, from counts of
distinct contexts of the shorter gram, level by level down to BACKOFF bytes, which both classes share; so a rare
expression gets the same backoff probability from both, weighed by how sure each class is of its context. A text's
evidence is the difference of the two log-likelihoods, normalised by length over the whole text and over its worst
words. A logistic curve maps both to a score; it is fitted on labelled texts that the models used for it have not
seen (two folds), on at most ``sample`` of them. The models themselves count all labelled training texts.

Scale: a gram is its eight bytes as a 64-bit integer, so grams never share counts, and the models grow with
the corpus. Texts are read once, in blocks that keep their distinct words and for each text the numbers of its
words. A block sends its distinct grams, with their counts in texts of each kind, to the parts of the models: grams
are dealt by the four bytes before the last, which all that a gram's ratio needs has in common, so each part is counted
and used where it lies, and no model is ever gathered. What returns is a block's ratios, in the order of its
grams, in half precision. All that is sent is packed in byte planes and compressed; the blocks are written once, dealt by
their number, and never moved.

Edge cases: a null or empty text has no evidence and the score of the fitted prior; very long texts are a block of
their own; without toxic or without ordinary training texts the score is the prior share for all; repeated labels of a
doc_id count as toxic if one is; labels without a document and null labels are ignored; a row without doc_id is not held
out; every row of documents, repeated or not, gives a row; equal scores are no tie to break; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm import arrays as A
from vitrina.llm.tables import Bucketed, saved, shuffle_partitions, texts

U64 = np.uint64
ORDER, BACKOFF = 8, 5
DISCOUNT = 0.75
#: Bytes of text in a block, and blocks to a part of the models.
BLOCK, BLOCKS_A_PART = 8 << 20, 3
#: Kinds of labelled texts (2 * fold + toxic) that are toxic and ordinary, for the model of all and for those of texts of fold 0 and 1.
MODELS = (({1, 3}, {0, 2}), ({3}, {2}), ({1}, {0}))
SCORE_AT = 0.7


def held_out() -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fold() -> F.Column:
    return (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) / 2).cast("int")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a block: doc_ids, distinct words, and of each text how many it has, their numbers and their counts."""
    for batch in A.slices(batches, limit=BLOCK):
        yield _made_block(batch)


def _made_block(batch: pa.RecordBatch) -> pa.RecordBatch:
    data, offsets = A.text_bytes(batch.column("text"), lower=True)
    starts, ends, at = A.words(data, offsets)
    _, first, word, n = np.unique(A.span_hash(A.prefix_hash(data), starts, ends), return_index=True, return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")  # frequent words get small numbers, which pack well
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    raw, own = data.tobytes(), first[order]
    words = b"\n".join([raw[a:b] for a, b in zip(starts[own].tolist(), ends[own].tolist(), strict=True)])
    del data, raw, starts, ends, first, own
    pairs = (np.repeat(np.arange(batch.num_rows), np.diff(at)) << 32) | rank[word]
    del word, rank, order, n
    pairs, times = np.unique(pairs, return_counts=True)
    size = np.diff(np.searchsorted(pairs, np.arange(batch.num_rows + 1) << 32))
    number = pairs & 0xFFFFFFFF
    step = np.diff(number, prepend=0)
    begin = np.r_[0, np.cumsum(size)[:-1]][size > 0]
    step[begin] = number[begin]
    row = {"ids": pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("doc_id").cast(pa.int64()))}
    packed = {"words": A.squeeze(np.frombuffer(words, np.uint8)), "size": A.squeeze(size.astype("<u4")), "step": A.squeeze(step.astype("<u4")), "times": A.squeeze(times.astype("<u4"))}
    return pa.record_batch(row | {k: pa.array([x], pa.binary()) for k, x in packed.items()})


class _Block:
    """What a row of _blocks holds."""

    def __init__(self, row: dict):
        words = A.expand(row["words"].as_py(), "<u1").tobytes()
        self.words = words.split(b"\n") if words else []
        self.size, step, self.times = (A.expand(row[k].as_py(), "<u4").astype(np.int64) for k in ("size", "step", "times"))
        before = np.cumsum(step)
        begin = np.r_[0, np.cumsum(self.size)]
        base = np.r_[0, before][begin[:-1]]
        self.word = before - np.repeat(base, self.size)

    def sorted_grams(self, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct grams by part and value, where parts begin in them, and of each gram in the words its place there and its word."""
        gram, owner = grams(self.words)
        seen, place = np.unique(gram, return_inverse=True)
        part = (A.mix(_context(seen, BACKOFF)) % U64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return seen[order], np.searchsorted(part[order], np.arange(parts + 1)), back[place], owner


def _asks(parts: int):
    """A row for each part that a block has grams of: the grams and their counts in texts of each kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield _asked({k: batch.column(k)[i] for k in batch.schema.names}, parts)
        A.give_back()

    return run


def _asked(row: dict, parts: int) -> pa.RecordBatch:
    held = _Block(row)
    gram, cuts, place, owner = held.sorted_grams(parts)
    kinds = np.full(len(held.size), -1, np.int8)
    marks = np.array(row["marks"].as_py() or [], np.int64)
    kinds[marks >> 2] = marks & 3
    kind = np.repeat(kinds, held.size)
    some = [p for p in range(parts) if cuts[p] < cuts[p + 1]]
    out = {"part": pa.array(some, pa.int32()), "block": pa.array([row["block"].as_py()] * len(some), pa.int64())}
    out["gram"] = pa.array([A.squeeze(np.diff(gram[cuts[p] : cuts[p + 1]], prepend=U64(0))) for p in some], pa.binary())
    for k in range(4):
        n = np.bincount(held.word[kind == k], weights=held.times[kind == k], minlength=len(held.words))
        count = np.bincount(place, weights=n[owner], minlength=len(gram)).astype("<u8")
        out[f"n{k}"] = pa.array([A.squeeze(count[cuts[p] : cuts[p + 1]]) for p in some], pa.binary())
    return pa.record_batch(out)


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ORDER bytes that end at each byte of the words, with a space before and after each; and the words' numbers."""
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    data = np.frombuffer(b"".join(b" %b " % w for w in words), np.uint8).astype(U64)
    place = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.zeros(len(data), U64)
    for back in range(min(ORDER, len(data))):
        byte = np.zeros(len(data), U64)
        byte[back:] = data[: len(data) - back]
        byte[place < back] = 0
        out |= byte << U64(8 * back)
    return out, np.repeat(np.arange(len(words)), lengths)


def _short(gram: np.ndarray, n: int) -> np.ndarray:
    """The last n bytes of each gram."""
    return gram & U64((1 << 8 * n) - 1)


def _context(gram: np.ndarray, n: int) -> np.ndarray:
    """The n - 1 bytes before each gram's last."""
    return (gram >> U64(8)) & U64((1 << 8 * (n - 1)) - 1)


def shared_backoff(seen: np.ndarray) -> np.ndarray:
    """Of distinct grams the probability of the last byte that both classes back off to.

    At each level from ORDER - 1 bytes down, a shorter gram counts as often as distinct longer ones end in it.
    """
    levels, longer = [], seen
    for n in range(ORDER - 1, BACKOFF - 1, -1):
        short, which, count = np.unique(_short(longer, n), return_inverse=True, return_counts=True)
        _, context, differ = np.unique(_context(short, n), return_inverse=True, return_counts=True)
        levels.append((which, count, np.bincount(context, weights=count)[context], differ[context]))
        longer = short
    which, count, total, _ = levels.pop()
    p = ((count + 0.5) / (total + 128.0))[which]
    while levels:
        which, count, total, differ = levels.pop()
        p = ((np.maximum(count - DISCOUNT, 0) + DISCOUNT * differ * p) / total)[which]
    return p


def ratios(gram: np.ndarray, counts: list[np.ndarray]) -> np.ndarray:
    """Log-likelihood ratio of two Kneser-Ney models for each gram, a row for each of MODELS.

    ``counts`` has four counts for each gram, one a kind; a gram may stand repeatedly. A gram in neither
    class has the ratio of what its context leaves to others.
    """
    known = np.flatnonzero(np.sum(counts, axis=0) > 0)
    seen, which = np.unique(gram[known], return_inverse=True)
    out = np.zeros((len(MODELS), len(gram)))
    if not len(seen):
        return out
    own = [np.bincount(which, weights=n[known], minlength=len(seen)) for n in counts]
    contexts, context = np.unique(_context(seen, ORDER), return_inverse=True)
    shared = shared_backoff(seen)
    at, c = np.minimum(np.searchsorted(seen, gram), len(seen) - 1), _context(gram, ORDER)
    hit, c_at = seen[at] == gram, np.minimum(np.searchsorted(contexts, c), len(contexts) - 1)
    c_hit = contexts[c_at] == c
    for m, sides in enumerate(MODELS):
        ratio, unseen = np.zeros(len(seen)), np.zeros(len(contexts))
        for sign, kinds in zip((1, -1), sides, strict=True):
            n = np.sum([own[k] for k in sorted(kinds)], axis=0)
            total, differ = (np.bincount(context, weights=x, minlength=len(contexts)) for x in (n, n > 0))
            left = np.where(total > 0, DISCOUNT * differ / np.maximum(total, 1), 1.0)
            ratio += sign * np.log(np.maximum(n - DISCOUNT, 0) / np.maximum(total[context], 1) + left[context] * shared)
            unseen += sign * np.log(left)
        out[m] = np.where(hit, ratio[at], np.where(c_hit, unseen[c_at], 0.0))
    return out


def _part(table: pa.Table) -> pa.Table:
    """The ratios of each block's grams that lie in one part."""
    gram = [np.cumsum(A.expand(x, "<u8"), dtype=U64) for x in table.column("gram").to_pylist()]
    counts = [np.concatenate([A.expand(x, "<u8") for x in table.column(f"n{k}").to_pylist()]).astype(float) for k in range(4)]
    found = ratios(np.concatenate(gram), counts).astype("<f2")
    ends = np.cumsum([len(g) for g in gram])
    packed = [A.squeeze(found[:, a:b].ravel()) for a, b in zip(np.r_[0, ends[:-1]], ends, strict=True)]
    A.give_back()
    return pa.table({"block": table.column("block"), "part": table.column("part"), "ratio": pa.array(packed, pa.binary())})


def evidence(ratio: np.ndarray, lengths: np.ndarray, at: np.ndarray, word: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Two numbers a text, from the ratios, numbers and counts of its words: its mean ratio a byte, and the mean of its two words with the greatest ratio."""
    out = np.zeros((len(at) - 1, 2))
    full = np.flatnonzero(np.diff(at))
    if not len(full):
        return out
    first, length = at[:-1][full], lengths[word] + 2
    out[full, 0] = np.add.reduceat(ratio * times, first) / np.add.reduceat(length * times, first)
    each = ratio / np.sqrt(length)
    order = np.lexsort((-each, np.repeat(np.arange(len(at) - 1), np.diff(at))))
    second = np.where(times[order][first] > 1, first, np.minimum(first + 1, at[1:][full] - 1))
    out[full, 1] = (each[order][first] + np.maximum(each[order][second], 0)) / 2
    return out


def _judged(parts: int):
    """The evidence of each text of a block: by the models of all, and by those that have not seen texts of its fold."""

    def run(key: tuple, block: pa.Table, answers: pa.Table) -> pa.Table:
        held = _Block({k: block.column(k)[0] for k in ("words", "size", "step", "times")})
        gram, _, place, owner = held.sorted_grams(parts)
        answers = answers.sort_by("part")
        got = [A.expand(x, "<f2").reshape(len(MODELS), -1) for x in answers.column("ratio").to_pylist()]
        ratio = np.concatenate(got, axis=1).astype(float) if got else np.zeros((len(MODELS), 0))
        if ratio.shape[1] != len(gram):
            raise ValueError("a block's ratios are not those of its grams")
        word = [np.bincount(owner, weights=r[place], minlength=len(held.words)) for r in ratio]
        lengths = np.array([len(w) for w in held.words], np.int64)
        ids = block.column("ids").combine_chunks().values
        folds = np.array([zlib.crc32(str(i).encode()) % 3 // 2 if i is not None else 0 for i in ids.to_pylist()], np.int64)
        at = np.r_[0, np.cumsum(held.size)]
        each = word[0][held.word]
        crossed = np.stack(word[1:])[np.repeat(folds, held.size), held.word]
        out = {"doc_id": ids}
        for m, r in enumerate((each, crossed)):
            x = evidence(r, lengths, at, held.word, held.times)
            out |= {f"whole{m}": pa.array(x[:, 0]), f"worst{m}": pa.array(x[:, 1])}
        A.give_back()
        return pa.table(out)

    return run


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression, the intercept last, by Newton's method."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _evidence(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id and evidence of every row of docs."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    made = texts(docs).mapInArrow(_blocks, "ids array<long>, words binary, size binary, step binary, times binary").withColumn("block", F.monotonically_increasing_id())
    held = Bucketed(made, "block", max(shuffle_partitions(docs.sparkSession), size // (2 * BLOCK)))
    blocks, parts = held.df, max(12, size // (BLOCKS_A_PART * BLOCK))
    rows = blocks.select("block", F.posexplode("ids").alias("row", "doc_id")).filter(~held_out())
    marks = rows.join(known.filter(~held_out()).hint("merge"), "doc_id").select("block", (4 * F.col("row").cast("long") + 2 * fold() + F.col("toxic")).alias("mark"))
    marked = blocks.drop("ids").join(marks.groupBy("block").agg(F.collect_list("mark").alias("marks")).hint("merge"), "block", "left")
    asks = marked.mapInArrow(_asks(parts), "part int, block long, gram binary, n0 binary, n1 binary, n2 binary, n3 binary")
    answers = asks.groupBy("part").applyInArrow(_part, "block long, part int, ratio binary")
    schema = "doc_id long, " + ", ".join(f"whole{m} double, worst{m} double" for m in range(2))
    found = saved(blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_judged(parts), schema))
    held.drop()
    return found


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (score >= 0.7) of each whole text, and its evidence."""
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    found = _evidence(docs, known)
    total, toxic = known.filter(~held_out()).agg(F.count("*"), F.sum("toxic")).first()
    prior = float(np.clip(toxic / total if total else 0.5, 1e-3, 1 - 1e-3))
    weights = np.array([0.0, 0.0, np.log(prior / (1 - prior))])
    crossed = found.filter(~held_out()).select("doc_id", F.col("whole1").alias("whole"), F.col("worst1").alias("worst"))
    seen = crossed.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).toPandas()
    if seen["toxic"].nunique() == 2:
        weights = logistic(seen[["whole", "worst"]].to_numpy(), seen["toxic"].to_numpy())
    whole, worst = F.col("whole0"), F.col("worst0")
    z = F.lit(float(weights[0])) * whole + F.lit(float(weights[1])) * worst + F.lit(float(weights[2]))
    scored = found.withColumn("score", 1 / (1 + F.exp(-z)))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= SCORE_AT).cast("int").alias("predicted"), whole.alias("whole"), worst.alias("worst"))
