"""Removal of long byte strings that occur more than once (exact substring deduplication).

Every byte covered by a string of ``length`` bytes that also starts anywhere else goes. The work is that
of a difference-cover suffix sort that stops at depth ``length``: name a sample of positions by what
follows them, sort the names and compare neighbours, then settle the other positions by the bytes up to
their sampled position and its name. Two points differ from the textbook algorithm, see the README: the
sample is chosen by content (the least gram hash in each window), which keeps the property a difference
cover is needed for, namely that equal strings meet a sampled position at equal offsets, with a
hundredth of the positions instead of two thirds; and names are 64-bit hashes of strings, so that no
recursion is needed.

Per block of documents (dealt by doc_id) with anchor a of start p the sampled position in [p, p + WINDOW):
1. ``name``: the hash of the bytes behind a; ``span``: that of all strings whose anchor is a, in one.
   Sorted by hash range, equal neighbours are repeats and go back to the blocks they come from.
2. If a span is repeated, so are all its strings; one block sends them on for the others' sake. If only
   its name is, the block sends the hash of each string. Anything else cannot be repeated.
3. Sorted again, equal neighbours are repeated strings; each block removes what they cover.

The same is done with words in place of bytes, for passages of more than 50 words that stand in two documents
at least: they are counted, not removed, and a document's own repeats do not count.

All shuffles but that of the texts are of packed 64-bit hashes, dealt by hash, so copies in any number
never meet in one task: a block sends a hash once, however often it holds it. Blocks and hash ranges are of
about the same size whatever the corpus, and their numbers follow from its bytes.

Edge cases: a null or empty text gives a row of zeros and the hash of no bytes; texts below ``length``
bytes lose nothing; very long texts are a block's piece of their own; repeated rows of one doc_id are documents
of their own; equal strings have no order, every one of them goes; an empty table gives an empty result; further
columns are ignored. Characters may be cut: the result is bytes.
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
from vitrina.llm.tables import shuffle_partitions, texts

U64 = np.uint64
WINDOW, GRAM = 128, 16
#: Words of a passage, and window and gram in words.
PASSAGE, WORD_WINDOW, WORD_GRAM = 51, 40, 4
#: Bytes of text in a block, in a piece of it, and for each hash range.
BLOCK, PIECE, RANGE = 4 << 20, 1 << 20, 64 << 20
#: Kinds of hashes of bytes; those of words are WORDS more.
NAME, SPAN, STRING, WORDS = 0, 1, 2, 8
_SENT = "part int, block int, kind int, n int, hashes binary"
_BACK = "block int, kind int, hashes binary"


class Strings:
    """Strings of ``length`` symbols in documents laid end to end, their anchors and what these stand for."""

    def __init__(self, prefix: np.ndarray, offsets: np.ndarray, length: int, window: int, gram: int):
        self.prefix, self.length, self.window = prefix, length, window
        n, sizes = len(prefix) - 1, np.diff(offsets)
        ok = np.zeros(n + 1, np.int32)
        long = np.flatnonzero(sizes >= length)
        ok[offsets[:-1][long]] += 1
        ok[offsets[1:][long] - length + 1] -= 1
        self.starts = np.flatnonzero(np.cumsum(ok)[:n])
        if not len(self.starts):
            self.anchor = self.low = self.high = self.group = self.doc = self.starts
            return
        grams = n - gram + 1
        least = (A.span_hash(prefix, np.arange(grams), np.arange(gram, n + 1)) & ~U64(0xFFFFFFFF)) | np.arange(grams, dtype=U64)
        wide = 1
        while wide < window:  # least[p] is the least of [p, p + wide)
            step = min(wide, window - wide)
            least = np.minimum(least[: len(least) - step], least[step:])
            wide += step
        anchors = (least[self.starts] & U64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, (anchors[1:] != anchors[:-1]) | (np.diff(self.starts) != 1)])
        self.anchor, self.low = anchors[first], self.starts[first]
        self.high = self.starts[np.r_[first[1:] - 1, len(anchors) - 1]]
        self.group = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(anchors)]))
        self.doc = np.searchsorted(offsets, self.low, "right") - 1

    def names(self) -> np.ndarray:
        return A.span_hash(self.prefix, self.anchor, self.anchor + (self.length - self.window + 1))

    def spans(self) -> np.ndarray:
        return A.span_hash(self.prefix, self.low, self.high + self.length)

    def strings(self, which: np.ndarray) -> np.ndarray:
        starts = self.starts[which]
        return A.span_hash(self.prefix, starts, starts + self.length)

    def covered(self, known: dict[int, np.ndarray]) -> np.ndarray:
        """Which symbols repeated strings cover, given sets of repeated names, spans and strings."""
        out = np.zeros(len(self.prefix), np.int32)
        if len(self.starts):
            gone = _found(self.spans(), known[SPAN])[self.group]
            some = np.flatnonzero(~gone & _found(self.names(), known[NAME])[self.group])
            gone[some] = _found(self.strings(some), known[STRING])
            np.add.at(out, self.starts[gone], 1)
            np.add.at(out, self.starts[gone] + self.length, -1)
        return np.cumsum(out)[:-1] > 0


class Piece:
    """Some documents of a block: strings of bytes, and passages of words."""

    def __init__(self, column: pa.Array, length: int):
        self.data, self.offsets = A.text_bytes(column)
        prefix = A.prefix_hash(self.data)
        self.bytes = Strings(prefix, self.offsets, length, WINDOW, GRAM)
        starts, ends, self.word_offsets = A.words(self.data, self.offsets)
        words = A.prefix_hash_of(A.span_hash(prefix, starts, ends))
        self.words = Strings(words, self.word_offsets, PASSAGE, WORD_WINDOW, WORD_GRAM)

    def kinds(self) -> list[tuple[int, Strings]]:
        return [(0, self.bytes), (WORDS, self.words)]


def _by_document(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The hashes, each once a document."""
    order = np.lexsort((doc, hashes))
    hashes, doc = hashes[order], doc[order]
    return hashes[np.r_[True, (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])]] if len(hashes) else hashes


def _found(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of the hashes are in the sorted array known."""
    if not len(known):
        return np.zeros(len(hashes), bool)
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


def _send(block: int, kind: int, hashes: np.ndarray, parts: int) -> list[tuple]:
    """Rows of one block's hashes in order, by hash range; one that it holds more than once stands twice."""
    ids, counts = np.unique(hashes, return_counts=True)
    ids = np.repeat(ids, np.minimum(counts, 2))
    cuts = np.searchsorted(ids, (np.arange(parts, dtype=np.float64) * (2.0**64 / parts)).astype(U64)).tolist() + [len(ids)]
    return [(r, block, kind, cuts[r + 1] - cuts[r], ids[cuts[r] : cuts[r + 1]].tobytes()) for r in range(parts) if cuts[r] < cuts[r + 1]]


def _repeated(sent: pd.DataFrame) -> pd.DataFrame:
    """What stands more than once among the hashes of a range, for each block that holds it.

    Kind 4 more marks, of spans, those whose strings the block must send: the first block that holds them.
    """
    out = []
    for kind in sorted(set(sent["kind"])):
        rows = sent[sent["kind"] == kind].sort_values("block")
        hashes = np.concatenate([np.frombuffer(x, U64) for x in rows["hashes"]])
        block = np.repeat(rows["block"].to_numpy(), rows["n"])
        order = np.argsort(hashes, kind="stable")
        hashes, block = hashes[order], block[order]
        same = hashes[1:] == hashes[:-1]
        before, after = np.r_[False, same], np.r_[same, False]
        keep = before | after
        code = np.where(before | (kind % WORDS != SPAN), kind, kind + 4)[keep]
        hashes, block = hashes[keep], block[keep]
        order = np.lexsort((code, block))
        hashes, block, code = hashes[order], block[order], code[order]
        cuts = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (code[1:] != code[:-1])]) if len(block) else np.empty(0, np.int64)
        out += [(int(block[i]), int(code[i]), hashes[i:j].tobytes()) for i, j in zip(cuts, np.r_[cuts[1:], len(block)], strict=True)]
    return pd.DataFrame(out, columns=["block", "kind", "hashes"])


def _sets(back: pd.DataFrame, base: int) -> dict[int, np.ndarray]:
    """Sorted hashes by kind; SPAN has all repeated spans, SPAN + 4 those to send."""
    out = {k: np.sort(np.frombuffer(b"".join(back["hashes"][back["kind"] == base + k]), U64)) for k in (NAME, SPAN, STRING, SPAN + 4)}
    out[SPAN] = np.sort(np.concatenate([out[SPAN], out[SPAN + 4]]))
    return out


def remove_repeats(docs: DataFrame, length: int = 400, digest: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, the removed spans, the kept bytes or (digest) their SHA-256, and n_shared_words.

    ``length`` must be over WINDOW + GRAM. Spans are maximal, in bytes, end exclusive. n_shared_words counts the
    words in passages of PASSAGE words that stand in another document as well.
    """
    if length < WINDOW + GRAM:
        raise ValueError(f"length must be at least {WINDOW + GRAM}")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, parts = max(shuffle_partitions(docs.sparkSession), size // BLOCK + 1), max(2, size // RANGE + 1)
    rows = texts(docs).withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int"))

    def pieces(table: pa.Table) -> Iterator[tuple[pa.RecordBatch, Piece]]:
        """A block's documents a few at a time: only hashes are held for all of it."""
        for batch in A.slices(table.to_batches(), limit=PIECE):
            yield batch, Piece(batch.column("text"), length)

    def anchors(key: tuple, table: pa.Table) -> pa.Table:
        found: dict[int, list] = {}
        for _, piece in pieces(table):
            for base, held in piece.kinds():
                for kind, hashes in ((NAME, held.names()), (SPAN, held.spans())):
                    found.setdefault(base + kind, []).append(_by_document(hashes, held.doc) if base else hashes)
        block = int(key[0].as_py())
        return _table([row for kind, hashes in found.items() for row in _send(block, kind, np.concatenate(hashes), parts)])

    def strings(key: tuple, table: pa.Table, back: pa.Table) -> pa.Table:
        if not table.num_rows or not back.num_rows:
            return _table([])
        back = back.to_pandas()
        known = {base: _sets(back, base) for base in (0, WORDS)}
        sent = {base: np.empty(0, U64) for base in known}
        found: dict[int, list] = {base: [] for base in known}
        for _, piece in pieces(table):
            for base, held in piece.kinds():
                if not len(held.starts):
                    continue
                spans = held.spans()
                first = np.zeros(len(spans), bool)
                first[np.unique(spans, return_index=True)[1]] = True
                sends = first & _found(spans, known[base][SPAN + 4]) & ~_found(spans, sent[base])
                sent[base] = np.union1d(sent[base], spans[sends])
                which = (_found(held.names(), known[base][NAME]) & (~_found(spans, known[base][SPAN]) | sends))[held.group]
                hashes = held.strings(which)
                found[base].append(_by_document(hashes, held.doc[held.group[which]]) if base else hashes)
        return _table([row for base, hashes in found.items() if hashes for row in _send(int(key[0].as_py()), base + STRING, np.concatenate(hashes), parts)])

    def kept(key: tuple, table: pa.Table, back: pa.Table) -> pa.Table:
        back, result = back.to_pandas(), []
        known = {base: _sets(back, base) for base in (0, WORDS)}
        for batch, piece in pieces(table):
            covered = piece.bytes.covered(known[0])
            shared = np.r_[0, np.cumsum(piece.words.covered(known[WORDS]))][piece.word_offsets]
            for doc_id, a, b, words in zip(batch.column("doc_id").to_pylist(), piece.offsets[:-1], piece.offsets[1:], np.diff(shared).tolist(), strict=True):
                own = covered[a:b]
                edge = np.flatnonzero(np.diff(np.r_[False, own, False].astype(np.int8))).reshape(-1, 2)
                rest = piece.data[a:b][~own].tobytes() if len(edge) else piece.data[a:b].tobytes()
                result.append((doc_id, int(b - a), int(own.sum()), len(edge), edge.tolist(), hashlib.sha256(rest).hexdigest() if digest else rest, words))
        return _result(result)

    def _result(result: list) -> pa.Table:
        last = pa.field("kept_sha256", pa.string()) if digest else pa.field("kept", pa.binary())
        schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), last, ("n_shared_words", pa.int64())])
        return pa.Table.from_arrays([pa.array([r[i] for r in result], f.type) for i, f in enumerate(schema)], schema=schema)

    by_block = rows.groupBy("block")
    first = by_block.applyInArrow(anchors, _SENT).groupBy("part").applyInPandas(lambda key, sent: _repeated(sent), _BACK)
    second = rows.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(strings, _SENT).groupBy("part").applyInPandas(lambda key, sent: _repeated(sent), _BACK)
    both = first.unionByName(second)
    out = f"doc_id long, n_bytes long, n_removed long, n_spans long, spans array<array<long>>, {'kept_sha256 string' if digest else 'kept binary'}, n_shared_words long"
    return rows.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(kept, out)


def _table(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["part", "block", "kind", "n", "hashes"])
