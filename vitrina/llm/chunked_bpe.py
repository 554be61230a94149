"""Byte-level BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the bytes cuts a text where its last bits are zero, so equal passages of different
documents are cut alike. A chunk is encoded once, by itself, and kept for all documents that a Python worker
sees. A chunk's ids may be wrong next to its ends, where the cut parts what the tokeniser joins. So every join is
repaired: a window around the cut is encoded again, from a border at its left to one at its right, where a
border is a place at which a visible ASCII character meets ASCII white space. The pre-tokeniser always parts the
text there, whatever lies beyond. The window reaches one border further than it replaces, and its first and last
ids must be those that the chunks have for the same bytes; where they are not, the text's windows reach further, and at
last are the whole text. So the ids are those of the whole text, exactly.

A new chunk is encoded by pieces, which are cut wherever the pre-tokeniser parts what lies around two ASCII characters
(at the end of a word, number or run of signs): a worker keeps the ids of each short piece, and only pieces that it
has not met go to the tokenizers library. No piece is cut inside an added token. Another pre-tokeniser, or added
tokens that take in white space, are given whole chunks.

No shuffle: texts stay where they are read. A dictionary of chunks shared by all executors would move the
corpus twice (chunks out, ids back) to save less encoding than that costs, so reuse is per worker, in a
store of bounded size.

Edge cases: a null or empty text has no ids and decodes to the empty text; special tokens in a text are
found as the tokenizers library does; very long texts are cut like others, one without borders is encoded whole;
equal and repeated rows give a row each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vitrina.llm import arrays as A
from vitrina.llm.tables import texts

U64 = np.uint64
#: Mean bytes of a chunk, as a power of two, and the bytes that decide on a cut.
CHUNK_BITS, GRAM = 10, 16
#: Bytes of text whose chunks a worker keeps.
STORE = 48 << 20
#: Bytes of the longest piece that a worker keeps, and how many of them.
PIECE, PIECES = 32, 400_000
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _ends() -> np.ndarray:
    """By two bytes: whether the first ends a word, number or run of signs, whatever lies around. An apostrophe may go on."""
    letter, digit, visible = np.zeros((3, 256), bool)
    letter[65:91] = letter[97:123] = digit[48:58] = visible[33:127] = True
    sign = visible & ~letter & ~digit
    out = visible[:, None] & _SPACE
    for kind in (letter, digit, sign):
        out |= kind[:, None] & (visible & ~kind)
    out[ord("'")] &= ~letter
    return out.ravel()


_ENDS = _ends()


class Codec:
    """A tokeniser of the tokenizers library, with the chunks encoded so far."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        table = _byte_of_character()
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.bytes_of = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_of[i] = token.encode() if token in special else bytes(table[c] for c in token)
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.bytes_at = np.cumsum(self.lengths) - self.lengths
        self.spelled = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        added = self.tokenizer.get_added_tokens_decoder().values()
        before = json.loads(self.tokenizer.to_str())
        plain = before["normalizer"] is None and (before["pre_tokenizer"] or {}) | {"trim_offsets": True} == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.parted = plain and not any(t.lstrip or t.rstrip or t.single_word or any(c.isspace() for c in t.content) for t in added)
        self.added = re.compile(b"|".join(re.escape(t.content.encode()) for t in added) or b"(?!)")
        self.store: dict[bytes, np.ndarray] = {}
        self.held = 0
        self._new_pieces()

    def _new_pieces(self) -> None:
        """Kept pieces by their number; their ids lie end to end, those of piece i from ``at[i]`` to ``at[i + 1]``."""
        self.pieces: dict[bytes, int] = {}
        self.ids, self.at = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _library(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece as the tokenizers library has them."""
        out = []
        for at in range(0, len(pieces), 2048):
            out += [e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in pieces[at : at + 2048]], add_special_tokens=False)]
        return out

    def _by_pieces(self, chunks: list[bytes]) -> list[np.ndarray]:
        """Ids of each chunk, put together from those of its pieces."""
        raw = b"".join(chunks)
        data = np.frombuffer(raw, np.uint8)
        ends = np.cumsum([0, *map(len, chunks)])
        here = np.zeros(len(data) + 1, bool)
        if len(data):
            here[1:-1] = _ENDS[(data[:-1].astype(np.uint16) << 8) | data[1:]]
        for m in self.added.finditer(raw):
            here[m.start() + 1 : m.end()] = False
        here[ends] = True
        cuts = np.flatnonzero(here)
        pieces = [raw[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        if len(self.pieces) > PIECES:
            self._new_pieces()
        new = sorted(set(pieces).difference(self.pieces), key=len)
        found, first = self._library(new), len(self.pieces)
        ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), np.uint32)])
        at = np.concatenate([self.at, self.at[-1] + np.cumsum([len(x) for x in found], dtype=np.int64)])
        self.pieces.update(zip(new, range(first, first + len(new)), strict=True))
        which = np.fromiter(map(self.pieces.__getitem__, pieces), np.int64, len(pieces))
        counts = at[which + 1] - at[which]
        stops = np.r_[0, np.cumsum(counts)]
        flat = ids[np.arange(stops[-1]) + np.repeat(at[which] - stops[:-1], counts)]
        long = new[bisect_right(new, PIECE, key=len) :]  # the last ones
        for p in long:
            del self.pieces[p]
        self.at = at[: len(self.pieces) + 1]
        self.ids = ids[: self.at[-1]]
        bounds = stops[np.searchsorted(cuts, ends)].tolist()
        return [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def encode(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece; a piece that was seen before is not encoded again."""
        new = [p for p in dict.fromkeys(pieces) if p not in self.store]
        if self.parted and new:
            fresh = dict(zip(new, self._by_pieces(new), strict=True))
        else:
            fresh = {p: np.array(i, np.uint32) for p, i in zip(new, self._library(new), strict=True)}
        size = sum(map(len, fresh))
        if self.held + size > STORE:
            out = [fresh[p] if p in fresh else self.store[p] for p in pieces]
            self.store, self.held = (fresh, size) if size <= STORE else ({}, 0)
            return out
        self.store.update(fresh)
        self.held += size
        return [self.store[p] for p in pieces]

    def forget(self) -> None:
        """Frees the stored chunks, so that a worker that goes on to other stages does not hold them."""
        self.store, self.held = {}, 0
        self._new_pieces()
        A.give_back()

    def decode(self, texts: list[np.ndarray]) -> list[str]:
        """The text of each array of ids: the bytes of all ids, gathered at once, and cut by text."""
        ids = np.concatenate(texts) if texts else np.empty(0, np.int64)
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.bytes_at[ids] - ends + lengths, lengths)
        data = self.spelled[place].tobytes()
        cuts = np.r_[0, ends][np.cumsum([0, *map(len, texts)])].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where chunks begin, and the end: at texts' offsets and where the content says so, on whole characters."""
        n = len(data)
        if n < GRAM:
            return np.unique(offsets)
        rolling = A.span_hash(A.prefix_hash(data), np.arange(n - GRAM + 1), np.arange(GRAM, n + 1))
        wanted = np.flatnonzero(rolling & U64((1 << CHUNK_BITS) - 1) == 0) + GRAM // 2
        whole = np.flatnonzero((data & 0xC0) != 0x80)
        return np.unique(np.concatenate([whole[np.minimum(np.searchsorted(whole, wanted), len(whole) - 1)], offsets]))

    def texts(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each whole text."""
        data, offsets = A.text_bytes(column)
        if not len(data):
            return [np.empty(0, np.uint32)] * len(column)
        cuts, raw = self.cuts(data, offsets), data.tobytes()
        ids = np.concatenate(self.encode([raw[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]))
        ends = np.cumsum(self.lengths[ids])  # chunks lie end to end, and so do the bytes of their ids
        borders = _borders(data)
        out, open_, reach = _by_text(ids, ends, offsets), cuts[~np.isin(cuts, offsets)], 1
        while len(open_):
            windows = _windows(open_, borders, offsets, reach)
            new = self.encode([raw[a:b] for a, b in zip(windows[0].tolist(), windows[3].tolist(), strict=True)])
            agree = _agree(windows, new, ids, ends, offsets)
            owner = np.searchsorted(offsets, windows[0], "right") - 1
            bad = np.unique(owner[~agree])
            self._put(out, windows, new, owner, bad, ids, ends, offsets)
            open_, reach = open_[np.isin(np.searchsorted(offsets, open_, "right") - 1, bad)], 4 * reach
        return out

    def _put(self, out: list, windows: np.ndarray, new: list, owner: np.ndarray, bad: np.ndarray, ids: np.ndarray, ends: np.ndarray, offsets: np.ndarray) -> None:
        """Replaces the ids of texts whose windows all agree."""
        good = np.flatnonzero(~np.isin(owner, bad))
        if not len(good):
            return
        own, first = np.unique(owner[good], return_index=True)
        a, b = windows[0][good], windows[3][good]
        before = np.r_[0, b[:-1]]
        before[first] = offsets[own]
        start, stop = _count(ends, before).tolist(), _count(ends, a).tolist()
        rest, last = _count(ends, np.r_[b[first[1:] - 1], b[-1:]]).tolist(), _count(ends, offsets[own + 1]).tolist()
        for n, (doc, i, j) in enumerate(zip(own.tolist(), first.tolist(), [*first[1:].tolist(), len(good)], strict=True)):
            parts = []
            for k in range(i, j):
                parts += [ids[start[k] : stop[k]], new[good[k]]]
            out[doc] = np.concatenate([*parts, ids[rest[n] : last[n]]])


def _borders(data: np.ndarray) -> np.ndarray:
    """The places where a visible ASCII character meets ASCII white space."""
    return np.flatnonzero((data[:-1] > 32) & (data[:-1] < 127) & _SPACE[data[1:]]) + 1


def _count(ends: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How many ids end at or before each place."""
    return np.searchsorted(ends, places, "right")


def _by_text(ids: np.ndarray, ends: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    at = _count(ends, offsets)
    at[0] = 0
    return [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _windows(cuts: np.ndarray, borders: np.ndarray, offsets: np.ndarray, reach: int) -> np.ndarray:
    """Windows around cuts, four rows: where they begin, the next border there, the last border before their end, the end.

    A window has ``reach`` borders more than it needs at either side, or reaches its text's end; those that meet
    are one.
    """
    doc = np.searchsorted(offsets, cuts, "right") - 1
    low, high = offsets[doc], offsets[doc + 1]
    padded = np.r_[np.full(reach + 1, -1), borders, np.full(reach + 1, offsets[-1] + 1)]
    left, right = np.searchsorted(borders, cuts) + reach, np.searchsorted(borders, cuts, "right") + reach + 1
    a, b = np.maximum(padded[left - reach], low), np.minimum(padded[right + reach], high)
    inner, outer = np.maximum(padded[left - reach + 1], low), np.minimum(padded[right + reach - 1], high)
    apart = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (a[1:] > outer[:-1])])
    last = np.r_[apart[1:] - 1, len(cuts) - 1]
    return np.stack([a[apart], inner[apart], outer[last], b[last]])


def _agree(windows: np.ndarray, new: list[np.ndarray], ids: np.ndarray, ends: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each window's first ids, up to the next border, and its last are those that chunks have for these bytes."""
    sizes = np.array([len(x) for x in new])
    flat, at = np.concatenate(new), np.cumsum(sizes) - sizes
    doc = np.searchsorted(offsets, windows[0], "right") - 1
    good = np.ones(len(new), bool)
    for begin, end, free, back in ((windows[0], windows[1], windows[0] == offsets[doc], False), (windows[2], windows[3], windows[3] == offsets[doc + 1], True)):
        i, j = _count(ends, begin), _count(ends, end)
        whole = ((i == 0) | (ends[i - 1] == begin)) & (j > 0) & (ends[np.maximum(j, 1) - 1] == end)
        n = np.where(free | ~whole, 0, j - i)
        fits = n <= sizes
        n = np.where(fits, n, 0)
        which = np.repeat(np.arange(len(new)), n)
        step = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        its = flat[at[which] + step + (sizes[which] - n[which] if back else 0)]
        wrong = np.unique(which[ids[i[which] + step] != its])
        good &= free | (whole & fits)
        good[wrong] = False
    return good


def _byte_of_character() -> dict[str, int]:
    """The characters by which byte-level BPE writes bytes: printable ones themselves, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec for each worker process and vocabulary file."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (array of int) of each whole text, and whether they decode to it exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = codec(path)
        for batch in A.slices(batches):
            ids = held.texts(batch.column("text"))
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32)
            exact = [x == t for x, t in zip(held.decode(ids), batch.column("text").to_pylist(), strict=True)]
            yield pa.record_batch({"doc_id": batch.column("doc_id").cast(pa.int64()), "n_tokens": pa.array([len(x) for x in ids], pa.int64()), "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), "exact": pa.array(exact, pa.bool_())})
        held.forget()

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, exact boolean")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of each row of ids (null: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = codec(path)
        for batch in batches:
            ids = [np.array(x or [], np.int64) for x in batch.column("ids").to_pylist()]
            out = [t for at in range(0, len(ids), 256) for t in held.decode(ids[at : at + 256])]
            yield pa.record_batch({"doc_id": batch.column("doc_id").cast(pa.int64()), "text": pa.array(out, pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the text decoded from them, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = codec(path)
        for batch in A.slices(batches):
            ids = held.texts(batch.column("text"))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in held.decode(ids)], pa.string()),
                }
            )

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
