"""Whole Arrow batches of texts as byte arrays: words, shingles and span hashes by numpy.

Every function takes the UTF-8 bytes of several documents laid end to end and the offsets of the
documents in them, so that no step runs once for each row.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
SHINGLE_BITS = 44
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=U64) * U64(2) + U64(1)
_POWERS = [np.ones(1, U64), np.ones(1, U64)]
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def text_bytes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty) and its n + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if lower:
        column = pc.utf8_lower(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of rows of about ``limit`` bytes of text; a longer text stays whole."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to
    give_back()


def give_back() -> None:
    """Returns freed memory to the system, as a worker process outlives its task and waits beside others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64, for i below n."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((BASE, pow(BASE, -1, 2**64))):
            steps = np.full(int(n * 1.25) + 1, base, U64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(_TABLE[data] * up[: len(data)], out=out[1:])
    return out


def prefix_hash_of(symbols: np.ndarray) -> np.ndarray:
    """As prefix_hash, of 64-bit symbols that are well mixed already."""
    up, _ = powers(len(symbols) + 1)
    out = np.zeros(len(symbols) + 1, U64)
    np.cumsum((symbols | U64(1)) * up[: len(symbols)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, the same wherever the span stands."""
    _, down = powers(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and the documents' offsets in them.

    A word is a run of ASCII letters, digits and bytes of other characters; it never crosses documents.
    """
    inside = _WORD[data]
    left, right = np.zeros(len(data), bool), np.zeros(len(data), bool)
    left[1:], right[:-1] = inside[:-1], inside[1:]
    full = offsets[:-1] < offsets[1:]
    left[offsets[:-1][full]] = False
    right[offsets[1:][full] - 1] = False
    starts = np.flatnonzero(inside & ~left)
    return starts, np.flatnonzero(inside & ~right) + 1, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``size`` words and their documents; a shorter document is one shingle."""
    n, counts = len(hashes), np.diff(offsets)
    factors = [pow(BASE, 2 * j + 3, 2**64) for j in range(size)]
    doc = np.repeat(np.arange(len(counts)), counts)
    out, owner = np.empty(0, U64), doc[:0]
    if n >= size:
        whole = np.zeros(n - size + 1, U64)
        for j, f in enumerate(factors):
            whole += hashes[j : n - size + 1 + j] * U64(f)
        keep = np.arange(n - size + 1) + size <= offsets[1:][doc[: n - size + 1]]
        out, owner = mix(whole[keep]), doc[: n - size + 1][keep]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        rest = np.array([sum(int(h) * f for h, f in zip(hashes[offsets[d] : offsets[d + 1]].tolist(), factors, strict=False)) % 2**64 for d in short], U64)
        out, owner = np.concatenate([out, mix(rest)]), np.concatenate([owner, short])
    return out, owner


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of each text, and the documents' offsets in them."""
    data, offsets = text_bytes(column, lower=True)
    starts, ends, at = words(data, offsets)
    return span_hash(prefix_hash(data), starts, ends), at


def distinct_shingles(hashes: np.ndarray, at: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each document, given its words' hashes, its distinct shingles in order: document, 44-bit shingle, count."""
    found, doc = shingles(hashes, at, size)
    both = np.sort((doc.astype(U64) << U64(SHINGLE_BITS)) | (found >> U64(64 - SHINGLE_BITS)))
    first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]]) if len(both) else np.empty(0, np.int64)
    kept = both[first]
    return (kept >> U64(SHINGLE_BITS)).astype(np.int64), kept & U64((1 << SHINGLE_BITS) - 1), np.diff(np.r_[first, len(both)])


def shingle_counts(column: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each document its distinct shingles in order: document, 44-bit shingle, count."""
    return distinct_shingles(*word_hashes(column), size)


def pack_sorted(values: np.ndarray) -> bytes:
    """Integers in order, in about three and a quarter bytes each where they are dense: the low 24 bits of
    each, then the rest in unary (Elias and Fano)."""
    high = (values >> U64(24)).astype(np.int64)
    marks = np.zeros(int(high[-1]) + len(values) + 1 if len(values) else 0, bool)
    marks[high + np.arange(len(values))] = True
    return pack(values & U64((1 << 24) - 1), 3) + np.packbits(marks).tobytes()


def unpack_sorted(data: bytes, n: int) -> np.ndarray:
    marks = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=3 * n)))
    return unpack(data[: 3 * n], 3) | ((marks - np.arange(n)).astype(U64) << U64(24))


def pack(values: np.ndarray, width: int) -> bytes:
    """Integers below 256 ** width, little-endian."""
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, width)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :width] = raw
    return out.reshape(-1).view("<u8").astype(U64)


def squeeze(values: np.ndarray) -> bytes:
    """Integers or half floats, byte plane by byte plane, compressed."""
    kind = values.dtype.newbyteorder("<")
    planes = np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(-1, kind.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + (pa.compress(planes, "zstd", asbytes=True) if planes else b"")


def expand(data: bytes, kind: str) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], size, "zstd", asbytes=True) if size else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)
