"""Vectorised word and shingle hashing inside Arrow batches.

A batch of texts is one byte buffer with offsets, so words are found and
hashed with whole-array numpy operations. A word's hash is a polynomial over
its bytes modulo 2**64 (per-byte random values, so the letter case fold is a
table entry), finished with a bijective mixer. A shingle's hash combines the
word hashes only, hence the kind and number of separators never matters.

Hash equality stands for equality of the words: two different shingles agree
with probability about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text handled at once; bounds the temporary arrays of a task.
SLICE_BYTES = 4 << 20
#: Words `[^\x20\x09-\x0D]+` (fixed by the operators' definition of a word).
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)


def _byte_values(fold: bool) -> np.ndarray:
    values = np.random.Generator(np.random.PCG64(20240917)).integers(
        1, 1 << 63, size=256, dtype=np.uint64) * U64(2) + U64(1)
    if fold:
        values[ord("A"):ord("Z") + 1] = values[ord("a"):ord("z") + 1]
    return values


EXACT = _byte_values(fold=False)
FOLDED = _byte_values(fold=True)
_powers: dict[str, np.ndarray] = {}


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n (kept between batches)."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 4096)
        for key, base in (("up", _BASE), ("down", _INV)):
            p = np.full(size, U64(base))
            p[0] = 1
            _powers[key] = np.multiply.accumulate(p)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (works in place on a fresh array)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def prefix_sums(data: np.ndarray, values: np.ndarray = EXACT) -> np.ndarray:
    """Polynomial prefix sums of the bytes; see ``span_hash``."""
    up, _ = _powers_to(len(data))
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * up, out=out[1:])
    return out


def span_hash(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Unfinished hash of the bytes begin:end, equal wherever they stand."""
    _, down = _powers_to(len(sums))
    return (sums[end] - sums[begin]) * down[begin]


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a text or binary column (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole documents of about ``limit`` bytes, one at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def _pieces(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges that end at a document's end or, inside a document longer
    than a slice, at a separator: no word crosses them."""
    lo, end = 0, len(data)
    while lo < end:
        hi = lo + SLICE_BYTES
        if hi >= end:
            yield lo, end
            return
        cut = int(offsets[np.searchsorted(offsets, hi, "right") - 1])
        if cut <= lo:
            stop = int(offsets[np.searchsorted(offsets, lo, "right")])
            cut = hi
            while cut < stop:
                found = np.flatnonzero(sep[data[cut:min(stop, cut + 65536)]])
                if len(found):
                    cut += int(found[0])
                    break
                cut = min(stop, cut + 65536)
        yield lo, cut
        lo = cut


def words(data: np.ndarray, offsets: np.ndarray, values: np.ndarray = FOLDED,
          sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the index of each document's first word (one
    more than documents)."""
    hashes, begins = [], []
    for lo, hi in _pieces(data, offsets, sep):
        part = data[lo:hi]
        word = ~sep[part]
        starts = offsets[(offsets >= lo) & (offsets < hi)] - lo
        begin = word.copy()
        begin[1:] &= ~word[:-1]
        begin[starts] = word[starts]
        last = word.copy()
        last[:-1] &= ~word[1:]
        ends = starts[starts > 0] - 1
        last[ends] = word[ends]
        b, e = np.flatnonzero(begin), np.flatnonzero(last) + 1
        sums = prefix_sums(part, values)
        hashes.append(mix(span_hash(sums, b, e) + (e - b).astype(np.uint64)))
        begins.append(b + lo)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(begins), offsets)


_WEIGHTS = np.random.Generator(np.random.PCG64(7)).integers(
    1, 1 << 63, size=64, dtype=np.uint64) * U64(2) + U64(1)


def shingles(word_hashes: np.ndarray, first: np.ndarray, size: int = 5
             ) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle of ``size`` words, in text order, and the index
    of each document's first one. A document of fewer words, but not none,
    has its whole sequence as one shingle."""
    counts = np.diff(first)
    n_shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_first = np.zeros(len(first), np.int64)
    np.cumsum(n_shingles, out=out_first[1:])
    full = np.zeros(max(0, len(word_hashes) - size + 1), np.uint64)
    for j in range(size):
        full += word_hashes[j:j + len(full)] * _WEIGHTS[j]
    inside = np.ones(len(full), bool)
    for j in range(1, size):
        marks = first[1:-1] - j
        inside[marks[(marks >= 0) & (marks < len(full))]] = False
    out = np.zeros(int(out_first[-1]), np.uint64)
    long_doc = np.repeat(counts >= size, n_shingles)
    # Positions inside one document that start a full shingle, in order.
    out[long_doc] = full[inside & _starts_long(first, counts, size, len(full))]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        total = counts[short].astype(np.uint64) * _WEIGHTS[size]
        for j in range(size - 1):
            has = counts[short] > j
            total[has] += word_hashes[first[short[has]] + j] * _WEIGHTS[j]
        out[out_first[short]] = total
    return mix(out), out_first


def _starts_long(first: np.ndarray, counts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Of n positions, those in documents of at least ``size`` words."""
    return np.repeat(counts >= size, counts)[:n]


def unique_sets(hashes: np.ndarray, first: np.ndarray) -> Iterator[np.ndarray]:
    """Each document's distinct hashes, ascending."""
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        x = np.sort(hashes[a:b])
        yield x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) > 1 else x
