"""Ask-and-share exchange: which keys of a bucket also occur elsewhere?

Documents are dealt into buckets (``bucket``, a hash of the document's key).
Each bucket sends its 64-bit keys, sorted and packed, to key ranges (one row
for each bucket and range); a range answers every bucket with those of its
keys that are shared. The rows of one key meet once for each bucket, not once
for each document: copies are counted where they stand. Cost: one pass of the
keys through the shuffle at a few bytes each, compressed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard

from .wordhash import U64

ASK_SCHEMA = "part int, bucket int, n int, body binary"
ANSWER_SCHEMA = "bucket int, body binary"
#: Keys that one range is meant to hold.
RANGE_KEYS = 1 << 18
#: Keys in one row at most, so no row grows with the data.
ROW_KEYS = 1 << 16


def pack(parts: np.ndarray, bucket: int, columns: list[np.ndarray]) -> pa.Table:
    """Rows for ``ASK_SCHEMA``: ``columns`` (fixed-width arrays, ordered by
    ``parts`` and then by the first column, which is sent as differences) cut
    where the part changes and at ``ROW_KEYS``."""
    if not len(parts):
        return empty_ask()
    edges = np.concatenate(([0], np.flatnonzero(np.diff(parts)) + 1, [len(parts)]))
    begins, ends = [], []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        for lo in range(a, b, ROW_KEYS):
            begins.append(lo)
            ends.append(min(b, lo + ROW_KEYS))
    packer = zstandard.ZstdCompressor(level=1)
    body = [packer.compress(b"".join([np.diff(columns[0][a:b], prepend=columns[0].dtype.type(0)).tobytes(),
                                      *(c[a:b].tobytes() for c in columns[1:])]))
            for a, b in zip(begins, ends)]
    n = [b - a for a, b in zip(begins, ends)]
    return pa.table({"part": pa.array(parts[begins], pa.int32()),
                     "bucket": pa.array([bucket] * len(n), pa.int32()),
                     "n": pa.array(n, pa.int32()), "body": pa.array(body, pa.binary())})


def empty_ask() -> pa.Table:
    return pa.table({"part": pa.array([], pa.int32()), "bucket": pa.array([], pa.int32()),
                     "n": pa.array([], pa.int32()), "body": pa.array([], pa.binary())})


def part_of(keys: np.ndarray, n_parts: int) -> np.ndarray:
    """Range of each key; ascending with the key."""
    return ((keys >> U64(32)) * U64(n_parts) >> U64(32)).astype(np.int32)


def unpack(table: pa.Table, dtypes: list) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bucket of every key, and the packed columns, of rows of ASK_SCHEMA."""
    buckets, counts = table["bucket"].to_numpy(), table["n"].to_numpy()
    columns: list[list[np.ndarray]] = [[] for _ in dtypes]
    unpacker = zstandard.ZstdDecompressor()
    for n, body in zip(counts.tolist(), table["body"].to_pylist()):
        body, at = unpacker.decompress(body), 0
        for out, dtype in zip(columns, dtypes):
            out.append(np.frombuffer(body, dtype, n, at))
            at += n * np.dtype(dtype).itemsize
        columns[0][-1] = np.cumsum(columns[0][-1], dtype=dtypes[0])
    cat = [np.concatenate(c) if c else np.zeros(0, d) for c, d in zip(columns, dtypes)]
    return np.repeat(buckets, counts), cat


def answer(buckets: np.ndarray, columns: list[np.ndarray]) -> pa.Table:
    """Rows of ``ANSWER_SCHEMA``: each bucket's share of ``columns``."""
    order = np.argsort(buckets, kind="stable")
    buckets = buckets[order]
    columns = [c[order] for c in columns]
    edges = np.concatenate(([0], np.flatnonzero(np.diff(buckets)) + 1, [len(buckets)])) if len(buckets) else [0]
    out, body = [], []
    packer = zstandard.ZstdCompressor(level=1)
    for a, b in zip(edges[:-1], edges[1:]):
        out.append(int(buckets[a]))
        body.append(packer.compress(b"".join(c[a:b].tobytes() for c in columns)))
    return pa.table({"bucket": pa.array(out, pa.int32()), "body": pa.array(body, pa.binary())})


def read_answers(table: pa.Table, dtypes: list) -> list[np.ndarray]:
    """The columns of all answers to one bucket."""
    width = sum(np.dtype(d).itemsize for d in dtypes)
    columns: list[list[np.ndarray]] = [[] for _ in dtypes]
    unpacker = zstandard.ZstdDecompressor()
    for body in table["body"].to_pylist():
        body, at = unpacker.decompress(body), 0
        n = len(body) // width
        for out, dtype in zip(columns, dtypes):
            out.append(np.frombuffer(body, dtype, n, at))
            at += n * np.dtype(dtype).itemsize
    return [np.concatenate(c) if c else np.zeros(0, d) for c, d in zip(columns, dtypes)]
