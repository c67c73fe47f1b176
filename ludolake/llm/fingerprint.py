"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch holds the ``K`` smallest of a text's distinct five-word shingle
hashes. Sketches of parts merge (``merge``) into the sketch of the union, and
estimate the number of distinct shingles (``distinct``), the resemblance of
two sets (``resemblance``) and how much of one set is inside another
(``containment``). With at most K distinct shingles all of these are exact.

A fingerprint is a sketch as text: the sorted 64-bit hashes, big-endian, in
base 64. Equal texts (and texts of equal shingle sets) have equal fingerprints.

``neighbours`` deals documents into ranges of their id, each range once, so
that a document and the next one in descending order meet in one task; only
the first document of each range travels twice.

Defined cases: null text is empty; an empty set has the empty fingerprint;
two empty sets resemble each other by 1, an empty and another by 0. Of rows
that repeat an id, the smallest text is the one that the document before sees;
all rows of an id see the same next document. A table of one document is its
own next one. A null id counts as smaller than all others. Empty table: empty
result.
"""

from __future__ import annotations

import base64
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as Wd
from pyspark.sql import functions as F

from . import wordhash as W
from .common import BUCKET_BYTES, cut, id_in, id_out, text_bytes

K = 128
SHINGLE = 5
#: Ranges up to which their heads (16 bytes each) are sent to all tasks.
MAX_HEADS = 1_000_000
_RANGE = float(2 ** 64)


def sketch(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest of some hashes, distinct and sorted."""
    if len(hashes) > 4 * k:
        # Repeats can fill the front, so take more until k distinct are there.
        take = 2 * k
        while take < len(hashes):
            low = np.unique(np.partition(hashes, take)[:take])
            if len(low) >= k:
                return low[:k]
            take *= 4
    return np.unique(hashes)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union of two sets."""
    return np.union1d(a, b)[:k]


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[k - 1]) + 1) / _RANGE)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the union that is in both sets."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = merge(a, b, k)
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(union, both, assume_unique=True).sum() / len(union))


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of set a that is in set b."""
    if not len(a):
        return 1.0
    union = merge(a, b, k)
    return min(1.0, resemblance(a, b, k) * distinct(union, k) / distinct(a, k))


def to_text(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)


def sketches(texts: list[str], k: int = K) -> list[np.ndarray]:
    data, offsets = W.text_buffer(pa.array(texts, pa.large_string()))
    out = []
    for i, j in W.slices(offsets):
        hashes, first = W.words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        hashes, first = W.shingles(hashes, first, SHINGLE)
        out += [sketch(hashes[a:b], k) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
    return out


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by as much of the following one."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
           "edited_fingerprint string, near_edited double, near_next double, "
           "next_doc_id long, n_shingles double, contained_in_edited double")


def _compare(rows: pa.Table, k: int) -> pa.Table:
    """Rows of one range, and the first ids of the next one (marked)."""
    rows = rows.sort_by([("turn", "ascending"), ("doc_id", "descending"), ("text", "ascending")])
    ids = rows["doc_id"].to_pylist()
    texts = [t or "" for t in rows["text"].to_pylist()]
    turn = rows["turn"].to_pylist()
    prints = sketches(texts, k)
    n = sum(t == 0 for t in turn)
    following = [0] * n
    ahead = n
    for i in range(n - 1, -1, -1):
        if i + 1 < n and ids[i + 1] != ids[i]:
            ahead = i + 1
        following[i] = ahead
    others = [edited(texts[i], texts[following[i]]) for i in range(n)]
    cut_prints = sketches(others, k)
    return pa.table({
        "doc_id": pa.array(ids[:n], pa.int64()),
        "n_chars": pa.array([len(t) for t in texts[:n]], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in others], pa.string()),
        "fingerprint": pa.array([to_text(a) for a in prints[:n]], pa.string()),
        "edited_fingerprint": pa.array([to_text(a) for a in cut_prints], pa.string()),
        "near_edited": pa.array([resemblance(a, b, k) for a, b in zip(prints, cut_prints)], pa.float64()),
        "near_next": pa.array([resemblance(prints[i], prints[following[i]], k) for i in range(n)], pa.float64()),
        "next_doc_id": pa.array([ids[j] for j in following], pa.int64()),
        "n_shingles": pa.array([distinct(a, k) for a in prints[:n]], pa.float64()),
        "contained_in_edited": pa.array([containment(a, b, k) for a, b in zip(prints, cut_prints)], pa.float64()),
    })


def neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(part, turn, doc_id, text)``: documents in ranges of their id, and in
    each range, with ``turn`` 1, what follows its last document in descending
    order (after the very last, the first)."""
    rows = docs.select(id_in(F.col(doc_id)).alias("doc_id"), F.col(text).alias("text"))
    n = max(1, math.ceil(text_bytes(rows) / BUCKET_BYTES))
    shares = [i / n for i in range(1, n)]
    ends = rows.agg(F.percentile_approx("doc_id", shares, max(10000, 20 * n))).first()[0] if shares else []
    # (A bucketizer wants one inner end at least.)
    splits = [-math.inf, *(sorted({float(x) for x in ends or []}) or [0.0]), math.inf]
    # A bucketizer finds the range by binary search, inside the engine.
    parts = Bucketizer(splits=splits, inputCol="at", outputCol="range")
    rows = (parts.transform(rows.withColumn("at", F.col("doc_id").cast("double")))
            .select(F.col("range").cast("int").alias("part"), F.lit(0).alias("turn"), "doc_id", "text"))
    heads = rows.groupBy("part").agg(F.max("doc_id").alias("doc_id"))
    # One row for each range.
    up = Wd.orderBy("part")
    heads = cut(heads.withColumn("up", F.lead("part").over(up)).withColumn(
        "top", F.max("part").over(Wd.partitionBy(F.lit(0)))).withColumn("low", F.min("part").over(Wd.partitionBy(F.lit(0)))))
    # The head of a range follows the range above; the top one, the lowest.
    heads = heads.select("doc_id", F.coalesce("up", F.col("low")).alias("to"))
    # Sent to the texts if few enough; beyond that, the join deals both out.
    follow = rows.drop("part").join(F.broadcast(heads) if n <= MAX_HEADS else heads, "doc_id").select(
        F.col("to").alias("part"), F.lit(1).alias("turn"), "doc_id", "text")
    return rows.union(follow)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike the
    text's is to the edited text's and to the next document's."""
    out = neighbours(docs, doc_id, text).groupBy("part").applyInArrow(lambda t: _compare(t, k), _SCHEMA)
    return out.withColumn("doc_id", id_out(F.col("doc_id"))).withColumn("next_doc_id", id_out(F.col("next_doc_id")))
