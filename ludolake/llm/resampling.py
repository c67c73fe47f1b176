"""Target-distribution importance resampling by hashed n-grams, on Arrow kernels.

A document's features are its runs of 1 to ``order`` consecutive words, each
hashed to a bucket (CRC-32 of its UTF-8 bytes, words joined by one space). Two
bags of buckets are counted, one over all documents and one over the target
texts; the gain of a bucket is the scaled logarithm of the ratio of its two
smoothed shares. A document's weight is the mean gain of its features; adding
Gumbel noise from a hash of its id and taking the highest scores draws without
replacement, with probabilities by weight.

In a task, texts in chunks of bounded size go through ``ascii_lower``,
``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode``. Shifted
dictionary indices, kept inside their document, form the n-grams; each distinct
one gets its CRC once, from the CRCs of its words (a CRC of joined strings is
the first one's, moved on by the second's length, xor the second one's).
``take`` brings buckets and gains back to all features, and segments of them
are summed for each document.

Two passes read the texts: one for the counts (summed in the tasks, then one
row for each bucket and task), one for the weights; only buckets (``buckets``
rows, a parameter) meet on the driver and are sent out. Ranks come from a range
partitioning by score, id and a row number: partitions are counted, their
offsets sent out, and a place inside a partition is the rank, so no task holds
all rows and equal rows are split, too.

Defined cases: a null or empty text has no words, no features and weight 0; a
null id's noise is that of an empty id, and it comes after all ids among equal
scores; repeated rows are drawn one by one, in any order among themselves; an
empty target gives gains against a flat one; empty tables give no rows. Only
the id and the text are read, so other columns, whatever their names, don't
matter. Texts of any length are read whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, sliced

#: Characters that end a word (fixed by the definition of a word).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
ORDER = 2
SEED = 7
MIN_WORDS = 20
PERCENT = 25


def _byte_tables() -> np.ndarray:
    """The register of CRC-32 after a zero byte, by its low byte."""
    reg = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        reg = np.where(reg & 1, (reg >> 1) ^ np.uint32(0xEDB88320), reg >> 1).astype(np.uint32)
    return reg


_ZERO_BYTE = _byte_tables()


def crc_joined(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of joined strings from the CRCs of both, and the second's bytes:
    a CRC is moved on by a length in the steps of the length's binary digits,
    each step four lookups in the tables of that power of two."""
    out, n, power = first.astype(np.uint32), length.copy(), 0
    # Moving on is linear, so a table of each byte of the register will do.
    tables = np.array([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    step = (tables >> np.uint32(8)) ^ _ZERO_BYTE[tables & 0xFF]        # by one byte
    while n.any():
        odd = (n & 1).astype(bool)
        out[odd] = _moved(step, out[odd])
        n >>= 1
        step = _moved(step, step)
        power += 1
    return out ^ second


def _moved(step: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return step[0][crc & 0xFF] ^ step[1][(crc >> 8) & 0xFF] ^ step[2][(crc >> 16) & 0xFF] ^ step[3][crc >> 24]


def features(texts: pa.Array, order: int = ORDER, buckets: int = BUCKETS):
    """``(words of each text, features of each text, [(bucket, text)])``: the
    buckets of all features and the texts they are in, an array pair for each
    length of n-gram."""
    n = len(texts)
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")), SEPARATORS)
    words, text = pc.list_flatten(lists), pc.list_parent_indices(lists)
    some = pc.greater(pc.binary_length(words), 0)
    words, text = words.filter(some), text.filter(some).to_numpy(zero_copy_only=False)
    n_words = np.bincount(text, minlength=n)
    if not len(words):
        return n_words, np.zeros(n, np.int64), []
    coded = words.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    distinct = [w.encode() for w in coded.dictionary.to_pylist()]
    crc = np.fromiter(map(zlib.crc32, distinct), np.uint32, len(distinct))
    after = np.fromiter((zlib.crc32(b" " + w) for w in distinct), np.uint32, len(distinct))
    length = np.fromiter(map(len, distinct), np.int64, len(distinct)) + 1
    out = [((crc % buckets)[index], text)]
    n_features = n_words.copy()
    gram, gram_crc = index, crc           # codes of (k-1)-grams by place, CRC by code
    for k in range(2, order + 1):
        inside = text[k - 1:] == text[:-(k - 1)] if len(text) >= k else np.zeros(0, bool)
        left, right = gram[:len(inside)][inside], index[k - 1:][inside]
        pairs = pc.dictionary_encode(pa.array(left * len(distinct) + right))
        code = pairs.indices.to_numpy(zero_copy_only=False)
        both = pairs.dictionary.to_numpy(zero_copy_only=False)
        a, b = both // len(distinct), both % len(distinct)
        made = crc_joined(gram_crc[a], after[b], length[b]) if len(both) else np.zeros(0, np.uint32)
        where = text[:len(inside)][inside]
        out.append(((made % buckets)[code], where))
        n_features += np.bincount(where, minlength=n)
        gram = np.full(len(inside), -1, np.int64)
        gram[inside], gram_crc = code, made
    return n_words, n_features, out


def bucket_counts(docs: DataFrame, text: str = "text", order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all texts, repeats counted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in sliced(batches, "text"):
            for bucket, _ in features(batch.column("text"), order, buckets)[2]:
                total += np.bincount(bucket, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], ["bucket", "n"])

    rows = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():     # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket, in thousandths, rounded down."""
    s, t, k = source.astype(float), target.astype(float), len(source)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + k) / ((s + 1) * (t.sum() + k)))).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text",
            order: int = ORDER) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_words``, ``n_features``
    and ``weight``, the mean gain rounded down (0 without features)."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = pa.array(sent.value)
        for batch in sliced(batches, "text"):
            n_words, n, found = features(batch.column("text"), order, len(sent.value))
            total = np.zeros(batch.num_rows, np.int64)
            for bucket, where in found:       # texts are in order: segments
                if len(where):
                    begin = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
                    each = of.take(pa.array(bucket)).to_numpy(zero_copy_only=False)
                    total[where[begin]] += np.add.reduceat(each, begin)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words.astype(np.int64)), pa.array(n.astype(np.int64)),
                 pa.array(np.where(n > 0, total // np.maximum(n, 1), 0))], ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
                                "n_words long, n_features long, weight long")


def _noise(seed: int):
    """Gumbel noise in thousandths, from a hash of the id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
                                .cast("binary"), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(scored: DataFrame, eligible, percent: int) -> DataFrame:
    """``scored`` (doc_id, score, ...) with ``rank``: 1, 2, 3... by falling
    score and rising id for the drawn rows, null for all others."""
    rows = cut(scored.withColumn("eligible", F.coalesce(eligible, F.lit(False))))
    drawn = percent * rows.filter("eligible").count() // 100
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(rows.filter("eligible").withColumn("row", F.monotonically_increasing_id())
                 .repartitionByRange(n, F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row")
                 .sortWithinPartitions(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row"))
    part = F.spark_partition_id()
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    offset, held = [], 0
    for k in range(max(sizes, default=-1) + 1):   # one entry for each shuffle partition
        offset.append(held)
        held += sizes.get(k, 0)
    starts = F.array(*[F.lit(x).cast("long") for x in offset]) if offset else F.array(F.lit(0).cast("long"))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    out = placed.withColumn("rank", F.get(starts, part) + place + 1)
    out = out.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    others = rows.filter("NOT eligible").withColumn("rank", F.lit(None).cast("long"))
    return out.select(*others.columns).unionByName(others).drop("eligible")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text",
             target_text: str = "text", order: int = ORDER, buckets: int = BUCKETS, seed: int = SEED,
             min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_words``, ``n_features``,
    ``weight``, ``score`` and ``rank`` (null: not drawn). ``percent`` of the
    documents of at least ``min_words`` words are drawn."""
    gain = gains(bucket_counts(docs, text, order, buckets), bucket_counts(target, target_text, order, buckets))
    scored = weights(docs, gain, doc_id, text, order).withColumn("score", F.col("weight") + _noise(seed))
    return ranked(scored, F.col("n_words") >= min_words, percent)


def digest(resampled: DataFrame) -> DataFrame:
    return resampled.select("doc_id", "n_features", "weight", "score", "rank")


# (crc32 by a table of bytes, built by its polynomial.)
ORACLE = r"""
WITH RECURSIVE shifted AS (
  SELECT range AS byte, CAST(range AS UBIGINT) AS c, 0 AS k FROM range(256)
  UNION ALL
  SELECT byte, CASE WHEN c % 2 = 1 THEN xor(c // 2, CAST(3988292384 AS UBIGINT)) ELSE c // 2 END, k + 1
  FROM shifted WHERE k < 8),
crc AS (SELECT list(c ORDER BY byte) AS t FROM shifted WHERE k = 8),
words AS (
  SELECT kind, row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM (SELECT 0 AS kind, doc_id, text FROM documents UNION ALL SELECT 1, NULL, text FROM benchmark)),
features AS (
  SELECT kind, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
  FROM words),
counts AS (SELECT kind, r, f, count(*) AS n FROM features GROUP BY kind, r, f),
bytes AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM counts)),
steps AS (
  SELECT f, list_reduce(list_transform(range(0, len(h) // 2), lambda i: CAST('0x' || h[2 * i + 1:2 * i + 2] AS UBIGINT)),
    lambda c, b: xor(c // 256, t[CAST(xor(c % 256, b) AS BIGINT) + 1]), CAST(4294967295 AS UBIGINT)) AS c
  FROM bytes, crc),
buckets AS (SELECT f, xor(c, CAST(4294967295 AS UBIGINT)) % 10000 AS bucket FROM steps),
held AS (SELECT kind, r, bucket, sum(n) AS n FROM counts JOIN buckets USING (f) GROUP BY kind, r, bucket),
totals AS (
  SELECT bucket, coalesce(sum(n) FILTER (kind = 0), 0) AS s, coalesce(sum(n) FILTER (kind = 1), 0) AS t
  FROM held GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (sum(s) OVER () + 10000) AS DOUBLE)
           / CAST((s + 1) * (sum(t) OVER () + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM totals),
sums AS (
  SELECT r, sum(n) AS n, sum(n * gain) AS total FROM held JOIN gains USING (bucket) WHERE kind = 0 GROUP BY r),
weights AS (
  SELECT r, doc_id, len(w) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_features,
         CAST(CASE WHEN n > 0 THEN (total - ((total % n) + n) % n) // n ELSE 0 END AS BIGINT) AS weight,
         CAST('0x' || sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), ''))[:8] AS BIGINT) AS h
  FROM words LEFT JOIN sums USING (r) WHERE kind = 0),
scores AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM weights),
drawn AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, 25 * count(*) OVER () // 100 AS quota
  FROM scores WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= quota THEN rank END AS rank
FROM scores LEFT JOIN drawn USING (r)
"""
