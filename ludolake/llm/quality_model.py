"""Quality classifier: perplexity under an n-gram model of trusted text.

The model is an interpolated modified Kneser-Ney model over UTF-8 bytes, each
byte predicted from the four before it (a document starts after four zero
bytes). An n-gram is an integer, so its count, its context and its suffix are
integer keys.

1. One pass over the documents, dealt into buckets with their labels, counts
   the n-grams of each bucket's trusted documents and lists the n-grams that
   the bucket's documents hold. Both are sent once for each bucket, not once
   for each occurrence.
2. Counts are summed by n-gram. Continuation counts of the lower orders,
   context totals, discounts and probabilities follow by joins on n-gram,
   context and suffix. The listed n-grams get their probability by the same
   joins, backing off where a count is missing. All of these tables are
   sharded by key; four counts for each order reach the driver.
3. Every bucket gets the probabilities of its own n-grams back and sums them
   over its documents.

A quarter of the trusted documents is left out of the counts; their
perplexities give each language's threshold, a quantile. The fewer there are of
a language, the less its own quantile says (of a hundred it is the largest one),
and the more counts its median and the spread that all languages share; see
``thresholds``. A document above its language's threshold is rejected.

Defined cases: null or empty text has no perplexity and is kept, as is a
document of a language without trusted documents; null is a language of its
own. Repeated labels of a document count as one (its worst). Rows that repeat
a document id are judged one by one. Texts of any length are read whole. Other
columns stay as they are, whatever their names. Without any trusted document
everything is kept. Empty table: empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash as W
from .common import bucket_of, column, cut, dealt, id_in, id_out, text_bytes, texts, with_key, without

ORDER = 5
QUANTILE = 0.995
#: Held-out documents that a language needs for its own quantile to weigh as
#: much as its median with the spread of all languages.
PRIOR = 200
BUCKET_BYTES = 8 << 20
#: Bytes whose n-grams a task holds at a time (or one document's).
SLICE_BYTES = 1 << 20
#: An n-gram takes 8 bits for each of its bytes, its place in a slice the rest.
PLACE_BITS = 64 - 8 * ORDER
#: Text whose n-gram types one part of the type tables is meant to hold.
PART_BYTES = 64 << 20

_ROWS = "kind int, part int, bucket int, body binary"
_U8, _U64 = np.uint8, np.uint64


def _grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The n-gram that ends at each byte of the documents."""
    pad = ORDER - 1
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    padded = np.zeros(len(data) + pad * n, _U8)
    at = np.arange(len(data)) + pad * np.repeat(np.arange(1, n + 1), lengths)
    padded[at] = data
    out = np.zeros(len(data), _U64)
    for j in range(pad, -1, -1):
        out = (out << _U64(8)) | padded[at - j]
    return out


#: Keys that wait for a merge; what is merged already may be as many.
WAITING = 1 << 19


def _merge(parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of sorted (key, count) lists, merged as they come: most keys are in
    many of them, and a task never holds all lists."""
    def merged(lists):
        keys, inverse = np.unique(np.concatenate([k for k, _ in lists]), return_inverse=True)
        return keys, np.bincount(inverse, np.concatenate([c for _, c in lists]), len(keys)).astype(np.int64)

    held = [(np.zeros(0, _U64), np.zeros(0, np.int64))]
    for part in parts:
        held.append(part)
        if sum(len(k) for k, _ in held[1:]) >= max(WAITING, len(held[0][0])):
            held = [merged(held)]
    return merged(held)


def _distinct(parts: Iterable[np.ndarray]) -> np.ndarray:
    """Sorted distinct keys of all lists, merged as they come."""
    held = [np.zeros(0, _U64)]
    for part in parts:
        held.append(part)
        if sum(map(len, held[1:])) >= max(WAITING, len(held[0])):
            held = [np.unique(np.concatenate(held))]
    return np.unique(np.concatenate(held))


def _planes(values: np.ndarray) -> bytes:
    """The first bytes of all values, then the second ones and so on: most of
    them are alike."""
    return values.view(_U8).reshape(len(values), values.itemsize).T.tobytes()


def _pack(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """Sorted keys as differences, and columns, compressed."""
    each = [np.diff(keys, prepend=_U64(0)), *columns]
    return zstandard.compress(np.int64(len(keys)).tobytes() + b"".join(map(_planes, each)), 3)


def _unpack(body: bytes, *dtypes) -> list[np.ndarray]:
    body = zstandard.decompress(body)
    n, at, out = int(np.frombuffer(body, np.int64, 1)[0]), 8, []
    for d in map(np.dtype, (_U64, *dtypes)):
        planes = np.frombuffer(body, _U8, n * d.itemsize, at).reshape(d.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(d).ravel())
        at += n * d.itemsize
    out[0] = np.cumsum(out[0])
    return out


def _sorted_types(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams in order, how often each occurs, and all places in the
    order of their n-grams. N-gram and place share a word: one plain sort."""
    word = (grams << _U64(PLACE_BITS)) | np.arange(len(grams), dtype=_U64)
    word.sort()
    places = (word & _U64((1 << PLACE_BITS) - 1)).astype(np.int64)
    word >>= _U64(PLACE_BITS)
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    return word[first], np.diff(first, append=len(word)), places


def _part(keys: np.ndarray, n_parts: int) -> np.ndarray:
    return (W.mix(keys) % _U64(n_parts)).astype(np.int64)


def _gather(docs: pa.Table, labels: pa.Table, n_parts: int) -> pa.Table:
    rows: list[tuple[int, int, int, bytes]] = []
    if docs.num_rows:
        bucket = docs["bucket"][0].as_py()
        trusted = np.isin(docs["doc_id"].to_numpy(zero_copy_only=False),
                          labels.filter(labels["train"])["doc_id"].to_numpy(zero_copy_only=False))
        data, offsets = W.text_buffer(texts(docs["text"]))
        held, counted = [], []
        for i, j in W.slices(offsets, SLICE_BYTES):
            lengths = np.diff(offsets[i:j + 1])
            grams = _grams(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            held.append(np.unique(grams))
            keys, n = np.unique(grams[np.repeat(trusted[i:j], lengths)], return_counts=True)
            counted.append((keys, n))
        asked = _distinct(held)
        keys, n = _merge(counted)
        for kind, k, columns in ((0, keys, (n,)), (1, asked, ())):
            part = _part(k, n_parts)
            for p in np.unique(part).tolist():
                mine = part == p
                rows.append((kind, p, bucket, _pack(k[mine], *(c[mine] for c in columns))))
    kinds, parts, buckets, bodies = zip(*rows) if rows else ((), (), (), ())
    return pa.table({"kind": pa.array(kinds, pa.int32()), "part": pa.array(parts, pa.int32()),
                     "bucket": pa.array(buckets, pa.int32()), "body": pa.array(bodies, pa.binary())})


def _count_part(rows: pa.Table) -> pa.Table:
    keys, counts = _merge(_unpack(b.as_py(), np.int64) for b in rows["body"])
    return pa.table({"g": pa.array(keys.view(np.int64)), "c": pa.array(counts)})


def _asked_part(rows: pa.Table) -> pa.Table:
    held = _distinct(_unpack(b.as_py())[0] for b in rows["body"])
    return pa.table({"g": pa.array(held.view(np.int64)), "part": pa.array(
        [rows["part"][0].as_py()] * len(held), pa.int32())})


def _answer_part(asked: pa.Table, known: pa.Table) -> pa.Table:
    g = known["g"].to_numpy().view(_U64)
    order = np.argsort(g)
    g, cost = g[order], known["cost"].to_numpy()[order].astype(np.float32)
    body = []
    for b in asked["body"]:
        (keys,) = _unpack(b.as_py())
        body.append(_pack(keys, cost[np.searchsorted(g, keys)]))
    return pa.table({"bucket": asked["bucket"], "body": pa.array(body, pa.binary())})


_SCORED = "doc_id long, lang string, n_bytes long, cost double, digest binary"


def _score(docs: pa.Table, answers: pa.Table) -> pa.Table:
    n = docs.num_rows
    total, lengths = np.zeros(n), np.zeros(n, np.int64)
    digests: list[bytes] = []
    if n:
        known = [_unpack(b, np.float32) for b in answers["body"].to_pylist()]
        keys = np.concatenate([k for k, _ in known]) if known else np.zeros(0, _U64)
        cost = np.concatenate([c for _, c in known]) if known else np.zeros(0, np.float32)
        order = np.argsort(keys)
        keys, cost = keys[order], cost[order].astype(np.float64)
        bodies = texts(docs["text"])
        digests = [hashlib.sha256(x).digest() for x in bodies.to_pylist()]
        data, offsets = W.text_buffer(bodies)
        lengths = np.diff(offsets)
        for i, j in W.slices(offsets, SLICE_BYTES):
            if offsets[j] == offsets[i]:
                continue
            grams = _grams(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            owner = np.repeat(np.arange(i, j, dtype=np.int32), lengths[i:j])
            for lo in range(0, len(grams), 1 << PLACE_BITS):
                types, runs, places = _sorted_types(grams[lo:lo + (1 << PLACE_BITS)])
                each = np.repeat(cost[np.searchsorted(keys, types)], runs)
                total += np.bincount(owner[lo + places], each, n)
    return pa.table({"doc_id": docs["doc_id"], "lang": docs["lang"],
                     "n_bytes": pa.array(lengths, pa.int64()), "cost": pa.array(total, pa.float64()),
                     "digest": pa.array(digests, pa.binary())})


# -- the model's tables -------------------------------------------------------

def _discounts(types: DataFrame) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and 3 or more, from the counts of counts."""
    n = types.agg(*(F.sum((F.col("c") == i).cast("long")) for i in range(1, 5))).first()
    n1, n2, n3, n4 = (x or 0 for x in n)
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return tuple(min(max(d, 0.05), i - 0.05) for i, d in enumerate((d1, d2, d3), 1))


def _suffix(order: int):
    """The n-gram of ``order`` that ends a longer one."""
    return F.col("g").bitwiseAND(F.lit((1 << (8 * order)) - 1))


def _tables(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For the orders from 1 up: probabilities (g, p) of the n-grams seen, and
    the weight (h, rest) that each context leaves to the next lower order."""
    types = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        types[k] = cut(types[k + 1].groupBy(_suffix(k).alias("g")).agg(F.count(F.lit(1)).alias("c")))
    out: list[tuple[DataFrame, DataFrame]] = []
    for k in range(1, ORDER + 1):
        d = _discounts(types[k])
        off = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        seen = types[k].withColumn("h", F.shiftright("g", 8)).withColumn("off", off)
        contexts = cut(seen.groupBy("h").agg(F.sum("c").alias("total"), F.sum("off").alias("off_sum"))
                       .select("h", "total", (F.col("off_sum") / F.col("total")).alias("rest")))
        seen = seen.join(contexts, "h")
        own = (F.col("c") - F.col("off")) / F.col("total")
        if k == 1:
            seen = seen.select("g", (own + F.col("rest") / 256).alias("p"))
        else:
            lower = out[-1][0].select(F.col("g").alias("s"), F.col("p").alias("q"))
            seen = (seen.withColumn("s", _suffix(k - 1)).join(lower, "s")
                    .select("g", (own + F.col("rest") * F.col("q")).alias("p")))
        out.append((cut(seen), contexts.select("h", "rest")))
    return out


def _probabilities(asked: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(g, p) of n-grams of the highest order, seen or not."""
    wanted = {ORDER: asked.select("g")}
    for k in range(ORDER - 1, 0, -1):
        wanted[k] = wanted[k + 1].select(_suffix(k).alias("g")).distinct()
    lower = None
    for k in range(1, ORDER + 1):
        seen, contexts = tables[k - 1]
        got = (wanted[k].join(seen, "g", "left").withColumn("h", F.shiftright("g", 8))
               .join(contexts, "h", "left"))
        rest = F.coalesce("rest", F.lit(1.0))
        if lower is None:
            got = got.select("g", F.coalesce("p", rest / 256).alias("p"))
        else:
            got = (got.withColumn("s", _suffix(k - 1)).join(lower, "s")
                   .select("g", F.coalesce("p", rest * F.col("q")).alias("p")))
        lower = cut(got).select(F.col("g").alias("s"), F.col("p").alias("q"))
    return lower.select(F.col("s").alias("g"), F.col("q").alias("p"))


def trusted(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, train)`` of the labelled documents of good quality that
    aren't toxic; a quarter, by hash, is kept for the thresholds."""
    return (labels.groupBy(F.col(doc_id).cast("long").alias("doc_id"))
            .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
            .filter("quality = 1 AND toxic = 0 AND doc_id IS NOT NULL")
            .select("doc_id", (F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(4)) != 0).alias("train")))


def perplexities(docs: DataFrame, good: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 lang: str = "lang") -> DataFrame:
    """``(doc_id, lang, n_bytes, perplexity)`` of every row, and the ``digest``
    of its text, by the model of the documents in ``good`` (``trusted``) marked
    ``train``."""
    size = text_bytes(docs, text)
    n_buckets = max(1, math.ceil(size / BUCKET_BYTES))
    n_parts = max(1, math.ceil(size / PART_BYTES))
    rows = docs.select(id_in(column(doc_id)).alias("doc_id"), column(lang).alias("lang"),
                       column(text).alias("text"))
    sent = dealt(rows, n_buckets, by_text=False)  # to meet its label
    marks = good.withColumn("bucket", bucket_of(F.col("doc_id"), n_buckets))
    gathered = cut(sent.groupBy("bucket").cogroup(marks.groupBy("bucket"))
                   .applyInArrow(lambda d, g: _gather(d, g, n_parts), _ROWS))
    counts = cut(gathered.filter("kind = 0").groupBy("part").applyInArrow(_count_part, "g long, c long"))
    asks = gathered.filter("kind = 1").select("part", "bucket", "body")
    asked = cut(asks.groupBy("part").applyInArrow(_asked_part, "g long, part int"))
    p = _probabilities(asked, _tables(counts))
    known = cut(asked.join(p, "g").select("part", "g", (-F.log2("p")).alias("cost")))
    answers = (asks.groupBy("part").cogroup(known.groupBy("part"))
               .applyInArrow(_answer_part, "bucket int, body binary"))
    scored = cut(sent.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(_score, _SCORED))
    return scored.select(id_out(F.col("doc_id")).alias("doc_id"), "lang", "n_bytes", F.when(
        F.col("n_bytes") > 0, F.pow(F.lit(2.0), F.col("cost") / F.col("n_bytes"))).alias("perplexity"), "digest")


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, **columns) -> DataFrame:
    """``doc_id``, ``lang``, ``n_bytes``, ``perplexity``, the ``threshold`` of
    its language and ``keep`` of every row."""
    return _judged(docs, labels, quantile, **columns).drop("digest")


def _judged(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, **columns) -> DataFrame:
    good = cut(trusted(labels))
    scored = perplexities(docs, good, **columns)
    known = cut(scored.join(good, "doc_id").filter("perplexity IS NOT NULL").select(
        F.col("lang").alias("_lang"), "train", F.log("perplexity").alias("x")))
    own = thresholds(known, quantile)
    return (scored.join(own, F.col("lang").eqNullSafe(F.col("_lang")), "left")
            .select("doc_id", "lang", "n_bytes", "perplexity", "threshold",
                    F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("keep"), "digest"))


def thresholds(known: DataFrame, quantile: float, prior: int = PRIOR) -> DataFrame:
    """``(_lang, threshold)`` from the log perplexities ``(_lang, train, x)`` of
    the trusted documents: the language's own quantile of held-out documents,
    and its median raised by what all languages' documents exceed their own
    medians by at that quantile, weighed as n to ``prior``. A language without
    held-out documents takes the quantile over all of them (over all trusted
    ones where none is held out)."""
    held = known.filter("NOT train")
    each = held.groupBy("_lang").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("x", 0.5, 10000).alias("middle"),
                                     F.percentile_approx("x", quantile, 10000).alias("own"))
    over = held.join(each.select(F.col("_lang").alias("_of"), "middle"), F.col("_lang").eqNullSafe(F.col("_of")))
    above, every = over.agg(F.percentile_approx(F.col("x") - F.col("middle"), quantile, 10000),
                            F.percentile_approx("x", quantile, 10000)).first()
    if every is None:
        every = known.agg(F.percentile_approx("x", quantile, 10000)).first()[0]
    weight = F.col("n") / (F.col("n") + prior)
    blend = weight * F.col("own") + (1 - weight) * (F.col("middle") + F.lit(above).cast("double"))
    langs = known.select("_lang").distinct()
    each = each.select(F.col("_lang").alias("_of"), blend.alias("blend"))
    return (langs.join(each, F.col("_lang").eqNullSafe(F.col("_of")), "left")
            .select("_lang", F.exp(F.coalesce("blend", F.lit(every).cast("double"))).alias("threshold")))


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
              lang: str = "lang", **how) -> DataFrame:
    """``docs`` without the rejected ones, each row by its own text and
    language."""
    keyed, key = with_key(docs, doc_id, text, lang)
    gone = (_judged(docs, labels, doc_id=doc_id, text=text, lang=lang, **how).filter("NOT keep")
            .select(F.struct(F.col("doc_id").alias("id"), "digest", F.col("lang").alias("more_0"))).distinct())
    return without(keyed, key, gone)
