"""Language identification: multinomial naive Bayes over hashed character
n-grams.

A text is lower-cased, characters that aren't letters become spaces, and its
1-, 2- and 3-grams are hashed into ``2 ** BITS`` features; grams that are only
spaces don't count. Training sums feature counts by language over all labelled
documents (sums inside each task, then one aggregation keyed by language and
feature). The matrix of log probabilities has a size fixed by ``BITS`` and the
number of languages, is checked against ``MAX_MATRIX_BYTES`` and broadcast.
Scoring gathers, for whole slices of documents at a time, the matrix rows of
the grams that occur.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
without any labelled document every text is. Equal posteriors: the language
that sorts first. Rows that repeat an id are judged one by one. Other columns
are ignored. Empty table: empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import wordhash as W
from .common import cut

BITS = 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
MAX_MATRIX_BYTES = 256 << 20
UNKNOWN = "und"

_PAD = max(ORDERS) - 1
_letters: list[np.ndarray] = []


def _is_letter(points: np.ndarray) -> np.ndarray:
    if not _letters:  # once in each worker
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)], dtype=bool))
    return _letters[0][points]


def _features(texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For each order, the features and the documents (indices) they are in;
    and which documents have a letter."""
    pad = " " * _PAD
    lowered = [(t or "").lower() for t in texts]
    joined = pad.join(["", *lowered])
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    lengths = np.array([len(t) for t in lowered], np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    at = np.arange(len(owner)) + _PAD * (owner + 1)
    letter = _is_letter(points)
    has = np.bincount(owner, letter[at], len(texts)) > 0
    points = np.where(letter, points, 32).astype(np.uint64)
    features, owners = [], []
    for n in ORDERS:
        gram = np.full(len(at), n, np.uint64)
        some = np.zeros(len(at), bool)
        for j in range(n):
            gram = (gram << np.uint64(21)) | points[at - j]
            some |= letter[at - j]
        features.append((W.mix(gram[some]) >> np.uint64(64 - BITS)).astype(np.int64))
        owners.append(owner[some])
    return features, owners, has


def _slices(texts: list[str | None], limit: int = 1 << 20):
    """Runs of documents of about ``limit`` characters."""
    begin = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t or "") > limit:
            yield begin, i
            begin, total = i, 0
        total += len(t or "")
    if begin < len(texts):
        yield begin, len(texts)


def _count(batches):
    sums: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
        for i, j in _slices(texts):
            names = sorted(set(langs[i:j]))
            code = np.array([names.index(x) for x in langs[i:j]], np.int64)
            features, owners, has = _features(texts[i:j])
            together = np.zeros((len(names), 1 << BITS), np.int64)
            for f, o in zip(features, owners):
                together += np.bincount(code[o] * (1 << BITS) + f, minlength=together.size).reshape(together.shape)
            for k, name in enumerate(names):
                sums[name] = sums.get(name, 0) + together[k]
                docs[name] = docs.get(name, 0) + int(has[code == k].sum())
    for name, row in sums.items():
        found = np.flatnonzero(row)
        yield pa.record_batch([pa.array([name] * (len(found) + 1)), pa.array([*found.tolist(), -1], pa.int32()),
                               pa.array([*row[found].tolist(), docs[name]], pa.int64())],
                              names=["lang", "feature", "n"])


def _packed(counts: pa.Table) -> pa.Table:
    return pa.table({"lang": counts["lang"][:1], "feature": pa.array([counts["feature"].to_numpy().tobytes()], pa.binary()),
                     "n": pa.array([counts["n"].to_numpy().tobytes()], pa.binary())})


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log priors and the matrix (feature, language) of log
    probabilities, from all rows of ``docs`` with a text and a language."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter(
        F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = cut(rows.mapInArrow(_count, "lang string, feature int, n long")
                 .groupBy("lang", "feature").agg(F.sum("n").alias("n")))
    # Feature -1 holds the number of documents.
    priors = {r["lang"]: r["n"] for r in counts.filter("feature = -1 AND n > 0").collect()}
    if len(priors) * (8 << BITS) > MAX_MATRIX_BYTES:
        raise ValueError(f"{len(priors)} languages don't fit the bound of the broadcast matrix")
    names = sorted(priors)
    matrix = np.full((1 << BITS, len(names)), SMOOTHING)
    held = counts.filter(F.col("feature") >= 0).filter(F.col("lang").isin(names))
    # One row for each language, of at most 2 ** BITS features.
    for row in held.groupBy("lang").applyInArrow(_packed, "lang string, feature binary, n binary").collect():
        matrix[np.frombuffer(row["feature"], np.int32), names.index(row["lang"])] += np.frombuffer(row["n"], np.int64)
    prior = np.log(np.array([priors[n] for n in names], float))
    return names, prior - (np.logaddexp.reduce(prior) if names else 0), np.log(matrix / matrix.sum(axis=0))


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (the posterior) of every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def score(batches):
        names, prior, matrix = shared.value
        columns = [np.ascontiguousarray(matrix[:, k]) for k in range(len(names))]
        for batch in batches:
            texts = batch.column("text").to_pylist()
            picked, sure = [], []
            for i, j in _slices(texts):
                features, owners, has = _features(texts[i:j])
                log = np.tile(prior, (j - i, 1))
                for f, o in zip(features, owners):
                    for k, column in enumerate(columns):
                        log[:, k] += np.bincount(o, column[f], j - i)
                if not names:
                    has[:] = False
                    log = np.zeros((j - i, 1))
                best = log.argmax(axis=1)
                weight = 1 / np.exp(log - log.max(axis=1, keepdims=True)).sum(axis=1)
                picked += [names[b] if h else UNKNOWN for b, h in zip(best, has)]
                sure.append(np.where(has, weight, 0.0))
            yield pa.record_batch([batch.column("doc_id"), pa.array(picked, pa.string()),
                                   pa.array(np.concatenate(sure) if sure else [], pa.float64())],
                                  names=["doc_id", "lang_pred", "score"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(score, f"doc_id {kind}, lang_pred string, score double"))


def held_out(doc_id: Column) -> Column:
    """Documents kept from training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Trains on the documents that aren't held out and predicts all."""
    model = train(docs.filter(~held_out(F.col(doc_id))), text, lang)
    return predict(docs, model, doc_id, text).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
