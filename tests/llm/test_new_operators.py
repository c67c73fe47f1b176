"""Importance resampling, whitening, SentencePiece encoding: against brute
force and the library, with nulls, empty, long and repeated rows, empty tables
and extra columns whose names clash with inner ones."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from ludolake.llm import common, resampling, sentencepiece_bpe, whitening

MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DOCS = "doc_id long, text string, n_words int, ids string, rank string, row int, part int, eligible int"


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def doc_rows():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeéß梦1X") for _ in range(rng.randint(1, 6)))
    some = [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(150)]
    some += [None, "", " \n", "one", "é-É", " ".join(word() for _ in range(8000))]
    rows = [(i, t) for i, t in enumerate(some)]
    rows += [(None, some[3]), (None, None), *[(500, some[5])] * 40, (7, some[9])]
    return [(*r, 1, "x", "y", 2, 3, 4) for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(doc_rows(), DOCS).repartition(3)


# ------------------------------------------------------------- resampling
def test_resampling(spark, docs, monkeypatch):
    monkeypatch.setattr(common, "CHUNK_BYTES", 2000)
    target = spark.createDataFrame([("aé b c aé b", 1), (None, 2), ("", 3), ("Zz top ß", 4)], "text string, bucket int")

    def buckets(text):
        w = words(text)
        return [zlib.crc32(x.encode()) % resampling.BUCKETS for x in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]
    s, t = Counter(), Counter()
    for r in doc_rows():
        s.update(buckets(r[1]))
    for r in target.collect():
        t.update(buckets(r["text"]))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000))))
            for b in range(10000)}
    want = []
    for i, text, *_ in doc_rows():
        found = buckets(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        want.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 2**32))),
                     len(words(text))))
    order = sorted((w for w in want if w[4] >= 20), key=lambda w: (-w[3], w[0] is None, w[0] or 0))
    drawn = [w[:4] + (k + 1,) for k, w in enumerate(order[:25 * len(order) // 100])]
    got = [tuple(r) for r in resampling.digest(resampling.resample(docs, target)).collect()]
    assert Counter(g for g in got if g[4] is not None) == Counter(drawn) and len(drawn) > 20
    assert Counter(g[:4] for g in got) == Counter(w[:4] for w in want)
    # Equal rows have ranks of their own, and reruns agree.
    assert sorted(map(str, got)) == sorted(
        map(str, (tuple(r) for r in resampling.digest(resampling.resample(docs, target)).collect())))
    assert resampling.resample(docs.limit(0), target).count() == 0
    assert resampling.resample(docs, target.limit(0)).count() == len(want)


def test_ranks_of_rows_that_all_tie(spark):
    rows = spark.range(4000).select(F.lit(1).cast("long").alias("doc_id"), F.lit(5).cast("long").alias("score"))
    got = resampling.ranked(rows.repartition(4), F.lit(True), 25)
    ranks = [r["rank"] for r in got.collect()]
    assert sorted(r for r in ranks if r) == list(range(1, 1001)) and ranks.count(None) == 3000


def test_joined_crcs():
    rng = random.Random(2)
    pairs = [(rng.randbytes(rng.randint(0, 40)), rng.randbytes(rng.choice([0, 1, 2, 7, 300, 70000]))) for _ in range(60)]
    a, b = (np.array([zlib.crc32(p[k]) for p in pairs], np.uint32) for k in (0, 1))
    got = resampling.crc_joined(a, b, np.array([len(p[1]) for p in pairs]))
    assert got.tolist() == [zlib.crc32(x + y) for x, y in pairs]


def test_longer_ngrams():
    texts = ["a b c d a b c", None, "a", "b c d", "", "x a b c"]
    for order in (1, 3, 4):
        n_words, n, found = resampling.features(pa.array(texts), order, 1000)
        for k, text in enumerate(texts):
            w = words(text)
            want = Counter(zlib.crc32(" ".join(w[i:i + j]).encode()) % 1000
                           for j in range(1, order + 1) for i in range(len(w) - j + 1))
            got = Counter(int(b) for bucket, where in found for b, x in zip(bucket, where) if x == k)
            assert (got, n_words[k], n[k]) == (want, len(w), want.total())


# ---------------------------------------------------------------- whitening
def exact(vectors):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], object)
    dev = x * len(x) - x.sum(0)
    y = (dev / len(x)).astype(float)
    values, vectors = np.linalg.eigh(y.T @ y / len(x))
    return (dev ** 2).sum(1), y, values[::-1], vectors[:, ::-1]


def test_whitening(spark):
    rng = np.random.default_rng(1)
    data = rng.standard_normal((300, 12)) * np.linspace(9, 1, 12) @ np.linalg.qr(rng.standard_normal((12, 12)))[0]
    data = np.vstack([data, data[:1].repeat(100, 0)])
    rows = [(i if i else None, [float(np.float32(c)) for c in v]) for i, v in enumerate(data)]
    bad = [(900, None), (901, [None] * 12), (902, [float("nan")] + [0.0] * 11), (903, [float("inf")] * 12),
           (904, [1.0]), (905, []), (906, [1e300] * 12)]
    df = spark.createDataFrame([(*r, 0, 1, 2) for r in rows + bad],
                               "vec_id long, embedding array<float>, n int, x int, whitened int").repartition(5)
    dev, y, values, vectors = exact([v for _, v in rows])
    got = whitening.digest(whitening.whiten(df, components=5)).collect()
    assert len(got) == 400 * 5
    want = y @ vectors[:, :5] / np.sqrt(values[:5])
    at = {i: k for k, (i, _) in enumerate(rows)}
    table = np.zeros((400, 5))
    for r in got:
        k = at[r["vec_id"]]
        table[k, r["component"] - 1] = r["whitened"]
        assert (r["n"], r["deviation"]) == (400, dev[k]) and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9)
    sign = np.sign((table * want).sum(0))
    assert np.abs(table * sign - want).max() < 1e-8
    # No variance, one row, no rows.
    for few in (df.filter("vec_id = 5"), df.filter("vec_id > 899"), df.limit(0),
                spark.createDataFrame([(1, [2.0, 3.0])] * 4, "vec_id long, embedding array<double>")):
        assert whitening.digest(whitening.whiten(few)).count() == 0


class Dense(whitening.Covariance):
    """The same products from a matrix, to run the solver on hard cases."""

    def __init__(self, v):
        self.v, self.d, self.passes = v, len(v), 0

    def times(self, b):
        self.passes += 1
        return self.v @ b


@pytest.mark.parametrize("values", [np.arange(300, 0, -1.0) ** 2, np.r_[[5.0] * 4, np.linspace(4.9, 1, 296)],
                                    np.r_[1e6, 1e3, 1.0, np.full(297, 1e-3)], np.r_[[7.0] * 10, np.zeros(290)]])
def test_jacobi_davidson_locks_all_pairs_in_a_small_subspace(values):
    q = np.linalg.qr(np.random.default_rng(3).standard_normal((300, 300)))[0]
    v = (q * values) @ q.T
    cov = Dense((v + v.T) / 2)
    found, vectors = whitening.leading_pairs(cov, 6, values.sum())
    assert np.allclose(found, np.sort(values)[::-1][:6], rtol=1e-12, atol=1e-12 * values[0])
    assert np.abs(v @ vectors - vectors * found).max() < 1e-12 * values[0]
    assert np.abs(vectors.T @ vectors - np.eye(6)).max() < 1e-12


def test_deviations_beyond_64_bits():
    x = np.array([[1 << 40, -(1 << 40)]])
    got = whitening._deviations(x, 1 << 30, [5, -5])
    assert got.dtype == object and got.tolist() == [[(1 << 70) - 5, -(1 << 70) + 5]]


# -------------------------------------------------------------- SentencePiece
@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_encode_and_decode(docs, library, monkeypatch):
    monkeypatch.setattr(common, "CHUNK_BYTES", 3000)
    encoded = sentencepiece_bpe.encode(docs, MODEL)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in encoded.collect()) == Counter(
        (r[0], tuple(library.encode(r[1] or ""))) for r in doc_rows())
    decoded = sentencepiece_bpe.decode(encoded, MODEL)
    assert Counter((r["doc_id"], r["decoded"]) for r in decoded.collect()) == Counter(
        (r[0], library.decode(library.encode(r[1] or ""))) for r in doc_rows())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    ids = [(r[0], library.encode(r[1] or "")) for r in doc_rows()]
    assert Counter(tuple(r) for r in sentencepiece_bpe.digest(decoded).collect()) == Counter(
        (i, len(e), sha(",".join(map(str, e))), sha(library.decode(e))) for i, e in ids)
    assert sentencepiece_bpe.digest(sentencepiece_bpe.decode(encoded.limit(0), MODEL)).count() == 0


def encoded_texts(texts):
    m = sentencepiece_bpe.read_model(MODEL)
    index, offsets, (ids, bounds) = sentencepiece_bpe.encode_chunk(m, pa.array(texts, pa.string()))
    index = index.to_pylist()
    return [[x for w in index[offsets[k]:offsets[k + 1]] for x in ids[bounds[w]:bounds[w + 1]].tolist()]
            for k in range(len(texts))]


def test_odd_texts(library):
    rng = random.Random(1)
    parts = ["a", "b", "e", "t", "h", " ", "  ", "▁", "é", "ß", "梦", "\n", "\t", "\0", "😀", "the ", "<s>", "<0x0A>", "aaaa",
             "1", "'", "﻿", "ἡ", "ing", "́", "한"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += [" " * n + x for n in [*range(70), 500, 1001] for x in ("", "a", "﻿", "the", " the")]
    texts += ["a" * 5000, "ab" * 3000, "".join(rng.choice("abcdefgh") for _ in range(9000)), "=" * 3000,
              "-" * 777 + " " * 40, "".join(rng.choice("的一是在不了有和人这中大为上") for _ in range(3000))]
    assert encoded_texts(texts) == [library.encode(t) for t in texts]


def test_decode_any_ids(spark, library):
    rng = random.Random(2)
    lists = [[rng.randrange(32000) if rng.random() < .5 else rng.randrange(300) for _ in range(rng.randint(0, 12))]
             for _ in range(3000)]
    m = sentencepiece_bpe.read_model(MODEL)
    got = sentencepiece_bpe.decode_chunk(m, pa.array([*lists, None], pa.large_list(pa.int32()))).to_pylist()
    assert got == [*(library.decode(x) for x in lists), None]
    with pytest.raises(ValueError):
        sentencepiece_bpe.decode_chunk(m, pa.array([[32000]], pa.large_list(pa.int32())))
