"""Exact results where hashes clash, and models against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from ludolake.llm import common, language_id, quality_model, suffix_dedup as S, wordhash as W

MASK = (1 << 64) - 1


def removed(texts):
    """What op8 keeps of each text, by hand."""
    first = {}
    for i, t in enumerate(texts):
        for p in range(len(t) - 49):
            first.setdefault(t[p:p + 50], i)
    out = []
    for i, t in enumerate(texts):
        gone = bytearray(len(t))
        for p in range(len(t) - 49):
            if first[t[p:p + 50]] < i:
                gone[p:p + 50] = b"\1" * 50
        out.append(hashlib.sha256(bytes(x for x, g in zip(t, gone) if not g)).hexdigest())
    return out


def exchanged(texts, n_buckets, ends):
    """The steps of op8 without Spark: what the shuffles bring together."""
    pack = zstandard.ZstdCompressor().compress
    buckets = [pa.table({"doc_id": pa.array(list(range(b, len(texts), n_buckets)), pa.int64()),
                         "text": pa.array([pack(t) for t in texts[b::n_buckets]], pa.binary()),
                         "bucket": pa.array([b] * len(texts[b::n_buckets]), pa.int32())}) for b in range(n_buckets)]

    def by(tables, name, value):
        both = pa.concat_tables(tables)
        return both.filter(pa.compute.equal(both[name], value))
    asked = [S._ask(d, 1) for d in buckets]
    answers = [S._answer(by(asked, "part", 0))]
    runs = [S._runs(d, by(answers, "bucket", b), 1, ends) for b, d in enumerate(buckets)]
    parts = set(pa.concat_tables(runs)["part"].to_pylist())
    found = [S._merge_range(by(runs, "part", p)) for p in parts]
    out = {}
    for b, d in enumerate(buckets):
        rows = S._remove(d, by(found, "bucket", b), False)
        out |= dict(zip(rows["doc_id"].to_pylist(), rows["kept_sha256"].to_pylist()))
    return [out[i] for i in range(len(texts))]


@pytest.mark.parametrize("clash", ["none", "anchor ids", "anchors", "both"])
def test_suffixes_when_short_hashes_clash(monkeypatch, clash):
    rng = random.Random(3)
    prose = lambda n: bytes(rng.choice(b"abcdef ") for _ in range(n))
    shared = [prose(rng.randint(50, 160)) for _ in range(6)]
    texts = [prose(rng.randint(0, 90)) + b"".join(
        rng.choice(shared)[rng.randint(0, 20):] + prose(rng.randint(0, 40)) for _ in range(rng.randint(0, 3)))
        for _ in range(40)] + [shared[0], shared[0], b" " * 300, b" " * 130, b""]
    if clash in ("anchor ids", "both"):
        monkeypatch.setattr(S, "_anchor_ids", lambda anchor, n_parts: anchor & np.uint64(3))
    if clash in ("anchors", "both"):
        monkeypatch.setattr(S._Sent, "anchors", lambda sent: np.zeros(sent.n, np.uint64))
    assert exchanged(texts, 3, [b"b", b"d"]) == removed(texts)


def test_front_coding_by_columns():
    rng = random.Random(9)
    keys = sorted({bytes(rng.choice(b"ab") for _ in range(rng.randint(1, S.LONGEST - 1))) + b"\1" for _ in range(500)})
    rows = np.frombuffer(b"".join(k.ljust(S.LONGEST, b"\0") for k in keys), np.uint8).reshape(-1, S.LONGEST)
    shared, lengths, rest = S.front_code(rows)
    assert np.array_equal(S._decode(shared, lengths, np.frombuffer(rest, np.uint8)), rows)
    run = S.Run(shared.tolist(), lengths.tolist(), rest)
    for k in keys:
        assert run.head == k
        run.step()


def test_rows_without_ids_spread(spark):
    rows = spark.range(4000).select(F.lit(common.NO_ID).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    for by_text in (True, False):
        held = common.dealt(rows, 50, by_text).groupBy("bucket").count().collect()
        assert len(held) == 50 and max(r["count"] for r in held) < 160
    ids = rows.withColumn("doc_id", F.lit(7).cast("long"))
    assert common.dealt(ids, 50).select("bucket").distinct().count() == 50
    assert [r[0] for r in common.dealt(ids, 50, False).select("bucket").distinct().collect()] == [
        r[0] for r in ids.limit(1).select(common.bucket_of(F.col("doc_id"), 50)).collect()]


def test_perplexities_without_ids(spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    rows = [(i, f"plain words in line {i}", "en") for i in range(60)]
    docs = spark.createDataFrame([*rows, *((None, t, "en") for _, t, _ in rows)], "doc_id long, text string, lang string")
    found = quality_model.perplexities(docs, quality_model.trusted(labels)).collect()
    of = {}
    for r in found:
        of.setdefault(bytes(r["digest"]), set()).add(r["perplexity"])
    assert len(found) == 120 and len(of) == 60 and all(len(x) == 1 for x in of.values())


def test_language_id_by_hand(spark):
    rng = random.Random(4)
    alphabet = {"en": "aeinorst ", "de": "aeinrstüß ", "el": "αειονρστ "}
    rows = []
    for i in range(120):
        lang = rng.choice(list(alphabet))
        mixed = alphabet[lang] + (alphabet["en"] if i % 2 else "") + "A1-"
        rows.append((i, "".join(rng.choice(mixed) for _ in range(rng.randint(0, 40))), lang if i % 7 else None))
    rows += [(200, None, "en"), (201, "12 -", "de"), (None, "Αει nor", "el"), (3, "sein", "de")]

    def grams(text):
        kept = [(ord(c) if c.isalpha() else 32, c.isalpha()) for c in (text or "").lower()]
        padded = [(32, False)] * 2 + kept
        out = Counter()
        for at in range(2, len(padded)):
            for n in (1, 2, 3):
                part = padded[at - n + 1:at + 1]
                if any(letter for _, letter in part):
                    code = n
                    # The last character comes first.
                    for point, _ in reversed(part):
                        code = ((code << 21) | point) & MASK
                    out[int(W.mix(np.array([code], np.uint64))[0]) >> (64 - language_id.BITS)] += 1
        return out

    counts, docs = {}, Counter()
    is_held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2
    for i, text, lang in rows:
        if text is not None and lang is not None and not is_held(i):
            counts.setdefault(lang, Counter()).update(grams(text))
            docs[lang] += any(c.isalpha() for c in text.lower())
    names = sorted(docs)
    size = {n: sum(counts[n].values()) + language_id.SMOOTHING * (1 << language_id.BITS) for n in names}
    expected = []
    for i, text, _ in rows:
        if not any(c.isalpha() for c in text or ""):
            expected.append((i, is_held(i), "und", 0.0))
            continue
        log = {n: math.log(docs[n] / sum(docs.values())) + sum(
            k * math.log((counts[n][g] + language_id.SMOOTHING) / size[n]) for g, k in grams(text).items()) for n in names}
        best = max(names, key=lambda n: log[n])
        expected.append((i, is_held(i), best, 1 / sum(math.exp(log[n] - log[best]) for n in names)))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = [tuple(r) for r in language_id.identify(table).collect()]
    order = lambda r: (r[0] is not None, r[0] or 0, r[2], r[3])
    for g, e in zip(sorted(got, key=order), sorted(expected, key=order), strict=True):
        assert g[:3] == e[:3] and abs(g[3] - e[3]) < 1e-9
