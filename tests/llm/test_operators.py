"""The training-data operators against brute-force versions, on a small table
with nulls, empty and long texts, ties, repeated rows and extra columns."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludolake.llm import (decontaminate, fingerprint, language_id, mixing, ngram_join, quality_model,
                          secret_scan, suffix_dedup, url_rules, warc, wordhash as W)
from ludolake.llm.components import components

SPACE = "[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket string, comp long"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    base = [prose(rng.randint(1, 120)) for _ in range(25)]
    passage = prose(60)
    near = []
    for t in base[:8]:
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        near.append(" ".join(w))
    return (base + near + base[3:6] + [t.upper() for t in base[8:10]]
            + [f"{prose(5)} {passage} {prose(7)}" for _ in range(4)]
            + [None, "", " \n\t", "one", "one two", "ONE  two", prose(20000)])


@pytest.fixture(scope="module")
def rows():
    langs, sources = ["en", "fr", None], ["b", "a", None, "c"]
    out = [(i, t, langs[i % 3], sources[i % 4] if i % 3 else "b", len(t or ""), "x", 1)
           for i, t in enumerate(texts())]
    return [*out, (None, "text without an id", "en", "a", 18, "x", 1)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_words_and_shingles(rows):
    import pyarrow as pa
    data, offsets = W.text_buffer(pa.array([r[1] for r in rows], pa.string()))
    found, ids = W.shingles(*W.words(data, offsets)), {}
    for k, r in enumerate(rows):
        w = re.findall(SPACE, lower(r[1]))
        want = [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []
        got = found[0][found[1][k]:found[1][k + 1]].tolist()
        assert len(got) == len(want) and all(ids.setdefault(x, y) == y for x, y in zip(want, got))


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_mixing(docs, rows, empty):
    got = mixing.taken(docs, shard_words=2000)
    found = got.collect()
    assert sorted(map(str, found)) == sorted(map(str, mixing.taken(docs, shard_words=2000).collect()))
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in rows)
    size = Counter()
    for r in rows:
        size[r[3]] += len(re.findall(SPACE, r[1] or ""))
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, left, free = {}, sum(size.values()), set(order)
    while free:                 # share by weight, cap, share the excess again
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * size[s] + 1e-9}
        for s in over or free:
            target[s] = 3 * size[s] if over else level * weight[s]
        left -= sum(target[s] for s in over)
        free = free - over if over else set()
    taken = Counter()
    for r in found:
        assert r["source_size"] == size[r["source"]] and r["taken"] <= 3 * r["size"]
        assert r["target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] += r["taken"]
    largest = max(r["size"] for r in found)
    assert all(abs(taken[s] - target[s]) <= (largest if s == "b" else 120) for s in order), (taken, target)
    assert mixing.taken(empty).count() == 0
    mixed = mixing.mixed_documents(docs, shard_words=2000)
    assert {"shard", "position", "copy", *docs.columns} == set(mixed.columns)


def test_splitting_tree_is_hypergeometric(spark):
    quotas = spark.createDataFrame([(1, 40), (2, 25), (3, 0), (4, 15)], "rank long, quota long")
    left = []
    for seed in range(40):
        cells = mixing.split(quotas, 4, seed).collect()
        per_shard, per_rank = Counter(), Counter()
        for r in cells:
            per_shard[r["shard"]] += r["quota"]
            per_rank[r["rank"]] += r["quota"]
        assert per_rank == {1: 40, 2: 25, 4: 15} and set(per_shard.values()) == {20}
        left += [r["quota"] for r in cells if r["shard"] == 0 and r["rank"] == 1]
    # 20 of 80 drawn, 40 good: mean 10, deviation about 1.95.
    assert abs(np.mean(left) - 10) < 1.2 and 1.2 < np.std(left) < 2.8


def test_fingerprints(docs, rows, empty, monkeypatch):
    monkeypatch.setattr(fingerprint, "BUCKET_BYTES", 20000)
    got = by_id(fingerprint.fingerprints(docs))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    assert len(got) == len(rows)
    for i, r in enumerate(order):
        text, after = r[1] or "", order[(i + 1) % len(order)][1] or ""
        n = len(text) // 3
        new = text[:len(text) - n] + after[:n]
        row = got[r[0]]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()

        def grams(t):
            w = re.findall(SPACE, lower(t))
            return {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        a, b = grams(text), grams(new)
        exact = len(a & b) / len(a | b) if a and b else float(len(a) == len(b))
        assert row["near_edited"] == pytest.approx(exact, abs=1e-9 if len(a | b) <= fingerprint.K else 0.2)
        assert row["n_shingles"] == pytest.approx(len(a), rel=0.3)
    a, b = (np.sort(np.random.default_rng(i).integers(0, 1 << 60, 500).astype(np.uint64)) for i in (1, 2))
    assert (fingerprint.merge(fingerprint.sketch(a), fingerprint.sketch(b))
            == fingerprint.sketch(np.concatenate((a, b)))).all()
    assert (fingerprint.from_text(fingerprint.to_text(a)) == a).all()
    assert fingerprint.fingerprints(empty).count() == 0


def _brute_kneser_ney(train, tests, order=5):
    """Perplexities by the textbook recursion over byte strings."""
    pad = b"\0" * (order - 1)
    counts = {order: Counter((pad + t)[i:i + order] for t in train for i in range(len(t)))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discount, context = {}, {}
    for k, c in counts.items():
        n = Counter(c.values())
        if not n[1] or not n[2]:
            discount[k] = [0.5, 0.75, 0.9]
        else:
            y = n[1] / (n[1] + 2 * n[2])
            two = 2 - 3 * y * n[3] / n[2]
            d = (1 - 2 * y * n[2] / n[1], two, 3 - 4 * y * n[4] / n[3] if n[3] else two)
            discount[k] = [min(max(x, 0.05), i - 0.05) for i, x in enumerate(d, 1)]
        for g, x in c.items():
            total, off = context.get((k, g[:-1]), (0, 0.0))
            context[k, g[:-1]] = total + x, off + discount[k][min(x, 3) - 1]

    def p(g):
        k = len(g)
        if not k:
            return 1 / 256
        if (k, g[:-1]) not in context:
            return p(g[1:])
        total, off = context[k, g[:-1]]
        x = counts[k].get(g, 0)
        return ((x - discount[k][min(x, 3) - 1]) / total if x else 0) + off / total * p(g[1:])
    return [2 ** (-sum(np.log2(p((pad + t)[i:i + order])) for i in range(len(t))) / len(t)) for t in tests]


def test_quality_model(spark, docs, rows, empty):
    labels = spark.createDataFrame([(i, 1 if i % 5 else 0, int(i % 11 == 0), "y") for i in range(45)] + [(3, 0, 0, "y")],
                                   "doc_id long, quality int, toxic int, bucket string")
    good = quality_model.trusted(labels).cache()
    train = {r["doc_id"] for r in good.filter("train").collect()}
    assert 3 not in train and train <= {i for i in range(45) if i % 5 and i % 11}
    got = by_id(quality_model.perplexities(docs, good))
    tests = [r for r in rows if r[1] and len(r[1]) < 2000]
    want = _brute_kneser_ney([r[1].encode() for r in rows if r[0] in train and r[1]], [r[1].encode() for r in tests])
    for r, x in zip(tests, want):
        assert got[r[0]]["perplexity"] == pytest.approx(x, rel=1e-4)
    kept = by_id(quality_model.classify(docs, labels))
    assert len(kept) == len(rows) and all(kept[r[0]]["keep"] for r in rows if not r[1])
    assert quality_model.classify(empty, labels).count() == 0
    nothing = quality_model.classify(docs, labels.limit(0))
    assert nothing.filter("NOT keep").count() == 0 and nothing.count() == len(rows)


def test_url_rules(spark):
    urls = [None, "", "abc", "HTTP://A.Org/x", "x://org", "a://b.org?x/", "s://EXAMPLE.org/en/12#a",
            "s://com/fr/://org/", "://x.com/de/", "http://xexample.org/es/", "http://m.example.org/es/9"]
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)] * 2, "page_id long, url string, host int")
    labelled = spark.createDataFrame(
        [(f"http://spam.net/{i}", True) for i in range(60)] + [(f"http://good{i % 7}.net/{i}", False) for i in range(200)],
        "url string, bad boolean")
    rules = url_rules.mine(labelled).cache()
    assert [r["items"] for r in rules.collect()] in ([["host=spam"]], [["site=spam.net"]]) or rules.count() == 2
    got = url_rules.judge(pages, rules).collect()
    assert len(got) == 2 * len(urls)

    def brute(u):
        rest = (u or "").partition("://")[2] if "://" in (u or "") else ""
        host = lower(re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        best = ""
        for verdict, rule in url_rules.LIST_RULES:
            d, _, p = rule.partition("/")
            if (host == d or host.endswith("." + d)) and path.startswith("/" + p) and len(rule) > len(best):
                best = rule
        return host, path, best or None, dict((b, a) for a, b in url_rules.LIST_RULES).get(best, "allow")
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(urls[r["page_id"]])
    more = spark.createDataFrame([(1, "https://www.spam.net/x"), (2, "https://good1.net/x")], "page_id long, url string")
    assert {r["page_id"]: r["verdict"] for r in url_rules.judge(more, rules).collect()} == {1: "block", 2: "allow"}
    assert url_rules.mine(labelled.limit(0)).count() == 0


def test_language_id(spark, empty):
    rng = random.Random(2)
    vocab = {"en": ["the", "and", "thing", "with"], "de": ["der", "und", "schön", "nicht"]}
    rows = [(i, " ".join(rng.choice(vocab[l]) for _ in range(30)), l if i % 9 else None)
            for i in range(200) for l in [rng.choice(["en", "de"])]]
    truth = {i: t for i, t, _ in rows}
    docs = spark.createDataFrame([*rows, (500, None, "en"), (501, "12 - !", "de"), (502, "", None)],
                                 "doc_id long, text string, lang string")
    got = by_id(language_id.identify(docs))
    assert len(got) == 203 and all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (500, 501, 502))
    for i, t in truth.items():
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert got[i]["lang_pred"] == ("en" if any(w in t.split() for w in vocab["en"]) else "de")
        assert 0 <= got[i]["score"] <= 1
    assert language_id.identify(empty).count() == 0


def test_ngram_join(docs, rows, empty, monkeypatch):
    monkeypatch.setattr(ngram_join, "GROUP_SETS", 4)
    monkeypatch.setattr(ngram_join, "BUCKET_BYTES", 4000)
    sets = {}
    for r in rows:
        w = re.findall(SPACE, lower(r[1]))
        sets[r[0]] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    key = lambda x: (x is not None, x or 0)
    ids = sorted(sets, key=key)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)), key=key)
                root[y] = x
    got = by_id(ngram_join.jaccard_components(docs))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == {
        i: (len(sets[i]), find(i)) for i in ids}
    kept = {r["doc_id"] for r in ngram_join.keep_one(docs).collect()}
    assert kept == {i for i in ids if find(i) == i}
    assert ngram_join.jaccard_components(empty).count() == 0


def test_decontaminate(spark, docs, rows, empty):
    item = re.findall(SPACE, rows[2][1])
    bench = spark.createDataFrame([(10, rows[40][1], 1), (9, " ".join(item[:12]), 1), (8, "one two", 1), (7, None, 1),
                                   (6, "", 1), (9, " ".join(item[:12]), 1)], "item_id long, text string, w int")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = {}
    for i, t, _ in bench.collect():
        w = split(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add(str(i))
    got = by_id(decontaminate.digest(decontaminate.scan(docs, bench)))
    for r in rows:
        w, hit, items = split(r[1]), set(), set()
        for n in {len(g) for g in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    items |= windows[tuple(w[k:k + n])]
        row = got[r[0]]
        assert (row["n_words"], row["n_hit"], row["n_items"], row["contaminated"]) == (
            len(w), len(hit), len(items), bool(hit))
        assert row["items_sha256"] == hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    joined = decontaminate.digest(decontaminate.scan(docs, bench, max_set=2))     # by the table of keys
    assert sorted(map(str, joined.collect())) == sorted(map(str, got.values()))
    clean = decontaminate.remove_spans(docs, bench)
    assert clean.count() == len(rows) and clean.columns == docs.columns
    assert {r["doc_id"]: split(r["text"]) for r in clean.collect()}[2] != split(rows[2][1])
    assert decontaminate.scan(clean, bench.filter("item_id > 8")).filter("n_hit > 0").count() == 0
    left = {r["doc_id"] for r in decontaminate.remove_documents(docs, bench).collect()}
    assert left == {i for i, r in got.items() if not r["contaminated"]}
    assert decontaminate.scan(empty, bench).count() == 0 and decontaminate.scan(docs, bench.limit(0)).filter("n_hit > 0").count() == 0


def test_suffix_dedup(docs, rows, empty, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 4000)
    monkeypatch.setattr(suffix_dedup, "RANGE_BYTES", 8000)
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 3000)
    first = {}
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for r in ordered:
        b = (r[1] or "").encode()
        for p in range(len(b) - 49):
            first.setdefault(b[p:p + 50], r[0])
    got = by_id(suffix_dedup.repeated_spans(docs))
    for r in ordered:
        b, gone = (r[1] or "").encode(), bytearray(len((r[1] or "").encode()))
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] != r[0]:
                gone[p:p + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        row = got[r[0]]
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        assert (row["n_bytes"], row["n_removed"], row["n_spans"]) == (len(b), sum(gone), spans)
        assert row["kept_sha256"] == hashlib.sha256(kept).hexdigest() and bytes(row["kept"]) == kept
    assert sum(r["n_removed"] for r in got.values()) > 1000
    assert suffix_dedup.digest(empty).count() == 0


def test_loser_tree_merge():
    rng = random.Random(3)
    for _ in range(100):
        runs, held = [], []
        for _ in range(rng.randint(1, 9)):
            xs = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 12)))
            held.append(xs)
            shared, lengths, rest = suffix_dedup.front_code(
                np.array([list(x.ljust(12, b"\0")) for x in xs], np.uint8))
            runs.append(suffix_dedup.Run(shared.tolist(), lengths.tolist(), rest))
        out = [(held[r][i], same) for r, i, same in suffix_dedup.merge(runs)]
        assert [x for x, _ in out] == sorted(x for xs in held for x in xs)
        assert all(same == (k > 0 and x == out[k - 1][0]) for k, (x, same) in enumerate(out))


def test_secret_scan(spark, empty):
    key, loose = "AKIA" + "Z7" * 8, "aB3dE6gH9jK2mN5pQ8sT1vW4xY7z"
    texts = [f"x password = 'hunter22x' y {key}", f"é user=bob  {loose} tail", loose, "secret=token:abcdef", None, "",
             "AKIAAKIA" + "A" * 15, "0123456789abcdef01234567", f"https://db.example/x\n{loose}", "token: abc",
             "PASSWD:\"abcdef\" api-key=1234567 apikey=1234567", f"user=bob {'x ' * 300}{loose}"]
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, weak string")
    found = secret_scan.find(docs)
    got = by_id(secret_scan.digest(found))
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for i, t in enumerate(texts):
        spans = []
        for rank, name, pattern, ok in ((0, "assign", assign, lambda m: len(m[2]) >= 6),
                                        (1, "access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
                                        (2, "hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)):
            spans += [(m.start(), rank, f"{name}:{m.start()}:{m.end()}") for m in pattern.finditer(t or "") if ok(m)]
        listed = ",".join(s for _, _, s in sorted(spans))
        assert got[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert got[i]["n_assign"] + got[i]["n_access"] + got[i]["n_hex"] == len(spans)
    assert got[1]["spans"] == "login:2:10,loose_secret:12:40"      # parts that complement each other
    assert got[2]["spans"] == "" and got[11]["spans"] == ""        # alone, or too far apart
    assert "endpoint:0:20" in got[8]["spans"]
    new = by_id(secret_scan.redact(docs, n_chars=None))
    assert new[1]["text"] == "é [SECRET]  [SECRET] tail" and new[2]["text"] == loose and new[4]["text"] is None
    assert secret_scan.find(empty).count() == 0


def test_warc(spark, tmp_path):
    tricky = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n"
    rows = [(5, "http://a/\r\nx", "<p>é</p>"), (2, None, "<p>é</p>"), (9, "u", "<p>é</p>"), (3, "u", None), (4, "u", ""),
            (7, "u", tricky), (8, "u", tricky * 3)]
    pages = spark.createDataFrame([(*r, "q") for r in rows], "page_id long, url string, html string, payload string")
    first = {}
    for i, _, h in sorted(rows):
        first.setdefault(h or "", i)
    path = str(tmp_path / "w")
    warc.write(pages, path, file_bytes=1500)
    got = {r["page_id"]: r for r in warc.read(spark, path).collect()}
    assert len(got) == len(rows)
    for i, _, h in rows:
        b, r = (h or "").encode(), got[i]
        revisit = first[h or ""] != i
        assert (r["payload_bytes"], r["record_type"], r["refers_to"]) == (
            len(b), "revisit" if revisit else "response", first[h or ""] if revisit else None)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(b).digest()).decode()
        assert bytes(r["payload"]) == (b"" if revisit else b)
    assert got[5]["url"] == "http://a/%0D%0Ax"
    assert warc.round_trip(pages).count() == len(rows)
    assert warc.round_trip(pages, min_bytes=10**6).filter("record_type = 'revisit'").count() == 0
    assert warc.round_trip(pages.limit(0)).count() == 0
