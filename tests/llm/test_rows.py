"""Rows without an id, repeated rows, and rows that share an id: every stage
judges each row by its own text."""

from collections import Counter

from pyspark.sql import functions as F

from ludolake.llm import decontaminate, mixing, ngram_join, secret_scan

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def counted(df):
    return Counter(tuple(r) for r in df.collect())


def test_redact_rows(spark):
    # (id, text, text after)
    cases = [(None, "aa password = hunter22", "aa [SECRET]"), (None, "b token=abcdef12 tail", "b [SECRET] tail"),
             (1, "passwd: abcdef1 x", "[SECRET] x"), (1, "long way to secret = abcdef9", "long way to [SECRET]"),
             (1, "nothing here", "nothing here"), (2, "token=abcdef12", "[SECRET]"), (2, "token=abcdef12", "[SECRET]"),
             (None, None, None), (3, "", "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t, _ in cases], SCHEMA).repartition(3)
    got = secret_scan.redact(docs)
    assert got.columns == docs.columns
    assert counted(got) == Counter((i, new, "en", "s", len(new or "")) for i, _, new in cases)


def test_remove_documents_rows(spark):
    item = " ".join(f"w{i}" for i in range(12))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, f"x {item} y"), (None, "clean"), (1, item), (1, "other text"), (2, "fine"), (2, "fine"), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    got = decontaminate.remove_documents(docs, bench)
    assert counted(got) == Counter((i, t, "en", "s", 0) for i, t in rows if item not in (t or ""))


def test_mixed_documents_rows(spark):
    # Source a holds the ids 0 to 39, b 20 to 59 with other texts; each has
    # two rows without an id and a repeated row. One source is null.
    rows = [(i, f"a{i} " * (3 + i % 5), "en", "a", 0) for i in range(40)]
    rows += [(i, f"b{i} " * (2 + i % 7), "en", "b", 0) for i in range(20, 60)]
    rows += [(i, f"c{i} " * 4, "en", None, 0) for i in range(30)]
    rows += [(None, f"{s} none {k}", "en", s, 0) for s in ("a", "b", None) for k in range(2)]
    rows += [rows[3], rows[45]]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    mixed, of = mixing.mix(docs, shard_words=100)
    source = {r["rank"]: r["source"] for r in of.collect()}
    held = {}
    for r in rows:
        held.setdefault((r[3], r[0]), []).append(r)
    want = Counter((*row, d["shard"], d["position"], d["copy"]) for d in mixed.collect()
                   for row in held[source[d["rank"]], d["doc_id"]])
    got = mixing.mixed_documents(docs, shard_words=100)
    assert got.columns == [*docs.columns, "shard", "position", "copy"]
    assert counted(got) == want
    # The words that come out are the words that the operator says are taken.
    words = {s: n for s, n in mixing.taken(docs, shard_words=100).groupBy("source").agg(F.sum("taken")).collect()}
    out = Counter()
    for r in got.collect():
        out[r["source"]] += len((r["text"] or "").split())
    assert out == {s: n for s, n in words.items() if n} and any(r["doc_id"] is None for r in got.collect())


def test_ngram_join_rows(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BUCKET_BYTES", 400)
    prose = lambda k, n=40: " ".join(f"{k}word{j}" for j in range(n))
    near = lambda k: prose(k) + " end"
    # Id 5 holds a, which is linked with id 1, and b, whose copies are 7 and 8.
    # Two rows without an id hold c and d, which aren't linked. Id 9 is e twice.
    cases = [(1, near("a"), 1), (5, prose("a"), 1), (5, prose("b"), 5), (7, prose("b"), 5), (8, near("b"), 5),
             (None, prose("c"), None), (None, prose("d"), None), (11, near("d"), None), (9, prose("e"), 9),
             (9, prose("e"), 9), (10, prose("e"), 9), (12, prose("f"), 12), (12, None, 12), (13, "", 13)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t, _ in cases], SCHEMA).repartition(3)
    shingles = lambda t: max(len(t.split()) - 4, 0) if t else 0
    got = ngram_join.jaccard_components(docs)
    assert counted(got) == Counter((i, shingles(t), c) for i, t, c in cases)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    # One row of each component; of equal rows, one.
    want = Counter({(i, t, "en", "s", 0): 1 for i, t, c in cases if i == c})
    assert counted(kept) == want
    many = docs.unionByName(docs).unionByName(docs.filter("doc_id IS NULL"))
    words = lambda rows: Counter({r: n for r, n in rows.items() if r[1]})
    assert words(counted(ngram_join.keep_one(many))) == words(want)
