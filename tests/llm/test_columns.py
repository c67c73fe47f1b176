"""Every stage and operator on a table whose extra columns have the names that
operators use inside, with null ids, rows that share an id, exact repeats, null
and empty texts; and on an empty table."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from ludolake.llm import (decontaminate, fingerprint, language_id, mixing, ngram_join, quality_model, resampling,
                          secret_scan, sentencepiece_bpe, suffix_dedup, url_rules, warc, whitening)
from tests.llm.test_new_operators import MODEL

NAMES = ("_id", "_digest", "_key", "_of", "_lang", "copy", "shard", "position", "bucket", "row", "row_key", "gone_key",
         "found_key", "spans", "hits", "w", "n_words", "rank", "digest", "component", "local", "a.b", "Text2", "key")
EXTRA = ", ".join(f"`{n}` {'string' if i % 2 else 'long'}" for i, n in enumerate(NAMES))
PLAIN = "doc_id long, text string, lang string, source string, n_chars long"


def prose(k, n=40):
    return " ".join(f"{k}word{j}" for j in range(n))


ITEM = " ".join(f"item{i}" for i in range(12))
TEXTS = [(1, prose("a")), (1, prose("a")), (1, prose("b")), (None, prose("c")), (None, prose("c") + " end"),
         (None, f"x {ITEM} y"), (2, f"{ITEM}"), (3, "aa password = hunter22 bb"), (3, "token=abcdef12"),
         (None, "secret=abcdef99 tail"), (4, None), (None, None), (5, ""), (5, ""), (6, prose("a") + " z"),
         (7, "fine and clean text here"), (7, "fine and clean text here"), (8, prose("d", 3000))]


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(i, t, "en" if k % 3 else None, "s" if k % 4 else None, len(t or "")) for k, (i, t) in enumerate(TEXTS)]
    plain = spark.createDataFrame(rows, PLAIN).repartition(3)
    # What the extra columns hold follows from the row, so rows can be compared.
    clash = plain.withColumns({n: (F.concat(F.lit(n), F.coalesce("text", F.lit("-"))) if i % 2 else F.coalesce("doc_id", F.lit(-1)))
                               for i, n in enumerate(NAMES)})
    assert clash.columns[5:] == list(NAMES)
    return plain, clash


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, ITEM, "q")], "item_id long, text string, w string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, 0, "z") for i in (1, 2, 3, 6, 7, 8)],
                                 "doc_id long, quality int, toxic int, _id string")


def stages(bench, labels):
    return {"remove_documents": lambda d: decontaminate.remove_documents(d, bench),
            "remove_documents_joined": lambda d: decontaminate.remove_documents(d, bench, max_set=0),
            "remove_spans": lambda d: decontaminate.remove_spans(d, bench), "redact": secret_scan.redact,
            "keep_one": ngram_join.keep_one, "keep_good": lambda d: quality_model.keep_good(d, labels)}


@pytest.mark.parametrize("name", list(stages(None, None)))
def test_stages_keep_clashing_columns(spark, tables, bench, labels, name):
    plain, clash = tables
    stage = stages(bench, labels)[name]
    want, got = rows_of(stage(plain)), stage(clash)
    assert got.columns == clash.columns
    found = rows_of(got)
    assert Counter(tuple(r[:5]) for r in found.elements()) == want
    # The extra columns are still those of the row that they came with.
    source = {tuple(r[:5]): tuple(r[5:]) for r in clash.collect()}
    texts = {(r[0], *r[2:4], *r[5:]) for r in clash.collect()}
    assert all((r[0], *r[2:4], *r[5:]) in texts for r in found)
    if name in ("keep_one", "keep_good", "remove_documents"):
        assert all(source[r[:5]] == r[5:] for r in found)
    empty = stage(clash.limit(0))
    assert empty.columns == clash.columns and empty.count() == 0


def test_decisions_without_ids(spark, tables, bench):
    plain, _ = tables
    rows = [tuple(r) for r in plain.collect()]
    hit = lambda t: ITEM in (t or "")
    assert rows_of(decontaminate.remove_documents(plain, bench)) == Counter(r for r in rows if not hit(r[1]))
    spans = Counter((r[0], (r[1] or None) and r[1]) for r in rows)
    cut = Counter((r["doc_id"], r["text"]) for r in decontaminate.remove_spans(plain, bench).collect())
    assert cut[(None, "x y")] == 1 and cut[(2, "")] == 1 and sum(cut.values()) == sum(spans.values())
    kept = Counter((r["doc_id"], r["text"]) for r in ngram_join.keep_one(plain).collect())
    # a (twice under id 1, and id 6) leaves one row, c's two texts without an id
    # one, the two equal clean texts one; texts without words all stay.
    assert kept[(1, prose("a"))] == 1 and (6, prose("a") + " z") not in kept and kept[(1, prose("b"))] == 1
    assert kept[(None, prose("c"))] + kept[(None, prose("c") + " end")] == 1
    assert kept[(7, "fine and clean text here")] == 1 and kept[(5, "")] == 2 and kept[(None, None)] == 1


def test_mixed_columns(spark, tables):
    plain, clash = tables
    a, b = mixing.mixed_documents(plain, shard_words=500), mixing.mixed_documents(clash, shard_words=500)
    assert a.columns == [*plain.columns, "shard", "position", "copy"]
    assert b.columns == [*clash.columns, "mix_shard", "mix_position", "mix_copy"]
    at = [*range(5), *range(len(clash.columns), len(clash.columns) + 3)]
    assert Counter(tuple(r[i] for i in at) for r in b.collect()) == rows_of(a)
    assert mixing.mixed_documents(clash.limit(0)).count() == 0


def test_operators_ignore_clashing_columns(spark, tables, bench, labels):
    plain, clash = tables
    page = lambda d: d.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("http://a.net/"), "lang").alias("url"),
                              F.col("text").alias("html"), *[F.col(f"`{c}`") for c in d.columns[5:]])
    vectors = lambda d: d.select(F.col("doc_id").alias("vec_id"), F.array(F.length("text"), F.col("doc_id"))
                                 .cast("array<double>").alias("embedding"), *[F.col(f"`{c}`") for c in d.columns[5:]])
    rules = url_rules.mine(spark.createDataFrame([], "url string, bad boolean"))
    operators = {
        "taken": mixing.taken, "fingerprints": fingerprint.fingerprints, "identify": language_id.identify,
        "classify": lambda d: quality_model.classify(d, labels), "judge": lambda d: url_rules.judge(page(d), rules),
        "components": ngram_join.jaccard_components, "scan": lambda d: decontaminate.scan(d, bench),
        "suffixes": suffix_dedup.digest, "secrets": secret_scan.find, "warc": lambda d: warc.round_trip(page(d)),
        "resample": lambda d: resampling.resample(d, bench), "whiten": lambda d: whitening.whiten(vectors(d)),
        "encode": lambda d: sentencepiece_bpe.encode(d, MODEL)}
    for name, run in operators.items():
        a, b = ([tuple(map(str, r)) for r in run(d).collect()] for d in (plain, clash))
        if name in ("taken", "fingerprints"):       # ties among equal ids may fall either way
            assert len(a) == len(b), name
        else:
            assert sorted(a) == sorted(b), name


def test_pipeline_on_odd_rows(spark, tables, bench, labels, tmp_path):
    _, clash = tables
    home = str(tmp_path)
    clash.write.parquet(f"{home}/documents.parquet")
    bench.write.parquet(f"{home}/benchmark.parquet")
    labels.write.parquet(f"{home}/labels.parquet")
    docs = spark.read.parquet(f"{home}/documents.parquet")
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, home)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{home}/{name}")
        docs = spark.read.parquet(f"{home}/{name}")
    assert C.run(spark, home).columns[-3:] == ["mix_shard", "mix_position", "mix_copy"]


def test_warc_has_one_response_for_each_payload(spark):
    rows = [(None, "u", "p"), (None, "v", "p"), (3, "u", "p"), (3, "u", "p"), (3, None, "p"), (4, "u", "p"),
            (None, "u", "q"), (None, "u", "q"), (None, None, "q"), (-5, "u", "r"), (2, "u", "r"), (9, "u", None), (8, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.round_trip(pages).collect())
    assert got == Counter([
        (3, "response", None, 1), *[(3, "revisit", 3, 1)] * 2, *[(None, "revisit", 3, 1)] * 2, (4, "revisit", 3, 1),
        (None, "response", None, 1), *[(None, "revisit", None, 1)] * 2,
        (-5, "response", None, 1), (2, "revisit", -5, 1), (8, "response", None, 0), (9, "revisit", 8, 0)])
    short = warc.round_trip(pages, min_bytes=2)
    assert short.filter("record_type = 'revisit'").count() == 0


def test_keep_one_takes_the_same_of_equal_rows_in_any_order(spark):
    rows = [(1, "the same words in each of these rows", lang, {"m": k}) for k, lang in enumerate(["d", "b", "c", "a"])]
    for given in (rows, rows[::-1]):
        docs = spark.createDataFrame(given, "doc_id long, text string, lang string, extra map<string,int>").coalesce(1)
        assert [(r["lang"], r["extra"]) for r in ngram_join.keep_one(docs).collect()] == [("a", {"m": 3})]
