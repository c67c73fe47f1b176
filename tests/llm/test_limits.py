"""Limits that must not grow, vanish or stop a query with the size of the data."""

from pyspark.sql import functions as F

from ludolake.llm import quality_model, url_rules, warc


def test_rules_do_not_need_more_bad_urls_in_a_larger_table(spark):
    # 60 bad urls of one host among 40,000: 0.15 % of all.
    n = F.col("id")
    urls = spark.range(40000).select(
        F.when(n < 60, F.concat(F.lit("http://spam.net/"), n)).otherwise(
            F.concat(F.lit("http://good"), n % 50, F.lit(".net/"), n)).alias("url"),
        ((n < 60) | (n % 500 == 77)).alias("bad"))
    rules = url_rules.mine(urls).cache()
    got = {tuple(r["items"]): r for r in rules.collect()}
    assert set(got) == {("host=spam",), ("site=spam.net",)}
    n_bad = urls.filter("bad").count()
    for r in got.values():
        assert r["confidence"] == 1 and abs(r["lift"] - 40000 / n_bad) < 1e-9 and abs(r["support"] - 60 / 40000) < 1e-12
    pages = spark.createDataFrame([(1, "http://spam.net/x"), (2, "http://good7.net/x")], "page_id long, url string")
    assert {r["page_id"]: r["verdict"] for r in url_rules.judge(pages, rules).collect()} == {1: "block", 2: "allow"}
    # A host below the floor makes no rule.
    few = urls.filter("url NOT LIKE '%spam%'").unionByName(urls.filter("url LIKE '%spam%'").limit(19))
    assert url_rules.mine(few).count() == 0


def test_threshold_of_languages_with_few_held_out_documents(spark, monkeypatch):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(2000)], "doc_id long, quality int, toxic int")
    train = {r["doc_id"]: r["train"] for r in quality_model.trusted(labels).collect()}
    held = [i for i, t in train.items() if not t]
    counted = [i for i, t in train.items() if t]
    rows = [(i, "en", 2.0 + i / 10000) for i in held[20:] + counted[20:]]
    rows += [(i, "xx", 2.0) for i in counted[:20]]                             # all in the training part
    rows += [(i, "yy", 2.0) for i in held[:19]] + [(held[19], "yy", 1000.0)]   # one odd document
    rows += [(9001, "en", 50.0), (9002, "xx", 50.0), (9003, "yy", 50.0), (9004, "zz", 50.0), (9005, "xx", None)]
    scored = spark.createDataFrame([(i, s, 10, p, b"") for i, s, p in rows],
                                   "doc_id long, lang string, n_bytes long, perplexity double, digest binary")
    monkeypatch.setattr(quality_model, "perplexities", lambda *a, **k: scored)
    keep = {r["doc_id"]: r["keep"] for r in quality_model.classify(scored, labels).collect()}
    assert [keep[i] for i in range(9001, 9006)] == [False, False, False, True, True]
    assert all(keep[i] for i in counted[:20] + held[:19]) and not keep[held[19]]


def test_warc_of_a_long_url(spark, tmp_path):
    rows = [(1, "http://a/" + "x" * 200_000, "<p>1</p>"), (2, "http://b/" + " " * 70_000, "<p>2</p>"), (3, "u", "<p>3</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = str(tmp_path / "w")
    warc.write(pages, path)
    got = {r["page_id"]: (r["url"], bytes(r["payload"])) for r in warc.read(spark, path).collect()}
    assert got == {i: (u.replace(" ", "%20"), h.encode()) for i, u, h in rows}
