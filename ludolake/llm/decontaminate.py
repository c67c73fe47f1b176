"""Benchmark decontamination: word windows of benchmark items in documents.

DataFrame functions only. A text's words are the runs of characters outside
the separators below, after A-Z is lower-cased. An item's windows are its runs
of ``window`` consecutive words; an item of fewer words, but not none, is one
window. Every window start of every document is hashed and looked up in the
set of window hashes; the few starts that are in it go on with their words and
are verified by equality. A document word inside any occurrence is hit.

The set of hashes is part of the plan (an IN set, sent with the tasks) as long
as the benchmark has at most ``max_set`` windows (0.8 MB of keys). The keys of a
larger benchmark are a table: places and keys of all starts are joined with it,
and only the words of hits are looked up again. The result is the same.

Defined cases: null text has no words; an item without words has no windows; a
text of fewer words than a window can only hold a shorter item; texts of any
length are read whole. Repeated rows, rows that share an id and rows without one
are judged and cut one by one, by their own text. Other columns are left as they
are, whatever their names. Empty tables give no hits or no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Wd
from pyspark.sql import functions as F

from .common import column, cut, free, with_key, without

#: Characters that end a word (fixed by the definition of a word).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
MAX_SET = 100_000


def words(text: Column) -> Column:
    """The words of a text, as an array."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, SEPARATORS + "+"), "")


def windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
            window: int = 10) -> DataFrame:
    """``(item_id, n, gram, key)``: the distinct windows of every item."""
    items = benchmark.select(F.col(item_id).alias("item_id"), words(F.col(text)).alias("w"))
    starts = F.expr(f"sequence(1, greatest(size(w) - {window - 1}, 1))")
    return (items.filter(F.size("w") > 0)
            .select("item_id", "w", F.explode(starts).alias("i"))
            .withColumn("part", F.expr(f"slice(w, i, {window})"))
            .select("item_id", F.size("part").alias("n"), F.array_join("part", " ").alias("gram"),
                    F.xxhash64("part").alias("key")).distinct())


def _starts(n: int, keys: list[int]) -> str:
    """SQL for the candidate starts of windows of n words in the array w."""
    every = f"if(size(w) >= {n}, sequence(1, size(w) - {n - 1}), array())"
    listed = ", ".join(f"{k}L" for k in keys)
    every = f"filter({every}, i -> xxhash64(slice(w, i, {n})) IN ({listed}))"
    return f"transform({every}, i -> struct(i AS at, {n} AS n, array_join(slice(w, i, {n}), ' ') AS gram))"


def _candidates(docs: DataFrame, found: DataFrame, doc_id: str, text: str, max_set: int) -> DataFrame:
    # One row for each length of window; lengths are at most ``window``.
    lengths = {r["n"]: r["c"] for r in found.groupBy("n").agg(F.countDistinct("key").alias("c")).collect()}
    rows = docs.select(column(doc_id).alias("doc_id"), words(column(text)).alias("w"))
    if sum(lengths.values()) > max_set:
        return _joined(rows, found, sorted(lengths))
    keys: dict[int, list[int]] = {n: [] for n in lengths}
    for r in found.select("n", "key").distinct().collect():
        keys[r["n"]].append(r["key"])
    parts = ", ".join(_starts(n, keys[n]) for n in sorted(keys))
    hits = f"concat({parts})" if parts else "cast(array() AS array<struct<at:int,n:int,gram:string>>)"
    # transform(array(w), w -> ...) names the words, so they are split once.
    judged = F.expr(f"transform(array(w), w -> struct(size(w) AS n_words, {hits} AS hits))[0]")
    return rows.select("doc_id", judged.alias("j")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("j.n_words").cast("long").alias("n_words"), "j.hits")


def _joined(rows: DataFrame, found: DataFrame, lengths: list[int]) -> DataFrame:
    """``_candidates`` by a join: each start of a window as (row, place, length,
    64-bit key) with the table of keys; only the words of hits are looked up
    again, in the rows that were written before."""
    rows = cut(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "w"))
    every = ", ".join(f"if(size(w) >= {n}, transform(sequence(1, size(w) - {n - 1}), "
                      f"i -> struct(i AS at, {n} AS n, xxhash64(slice(w, i, {n})) AS key)), array())" for n in lengths)
    starts = rows.select("row", F.explode(F.expr(f"concat({every})")).alias("s")).select("row", "s.*")
    hits = (starts.join(found.select("n", "key").distinct(), ["n", "key"])
            .groupBy("row").agg(F.collect_list(F.struct("at", "n")).alias("places")))
    gram = F.expr("transform(places, p -> struct(p.at AS at, p.n AS n, array_join(slice(w, p.at, p.n), ' ') AS gram))")
    none = F.expr("cast(array() AS array<struct<at:int,n:int,gram:string>>)")
    return rows.join(hits, "row", "left").select(
        "row", "doc_id", F.size("w").cast("long").alias("n_words"), F.coalesce(gram, none).alias("hits"))


def scan(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text", window: int = 10, max_set: int = MAX_SET) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_words``, ``n_hit``
    (words inside occurrences), ``items`` (sorted as strings, of items with an
    occurring window) and ``spans`` (maximal runs of hit words: first word,
    counted from 0, and the one after the last)."""
    found = cut(windows(benchmark, item_id, item_text, window))
    rows = cut(_candidates(docs, found, doc_id, text, max_set))
    grams = found.select("gram", "n").distinct()
    hits = cut(rows.select("row", F.explode("hits").alias("h")).select("row", "h.*")
               .join(grams, ["gram", "n"]))
    # Occurrences to runs: a run begins where no earlier occurrence reaches.
    order = Wd.partitionBy("row").orderBy("at")
    before = F.max(F.col("at") + F.col("n")).over(order.rowsBetween(Wd.unboundedPreceding, -1))
    runs = (hits.select("row", "at", F.col("n")).groupBy("row", "at").agg(F.max("n").alias("n"))
            .withColumn("new", F.coalesce(F.col("at") > before, F.lit(True)).cast("int"))
            .withColumn("run", F.sum("new").over(order.rowsBetween(Wd.unboundedPreceding, 0)))
            .groupBy("row", "run").agg((F.min("at") - 1).cast("long").alias("begin"),
                                       (F.max(F.col("at") + F.col("n")) - 1).cast("long").alias("end")))
    spans = runs.groupBy("row").agg(
        F.sum(F.col("end") - F.col("begin")).alias("n_hit"),
        F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("spans"))
    items = (hits.select("row", "gram", "n").distinct().join(found, ["gram", "n"])
             .select("row", F.col("item_id").cast("string").alias("item")).distinct()
             .groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items")))
    return (rows.select("row", "doc_id", "n_words").join(spans, "row", "left").join(items, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    F.coalesce("spans", F.array().cast("array<struct<begin:bigint,end:bigint>>")).alias("spans")))


def digest(scanned: DataFrame) -> DataFrame:
    """The digest columns of ``scan``'s rows."""
    return scanned.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     **how) -> DataFrame:
    """``docs`` without those that hold a window, each row by its own text."""
    keyed, key = with_key(docs, doc_id, text)
    hit = scan(keyed, benchmark, key, text, **how).filter("n_hit > 0").select("doc_id").distinct()
    return without(keyed, key, hit)


def remove_spans(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 **how) -> DataFrame:
    """``docs`` with the hit words, and the separators that follow each, cut
    out of the text, each row by its own text."""
    keyed, key = with_key(docs, doc_id, text)
    other, spans = free(keyed, "found_key"), free(keyed, "found_spans")
    found = (scan(keyed, benchmark, key, text, **how).filter("n_hit > 0")
             .groupBy("doc_id").agg(F.any_value("spans").alias("spans")).toDF(other, spans))
    inner, word = SEPARATORS, SEPARATORS.replace("[", "[^", 1)
    # A piece is a word with what follows; a text's leading separators make
    # one more piece in front.
    pieces = F.split(column(text), f"(?<={inner})(?={word})")
    lead = F.when(column(text).rlike(f"^{inner}"), 1).otherwise(0)
    hit = F.struct(pieces.alias("pieces"), lead.alias("lead"), F.col(spans).alias("spans"))
    cut_out = F.transform(F.array(hit), lambda x: F.array_join(F.filter(
        x["pieces"], lambda p, i: ~F.exists(x["spans"], lambda s: (i - x["lead"] >= s["begin"])
                                            & (i - x["lead"] < s["end"]))), ""))[0]
    new = F.when(F.col(spans).isNull(), column(text)).otherwise(cut_out)
    return (keyed.join(found, F.col(key).eqNullSafe(F.col(other)), "left")
            .select(*(new.alias(c) if c == text else column(c) for c in docs.columns)))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
doc_windows AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, gram)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits))
  GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
