"""URL filters: list rules, and association rules mined from labels.

*List rules* are ``host/path`` prefixes that allow or block. A rule fits its
host and all subdomains where the url's path starts with the rule's; the
longest rule that fits wins. The list is small and part of the plan.

*Mined rules.* A labelled url is a transaction: its tokens (host labels, path
words, query keys, scheme, ...). Spark's FP-growth mines the sets that at least
``MIN_COUNT`` bad urls hold, however many are labelled; a set's count among all
labelled urls comes from the same kind of index that rules are matched with.
Rules ``tokens -> bad`` are pruned by confidence and lift, and dropped where a
rule with fewer of their tokens is as sure. What can't survive that isn't grown:
tokens that all labelled urls have are left out, tokens that the same urls have
are mined as one (a rule of several tokens names the first of them), and a token
that only bad urls have is a rule by itself, in no larger set. Every rule is posted under one of its tokens, the rarest;
a url meets only the rules posted under tokens that it has, and a rule fires
when all of its tokens are there.

DataFrame functions and Spark's ML library only; no Python code sees a url.

Defined cases: a null url, or one without ``://``, has an empty host and path
and no tokens: no rule fits it, and it is allowed. Without any bad label, or
without frequent sets, no rule is mined. Rows that repeat a page id are judged
one by one; equal urls get equal verdicts. Other columns are ignored. Empty
table: empty result.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: (verdict, rule): a rule is a host, lower case, and a path prefix.
LIST_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
              ("allow", "com/fr/"), ("block", "com/de/"))
#: Bad urls that a rule must fit at least, however many are labelled.
MIN_COUNT = 20
MIN_CONFIDENCE = 0.4
MIN_LIFT = 1.5


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1),
                       string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)?", 1)
    empty = F.lit("")
    return F.coalesce(host, empty), F.coalesce(path, empty)


def list_verdict(host: Column, path: Column, rules: Sequence[tuple[str, str]] = LIST_RULES) -> Column:
    """struct(verdict, rule) of the longest list rule that fits, or null."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at = rule.index("/")
        domain, prefix = rule[:at], rule[at:]
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def tokens(url: Column) -> Column:
    """Distinct tokens of a url; numbers are one token, whatever their value."""
    host, path = host_path(url)
    labels = F.split(host, r"\.")
    words = F.array_remove(F.split(F.regexp_replace(F.lower(path), r"[0-9]+", "9"), r"[/._-]+"), "")
    keys = F.array_remove(F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit(r"[?&]([^=&#]+)="), F.lit(1)), "")
    listed = F.concat(
        F.transform(labels, lambda x: F.concat(F.lit("host="), x)),
        F.array(F.concat(F.lit("site="), F.concat_ws(".", F.slice(F.concat(F.array(F.lit("")), labels), -2, 2)))),
        F.transform(words, lambda x: F.concat(F.lit("path="), x)),
        F.transform(keys, lambda x: F.concat(F.lit("query="), x)),
        F.array(F.concat(F.lit("scheme="), F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))),
                F.concat(F.lit("fragment="), (F.instr(url, "#") > 0).cast("string")),
                F.concat(F.lit("slash="), path.endswith("/").cast("string"))))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(listed))


def _totals(kinds: DataFrame, sets: DataFrame) -> DataFrame:
    """``(rule_id, total)``: how many of the urls of ``kinds`` hold each set.
    A set is posted under its token that the fewest urls have."""
    each = kinds.select("items", "n", F.explode("items").alias("token"))
    use = each.groupBy("token").agg(F.sum("n").alias("use"))
    posted = (sets.select("rule_id", F.col("items").alias("set"), F.explode("items").alias("token")).join(use, "token")
              .groupBy("rule_id", "set").agg(F.min(F.struct("use", "token"))["token"].alias("token")))
    return (each.join(posted, "token").filter(F.size(F.array_except("set", "items")) == 0)
            .groupBy("rule_id").agg(F.sum("n").alias("total")))


def _merged(kinds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``kinds`` with one token for those that the same urls have, and the
    tokens ``(token, name, n, bad)`` with the one that stands for each."""
    each = kinds.select("items", "n", "bad", F.explode("items").alias("token"))
    mark = F.xxhash64("items")
    seen = each.groupBy("token").agg(F.bit_xor(mark).alias("m1"), F.bit_xor(F.xxhash64(F.lit(1), "items")).alias("m2"),
                                     F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    same = ["m1", "m2", "n", "bad"]
    names = seen.groupBy(*same).agg(F.min("token").alias("name"))
    tokens = cut(seen.join(names, same).select("token", "name", "n", "bad"))
    merged = (each.join(tokens.select("token", "name"), "token").groupBy("items", "n", "bad")
              .agg(F.array_sort(F.collect_set("name")).alias("names")))
    return cut(merged.select(F.col("names").alias("items"), "n", "bad")), tokens


def mine(labelled: DataFrame, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE,
         min_lift: float = MIN_LIFT) -> DataFrame:
    """Rules ``(rule_id, items, confidence, lift, support)`` from
    ``(url, bad)``."""
    # Urls with the same tokens are one row with their counts.
    kinds = cut(labelled.select(F.array_sort(tokens(F.col("url"))).alias("items"), F.col("bad").cast("long").alias("bad"))
                .filter(F.size("items") > 0)
                .groupBy("items").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")))
    n, n_bad = (x or 0 for x in kinds.agg(F.sum("n"), F.sum("bad")).first())
    if n_bad < min_count:
        return kinds.sparkSession.createDataFrame(
            [], "items array<string>, confidence double, lift double, support double, rule_id long")
    if min_lift > 1:
        # A token of every url makes no set surer, and alone it has lift 1.
        common = [r["token"] for r in kinds.select("n", F.explode("items").alias("token")).groupBy("token")
                  .agg(F.sum("n").alias("n")).filter(F.col("n") == n).collect()]
        kinds = kinds.withColumn("items", F.array_except("items", F.array(*map(F.lit, common)).cast("array<string>")))
    # No set of tokens that the same urls have, and no larger set around a token
    # that only bad urls have, is surer than a smaller one: neither is grown.
    kinds, known = _merged(kinds.filter(F.size("items") > 0))
    named = known.filter("token = name")
    sure = named.filter((F.col("n") == F.col("bad")) & (F.col("bad") >= min_count))
    sure = sure.select(F.array("token").alias("items"), F.col("bad").alias("freq"))
    open_tokens = named.filter((F.col("n") > F.col("bad")) & (F.col("bad") >= min_count)).select("token")
    bad = cut(kinds.filter("bad > 0").select("items", "bad", F.explode("items").alias("token"))
              .join(open_tokens, "token").groupBy("items", "bad").agg(F.collect_set("token").alias("held"))
              .select(F.col("held").alias("items"), F.explode(F.expr("sequence(1L, bad)"))).select("items"))
    # Spark rounds the product of support and rows up; empty ones aren't counted.
    rows = bad.count()
    if rows < min_count:
        sets = bad.select("items", F.lit(0).cast("long").alias("freq")).limit(0)
    else:
        sets = FPGrowth(itemsCol="items", minSupport=(min_count - 0.5) / rows).fit(bad).freqItemsets
    sets = cut(sets.unionByName(sure).select(F.array_sort("items").alias("items"), "freq")
               .withColumn("rule_id", F.xxhash64("items")))
    confidence = F.col("freq") / F.col("total")
    rules = cut(sets.join(_totals(kinds, sets), "rule_id")
                .select("items", confidence.alias("confidence"), (confidence / (n_bad / n)).alias("lift"),
                        (F.col("freq") / n).alias("support"), "rule_id")
                .filter((F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift)))
    # A rule is redundant if fewer of its tokens are as sure. Candidates share
    # a token, found through the posting lists of the rules themselves.
    posted = rules.select(F.col("rule_id").alias("small"), F.col("items").alias("small_items"),
                          F.col("confidence").alias("small_confidence"), F.col("items")[0].alias("token"))
    redundant = (rules.select("rule_id", "items", "confidence", F.explode("items").alias("token"))
                 .join(posted, "token")
                 .filter((F.size("small_items") < F.size("items")) & (F.col("small_confidence") >= F.col("confidence"))
                         & (F.size(F.array_except("small_items", "items")) == 0))
                 .select("rule_id").distinct())
    rules = rules.join(redundant, "rule_id", "left_anti")
    # A rule of one token holds for the others that the same urls have, too.
    others = known.filter("token <> name").select(F.array("name").alias("items"), F.array("token").alias("other"))
    alike = (rules.join(others, "items").drop("items", "rule_id").withColumnRenamed("other", "items")
             .withColumn("rule_id", F.xxhash64("items")))
    return rules.unionByName(alike)


def index(rules: DataFrame) -> DataFrame:
    """``(token, rule_id, items, confidence)``: each rule under the token that
    the fewest rules have."""
    each = rules.select("rule_id", "items", "confidence", F.explode("items").alias("token"))
    use = each.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return (each.join(use, "token").groupBy("rule_id", "items", "confidence")
            .agg(F.min(F.struct("n", "token")).alias("m"))
            .select(F.col("m.token").alias("token"), "rule_id", "items", "confidence"))


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct urls of ``urls`` (column ``url``) that a rule fires on,
    with the surest rule's id and confidence."""
    held = urls.select("url").filter(F.col("url").isNotNull()).distinct().select(
        "url", tokens(F.col("url")).alias("tokens"))
    return (held.select("url", "tokens", F.explode("tokens").alias("token")).join(index(rules), "token")
            .filter(F.size(F.array_except("items", "tokens")) == 0)
            .groupBy("url").agg(F.max(F.struct("confidence", "rule_id")).alias("m"))
            .select("url", F.col("m.rule_id").alias("rule_id"), F.col("m.confidence").alias("confidence")))


def judge(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url",
          list_rules: Sequence[tuple[str, str]] = LIST_RULES) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, and the mined
    rule's ``confidence``, of every row."""
    host, path = host_path(F.col("url"))
    rows = (pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
            .withColumn("host", host).withColumn("path", path)
            .withColumn("listed", list_verdict(F.col("host"), F.col("path"), list_rules)))
    # Only urls without a list rule need the mined ones.
    fired = match(rows.filter("listed IS NULL"), rules)
    return (rows.join(fired, "url", "left")
            .select("page_id", "host", "path", F.col("listed.rule").alias("rule"),
                    F.coalesce("listed.verdict", F.when(F.col("confidence").isNotNull(), "block").otherwise("allow"))
                    .alias("verdict"), F.when(F.col("listed").isNull(), F.col("confidence")).alias("confidence")))


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``(url, bad)``: the number in a page's path is the id of the document
    that it shows; a page is bad if that is labelled as toxic or of low
    quality."""
    shown = pages.select("url", F.regexp_extract(host_path(F.col("url"))[1], r"/([0-9]+)[^0-9/]*/?$", 1)
                         .try_cast("long").alias("doc_id")).filter("doc_id IS NOT NULL")
    bad = labels.groupBy("doc_id").agg((F.max(F.greatest("toxic", 1 - F.col("quality"))) > 0).alias("bad"))
    return shown.join(bad, "doc_id").select("url", "bad")
