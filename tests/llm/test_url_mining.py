"""Mined url rules against all token sets counted by hand, and their growth."""

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from ludolake.llm import url_rules


def some_urls(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        site = rng.choice(["shop", "shop", "news", "blog"])
        words = [rng.choice(["buy", "win", "read", "x"]) for _ in range(rng.randint(0, 2))]
        query = rng.choice(["", "?ref=1", f"?ref={i}&promo=2"])
        url = f"http://{rng.choice(['www', 'm'])}.{site}.net/{'/'.join(words)}{query}"
        risk = 0.05 + 0.6 * ("promo" in query and site == "shop") + 0.3 * ("win" in words)
        out.append((url, rng.random() < risk))
    return out + [("http://bad.only.net/win", True)] * 25 + [("no scheme", True), (None, False)]


def by_hand(kinds, min_count, min_confidence, min_lift):
    """Rules from (tokens, bad) of every url: all sets, all supersets."""
    kinds = [(frozenset(t), b) for t, b in kinds if t]
    n, n_bad = len(kinds), sum(b for _, b in kinds)
    common = {t for t in set().union(*(k for k, _ in kinds)) if all(t in k for k, _ in kinds)}
    freq = Counter(frozenset(c) for k, b in kinds if b for size in range(1, len(k - common) + 1)
                   for c in combinations(sorted(k - common), size))
    sets = {s: c for s, c in freq.items() if c >= min_count}
    total = {s: sum(s <= k for k, _ in kinds) for s in sets}
    rules = {s: c / total[s] for s, c in sets.items()
             if c / total[s] >= min_confidence and c / total[s] / (n_bad / n) >= min_lift}
    rules = {s: c for s, c in rules.items() if not any(r < s and x >= c for r, x in rules.items())}
    # Tokens of the same urls: a rule of several names the first one.
    held = {}
    for i, (k, _) in enumerate(kinds):
        for t in k:
            held.setdefault(t, set()).add(i)
    first = {t: min(u for u in held if held[u] == held[t]) for t in held}
    return {s: c for s, c in rules.items() if len(s) == 1 or all(first[t] == t for t in s)}, rules


@pytest.mark.parametrize("seed", [1, 2])
def test_rules_by_hand(spark, seed):
    rows = some_urls(seed, 400)
    urls = spark.createDataFrame(rows, "url string, bad boolean").repartition(3)
    kinds = [(r["t"], r["bad"]) for r in urls.select(url_rules.tokens(F.col("url")).alias("t"), "bad").collect()]
    want, every = by_hand(kinds, 8, 0.4, 1.5)
    rules = url_rules.mine(urls, min_count=8).cache()
    got = {frozenset(r["items"]): r["confidence"] for r in rules.collect()}
    assert got == want and len(got) > 4 and any(len(s) > 1 for s in got)
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    judged = {r["page_id"]: r for r in url_rules.judge(pages, rules, list_rules=()).collect()}
    of = {r["page_id"]: set(r["t"]) for r in pages.select("page_id", url_rules.tokens(F.col("url")).alias("t")).collect()}
    for i, tokens in of.items():
        # On labelled urls, the rules left out never decide.
        sure = max((c for s, c in every.items() if s <= tokens), default=None)
        assert (judged[i]["confidence"], judged[i]["verdict"]) == (sure, "allow" if sure is None else "block")


def test_sets_do_not_explode(spark, monkeypatch):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        path = "/".join(rng.choice("abc") + "klm"[k] for k in range(3))
        rows.append((f"http://s{i % 3}.site{i % 3}.com/page/{path}?id={i}&ref=2&lang=3", i % 3 < 2))
    urls = spark.createDataFrame(rows, "url string, bad boolean")
    assert urls.select(F.max(F.size(url_rules.tokens(F.col("url"))))).first()[0] >= 13
    mined = []
    growth = url_rules.FPGrowth.fit
    monkeypatch.setattr(url_rules.FPGrowth, "fit", lambda self, df: mined.append(growth(self, df)) or mined[-1])
    rules = url_rules.mine(urls)
    assert {"site=site0.com", "site=site1.com"} <= {t for r in rules.collect() for t in r["items"]}
    assert sum(m.freqItemsets.count() for m in mined) < 1000
