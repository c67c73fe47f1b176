"""Secret scans: base patterns, and credentials linked from their parts.

Base spans need no company: an assignment to a secret's name, an access key
id, a long run of hex digits. Other parts mean little alone and are *weak*: a
bare random-looking token (``loose_secret``), a user or client name
(``login``), an address of a service (``endpoint``). Within a *scope* (parts of
one document at most ``reach`` code points apart) a weak part is reported only
when a complementary part is there: secrets (weak or base) complement logins,
access ids and endpoints, and the other way round.

The parts are found in the tasks that read the texts. Linking is an interval
join within each document: every weak part looks back to the farthest end, and
ahead to the nearest start, of complementary parts, with running maxima and
minima over the document's parts in order. That is linear in the parts; no
pairs are made.

Defined cases: null text is empty, without spans. Offsets are code points, the
end exclusive. A weak part that overlaps a base span is dropped; so is one that
overlaps an earlier weak part of its kind. Repeated rows, rows that share an id
and rows without one are judged and redacted one by one, by their own text.
Texts of any length are read whole. Other columns stay as they are, whatever
their names. Empty table: empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Wd
from pyspark.sql import functions as F

from .common import column, cut, free, with_key

# Fixed patterns of the base spans.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
# Weak parts.
LOOSE = re.compile(r"[A-Za-z0-9+/_-]{28,}={0,2}")
LOGIN = re.compile(r"\b(?:user(?:name)?|login|client_?id|account)\b[\"']?\x20*[:=]\x20*[\"']?"
                   r"([A-Za-z0-9@._-]{2,})", re.IGNORECASE | re.ASCII)
ENDPOINT = re.compile(r"\b[a-z][a-z0-9+.]{1,20}://[^\s\"'<>]{4,}", re.ASCII)

#: In the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "loose_secret", "login", "endpoint")
_SECRET = ("assign", "hex", "loose_secret")
_OTHER = ("access", "login", "endpoint")

_SPAN = pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64())])
_SCHEMA = "base array<struct<start:long,rank:int,end:long>>, " \
          "weak array<struct<start:long,rank:int,end:long>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end), by start and kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _random_looking(token: str) -> bool:
    kinds = (any(c.islower() for c in token) + any(c.isupper() for c in token)
             + 2 * any(c.isdigit() for c in token))
    return kinds >= 3 and len(set(token)) >= 12


def weak_parts(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    found = [(m.start(), 3, m.end()) for m in LOOSE.finditer(text) if _random_looking(m[0])]
    found += [(m.start(), 4, m.end()) for m in LOGIN.finditer(text)]
    if "://" in text:
        found += [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    starts = [s for s, _, _ in base]
    reach = list(accumulate((e for _, _, e in base), max))  # farthest end so far
    return sorted(x for x in found if not (k := bisect_left(starts, x[2])) or reach[k - 1] <= x[0])


def _structs(rows: list[list[tuple[int, int, int]]]) -> pa.Array:
    return pa.array([[{"start": s, "rank": k, "end": e} for s, k, e in row] for row in rows],
                    pa.list_(_SPAN))


def _parts(batches):
    for batch in batches:
        base = []
        weak = []
        for text in batch.column("text").to_pylist():
            spans = base_spans(text) if text else []
            base.append(spans)
            weak.append(weak_parts(text, spans) if text else [])
        keys = [n for n in batch.schema.names if n != "text"]
        yield pa.record_batch([*map(batch.column, keys), _structs(base), _structs(weak)],
                              names=[*keys, "base", "weak"])


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", reach: int = 200) -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` (base and linked ones) of every row;
    a span is (start, rank in ``KINDS``, end), in that order."""
    return _find(docs.select(column(doc_id).cast("long").alias("doc_id"), column(text).alias("text")), reach)


def _find(rows: DataFrame, reach: int) -> DataFrame:
    """``find`` on rows of ``text`` and key columns, which are kept."""
    keys = [f for f in rows.schema if f.name != "text"]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in keys), _SCHEMA])
    rows = cut(rows.mapInArrow(_parts, schema).withColumn("row", F.monotonically_increasing_id()))
    parts = (rows.filter(F.size("weak") > 0)
             .select("row", F.explode(F.concat("base", "weak")).alias("p")).select("row", "p.*"))
    is_secret = F.col("rank").isin([KINDS.index(k) for k in _SECRET])
    by = ("start", "rank", "end")
    back = Wd.partitionBy("row").orderBy(*by).rowsBetween(Wd.unboundedPreceding, -1)
    # Ahead is back in the opposite order: a growing frame, linear in the parts.
    ahead = Wd.partitionBy("row").orderBy(*map(F.desc, by)).rowsBetween(Wd.unboundedPreceding, -1)
    for name, is_kind in (("secret", is_secret), ("other", ~is_secret)):
        parts = (parts.withColumn(f"{name}_end", F.max(F.when(is_kind, F.col("end"))).over(back))
                 .withColumn(f"{name}_start", F.min(F.when(is_kind, F.col("start"))).over(ahead)))

    def near(name: str):
        return (F.coalesce(F.col("start") - F.col(f"{name}_end") <= reach, F.lit(False))
                | F.coalesce(F.col(f"{name}_start") - F.col("end") <= reach, F.lit(False)))

    linked = (parts.filter(F.col("rank") >= 3)
              .filter(F.when(is_secret, near("other")).otherwise(near("secret")))
              .groupBy("row").agg(F.collect_list(F.struct("start", "rank", "end")).alias("linked")))
    return (rows.join(linked, "row", "left")
            .select(*(f.name for f in keys), "base", F.array_sort(F.concat("base", F.coalesce(
                "linked", F.expr("filter(weak, x -> false)")))).alias("spans")))


def _listed(spans: str) -> F.Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, s -> concat(element_at(array({names}), s.rank + 1), "
                  "':', s.start, ':', s.end)), ',')")


def digest(found: DataFrame) -> DataFrame:
    """The digest columns of ``find``'s rows."""
    count = [F.expr(f"cast(size(filter(base, s -> s.rank = {k})) AS bigint)").alias(f"n_{KINDS[k]}")
             for k in range(3)]
    return found.select("doc_id", *count, F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"),
                        _listed("spans").alias("spans"))


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars",
           mark: str = "[SECRET]", reach: int = 200) -> DataFrame:
    """``docs`` with every reported span replaced by ``mark`` (overlapping
    spans by one), and ``n_chars`` renewed. Every row comes out once: spans go
    back to the id and text that they were found in."""
    keyed, key = with_key(docs, doc_id, text)
    other, spans = free(keyed, "found_key"), free(keyed, "found_spans")
    found = (_find(keyed.select(F.col(key).alias("key"), column(text).alias("text")), reach)
             .filter(F.size("spans") > 0).groupBy("key").agg(F.any_value("spans").alias("spans")).toDF(other, spans))
    # What is kept of the text: from the farthest end so far to the next start.
    body, listed = column(text), F.col(spans)

    def piece(a: Column, s: Column) -> Column:
        more = F.concat(a["out"], F.substring(body, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                        F.lit(mark))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"),
                        F.when(s["start"] < a["at"], a["out"]).otherwise(more).alias("out"))

    cleaned = F.aggregate(listed, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")), piece,
                          lambda a: F.concat(a["out"], F.substr(body, (a["at"] + 1).cast("int"))))
    out = keyed.join(found, F.col(key).eqNullSafe(F.col(other)), "left").withColumn(
        text, F.when(listed.isNull(), body).otherwise(cleaned))
    if n_chars and n_chars in docs.columns:
        out = out.withColumn(n_chars, F.when(listed.isNull(), column(n_chars)).otherwise(
            F.char_length(column(text)).cast(docs.schema[n_chars].dataType)))
    return out.select(*map(column, docs.columns))


# -- the digest in SQL ----------------------------------------------------------

def _any_case(words: str) -> str:
    """A pattern of A-Z and a-z letters in either case; other letters that a
    case-blind pattern would fold to them don't match."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


def _oracle(reach: int = 200) -> str:
    """DuckDB SQL of ``digest``. Places come from what is between the matches;
    weak parts are linked by comparing all parts of a document."""
    between = r"""["']?\x20*[:=]\x20*["']?"""
    names = "(?:" + _any_case("password|passwd|secret|token|api_?key") + ")"
    who = _any_case("user") + "(?:" + _any_case("name") + ")?|" + _any_case("login|client_?id|account")
    patterns = (("assign", names + between + "([A-Za-z0-9+/_.=-]+)", "length(value) >= 6"),
                ("access", "(AKIA[A-Z0-9]+)", "length(value) >= 20"),
                ("hex", "([0-9a-f]+)", "length(value) >= 24"),
                ("loose_secret", "([A-Za-z0-9+/_-]{28,}={0,2})",
                 "regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') "
                 "AND list_unique(string_split(value, '')) >= 12"),
                ("login", rf"\b(?:{who})\b" + between + "([A-Za-z0-9@._-]{2,})", "true"),
                ("endpoint", r"""(\b[a-z][a-z0-9+.]{1,20}://[^\x09-\x0D\x20"'<>]{4,})""", "true"))
    each = []
    for rank, (_, pattern, holds) in enumerate(patterns):
        quoted = "'" + pattern.replace("'", "''") + "'"
        each.append(f"""
  SELECT r, {rank} AS rank, start, start + length(whole) AS stop FROM (
    SELECT r, value, whole, (sum(length(gap) + length(whole)) OVER (PARTITION BY r ORDER BY i) - length(whole))::BIGINT AS start
    FROM (SELECT r, unnest(regexp_extract_all(text, {quoted}, 0)) AS whole,
                 unnest(regexp_extract_all(text, {quoted}, 1)) AS value,
                 unnest(string_split_regex(text, {quoted})[:-2]) AS gap,
                 generate_subscripts(regexp_extract_all(text, {quoted}, 0), 1) AS i
          FROM docs WHERE regexp_matches(text, {quoted})))
  WHERE {holds}""")
    kinds = ", ".join(f"'{k}'" for k, _, _ in patterns)
    listed = f"string_agg(list_extract([{kinds}], rank + 1) || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop)"
    count = ", ".join(f"count(*) FILTER (rank = {k}) AS n_{patterns[k][0]}" for k in range(3))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
found AS ({" UNION ALL".join(each)}),
base AS (SELECT * FROM found WHERE rank < 3),
weak AS (SELECT * FROM found f WHERE rank >= 3 AND NOT EXISTS (
  SELECT 1 FROM base b WHERE b.r = f.r AND b.start < f.stop AND b.stop > f.start)),
parts AS (SELECT *, rank IN (0, 2, 3) AS secret FROM (SELECT * FROM base UNION ALL SELECT * FROM weak)),
spans AS (SELECT r, rank, start, stop FROM parts p WHERE rank < 3 OR EXISTS (
  SELECT 1 FROM parts q WHERE q.r = p.r AND q.secret <> p.secret
  AND p.start - q.stop <= {reach} AND q.start - p.stop <= {reach})),
bases AS (SELECT r, {count}, {listed} AS listed FROM base GROUP BY r),
every AS (SELECT r, {listed} AS listed FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(bases.listed, '')) AS base_sha256, coalesce(every.listed, '') AS spans
FROM docs LEFT JOIN bases USING (r) LEFT JOIN every USING (r)"""


ORACLE = _oracle()
