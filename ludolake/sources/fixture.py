"""Raw event export derived from the ``events`` test table.

The warehouse export this engine targets (one row per event, nested
``event_params``) does not exist in the test data. ``raw_events`` derives it
from ``events`` with the deterministic mapping of ``FIXTURES.md`` §2: every
source row emits one to nine raw events. The result has ``RAW_SCHEMA``.

Everything is row-wise except the "first event of the user" flag, which is a
per-user ``min_by`` aggregation (partial, map-side: safe even when one user
holds a third of all rows) joined back on the unique ``event_id``.

``names`` restricts the output to some event names, like a pushed-down
``event_name IN (...)`` filter; the first-event aggregation runs only when
``first_open`` is requested.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import EVENT_PARAM, RAW_SCHEMA

# --- fixed values of the mapping (FIXTURES.md §2) ---------------------------
AD_FORMATS = ["REWARDED", "INTER", "BANNER"]          # by k % 3
AD_PLATFORM = "ad_network"
AD_SOURCE = "ad_source_main"
CURRENCY = "USD"
HOUR_US = 3_600_000_000
# -----------------------------------------------------------------------------

ALL_EVENTS = (
    "first_open", "session_start", "start_level", "user_engagement", "screen_view",
    "win_level", "lose_level", "revive_level", "booster_used", "ad_impression",
    "ads_reward_complete", "in_app_purchase", "app_remove",
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table. Every raw event is derived row by row, so the
    scan's splits (``spark.sql.files.*`` of the session) are kept."""
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _p(key: str, slot: str, value: Column) -> Column:
    """One ``event_params`` entry, or NULL (omitted) when ``value`` is NULL."""
    v = {"string_value": F.lit(None).cast("string"),
         "int_value": F.lit(None).cast("bigint"),
         "double_value": F.lit(None).cast("double")}
    name = f"{slot}_value"
    v[name] = value.cast({"string": "string", "int": "bigint", "double": "double"}[slot])
    entry = F.struct(F.lit(key).alias("key"),
                     F.struct(*[c.alias(n) for n, c in v.items()]).alias("value"))
    return F.when(value.isNotNull(), entry)


def _params(*entries: Column) -> Column:
    if not entries:
        return F.array().cast(f"array<{EVENT_PARAM.simpleString()}>")
    # Nearly all rows have all entries; a filter with a lambda isn't compiled,
    # nor is anything inside it, so only rows that lack some pay for it.
    arr = F.array(*entries)
    return F.when(reduce(and_, [e.isNotNull() for e in entries]), arr).otherwise(F.filter(arr, lambda x: x.isNotNull()))


def _derived(events: DataFrame, with_first: bool) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    df = events.select(
        "event_id", "user_id", "event_type", "value",
        k.alias("k"), us.alias("us"), F.to_date("ts").alias("date_par"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
    )
    if with_first:
        # rn = 1 of row_number() per user ordered by (ts, event_id), as an
        # aggregation: min_by keeps one row per user in each map task.
        first = (events.groupBy("user_id")
                 .agg(F.min_by("event_id", F.struct("ts", "event_id")).alias("event_id"))
                 .withColumn("is_first", F.lit(True)))
        df = (df.join(first, ["user_id", "event_id"], "left")
              .withColumn("is_first", F.coalesce("is_first", F.lit(False))))
    else:
        df = df.withColumn("is_first", F.lit(False))
    return df


def raw_events(events: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """The raw nested event table (``RAW_SCHEMA``) for the given event names."""
    wanted = list(ALL_EVENTS if names is None else names)
    unknown = set(wanted) - set(ALL_EVENTS)
    if unknown:
        raise ValueError(f"unknown event names: {sorted(unknown)}")
    df = _derived(events, "first_open" in wanted)

    uid, k, t = F.col("user_id"), F.col("k"), F.col("event_type")
    day = F.dayofmonth("date_par")
    level_n = F.lit(1) + k % 8
    level = (F.when(k % 41 == 7, F.lit(None).cast("string"))
             .when(k % 17 == 3, F.concat(F.lit("0"), level_n.cast("string")))
             .otherwise(level_n.cast("string")))
    session_hour = F.call_function("div", F.col("us") - F.col("us") % HOUR_US, F.lit(1_000_000))
    cents = F.col("cents")
    null_str = F.lit(None).cast("string")

    specs: dict[str, tuple[Column, Column]] = {
        "first_open": ((F.col("is_first") & (uid % 19 != 4)) | ((k == 99) & (t == "signup")),
                       _params(_p("ga_session_id", "int", session_hour))),
        "session_start": (F.lit(True), _params(_p("ga_session_id", "int", session_hour))),
        "start_level": (F.lit(True), _params(_p("level", "string", level))),
        "user_engagement": (k % 23 != 22, _params(
            _p("ga_session_id", "int", session_hour),
            _p("engagement_time_msec", "int", F.when(k % 10 != 9, cents * 40)))),
        "screen_view": (k % 5 == 0, _params(
            _p("ga_session_id", "int", session_hour),
            _p("engagement_time_msec", "int", cents * 10))),
        "win_level": ((t == "click") | ((t == "purchase") & (k % 2 == 0)),
                      _params(_p("level", "string", level))),
        "lose_level": (t == "error", _params(_p("level", "string", level))),
        "revive_level": ((t == "error") & (k % 3 == 0), _params(
            _p("level", "string", level),
            _p("percent", "string", k.cast("string")),
            _p("lose_type", "string", F.concat(F.lit("type_"), (k % 3).cast("string"))))),
        "booster_used": (t == "signup", _params(
            _p("level", "int", level_n),
            _p("booster_type", "string", F.concat(F.lit("booster_"), (k % 4).cast("string"))))),
        "ad_impression": ((t == "view") | ((t == "click") & (k % 2 == 0)), _params(
            _p("ad_platform", "string", F.lit(AD_PLATFORM)),
            _p("ad_format", "string", F.element_at(F.array(*map(F.lit, AD_FORMATS)),
                                                   (k % 3 + 1).cast("int"))),
            _p("value", "double", F.col("value")),
            _p("ad_source", "string", F.lit(AD_SOURCE)),
            _p("currency", "string", F.lit(CURRENCY)))),
        "ads_reward_complete": ((t == "view") & (k % 3 == 0), _params(
            _p("placement", "string", F.concat(F.lit("p_"), (k % 5).cast("string"))))),
        "in_app_purchase": (t == "purchase", _params(
            _p("product_id", "string", F.concat(F.lit("product_"), (k % 4).cast("string"))),
            _p("price", "int", cents),
            _p("currency", "string", F.lit(CURRENCY)),
            _p("quantity", "int", F.lit(1)),
            _p("value", "int", cents))),
        "app_remove": (k == 98, _params()),
    }

    # The names come first and each row builds its own parameters alone: a reader
    # that needs no parameters (or those of one event) doesn't pay for the rest.
    # A column of its own, as an expression inside explode isn't compiled. Names
    # that don't apply are dropped after it: a filter of the array isn't compiled.
    version = F.when(uid % 13 == 12, null_str).otherwise(F.concat(
        F.lit("1."),
        (uid % 3 + F.when(day >= 16, 1).otherwise(0)
         + F.when((uid % 7 == 3) & (k % 2 == 1), 1).otherwise(0)).cast("string")))
    country = F.when(uid % 13 == 5, null_str).otherwise(
        F.concat(F.lit("NATION_"), (uid % 25).cast("string")))
    # What all events of a row have alike is made once, before they part.
    df = df.withColumns({
        "names": F.array(*[F.when(specs[n][0], F.lit(n)) for n in wanted]),
        "user_pseudo_id": F.concat(F.lit("u"), uid.cast("string")),
        "event_date": F.date_format("date_par", "yyyyMMdd"),
        "version": version,
        "country": country,
        "platform": F.when(uid % 2 == 0, "ANDROID").otherwise("IOS"),
    })
    params = None
    for n in wanted:
        cond = F.col("event_name") == F.lit(n)
        params = F.when(cond, specs[n][1]) if params is None else params.when(cond, specs[n][1])

    rows = df.select("*", F.explode("names").alias("event_name")).filter(F.col("event_name").isNotNull())
    return rows.select(
        "user_pseudo_id",
        "event_name",
        "event_date",
        "date_par",
        F.col("us").alias("event_timestamp"),
        "version",
        "country",
        "platform",
        F.when(F.col("event_name") == "in_app_purchase", F.col("value"))
         .cast("double").alias("event_value_in_usd"),
        params.alias("event_params"),
    ).select([F.col(f.name).cast(f.dataType) for f in RAW_SCHEMA.fields])


def read_raw(spark: SparkSession, sf_dir: str, names: Iterable[str] | None = None) -> DataFrame:
    return raw_events(read_events(spark, sf_dir), names)
