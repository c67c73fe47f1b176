"""Flat → dashboard: the metric tables.

Each function takes flat-table DataFrames and returns the metric DataFrame in
the dashboard's column order; no I/O. The plans are written so that

* every distinct count runs on rows first reduced to one row per
  (group, user) with partial map-side aggregation, so a hot group or a hot
  user never ships its raw rows to one reducer;
* conditional distinct counts become per-user flags and plain sums, instead
  of Spark's ``Expand`` (one copy of every row per distinct aggregate);
* joins on ``user_pseudo_id`` see deduplicated sides, which bounds the fan-out
  of a hot user to a few rows per day;
* no side is broadcast by hint: AQE broadcasts a side only when its measured
  size is under ``spark.sql.autoBroadcastJoinThreshold``.

Join keys compare with ``=``: NULL version, country or level never match, as
in the warehouse SQL. ``GROUP BY`` keeps NULL groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.casts import safe_int, strict_int
from ..functions.exact import COUNT_FACTOR, MONEY_ADDEND, MONEY_FACTOR, money, ratio2
from ..functions.params import with_params
from ..schemas import METRIC_COLUMNS

USER = "user_pseudo_id"
DAY = "event_date"

# --- fixed values ------------------------------------------------------------
PLAYTIME_EVENTS = ["user_engagement", "session_start", "first_open", "screen_view"]
REWARDED = "REWARDED"
INTER = "INTER"
COHORT_MAX_DAY = 30
LONG_SESSION_MS = 300_000
# -----------------------------------------------------------------------------


def _out(df: DataFrame, name: str) -> DataFrame:
    return df.select(*METRIC_COLUMNS[name])


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def _distinct_users(df: DataFrame, keys: list[str], alias: str) -> DataFrame:
    """``COUNT(DISTINCT user)`` per ``keys``: dedup (partial, map-side) then count."""
    return (df.select(*keys, USER).distinct()
            .groupBy(*keys).agg(F.count(USER).alias(alias)))


# ---------------------------------------------------------------- new_user / dau
def new_user(first_open: DataFrame) -> DataFrame:
    """Distinct users with a ``first_open`` per (day, country, version)."""
    return _out(_distinct_users(first_open, [DAY, "country", "version"], "new_user"),
                "new_user")


def dau(session_start: DataFrame) -> DataFrame:
    """Distinct users with a ``session_start`` per (day, country, version)."""
    return _out(_distinct_users(session_start, [DAY, "country", "version"], "dau"), "dau")


# ------------------------------------------------------------------- playtime
def playtime(raw: DataFrame, extra: bool = False) -> DataFrame:
    """Sessions and engagement time per (version, day, platform, country).

    Reads the raw table (engagement time is a parameter of four event kinds).
    Only rows with an engagement time count. ``total_sessions`` counts
    distinct session ids of the group, not per user. Averages are exact
    integer ratios rounded half up (``ratio2``); ``extra`` adds the
    computed-but-unpublished ``cohort_size``, ``total_playtime_hours`` and
    ``pct_long_sessions``.
    """
    return playtime_of(playtime_sessions(raw), extra)


_GROUP = ["version", "date_par", "platform", "country"]


def playtime_sessions(raw: DataFrame) -> DataFrame:
    """One row for each group, user and session: engagement time, events and
    long events. Such rows can be merged by sums."""
    # The key test is a cheap, code-generated pre-filter (a row without the
    # key has no engagement time); the exact NULL test follows.
    has_time = F.array_contains(F.col("event_params")["key"], F.lit("engagement_time_msec"))
    rows = (with_params(raw.filter(F.col("event_name").isin(PLAYTIME_EVENTS) & has_time),
                        [(c, F.col(c)) for c in _GROUP + [USER]]
                        + [("ms", "engagement_time_msec", "int"),
                           ("session_id", "ga_session_id", "int")])
            .filter(F.col("ms").isNotNull()))
    return rows.groupBy(*_GROUP, USER, "session_id").agg(
        F.sum("ms").alias("ms"), F.count("*").alias("n"),
        F.count_if(F.col("ms") >= LONG_SESSION_MS).alias("n_long"))


def playtime_of(each: DataFrame, extra: bool = False) -> DataFrame:
    """``playtime`` from the rows of ``playtime_sessions``.

    Such a row stands once for its user and once for its session; each is
    counted once in its group. Raw rows are never multiplied (as Spark's
    ``Expand`` for two distinct counts would), and no hot group or user sends
    more than its users and sessions.
    """
    keys = _GROUP
    none = F.lit(0).cast("bigint")
    n_sessions = F.when(F.col("session_id").isNotNull(), F.col("n")).otherwise(none)
    stands = F.array(
        F.struct(F.lit("user").alias("kind"), F.col(USER).alias("id"), F.col("ms").alias("ms"), F.col("n").alias("n"),
                 n_sessions.alias("n_sessions"), F.col("n_long").alias("n_long")),
        F.when(F.col("session_id").isNotNull(), F.struct(
            F.lit("session").alias("kind"), F.col("session_id").cast("string").alias("id"), none.alias("ms"),
            none.alias("n"), none.alias("n_sessions"), none.alias("n_long"))))
    sums = [F.sum(c).alias(c) for c in ("ms", "n", "n_sessions", "n_long")]
    once = (each.select(*keys, F.explode(F.filter(stands, lambda x: x.isNotNull())).alias("e"))
            .select(*keys, "e.*").groupBy(*keys, "kind", "id").agg(*sums))
    counted = F.col("id").isNotNull()
    agg = once.groupBy(*keys).agg(
        F.count_if((F.col("kind") == "user") & counted).alias("users"),
        F.count_if((F.col("kind") == "session") & counted).alias("total_sessions"),
        F.sum("ms").alias("sum_ms"), F.sum("n").alias("n_ms"), F.sum("n_sessions").alias("n_sessions"),
        F.sum("n_long").alias("n_long"))
    out = agg.select(
        "version", F.col("date_par").alias(DAY), "platform", "country", "total_sessions",
        ratio2("sum_ms", F.col("n_ms") * 60_000).alias("avg_session_length_minutes"),
        ratio2("total_sessions", "users").alias("avg_sessions_per_user"),
        ratio2("sum_ms", F.col("users") * 60_000).alias("avg_playtime_per_user_minutes"),
        F.col("users").alias("cohort_size"),
        ratio2("sum_ms", F.lit(3_600_000)).alias("total_playtime_hours"),
        ratio2(F.col("n_long") * 100, "n_sessions").alias("pct_long_sessions"),
    )
    cols = METRIC_COLUMNS["playtime"]
    if extra:
        cols = cols + ["cohort_size", "total_playtime_hours", "pct_long_sessions"]
    return out.select(*cols)


# --------------------------------------------------------------------- cohort
def cohort(first_open: DataFrame, session_start: DataFrame, user_data: DataFrame,
           max_day: int = COHORT_MAX_DAY) -> DataFrame:
    """Day-N retention per (cohort day, day offset, version, country).

    A cohort member is every ``first_open`` row (a user opening on two days is
    in two cohorts); the member's version and country come from
    ``user_data`` of that day (several pairs: counted under each). Retained on
    offset N (0..max_day, inclusive) = had a session N days after the cohort
    day. Offsets without retained users have no row.
    """
    # Members without a version or country on their cohort day are dropped
    # by both consumers (the retention join and the final join with the
    # base), so the warehouse's LEFT join is an inner join on non-NULL info.
    # Both consumers read this one subtree; AQE reuses its shuffle stages.
    info = (user_data.filter(F.col(USER).isNotNull() & F.col("version").isNotNull()
                             & F.col("country").isNotNull())
            .select(USER, F.col(DAY).alias("cohort_date"), "version", "country"))
    members = (first_open.filter(F.col(USER).isNotNull())
               .select(USER, F.col(DAY).alias("cohort_date")).distinct()
               .join(info, [USER, "cohort_date"])
               .distinct())
    # One row per user and active day: partial dedup before the shuffle, so
    # a hot user sends at most one row per day and map task.
    sessions = session_start.select(USER, DAY).distinct()
    offset = F.datediff(F.col(DAY), F.col("cohort_date"))
    # The offset condition as an equality: a member's days lie in the interval
    # of its cohort day or in the next one, a session in exactly one. So no
    # task joins a user's whole history, however long it is.
    width = max_day + 1
    interval = F.floor(F.unix_date(DAY) / width)
    reach = members.withColumn("interval", F.explode(F.sequence(
        F.floor(F.unix_date("cohort_date") / width), F.floor((F.unix_date("cohort_date") + max_day) / width))))
    retained = (reach.join(sessions.withColumn("interval", interval), [USER, "interval"])
                .filter(offset.between(0, max_day))
                # members and sessions are deduplicated: each user occurs once
                # per (cohort_date, day, version, country), so count = distinct.
                .groupBy("cohort_date", DAY, "version", "country")
                .agg(F.count(USER).alias("retained_user"))
                .withColumn("days_since_first_open", offset.cast("bigint")))
    base = members.groupBy("cohort_date", "version", "country").agg(
        F.count(USER).alias("total_users"))
    out = (retained.join(base, ["cohort_date", "version", "country"])
           .select(F.col("cohort_date").alias(DAY), "days_since_first_open", "version",
                   "country", "total_users", "retained_user",
                   ratio2(F.col("retained_user") * 100, "total_users").alias("retention_rate")))
    return _out(out, "cohort")


# --------------------------------------------------- ad reach and revenue
_UDVC = [USER, DAY, "version", "country"]


def _engaged(user_engagement: DataFrame) -> DataFrame:
    """One row per (user, day, version, country) with engagement."""
    return user_engagement.select(*_UDVC).distinct()


def _ads_reach(ad_impression: DataFrame) -> DataFrame:
    """Per (user, day, version, country): was a rewarded / interstitial ad shown."""
    fmt = F.col("ad_format")
    return ad_impression.groupBy(*_UDVC).agg(
        F.max(_flag(fmt == REWARDED)).alias("rw"),
        F.max(_flag(fmt == INTER)).alias("inter"),
    )


def _ads_per_user(ad_impression: DataFrame) -> DataFrame:
    """Ad impressions collapsed to one row per (user, day, version, country).

    First one row per ad format (the warehouse's pre-aggregation), then per
    user: ``n_formats`` counts those rows (NULL is a format group), because
    the warehouse joins one row per format, which multiplies a user's
    purchase revenue; it is kept to reproduce that. Both steps are
    fixed-width hash aggregations with map-side partial aggregation.
    """
    fmt = F.col("ad_format")
    per_format = ad_impression.groupBy(*_UDVC, "ad_format").agg(
        F.sum(money("value")).alias("ads"))
    return per_format.groupBy(*_UDVC).agg(
        F.max(_flag(fmt == REWARDED)).alias("rw"),
        F.max(_flag(fmt == INTER)).alias("inter"),
        F.sum("ads").alias("ads"),
        F.count("*").alias("n_formats"),
    )


def _reach(engaged: DataFrame, ads: DataFrame) -> DataFrame:
    return engaged.join(ads, _UDVC, "left")


def ads_inter_rw_cnt(user_engagement: DataFrame, ad_impression: DataFrame) -> DataFrame:
    """Engaged users, and those of them shown rewarded / interstitial ads,
    per (day, version, country)."""
    j = _reach(_engaged(user_engagement), _ads_reach(ad_impression))
    out = j.groupBy(DAY, "version", "country").agg(
        F.count(USER).alias("total_user"),
        F.sum(F.coalesce("rw", F.lit(0))).cast("bigint").alias("ad_rw_count"),
        F.sum(F.coalesce("inter", F.lit(0))).cast("bigint").alias("ad_inter_count"),
    )
    return _out(out, "ads_inter_rw_cnt")


def rev_iap_ads3(user_engagement: DataFrame, ad_impression: DataFrame,
                 in_app_purchase: DataFrame, corrected: bool = False) -> DataFrame:
    """Purchase and ad revenue plus ad reach per (day, version, country).

    Only revenue of users with engagement that day, version and country is
    counted. The warehouse query adds a user's purchase revenue once per ad
    format the user saw that day; ``corrected=True`` counts it once.
    Money is summed as DECIMAL (exact, order-independent), then DOUBLE.
    """
    iap = in_app_purchase.groupBy(*_UDVC).agg(F.sum(money("event_value_in_usd")).alias("iap"))
    j = _reach(_engaged(user_engagement), _ads_per_user(ad_impression)).join(iap, _UDVC, "left")
    iap_term = F.col("iap") if corrected else (
        F.col("iap").cast(MONEY_FACTOR) * F.coalesce("n_formats", F.lit(1)).cast(COUNT_FACTOR))
    zero = F.lit(0).cast("decimal(38,12)")
    agg = j.groupBy(DAY, "version", "country").agg(
        F.count(USER).alias("total_user"),
        F.sum(F.coalesce("rw", F.lit(0))).cast("bigint").alias("ad_rw_count"),
        F.sum(F.coalesce("inter", F.lit(0))).cast("bigint").alias("ad_inter_count"),
        F.coalesce(F.sum("ads"), zero).alias("ads_dec"),
        F.coalesce(F.sum(iap_term), zero).alias("iap_dec"),
    )
    out = agg.select(
        DAY, "version", "country",
        F.col("iap_dec").cast("double").alias("iap_rev"),
        F.col("ads_dec").cast("double").alias("ads_rev"),
        (F.col("iap_dec").cast(MONEY_ADDEND) + F.col("ads_dec").cast(MONEY_ADDEND)).cast("double").alias("total_revenue"),
        "total_user", "ad_rw_count", "ad_inter_count",
    )
    return _out(out, "rev_iap_ads3")


# -------------------------------------------------------------------- winrate2
def winrate2(start_level: DataFrame, win_level: DataFrame, lose_level: DataFrame,
             first_open: DataFrame) -> DataFrame:
    """Win percentage per (day, version, integer level).

    Starters are restricted to users with a ``first_open`` on any day. Per
    (day, version, level string, user) a start counts once, and a win / loss
    with the same day, version and level string counts once each. The level
    is then cast (``SAFE_CAST``) and the groups merged: ``'1'`` and ``'01'``
    of one user count twice.
    """
    k = [USER, DAY, "version", "level"]
    # Dedup each side on the same four keys first (partial, map-side): the
    # three aggregates share one hash partitioning, so both left joins run
    # without another shuffle, and the first_open filter then sees one row
    # per user, day, version and level (a hot user sends few rows).
    starts = start_level.select(*k).distinct()
    wins = win_level.select(*k).distinct().withColumn("w", F.lit(1))
    losses = lose_level.select(*k).distinct().withColumn("l", F.lit(1))
    # ``IN (SELECT DISTINCT user FROM first_open)`` as an inner join with the
    # distinct users, after the outcome joins: a semi join here would be
    # pushed below them and reshuffle the starts twice.
    j = (starts.join(wins, k, "left").join(losses, k, "left")
         .join(first_open.select(USER).distinct(), USER))
    agg = j.groupBy(DAY, "version", safe_int("level").alias("level")).agg(
        F.count("*").alias("user_start"),
        F.sum(F.coalesce("w", F.lit(0))).cast("bigint").alias("event_win"),
        F.sum(F.coalesce("l", F.lit(0))).cast("bigint").alias("event_lose"),
    )
    out = agg.withColumn(
        "winrate", ratio2(F.col("event_win") * 100, F.col("event_win") + F.col("event_lose")))
    return _out(out, "winrate2")


# -------------------------------------------------------------- level_booster2
def _uses(times: str | None) -> Column:
    return F.count("*") if times is None else F.sum(times)


def level_booster2(start_level: DataFrame, booster_used: DataFrame, times: str | None = None) -> DataFrame:
    """Boosters used and distinct starters per (day, version, integer level).
    A booster row stands for one use, or for as many as column ``times`` says.

    ``num_booster`` is NULL where no booster was used at a started level;
    boosters at levels nobody started are not reported.
    """
    g = [DAY, "version", safe_int("level").alias("level")]
    boosters = booster_used.groupBy(*g).agg(_uses(times).alias("num_booster"))
    starts = (start_level.select(DAY, "version", safe_int("level").alias("level"), USER)
              .distinct().groupBy(DAY, "version", "level")
              .agg(F.count(USER).alias("user_start")))
    out = starts.join(boosters, [DAY, "version", "level"], "left")
    return _out(out, "level_booster2")


def booster_type(booster_used: DataFrame, times: str | None = None) -> DataFrame:
    """Booster-use events per (day, version, booster type); a row stands for
    one, or for as many as column ``times`` says."""
    out = booster_used.groupBy(DAY, "version", "booster_type").agg(
        _uses(times).alias("num_booster_used"))
    return _out(out, "booster_type")


# ------------------------------------------------------------------ drop_final
def _level_stats(start_level: DataFrame) -> DataFrame:
    """Distinct starters per (day, version, level) with a failing level cast."""
    return (start_level.select(DAY, "version", strict_int("level", "level").alias("level"), USER)
            .distinct().groupBy(DAY, "version", "level")
            .agg(F.count(USER).alias("user_start")))


def drop_final(start_level: DataFrame) -> DataFrame:
    """Starters of level n and of level n+1 (same day and version).

    The next-level count is clamped to ``user_start - 1`` when it is not
    smaller, and NULL when level n+1 has no starters (or a key is NULL).
    The self join on ``level + 1`` is a one-row range frame over the small
    per-level table.
    """
    stats = _level_stats(start_level)
    w = Window.partitionBy(DAY, "version").orderBy("level").rangeBetween(1, 1)
    keys_ok = F.col(DAY).isNotNull() & F.col("version").isNotNull() & F.col("level").isNotNull()
    nxt = F.when(keys_ok, F.max("user_start").over(w))
    out = (stats.withColumn("next", nxt)
           .withColumn("user_start_next_level",
                       F.when(F.col("next") >= F.col("user_start"), F.col("user_start") - 1)
                       .otherwise(F.col("next"))))
    return _out(out, "drop_final")


def drop_rate3(start_level: DataFrame) -> DataFrame:
    """User-level continuation: starters of level n who also started n+1.

    First start per (day, version, user, level) by ``event_timestamp``
    (``ROW_NUMBER() = 1`` as a ``min`` aggregation, partial map-side). The
    self join on (user, day, version, level + 1) becomes a one-row range
    frame per (day, version, user): does the same user have level - 1?
    Each start then counts once for its own level and, when it continues
    one, once for the level below, in a single aggregation (one scan, no
    join). Published in the warehouse only as a disabled query; fully
    specified, so built.
    """
    first = (start_level
             .select(DAY, "version", USER, strict_int("level", "level").alias("level"),
                     "event_timestamp")
             .groupBy(DAY, "version", USER, "level")
             .agg(F.min("event_timestamp").alias("first_ts")))
    w = Window.partitionBy(DAY, "version", USER).orderBy("level").rangeBetween(-1, -1)
    keys_ok = (F.col(DAY).isNotNull() & F.col("version").isNotNull()
               & F.col(USER).isNotNull() & F.col("level").isNotNull())
    flagged = first.withColumn(
        "continues", F.coalesce(F.when(keys_ok, F.count("*").over(w)), F.lit(0)) > 0)
    continues = F.col("continues")
    user = F.when(F.col(USER).isNotNull(), F.lit(1)).otherwise(F.lit(0))
    parts = F.array(
        F.struct(F.col("level").alias("k"), user.alias("start"), F.lit(0).alias("next")),
        F.when(continues, F.struct((F.col("level") - 1).alias("k"), F.lit(0).alias("start"),
                                   F.lit(1).alias("next"))),
    )
    out = (flagged.select(DAY, "version", F.explode(parts).alias("c"))
           .filter(F.col("c").isNotNull())
           .groupBy(DAY, "version", F.col("c.k").alias("level"))
           .agg(F.sum("c.start").cast("bigint").alias("user_start"),
                F.sum("c.next").cast("bigint").alias("user_start_next_level"))
           .withColumn("retention_rate",
                       ratio2(F.col("user_start_next_level") * 100, "user_start")))
    return _out(out, "drop_rate3")
