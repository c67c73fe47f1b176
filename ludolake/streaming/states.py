"""Metrics kept by mergeable states: a micro-batch updates them by itself.

A state is an aggregate of raw rows whose parts can be merged: one row for each
day, group and user (or session, level, ad format) with flags (``max``) and
amounts (``sum``). A batch aggregates its own rows, merges them with the stored
rows of the days it touches, and the metrics of the dependent days are computed
from the states. No other raw file is read, and no raw or flat row is kept; what
is read again is the states of touched days (and of the 30 days after a cohort
day), which grow with active users, not with events.

| state | one row for each day and | holds |
| --- | --- | --- |
| person | version, country, user | which kinds of event they had, purchase revenue |
| ads | version, country, user, ad format | ad revenue |
| attempts | version, level, user | started, won, lost, first start |
| boosters | version, level, booster type | uses |
| engagement | version, platform, country, user, session | time, events, long events |

States and metrics are tables of a versioned warehouse (``plans.versions``),
published together with the number of the batch. A batch that is replayed after
a failure has either been published, then it is skipped, or it hasn't, then
nothing of it is visible: every row counts exactly once. Late rows of any day
are merged like others. Rows that vanish from raw can't be taken out of a state;
``versions.sync`` does that.

Each metric is the same function as in a full build, given the states in place
of the flat tables: it dedups and sums its inputs anyway.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.exact import money
from ..functions.params import with_params
from ..operators import metrics as M
from ..operators.flatten import flatten
from ..plans import versions as V
from ..plans.pipeline import METRIC_SHAPE, METRICS, MetricSpec, Sources
from ..schemas import METRIC_CLUSTER, RAW_SCHEMA
from ..session import checkpoint_dir
from ..sources.tables import PARTITION

USER = "user_pseudo_id"


@dataclass(frozen=True)
class State:
    name: str
    keys: list[str]
    #: column -> how it merges ("max", "min" or "sum")
    merge: dict[str, str]
    #: raw rows -> rows with the keys and columns, not yet merged
    rows: Callable[[DataFrame], DataFrame]

    def merged(self, rows: DataFrame) -> DataFrame:
        how = {"max": F.max, "min": F.min, "sum": F.sum}
        return rows.groupBy(*self.keys).agg(*[how[h](c).alias(c) for c, h in self.merge.items()])


def _person(raw: DataFrame) -> DataFrame:
    def had(event: str) -> Column:
        return F.col("event_name").eqNullSafe(F.lit(event))
    return raw.select(F.col("date_par").alias(PARTITION), "version", "country", USER,
                      had("first_open").alias("opened"), had("session_start").alias("active"),
                      had("user_engagement").alias("engaged"), had("in_app_purchase").alias("bought"),
                      F.when(had("in_app_purchase"), money("event_value_in_usd")).alias("revenue"))


def _ads(raw: DataFrame) -> DataFrame:
    return flatten(raw, "ad_impression").select(PARTITION, "version", "country", USER, "ad_format",
                                                money("value").alias("value"))


def _attempts(raw: DataFrame) -> DataFrame:
    # The three tables in one pass over the batch.
    flag = {"start_level": "started", "win_level": "won", "lose_level": "lost"}
    event = F.col("event_name")
    return with_params(raw.filter(event.isin(list(flag))), [
        (PARTITION, F.col("date_par")), ("version", F.col("version")), ("level", "level", "string"), (USER, F.col(USER)),
        ("event_timestamp", F.when(event == "start_level", F.col("event_timestamp"))),
        *[(column, event == table) for table, column in flag.items()]])


def _boosters(raw: DataFrame) -> DataFrame:
    return flatten(raw, "booster_used").select(PARTITION, "version", "level", "booster_type",
                                               F.lit(1).cast("long").alias("uses"))


STATES: dict[str, State] = {s.name: s for s in [
    State("state_person", [PARTITION, "version", "country", USER],
          {"opened": "max", "active": "max", "engaged": "max", "bought": "max", "revenue": "sum"}, _person),
    State("state_ads", [PARTITION, "version", "country", USER, "ad_format"], {"value": "sum"}, _ads),
    State("state_attempts", [PARTITION, "version", "level", USER],
          {"event_timestamp": "min", "started": "max", "won": "max", "lost": "max"}, _attempts),
    State("state_boosters", [PARTITION, "version", "level", "booster_type"], {"uses": "sum"}, _boosters),
    State("state_engagement", [PARTITION, "version", "platform", "country", USER, "session_id"],
          {"ms": "sum", "n": "sum", "n_long": "sum"},
          lambda raw: M.playtime_sessions(raw).withColumnRenamed("date_par", PARTITION)),
]}

#: What stands for a flat table: its state, the rows of it, and renamed columns.
_STANDS: dict[str, tuple[str, str | None, dict[str, str]]] = {
    "first_open": ("state_person", "opened", {}),
    "session_start": ("state_person", "active", {}),
    "user_engagement": ("state_person", "engaged", {}),
    "user_data": ("state_person", None, {}),
    "in_app_purchase": ("state_person", "bought", {"revenue": "event_value_in_usd"}),
    "ad_impression": ("state_ads", None, {}),
    "start_level": ("state_attempts", "started", {}),
    "win_level": ("state_attempts", "won", {}),
    "lose_level": ("state_attempts", "lost", {}),
    "booster_used": ("state_boosters", None, {}),
    "engagement": ("state_engagement", None, {}),
}


def _metric(name: str) -> MetricSpec:
    """The metric over states: boosters and engagement hold sums, not rows."""
    spec = METRICS[name]
    if name == "booster_type":
        return replace(spec, fn=lambda b: M.booster_type(b, times="uses"))
    if name == "level_booster2":
        return replace(spec, fn=lambda s, b: M.level_booster2(s, b, times="uses"))
    if name == "playtime":
        return replace(spec, inputs=["engagement"], scoped=["engagement"],
                       fn=lambda e: M.playtime_of(e.withColumnRenamed(PARTITION, "date_par")))
    return spec


def state_sources(spark: SparkSession, root: str, version: V.Version) -> Sources:
    """The metrics' inputs, read from the states of a version."""
    opened: dict[str, DataFrame] = {}

    def get(name: str) -> DataFrame:
        table, only, names = _STANDS[name]
        if table not in opened:
            opened[table] = V.read_version(spark, root, table, version)
        df = opened[table]
        return (df.filter(F.col(only)) if only else df).withColumnsRenamed(names)
    return get


def merge_batch(spark: SparkSession, batch: DataFrame, root: str, stream: str, number: int,
                metrics: list[str] | None = None, cohort_days: int = M.COHORT_MAX_DAY) -> V.Version:
    """Merge one batch of raw rows into the states, recompute the dependent
    days of the metrics from them, and publish both. ``stream`` and ``number``
    name the batch; one that was published before is skipped."""
    old = V.current(spark, root)
    if old.streams.get(stream, -1) >= number:
        return old
    names = metrics or [m for m, s in METRICS.items() if s.incremental]
    # One value for each day comes to the driver.
    days = {V._name(r[0]) for r in batch.select("date_par").distinct().collect()}
    new = replace(old, streams=old.streams | {stream: number})
    for state in STATES.values():
        rows = state.rows(batch)
        if state.name in old.days:
            stored = V.read_version(spark, root, state.name, old).filter(V.on_days(PARTITION, days))
            rows = rows.unionByName(stored)
        new = V.stage(state.merged(rows), root, state.name, new, days)
    before = state_sources(spark, root, old) if STATES.keys() <= old.days.keys() else None
    sources = state_sources(spark, root, new)
    known = set(new.days["state_person"])
    for name in names:
        touched = set(days)
        if name == "cohort":
            touched = V._before(days, cohort_days) & known
        if name == "winrate2":
            touched |= V.starter_days(before, sources, days)
        if touched:
            new = V.stage(_metric(name).build(sources, days=touched), root, name, new, touched,
                          METRIC_CLUSTER[METRIC_SHAPE[name]])
    return V.publish(spark, root, new)


def state_stream(spark: SparkSession, raw_path: str, root: str, checkpoint: str | None = None,
                 metrics: list[str] | None = None, stream: str = "raw", available_now: bool = True,
                 processing_time: str | None = None, max_files: int | None = None) -> StreamingQuery:
    """Follow the raw export, batch by batch. ``stream`` names the checkpoint:
    with a new checkpoint, give a new name and an empty root, as a new
    checkpoint reads all files again."""
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/ludolake-state-stream"
    source = spark.readStream.schema(RAW_SCHEMA).option("basePath", raw_path)
    if max_files:
        source = source.option("maxFilesPerTrigger", max_files)

    def on_batch(batch: DataFrame, number: int) -> None:
        merge_batch(batch.sparkSession, batch, root, stream, number, metrics)

    writer = source.parquet(raw_path).writeStream.foreachBatch(on_batch).option("checkpointLocation", ckpt)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
