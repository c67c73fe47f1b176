"""Every registered query: ``(spark, sf_dir) -> DataFrame``.

Each query reads the test tables under ``sf_dir`` (the ``events`` table,
turned into raw events by ``sources.fixture``), derives the flat inputs it
needs and runs one operator of the engine over all of them.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import oracle
from .operators.flatten import FLAT_SPECS, flatten_all, rejects_view
from .operators.metrics import PLAYTIME_EVENTS, playtime
from .plans import refresh, versions
from .plans.pipeline import METRIC_SHAPE, METRICS, RAW, USER_DATA, derived_sources
from .plans.refresh import flat_increment, metric_increment
from .schemas import METRIC_CLUSTER, METRIC_COLUMNS, RAW_SCHEMA
from .session import checkpoint_dir, configure
from .sources.fixture import ALL_EVENTS, read_raw
from .sources.tables import read_raw_table, read_table, table_path, write_table
from .streaming import states

Query = Callable[[SparkSession, str], DataFrame]


def _raw_names(inputs: list[str]) -> list[str] | None:
    names: set[str] = set()
    for name in inputs:
        if name == USER_DATA:
            return None
        names.update(PLAYTIME_EVENTS if name == RAW else [FLAT_SPECS[name].event])
    return [n for n in ALL_EVENTS if n in names]


def sources_for(spark: SparkSession, sf_dir: str, inputs: list[str]):
    configure(spark)
    return derived_sources(read_raw(spark, sf_dir, _raw_names(inputs)))


def _cut(sources, before: dt.date):
    """Sources as they were when the data ended on ``before``."""
    def get(name: str) -> DataFrame:
        col = "date_par" if name == RAW else "event_date"
        return sources(name).filter(F.col(col) <= F.lit(before))
    return get


def flat_query(table: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return sources_for(spark, sf_dir, [table])(table)
    return q


def flat_incremental_query(table: str, cutoff: str = oracle.INCREMENTAL_CUTOFF) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        raw = read_raw(spark, sf_dir, None if table == USER_DATA else [FLAT_SPECS[table].event])
        target = derived_sources(raw)(table).filter(
            F.col("event_date") <= F.lit(dt.date.fromisoformat(cutoff)))
        return flat_increment(raw, table, target)
    return q


def metric_query(name: str) -> Query:
    spec = METRICS[name]

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spec.build(sources_for(spark, sf_dir, spec.inputs))
    return q


def metric_incremental_query(name: str, cutoff: str) -> Query:
    """The rows the scheduled append adds to a table built up to ``cutoff``."""
    spec = METRICS[name]

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        sources = sources_for(spark, sf_dir, spec.inputs)
        target = spec.build(_cut(sources, dt.date.fromisoformat(cutoff)))
        return metric_increment(spec, sources, target)
    return q


def _scratch_root(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _exported(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """The raw events as a written export under ``root``: jobs that read raw
    several times derive it from the test tables once, and read just the days
    and columns they need. No shuffle, so neither a day nor a user is one task."""
    refresh.write_raw(read_raw(spark, sf_dir), root, files_per_date=0)
    return read_raw_table(spark, table_path(root, refresh.RAW_TABLE))


def _refreshed_cohort(spark: SparkSession, sf_dir: str, cutoff: str, lookback_days: int) -> DataFrame:
    """The written cohort table after a build up to ``cutoff``, an append of
    the days since, and a lookback refresh."""
    configure(spark)
    root = _scratch_root(spark, "cohort-lookback")
    raw = _exported(spark, sf_dir, root)
    last = dt.date.fromisoformat(cutoff)
    early = raw.filter(F.col("date_par") <= F.lit(last))
    refresh.build_flat(spark, early, root)
    refresh.build_metrics(spark, root, ["cohort"], raw=early)
    refresh.append_flat(spark, raw, root, bootstrap=True)
    refresh.append_metrics(spark, root, ["cohort"], bootstrap=True, raw=raw)
    refresh.refresh_metrics(spark, root, lookback_days, ["cohort"], raw=raw, since=last + dt.timedelta(days=1))
    return read_table(spark, table_path(root, "cohort"), metric_query("cohort")(spark, sf_dir).columns)


def cohort_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohort table after a 30-day lookback refresh of a written table built up
    to the cohort cutoff. The test data spans fewer days than the lookback, so
    every day is recomputed: equal to a full build."""
    return _refreshed_cohort(spark, sf_dir, oracle.COHORT_CUTOFF, oracle.LOOKBACK_DAYS)


def cohort_lookback_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a later cutoff and a shorter lookback: the older days stay
    as they were written at the cutoff, the others are recomputed."""
    return _refreshed_cohort(spark, sf_dir, oracle.INCREMENTAL_CUTOFF, oracle.SHORT_LOOKBACK_DAYS)


def dashboard_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a dashboard reads: one version over a date range of a written
    metric table."""
    s = oracle.SLICE
    configure(spark)
    root = _scratch_root(spark, "dashboard-slice")
    df = metric_query("rev_iap_ads3")(spark, sf_dir)
    write_table(df, table_path(root, "rev_iap_ads3"), METRIC_CLUSTER[METRIC_SHAPE["rev_iap_ads3"]])
    return refresh.dashboard_slice(spark, root, "rev_iap_ads3", s["start"], s["end"],
                                   version=s["version"]).select(*df.columns)


def arrived_late(raw: DataFrame, before: bool) -> DataFrame:
    """The raw rows that were there before (or that came later): three old days
    lacked a fifth of the users, and the first opens of another fifth; days after
    the cutoff hadn't come."""
    user = F.substring("user_pseudo_id", 2, 20).cast("bigint")
    late = ((F.col("date_par") > F.lit(dt.date.fromisoformat(oracle.INCREMENTAL_CUTOFF)))
            | (F.col("date_par").isin([dt.date.fromisoformat(d) for d in oracle.LATE_DAYS])
               & ((user % 5 == 0) | ((user % 5 == 1) & (F.col("event_name") == "first_open")))))
    return raw.filter(~late if before else late)


def _synced(spark: SparkSession, sf_dir: str, metric: str) -> DataFrame:
    """The published table of a metric after the early rows were synced, and
    then all rows."""
    configure(spark)
    root = _scratch_root(spark, f"synced-{metric}")
    raw = _exported(spark, sf_dir, root)
    versions.sync(spark, arrived_late(raw, before=True), root, [metric])
    versions.sync(spark, raw, root, [metric])
    return versions.read_version(spark, root, metric, columns=METRIC_COLUMNS[metric])


def append_changed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cohort table after rows arrived late for three old days and new days
    were added: found by the day manifest, equal to a full build."""
    return _synced(spark, sf_dir, "cohort")


def winrate2_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """winrate2 after first opens arrived late: the days on which their users
    start levels are rewritten, equal to a full build."""
    return _synced(spark, sf_dir, "winrate2")


def states_rev_iap_ads3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue and reach kept by mergeable states: three batches of rows, cut
    across days and users, give a full build."""
    configure(spark)
    root = _scratch_root(spark, "states")
    part = F.pmod(F.xxhash64("user_pseudo_id", "event_name", "event_timestamp"), F.lit(3))
    # The batches are written in one pass, sorted by event, and each is read alone.
    path = table_path(root, "batches")
    write_table(read_raw(spark, sf_dir).withColumn("batch", part), path, ["event_name"], partition="batch",
                files_per_date=0)
    raw = spark.read.schema(T.StructType([*RAW_SCHEMA.fields, T.StructField("batch", T.LongType())])).parquet(path)
    for k in range(3):
        states.merge_batch(spark, raw.filter(F.col("batch") == k).drop("batch"), root, "batches", k, ["rev_iap_ads3"])
    return versions.read_version(spark, root, "rev_iap_ads3", columns=METRIC_COLUMNS["rev_iap_ads3"])


def with_duplicates(raw: DataFrame) -> DataFrame:
    """Raw rows in which some users' level starts hold their level twice."""
    level = F.filter("event_params", lambda p: p["key"] == "level")
    twice = ((F.col("event_name") == "start_level")
             & (F.substring("user_pseudo_id", 2, 20).cast("bigint") % oracle.DUPLICATE_USERS == 3))
    return raw.withColumn("event_params", F.when(twice, F.concat("event_params", level)).otherwise(F.col("event_params")))


def flatten_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept out of the flat layer for a parameter that occurs twice."""
    configure(spark)
    return rejects_view(flatten_all(with_duplicates(read_raw(spark, sf_dir)), rejects=True))


def playtime_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """playtime with the columns that the dashboard doesn't publish."""
    return playtime(sources_for(spark, sf_dir, [RAW])(RAW), extra=True)


def raw_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of a written export, read back with the declared schema: events
    and distinct users for each day and event."""
    configure(spark)
    root = _scratch_root(spark, "raw-export")
    refresh.write_raw(read_raw(spark, sf_dir), root)
    raw = read_raw_table(spark, table_path(root, refresh.RAW_TABLE))
    users = raw.groupBy("date_par", "event_name", "user_pseudo_id").agg(
        F.count("*").alias("n"), F.sum(F.size("event_params")).alias("params"))
    return users.groupBy("date_par", "event_name").agg(
        F.sum("n").alias("events"), F.count("user_pseudo_id").alias("users"), F.sum("params").alias("params"))


def _incremental_cutoff(name: str) -> str:
    return oracle.COHORT_CUTOFF if name == "cohort" else oracle.INCREMENTAL_CUTOFF


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for t in FLAT_SPECS:
        out[f"flatten_{t}"] = flat_query(t)
    out[USER_DATA] = flat_query(USER_DATA)
    for m in METRICS:
        out[m] = metric_query(m)
    for t in FLAT_SPECS:
        out[f"flatten_{t}_incremental"] = flat_incremental_query(t)
    for m, spec in METRICS.items():
        if spec.incremental:
            out[f"{m}_incremental"] = metric_incremental_query(m, _incremental_cutoff(m))
    out["cohort_lookback"] = cohort_lookback
    out["cohort_lookback_short"] = cohort_lookback_short
    out["dashboard_slice"] = dashboard_slice
    for q in (append_changed_days, winrate2_refresh, flatten_rejects, playtime_extra, raw_export,
              states_rev_iap_ads3):
        out[q.__name__] = q
    return out


def all_oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for t in FLAT_SPECS:
        out[f"flatten_{t}"] = oracle.flat_sql(t)
    out[USER_DATA] = oracle.flat_sql(USER_DATA)
    for m in METRICS:
        out[m] = oracle.metric_sql(m)
    for t in FLAT_SPECS:
        out[f"flatten_{t}_incremental"] = oracle.flat_incremental_sql(t)
    for m, spec in METRICS.items():
        if spec.incremental:
            out[f"{m}_incremental"] = oracle.metric_incremental_sql(m, _incremental_cutoff(m))
    out["cohort_lookback"] = oracle.metric_sql("cohort")
    out["cohort_lookback_short"] = oracle.cohort_refreshed_sql()
    out["dashboard_slice"] = oracle.dashboard_slice_sql()
    out["append_changed_days"] = oracle.metric_sql("cohort")
    out["winrate2_refresh"] = oracle.metric_sql("winrate2")
    out["flatten_rejects"] = oracle.rejects_sql()
    out["playtime_extra"] = oracle.playtime_extra_sql()
    out["raw_export"] = oracle.raw_export_sql()
    out["states_rev_iap_ads3"] = oracle.metric_sql("rev_iap_ads3")
    return out
