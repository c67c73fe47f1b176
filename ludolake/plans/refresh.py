"""Building and refreshing the flat and dashboard layers.

Three kinds of job, as scheduled upstream:

* **full build** (``CREATE OR REPLACE TABLE ... AS``): ``build_flat`` and
  ``build_metrics`` overwrite whole tables;
* **increment** (``INSERT INTO ... WHERE event_date > (SELECT max ...)``):
  ``append_flat`` / ``append_metrics`` read the target's high-water mark
  once on the driver and append only later days;
* **lookback refresh** (ours): ``refresh_metrics`` recomputes the last N
  days and replaces just those date partitions, which also repairs late data
  and later retention days of recent cohorts; ``refresh_days`` does the same
  for given raw days across both layers (the streaming job uses it).

Readers: ``warehouse_sources`` (inputs for the metric code),
``dashboard_slice`` (what a dashboard reads) and ``register_views`` (SQL).

Reruns are safe: an increment after a successful one finds nothing newer than
the mark, and a refresh rewrites the same partitions with the same rows.
Each job reads written tables, so lineage never grows across jobs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.flatten import (FLAT_EVENTS, FLAT_SPECS, USER_DATA_COLUMNS, WIDE_SORT,
                                 flat_view, flatten, flatten_all, user_data)
from ..schemas import METRIC_CLUSTER
from ..sources.tables import (high_water_mark, read_raw_table, read_table, table_exists,
                              table_high_water_mark, table_path, write_table)
from .pipeline import METRIC_SHAPE, METRICS, RAW, USER_DATA, MetricSpec, Sources

RAW_TABLE = "raw"


# ------------------------------------------------------------------ sources
def warehouse_sources(spark: SparkSession, root: str, raw: DataFrame | None = None) -> Sources:
    """Inputs read from materialized tables under ``root``; the raw event
    table is ``raw`` when given (the export usually lives elsewhere), else
    ``<root>/raw``."""
    opened: dict[str, DataFrame] = {}

    def table(name: str, **kw) -> DataFrame:
        # One relation per table and job: its file listing is done once and
        # shared by every view and branch that reads it.
        if name not in opened:
            opened[name] = read_table(spark, table_path(root, name), **kw)
        return opened[name]

    def get(name: str) -> DataFrame:
        if name == RAW:
            if raw is not None:
                return raw
            if RAW_TABLE not in opened:
                opened[RAW_TABLE] = read_raw_table(spark, table_path(root, RAW_TABLE))
            return opened[RAW_TABLE]
        if name == USER_DATA:
            return table(USER_DATA, columns=USER_DATA_COLUMNS)
        return flat_view(table(FLAT_EVENTS), name)
    return get


def write_raw(raw: DataFrame, root: str, files_per_date: int | None = None) -> None:
    """Materialize the raw event table, partitioned by ``date_par`` and
    sorted by ``event_name`` so each flat job skips other events' row groups."""
    write_table(raw, table_path(root, RAW_TABLE), ["event_name"], partition="date_par",
                files_per_date=files_per_date)


def _flat_df(raw: DataFrame, name: str, strict: bool) -> DataFrame:
    return user_data(raw) if name == USER_DATA else flatten(raw, name, strict=strict)


# --------------------------------------------------------------- full builds
def build_flat(spark: SparkSession, raw: DataFrame, root: str, strict: bool = True,
               files_per_date: int | None = None) -> None:
    """Overwrite the flat layer from the raw table.

    The 12 flat tables are one dataset, ``flat_events``, partitioned by day
    and event name and written from ONE scan of raw (``flatten_all``); each
    table is a partition-pruned view of it (``warehouse_sources``).
    ``user_data`` is its own table.
    """
    write_table(flatten_all(raw, strict), table_path(root, FLAT_EVENTS), WIDE_SORT,
                partition=["event_date", "event_name"], files_per_date=files_per_date)
    write_table(user_data(raw), table_path(root, USER_DATA), files_per_date=files_per_date)


def build_metrics(spark: SparkSession, root: str, metrics: list[str] | None = None,
                  raw: DataFrame | None = None) -> None:
    """Overwrite the dashboard tables from the flat tables under ``root``."""
    sources = warehouse_sources(spark, root, raw)
    for name in metrics or list(METRICS):
        _write_metric(METRICS[name], sources, root, "overwrite")


def _write_metric(spec: MetricSpec, sources: Sources, root: str, mode: str,
                  after=None) -> None:
    df = spec.build(sources, after=after)
    # Metric tables are small aggregates: the day rebalance of write_table
    # gives about one file per day.
    write_table(df, table_path(root, spec.name), METRIC_CLUSTER[METRIC_SHAPE[spec.name]],
                mode=mode, stale=lambda v: after is None or dt.date.fromisoformat(v[0]) > after)


# ---------------------------------------------------------------- increments
def flat_increment(raw: DataFrame, table: str, target: DataFrame | None,
                   hwm: str = "target", strict: bool = True) -> DataFrame:
    """Rows a scheduled run appends to flat table ``table``.

    ``hwm="target"``: days after the target's latest day (an empty or
    missing target gives no rows, like the warehouse's NULL comparison).
    ``hwm="source"``: the upstream script's literal form, comparing the raw
    table with its own maximum, which never selects a row.
    """
    if hwm == "target":
        mark = high_water_mark(target) if target is not None else None
    elif hwm == "source":
        mark = high_water_mark(raw, "date_par")
    else:
        raise ValueError("hwm must be 'target' or 'source'")
    df = _flat_df(raw, table, strict)
    if mark is None:
        return df.filter(F.lit(False))
    return df.filter(F.col("event_date") > F.lit(mark))


def metric_increment(spec: MetricSpec, sources: Sources, target: DataFrame | None,
                     bootstrap: bool = False, mark=None) -> DataFrame:
    """Rows a scheduled run appends to metric table ``spec.name``.

    The mark is the target's latest day (given, or computed from
    ``target``). Inputs are cut at it before any join or aggregation (see
    ``MetricSpec.scoped``), so only new days are read.
    """
    if mark is None and target is not None:
        mark = high_water_mark(target)
    if mark is None:
        df = spec.build(sources)
        return df if bootstrap else df.filter(F.lit(False))
    return spec.build(sources, after=mark)


def flat_marks(spark: SparkSession, root: str) -> dict[str, object]:
    """Latest day of each flat table, from the partition directories."""
    return table_high_water_mark(spark, table_path(root, FLAT_EVENTS), by="event_name")


def append_flat(spark: SparkSession, raw: DataFrame, root: str, hwm: str = "target",
                strict: bool = True, bootstrap: bool = False) -> list[str]:
    """Append new days to the flat layer in one pass over raw.

    Each flat table keeps its own mark: an event kind's rows are appended
    only for days after that kind's latest day. A kind with no rows yet gets
    none, like an empty target upstream, unless ``bootstrap`` is set, which
    loads all of its days. The kinds left out for that reason are returned.
    ``hwm="source"`` reproduces the upstream script, which compares raw with
    its own maximum: no rows.
    """
    if hwm == "source":
        marks = {spec.event: high_water_mark(raw, "date_par") for spec in FLAT_SPECS.values()}
    elif hwm == "target":
        marks = flat_marks(spark, root)
    else:
        raise ValueError("hwm must be 'target' or 'source'")
    keep = F.lit(False)
    for event, mark in marks.items():
        if mark is not None:
            keep = keep | ((F.col("event_name") == F.lit(event))
                           & (F.col("date_par") > F.lit(mark)))
    known = [m for m in marks.values() if m is not None]
    without = sorted({spec.event for spec in FLAT_SPECS.values()} - {e for e, m in marks.items() if m is not None})
    if bootstrap and hwm == "target":
        keep = keep | F.col("event_name").isin(without)
        without = []
    elif known:
        # The earliest mark as a plain day predicate: partition pruning on
        # raw does not depend on splitting the per-event disjunction.
        keep = keep & (F.col("date_par") > F.lit(min(known)))
    write_table(flatten_all(raw.filter(keep), strict), table_path(root, FLAT_EVENTS),
                WIDE_SORT, mode="append", partition=["event_date", "event_name"])
    path = table_path(root, USER_DATA)
    if hwm == "source":
        inc = flat_increment(raw, USER_DATA, None, hwm="source")
    else:
        mark = table_high_water_mark(spark, path)
        if mark is None and bootstrap:
            inc = user_data(raw)
        else:
            inc = user_data(raw.filter(F.lit(mark is not None) & (F.col("date_par") > F.lit(mark))))
    write_table(inc, path, mode="append")
    return without


def append_metrics(spark: SparkSession, root: str, metrics: list[str] | None = None,
                   bootstrap: bool = False, raw: DataFrame | None = None) -> None:
    """Append new days to the dashboard tables."""
    sources = warehouse_sources(spark, root, raw)
    for name in metrics or [m for m, s in METRICS.items() if s.incremental]:
        spec = METRICS[name]
        path = table_path(root, name)
        mark = table_high_water_mark(spark, path)
        df = metric_increment(spec, sources, None, bootstrap=bootstrap, mark=mark)
        write_table(df, path, METRIC_CLUSTER[METRIC_SHAPE[name]], mode="append")


def lookback_start(mark, lookback_days: int):
    """The day before the first one that a lookback refresh rewrites: the rows
    of the day ``lookback_days`` before the mark still depend on it."""
    return mark - dt.timedelta(days=lookback_days + 1) if mark is not None else None


def refresh_metrics(spark: SparkSession, root: str, lookback_days: int = 30,
                    metrics: list[str] | None = None, raw: DataFrame | None = None,
                    since: dt.date | None = None) -> None:
    """Recompute the days from ``since - lookback_days`` on and replace just
    those partitions (dynamic overwrite). ``since`` is the first day loaded
    since the last refresh; without it, the target's latest day, which is
    right when one day is loaded at a time. Cohort needs ``lookback_days >=
    30``. A missing target is an error: build it first."""
    sources = warehouse_sources(spark, root, raw)
    for name in metrics or [m for m, s in METRICS.items() if s.incremental]:
        spec = METRICS[name]
        path = table_path(root, name)
        mark = table_high_water_mark(spark, path)
        if mark is None:
            raise ValueError(f"{name} has not been built under {root}")
        first = min(since, mark) if since is not None else mark
        _write_metric(spec, sources, root, "dynamic", after=lookback_start(first, lookback_days))


def refresh_days(spark: SparkSession, raw: DataFrame, root: str, days: list,
                 metrics: list[str] | None = None, cohort_lookback: int = 30,
                 strict: bool = True) -> None:
    """Recompute everything that depends on the given raw days.

    The flat layer and ``user_data`` are rebuilt for exactly those days
    (dynamic partition overwrite), then every metric is recomputed from the
    earliest of them on (cohort from ``cohort_lookback`` days before, as its
    rows for a cohort day depend on later sessions). Idempotent: running it
    twice writes the same partitions with the same rows, so late data for a
    day is absorbed by rerunning that day.
    """
    if not days:
        return
    on_days = raw.filter(F.col("date_par").isin(sorted(days)))
    listed = {str(d) for d in days}
    write_table(flatten_all(on_days, strict), table_path(root, FLAT_EVENTS), WIDE_SORT,
                mode="dynamic", partition=["event_date", "event_name"], stale=lambda v: v[0] in listed)
    write_table(user_data(on_days), table_path(root, USER_DATA), mode="dynamic",
                stale=lambda v: v[0] in listed)
    sources = warehouse_sources(spark, root, raw)
    first = min(days)
    for name in metrics or [m for m, s in METRICS.items() if s.incremental]:
        back = cohort_lookback if name == "cohort" else 0
        _write_metric(METRICS[name], sources, root, "dynamic",
                      after=first - dt.timedelta(days=back + 1))


def dashboard_slice(spark: SparkSession, root: str, metric: str, start, end,
                    version: str | None = None, country: str | None = None) -> DataFrame:
    """What a dashboard reads: a metric table over a day range, optionally
    one version and one country. The day range prunes partitions at
    planning; version and country reach the Parquet scan as pushed filters,
    which skip row groups because files are sorted by the cluster keys."""
    df = read_table(spark, table_path(root, metric))
    cond = F.col("event_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    if version is not None:
        cond = cond & (F.col("version") == F.lit(version))
    if country is not None:
        cond = cond & (F.col("country") == F.lit(country))
    return df.filter(cond)


def register_views(spark: SparkSession, root: str, raw: DataFrame | None = None) -> list[str]:
    """Register the flat tables, ``user_data`` and the metric tables found
    under ``root`` as temporary views, for ``spark.sql`` users. Returns
    the view names."""
    sources = warehouse_sources(spark, root, raw)
    names = []
    for name in list(FLAT_SPECS) + [USER_DATA]:
        if table_exists(spark, table_path(root, USER_DATA if name == USER_DATA else FLAT_EVENTS)):
            sources(name).createOrReplaceTempView(name)
            names.append(name)
    for name in METRICS:
        path = table_path(root, name)
        if table_exists(spark, path):
            read_table(spark, path).createOrReplaceTempView(name)
            names.append(name)
    return names
