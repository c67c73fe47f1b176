"""Lookback refreshes on written tables: daily runs, a gap, and the keys."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ludolake import __main__ as cli
from ludolake import oracle, queries
from ludolake.operators import metrics as M
from ludolake.plans import refresh as R
from ludolake.plans.pipeline import METRICS, USER_DATA
from ludolake.sources.tables import read_table, table_path
from tests.conftest import SF_MID

DAY = dt.date(2024, 1, 1)
KEYS = "user_pseudo_id string, event_date date, version string, country string"


@pytest.fixture
def loaded(spark, monkeypatch):
    """Sources up to ``state["last"]``: one user opens on each of the days 0, 1
    and 29, and all are active on all 33 days."""
    days = [DAY + dt.timedelta(days=i) for i in range(33)]
    active = [(f"u{o}", d, "1", "X") for o in (0, 1, 29) for d in days[o:]]
    frames = {"first_open": spark.createDataFrame([(f"u{o}", days[o], "1", "X") for o in (0, 1, 29)], KEYS),
              "session_start": spark.createDataFrame(active, KEYS).coalesce(1).cache(),
              USER_DATA: spark.createDataFrame(active, KEYS).coalesce(1).cache()}
    state = {"days": days, "last": days[0]}
    monkeypatch.setattr(R, "warehouse_sources", lambda *a, **k: lambda name: frames[name].filter(
        F.col("event_date") <= F.lit(state["last"])))
    state["full"] = {tuple(r) for r in M.cohort(frames["first_open"], frames["session_start"], frames[USER_DATA]).collect()}
    return state


def _rows(spark, root, columns):
    return sorted(map(str, (tuple(r) for r in read_table(spark, table_path(root, "cohort"), columns).collect())))


def test_daily_refreshes_equal_one_build(spark, tmp_path, loaded):
    root = str(tmp_path)
    R.build_metrics(spark, root, ["cohort"])
    columns = METRICS["cohort"].build(R.warehouse_sources(spark, root)).columns
    for day in loaded["days"][1:]:
        loaded["last"] = day
        R.refresh_metrics(spark, root, 30, ["cohort"], since=day)
    assert _rows(spark, root, columns) == sorted(map(str, loaded["full"])) and len(loaded["full"]) == 31 + 31 + 4


def test_refresh_after_a_gap(spark, tmp_path, loaded, monkeypatch):
    root, days = str(tmp_path), loaded["days"]
    loaded["last"] = days[28]
    R.build_metrics(spark, root, ["cohort"])
    columns = METRICS["cohort"].build(R.warehouse_sources(spark, root)).columns
    loaded["last"] = days[32]          # a gap of days, then append and refresh
    R.append_metrics(spark, root, ["cohort"])
    monkeypatch.setattr(cli, "read_raw_table", lambda *a: None)
    monkeypatch.setattr(cli, "configure", lambda s: spark)
    args = ["refresh", "--raw", "x", "--root", root, "--lookback", "30", "--metrics", "cohort"]
    cli.main([*args, "--since", str(days[29])])
    assert _rows(spark, root, columns) == sorted(map(str, loaded["full"]))


def test_short_lookback_keeps_and_recomputes(spark):
    spans = queries.cohort_lookback_short(spark, SF_MID).cache()
    kept = dt.date.fromisoformat(oracle.INCREMENTAL_CUTOFF) - dt.timedelta(days=oracle.SHORT_LOOKBACK_DAYS)
    assert spans.filter(F.col("event_date") <= F.lit(kept)).count() > 0
    assert spans.filter(F.col("event_date") > F.lit(kept)).count() > 0
    full = queries.metric_query("cohort")(spark, SF_MID)
    assert spans.exceptAll(full).count() + full.exceptAll(spans).count() > 0


def test_dashboard_slice_reads_the_written_table(spark):
    plan = queries.dashboard_slice(spark, SF_MID)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "Exchange" not in plan
