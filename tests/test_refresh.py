"""Full builds, scheduled increments and lookback refresh on disk."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ludolake.plans import refresh as R
from ludolake.plans.pipeline import FLAT_TABLES, METRICS
from ludolake.sources.fixture import read_raw
from ludolake.sources.tables import read_table, table_path
from tests.conftest import SF_SMALL

CUTOFF = dt.date(2024, 1, 20)


def rows(df):
    return sorted(df.collect(), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture(scope="module")
def warehouses(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("wh")
    raw = read_raw(spark, SF_SMALL)
    full, inc = str(base / "full"), str(base / "inc")
    R.write_raw(raw, full)
    raw_t = read_table(spark, table_path(full, R.RAW_TABLE), partition="date_par")
    # full build over all days
    R.build_flat(spark, raw_t, full)
    R.build_metrics(spark, full)
    # a warehouse built while the data ended at the cutoff, then appended to
    raw_cut = raw_t.filter(F.col("date_par") <= F.lit(CUTOFF))
    R.build_flat(spark, raw_cut, inc)
    R.build_metrics(spark, inc, raw=raw_cut)
    R.append_flat(spark, raw_t, inc)
    R.append_metrics(spark, inc, raw=raw_t)
    return spark, raw_t, full, inc


@pytest.mark.parametrize("table", FLAT_TABLES)
def test_flat_append_equals_full_build(warehouses, table):
    spark, _, full, inc = warehouses
    a = R.warehouse_sources(spark, full)(table)
    b = R.warehouse_sources(spark, inc)(table)
    assert a.columns == b.columns
    assert rows(a) == rows(b)


@pytest.mark.parametrize("table", FLAT_TABLES)
def test_flat_layer_equals_per_table_flatten(warehouses, table):
    spark, raw_t, full, _ = warehouses
    a = R.warehouse_sources(spark, full)(table)
    b = R._flat_df(raw_t, table, strict=True)
    assert a.columns == b.columns
    assert rows(a) == rows(b)


@pytest.mark.parametrize("name", [m for m, s in METRICS.items() if s.incremental and m != "cohort"])
def test_metric_append_equals_full_build(warehouses, name):
    spark, _, full, inc = warehouses
    a = read_table(spark, table_path(full, name))
    b = read_table(spark, table_path(inc, name), a.columns)
    assert rows(a) == rows(b)


def test_cohort_append_is_stale_and_lookback_repairs_it(warehouses):
    spark, _, full, inc = warehouses
    a = read_table(spark, table_path(full, "cohort"))
    b = read_table(spark, table_path(inc, "cohort"), a.columns)
    assert rows(a) != rows(b)          # cohorts up to the cutoff missed later days
    R.refresh_metrics(spark, inc, lookback_days=30, metrics=["cohort"])
    spark.catalog.clearCache()
    c = read_table(spark, table_path(inc, "cohort"), a.columns)
    assert rows(a) == rows(c)


def test_rerun_appends_nothing(warehouses):
    spark, raw_t, _, inc = warehouses
    before = {m: read_table(spark, table_path(inc, m)).count() for m in ["dau", "winrate2"]}
    flat_before = R.warehouse_sources(spark, inc)("first_open").count()
    R.append_metrics(spark, inc, ["dau", "winrate2"], raw=raw_t)
    R.append_flat(spark, raw_t, inc)
    after = {m: read_table(spark, table_path(inc, m)).count() for m in ["dau", "winrate2"]}
    assert before == after
    assert R.warehouse_sources(spark, inc)("first_open").count() == flat_before


def test_source_high_water_mark_selects_nothing(warehouses):
    spark, raw_t, _, inc = warehouses
    target = R.warehouse_sources(spark, inc)("start_level")
    assert R.flat_increment(raw_t, "start_level", target, hwm="source").count() == 0
    before = R.warehouse_sources(spark, inc)("win_level").count()
    R.append_flat(spark, raw_t, inc, hwm="source")
    assert R.warehouse_sources(spark, inc)("win_level").count() == before


def test_empty_target_appends_nothing_unless_bootstrap(warehouses):
    spark, _, full, _ = warehouses
    sources = R.warehouse_sources(spark, full)
    spec = METRICS["dau"]
    assert R.metric_increment(spec, sources, None).count() == 0
    assert R.metric_increment(spec, sources, None, bootstrap=True).count() > 0


def test_late_rows_are_not_appended(warehouses):
    spark, raw_t, full, _ = warehouses
    target = R.warehouse_sources(spark, full)("session_start")
    inc = R.flat_increment(raw_t, "session_start", target)
    assert inc.count() == 0            # every day is already at or below the mark


def test_tables_are_date_partitioned_in_declared_order(warehouses):
    spark, _, full, _ = warehouses
    from ludolake.operators.flatten import FLAT_SPECS
    from ludolake.plans.refresh import warehouse_sources
    df = warehouse_sources(spark, full)("session_start")
    assert df.columns == FLAT_SPECS["session_start"].column_names()
    assert dict(df.dtypes)["event_date"] == "date"
    import os
    parts = os.listdir(table_path(full, "dau"))
    assert any(p.startswith("event_date=2024-01-") for p in parts)


def test_dashboard_slice_reads_the_metric_table(warehouses):
    spark, _, full, _ = warehouses
    s = R.dashboard_slice(spark, full, "dau", "2024-01-05", "2024-01-25", version="1.1")
    full_dau = read_table(spark, table_path(full, "dau"))
    want = full_dau.filter((F.col("event_date").between(dt.date(2024, 1, 5), dt.date(2024, 1, 25)))
                           & (F.col("version") == "1.1"))
    assert rows(s) == rows(want) and s.count() > 0
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "EqualTo(version,1.1)" in plan


def test_raw_table_reads_with_declared_schema(warehouses):
    spark, _, full, _ = warehouses
    from ludolake.schemas import RAW_SCHEMA
    from ludolake.sources.tables import read_raw_table
    df = read_raw_table(spark, table_path(full, R.RAW_TABLE))
    assert df.schema.simpleString() == RAW_SCHEMA.simpleString()


def test_sql_views_over_the_warehouse(warehouses):
    spark, raw_t, full, _ = warehouses
    names = R.register_views(spark, full, raw_t)
    assert {"start_level", "user_data", "dau", "cohort"} <= set(names)
    n = spark.sql("SELECT count(*) FROM dau WHERE version = '1.1'").first()[0]
    assert n == read_table(spark, table_path(full, "dau")).filter("version = '1.1'").count() > 0
    lvl = spark.sql("SELECT level FROM booster_used LIMIT 1").schema["level"].dataType.simpleString()
    assert lvl == "bigint"


def test_command_line_build_then_append(spark, tmp_path):
    from ludolake.__main__ import main
    from ludolake.sources.tables import write_table
    raw = read_raw(spark, SF_SMALL)
    export, root = str(tmp_path / "export"), str(tmp_path / "wh")
    write_table(raw.filter(F.col("date_par") <= F.lit(CUTOFF)), export, partition="date_par",
                files_per_date=0)
    main(["build", "--raw", export, "--root", root, "--metrics", "dau"])
    write_table(raw.filter(F.col("date_par") > F.lit(CUTOFF)), export, partition="date_par",
                mode="append", files_per_date=0)
    main(["append", "--raw", export, "--root", root, "--metrics", "dau"])
    from ludolake.operators import metrics as M
    want = M.dau(R._flat_df(raw, "session_start", True))
    got = read_table(spark, table_path(root, "dau"), want.columns)
    assert rows(got) == rows(want)
