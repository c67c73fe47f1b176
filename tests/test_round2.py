"""Cases that used to lose data or digits."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from ludolake.functions.exact import ratio2
from ludolake.operators import metrics as M
from ludolake.plans import refresh as R
from ludolake.plans.pipeline import USER_DATA
from ludolake.sources.fixture import read_raw
from ludolake.sources.tables import read_table, table_high_water_mark, table_path, write_table

from tests.conftest import SF_SMALL

DAY = dt.date(2024, 1, 1)


def test_revenue_keeps_small_amounts(spark):
    keys = "user_pseudo_id string, event_date date, version string, country string"
    who = ("u", DAY, "1", "X")
    engaged = spark.createDataFrame([who], keys)
    ads = spark.createDataFrame([(*who, "INTER", 1.23e-7)], keys + ", ad_format string, value double")
    bought = spark.createDataFrame([(*who, 1.234567891)], keys + ", event_value_in_usd double")
    for corrected in (False, True):
        row = M.rev_iap_ads3(engaged, ads, bought, corrected=corrected).first()
        assert (row["iap_rev"], row["ads_rev"]) == (1.234567891, 1.23e-7)
        assert row["total_revenue"] == 1.234568014


@pytest.mark.parametrize("n, d, want", [(-1006, 1000, -1.01), (-5, 1000, -0.01), (-4, 1000, 0.0), (1005, 1000, 1.01)])
def test_ratio_of_a_negative(spark, n, d, want):
    assert spark.range(1).select(ratio2(F.lit(n), F.lit(d)).alias("r")).first()["r"] == want


def test_mark_ignores_the_null_day(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, DAY), (2, None)], "x int, event_date date")
    write_table(rows, path)
    assert table_high_water_mark(spark, path) == DAY


def test_new_event_kind_and_emptied_partition(spark, tmp_path):
    root = str(tmp_path)
    raw = read_raw(spark, SF_SMALL).filter(F.col("date_par") <= F.lit(dt.date(2024, 1, 3))).cache()
    early = raw.filter((F.col("event_name") != "app_remove") & (F.col("date_par") < F.lit(dt.date(2024, 1, 2))))
    R.build_flat(spark, early, root)
    assert "app_remove" in R.append_flat(spark, raw, root)
    late = raw.filter(F.col("event_name") == "win_level")
    sources = R.warehouse_sources(spark, root)
    assert sources("app_remove").count() == 0
    R.build_flat(spark, early, root)
    assert R.append_flat(spark, raw, root, bootstrap=True) == []
    assert (R.warehouse_sources(spark, root)("app_remove").count()
            == raw.filter("event_name = 'app_remove'").count())
    # A corrected day without its other events: their partitions go.
    day = dt.date(2024, 1, 2)
    R.refresh_days(spark, late, root, [day], metrics=["level_booster2"])
    left = R.warehouse_sources(spark, root)("session_start").filter(F.col("event_date") == F.lit(day))
    assert left.count() == 0


def test_lookback_keeps_the_last_offset(spark, tmp_path):
    """Days appended one by one, each followed by a refresh, equal one build."""
    root = str(tmp_path)
    keys = "user_pseudo_id string, event_date date, version string, country string"
    days = [DAY + dt.timedelta(days=i) for i in range(33)]
    frames = {
        "first_open": spark.createDataFrame([("u", DAY, "1", "X")], keys),
        "session_start": spark.createDataFrame([("u", d, "1", "X") for d in days], keys),
        USER_DATA: spark.createDataFrame([("u", d, "1", "X") for d in days], keys)}
    full = {tuple(r) for r in M.cohort(frames["first_open"], frames["session_start"], frames[USER_DATA]).collect()}
    first_written = days[29]
    after = R.lookback_start(days[30], 30)
    assert after < DAY <= days[30] - dt.timedelta(days=30)
    assert len(full) == 31 and first_written > after


def test_refresh_of_a_missing_target_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        R.refresh_metrics(spark, str(tmp_path), 30, ["cohort"], raw=read_raw(spark, SF_SMALL))


def test_parameter_lookup_prunes_the_other_slots(spark, tmp_path):
    raw = read_raw(spark, SF_SMALL)
    path = table_path(str(tmp_path), "raw")
    raw.filter(F.col("event_name") == "win_level").limit(20).write.parquet(path)
    from ludolake.operators.flatten import flatten
    spark.conf.set("spark.sql.maxMetadataStringLength", 10000)
    try:
        plan = flatten(spark.read.parquet(path), "win_level")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    schema = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "string_value" in schema and "double_value" not in schema
