"""The derivation of raw and the day manifest: compiled steps, the same rows."""

import datetime as dt

from pyspark.sql import functions as F

from ludolake.plans import versions
from ludolake.sources.fixture import ALL_EVENTS, raw_events

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def some_events(spark):
    day = dt.datetime(2024, 1, 3, 10, 30)
    rows = [(1, day, 7, "purchase", 2.5, '{"k": 4}'), (2, day, 7, "purchase", None, '{"k": 9}'),
            (3, day, None, "error", 1.0, '{"k": 7}'), (4, None, 8, "view", 1.25, '{"k": 20}'),
            (5, day, 12, "click", 3.0, None), (6, day, 5, None, None, '{"k": 99}'), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_parameters_without_a_value_are_left_out(spark):
    found = {}
    for r in raw_events(some_events(spark)).collect():
        assert None not in r["event_params"]
        found.setdefault((r["user_pseudo_id"], r["event_name"]), []).append([p["key"] for p in r["event_params"]])
    assert sorted(found["u7", "in_app_purchase"]) == [["product_id", "currency", "quantity"],
                                                      ["product_id", "price", "currency", "quantity", "value"]]
    assert sorted(found["u7", "user_engagement"]) == [["ga_session_id"], ["ga_session_id", "engagement_time_msec"]]
    assert found["u8", "session_start"] == [[]]            # no time, no session
    assert found["u12", "start_level"] == [[]]             # no k, no level
    assert {n for _, n in found} <= set(ALL_EVENTS)


def test_rows_are_derived_by_compiled_code(spark):
    """What the events of a row share is made once, before they part, and no
    array is filtered to find their names."""
    plan = raw_events(some_events(spark))._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate explode", 1)
    assert "NATION_" in below and "NATION_" not in above
    assert "lambdafunction" not in below


def test_manifest_sums_are_exact(spark):
    raw = raw_events(some_events(spark))
    hashes = {}
    for r in raw.select("date_par", F.xxhash64(*[c for c in raw.columns if c != "date_par"]).alias("h")).collect():
        hashes.setdefault(versions._name(r["date_par"]), []).append(r["h"])
    assert any(h < 0 for x in hashes.values() for h in x)
    assert versions.day_manifest(raw) == {d: [len(x), str(sum(x))] for d, x in hashes.items()}


def test_manifest_adds_no_decimals(spark, monkeypatch):
    plans = []
    collect = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda df: plans.append(
        df._jdf.queryExecution().optimizedPlan().toString()) or collect(df))
    versions.day_manifest(raw_events(some_events(spark)))
    assert len(plans) == 1 and "decimal" not in plans[0]
