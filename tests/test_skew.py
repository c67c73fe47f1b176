"""A hot user: one user id holds a third of all events (the sf0.001 events
with every third row re-assigned). Every metric still matches its oracle;
the plan test covers that such a user never ships raw rows to one task."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.parity import compare

HOT_USER = 7
KEYS = ["user_data", "new_user", "dau", "playtime", "cohort", "rev_iap_ads3",
        "rev_iap_ads3_corrected", "winrate2", "level_booster2", "booster_type",
        "ads_inter_rw_cnt", "drop_final", "drop_rate3", "cohort_incremental"]


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("skew")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(HOT_USER))
                        .otherwise(F.col("user_id")))
    hot.coalesce(1).write.parquet(str(d / "events.parquet"))
    return str(d)


@pytest.fixture(scope="module")
def con_skew(skewed_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{skewed_dir}/events.parquet/*.parquet')")
    return con


def test_hot_user_holds_a_third(con_skew):
    n, hot = con_skew.sql(f"SELECT count(*), count(*) FILTER (WHERE user_id = {HOT_USER}) "
                          "FROM events").fetchall()[0]
    assert hot * 3 >= n


@pytest.mark.parametrize("key", KEYS)
def test_parity_with_a_hot_user(spark, skewed_dir, con_skew, key):
    r = compare(spark, skewed_dir, key, entry.queries()[key], entry.oracle_sql()[key], con_skew)
    assert r["ok"], r
