"""Every registered query against its DuckDB oracle (the driver's check).

All keys of the analytics layers run at sf0.001; the metrics also at sf0.01,
where the fixture reaches more cases (multi-version days, clamps, NULL levels).
"""

import pytest

import __spark_entry__ as entry
from ludolake.queries import all_oracle_sql, all_queries
from tests.conftest import SF_MID, SF_SMALL
from tests.parity import compare

QUERIES = all_queries()
ORACLE = all_oracle_sql()
MID_KEYS = ["playtime", "cohort", "rev_iap_ads3", "rev_iap_ads3_corrected", "winrate2",
            "level_booster2", "ads_inter_rw_cnt", "drop_final", "drop_rate3",
            "cohort_incremental", "winrate2_incremental", "playtime_extra", "append_changed_days",
            "winrate2_refresh", "flatten_rejects"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", list(QUERIES))
def test_parity_small(spark, con_small, key):
    r = compare(spark, SF_SMALL, key, QUERIES[key], ORACLE[key], con_small)
    assert r["ok"], r


@pytest.mark.parametrize("key", MID_KEYS)
def test_parity_mid(spark, con_mid, key):
    r = compare(spark, SF_MID, key, QUERIES[key], ORACLE[key], con_mid)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_date", "days_since_first_open", "version", "country",
                          "total_users", "retained_user", "retention_rate"]
    assert df.count() > 0
