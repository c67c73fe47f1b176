"""The training-data queries that have SQL, against their DuckDB oracle."""

import pytest

import __spark_entry__ as entry
from ludolake.llm.queries import all_oracle_sql, all_queries
from tests.conftest import SF_SMALL
from tests.parity import compare


def test_keys_are_registered():
    assert set(all_oracle_sql()) <= set(all_queries()) <= set(entry.queries())


@pytest.mark.parametrize("key", list(all_oracle_sql()))
def test_parity_small(spark, con_small, key):
    r = compare(spark, SF_SMALL, key, all_queries()[key], all_oracle_sql()[key], con_small)
    assert r["ok"], r
