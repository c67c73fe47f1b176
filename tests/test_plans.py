"""Plan invariants for large inputs (broadcast off, as when every side is
big): no operator shuffles raw rows on a key that contains the user id.
Every such exchange must sit on a (partial) aggregation, so a user holding a
third of all rows sends a few pre-aggregated rows, not its raw rows."""

import pytest

from ludolake.plans import refresh as R
from ludolake.plans.pipeline import METRICS
from ludolake.sources.fixture import read_raw
from tests.conftest import SF_SMALL

AGG = ("HashAggregate", "ObjectHashAggregate", "SortAggregate")


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    raw = read_raw(spark, SF_SMALL)
    R.build_flat(spark, raw, root)
    return R.warehouse_sources(spark, root, raw)


def _depth(line: str) -> int:
    return len(line) - len(line.lstrip(" :+-"))


def _op(line: str) -> str:
    return line.strip().lstrip(":+- ").strip()


def _raw_paths(plan: str):
    """For each user-keyed Exchange, yield the scans it can reach without an
    aggregation in between (the raw rows it would shuffle)."""
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(" not in line:
            continue
        if "user_pseudo_id" not in line.split("hashpartitioning(")[1].split(")")[0]:
            continue
        stack: list[tuple[int, str]] = []        # ancestors inside the subtree
        for nxt in lines[i + 1:]:
            d = _depth(nxt)
            if d <= _depth(line):
                break
            while stack and stack[-1][0] >= d:
                stack.pop()
            op = _op(nxt)
            if op.startswith(("FileScan", "Scan ")):
                if not any(a.startswith(AGG) for _, a in stack):
                    yield line.strip(), op
            stack.append((d, op))


@pytest.mark.parametrize("name", list(METRICS))
def test_user_keyed_shuffles_are_pre_aggregated(spark, warehouse, name):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = METRICS[name].build(warehouse)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    for exchange, scan in _raw_paths(plan):
        # user_data is distinct by construction: a few rows per user and day.
        if "/user_data]" in scan.split("PartitionFilters")[0]:
            continue
        raise AssertionError(f"{name}: {exchange} shuffles raw rows of {scan[:160]}")


@pytest.mark.parametrize("name", ["new_user", "cohort", "rev_iap_ads3", "winrate2"])
def test_no_broadcast_hints_and_no_cartesian(spark, warehouse, name):
    plan = METRICS[name].build(warehouse)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
