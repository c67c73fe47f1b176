"""Shuffle stages per metric in the final AQE plans, broadcast disabled (as
when every side is large). Produces the table in README "Shuffles per metric".

    python -m tests.plan_report [sf_dir]
"""

from __future__ import annotations

import os
import sys
import tempfile


def main(argv: list[str]) -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from ludolake.plans import refresh as R
    from ludolake.plans.pipeline import METRICS
    from ludolake.session import local_session
    from ludolake.sources.fixture import read_raw
    from ludolake.sources.tables import read_raw_table

    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    spark = local_session(8)
    root = tempfile.mkdtemp(prefix="ludolake-plans-")
    R.write_raw(read_raw(spark, sf_dir), root)          # raw as a table, as in production
    raw = read_raw_table(spark, f"{root}/{R.RAW_TABLE}")
    R.build_flat(spark, raw, root)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    sources = R.warehouse_sources(spark, root, raw)
    print("| Metric | Shuffle stages | Reused | Expand | Window |")
    print("| --- | --- | --- | --- | --- |")
    for name, spec in METRICS.items():
        df = spec.build(sources)
        df.collect()          # runs this DataFrame's own (adaptive) plan; results are small
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        print(f"| {name} | {plan.count('ShuffleQueryStage')} | {plan.count('ReusedExchange')} "
              f"| {plan.count('Expand')} | {plan.count('Window [')} |")


if __name__ == "__main__":
    main(sys.argv[1:])
