"""Write PLANS.md: the physical plan shape of every registered query.

For each query: shuffle exchanges, broadcast exchanges and notable
operators of the initial AQE plans, with automatic broadcast switched off
(so dimension joins show the strategy the code asks for, as on a cluster
where the tables are large).  Many queries write tables on the way (daily
loads, staging, buckets, checkpoints): the plan of every such write is
counted, not only that of the last read.

    python scripts/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cumulo.queries import QUERIES  # noqa: E402
from cumulo.plans.inspect import physical_plan, session_conf  # noqa: E402
from cumulo.sources.session import local_session  # noqa: E402

NOTABLE = ["WindowGroupLimit", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
           "HashAggregate", "ObjectHashAggregate", "SortAggregate", "Window", "TakeOrderedAndProject",
           "Expand", "Generate", "MapInArrow", "FlatMapGroupsInArrow", "FlatMapCoGroupsInArrow"]


def recorded(run):
    """The plans of everything ``run()`` writes or checkpoints, and of the
    DataFrame it returns."""
    from pyspark.sql.classic.dataframe import DataFrame
    from pyspark.sql.readwriter import DataFrameWriter

    plans, saved = [], {}

    def keep(cls, name, frame):
        f = saved[cls, name] = getattr(cls, name)

        def call(self, *args, **kwargs):
            plans.append(physical_plan(frame(self)))
            return f(self, *args, **kwargs)
        setattr(cls, name, call)

    for name in ("parquet", "save", "saveAsTable", "insertInto"):
        keep(DataFrameWriter, name, lambda w: w._df)
    keep(DataFrame, "checkpoint", lambda df: df)
    try:
        plans.append(physical_plan(run()))
    finally:
        for (cls, name), f in saved.items():
            setattr(cls, name, f)
    return plans


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    print("# Plan shapes of the registered queries\n")
    print(f"Generated by `scripts/plan_report.py` on `{sf_dir}` with "
          "`spark.sql.autoBroadcastJoinThreshold=-1` (no automatic broadcasts).  "
          "Counts are for the initial adaptive plans of the result and of every "
          "table the query writes or checkpoints on the way (their number is in "
          "the second column; daily loads write one per day).\n")
    print("| query | writes | shuffles | broadcasts | bucketed scans | pushed filters | operators |")
    print("|---|---|---|---|---|---|---|")
    with session_conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        for name, fn in QUERIES.items():
            plans = recorded(lambda: fn(spark, sf_dir))
            plan = "\n".join(plans)
            shuffles = sum(1 for ln in plan.splitlines() if re.search(r"(?<!Reused)\bExchange\b", ln) and "Broadcast" not in ln)
            bcasts = sum(1 for ln in plan.splitlines() if "BroadcastExchange" in ln)
            bucketed = plan.count("Bucketed: true")
            pushed = sum(1 for ln in plan.splitlines() if re.search(r"PushedFilters: \[[^\]]", ln))
            ops = []
            for op in NOTABLE:
                n = len(re.findall(rf"\b{op}\b", plan))
                if op == "Window":
                    n -= len(re.findall(r"\bWindowGroupLimit\b", plan))
                if n:
                    ops.append(f"{op}×{n}" if n > 1 else op)
            if "Partial" in plan and "WindowGroupLimit" in plan:
                ops.append("(partial group limit before shuffle)")
            print(f"| `{name}` | {len(plans) - 1} | {shuffles} | {bcasts} | {bucketed} | {pushed} | {', '.join(ops)} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
