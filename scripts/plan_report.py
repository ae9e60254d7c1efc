"""Operator counts of a whole customer feature run: the tables that it writes
on its way, one by one, and the final plan (what ``explain`` shows of each).

usage: python scripts/plan_report.py [sf_dir]
"""

from __future__ import annotations

import collections
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from carelens.config import FeatureConfig
    from carelens.plans import features as FT
    from carelens.session import get_session
    from carelens.sources.fixtures import fixture_sources

    spark = get_session("local[8]", shuffle_partitions=8)
    plan = FT._Plan(fixture_sources(spark, sf_dir), FeatureConfig(), FT.FEATURE_NAMES)
    final = FT._table(plan, FT.FEATURE_NAMES)
    final.write.format("noop").mode("overwrite").save()
    keep = ["FileScan", "Exchange", "BroadcastExchange",
            "HashAggregate", "ObjectHashAggregate", "SortAggregate", "Window", "SortMergeJoin",
            "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
            "Expand", "BatchEvalPython", "ArrowEvalPython"]
    total: collections.Counter[str] = collections.Counter()
    print(f"sf_dir={sf_dir}")
    for part, df in {**plan.staged, "result": final}.items():
        text = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        counts = collections.Counter(re.findall(r"^[\s:+\-|]*(?:\*\(\d+\) )?(\w+)", text, flags=re.M))
        total += counts
        scans = re.findall(r"FileScan parquet \S*\[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", text)
        print(f"  {part}: {counts['Exchange']} Exchange, {len(scans)} scans of {sum(len(c.split(',')) for c, _ in scans)} columns, "
              f"{sum(1 for _, f in scans if f)} with pushed filters")
    for k in keep:
        print(f"  {k:24s} {total[k]}")


if __name__ == "__main__":
    main()
