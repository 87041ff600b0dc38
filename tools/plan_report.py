"""Summarise the physical plan of every registered query on the driver's tables
(the training-data operators run many jobs each and are not in it).

    python tools/plan_report.py [sf_dir] > PLANS.md

For each query: shuffles (Exchange nodes by kind), join strategies,
aggregation operators, Python evaluation nodes, and every Parquet scan's
pushed filters and read schema. Plans are the initial adaptive plans (AQE may
still turn a shuffle join into a broadcast at run time). Queries that train
models are skipped (their plans are MLlib's).
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ember.plans import QUERIES  # noqa: E402
from ember.session import build_session  # noqa: E402

SKIP = {"colour_classifier_scores", "price_regressor_scores", "price_prediction_histogram", "station_temperature_scores"}


def summarise(plan: str) -> list[str]:
    out = []
    kinds = {}
    for line in plan.splitlines():
        m = re.search(r"(BroadcastExchange|ReusedExchange|Exchange (\w+))", line)
        if m:
            k = "broadcast" if m.group(1) == "BroadcastExchange" else \
                "reused" if m.group(1) == "ReusedExchange" else m.group(2)
            kinds[k] = kinds.get(k, 0) + 1
    out.append("exchanges: " + (", ".join(f"{k} x{v}" for k, v in sorted(kinds.items()))
                                or "none"))
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                       r"BroadcastNestedLoopJoin|CartesianProduct)[^\n]*?(Inner|LeftOuter|"
                       r"LeftSemi|LeftAnti|RightOuter|FullOuter)", plan)
    if joins:
        out.append("joins: " + ", ".join(f"{a} {b}" for a, b in joins))
    aggs = sorted(set(re.findall(r"(HashAggregate|ObjectHashAggregate|SortAggregate)", plan)))
    if aggs:
        out.append("aggregates: " + ", ".join(aggs))
    py = sorted(set(re.findall(r"(ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|"
                               r"MapInPandas)", plan)))
    out.append("python: " + (", ".join(py) if py else "none"))
    for line in plan.splitlines():
        if "FileScan" not in line:
            continue
        fmt = re.search(r"FileScan (\w+)", line).group(1)
        loc = re.search(r"Location: \w+\(\d+ paths\)\[([^\],]*)", line)
        where = os.path.basename(loc.group(1).rstrip("/")) if loc else "?"
        where = re.sub(r"-[0-9a-f]{12}$", "", where)
        buckets = re.search(r"SelectedBucketsCount: [^,\n]*", line)
        pushed = re.search(r"PushedFilters: (\[.*?\]), ReadSchema", line)
        schema = re.search(r"ReadSchema: (struct<.*>)", line)
        out.append(f"scan {fmt} {where}: pushed {pushed.group(1) if pushed else '?'} "
                   f"read {schema.group(1) if schema else '?'}" + (f", {buckets.group()}" if buckets else ""))
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(f"local[{os.environ.get('REPORT_CPUS', '8')}]", 16, extra={"spark.driver.memory": "8g"})
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ember-plans-"))
    print(f"# Physical plans ({os.path.basename(sf_dir)})\n")
    print("Generated by `tools/plan_report.py`; initial adaptive plans.\n")
    for name, fn in sorted(QUERIES.items()):
        if name in SKIP:
            continue
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        print(f"## {name}\n")
        for line in summarise(plan):
            print(f"- {line}")
        print()
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
