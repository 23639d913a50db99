"""Physical shape of every registered query (final adaptive plan after running at sf0.01).

``python tests/plan_report.py [sf_dir] > PLANS.md``; with keys after the folder, only their lines
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PATTERNS = {
    "shuffles": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobinPartitioning|Exchange SinglePartition|Exchange rebalance",
    "broadcasts": r"BroadcastExchange",
    "bhj": r"BroadcastHashJoin",
    "bnlj": r"BroadcastNestedLoopJoin",
    "smj": r"SortMergeJoin",
    "aggregates": r"HashAggregate|ObjectHashAggregate|SortAggregate",
    "windows": r"\bWindow\b",
    "top_k": r"TakeOrderedAndProject",
    "sorts": r"\bSort \[",
    "scans": r"FileScan|Scan parquet|BatchScan",
}


def shape(plan: str) -> dict:
    # count each operator once per plan node line; reused exchanges/subqueries are counted once
    lines = [ln for ln in plan.splitlines() if "ReusedExchange" not in ln]
    text = "\n".join(lines)
    return {k: len(re.findall(p, text)) for k, p in PATTERNS.items()}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as E
    from dockcast.session import build_session
    spark = build_session()
    qs, sqls = E.queries(), E.oracle_sql()
    only = argv[2:]
    if not only:
        _head(sf_dir)
    for k in only or qs:
        _line(spark, sf_dir, k, qs[k], k in sqls)
    spark.stop()


def _head(sf_dir):
    print(f"# Physical plans of the registered queries\n\nFinal adaptive plans after running each key on `{sf_dir}` "
          "(local[8], AQE on). Counts are plan nodes of the whole query, subqueries included; "
          "`shuffles` counts exchanges (the stored tables' own "
          "one-time writes are not part of a downstream query's plan). Generated by `tests/plan_report.py`.\n")
    cols = list(PATTERNS)
    print("| key | check | " + " | ".join(cols) + " |")
    print("|---|---|" + "---|" * len(cols))


def _line(spark, sf_dir, k, fn, has_sql):
    df = fn(spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    found = shape(df._jdf.queryExecution().executedPlan().toString())
    print(f"| {k} | {'O' if has_sql else 'R'} | " + " | ".join(str(found[c]) for c in PATTERNS) + " |", flush=True)


if __name__ == "__main__":
    main(sys.argv)
