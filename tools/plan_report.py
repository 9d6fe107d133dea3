"""Summarise the physical plan of every registered query (PLANS.md).

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


NOTES = """How to read it:

* **hash shuffles** are the joins and groupings the query needs.  Hot keys are handled in the operators
  (partial aggregation, salting), not by avoiding the shuffle.
* **range shuffles** happen when the sorted inputs of exact medians, NTILE and LAG/LEAD are written, before
  the plans below: one for each, whatever the size.  The plans read the sorted rows back.
* **single-partition** exchanges come from two kinds of step only: the final merge of a global aggregate, where
  each map task sends one partial row, and windows over small aggregates (months, years, genre x tier, a
  token vocabulary, one row for each range partition).
* **broadcasts** are one-row aggregates, per-partition offset and boundary tables, `nation`/`region`, and
  hot-key sets bounded by rows/threshold.  AQE may add more at runtime after measuring sizes.
* **group limits** (`WindowGroupLimit`) show the partial top-N before the shuffle in the ranking queries.
* **unpruned scans** counts Parquet scans without a narrowed `ReadSchema`.
"""


def summarise(plan: str) -> dict:
    return {
        "hash shuffles": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range shuffles": len(re.findall(r"Exchange rangepartitioning", plan)),
        "single-partition": len(re.findall(r"Exchange SinglePartition", plan)),
        "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
        "SMJ": len(re.findall(r"SortMergeJoin", plan)),
        "BHJ": len(re.findall(r"BroadcastHashJoin", plan)),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "group limits": len(re.findall(r"WindowGroupLimit", plan)),
        "scans": len(re.findall(r"FileScan parquet", plan)),
        "unpruned scans": sum(1 for line in plan.splitlines()
                              if "FileScan parquet" in line and "ReadSchema" not in line),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from marquee.session import build_session
    from marquee.registry import QUERIES
    spark = build_session()
    cols = None
    rows = []
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        cols = cols or list(s)
        rows.append((name, s))
    print("# Physical plan summary\n")
    print(f"Generated by `tools/plan_report.py` on `{os.path.basename(sf_dir)}` (initial adaptive plans; "
          "layers already written to the checkpoint folder appear as Parquet scans).\n")
    print(NOTES)
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, s in rows:
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
