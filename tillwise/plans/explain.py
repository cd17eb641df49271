"""Plan review for registered queries.

    python -m tillwise.plans.explain rfm_segments [sf_dir]      # formatted plan
    python -m tillwise.plans.explain --summary [sf_dir] [names]  # table of counts

Operators that materialise intermediate results (range sorts, lineage cuts)
run those jobs while the plan is built; the plan shown is the final query
over their outputs (earlier materialisations appear as parquet scans).
"""

from __future__ import annotations

import re
import sys

COUNTED = ["Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
           "BroadcastNestedLoopJoin", "HashAggregate", "SortAggregate", "ObjectHashAggregate",
           "Window", "Expand", "Sort", "Scan parquet"]


def plan_text(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def summarize(text: str) -> dict:
    tree = text.split("\n\n")[0]
    out = {}
    for op in COUNTED:
        out[op] = len(re.findall(r"[+:\-\s*]" + re.escape(op) + r"(?:\s|\()", tree))
    out["PushedFilters"] = sum(1 for line in text.splitlines()
                               if line.startswith("PushedFilters") and line.strip() != "PushedFilters: []")
    return out


def main(argv: list[str]) -> None:
    from ..session import build_session
    from .registry import headline, queries

    spark = build_session("local[*]", app="tillwise-explain")
    spark.sparkContext.setLogLevel("ERROR")
    q = queries()
    if argv and argv[0] == "--summary":
        sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
        names = argv[2:] or headline()
        print("| query | " + " | ".join(COUNTED + ["PushedFilters"]) + " |")
        print("|---" * (len(COUNTED) + 2) + "|")
        for name in names:
            s = summarize(plan_text(q[name](spark, sf_dir)))
            print(f"| {name} | " + " | ".join(str(s[k]) for k in COUNTED + ["PushedFilters"]) + " |")
    else:
        sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
        q[argv[0]](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
