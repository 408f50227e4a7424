"""Write PLANS.md: the executed physical-plan shape of every headline query.

Usage: python tools/plan_report.py [sf_dir]   (runs each query once; AQE final plans)
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shape(plan: str) -> dict:
    final = plan.split("+- == Initial Plan ==")[0]
    scans = re.findall(r"FileScan (\w+) \[[^\]]*\].*?PushedFilters: (\[[^\]]*\]).*?ReadSchema: (struct<[^>]*>)",
                       final)
    return {
        "shuffles": final.count("Exchange hashpartitioning") + final.count("Exchange rangepartitioning")
        + final.count("Exchange SinglePartition") + final.count("Exchange RoundRobinPartitioning"),
        "single_partition": final.count("Exchange SinglePartition"),
        "broadcast_joins": final.count("BroadcastHashJoin"),
        "sort_merge_joins": final.count("SortMergeJoin"),
        "windows": len(re.findall(r"\bWindow\b", final)),
        "python": final.count("MapInPandas") + final.count("ArrowEvalPython") + final.count("BatchEvalPython"),
        "scans": [(fmt, pushed, schema) for fmt, pushed, schema in scans],
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from bench import HEADLINE
    from screenlake.plans.catalog import QUERIES
    from screenlake.session import get_spark
    spark = get_spark("local[4]", 8)
    out = ["# PLANS", "",
           f"Executed (AQE final) physical plans of the headline queries on `{sf_dir}`, "
           "written by `tools/plan_report.py`. Materialised stage boundaries appear as separate "
           "jobs and are not counted here. `single_partition` counts exchanges into one task: they "
           "only ever carry small tables (bucket offsets, per-window / per-chunk counts, a top-k).",
           "", "| query | shuffles | single-partition | BHJ | SMJ | windows | python | scans: ReadSchema (PushedFilters) |",
           "|---|---|---|---|---|---|---|---|"]
    for n in HEADLINE:
        df = QUERIES[n](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        s = shape(df._jdf.queryExecution().executedPlan().toString())
        scans = "; ".join(f"`{schema}` ({pushed})" for _, pushed, schema in s["scans"][:3])
        out.append(f"| {n} | {s['shuffles']} | {s['single_partition']} | {s['broadcast_joins']} | "
                   f"{s['sort_merge_joins']} | {s['windows']} | {s['python']} | {scans} |")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    open(path, "w").write("\n".join(out) + "\n")
    print(path)


if __name__ == "__main__":
    main()
