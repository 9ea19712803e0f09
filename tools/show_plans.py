"""Write the executed physical plans of headline queries to PLANS.md.

usage: python tools/show_plans.py [sf_dir] [out]

Each query is run once (noop sink) so the plan shown is AQE's final plan,
followed by a summary: exchanges, join strategies, pushed filters and read
schemas of the scans.
"""
import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feedlens.plans.catalog import registry  # noqa: E402
from feedlens.session import build_session  # noqa: E402

HEADLINE = ["main_metric_report", "full_report", "daily_slices", "feed_traffic",
            "users_feed_only", "welch_ctr", "ab_test_03", "linearized_histogram", "aa_resample",
            "aa_pvalue_histogram", "retention_feed", "retention_feed_incremental", "weekly_audience",
            "weekly_audience_feed", "full_report_store", "users_both_services_state", "realtime_feed"]

OPS = ("Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin",
       "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "Expand",
       "Window", "HashAggregate", "Generate")


def summary(plan: str) -> list[str]:
    counts = Counter()
    for line in plan.splitlines():
        m = re.match(r"^[\s:+\-*|]*\(?\d*\)?\s*([A-Za-z]+)", line.strip())
        if not m:
            continue
        for op in OPS:
            if re.search(rf"\b{op}\b", line) and not line.strip().startswith(("Input", "Output")):
                counts[op] += 1
                break
    out = [f"- {op}: {n}" for op, n in sorted(counts.items())]
    pushed = sorted(set(re.findall(r"(PushedFilters: \[.*?\])(?:, ReadSchema|$)", plan, re.M)))
    schemas = sorted(set(re.findall(r"ReadSchema: \S+", plan)))
    out += [f"- {p}" for p in pushed] + [f"- {s}" for s in schemas]
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(
        os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    spark = build_session("local[8]", 8)
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    reg = registry()
    parts = ["# Executed plans of headline queries", "",
             f"Generated by `tools/show_plans.py` on `{sf_dir}` (local[8], AQE final plans).", ""]
    for name in HEADLINE:
        df = reg[name](spark, sf_dir)
        df.collect()   # executes this Dataset's own plan, so AQE's final plan is shown
        top = df._jdf.queryExecution().executedPlan()
        try:                      # AdaptiveSparkPlanExec: its current (final) plan only
            plan = top.executedPlan().toString()
        except Exception:
            plan = top.toString()
        lines = [ln if len(ln) <= 240 else ln[:240] + " ..." for ln in plan.strip().splitlines()]
        parts += [f"## {name}", "", *summary(plan), "", "```", *lines, "```", ""]
    with open(out, "w") as fh:
        fh.write("\n".join(parts))
    print("wrote", out)


if __name__ == "__main__":
    main()
