"""Summarise the physical plan of every registered batch query.

Usage: python scripts/plan_report.py [sf_dir] > PLANS.md

Plans are taken with estimate-based broadcasts off and AQE off, i.e. the
shape the query has when every table is large (as on a 100 TB cluster):
no table is small enough to broadcast, and no runtime re-planning is shown.
For each query: exchanges (shuffles) with their partitioning, join
strategies, aggregate stages, per-group limits, and what reaches each scan
(read schema, pushed filters).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.plans.catalog import QUERIES  # noqa: E402
from quarry.session import build_session  # noqa: E402


def summarize(plan: str) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {"exchanges": [], "joins": [], "aggs": [], "scans": [], "other": []}
    for raw in plan.splitlines():
        line = raw.strip().lstrip("+-:* ").strip()
        line = re.sub(r"^\(\d+\)\s*", "", line)  # whole-stage codegen id
        line = re.sub(r"#\d+L?", "", line)
        if line.startswith("Exchange"):
            m = re.match(r"Exchange (\w+\([^)]*\)|SinglePartition|RoundRobinPartitioning\(\d+\))", line)
            out["exchanges"].append(m.group(1) if m else line[:80])
        elif "Join" in line.split(" ")[0]:
            out["joins"].append(" ".join(line.split(" ")[:3]))
        elif line.startswith("HashAggregate") or line.startswith("ObjectHashAggregate"):
            fn = re.search(r"functions=\[([^\]]*)\]", line)
            keys = re.search(r"keys=\[([^\]]*)\]", line)
            out["aggs"].append(f"keys=[{keys.group(1) if keys else ''}] {fn.group(1)[:60] if fn else ''}")
        elif line.startswith("FileScan") or line.startswith("Scan "):
            schema = re.search(r"ReadSchema: (struct<[^>]*>)", line)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", line)
            fmt = re.search(r"FileScan (\w+)", line)
            out["scans"].append(
                f"{fmt.group(1) if fmt else 'scan'} {schema.group(1) if schema else ''} "
                f"pushed={pushed.group(1) if pushed else '[]'}"
            )
        elif line.startswith(("WindowGroupLimit", "TakeOrderedAndProject", "Generate", "Window ")):
            out["other"].append(line.split("[")[0].strip() + (" Partial" if "Partial" in line else ""))
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "local[8]",
        "plans",
        {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": "32",
        },
    )
    print("# Physical plans at scale\n")
    print("Generated by `scripts/plan_report.py`: no broadcasts (every table large), AQE off, so this")
    print("is the plan a 100 TB run starts from; at run time AQE may still coalesce partitions,")
    print("split skewed ones and turn a join whose measured side is small into a broadcast join.\n")
    for name, fn in QUERIES.items():
        if name.startswith("stream_"):
            continue
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        print(f"## {name}\n")
        print(f"- shuffles: {len(s['exchanges'])} — " + ("; ".join(s["exchanges"]) or "none"))
        if s["joins"]:
            print("- joins: " + "; ".join(s["joins"]))
        if s["aggs"]:
            print("- aggregates: " + "; ".join(s["aggs"]))
        if s["other"]:
            print("- other: " + "; ".join(s["other"]))
        for sc in s["scans"]:
            print(f"- scan: {sc}")
        print()
    stream_plans(spark, sf_dir)
    spark.stop()


def stream_plans(spark, sf_dir: str) -> None:
    """Plans of the stateful stream jobs, taken from a started query."""
    from quarry.session import scratch_path
    from quarry.sources.tables import event_log_lines, table
    from quarry.streaming import jobs as J
    from quarry.streaming import logs as SL
    from quarry.streaming.runner import start_to_table

    print("# Stream jobs (stateful part)\n")
    print("From the first micro-batch of each query: the operators before and after the")
    print("state store, and the watermark.\n")
    stream = J.feed_stream(event_log_lines(table(spark, sf_dir, "events")), "plan-feed")
    logs = SL.timed_logs(stream, watermark=J.REPORT_WATERMARK)
    reports = {
        "stream_log_windows": SL.window_stats(logs, J.REPORT_WINDOW, J.REPORT_SLIDE),
        "stream_window_heavy_hitters": SL.window_heavy_hitters(logs, 10, J.REPORT_WINDOW, J.REPORT_SLIDE),
        "stream_window_top_endpoints": SL.window_endpoint_counts(logs, J.REPORT_WINDOW, J.REPORT_SLIDE),
        "stream_closed_top_endpoints": SL.window_top_endpoints(
            logs, 10, J.REPORT_WINDOW, J.REPORT_SLIDE),
        "stream_running_stats": SL.running_stats(SL.timed_logs(stream)),
    }
    for name, df in reports.items():
        mode = "update" if name == "stream_running_stats" else "append"
        q = start_to_table(df, scratch_path(spark, "plan-out"), scratch_path(spark, "plan-ck"), mode)
        q.awaitTermination(300)
        text = q._jsq.explainInternal(False)
        ops = []
        for raw in text.splitlines():
            line = re.sub(r"^[\s+\-:*|]*(\(\d+\)\s*)?", "", raw)
            line = re.sub(r"#\d+L?", "", line)
            for op in ("StateStoreSave", "StateStoreRestore", "Exchange", "HashAggregate",
                       "Expand", "EventTimeWatermark", "Generate"):
                if line.startswith(op):
                    detail = ""
                    if op == "HashAggregate":
                        fn = re.search(r"functions=\[([^\]]*)\]", line)
                        detail = f" [{fn.group(1)[:50]}]" if fn else ""
                    elif op == "Exchange":
                        detail = " " + line.split(",")[0].split(" ", 1)[1][:60]
                    elif op == "EventTimeWatermark":
                        detail = " " + line.split(",")[-1].strip()
                    ops.append(op + detail)
        print(f"## {name}\n")
        print("- operators, top to bottom: " + " <- ".join(ops))
        print()


if __name__ == "__main__":
    main()
