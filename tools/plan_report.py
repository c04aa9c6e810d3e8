"""Summarize the physical plans of every Spark job each registered query runs.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

Runs each query (writes inside ingests included) with Spark's event log in a
fresh scratch folder, attributes every SQL execution to the query that was
running, and lists per query: SQL executions, shuffle exchanges (by kind),
broadcasts, scans with their read schema / pushed and partition filters,
and whether the plan is whole-stage code generated.
"""

from __future__ import annotations

import glob
import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _events(log_dir):
    for path in sorted(glob.glob(f"{log_dir}/**/*", recursive=True)):
        if not os.path.isfile(path):
            continue
        opener = open
        if path.endswith(".zstd") or path.endswith(".zst"):
            import io
            import zstandard
            opener = lambda p: io.TextIOWrapper(
                zstandard.ZstdDecompressor().stream_reader(open(p, "rb")))
        with opener(path) as f:
            for line in f:
                try:
                    yield json.loads(line)
                except json.JSONDecodeError:
                    continue


def _final(plan: str) -> str:
    """Only the nodes of the plan that ran: with AQE the text also holds the
    initial plan's tree, whose nodes are listed in the same detail section."""
    tree, _, details = plan.partition("\n\n")
    if "== Initial Plan ==" in tree:
        tree = tree.split("== Initial Plan ==", 1)[0]
    ids = set(re.findall(r"\((\d+)\)", tree))
    keep = [b for b in details.split("\n\n")
            if (m := re.match(r"^\((\d+)\) ", b.strip())) and m.group(1) in ids]
    return tree + "\n\n" + "\n\n".join(b.strip() for b in keep)


def _scan_lines(plan: str):
    out = []
    for block in plan.split("\n\n"):
        head = block.strip().split("\n", 1)[0]
        if re.match(r"^\(\d+\) Scan ", head):
            fmt = head.split("Scan", 1)[1].strip()
            info = {"format": fmt}
            loc = re.search(r"^Location: \w+ \[(.*)\]$", block, re.M)
            if loc:
                # scratch prefixes shortened; keeps which folders were listed
                text = re.sub(r"file:/\S*?/chronoroll/([\w-]+?)-[0-9a-f]{12}", r"<\1>", loc.group(1))
                info["Location"] = re.sub(r"file:/root/testdata/sf[0-9.]+/", "", text)[:200]
            for key in ("ReadSchema", "PushedFilters", "PartitionFilters"):
                m = re.search(rf"^{key}: (.*)$", block, re.M)
                if m and m.group(1) not in ("[]",):
                    info[key] = m.group(1)[:160]
            out.append(info)
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    log_dir = tempfile.mkdtemp(prefix="chronoroll-eventlog-")
    from chronoroll.session import build_session
    from chronoroll.plans.suite import QUERIES
    spark = build_session("plan-report", master=os.environ.get("PLAN_MASTER", "local[8]"), shuffle_partitions=8,
                          extra={"spark.eventLog.enabled": "true",
                                 "spark.eventLog.dir": f"file://{log_dir}"})
    windows = []
    for name, fn in QUERIES.items():
        t0 = time.time() * 1000
        fn(spark, sf).write.format("noop").mode("overwrite").save()
        windows.append((name, t0, time.time() * 1000))
    spark.stop()

    # the plan of each SQL execution: AQE's last (final) plan when there is one
    start_time, plan_of = {}, {}
    for ev in _events(log_dir):
        kind = ev.get("Event", "")
        if kind.endswith("SQLExecutionStart"):
            start_time[ev["executionId"]] = ev.get("time", 0)
            plan_of.setdefault(ev["executionId"], ev.get("physicalPlanDescription", ""))
        elif kind.endswith("SQLAdaptiveExecutionUpdate"):
            plan_of[ev["executionId"]] = ev.get("physicalPlanDescription", "")
    per_query = {n: [] for n, _, _ in windows}
    for eid, t in sorted(start_time.items()):
        for name, a, b in windows:
            if a <= t <= b:
                per_query[name].append(_final(plan_of[eid]))
                break

    print("# Physical plans of the time-series queries\n")
    print(f"Generated by `tools/plan_report.py {sf}`: every SQL execution a query")
    print("runs (its writes included), read from Spark's event log.\n")
    print("| query | SQL runs | shuffles (hash / rebalance / range / round-robin) | broadcasts | sort-merge joins | codegen |")
    print("|---|---|---|---|---|---|")
    details = []
    for name, plans in per_query.items():
        text = "\n".join(plans)
        args = re.findall(r"^\(\d+\) Exchange\nInput.*?\nArguments: (.*)$", text, re.M)
        hp = sum(1 for a in args if a.startswith("hashpartitioning") and "REBALANCE" not in a)
        rb = sum(1 for a in args if "REBALANCE" in a)
        rg = sum(1 for a in args if a.startswith("rangepartitioning"))
        rr = sum(1 for a in args if a.startswith("RoundRobin") or a.startswith("roundrobin"))
        single = sum(1 for a in args if a.startswith("SinglePartition"))
        bc = len(re.findall(r"^\(\d+\) BroadcastExchange", text, re.M))
        smj = len(re.findall(r"^\(\d+\) SortMergeJoin", text, re.M))
        cg = "yes" if "[codegen id" in text else "no"
        shuffles = f"{hp} / {rb} / {rg} / {rr}" + (f" (+{single} single)" if single else "")
        print(f"| `{name}` | {len(plans)} | {shuffles} | {bc} | {smj} | {cg} |")
        scans = [s for p in plans for s in _scan_lines(p)]
        if scans:
            details.append((name, scans))

    print("\n## Scans\n")
    print("Read schema, pushed filters and partition filters of each scan")
    print("(edge files a query writes and reads back are scans too).\n")
    for name, scans in details:
        print(f"### `{name}`\n")
        seen = set()
        for s in scans:
            key = json.dumps(s, sort_keys=True)
            if key in seen:
                continue
            seen.add(key)
            parts = [f"**{s['format']}**"] + [f"{k}: `{v}`" for k, v in s.items() if k != "format"]
            print("- " + "; ".join(parts))
        print()


if __name__ == "__main__":
    main()
