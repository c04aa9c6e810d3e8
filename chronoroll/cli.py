"""Command line: the reference's scripted steps as Spark jobs.

    spark-submit chronoroll/cli.py snapshot  --raw /data/raw --out /data/ingestion \\
        --latest /data/ingestion/latest --columns "id,at,kind,…" --region-col kind
    spark-submit chronoroll/cli.py ingest    --spec events_detail.json --table /data/tables/events \\
        [--quarantine /data/bad/events] [--base /data/ingestion/latest]
    spark-submit chronoroll/cli.py stream    --spec events_stream.json --out /data/tables/stream \\
        --checkpoint /data/ckpt/stream [--source /data/topic] [--trigger spec|availableNow|once]
    spark-submit chronoroll/cli.py compact   --spec events_stream.json --out /data/tables/stream \\
        --base /data/tables/stream_base [--purge]
    spark-submit chronoroll/cli.py inventory --base /data/raw [--glob "*.csv"]

Every command prints a short summary; ``--report`` writes the full per-region
report. No data set is collected to the driver.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from .functions.values import CSV_WRITER
from .session import build_session


def _load_spec(path: str) -> dict:
    with open(path) as f:
        return json.load(f)


def _report(df, folder: str | None, name: str) -> None:
    """Print how many rows a report has and its first ones; write all of it to ``folder``."""
    print(f"{name}: {df.count()} rows")
    df.show(truncate=False)
    if folder:
        df.write.mode("overwrite").option("header", "true").options(**CSV_WRITER).csv(f"{folder.rstrip('/')}/{name}")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="chronoroll")
    sub = ap.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("snapshot", help="region CSV folders → dated snapshot + latest")
    s.add_argument("--raw", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--latest", required=True)
    s.add_argument("--columns", help="comma-separated header names (read as text)")
    s.add_argument("--region-col", default="region")
    s.add_argument("--format", default="csv")
    s.add_argument("--files-per-region", type=int,
                   help="1 = one file per region (small regions only); default: sized by AQE")

    i = sub.add_parser("ingest", help="run a batch ingestion spec (JSON)")
    i.add_argument("--spec", required=True)
    i.add_argument("--table", required=True)
    i.add_argument("--quarantine")
    i.add_argument("--base", help="override inputSource.baseDir")
    i.add_argument("--region", action="append",
                   help="reload only this region folder (repeatable); others stay as they are")

    st = sub.add_parser("stream", help="run a message-topic spec as a stream")
    st.add_argument("--spec", required=True)
    st.add_argument("--out", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--source", help="folder of JSON-line files instead of the topic")
    st.add_argument("--quarantine")
    st.add_argument("--trigger", default="availableNow")

    c = sub.add_parser("compact", help="fold streaming partials into the base table")
    c.add_argument("--spec", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--base", required=True)
    c.add_argument("--upto", type=int)
    c.add_argument("--purge", action="store_true")

    v = sub.add_parser("inventory", help="files and bytes per region folder")
    v.add_argument("--base", required=True)
    v.add_argument("--glob", default="*.csv")
    v.add_argument("--region-col", default="region")

    for p in (s, i, v):
        p.add_argument("--report", help="folder for the full per-region report (CSV)")
    a = ap.parse_args(argv)
    spark = build_session(f"chronoroll-{a.cmd}")

    if a.cmd == "snapshot":
        from .plans.snapshot import snapshot_regions
        cols = a.columns.split(",") if a.columns else None
        res = snapshot_regions(spark, a.raw, a.out, a.latest, columns=cols,
                               partition_col=a.region_col, fmt=a.format,
                               files_per_region=a.files_per_region)
        print(f"snapshot: {res.dated}  latest: {res.latest}")
        _report(res.counts, a.report, "counts")
        from .plans.audit import compare_inventories
        check = compare_inventories(spark, a.raw, a.latest, a.region_col)
        _report(check, a.report, "check")
        missing = check.filter(F.col("status") == "MISSING_OUTPUT").count()
        if missing:
            print(f"{missing} region(s) have input but no output")
            return 1
    elif a.cmd == "ingest":
        from .plans.spec_job import run_spec
        res = run_spec(spark, _load_spec(a.spec), a.table, quarantine_path=a.quarantine,
                       base_override=a.base, keep_counts=True, regions=a.region)
        print(f"table: {res.table}  partitions: {', '.join(res.partition_cols)}")
        if res.counts is not None:
            _report(res.counts.orderBy(*res.counts.columns[:1]), a.report, "counts")
    elif a.cmd == "stream":
        from .plans.spec_job import run_stream_spec
        q, _ = run_stream_spec(spark, _load_spec(a.spec), a.out, a.checkpoint,
                               source_override=a.source, trigger=a.trigger,
                               quarantine_path=a.quarantine)
        q.awaitTermination()
        print(f"stream stopped; last progress: {q.lastProgress}")
    elif a.cmd == "compact":
        from .spec import TableSpec
        from .streaming import compact_stream_rollup, purge_compacted
        spec = TableSpec.from_dict(_load_spec(a.spec).get("spec", _load_spec(a.spec)))
        upto = compact_stream_rollup(spark, spec, a.out, a.base, upto_batch=a.upto)
        print(f"base covers batches up to {upto}")
        if a.purge:
            print(f"purged {purge_compacted(spark, a.out, a.base)} partial folders")
    elif a.cmd == "inventory":
        from .plans.audit import inventory
        inv = inventory(spark, a.base, a.region_col, glob=a.glob)
        _report(inv, a.report, "inventory")
        empty = inv.filter(~F.col("has_files")).count()
        if empty:
            print(f"{empty} region folder(s) without files")
    return 0


if __name__ == "__main__":
    sys.exit(main())
