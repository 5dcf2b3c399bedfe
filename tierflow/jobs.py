"""Job entry point: each medallion step as a separate Spark job.

    spark-submit --py-files tierflow.zip tierflow/jobs.py ingest  --source /landing/countries/
    spark-submit --py-files tierflow.zip tierflow/jobs.py refine  [--catalog main]
    spark-submit --py-files tierflow.zip tierflow/jobs.py publish [--catalog main]
    spark-submit --py-files tierflow.zip tierflow/jobs.py verify  [--catalog main]
    spark-submit --py-files tierflow.zip tierflow/jobs.py run     --source /landing/countries/
    spark-submit --py-files tierflow.zip tierflow/jobs.py compact [--catalog main]

(or ``python -m tierflow.jobs …`` where pyspark is installed). The session comes from the cluster
(``getOrCreate``), so its settings — including ``spark.checkpoint.dir`` —
are the cluster's. Steps hand off through catalog tables, so an
orchestrator can run and retry them one by one, as the original job does.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tierflow.plans.medallion import (
    Layout,
    bronze_to_silver,
    compact,
    ingest,
    run_pipeline,
    silver_to_gold,
    verify,
)

STEPS = ("ingest", "refine", "publish", "verify", "run", "compact")


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tierflow.jobs", description=__doc__.splitlines()[0])
    p.add_argument("step", choices=STEPS)
    p.add_argument("--catalog", default=None, help="catalog holding the three layers (optional)")
    p.add_argument("--bronze-db", default="bronze")
    p.add_argument("--silver-db", default="silver")
    p.add_argument("--gold-db", default="gold")
    p.add_argument("--source", nargs="+", help="JSON files or folders to land (ingest, run)")
    p.add_argument("--source-url", default=None, help="source label stored on each row")
    p.add_argument("--doc-layout", choices=("array", "large_array", "lines"), default="array")
    p.add_argument("--batch-id", default=None, help="stable id makes a retried ingest idempotent")
    p.add_argument("--validate", choices=("before", "inline"), default="inline")
    p.add_argument("--format", choices=("parquet", "delta"), default="parquet", help="of every table")
    p.add_argument("--tolerated", type=float, default=0.0, help="ingest: share of records that may lack required keys")
    p.add_argument("--together", action="store_true", help="publish, run: show the six gold tables as one run, through views")
    p.add_argument("--max-drop", type=float, default=None, help="refine drop-rate gate")
    p.add_argument(
        "--row-bounds", type=int, nargs=2, metavar=("LO", "HI"), default=None,
        help="verify: accepted silver row count, inclusive (default 220 260)",
    )
    args = p.parse_args(argv)
    if args.step in ("ingest", "run") and not args.source:
        p.error(f"{args.step} needs --source")
    return args


def layout_of(args: argparse.Namespace) -> Layout:
    return Layout(args.catalog, args.bronze_db, args.silver_db, args.gold_db, fmt=args.format)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"tierflow-{args.step}").getOrCreate()
    lay = layout_of(args)
    source = args.source[0] if args.source and len(args.source) == 1 else args.source
    gate = {} if args.max_drop is None else {"max_drop": args.max_drop}
    bounds = {} if args.row_bounds is None else {"count_bounds": tuple(args.row_bounds)}
    if args.step == "ingest":
        res = ingest(
            spark, source, lay, args.doc_layout, args.source_url, args.batch_id,
            validate=args.validate, tolerated=args.tolerated,
        )
        print(f"landed batch {res.batch_id}: {res.records} records into {lay.bronze}")
    elif args.step == "refine":
        res = bronze_to_silver(spark, lay, **gate)
        print(f"wrote {res.rows} rows to {lay.silver}")
    elif args.step == "publish":
        for table, rows in silver_to_gold(spark, lay, together=args.together).items():
            print(f"wrote {rows} rows to {lay.gold(table)}")
    elif args.step == "verify":
        verify(spark, lay, **bounds)
        print("all data quality checks passed")
    elif args.step == "compact":
        done = compact(spark, lay)
        print(f"compacted {done.partitions} partitions of {lay.bronze}, folded {done.batches} batches of {lay.batch_log}")
    else:
        res = run_pipeline(
            spark, source, lay, args.doc_layout, args.source_url, args.batch_id,
            validate=args.validate, together=args.together, **gate, **bounds,
        )
        print(f"run complete: batch {res.ingest.batch_id}, {res.silver_rows} silver rows")
    return 0


if __name__ == "__main__":
    sys.exit(main())
