"""Jobs from the command line, e.g. with spark-submit:

    python -m tellerline --root /data stage-to-bronze --folder atm_visits
    python -m tellerline --root /data silver --table atm_visits --trigger-mode Streaming
    python -m tellerline --root /data stream-all
    python -m tellerline --root /data gold-daily --anchor 20240120 --num-days 3
"""

from __future__ import annotations

import argparse
import datetime as dt
import signal
import threading
from dataclasses import replace

from pyspark.sql import SparkSession

from tellerline import plans, schemas, streaming
from tellerline.params import DayWindow, JobConfig, MonthWindow, TriggerMode
from tellerline.session import build_session
from tellerline.sources import create_layer_tables
from tellerline.streaming.bronze import progress

ROOTS = ("stage_root", "bronze_root", "silver_root", "gold_root", "checkpoint_root")
SCHEMAS = ("bronze_schema", "silver_schema", "gold_schema")
SETTINGS = ("key_buckets", "split_rows", "poll_seconds", "time_zone", "max_files_per_trigger", "max_bronze_files_per_trigger", *SCHEMAS)

SILVER_JOBS = {
    "atm_customers": streaming.run_customers,
    "atm_locations": streaming.run_locations,
    "atm_visits": streaming.run_visits,
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tellerline")
    top.add_argument("--root", required=True, help="shared folder that holds all layers")
    top.add_argument("--key-buckets", type=int, default=64, help="fixed once a dimension table is written")
    top.add_argument("--split-rows", type=int, help="open rows above which a bucket is split")
    top.add_argument("--poll-seconds", type=int, default=15, help="how often a streaming run looks for files")
    top.add_argument("--time-zone", default="UTC", help="zone in which dates are defined")
    for field in ROOTS:
        top.add_argument(f"--{field.replace('_', '-')}", help="by default a folder of --root")
    for field in SCHEMAS:
        top.add_argument(f"--{field.replace('_', '-')}", default=field.split("_")[0])
    top.add_argument("--max-files-per-trigger", type=int, default=20, help="staged files per micro-batch")
    top.add_argument("--max-bronze-files-per-trigger", type=int, default=1000, help="bronze files per merge")
    jobs = top.add_subparsers(dest="job", required=True)

    tables = jobs.add_parser("create-tables")
    tables.add_argument("--layer", choices=sorted(schemas.LAYER_TABLES), required=True)
    tables.add_argument("--reset", action="store_true", help="also empty the tables")

    bronze = jobs.add_parser("stage-to-bronze")
    bronze.add_argument("--folder", choices=sorted(schemas.STAGED), required=True)
    bronze.add_argument("--table", help="bronze table, by default named like the folder")
    bronze.add_argument("--quarantine", action="store_true", help="split off lines that do not parse")
    bronze.add_argument("--rescue", action="store_true", help="keep undeclared and wrongly typed fields")
    bronze.add_argument("--measure", action="store_true", help="count rows, null keys, late and rejected rows")
    bronze.add_argument("--late-before", type=dt.date.fromisoformat, help="with --measure: first day that is not late, yyyy-mm-dd")
    silver = jobs.add_parser("silver")
    silver.add_argument("--table", choices=sorted(SILVER_JOBS), required=True)
    silver.add_argument("--first-effective", help="customers: column that dates a first version")
    silver.add_argument("--literal", action="store_true", help="customers: miss changes from and to NULL")
    for job in (bronze, silver):
        job.add_argument("--trigger-mode", type=TriggerMode, choices=list(TriggerMode), default=TriggerMode.BATCH)

    together = jobs.add_parser("stream-all", help="all jobs to bronze and silver, until the process is told to end")
    together.add_argument("--restarts", type=int, default=3, help="failures in a row before all are stopped")

    daily = jobs.add_parser("gold-daily")
    daily.add_argument("--anchor", default="CURRENT_DATE", help="last day, yyyyMMdd")
    daily.add_argument("--num-days", type=int, default=3)
    monthly = jobs.add_parser("gold-monthly")
    monthly.add_argument("--anchor", default="LAST_MONTH", help="month after the last one, yyyyMM")
    monthly.add_argument("--num-months", type=int, default=1)
    for job in (daily, monthly):
        job.add_argument("--literal", action="store_true", help="the behaviour as originally written")
    return top


def stream_all(spark: SparkSession, config: JobConfig, restarts: int) -> dict[str, int]:
    """All streaming jobs side by side; they take up what there is and stop when the process is interrupted or terminated."""
    config = replace(config, trigger_mode=TriggerMode.STREAMING)
    over = threading.Event()
    before = {number: signal.signal(number, lambda *_: over.set()) for number in (signal.SIGINT, signal.SIGTERM)}
    jobs = {f"bronze {f}": lambda f=f: streaming.run_stage_to_bronze(spark, config, f) for f in sorted(schemas.STAGED)}
    jobs |= {f"silver {t}": lambda run=run: run(spark, config) for t, run in SILVER_JOBS.items()}
    try:
        return streaming.supervise(spark, jobs, over.is_set, restarts)
    finally:
        for number, handler in before.items():
            signal.signal(number, handler)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    mode = getattr(args, "trigger_mode", TriggerMode.BATCH)
    roots = {field: getattr(args, field) for field in ROOTS if getattr(args, field)}
    settings = {field: getattr(args, field) for field in SETTINGS}
    config = JobConfig.under(args.root, trigger_mode=mode, **settings, **roots)
    spark = build_session(f"tellerline {args.job}", spark__sql__session__timeZone=args.time_zone)
    if args.job == "create-tables":
        print(create_layer_tables(spark, config, args.layer, args.reset))
    elif args.job == "stream-all":
        print(stream_all(spark, config, args.restarts))
    elif args.job == "gold-daily":
        print(plans.run_daily(spark, config, DayWindow.resolve(args.anchor, args.num_days, zone=args.time_zone), literal=args.literal))
    elif args.job == "gold-monthly":
        print(plans.run_monthly(spark, config, MonthWindow.resolve(args.anchor, args.num_months, zone=args.time_zone), literal=args.literal))
    else:
        if args.job == "stage-to-bronze":
            options = {"rescue": args.rescue, "measure": args.measure, "late_before": args.late_before}
            query = streaming.run_stage_to_bronze(spark, config, args.folder, args.table, args.quarantine, **options)
        else:
            options = {"first_effective": args.first_effective, "literal": args.literal} if args.table == "atm_customers" else {}
            query = SILVER_JOBS[args.table](spark, config, **options)
        query.awaitTermination()
        print(progress(query))


if __name__ == "__main__":
    main()
