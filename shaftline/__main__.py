"""Monitor a fleet from its readings: ``python -m shaftline READINGS TARGET``.

Stores the clean, daily, flagged and scored tables and all reports below TARGET
and shows the head of each report. Works under ``spark-submit`` as well.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from shaftline.config import BASELINE_DAYS, READINGS, Monitor
from shaftline.operators.baseline import significant_days
from shaftline.operators.cleaning import both_reports
from shaftline.operators.grading import is_restricted, restricted_days
from shaftline.operators.quality import preview
from shaftline.plans.monitoring import (
    REPORTS,
    TRENDS,
    inspect_run,
    run_monitoring,
    update_monitoring,
)
from shaftline.session import build_session
from shaftline.sources.tables import (
    publish,
    read_readings,
    read_table,
    read_with_rejects,
    verify_publish,
    write_table,
)

# Rows shown of each stored report.
SHOWN = 50


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="shaftline", description=__doc__)
    parser.add_argument("readings", help="CSV with a header, or Parquet; file or folder")
    parser.add_argument("target", help="folder for the stored tables")
    parser.add_argument("--parquet", action="store_true", help="READINGS is Parquet")
    parser.add_argument(
        "--rejects",
        metavar="URI",
        help="store malformed CSV lines there and go on, instead of failing",
    )
    parser.add_argument("--infer", action="store_true", help="infer the schema")
    parser.add_argument("--timestamp-format", help="of times not written as 2026-01-31 12:30:00")
    parser.add_argument("--no-clean-table", action="store_true", help="skip storing clean rows")
    parser.add_argument(
        "--update",
        choices=("merge", "days"),
        help="add READINGS to the tables of TARGET, or replace the days they are of",
    )
    parser.add_argument("--publish", metavar="URI", help="also publish the flagged days there")
    rule = parser.add_mutually_exclusive_group()
    rule.add_argument(
        "--baseline-cutoff", metavar="YYYY-MM-DD", help="days up to then, for the whole fleet"
    )
    rule.add_argument(
        "--baseline-days",
        type=int,
        default=BASELINE_DAYS,
        metavar="N",
        help=f"each machine's own first N days, {BASELINE_DAYS} unless said otherwise",
    )
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parse(argv)
    cfg = Monitor(baseline_cutoff=args.baseline_cutoff, baseline_days=args.baseline_days)
    spark = spark or build_session()

    if args.parquet:
        readings = read_table(spark, args.readings, None if args.infer else READINGS)
    elif args.rejects:
        readings, rejects = read_with_rejects(
            spark, args.readings, timestamp_format=args.timestamp_format
        )
        write_table(rejects, args.rejects)
        print(f"RejectedLines: {read_table(spark, args.rejects, rejects.schema).count()}")
    else:
        readings = read_readings(
            spark, args.readings, infer=args.infer, timestamp_format=args.timestamp_format
        )
    readings.printSchema()
    preview(readings, 10).show(truncate=False)

    if args.update:
        run = update_monitoring(spark, readings, args.target, cfg, args.update == "days")
    else:
        store_clean = not args.no_clean_table
        run = run_monitoring(spark, readings, args.target, cfg, store_clean)
    if run.counts is None:
        both_reports(readings, cfg).show(vertical=True)
    else:  # counted while the clean rows were written
        for name, count in run.counts.items():
            print(f"{name}: {count}")
    flagged = run.tables.read(spark, "flagged")
    restricted_days(flagged, cfg=cfg).show(SHOWN)
    significant_days(run.tables.read(spark, "scored"), cfg=cfg).show(SHOWN)
    for name in REPORTS:
        print(f"{name} (whole in {run.tables.report(name)})")
        order = [cfg.key, cfg.date] if name in TRENDS else None
        preview(run.tables.read(spark, name), SHOWN, order).show(SHOWN)
    inspect_run(spark, run.tables, cfg).show()

    if args.publish:
        counts = {"RestrictedDays": is_restricted(cfg)}
        receipt = publish(
            flagged, args.publish, counts, partition_by=[cfg.date], sort_by=[cfg.key], arrange=False
        )
        verify_publish(spark, receipt, counts).show()


if __name__ == "__main__":
    main()
