"""Command line for the batch jobs: profile, silver, gold, validate, query.

    python -m fareflow.cli profile  --bronze B --out O (--year-months 2024-01 ... | --months-file F | --year Y --month M) [--write-details]
    python -m fareflow.cli silver   --bronze B --silver S (months as above) [--rejected R] [--max-critical-ratio X] [--table T] [--force]
    python -m fareflow.cli gold     --silver S --gold G [--select dashboard|all] [--zones Z] [--test] [--force] [months as above]
    python -m fareflow.cli validate --silver S (months as above)
    python -m fareflow.cli query    --silver S --name aq1|aq2|aq3|aq4 (months as above) [--out O]

Every command runs Spark jobs on the session's cluster; only the month list
(configuration-sized) and small result tables reach the driver.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _months(spark: SparkSession, args):
    from fareflow.operators.months import choose_scope
    return choose_scope(spark, year_months=args.year_months, months_file=args.months_file,
                        year=args.year, month=args.month)


def _month_pairs(spark: SparkSession, args) -> list[tuple[int, int]]:
    frame = _months(spark, args).orderBy("line_no")
    return [(int(r["year"]), int(r["month"])) for r in frame.collect()]


def _print(df):
    """Print every row of a small result, computed once; returns the rows."""
    rows = df.collect()
    df.sparkSession.createDataFrame(rows, df.schema).show(max(1, len(rows)), truncate=False)
    return rows


def cmd_profile(spark, args):
    from fareflow.operators import profile as pf
    from fareflow.sources.bronze import read_bronze_months
    from fareflow.sources.sinks import write_profile_details, write_profile_summary
    bronze = read_bronze_months(spark, args.bronze, _month_pairs(spark, args))
    # Two scans: the counted values of the coded columns, and one row per month.
    counts = pf.value_counts(bronze, pf.COUNTED_COLUMNS).cache()
    profiled = pf.profile(bronze, counted=counts).cache()
    details, names = None, []
    if args.write_details:
        details = f"{args.out}/details"
        parts = {"summary": pf.SUMMARY_NAMES, "null_checks": [n for _, n in pf.NULL_CHECKS],
                 "critical_quality": ["total_rows", *pf.CRITICAL_COUNTERS], "warning_quality": pf.WARNING_COUNTERS}
        tables = {n: profiled.select("year", "month", *cols) for n, cols in parts.items()}
        tables |= {f"{c}_distribution": counts.where(f"column_name = '{c}'").select(
            "year", "month", counts["value"].alias(c), "total_rows") for c in pf.DISTRIBUTION_COLUMNS}
        names = write_profile_details(tables, details)
    summary = pf.with_paths(pf.summarize(profiled), args.bronze, details, names)
    write_profile_summary(summary, f"{args.out}/bronze_quality_summary")
    _print(summary.orderBy("year", "month"))


def cmd_silver(spark, args):
    from fareflow.plans.silver_job import run_silver_job
    rows = _print(run_silver_job(spark, args.bronze, args.silver, _month_pairs(spark, args), force=args.force,
                                 rejected=args.rejected, max_critical_ratio=args.max_critical_ratio,
                                 table=args.table).orderBy("year", "month"))
    return 1 if any(r["status"] in ("missing", "failed_gate") for r in rows) else 0


def cmd_gold(spark, args):
    from fareflow.operators.months import gold_completeness, months_frame
    from fareflow.plans.gold_build import (
        CORE_TABLES, DASHBOARD_TABLES, MART_TABLES, build_gold, table_paths, test_gold)
    from fareflow.sources.bronze import stored_months
    from fareflow.sources.tables import read_partitioned
    from fareflow.sources.zones import read_zone_lookup
    tables = DASHBOARD_TABLES if args.select == "dashboard" else CORE_TABLES + MART_TABLES
    paths = table_paths(args.gold, tables)
    if args.year_months or args.months_file or args.year:
        asked = _months(spark, args)
    else:  # no months named: all that Silver holds
        asked = months_frame(spark, stored_months(spark, args.silver))
    if not args.force and all(r["passed"] for r in gold_completeness(spark, paths, asked).collect()):
        print("Gold is complete for these months; nothing to build (--force rebuilds it)")
        return 0
    if "dim_zone" in tables and not args.zones:
        raise SystemExit("--zones is needed for the zone dimension")
    zones = read_zone_lookup(spark, args.zones) if args.zones else None
    build_gold(spark, read_partitioned(spark, args.silver), zones, args.gold, tables)
    if args.test and not all(r["passed"] for r in _print(test_gold(spark, paths))):
        return 1
    return 0


def cmd_validate(spark, args):
    from fareflow.operators.months import partition_coverage
    from fareflow.sources.tables import read_partitioned
    cov = partition_coverage(_months(spark, args), read_partitioned(spark, args.silver))
    return 1 if any(r["validation"] == "failed" for r in _print(cov.orderBy("line_no"))) else 0


def cmd_query(spark, args):
    from fareflow.operators import queries as aq
    from fareflow.sources.tables import read_partitioned
    fn = {"aq0": aq.smoke_read, "aq1": aq.monthly_trip_summary,
          "aq2": aq.payment_type_summary, "aq3": aq.hourly_demand_pattern,
          "aq4": aq.top_pickup_zones}[args.name]
    result = fn(read_partitioned(spark, args.silver), _month_pairs(spark, args))
    if args.out:
        result.coalesce(1).write.mode("overwrite").option("header", True).csv(args.out)
    else:
        _print(result)


def _add_months(p):
    p.add_argument("--year-months", nargs="+")
    p.add_argument("--months-file")
    p.add_argument("--year", type=int)
    p.add_argument("--month", type=int)


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="fareflow")
    sub = parser.add_subparsers(dest="command", required=True)
    p = sub.add_parser("profile")
    p.add_argument("--bronze", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--write-details", action="store_true")
    _add_months(p)
    p = sub.add_parser("silver")
    p.add_argument("--bronze", required=True)
    p.add_argument("--silver", required=True)
    p.add_argument("--rejected", help="base of the rejected rows (default: the Silver base with _rejected)")
    p.add_argument("--max-critical-ratio", type=float, help="leave a month with more critical issues a row unwritten")
    p.add_argument("--table", help="catalog table that learns the written months")
    p.add_argument("--force", action="store_true")
    _add_months(p)
    p = sub.add_parser("gold")
    p.add_argument("--silver", required=True)
    p.add_argument("--zones", help="zone lookup; needed for the zone dimension and the zone marts")
    p.add_argument("--select", choices=["dashboard", "all"], default="dashboard",
                   help="dashboard: what the daily revenue report needs; all: every dimension and mart")
    p.add_argument("--gold", required=True)
    p.add_argument("--test", action="store_true")
    p.add_argument("--force", action="store_true")
    _add_months(p)
    p = sub.add_parser("validate")
    p.add_argument("--silver", required=True)
    _add_months(p)
    p = sub.add_parser("query")
    p.add_argument("--silver", required=True)
    p.add_argument("--name", required=True, choices=["aq0", "aq1", "aq2", "aq3", "aq4"])
    p.add_argument("--out")
    _add_months(p)
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    from fareflow.session import configure
    args = build_parser().parse_args(argv)
    spark = configure(spark or SparkSession.builder.appName("fareflow").getOrCreate())
    handler = {"profile": cmd_profile, "silver": cmd_silver, "gold": cmd_gold,
               "validate": cmd_validate, "query": cmd_query}[args.command]
    return int(handler(spark, args) or 0)


if __name__ == "__main__":
    sys.exit(main())
