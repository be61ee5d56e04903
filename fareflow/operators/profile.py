"""Bronze profiling (PF1-PF8, DC1, DC5, DC6).

Every check of a month is a column of one grouped aggregate over
``(year, month)``: all months and all counters in a single scan, with
map-side partial aggregation so the shuffle carries one small row per month
per task.  Exact distinct counts are taken from the counted values of the
columns (the pass of PF5): Bronze is unchecked, so a column may hold any
number of values, and each of them is a row of its own there.
``approximate=True`` counts with HyperLogLog++ in the first scan instead.
Nothing is collected: each result is a DataFrame.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.functions.expressions import (
    count_when, minute_boundaries_between, null_count,
)
from fareflow.functions.rules import (
    LOCATION_MAX, LOCATION_MIN, PAYMENT_TYPE_DOMAIN, RATECODE_DOMAIN,
    STORE_AND_FWD_DOMAIN, VENDOR_DOMAIN, VERY_LONG_DISTANCE_MILES,
    VERY_LONG_DURATION_MINUTES,
)

MONTH = ["year", "month"]

# Bronze column -> null-count column name (PF2).
NULL_CHECKS = [
    ("VendorID", "null_vendor_id"),
    ("tpep_pickup_datetime", "null_pickup_datetime"),
    ("tpep_dropoff_datetime", "null_dropoff_datetime"),
    ("passenger_count", "null_passenger_count"),
    ("trip_distance", "null_trip_distance"),
    ("RatecodeID", "null_ratecode_id"),
    ("store_and_fwd_flag", "null_store_and_fwd_flag"),
    ("PULocationID", "null_pickup_location_id"),
    ("DOLocationID", "null_dropoff_location_id"),
    ("payment_type", "null_payment_type"),
    ("fare_amount", "null_fare_amount"),
    ("total_amount", "null_total_amount"),
]

# Fee column -> negative-count column name (PF4).
NEGATIVE_FEE_CHECKS = [
    ("extra", "negative_extra_count"),
    ("mta_tax", "negative_mta_tax_count"),
    ("tip_amount", "negative_tip_count"),
    ("tolls_amount", "negative_tolls_count"),
    ("improvement_surcharge", "negative_improvement_surcharge_count"),
    ("congestion_surcharge", "negative_congestion_surcharge_count"),
    ("airport_fee", "negative_airport_fee_count"),
]

# Bronze column -> distinct-count column name (PF1).
DISTINCT_CHECKS = [
    ("VendorID", "distinct_vendor_count"),
    ("payment_type", "distinct_payment_type_count"),
    ("RatecodeID", "distinct_ratecode_count"),
    ("PULocationID", "distinct_pickup_location_count"),
    ("DOLocationID", "distinct_dropoff_location_count"),
]


def _c(name: str) -> Column:
    return F.col(name)


def _lng(c: Column, name: str) -> Column:
    return c.cast("long").alias(name)


def summary_columns(approximate: bool = False) -> list[Column]:
    """PF1: row count, time range, three measures; approximate distinct counts if asked."""
    cols = [F.count(F.lit(1)).alias("total_rows")]
    if approximate:
        cols += [F.approx_count_distinct(_c(src)).alias(name) for src, name in DISTINCT_CHECKS]
    for ts, label in [("tpep_pickup_datetime", "pickup"), ("tpep_dropoff_datetime", "dropoff")]:
        cols += [F.min(ts).alias(f"min_{label}_datetime"), F.max(ts).alias(f"max_{label}_datetime")]
    for m in ["trip_distance", "fare_amount", "total_amount"]:
        cols += [F.min(m).alias(f"min_{m}"), F.max(m).alias(f"max_{m}"),
                 F.avg(m).alias(f"avg_{m}")]
    return cols


# Columns of PF1.
SUMMARY_NAMES = (["total_rows"] + [n for _, n in DISTINCT_CHECKS]
                 + [f"{e}_{t}_datetime" for t in ("pickup", "dropoff") for e in ("min", "max")]
                 + [f"{e}_{m}" for m in ("trip_distance", "fare_amount", "total_amount") for e in ("min", "max", "avg")])


def null_columns() -> list[Column]:
    """PF2: NULL count of 12 columns."""
    return [_lng(null_count(src), name) for src, name in NULL_CHECKS]


# Names of the PF3 counters.
CRITICAL_COUNTERS = [
    "invalid_datetime_count", "invalid_distance_count", "invalid_passenger_count",
    "invalid_fare_count", "invalid_total_amount_count", "null_pickup_location_count",
    "null_dropoff_location_count", "null_payment_type_count",
]


def critical_columns() -> list[Column]:
    """PF3: critical issue counters (no month-window rule, unlike Silver)."""
    pu, do = _c("tpep_pickup_datetime"), _c("tpep_dropoff_datetime")
    conds = [
        pu.isNull() | do.isNull() | (do <= pu),
        _c("trip_distance").isNull() | (_c("trip_distance") <= 0),
        _c("passenger_count").isNull() | (_c("passenger_count") <= 0),
        _c("fare_amount").isNull() | (_c("fare_amount") < 0),
        _c("total_amount").isNull() | (_c("total_amount") < 0),
        _c("PULocationID").isNull(),
        _c("DOLocationID").isNull(),
        _c("payment_type").isNull(),
    ]
    return [_lng(count_when(c), n) for c, n in zip(conds, CRITICAL_COUNTERS)]


def _outside(name: str, domain: list) -> Column:
    return _c(name).isNotNull() & ~_c(name).isin(*domain)


# Names of the PF4 counters.
WARNING_COUNTERS = (
    ["invalid_vendor_count", "invalid_payment_type_domain_count", "invalid_ratecode_count",
     "invalid_store_and_fwd_flag_count"]
    + [name for _, name in NEGATIVE_FEE_CHECKS]
    + ["pickup_location_out_of_range_count", "dropoff_location_out_of_range_count",
       "very_long_distance_count", "very_long_duration_count"]
)


def warning_columns() -> list[Column]:
    """PF4: 15 warning counters; duration counts minute boundaries."""
    def out_of_range(c: str) -> Column:
        return _c(c).isNotNull() & ((_c(c) < LOCATION_MIN) | (_c(c) > LOCATION_MAX))
    conds = [
        _outside("VendorID", VENDOR_DOMAIN),
        _outside("payment_type", PAYMENT_TYPE_DOMAIN),
        _outside("RatecodeID", RATECODE_DOMAIN),
        _outside("store_and_fwd_flag", STORE_AND_FWD_DOMAIN),
        *[_c(src) < 0 for src, _ in NEGATIVE_FEE_CHECKS],
        out_of_range("PULocationID"),
        out_of_range("DOLocationID"),
        _c("trip_distance") > VERY_LONG_DISTANCE_MILES,
        minute_boundaries_between("tpep_pickup_datetime", "tpep_dropoff_datetime")
        > VERY_LONG_DURATION_MINUTES,
    ]
    return [_lng(count_when(c), n) for c, n in zip(conds, WARNING_COUNTERS)]


def value_counts(bronze: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(year, month, column_name, value, total_rows) of several columns in one pass.

    ``stack`` unpivots each row into one row per column before the grouped
    count, so one scan and one shuffle of counted values serve all of them.  A
    common value is one row per task, a column of unlike values is spread over
    all tasks.
    """
    # Both zeros are one value.
    text = lambda c: f"CAST(`{c}` + 0 AS STRING)" if c in _DOUBLES else f"CAST(`{c}` AS STRING)"
    pairs = [f"'{c}', {text(c)}" for c in columns]
    return (bronze.select(*MONTH, F.expr(f"stack({len(pairs)}, {', '.join(pairs)})").alias("column_name", "value"))
            .groupBy(*MONTH, "column_name", "value").agg(F.count(F.lit(1)).alias("total_rows")))


_DOUBLES = {"RatecodeID", "passenger_count"}


def distinct_counts(counted: DataFrame) -> DataFrame:
    """The five distinct counts of PF1 per month, from ``value_counts``."""
    return counted.where("value is not null").groupBy(*MONTH).agg(*[
        F.count(F.when(F.col("column_name") == src, 1)).alias(name) for src, name in DISTINCT_CHECKS])


def _with_distinct(aggregated: DataFrame, bronze: DataFrame, counted: DataFrame | None) -> DataFrame:
    """Add the exact distinct counts; one row per month meets one row per month."""
    if counted is None:
        counted = value_counts(bronze, [src for src, _ in DISTINCT_CHECKS])
    both = aggregated.join(distinct_counts(counted), MONTH, "left")
    names = [n for _, n in DISTINCT_CHECKS]
    rest = [c for c in aggregated.columns if c not in (*MONTH, "total_rows")]
    return both.select(*MONTH, "total_rows", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in names], *rest)


def profile(bronze: DataFrame, approximate: bool = False, counted: DataFrame | None = None) -> DataFrame:
    """PF1-PF4 for every month: one row per (year, month).

    One scan for all counters and one of five columns for the distinct
    counts; ``counted`` (``value_counts`` of at least those) saves the second.
    """
    table = bronze.groupBy(*MONTH).agg(
        *summary_columns(approximate), *null_columns(), *critical_columns(), *warning_columns())
    return table if approximate else _with_distinct(table, bronze, counted)


def summary(bronze: DataFrame, approximate: bool = False, counted: DataFrame | None = None) -> DataFrame:
    """PF1"""
    table = bronze.groupBy(*MONTH).agg(*summary_columns(approximate))
    return table if approximate else _with_distinct(table, bronze, counted)


def null_checks(bronze: DataFrame) -> DataFrame:
    """PF2"""
    return bronze.groupBy(*MONTH).agg(*null_columns())


def critical_quality(bronze: DataFrame) -> DataFrame:
    """PF3 (with ``total_rows``)."""
    return bronze.groupBy(*MONTH).agg(F.count(F.lit(1)).alias("total_rows"),
                                      *critical_columns())


def warning_quality(bronze: DataFrame) -> DataFrame:
    """PF4"""
    return bronze.groupBy(*MONTH).agg(*warning_columns())


def distribution(bronze: DataFrame, column: str) -> DataFrame:
    """PF5: row count per value of ``column`` per month; NULL is its own group."""
    return (bronze.groupBy(*MONTH, column)
            .agg(F.count(F.lit(1)).alias("total_rows")))


DISTRIBUTION_COLUMNS = ["payment_type", "RatecodeID", "VendorID", "store_and_fwd_flag"]


def distributions(bronze: DataFrame) -> DataFrame:
    """PF5, all four in one pass: (year, month, column_name, value, total_rows)."""
    return value_counts(bronze, DISTRIBUTION_COLUMNS)


# Columns whose counted values serve PF5 and the distinct counts of PF1.
COUNTED_COLUMNS = list(dict.fromkeys(DISTRIBUTION_COLUMNS + [src for src, _ in DISTINCT_CHECKS]))


def monthly_summary(bronze: DataFrame) -> DataFrame:
    """PF6-PF8: one summary row per month (see ``summarize``)."""
    return summarize(bronze.groupBy(*MONTH).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min("tpep_pickup_datetime").alias("min_pickup_datetime"),
        F.max("tpep_pickup_datetime").alias("max_pickup_datetime"),
        F.min("tpep_dropoff_datetime").alias("min_dropoff_datetime"),
        F.max("tpep_dropoff_datetime").alias("max_dropoff_datetime"),
        *critical_columns(), *warning_columns()))


def summarize(profiled: DataFrame) -> DataFrame:
    """The summary rows from a profile (``profile`` or a part of it).

    ``critical_issue_count``/``warning_issue_count`` add up every counter of
    PF3/PF4 (a row failing two rules counts twice).  Rows are ordered by
    year, month when written (``sinks.write_profile_summary``).
    """
    total = lambda names: sum((F.coalesce(F.col(n), F.lit(0)) for n in names[1:]),
                              F.coalesce(F.col(names[0]), F.lit(0)))
    return profiled.select(
        F.concat_ws("-", "year", "month").alias("period"),
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        "total_rows",
        total(CRITICAL_COUNTERS).cast("long").alias("critical_issue_count"),
        total(WARNING_COUNTERS).cast("long").alias("warning_issue_count"),
        "min_pickup_datetime", "max_pickup_datetime",
        "min_dropoff_datetime", "max_dropoff_datetime")


def with_paths(summary: DataFrame, bronze_base: str, details_dir: str | None = None,
               generated: Iterable[str] = ()) -> DataFrame:
    """PF7: where each month was read from, and where its details went."""
    folder = F.format_string("year=%04d/month=%02d/", F.col("year"), F.col("month"))
    files = list(generated)
    return summary.select(
        "*", F.concat(F.lit(f"{bronze_base.rstrip('/')}/"), folder).alias("input_file"),
        F.lit(details_dir or "").alias("details_output_dir"),
        F.array_join(F.transform(F.lit(files).cast("array<string>"), lambda n: F.concat(n, F.lit("/"), folder)), ", ")
        .alias("generated_files"))


def quality_gate(bronze: DataFrame, max_critical_ratio: float = 0.1) -> DataFrame:
    """DC6: per month, pass when critical issues per row <= the threshold."""
    s = monthly_summary(bronze)
    ratio = F.col("critical_issue_count") / F.col("total_rows")
    return s.select(
        "period", "year", "month", "total_rows", "critical_issue_count",
        ratio.alias("critical_issue_ratio"),
        F.lit(float(max_critical_ratio)).alias("max_critical_ratio"),
        F.when(ratio <= F.lit(float(max_critical_ratio)), "passed")
         .otherwise("failed").alias("gate"))


def volume_checks(bronze: DataFrame, zone_lookup: DataFrame) -> DataFrame:
    """DC5: Bronze row count and zone lookup row count, one row per check."""
    return (bronze.agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit("bronze_row_count").alias("check"), "row_count")
            .unionByName(zone_lookup.agg(F.count(F.lit(1)).alias("row_count"))
                         .select(F.lit("zone_row_count").alias("check"), "row_count")))


# Quantiles of the documented distribution profile.
DISTANCE_QUANTILES = [0.5, 0.95, 0.99, 0.999]
DURATION_QUANTILES = [0.95, 0.99, 0.999]


def distribution_profile(silver: DataFrame, accuracy: int = 10000) -> DataFrame:
    """DC1: approximate quantiles of distance and duration per month.

    ``percentile_approx`` keeps a bounded sketch per group (size set by
    ``accuracy``), merged across tasks: no sort, no full group in memory.
    """
    def q(col: str, ps: list[float], prefix: str) -> list[Column]:
        arr = F.percentile_approx(col, ps, accuracy)
        return [arr[i].alias(f"{prefix}_p{str(p).split('.')[1].ljust(2, '0')}")
                for i, p in enumerate(ps)]
    return silver.groupBy(*MONTH).agg(
        *q("trip_distance", DISTANCE_QUANTILES, "trip_distance"),
        *q("trip_duration_minutes", DURATION_QUANTILES, "trip_duration_minutes"))
