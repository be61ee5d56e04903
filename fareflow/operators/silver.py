"""Bronze -> Silver: clean, fill, derive, flag, project (CR, SN3, SN4, DV, WF, OF, RC1, DC2).

The whole transform is a narrow, row-wise map: one filter and a few
projections that Catalyst collapses into a single whole-stage-codegen stage.
No shuffle, no UDF.  Input is normalised Bronze (``sources.bronze``) with
string partition columns ``year`` and ``month``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.functions.expressions import (
    any_of, count_when, epoch_seconds, guarded_ratio, month_start, next_month_start,
)
from fareflow.functions.rules import (
    conjunction, critical_rules, failed_rule_ids, outlier_flags, passes_all, warning_flags,
)
from fareflow.schema import FEE_COLUMNS, SILVER_COLUMNS, SPLIT_COLUMNS


def silver_rules(strict_payment_domain: bool = False, month_window: bool = True):
    """The admission rules with the pickup window taken from year/month.

    When year/month are literals (a single-month job) the window bounds
    constant-fold, so the pickup range pushes down to the parquet scan.
    """
    if month_window:
        start, end = month_start("year", "month"), next_month_start("year", "month")
    else:
        start = end = None
    return critical_rules(start, end, strict_payment_domain)


def clean(bronze: DataFrame, strict_payment_domain: bool = False) -> DataFrame:
    """Rows passing all critical rules (NULL comparisons reject)."""
    return bronze.filter(conjunction(silver_rules(strict_payment_domain)))


def rejected(bronze: DataFrame, strict_payment_domain: bool = False) -> DataFrame:
    """DC2: the complement of ``clean`` with the ids of the failed rules.

    ``clean(b)`` and ``rejected(b)`` partition ``b`` exactly.
    """
    rules = silver_rules(strict_payment_domain)
    failed = failed_rule_ids(rules)
    return (bronze.filter(~passes_all(rules))
            .withColumn("failed_rules", failed)
            .withColumn("failed_rule_count", F.size("failed_rules")))


def derive(cleaned: DataFrame) -> DataFrame:
    """Fill fees (SN3), derive DV1-DV8 and every WF/OF flag."""
    fees = {f: F.coalesce(F.col(f), F.lit(0.0)).alias(f) for f in FEE_COLUMNS}
    passthrough = [c for c in cleaned.columns if c not in fees]
    minutes = ((epoch_seconds("tpep_dropoff_datetime")
                - epoch_seconds("tpep_pickup_datetime")) / F.lit(60.0))
    stage1 = cleaned.select(
        *passthrough, *fees.values(),
        minutes.alias("trip_duration_minutes"),
        F.to_date("tpep_pickup_datetime").alias("pickup_date"),
        F.hour("tpep_pickup_datetime").alias("pickup_hour"),
        F.date_format("tpep_pickup_datetime", "EEEE").alias("pickup_day_of_week"),
    )
    positive_minutes = F.col("trip_duration_minutes") > 0
    stage2 = stage1.select(
        "*",
        guarded_ratio("fare_amount", "trip_distance", F.col("trip_distance") > 0)
        .alias("fare_per_mile"),
        guarded_ratio("tip_amount", "fare_amount", F.col("fare_amount") > 0)
        .alias("tip_rate"),
        guarded_ratio(F.col("trip_distance"), F.col("trip_duration_minutes") / F.lit(60.0),
                      positive_minutes).alias("avg_speed_mph"),
        guarded_ratio("fare_amount", "trip_duration_minutes", positive_minutes)
        .alias("fare_per_minute"),
    )
    warnings, outliers = warning_flags(), outlier_flags()
    stage3 = stage2.select(
        "*",
        (F.col("PULocationID") == F.col("DOLocationID")).alias("same_pickup_dropoff_zone"),
        *[expr.alias(name) for name, expr in warnings],
        *[expr.alias(name) for name, expr in outliers],
    )
    return stage3.select(
        "*",
        any_of(F.col(n) for n, _ in warnings).alias("has_warning_quality_issue"),
        any_of(F.col(n) for n, _ in outliers).alias("is_analytical_outlier"),
    )


# Raw (Bronze) name of each Silver column that is a renamed raw column.
_RAW_NAME = {
    "vendor_id": "VendorID",
    "pickup_datetime": "tpep_pickup_datetime",
    "dropoff_datetime": "tpep_dropoff_datetime",
    "ratecode_id": "RatecodeID",
    "pickup_location_id": "PULocationID",
    "dropoff_location_id": "DOLocationID",
}


def project(derived: DataFrame) -> DataFrame:
    """SN4: the fixed 45-column Silver schema (cast + rename, partitions last)."""
    return derived.select(*[
        F.col(_RAW_NAME.get(name, name)).cast(dtype).alias(name)
        for name, dtype in SILVER_COLUMNS
    ])


def to_silver(bronze: DataFrame, strict_payment_domain: bool = False) -> DataFrame:
    """Normalised Bronze -> Silver rows (all months present in the input)."""
    return project(derive(clean(bronze, strict_payment_domain)))


ACCEPTED, REJECTED = "accepted", "rejected"


def split(bronze: DataFrame, strict_payment_domain: bool = False) -> DataFrame:
    """Every Bronze row once, by ``outcome``: the narrow map behind one write of both.

    Accepted rows carry the Silver columns; rejected rows carry ``raw`` and
    ``failed_rules`` and nothing else, so neither side stores the other's
    values.  ``outcome``, ``year`` and ``month`` come last, as partitions.
    """
    rules = silver_rules(strict_payment_domain)
    ok = passes_all(rules)
    marked = bronze.select(
        "*", ok.alias("_accepted"),
        F.when(~ok, F.struct(*[F.col(c) for c in bronze.columns if c not in ("year", "month")])).alias("raw"),
        F.when(~ok, failed_rule_ids(rules)).alias("failed_rules"))
    accepted = F.col("_accepted")
    return derive(marked).select(
        *[F.when(accepted, F.col(_RAW_NAME.get(name, name)).cast(dtype)).alias(name)
          for name, dtype in SILVER_COLUMNS if name not in ("year", "month")],
        *SPLIT_COLUMNS, F.when(accepted, ACCEPTED).otherwise(REJECTED).alias("outcome"), "year", "month")


def stored_rejected(rows: DataFrame) -> DataFrame:
    """DC2 read back: the rejected rows of a split as ``rejected`` returns them."""
    return rows.select("raw.*", "year", "month", "failed_rules", F.size("failed_rules").alias("failed_rule_count"))


def reconcile(bronze: DataFrame, strict_payment_domain: bool = False) -> DataFrame:
    """RC1: per month bronze_count, silver_count, dropped_count in one pass."""
    keep = passes_all(silver_rules(strict_payment_domain))
    return (bronze.groupBy("year", "month")
            .agg(F.count(F.lit(1)).alias("bronze_count"),
                 count_when(keep).cast("long").alias("silver_count"))
            .withColumn("dropped_count", F.col("bronze_count") - F.col("silver_count")))


def rule_failure_counts(bronze: DataFrame, strict_payment_domain: bool = False) -> DataFrame:
    """Per month, one column per critical rule: rows failing that rule."""
    rules = silver_rules(strict_payment_domain)
    return (bronze.groupBy("year", "month")
            .agg(*[count_when(~F.coalesce(r.keep(), F.lit(False))).cast("long")
                   .alias(f"{r.rule_id.lower()}_{r.name}_failures") for r in rules]))
