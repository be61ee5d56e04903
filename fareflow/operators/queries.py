"""Bounded analytic queries over Silver (AQ0-AQ4) and the Bronze top zones (DC3).

Each query takes an optional month list.  Given one, it is applied as a
filter on the partition columns (``months.restrict``), so on a partitioned
Silver table only those folders are listed and read.  Without one the query
runs for every month at once, grouped by year and month as well, which is
the same answer as running the one-month query month by month.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareflow.functions.expressions import count_when
from fareflow.operators.months import restrict

MONTH = ["year", "month"]

# Columns of the smoke read.
SMOKE_COLUMNS = [
    "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count",
    "trip_distance", "fare_amount", "total_amount", "pickup_location_id",
    "dropoff_location_id", "payment_type", "year", "month",
]
SMOKE_ROWS = 25
TOP_PICKUP_ZONES = 25
TOP_NAMED_ZONES = 10


def _scoped(silver: DataFrame, months: Iterable[tuple[int, int]] | None) -> DataFrame:
    return silver if months is None else restrict(silver, months)


def smoke_read(silver: DataFrame, months: Iterable[tuple[int, int]] | None = None) -> DataFrame:
    """AQ0: 12 explicit columns, at most 25 rows, in no order (a read check)."""
    return _scoped(silver, months).select(*SMOKE_COLUMNS).limit(SMOKE_ROWS)


def ordered_smoke_read(silver: DataFrame, months: Iterable[tuple[int, int]] | None = None) -> DataFrame:
    """AQ0 with a full order over its columns, so that its rows are defined.

    Rows that tie in all columns are equal rows.  Each task keeps its first
    25 rows before anything is exchanged.
    """
    return _scoped(silver, months).select(*SMOKE_COLUMNS).orderBy(*SMOKE_COLUMNS).limit(SMOKE_ROWS)


def monthly_trip_summary(silver: DataFrame,
                         months: Iterable[tuple[int, int]] | None = None) -> DataFrame:
    """AQ1: per month trips, revenue, three averages, outlier count (NULL -> 0)."""
    return (_scoped(silver, months).groupBy(*MONTH).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("total_amount").alias("avg_total_amount"),
        F.avg("trip_distance").alias("avg_trip_distance"),
        F.avg("trip_duration_minutes").alias("avg_trip_duration_minutes"),
        count_when(F.col("is_analytical_outlier")).alias("analytical_outlier_count"))
        .orderBy(*MONTH))


def payment_type_summary(silver: DataFrame,
                         months: Iterable[tuple[int, int]] | None = None) -> DataFrame:
    """AQ2: per month and payment type; busiest first."""
    return (_scoped(silver, months).groupBy(*MONTH, "payment_type").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("fare_amount").alias("avg_fare_amount"),
        F.avg("tip_amount").alias("avg_tip_amount"),
        F.avg("tip_rate").alias("avg_tip_rate"))
        .orderBy(*MONTH, F.desc("trip_count"), "payment_type"))


def hourly_demand_pattern(silver: DataFrame,
                          months: Iterable[tuple[int, int]] | None = None) -> DataFrame:
    """AQ3: per month and pickup hour."""
    return (_scoped(silver, months).groupBy(*MONTH, "pickup_hour").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("trip_distance").alias("avg_trip_distance"),
        F.avg("trip_duration_minutes").alias("avg_trip_duration_minutes"))
        .orderBy(*MONTH, "pickup_hour"))


def _top_per_month(agg: DataFrame, k: int, order: list) -> DataFrame:
    """Top-k rows per month of an already aggregated (small) table.

    The window only sees aggregated rows (at most one per location per
    month), so each window partition is bounded by the number of zones.
    """
    w = Window.partitionBy(*MONTH).orderBy(*order)
    return (agg.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k))


def top_pickup_zones(silver: DataFrame, months: Iterable[tuple[int, int]] | None = None,
                     k: int = TOP_PICKUP_ZONES) -> DataFrame:
    """AQ4: per month the k busiest pickup locations (ties: lower id first)."""
    agg = _scoped(silver, months).groupBy(*MONTH, "pickup_location_id").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("total_amount").alias("avg_total_amount"),
        F.avg("trip_distance").alias("avg_trip_distance"))
    return (_top_per_month(agg, k, [F.desc("trip_count"), "pickup_location_id"])
            .orderBy(*MONTH, "rank"))


def top_pickup_zones_named(bronze: DataFrame, zone_lookup: DataFrame,
                           months: Iterable[tuple[int, int]] | None = None,
                           k: int = TOP_NAMED_ZONES) -> DataFrame:
    """DC3/JN5: Bronze trips per pickup zone with borough and zone names, top k.

    Counts per location first, then joins the per-location counts (not the
    trips) to the lookup: the join input is one row per location and month.
    """
    counts = (_scoped(bronze, months).groupBy(*MONTH, "PULocationID")
              .agg(F.count(F.lit(1)).alias("trip_count")))
    zones = zone_lookup.select(F.col("LocationID").cast("long").alias("_loc"),
                               F.col("Borough").alias("borough"), F.col("Zone").alias("zone"))
    named = (counts.join(zones, counts.PULocationID == zones._loc, "inner")
             .select(*MONTH, F.col("PULocationID").alias("pickup_location_id"),
                     "borough", "zone", "trip_count"))
    return (_top_per_month(named, k, [F.desc("trip_count"), "pickup_location_id"])
            .orderBy(*MONTH, "rank"))
