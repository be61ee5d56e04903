"""Gold dimensions (GD1-GD6).

Constant dimensions are tiny relations built with ``createDataFrame``; the
date dimension is derived from the same outlier-filtered trips that feed the
fact table, so its keys cover every fact row by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.functions.expressions import date_key, iso_day_of_week

# Payment types (id, name, is standard payment).
PAYMENT_TYPES = [
    (1, "Credit card", True),
    (2, "Cash", True),
    (3, "No charge", False),
    (4, "Dispute", False),
]

# Rate codes (id, name).
RATE_CODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
    (99, "Unknown"),
]

# Vendors (id, name).
VENDORS = [
    (1, "Creative Mobile Technologies"),
    (2, "VeriFone"),
]

# Hour ranges of the time periods (inclusive), else 'night'.
TIME_PERIODS = [
    (0, 5, "late_night"),
    (6, 10, "morning"),
    (11, 15, "midday"),
    (16, 20, "evening"),
]
OTHER_TIME_PERIOD = "night"

# Three-letter month names.
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
               "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def analytical(silver: DataFrame) -> DataFrame:
    """GF1: drop analytical outliers; a NULL outlier flag is kept."""
    return silver.filter(~F.coalesce(F.col("is_analytical_outlier"), F.lit(False)))


def dim_date(silver: DataFrame) -> DataFrame:
    """GD1: one row per distinct non-null pickup date of non-outlier trips."""
    dates = (analytical(silver).select(F.col("pickup_date").alias("date"))
             .filter(F.col("date").isNotNull()).distinct())
    return dates_to_dim(dates)


def dates_to_dim(dates: DataFrame) -> DataFrame:
    """Calendar attributes of a one-column ``date`` relation."""
    month_name = F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month("date"))
    dow = iso_day_of_week("date")
    return dates.select(
        date_key("date").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        month_name.alias("month_name"),
        F.dayofmonth("date").alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format("date", "EEEE").alias("day_of_week_name"),
        dow.isin(6, 7).alias("is_weekend"),
    )


def dim_hour(spark: SparkSession) -> DataFrame:
    """GD2: hours 0-23 with their time period."""
    hour = F.col("hour_key")
    period = F.lit(OTHER_TIME_PERIOD)
    for lo, hi, name in reversed(TIME_PERIODS):
        period = F.when(hour.between(lo, hi), F.lit(name)).otherwise(period)
    return (spark.range(0, 24).select(F.col("id").cast("int").alias("hour_key"))
            .select("hour_key", F.col("hour_key").alias("hour"), period.alias("time_period")))


def dim_payment_type(spark: SparkSession) -> DataFrame:
    """GD3"""
    schema = T.StructType([
        T.StructField("payment_type_id", T.IntegerType(), False),
        T.StructField("payment_type_name", T.StringType(), False),
        T.StructField("is_standard_payment", T.BooleanType(), False),
    ])
    return spark.createDataFrame(PAYMENT_TYPES, schema)


def dim_rate_code(spark: SparkSession) -> DataFrame:
    """GD4"""
    schema = T.StructType([
        T.StructField("ratecode_id", T.IntegerType(), False),
        T.StructField("ratecode_name", T.StringType(), False),
    ])
    return spark.createDataFrame(RATE_CODES, schema)


def dim_vendor(spark: SparkSession) -> DataFrame:
    """GD5"""
    schema = T.StructType([
        T.StructField("vendor_id", T.IntegerType(), False),
        T.StructField("vendor_name", T.StringType(), False),
    ])
    return spark.createDataFrame(VENDORS, schema)


def dim_zone(zone_lookup: DataFrame) -> DataFrame:
    """GD6: project/rename the zone lookup; rows without an id are dropped."""
    return (zone_lookup.select(
        F.col("LocationID").cast("int").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        F.col("service_zone").alias("service_zone"))
        .filter(F.col("location_id").isNotNull()))
