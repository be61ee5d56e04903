"""Column names and types of every layer, held as data.

Bronze is schema-on-read and drifts between months; Silver is fixed by the
projection table ``SILVER_COLUMNS`` (45 columns, partition columns last).
"""

from __future__ import annotations

from pyspark.sql import types as T

# The raw (Bronze) column names consumed by the Silver job.
BRONZE_COLUMNS = [
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime",
    "passenger_count", "trip_distance", "RatecodeID", "store_and_fwd_flag",
    "PULocationID", "DOLocationID", "payment_type", "fare_amount", "extra",
    "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "total_amount", "congestion_surcharge", "airport_fee",
]

# Fee columns that default to 0.0 when missing or NULL.
FEE_COLUMNS = [
    "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "congestion_surcharge", "airport_fee",
]

# Silver projection (name, type); partition columns last.
SILVER_COLUMNS: list[tuple[str, T.DataType]] = [
    ("vendor_id", T.IntegerType()),
    ("pickup_datetime", T.TimestampNTZType()),
    ("dropoff_datetime", T.TimestampNTZType()),
    ("passenger_count", T.LongType()),
    ("trip_distance", T.DoubleType()),
    ("ratecode_id", T.LongType()),
    ("store_and_fwd_flag", T.StringType()),
    ("pickup_location_id", T.IntegerType()),
    ("dropoff_location_id", T.IntegerType()),
    ("payment_type", T.LongType()),
    ("fare_amount", T.DoubleType()),
    ("extra", T.DoubleType()),
    ("mta_tax", T.DoubleType()),
    ("tip_amount", T.DoubleType()),
    ("tolls_amount", T.DoubleType()),
    ("improvement_surcharge", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("congestion_surcharge", T.DoubleType()),
    ("airport_fee", T.DoubleType()),
    ("trip_duration_minutes", T.DoubleType()),
    ("pickup_date", T.DateType()),
    ("pickup_hour", T.IntegerType()),
    ("pickup_day_of_week", T.StringType()),
    ("fare_per_mile", T.DoubleType()),
    ("tip_rate", T.DoubleType()),
    ("avg_speed_mph", T.DoubleType()),
    ("fare_per_minute", T.DoubleType()),
    ("same_pickup_dropoff_zone", T.BooleanType()),
    ("is_invalid_vendor", T.BooleanType()),
    ("is_invalid_payment_type_domain", T.BooleanType()),
    ("is_invalid_ratecode", T.BooleanType()),
    ("is_invalid_store_and_fwd_flag", T.BooleanType()),
    ("has_negative_fee_component", T.BooleanType()),
    ("is_pickup_location_out_of_range", T.BooleanType()),
    ("is_dropoff_location_out_of_range", T.BooleanType()),
    ("is_very_long_distance", T.BooleanType()),
    ("is_very_long_duration", T.BooleanType()),
    ("has_warning_quality_issue", T.BooleanType()),
    ("is_extreme_speed", T.BooleanType()),
    ("is_fare_distance_mismatch", T.BooleanType()),
    ("is_distance_duration_mismatch", T.BooleanType()),
    ("is_same_zone_high_fare", T.BooleanType()),
    ("is_analytical_outlier", T.BooleanType()),
    ("year", T.StringType()),
    ("month", T.StringType()),
]

# Zone lookup CSV (header row; names as in the published lookup file).
ZONE_CSV_SCHEMA = T.StructType([
    T.StructField("LocationID", T.IntegerType(), True),
    T.StructField("Borough", T.StringType(), True),
    T.StructField("Zone", T.StringType(), True),
    T.StructField("service_zone", T.StringType(), True),
])

# Fact table columns in output order (35).
FACT_COLUMNS = [
    "trip_id", "pickup_datetime", "dropoff_datetime", "pickup_date_key",
    "pickup_hour_key", "pickup_day_of_week", "vendor_id", "ratecode_id",
    "payment_type_id", "pickup_location_id", "dropoff_location_id",
    "passenger_count", "trip_distance", "trip_duration_minutes", "fare_amount",
    "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "congestion_surcharge", "airport_fee", "total_amount", "fare_per_mile",
    "tip_rate", "avg_speed_mph", "fare_per_minute", "same_pickup_dropoff_zone",
    "has_warning_quality_issue", "is_extreme_speed", "is_fare_distance_mismatch",
    "is_distance_duration_mismatch", "is_same_zone_high_fare", "year", "month",
]

# Columns of a split row beside the Silver columns: a rejected row as it was
# delivered and the rules it failed (NULL for accepted rows).
SPLIT_COLUMNS = ["raw", "failed_rules"]
