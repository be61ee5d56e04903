"""Gold fact table (GF1-GF4): one row per analytical trip, no join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.functions.expressions import canonical_text, date_key
from fareflow.operators.dims import analytical
from fareflow.schema import FACT_COLUMNS

# Fields of the surrogate key, in key order, with their text form.
TRIP_KEY_FIELDS = [
    ("vendor_id", "int"),
    ("pickup_datetime", "timestamp"),
    ("dropoff_datetime", "timestamp"),
    ("pickup_location_id", "int"),
    ("dropoff_location_id", "int"),
    ("fare_amount", "double"),
    ("total_amount", "double"),
    ("year", "string"),
    ("month", "string"),
]


def trip_id() -> F.Column:
    """GF2: upper-hex MD5 of the key fields joined by '|', NULL -> ''.

    Text forms are engine independent (see ``canonical_text``): the key is
    the same whichever engine computes it.
    """
    parts = [canonical_text(name, kind) for name, kind in TRIP_KEY_FIELDS]
    return F.upper(F.md5(F.concat_ws("|", *parts)))


def fact_trip(silver: DataFrame) -> DataFrame:
    """GF4: 35 columns over outlier-filtered Silver, partitioned by year/month."""
    renamed = {
        "trip_id": trip_id(),
        "pickup_date_key": date_key("pickup_date"),
        "pickup_hour_key": F.col("pickup_hour"),
        "payment_type_id": F.col("payment_type"),
        "passenger_count": F.col("passenger_count").cast("bigint"),
    }
    return analytical(silver).select(*[
        renamed[c].alias(c) if c in renamed else F.col(c) for c in FACT_COLUMNS
    ])
