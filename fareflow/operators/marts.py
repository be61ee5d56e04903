"""Gold marts (MT1-MT5) over the fact table and dimensions.

MT1-MT4 join the fact to a dimension with a unique key and group by that
dimension's columns.  They aggregate the fact on the join key first and join
the (small) aggregate to the dimension afterwards: the same rows as
join-then-group, but the join never touches individual trips and the only
shuffle carries one partial row per key per task.  MT5 needs both zone
roles of a trip to classify it, so it aggregates by (pickup, dropoff) pair
first, looks both zones up per pair and adds the pairs up into four groups.

Inner joins keep the reference's consequences: trips whose location has no
zone drop out of MT3/MT5, payment types outside the dimension out of MT4.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.functions.expressions import count_when
from fareflow.plans.joins import lookup_after_aggregate

# Zone names that count as airports.
AIRPORT_ZONE_NAMES = ["JFK Airport", "LaGuardia Airport", "Newark Airport"]


def _trips() -> Column:
    # count(trip_id): the key is an MD5 digest and never NULL, so this is a
    # row count, and the digest need not be computed for the mart.
    return F.count(F.lit(1)).alias("total_trips")


def _avgs(*names: str) -> list[Column]:
    return [F.avg(n).alias(f"avg_{n}") for n in names]


def _sums(pairs: list[tuple[str, str]]) -> list[Column]:
    return [F.sum(src).alias(out) for out, src in pairs]


def mart_daily_trip_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """MT1: per pickup date; sums zero-filled, plus conditional counts."""
    zf = lambda c: F.coalesce(F.col(c), F.lit(0))
    agg = fact.groupBy("pickup_date_key").agg(
        _trips(),
        F.sum(zf("passenger_count")).alias("total_passengers"),
        F.sum(zf("total_amount")).alias("total_revenue"),
        F.sum(zf("fare_amount")).alias("total_fare_amount"),
        F.sum(zf("tip_amount")).alias("total_tip_amount"),
        F.sum(zf("tolls_amount")).alias("total_tolls_amount"),
        F.sum(zf("airport_fee")).alias("total_airport_fee"),
        F.sum(zf("congestion_surcharge")).alias("total_congestion_surcharge"),
        *_avgs("total_amount", "fare_amount", "tip_amount", "tip_rate",
               "trip_distance", "trip_duration_minutes", "fare_per_mile"),
        count_when(F.col("payment_type_id") == 1).alias("credit_card_trips"),
        count_when(F.col("payment_type_id") == 2).alias("cash_trips"),
        count_when(zf("airport_fee") > 0).alias("airport_fee_trips"),
        count_when(F.coalesce(F.col("has_warning_quality_issue"), F.lit(False)))
        .alias("warning_trip_count"),
    )
    measures = [c for c in agg.columns if c != "pickup_date_key"]
    joined = lookup_after_aggregate(agg, dim_date.select("date_key", "date"),
                                    {"pickup_date_key": "date_key"})
    return joined.select("date_key", "date", *measures)


def mart_hourly_demand(fact: DataFrame, dim_date: DataFrame, dim_hour: DataFrame) -> DataFrame:
    """MT2: per pickup date and hour, with date and hour attributes."""
    agg = fact.groupBy("pickup_date_key", "pickup_hour_key").agg(
        _trips(),
        F.sum("passenger_count").alias("total_passengers"),
        *_sums([("total_amount", "total_amount"), ("total_fare_amount", "fare_amount"),
                ("total_tip_amount", "tip_amount")]),
        *_avgs("total_amount", "fare_amount", "tip_amount", "tip_rate",
               "trip_distance", "trip_duration_minutes", "fare_per_mile"),
    )
    measures = [c for c in agg.columns if c not in ("pickup_date_key", "pickup_hour_key")]
    with_date = lookup_after_aggregate(
        agg, dim_date.select("date_key", "date", "year", "month", "day_of_week", "is_weekend"),
        {"pickup_date_key": "date_key"})
    # dim_hour is a 24-row constant relation: its size is fixed by construction.
    with_hour = lookup_after_aggregate(with_date, F.broadcast(dim_hour),
                                       {"pickup_hour_key": "hour_key"})
    return with_hour.select("date_key", "date", "year", "month", "day_of_week", "is_weekend",
                            "hour_key", "hour", "time_period", *measures)


_ZONE_MEASURE_SUMS = [
    ("total_amount", "total_amount"), ("total_fare_amount", "fare_amount"),
    ("total_tip_amount", "tip_amount"), ("total_tolls_amount", "tolls_amount"),
    ("total_congestion_surcharge", "congestion_surcharge"),
    ("total_airport_fee", "airport_fee"),
]


def mart_pickup_zone_performance(fact: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """MT3: per pickup zone."""
    agg = fact.groupBy("pickup_location_id").agg(
        _trips(),
        F.sum("passenger_count").alias("total_passengers"),
        *_sums(_ZONE_MEASURE_SUMS),
        *_avgs("total_amount", "fare_amount", "tip_amount", "tip_rate",
               "trip_distance", "trip_duration_minutes", "fare_per_mile"),
    )
    measures = [c for c in agg.columns if c != "pickup_location_id"]
    zones = dim_zone.select(
        F.col("location_id").alias("pickup_location_id"),
        F.col("borough").alias("pickup_borough"),
        F.col("zone").alias("pickup_zone"),
        F.col("service_zone").alias("pickup_service_zone"))
    joined = lookup_after_aggregate(agg, zones,
                                    {"pickup_location_id": "pickup_location_id"})
    return joined.select("pickup_location_id", "pickup_borough", "pickup_zone",
                         "pickup_service_zone", *measures)


def mart_payment_behavior(fact: DataFrame, dim_payment_type: DataFrame) -> DataFrame:
    """MT4: per payment type of the dimension (types outside it drop out)."""
    agg = fact.groupBy("payment_type_id").agg(
        _trips(),
        F.sum("passenger_count").alias("total_passengers"),
        *_sums([("total_amount", "total_amount"), ("total_fare_amount", "fare_amount"),
                ("total_tip_amount", "tip_amount"), ("total_tolls_amount", "tolls_amount")]),
        *_avgs("total_amount", "fare_amount", "tip_amount", "tip_rate", "fare_per_mile",
               "trip_distance", "trip_duration_minutes"),
    )
    measures = [c for c in agg.columns if c != "payment_type_id"]
    # dim_payment_type is a 4-row constant relation.
    joined = lookup_after_aggregate(agg, F.broadcast(dim_payment_type),
                                    {"payment_type_id": "payment_type_id"})
    return joined.select("payment_type_id", "payment_type_name", "is_standard_payment",
                         *measures)


def airport_trip_type(pickup_zone: Column, dropoff_zone: Column) -> Column:
    """First match wins: both ends, pickup, dropoff, else non-airport."""
    pu = pickup_zone.isin(*AIRPORT_ZONE_NAMES)
    do = dropoff_zone.isin(*AIRPORT_ZONE_NAMES)
    return (F.when(pu & do, "airport_to_airport").when(pu, "airport_pickup")
            .when(do, "airport_dropoff").otherwise("non_airport"))


def mart_airport_trip_summary(fact: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """MT5: trips by the airport roles of their two zones.

    Sums and counts of a pair of zones add up, and an average is the sum of
    the pairs' sums over the sum of their counts, so only pairs (at most the
    square of the number of zones) meet the dimension, never trips.
    """
    averaged = ["total_amount", "fare_amount", "tip_amount", "tip_rate",
                "trip_distance", "trip_duration_minutes", "fare_per_mile"]
    measures = list(dict.fromkeys([src for _, src in _ZONE_MEASURE_SUMS] + averaged))
    pairs = fact.groupBy("pickup_location_id", "dropoff_location_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("passenger_count").alias("passengers"),
        *[F.sum(m).alias(f"s_{m}") for m in measures], *[F.count(m).alias(f"c_{m}") for m in averaged])
    zones = dim_zone.select("location_id", "zone")
    named = lookup_after_aggregate(pairs, zones.select(
        F.col("location_id").alias("_pl"), F.col("zone").alias("pickup_zone")), {"pickup_location_id": "_pl"})
    named = lookup_after_aggregate(named, zones.select(
        F.col("location_id").alias("_dl"), F.col("zone").alias("dropoff_zone")), {"dropoff_location_id": "_dl"})
    return (named.withColumn("airport_trip_type", airport_trip_type(F.col("pickup_zone"), F.col("dropoff_zone")))
            .groupBy("airport_trip_type").agg(
                F.sum("n").alias("total_trips"),
                F.sum("passengers").alias("total_passengers"),
                *[F.sum(f"s_{src}").alias(out) for out, src in _ZONE_MEASURE_SUMS],
                *[F.try_divide(F.sum(f"s_{m}"), F.sum(f"c_{m}")).alias(f"avg_{m}") for m in averaged]))
