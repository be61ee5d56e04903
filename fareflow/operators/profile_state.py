"""Mergeable profile state: one small row of sketches per month (DC1, PF8).

Quantiles and distinct counts do not add up over months, sketches of them do.
``monthly_state`` makes one row per month from one scan of its trips: counts
and extremes, a KLL sketch per measure and an HLL sketch per coded column.
Stored beside the table, any set of months is reported from those rows alone
(``merged``); a month that is rewritten replaces its row.

A KLL sketch answers a quantile with a value whose rank is off by at most
``RANK_ERROR`` of the trips (with 99 % confidence, about three times the
sketch's own standard figure); an HLL estimate is off by at most
``DISTINCT_ERROR``.  Both have a fixed size, however many trips a month has,
and merging does not add to the error.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.operators.months import restrict

MEASURES = ["trip_distance", "trip_duration_minutes"]
CODED = ["pickup_location_id", "dropoff_location_id"]
QUANTILES = [0.5, 0.95, 0.99, 0.999]

KLL_SIZE = 2000
RANK_ERROR = 0.005
HLL_SIZE = 12
DISTINCT_ERROR = 0.05


def monthly_state(silver: DataFrame) -> DataFrame:
    """One row per month: counts, time range, sketches."""
    return silver.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.min("pickup_datetime").alias("min_pickup_datetime"), F.max("pickup_datetime").alias("max_pickup_datetime"),
        *[F.kll_sketch_agg_double(F.col(m).cast("double"), F.lit(KLL_SIZE)).alias(f"{m}_kll") for m in MEASURES],
        *[F.hll_sketch_agg(F.col(c).cast("long"), F.lit(HLL_SIZE)).alias(f"{c}_hll") for c in CODED])


def _quantile(sketch: str, p: float) -> Column:
    """NULL where no trip has a value."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(p)))


def quantile_name(measure: str, p: float) -> str:
    return f"{measure}_p{str(p).split('.')[1].ljust(2, '0')}"


def merged(state: DataFrame, *by: str, months: Iterable[tuple[int, int]] | None = None) -> DataFrame:
    """The profile of the state's months (or of the listed ones), one row per group of ``by``.

    Reads one row a month and no trips.
    """
    rows = state if months is None else restrict(state, months)
    whole = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("months"), F.sum("trip_count").alias("trip_count"),
        F.min("min_pickup_datetime").alias("min_pickup_datetime"), F.max("max_pickup_datetime").alias("max_pickup_datetime"),
        *[F.kll_merge_agg_double(f"{m}_kll").alias(f"{m}_kll") for m in MEASURES],
        *[F.hll_union_agg(f"{c}_hll").alias(f"{c}_hll") for c in CODED])
    return whole.select(
        *by, "months", "trip_count", "min_pickup_datetime", "max_pickup_datetime",
        *[_quantile(f"{m}_kll", p).alias(quantile_name(m, p)) for m in MEASURES for p in QUANTILES],
        *[F.hll_sketch_estimate(f"{c}_hll").alias(f"distinct_{c}") for c in CODED])


def verified(report: DataFrame, silver: DataFrame, by: str) -> DataFrame:
    """Whether a report's estimates lie within their stated errors of the trips.

    The trips are scanned again for it: the share of trips below and up to
    each estimate has to enclose the asked share, give or take the error.
    """
    joined = silver.join(F.broadcast(report.drop("trip_count", "min_pickup_datetime", "max_pickup_datetime")), by)
    n = lambda c: F.count(F.when(c, 1))
    checks = []
    for m in MEASURES:
        ok = []
        for p in QUANTILES:
            q = F.col(quantile_name(m, p))
            ok += [n(F.col(m) < q) <= (p + RANK_ERROR) * F.count(m), n(F.col(m) <= q) >= (p - RANK_ERROR) * F.count(m)]
        checks.append(reduce(lambda a, b: a & b, ok).alias(f"{m}_within_error"))
    for c in CODED:
        exact = F.count_distinct(c)
        checks.append((F.abs(F.first(f"distinct_{c}") - exact) <= F.ceil(DISTINCT_ERROR * exact)).alias(f"{c}_within_error"))
    checked = joined.groupBy(by).agg(*checks)
    return report.select(by, "months", "trip_count", "min_pickup_datetime", "max_pickup_datetime").join(checked, by)
