"""Invariants across layers, and layer counts against the independent SQL."""

import pytest
from pyspark.sql import functions as F

from fareflow.operators import dims, fact as fact_ops, marts, profile as pf, silver as sv
from fareflow.plans import layers as L

from conftest import SF_SMALL

FLAGS = ["is_invalid_vendor", "is_invalid_payment_type_domain", "is_invalid_ratecode",
         "is_invalid_store_and_fwd_flag", "is_pickup_location_out_of_range",
         "is_dropoff_location_out_of_range", "is_very_long_distance", "is_very_long_duration",
         "same_pickup_dropoff_zone", "is_extreme_speed", "is_fare_distance_mismatch",
         "is_distance_duration_mismatch", "is_same_zone_high_fare"]


@pytest.fixture(scope="module")
def expected():
    """The same counts from the independent SQL."""
    from oracle.sql import with_gold
    from oracle_compare import duck
    flags = ", ".join(f"count(*) FILTER (WHERE {f}) AS {f}" for f in FLAGS)
    sql = with_gold(f"""
SELECT (SELECT count(*) FROM bronze) AS bronze, count(*) AS silver, {flags},
  count(*) FILTER (WHERE is_analytical_outlier) AS outlier_true,
  count(*) FILTER (WHERE is_analytical_outlier IS NULL) AS outlier_null,
  count(*) FILTER (WHERE extra < 0) AS extra_negative,
  (SELECT count(*) FROM dim_date) AS mt1_dates,
  CAST(sum(CAST(total_amount AS DECIMAL(18,4))) AS VARCHAR) AS total
FROM silver""")
    got = duck(SF_SMALL).execute(sql)
    return dict(zip([d[0] for d in got.description], got.fetchone()))


@pytest.fixture(scope="module")
def layers(spark):
    bronze = L.bronze(spark, SF_SMALL)
    silver = L.silver(spark, SF_SMALL)
    return bronze, silver


def test_fixture_counts(spark, layers, expected):
    bronze, silver = layers
    assert bronze.count() == expected["bronze"]
    got = silver.agg(
        F.count(F.lit(1)).alias("silver"), *[F.count(F.when(F.col(f), 1)).alias(f) for f in FLAGS],
        F.count(F.when(F.col("is_analytical_outlier"), 1)).alias("outlier_true"),
        F.count(F.when(F.col("is_analytical_outlier").isNull(), 1)).alias("outlier_null"),
        F.count(F.when(F.col("extra") < 0, 1)).alias("extra_negative"),
        F.sum(F.col("total_amount").cast("decimal(18,4)")).cast("string").alias("total")).first().asDict()
    assert got == {k: expected[k] for k in got}
    assert all(got[f] > 0 for f in FLAGS)


def test_every_rule_and_check_can_fail(layers):
    bronze, _ = layers
    row = sv.rule_failure_counts(bronze).drop("year", "month").groupBy().sum().first()
    assert min(row) > 0 and len(row) == 16
    warned = pf.warning_quality(bronze).drop("year", "month").groupBy().sum().first()
    assert min(warned) > 0


def test_silver_plus_rejected_is_bronze(layers, expected):
    bronze, silver = layers
    assert silver.count() + sv.rejected(bronze).count() == bronze.count()
    rc = sv.reconcile(bronze).agg(F.sum("bronze_count"), F.sum("silver_count"),
                                  F.sum("dropped_count")).first()
    n, k = expected["bronze"], expected["silver"]
    assert tuple(rc) == (n, k, n - k)


def test_mart_totals_equal_fact_rows(spark, layers, expected):
    _, silver = layers
    fact = fact_ops.fact_trip(silver)
    n = fact.count()
    assert n == silver.count() - silver.filter("is_analytical_outlier").count()
    mt1 = marts.mart_daily_trip_revenue(fact, dims.dim_date(silver))
    assert mt1.count() == expected["mt1_dates"]
    assert mt1.agg(F.sum("total_trips")).first()[0] == n
    mt5 = marts.mart_airport_trip_summary(fact, L.dim_zone(spark, SF_SMALL))
    in_range = fact.filter(F.col("pickup_location_id").between(1, 265)
                           & F.col("dropoff_location_id").between(1, 265)).count()
    assert mt5.agg(F.sum("total_trips")).first()[0] == in_range


def test_distributions_sum_to_rows(layers, expected):
    bronze, _ = layers
    n = expected["bronze"]
    for c in pf.DISTRIBUTION_COLUMNS:
        assert pf.distribution(bronze, c).agg(F.sum("total_rows")).first()[0] == n
    assert pf.distributions(bronze).agg(F.sum("total_rows")).first()[0] == 4 * n


def test_quantile_profile_is_ordered(layers):
    _, silver = layers
    for r in pf.distribution_profile(silver).collect():
        assert r.trip_distance_p50 <= r.trip_distance_p95 <= r.trip_distance_p99 <= r.trip_distance_p999
        assert (r.trip_duration_minutes_p95 <= r.trip_duration_minutes_p99
                <= r.trip_duration_minutes_p999)


def test_trip_key_is_stable_hex(layers):
    _, silver = layers
    fact = fact_ops.fact_trip(silver)
    bad = fact.filter(~F.col("trip_id").rlike("^[0-9A-F]{32}$")).count()
    assert bad == 0
