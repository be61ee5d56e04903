"""Distinct counts without value sets, plain sums, and mergeable profile state."""

import numpy as np
from pyspark.sql import functions as F

from fareflow.operators import marts, profile as pf, profile_state as ps
from fareflow.plans import layers as L
from fareflow.sources.sinks import write_month_partitions
from fareflow.sources.tables import read_partitioned

from conftest import SF_SMALL


def test_distinct_counts_of_columns_without_a_domain(spark):
    bronze = L.bronze(spark, SF_SMALL).where("year = '1996'")
    wild = bronze.withColumn("PULocationID", F.xxhash64(F.monotonically_increasing_id())).withColumn(
        "RatecodeID", F.when(F.col("VendorID") == 1, F.lit(-0.0)).otherwise(F.lit(0.0)))
    got = pf.summary(wild)
    for r in got.collect():
        month = wild.where(f"month = '{r.month}'")
        want = month.agg(*[F.count_distinct(c) for c, _ in pf.DISTINCT_CHECKS]).first()
        assert [r[n] for _, n in pf.DISTINCT_CHECKS] == list(want)
    assert "collect_set" not in got._jdf.queryExecution().executedPlan().toString()
    empty = wild.withColumn("PULocationID", F.lit(None).cast("long"))
    assert {r.distinct_pickup_location_count for r in pf.summary(empty).collect()} == {0}


def test_small_sums_are_not_rounded_away(spark):
    fact = L.fact_trip(spark, SF_SMALL).limit(1).withColumn("tip_amount", F.lit(0.00001)).withColumn("payment_type_id", F.lit(1))
    from fareflow.operators import dims
    row = marts.mart_payment_behavior(fact, dims.dim_payment_type(spark)).first()
    assert row.total_tip_amount == 0.00001 and row.avg_tip_amount == 0.00001


def test_reports_of_any_months_from_their_sketches(spark, scratch):
    silver = L.silver_table(spark, SF_SMALL)
    write_month_partitions(ps.monthly_state(silver), f"{scratch}/state")
    state = read_partitioned(spark, f"{scratch}/state")
    months = [(1995, m) for m in range(1, 13)] + [(1996, m) for m in range(1, 13)]
    report = ps.merged(state, months=months)
    assert report.count() == 1
    files = ps.merged(state, months=months)
    scan = files._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scan and "silver" not in " ".join(state.inputFiles())
    r = report.first()
    trips = silver.where("year in ('1995', '1996')").toPandas()
    assert (r.months, r.trip_count) == (24, len(trips))
    for m in ps.MEASURES:
        for p in ps.QUANTILES:
            q = r[ps.quantile_name(m, p)]
            below, upto = np.mean(trips[m] < q), np.mean(trips[m] <= q)
            assert below <= p + ps.RANK_ERROR and upto >= p - ps.RANK_ERROR
    for c in ps.CODED:
        exact = trips[c].nunique()
        assert abs(r[f"distinct_{c}"] - exact) <= np.ceil(ps.DISTINCT_ERROR * exact)


def test_a_rewritten_month_replaces_its_row(spark, scratch):
    silver = L.silver_table(spark, SF_SMALL).where("year = '1996'")
    write_month_partitions(ps.monthly_state(silver), f"{scratch}/state")
    write_month_partitions(ps.monthly_state(silver.where("month = '03'").limit(2)), f"{scratch}/state")
    state = read_partitioned(spark, f"{scratch}/state")
    assert state.count() == 12 and ps.merged(state, "month").where("month = '03'").first().trip_count == 2


def test_months_without_a_value(spark):
    silver = L.silver_table(spark, SF_SMALL).where("year = '1996'").withColumn("trip_distance", F.lit(None).cast("double"))
    r = ps.merged(ps.monthly_state(silver)).first()
    assert r.trip_distance_p50 is None and r.trip_duration_minutes_p99 is not None
