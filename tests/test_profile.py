"""Profiling semantics on hand-made rows."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from fareflow.functions.expressions import minute_boundaries_between
from fareflow.operators import profile as pf

from test_rules import frame, trip

T = datetime(2024, 1, 10, 10, 0, 59)


def test_minute_boundaries_count_boundaries_not_minutes(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 59), datetime(2024, 1, 1, 0, 1, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(minute_boundaries_between("a", "b")).first()[0] == 1


def test_warning_duration_uses_boundaries(spark):
    rows = [trip(tpep_pickup_datetime=T, tpep_dropoff_datetime=T + timedelta(minutes=1440, seconds=2)),
            trip(tpep_pickup_datetime=T - timedelta(seconds=29),
                 tpep_dropoff_datetime=T - timedelta(seconds=29) + timedelta(minutes=1440))]
    r = pf.warning_quality(frame(spark, rows)).first()
    assert r.very_long_duration_count == 1


def test_critical_counts_have_no_month_window_and_count_nulls(spark):
    rows = [trip(tpep_pickup_datetime=datetime(2023, 5, 1), tpep_dropoff_datetime=datetime(2023, 5, 1, 1)),
            trip(trip_distance=None, passenger_count=0.0),
            trip(payment_type=None)]
    r = pf.critical_quality(frame(spark, rows)).first()
    assert r.total_rows == 3 and r.invalid_datetime_count == 0
    assert r.invalid_distance_count == 1 and r.invalid_passenger_count == 1
    assert r.null_payment_type_count == 1


def test_distribution_keeps_null_group(spark):
    rows = [trip(payment_type=None), trip(payment_type=1), trip(payment_type=1)]
    got = {r.payment_type: r.total_rows for r in pf.distribution(frame(spark, rows), "payment_type").collect()}
    assert got == {None: 1, 1: 2}


def test_monthly_summary_adds_every_counter(spark):
    # one row failing two critical rules and one warning rule
    rows = [trip(trip_distance=0.0, fare_amount=-1.0, VendorID=7), trip()]
    r = pf.monthly_summary(frame(spark, rows)).first()
    assert (r.period, r.year, r.month, r.total_rows) == ("2024-01", 2024, 1, 2)
    assert r.critical_issue_count == 2 and r.warning_issue_count == 1


def test_quality_gate(spark):
    rows = [trip(trip_distance=0.0)] + [trip() for _ in range(9)]
    r = pf.quality_gate(frame(spark, rows), max_critical_ratio=0.1).first()
    assert r.critical_issue_ratio == 0.1 and r.gate == "passed"
    r = pf.quality_gate(frame(spark, rows), max_critical_ratio=0.05).first()
    assert r.gate == "failed"


def test_summary_distinct_counts_exact_and_approximate(spark):
    rows = [trip(PULocationID=i % 7 + 1) for i in range(30)]
    exact = pf.summary(frame(spark, rows)).first()
    approx = pf.summary(frame(spark, rows), approximate=True).first()
    assert exact.distinct_pickup_location_count == 7
    assert abs(approx.distinct_pickup_location_count - 7) <= 1
    assert exact.avg_fare_amount == 20.0


def test_sums_and_averages_lose_nothing(spark):
    import math
    from fareflow.functions.expressions import reported_mean, reported_sum
    one = lambda vals: spark.createDataFrame([(v,) for v in vals], "x double").repartition(3).agg(
        reported_sum("x"), reported_mean("x")).first()
    assert one([5e13, 1.0])[0] == 50_000_000_000_001.0
    assert math.isnan(one([1.0, float("nan")])[0]) and math.isnan(one([1.0, float("nan")])[1])
    assert tuple(one([None])) == (None, None)
    assert one([0.1, 0.2, 0.3] * 50)[0] == 30.0
    assert one([1e15, 1e15])[0] == 2e15


def test_trip_key_tells_close_and_huge_amounts_apart(spark):
    from fareflow.functions.expressions import canonical_text
    rows = [(1.00001,), (1.00002,), (1e15,), (1e30,), (float("nan"),), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "x double").select(canonical_text("x", "double")).collect()]
    assert len(set(got)) == 6 and got[0] == "1.0000100000" and got[-1] == ""
    ts = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00.000001' a, timestamp_ntz'2024-01-01 00:00:00.000002' b")
    a, b = ts.select(canonical_text("a", "timestamp"), canonical_text("b", "timestamp")).first()
    assert a != b
