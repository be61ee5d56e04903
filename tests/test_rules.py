"""Row rules and flags on hand-made rows, at their boundaries."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fareflow.operators.silver import rejected, to_silver
from fareflow.sources.bronze import BRONZE_TYPES, normalize_schema
from fareflow.schema import BRONZE_COLUMNS, SILVER_COLUMNS

T0 = datetime(2024, 1, 15, 10, 0, 0)


def trip(**over):
    row = {
        "VendorID": 1, "tpep_pickup_datetime": T0,
        "tpep_dropoff_datetime": T0 + timedelta(minutes=30), "passenger_count": 1.0,
        "trip_distance": 5.0, "RatecodeID": 1.0, "store_and_fwd_flag": "N",
        "PULocationID": 10, "DOLocationID": 20, "payment_type": 1, "fare_amount": 20.0,
        "extra": 1.0, "mta_tax": 0.5, "tip_amount": 3.0, "tolls_amount": 0.0,
        "improvement_surcharge": 0.3, "total_amount": 25.0, "congestion_surcharge": 2.5,
        "airport_fee": 0.0, "year": "2024", "month": "01",
    }
    row.update(over)
    return row


def frame(spark, rows):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(c, BRONZE_TYPES[c]) for c in BRONZE_COLUMNS]
                          + [T.StructField("year", T.StringType()),
                             T.StructField("month", T.StringType())])
    data = [tuple(r[c] for c in BRONZE_COLUMNS + ["year", "month"]) for r in rows]
    return spark.createDataFrame(data, schema)


def silver_rows(spark, *rows):
    return to_silver(frame(spark, list(rows))).collect()


def test_silver_schema_is_fixed(spark):
    out = to_silver(frame(spark, [trip()]))
    assert [(f.name, f.dataType) for f in out.schema.fields] == SILVER_COLUMNS


@pytest.mark.parametrize("over", [
    {"tpep_pickup_datetime": None},
    {"tpep_dropoff_datetime": None},
    {"tpep_dropoff_datetime": T0},                       # equal: not strictly after
    {"tpep_pickup_datetime": datetime(2023, 12, 31, 23, 59, 59),
     "tpep_dropoff_datetime": datetime(2024, 1, 1, 0, 10)},  # before the month
    {"tpep_pickup_datetime": datetime(2024, 2, 1, 0, 0, 0),
     "tpep_dropoff_datetime": datetime(2024, 2, 1, 0, 5)},  # next month start
    {"trip_distance": None}, {"trip_distance": 0.0},
    {"passenger_count": None}, {"passenger_count": 0.0},
    {"fare_amount": None}, {"fare_amount": -0.01},
    {"total_amount": None}, {"total_amount": -1.0},
    {"PULocationID": None}, {"DOLocationID": None}, {"payment_type": None},
])
def test_critical_rules_reject(spark, over):
    assert silver_rows(spark, trip(**over)) == []
    rej = rejected(frame(spark, [trip(**over)])).collect()
    assert len(rej) == 1 and rej[0]["failed_rule_count"] >= 1


@pytest.mark.parametrize("over", [
    {"fare_amount": 0.0}, {"total_amount": 0.0},
    {"tpep_pickup_datetime": datetime(2024, 1, 1, 0, 0, 0),
     "tpep_dropoff_datetime": datetime(2024, 1, 1, 0, 1, 0)},  # month start is inside
    {"payment_type": 0},  # code keeps payment 0 (only the documented option drops it)
])
def test_critical_rules_keep(spark, over):
    assert len(silver_rows(spark, trip(**over))) == 1


def test_month_window_rolls_december(spark):
    late = trip(tpep_pickup_datetime=datetime(2023, 12, 31, 23, 0),
                tpep_dropoff_datetime=datetime(2024, 1, 1, 0, 30), year="2023", month="12")
    assert len(silver_rows(spark, late)) == 1


def test_derived_columns(spark):
    r = silver_rows(spark, trip())[0]
    assert r.trip_duration_minutes == 30.0
    assert r.pickup_date.isoformat() == "2024-01-15" and r.pickup_hour == 10
    assert r.pickup_day_of_week == "Monday"
    assert r.fare_per_mile == 4.0 and r.tip_rate == 0.15
    assert r.avg_speed_mph == 10.0 and r.fare_per_minute == 20.0 / 30.0
    assert r.year == "2024" and r.month == "01"


def test_sub_second_trip_gives_null_outlier(spark):
    # T6: duration 0 -> speed NULL -> extreme-speed NULL -> outlier NULL
    r = silver_rows(spark, trip(tpep_dropoff_datetime=T0 + timedelta(milliseconds=500)))[0]
    assert r.trip_duration_minutes == 0.0
    assert r.avg_speed_mph is None and r.fare_per_minute is None
    assert r.is_extreme_speed is None and r.is_analytical_outlier is None


def test_zero_fare_tip_rate_null(spark):
    assert silver_rows(spark, trip(fare_amount=0.0))[0].tip_rate is None


@pytest.mark.parametrize("over,flag,expected", [
    ({"VendorID": 6}, "is_invalid_vendor", True),
    ({"VendorID": None}, "is_invalid_vendor", False),
    ({"payment_type": 0}, "is_invalid_payment_type_domain", True),
    ({"payment_type": 6}, "is_invalid_payment_type_domain", False),
    ({"RatecodeID": 99.0}, "is_invalid_ratecode", False),
    ({"RatecodeID": 7.0}, "is_invalid_ratecode", True),
    ({"store_and_fwd_flag": "X"}, "is_invalid_store_and_fwd_flag", True),
    ({"store_and_fwd_flag": None}, "is_invalid_store_and_fwd_flag", False),
    ({"extra": -1.0}, "has_negative_fee_component", True),
    ({"extra": None}, "has_negative_fee_component", False),
    ({"PULocationID": 265}, "is_pickup_location_out_of_range", False),
    ({"PULocationID": 266}, "is_pickup_location_out_of_range", True),
    ({"DOLocationID": 0}, "is_dropoff_location_out_of_range", True),
    ({"trip_distance": 100.0}, "is_very_long_distance", False),
    ({"trip_distance": 100.01, "tpep_dropoff_datetime": T0 + timedelta(hours=3)},
     "is_very_long_distance", True),
    ({"tpep_dropoff_datetime": T0 + timedelta(minutes=1441)}, "is_very_long_duration", True),
    ({"tpep_dropoff_datetime": T0 + timedelta(minutes=1440)}, "is_very_long_duration", False),
])
def test_warning_flags(spark, over, flag, expected):
    r = silver_rows(spark, trip(**over))[0]
    assert r[flag] is expected
    if expected:
        assert r.has_warning_quality_issue is True


@pytest.mark.parametrize("over,flag,expected", [
    # 120 mph exactly is not extreme; just above is
    ({"trip_distance": 60.0}, "is_extreme_speed", False),
    ({"trip_distance": 60.1}, "is_extreme_speed", True),
    ({"trip_distance": 0.09, "fare_amount": 100.01, "total_amount": 101.0},
     "is_fare_distance_mismatch", True),
    ({"trip_distance": 0.1, "fare_amount": 150.0, "total_amount": 151.0},
     "is_fare_distance_mismatch", False),
    ({"trip_distance": 0.09, "fare_amount": 100.0}, "is_fare_distance_mismatch", False),
    ({"trip_distance": 101.0, "tpep_dropoff_datetime": T0 + timedelta(minutes=89)},
     "is_distance_duration_mismatch", True),
    ({"DOLocationID": 10, "trip_distance": 0.05, "fare_amount": 150.0, "total_amount": 151.0},
     "is_same_zone_high_fare", True),
])
def test_outlier_flags(spark, over, flag, expected):
    r = silver_rows(spark, trip(**over))[0]
    assert r[flag] is expected
    if expected:
        assert r.is_analytical_outlier is True


def test_same_zone_is_not_an_outlier_by_itself(spark):
    r = silver_rows(spark, trip(DOLocationID=10))[0]
    assert r.same_pickup_dropoff_zone is True and r.is_analytical_outlier is False


def test_fees_filled_with_zero(spark):
    r = silver_rows(spark, trip(extra=None, tip_amount=None, airport_fee=None))[0]
    assert (r.extra, r.tip_amount, r.airport_fee) == (0.0, 0.0, 0.0)


def test_casts_truncate(spark):
    r = silver_rows(spark, trip(passenger_count=1.7, RatecodeID=2.0))[0]
    assert r.passenger_count == 1 and r.ratecode_id == 2


def test_strict_payment_option(spark):
    df = frame(spark, [trip(payment_type=5), trip()])
    assert to_silver(df).count() == 2
    assert to_silver(df, strict_payment_domain=True).count() == 1


def test_normalize_keeps_case_drifted_values(spark):
    # T1: a column named 'Extra' keeps its values
    df = frame(spark, [trip(extra=4.0)]).withColumnRenamed("extra", "Extra")
    out = normalize_schema(df, keep=("year", "month"))
    assert out.select("extra").first()[0] == 4.0


def test_normalize_adds_missing_defaults(spark):
    df = frame(spark, [trip()]).drop("airport_fee", "congestion_surcharge", "store_and_fwd_flag")
    out = normalize_schema(df, keep=("year", "month")).first()
    assert out.airport_fee == 0.0 and out.congestion_surcharge == 0.0
    assert out.store_and_fwd_flag is None


def test_normalize_requires_core_columns(spark):
    df = frame(spark, [trip()]).drop("fare_amount")
    with pytest.raises(ValueError):
        normalize_schema(df)


def test_flags_use_no_python(spark):
    plan = to_silver(frame(spark, [trip()]))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert F is not None
