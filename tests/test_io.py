"""Sources, sinks and batch scope: drift reads, month overwrite, skip rule,
month lists, coverage and completeness checks, the Gold build."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fareflow.operators import months as bm
from fareflow.plans.gold_build import build_gold, test_gold as run_gold_tests
from fareflow.plans.silver_job import run_silver_job
from fareflow.sources.bronze import month_path, read_bronze_months
from fareflow.sources.sinks import write_month_partitions
from fareflow.sources.tables import read_partitioned
from fareflow.sources.zones import read_zone_lookup

from conftest import SF_SMALL


def _raw_month(spark, year, month, n, variant):
    """A raw Bronze month file in one of the drift variants."""
    base = datetime(year, month, 2, 8, 0)
    rows = []
    for i in range(n):
        pu = base + timedelta(minutes=7 * i)
        rows.append({
            "VendorID": 1 + i % 2, "tpep_pickup_datetime": pu,
            "tpep_dropoff_datetime": pu + timedelta(minutes=12),
            "passenger_count": 1 + i % 3, "trip_distance": 1.5 + i,
            "RatecodeID": 1, "store_and_fwd_flag": "N", "PULocationID": 1 + i % 265,
            "DOLocationID": 2 + i % 200, "payment_type": 1 + i % 4,
            "fare_amount": 10.0 + i, "extra": 1.0, "mta_tax": 0.5, "tip_amount": 2.0,
            "tolls_amount": 0.0, "improvement_surcharge": 0.3, "total_amount": 14.0 + i,
            "congestion_surcharge": 2.5, "airport_fee": 0.0,
        })
    df = spark.createDataFrame(rows)
    if variant == "capital_airport_fee":
        df = df.withColumnRenamed("airport_fee", "Airport_fee")
    elif variant == "missing_columns":
        df = df.drop("airport_fee", "congestion_surcharge", "store_and_fwd_flag")
    elif variant == "double_counts":
        df = (df.withColumn("passenger_count", F.col("passenger_count").cast("double"))
              .withColumn("RatecodeID", F.col("RatecodeID").cast("double")))
    return df


def land(spark, base, months):
    for (y, m), variant, n in months:
        _raw_month(spark, y, m, n, variant).coalesce(1).write.mode("overwrite").parquet(
            month_path(base, y, m))


DRIFT = [((2019, 1), "double_counts", 40), ((2020, 3), "missing_columns", 30),
         ((2024, 1), "capital_airport_fee", 50)]


def test_read_months_across_drift(spark, scratch):
    base = f"{scratch}/bronze"
    land(spark, base, DRIFT)
    df = read_bronze_months(spark, base, [(2019, 1), (2020, 3), (2024, 1)])
    counts = {(r.year, r.month): r["count"] for r in df.groupBy("year", "month").count().collect()}
    assert counts == {("2019", "01"): 40, ("2020", "03"): 30, ("2024", "01"): 50}
    lacking = df.filter("year = '2020'").agg(F.min("airport_fee"), F.max("airport_fee"), F.count("airport_fee"),
                                             F.count("store_and_fwd_flag")).first()
    assert tuple(lacking) == (0.0, 0.0, 30, 0)


@pytest.mark.parametrize("order", [[2019, 2020, 2021], [2021, 2020, 2019], [2020, 2019, 2021]])
def test_no_month_decides_the_columns_of_another(spark, scratch, order):
    from fareflow.sources.bronze import read_bronze_table
    base = f"{scratch}/bronze"
    for y in order:
        raw = _raw_month(spark, y, 1, 3, "plain").withColumn("airport_fee", F.lit(1.25))
        (raw if y == 2020 else raw.drop("airport_fee")).write.parquet(month_path(base, y, 1))
    for df in (read_bronze_table(spark, base), read_bronze_months(spark, base, [(y, 1) for y in order])):
        assert dict(df.groupBy("year").agg(F.sum("airport_fee")).collect()) == {"2019": 0.0, "2020": 3.75, "2021": 0.0}


def test_months_of_conflicting_types_are_read_together(spark, scratch):
    base = f"{scratch}/bronze"
    land(spark, base, DRIFT)
    # force a real type conflict: a month with passenger_count as string
    (_raw_month(spark, 2021, 1, 10, "plain")
     .withColumn("passenger_count", F.col("passenger_count").cast("string"))
     .write.mode("overwrite").parquet(month_path(base, 2021, 1)))
    df = read_bronze_months(spark, base, [(2019, 1), (2021, 1)])
    assert df.count() == 50


def test_silver_job_overwrites_one_month_and_skips_done(spark, scratch):
    bronze, silver = f"{scratch}/bronze", f"{scratch}/silver"
    land(spark, bronze, DRIFT)
    summary = run_silver_job(spark, bronze, silver, [(2019, 1), (2020, 3)]).collect()
    assert {r.status for r in summary} == {"written"}
    assert {r.period: (r.bronze_count, r.silver_count, r.dropped_count) for r in summary} == {
        "2019-01": (40, 40, 0), "2020-03": (30, 30, 0)}
    # second run skips both, third run (force) rewrites only 2019-01
    again = run_silver_job(spark, bronze, silver, [(2019, 1), (2020, 3)]).collect()
    assert {r.status for r in again} == {"skipped"}
    import os
    other = sorted(os.listdir(month_path(silver, 2020, 3).replace("file:", "")))
    run_silver_job(spark, bronze, silver, [(2019, 1)], force=True).collect()
    assert sorted(os.listdir(month_path(silver, 2020, 3))) == other
    table = read_partitioned(spark, silver)
    assert table.count() == 70
    assert dict(table.groupBy("month").count().collect()) == {"01": 40, "03": 30}


def test_a_month_that_becomes_empty_loses_its_rows_and_is_done(spark, scratch):
    bronze, silver = f"{scratch}/bronze", f"{scratch}/silver"
    land(spark, bronze, DRIFT)
    run_silver_job(spark, bronze, silver, [(2019, 1), (2020, 3)]).collect()
    (_raw_month(spark, 2020, 3, 30, "plain").withColumn("trip_distance", F.lit(0.0))
     .write.mode("overwrite").parquet(month_path(bronze, 2020, 3)))
    again = run_silver_job(spark, bronze, silver, [(2020, 3)], force=True).first()
    assert (again.status, again.bronze_count, again.silver_count, again.dropped_count) == ("written", 30, 0, 30)
    table = read_partitioned(spark, silver)
    assert table.count() == 40 and table.filter("year = '2020'").count() == 0
    months = bm.months_frame(spark, [(2019, 1), (2020, 3), (2024, 1)])
    assert [r.period for r in bm.pending_months(spark, months, silver).collect()] == ["2024-01"]


def test_a_months_frame_reads_only_its_files(spark, scratch):
    path = f"{scratch}/t"
    df = spark.createDataFrame([(i, "2024", f"{m:02d}") for i, m in enumerate(range(1, 13))],
                               "v int, year string, month string")
    write_month_partitions(df, path)
    q = bm.restrict(read_partitioned(spark, path), bm.months_frame(spark, [(2024, 5)]))
    assert [r.v for r in q.collect()] == [4]
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert len({f for f in q.inputFiles()}) == 12 and q.select(F.input_file_name().alias("f")).distinct().count() == 1


def test_dynamic_overwrite_replaces_only_present_months(spark, scratch):
    path = f"{scratch}/t"
    df = spark.createDataFrame([(1, "2024", "01"), (2, "2024", "02")], "v int, year string, month string")
    write_month_partitions(df, path)
    write_month_partitions(spark.createDataFrame([(9, "2024", "02")], df.schema), path)
    got = sorted(tuple(r) for r in read_partitioned(spark, path).select("v", "year", "month").collect())
    assert got == [(1, "2024", "01"), (9, "2024", "02")]


def test_partition_filter_prunes(spark, scratch):
    path = f"{scratch}/t"
    df = spark.createDataFrame([(i, "2024", f"{m:02d}") for i, m in enumerate(range(1, 13))],
                               "v int, year string, month string")
    write_month_partitions(df, path)
    q = bm.restrict(read_partitioned(spark, path), [(2024, 1), (2024, 3)])
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert sorted(r.month for r in q.collect()) == ["01", "03"]


def test_month_list_parsing(spark, scratch):
    p = f"{scratch}/months.txt"
    with open(p, "w") as f:
        f.write("# recovery sample\n2019-01\n\n  2020-03  # trailing comment\n2019-01\n")
    got = [(r.period, r.year, r.month) for r in bm.read_month_list(spark, p).orderBy("line_no").collect()]
    assert got == [("2019-01", "2019", "01"), ("2020-03", "2020", "03"), ("2019-01", "2019", "01")]
    with open(p, "a") as f:
        f.write("2020-13\n")
    with pytest.raises(ValueError):
        bm.read_month_list(spark, p)
    with pytest.raises(FileNotFoundError):
        bm.read_month_list(spark, f"{scratch}/nope.txt")


def test_choose_scope(spark, scratch):
    p = f"{scratch}/months.txt"
    with open(p, "w") as f:
        f.write("2021-01\n2022-01\n")
    scope = bm.choose_scope(spark, year_months=["2019-01"], months_file=p)
    assert [r.period for r in scope.orderBy("line_no").collect()] == ["2019-01", "2021-01", "2022-01"]
    assert [r.period for r in bm.choose_scope(spark, year=2024, month=1).collect()] == ["2024-01"]
    with pytest.raises(ValueError):
        bm.choose_scope(spark)
    with pytest.raises(ValueError):
        bm.choose_scope(spark, year_months=["2024-1"])


def test_month_window(spark):
    assert bm.month_window(spark, 2024, 12) == (datetime(2024, 12, 1), datetime(2025, 1, 1))
    assert bm.month_window(spark, 2024, 1) == (datetime(2024, 1, 1), datetime(2024, 2, 1))


def test_coverage_and_pending(spark, scratch):
    bronze, silver = f"{scratch}/bronze", f"{scratch}/silver"
    land(spark, bronze, DRIFT)
    run_silver_job(spark, bronze, silver, [(2019, 1)]).collect()
    months = bm.months_frame(spark, [(2019, 1), (2020, 3)])
    cov = {r.period: (r.trip_count, r.validation)
           for r in bm.partition_coverage(months, read_partitioned(spark, silver)).collect()}
    assert cov == {"2019-01": (40, "passed"), "2020-03": (0, "failed")}
    pending = [r.period for r in bm.pending_months(spark, months, silver).collect()]
    assert pending == ["2020-03"]
    assert bm.pending_months(spark, months, silver, force=True).count() == 2


def test_gold_build_and_default_tests(spark, scratch):
    from fareflow.plans import layers as L
    from fareflow.sources import landing
    silver = L.silver(spark, SF_SMALL)
    zones = read_zone_lookup(spark, landing.zone_csv(spark, SF_SMALL))
    paths = build_gold(spark, silver, zones, f"{scratch}/gold")
    assert spark.read.parquet(paths["fact_trip"]).count() == L.fact_trip(spark, SF_SMALL).count()
    results = run_gold_tests(spark, paths).collect()
    assert results and all(r.passed for r in results), [r for r in results if not r.passed]
    from fareflow.operators import checks
    some = {n: spark.read.parquet(p) for n, p in paths.items() if n != "dim_vendor"}
    absent = [r for r in checks.run_assertions(spark, some).collect() if r.failures is None]
    assert absent and not any(r.passed for r in absent)
    assert "dim_vendor" in {r.model for r in absent} and "fact_trip" in {r.model for r in absent}
    months = L.bronze(spark, SF_SMALL).select("year", "month").distinct().select(
        F.lit(0).cast("long").alias("line_no"),
        F.concat_ws("-", "year", "month").alias("period"), "year", "month")
    complete = bm.gold_completeness(spark, paths, months).collect()
    assert all(r.passed for r in complete)
    missing = bm.gold_completeness(spark, {**paths, "dim_x": f"{scratch}/none"}, months).collect()
    assert not all(r.passed for r in missing)


def test_case_only_drift_keeps_values(spark, scratch):
    base = f"{scratch}/bronze"
    (_raw_month(spark, 2023, 1, 10, "plain").withColumn("airport_fee", F.lit(1.25))
     .write.parquet(month_path(base, 2023, 1)))
    (_raw_month(spark, 2024, 1, 10, "capital_airport_fee").withColumn("Airport_fee", F.lit(1.75))
     .write.parquet(month_path(base, 2024, 1)))
    df = read_bronze_months(spark, base, [(2023, 1), (2024, 1)])
    got = dict(df.groupBy("year").agg(F.max("airport_fee")).collect())
    assert got == {"2023": 1.25, "2024": 1.75}
