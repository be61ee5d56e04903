"""Writes by month: no sort, no wide shuffle, the same rows."""

import uuid

import pytest
from pyspark.sql import functions as F

from fareflow.sources import fixture, landing
from fareflow.sources.sinks import write_month_partitions, write_partitioned_table, write_split_months

from conftest import SF_SMALL

SETTING = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture()
def rows(spark):
    return spark.range(5_000).select(
        "id", (1990 + F.col("id") % 20).cast("string").alias("year"), F.lpad((1 + F.col("id") % 12).cast("string"), 2, "0").alias("month"))


def split_write(rows, base):
    outcome = F.when(F.col("id") % 9 == 0, "rejected").otherwise("accepted").alias("outcome")
    months = [(int(r.year), int(r.month)) for r in rows.select("year", "month").distinct().collect()]
    return write_split_months(rows.select("id", outcome, "year", "month"), {"accepted": base, "rejected": f"{base}_no"}, months)


@pytest.mark.parametrize("write", [
    write_month_partitions, write_partitioned_table, split_write,
    lambda rows, base: landing.land_bronze(rows.sparkSession, SF_SMALL, base)])
def test_a_write_by_month_sorts_nothing(spark, rows, scratch, write):
    spark.conf.unset(SETTING)
    write(rows, f"{scratch}/out")
    table = f"t{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {table} (id long, year string, month string) USING parquet "
              f"PARTITIONED BY (year, month) LOCATION '{scratch}/{table}'")
    rows.createOrReplaceTempView(f"v{table}")
    plan = spark.sql(f"EXPLAIN INSERT OVERWRITE {table} SELECT * FROM v{table}").first()[0]
    spark.sql(f"DROP TABLE {table}")
    assert "InsertIntoHadoopFsRelation" in plan and "Sort [" not in plan


def test_more_months_than_open_files(spark, rows, scratch):
    """60 months and two outcomes in one task: 120 files where 64 may be open at a time."""
    counts = split_write(rows.coalesce(1), f"{scratch}/s")
    assert sum(counts.values()) == 5_000 and len(counts) > 64
    back = spark.read.parquet(f"{scratch}/s").unionByName(spark.read.parquet(f"{scratch}/s_no"))
    assert back.select("id", "year", "month").exceptAll(rows).count() == 0 and back.count() == 5_000


def test_landing_shuffles_what_a_trip_is_derived_from(spark):
    """The trips' own columns are derived after the exchange."""
    for part in landing.landing_parts(spark, SF_SMALL):
        plan = part._jdf.queryExecution().executedPlan().toString()
        above, exchange, below = plan.partition("Exchange hashpartitioning(year")
        assert exchange and "tpep_pickup_datetime" in above and "tpep_pickup_datetime" not in below


def test_landing_parts_hold_every_row(spark):
    want = fixture.read_fixture_bronze(spark, SF_SMALL).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("total_amount").cast("decimal(20,4)")).alias("s"))
    got = None
    for part in landing.landing_parts(spark, SF_SMALL):
        one = part.groupBy("year", "month").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("total_amount").cast("decimal(20,4)")).alias("s"))
        got = one if got is None else got.unionByName(one)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
