"""Two-pass uniqueness against plain grouping, and what reaches its exact shuffle."""

import os

import pytest
from pyspark.sql import functions as F

from fareflow.operators import checks, unique
from fareflow.session import checkpoint_dir


@pytest.fixture(scope="module")
def keyed(spark):
    """50,000 keys once, 40 twice, one 20,000 times, some nulls."""
    key = F.upper(F.md5(F.col("id").cast("string"))).alias("trip_id")
    once = spark.range(50_000).select(key)
    twice = spark.range(100, 140).select(key)
    hot = spark.range(20_000).select(F.lit("F" * 32).alias("trip_id"))
    none = spark.range(300).select(F.lit(None).cast("string").alias("trip_id"))
    return once.union(twice).union(hot).union(none).repartition(8)


def folders(spark):
    base = f"{checkpoint_dir(spark).removeprefix('file:')}/fareflow/unique"
    return set(os.listdir(base)) if os.path.isdir(base) else set()


@pytest.mark.parametrize("bound", [1_000_000, 41, 40, 0])
def test_same_duplicates_with_and_without_the_broadcast(spark, keyed, bound):
    found, _ = unique.duplicates(keyed, "trip_id", bound)
    got = {r.value: r.n for r in found.collect()}
    want = {r.value: r.n for r in unique.repeated_values(keyed, "trip_id").collect()}
    assert got == want and len(got) == 41 and got["F" * 32] == 20_000
    before = folders(spark)
    assert unique.count_duplicates(keyed, "trip_id", bound) == 41
    assert folders(spark) == before


def test_only_possible_duplicates_meet_the_exact_grouping(keyed):
    hashes = unique.repeated_hashes(keyed, "trip_id")
    assert hashes.count() == 41
    assert unique.suspects(keyed, "trip_id", hashes).count() == 20_000 + 2 * 40


def test_shared_hashes_are_told_apart(spark, keyed):
    """A hash that is reported without a repeated value changes nothing."""
    every = keyed.select(F.xxhash64("trip_id").alias("hash")).distinct()
    rows = unique.suspects(keyed, "trip_id", every)
    assert rows.count() == 70_040
    assert unique.repeated_values(rows, "value").count() == 41


def test_first_pass_moves_hashes_alone(keyed):
    plan = unique.repeated_hashes(keyed, "trip_id")._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in plan.splitlines() if "Exchange hashpartitioning(hash" in x]
    assert len(moved) == 1 and "xxhash64" in plan
    below = plan[:plan.index(moved[0])]
    assert "value" not in below


@pytest.mark.parametrize("kind", ["long", "double", "date", "binary"])
def test_other_types(spark, kind):
    df = spark.range(10).selectExpr("id").union(spark.range(3).selectExpr("id"))
    col = {"date": F.date_add(F.lit("2020-01-01"), F.col("id").cast("int")),
           "binary": F.col("id").cast("string").cast("binary")}.get(kind, F.col("id").cast(kind))
    assert unique.count_duplicates(df.select(col.alias("k")), "k") == 3


def test_signed_zeros_are_one_value(spark):
    df = spark.sql("SELECT * FROM VALUES (0.0D), (-0.0D), (1.0D), (double('NaN')), (double('NaN')) AS t(k)")
    assert unique.count_duplicates(df, "k") == 2


def test_empty_and_null_columns(spark):
    empty = spark.createDataFrame([], "k string")
    assert unique.count_duplicates(empty, "k") == 0
    nulls = spark.createDataFrame([(None,), (None,)], "k string")
    assert unique.count_duplicates(nulls, "k") == 0


def test_fact_assertion_counts_the_same(spark, keyed):
    tests = [checks.Assertion("fact_trip", "trip_id", "unique"), checks.Assertion("fact_trip", "trip_id", "not_null")]
    got = {r.test_name: (r.failures, r.passed) for r in checks.run_assertions(spark, {"fact_trip": keyed}, tests).collect()}
    assert got == {"unique": (41, False), "not_null": (300, False)}
