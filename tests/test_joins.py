"""Aggregate-then-lookup and the keys of built tables."""

import pytest
from pyspark.sql import functions as F

from fareflow.plans.joins import lookup_after_aggregate


def test_lookup_after_aggregate_matches_join_then_group(spark):
    facts = spark.range(200).select((F.col("id") % 7).alias("k"), F.col("id").alias("x"))
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(5)], "k long, name string")
    agg = facts.groupBy("k").agg(F.sum("x").alias("s"))
    got = sorted(tuple(r) for r in lookup_after_aggregate(agg, dim, {"k": "k"})
                 .select("k", "name", "s").collect())
    want = sorted(tuple(r) for r in facts.join(dim, "k").groupBy("k", "name")
                  .agg(F.sum("x").alias("s")).collect())
    assert got == want and len(got) == 5  # keys 5 and 6 have no dimension row


def test_a_repeated_dimension_key_raises(spark):
    agg = spark.createDataFrame([(1, 36)], "k long, trips long")
    dim = spark.createDataFrame([(1, "a"), (1, "b")], "k long, name string")
    with pytest.raises(Exception, match="not unique"):
        lookup_after_aggregate(agg, dim, {"k": "k"}).collect()


def test_silver_fingerprint_tracks_code(tmp_path, monkeypatch):
    from fareflow.sources import landing
    a = landing._code_fingerprint(landing._SILVER_CODE)
    assert a == landing._code_fingerprint(landing._SILVER_CODE)
    assert a != landing._code_fingerprint(landing._SILVER_CODE[:-1])
