"""Physical-plan properties: no Python in any plan, pushdown and pruning,
pre-aggregation before dimension joins, one scan per profile."""

import re

import pytest

from fareflow.operators import marts, profile as pf, silver as sv
from fareflow.plans import layers as L
from fareflow.registry import QUERIES
from fareflow.sources.bronze import read_bronze_month
from fareflow.sources import landing

from conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_in_plans(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_silver_filter_and_columns_reach_the_scan(spark):
    base = landing.bronze_base(spark, SF_SMALL)
    silver = sv.to_silver(read_bronze_month(spark, base, 1996, 3))
    plan = formatted(silver)
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    assert "IsNotNull(tpep_pickup_datetime)" in pushed
    assert "GreaterThan(trip_distance,0.0)" in pushed
    # the month window folds to literals for a single-month read
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in pushed


def test_profile_is_one_scan(spark):
    df = pf.profile(L.bronze(spark, SF_SMALL))
    # as many scans as Bronze stores schemas, and no row is multiplied
    assert len(re.findall(r"FileScan|Scan parquet", plan_of(df))) <= 4 and "Expand" not in plan_of(df)


def test_mart_aggregates_before_joining_dimension(spark):
    silver = L.silver(spark, SF_SMALL)
    from fareflow.operators import dims, fact as fact_ops
    df = marts.mart_daily_trip_revenue(fact_ops.fact_trip(silver), dims.dim_date(silver))
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    # the join consumes an Aggregate on the fact side
    join_at = logical.index("Join Inner")
    assert "Aggregate [pickup_date_key" in logical[join_at:]


def test_mart_trip_key_not_computed(spark):
    df = marts.mart_airport_trip_summary(L.fact_trip(spark, SF_SMALL), L.dim_zone(spark, SF_SMALL))
    assert "md5" not in plan_of(df)
    # only pairs of zones meet the dimension, never trips
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [pickup_location_id" in logical[logical.index("Join Inner"):]
