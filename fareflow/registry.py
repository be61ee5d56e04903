"""Registered queries: operator id -> ``(spark, sf_dir) -> DataFrame``.

Every entry reads the test tables in full and returns a lazy DataFrame.
Bronze-side operators (scans, Silver transform, profiling) read the landed
Bronze files; Gold, the ad-hoc queries and the checks read the published
Silver table written by the month batch job (``plans.layers``), as in the
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.operators import (
    checks, dims, marts, months as bm, profile as pf,
    queries as aq, silver as sv, unique,
)
from fareflow.functions import expressions as ex
from fareflow.plans import layers as L

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# ---- scans and the Silver transform -------------------------------------

@register("io1_bronze_month_scan")
def io1(spark, sf):
    """IO1/IO2 + SN1/SN2: every Bronze month, normalised."""
    return L.bronze(spark, sf)


@register("io3_zone_lookup")
def io3(spark, sf):
    return L.zone_lookup(spark, sf)


@register("sn4_silver_trips")
def silver(spark, sf):
    """CR + SN3/SN4 + DV + WF + OF: the 45-column Silver rows."""
    return L.silver(spark, sf)


@register("cr_rule_failure_counts")
def cr_counts(spark, sf):
    """Per month, rows failing each of the 16 critical rules."""
    return sv.rule_failure_counts(L.bronze(spark, sf))


@register("rc1_row_reconciliation")
def rc1(spark, sf):
    return sv.reconcile(L.bronze(spark, sf))


@register("dc4_strict_payment_reconciliation")
def dc4(spark, sf):
    """RC1 with the documented strict payment rule (types 1-4 only) switched on."""
    return sv.reconcile(L.bronze(spark, sf), strict_payment_domain=True)


@register("dc2_rejected_rows")
def dc2(spark, sf):
    """Rejected Bronze rows with the failed rule ids (as text for comparison)."""
    rej = sv.rejected(L.bronze(spark, sf))
    return rej.withColumn("failed_rules", F.array_join("failed_rules", ","))


@register("dc2_rejected_read_back")
def dc2_stored(spark, sf):
    """DC2 + RC1: the rejected rows that the Silver job's one write left beside Silver."""
    from fareflow.plans.silver_job import rejected_base
    from fareflow.sources import landing
    rows = spark.read.parquet(rejected_base(landing.silver_base(spark, sf)))
    return sv.stored_rejected(rows).withColumn("failed_rules", F.array_join("failed_rules", ","))


_RUNS: dict[str, str] = {}


def _fresh_folder(spark, name: str) -> str:
    """A new folder for one run of a write-then-read query.

    The folder of the same query's run before is deleted: a run's output is
    kept until the query runs again.
    """
    import uuid
    from fareflow.session import checkpoint_dir
    from fareflow.sources.paths import delete_folder
    if name in _RUNS:
        delete_folder(spark, _RUNS[name])
    _RUNS[name] = f"{checkpoint_dir(spark)}/fareflow/runs/{uuid.uuid4().hex}/{name}"
    return _RUNS[name]


@register("io7_silver_partitions_read_back")
def io7(spark, sf):
    """IO7 + IO4: Silver written by month, then its first month rewritten to empty, read back."""
    from fareflow.sources.sinks import write_month_partitions
    from fareflow.sources.tables import read_partitioned
    from fareflow.schema import SILVER_COLUMNS
    path = _fresh_folder(spark, "io7")
    months = _stored(spark, sf)
    silver = L.silver(spark, sf)
    write_month_partitions(silver, path, months)
    first = min(months)
    write_month_partitions(bm.restrict(silver, [first]).where(F.lit(False)), path, [first])
    return read_partitioned(spark, path).select(*[n for n, _ in SILVER_COLUMNS])


@register("dc7_run_summary")
def dc7(spark, sf):
    """DC7 + RC1 + BM5: the Silver batch job over every landed month.

    The job runs twice into a fresh folder: first the first year, then all
    months, so the second run skips what the first one wrote.
    """
    from fareflow.plans.silver_job import run_silver_job
    from fareflow.sources import landing
    months, path = _stored(spark, sf), _fresh_folder(spark, "dc7")
    base = landing.bronze_base(spark, sf)
    run_silver_job(spark, base, path, [m for m in months if m[0] == months[0][0]])
    return run_silver_job(spark, base, path, months).drop("output_path")


@register("sn2_missing_columns")
def sn2(spark, sf):
    """SN1/SN2: what each month holds of the columns that older deliveries lack."""
    return L.bronze(spark, sf).groupBy("year", "month").agg(
        F.count("airport_fee").alias("airport_fee_values"), ex.reported_sum("airport_fee").alias("airport_fee_sum"),
        F.count("congestion_surcharge").alias("congestion_values"),
        ex.reported_sum("congestion_surcharge").alias("congestion_sum"),
        F.count("store_and_fwd_flag").alias("flag_values"), ex.reported_sum("extra").alias("extra_sum"),
        ex.reported_sum("passenger_count").alias("passenger_sum"))


@register("io5_visible_years")
def io5(spark, sf):
    """IO5: trips per month of the visible years, partitions by rule."""
    from fareflow.sources import landing
    from fareflow.sources.tables import projected_silver
    return projected_silver(landing.silver_base(spark, sf), 1994, 1996).read(spark).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("trip_count"))


@register("io8_gold_mart_read_back")
def io8(spark, sf):
    """IO8: a mart as the Gold build wrote it."""
    from fareflow.sources import landing
    return ex.reported(spark.read.parquet(landing.gold_paths(spark, sf)["mart_payment_behavior"]))


@register("io9_gold_fact_read_back")
def io9(spark, sf):
    """IO9: the fact table as the Gold build wrote it, partitioned by month."""
    from fareflow.schema import FACT_COLUMNS
    from fareflow.sources import landing
    return spark.read.parquet(landing.gold_paths(spark, sf)["fact_trip"]).select(*FACT_COLUMNS)


@register("io12_profile_details_read_back")
def io12(spark, sf):
    """IO12: profile tables written as headed CSV and read back."""
    from fareflow.sources.sinks import write_profile_details
    path = _fresh_folder(spark, "io12")
    table = pf.critical_quality(L.bronze(spark, sf))
    write_profile_details({"critical_quality": table}, path)
    back = spark.read.schema(table.schema).option("header", True).csv(f"{path}/critical_quality")
    return back.select(*table.columns)


@register("io13_profile_summary_read_back")
def io13(spark, sf):
    """IO13: the multi-month summary written as one CSV and read back."""
    from fareflow.sources.sinks import write_profile_summary
    path = _fresh_folder(spark, "io13")
    table = pf.monthly_summary(L.bronze(spark, sf))
    write_profile_summary(table, path)
    return spark.read.schema(table.schema).option("header", True).csv(path)


# ---- profiling ------------------------------------------------------------

@register("pf_profile_one_pass")
def pf_all(spark, sf):
    """PF1-PF4 for every month from one scan and one aggregate."""
    return ex.reported(pf.profile(L.bronze(spark, sf)), only_means=True)


@register("pf1_summary")
def pf1(spark, sf):
    return ex.reported(pf.summary(L.bronze(spark, sf)), only_means=True)


@register("pf2_null_checks")
def pf2(spark, sf):
    return pf.null_checks(L.bronze(spark, sf))


@register("pf3_critical_quality")
def pf3(spark, sf):
    return pf.critical_quality(L.bronze(spark, sf))


@register("pf4_warning_quality")
def pf4(spark, sf):
    return pf.warning_quality(L.bronze(spark, sf))


def _dist(column: str) -> Query:
    def q(spark, sf):
        return pf.distribution(L.bronze(spark, sf), column)
    q.__doc__ = f"PF5: distribution of {column} per month."
    return q


register("pf5_payment_type_distribution")(_dist("payment_type"))
register("pf5_ratecode_distribution")(_dist("RatecodeID"))
register("pf5_vendor_distribution")(_dist("VendorID"))
register("pf5_store_and_fwd_distribution")(_dist("store_and_fwd_flag"))


@register("pf5_distributions_one_pass")
def pf5_all(spark, sf):
    return pf.distributions(L.bronze(spark, sf))


@register("pf7_monthly_summary")
def pf7(spark, sf):
    """PF6-PF8: one summary row per month."""
    return pf.with_paths(pf.monthly_summary(L.bronze(spark, sf)), "bronze", "details", ["summary", "null_checks"])


@register("dc1_distribution_profile")
def dc1(spark, sf):
    return pf.distribution_profile(L.silver_table(spark, sf))


@register("dc1_merged_years")
def dc1_years(spark, sf):
    """DC1 + PF8: yearly profiles merged from one stored sketch row a month.

    The sketches' answers are estimates, so each is reported as whether it
    lies within its stated error of the trips themselves.
    """
    from fareflow.operators import profile_state as ps
    from fareflow.sources.sinks import write_month_partitions
    from fareflow.sources.tables import read_partitioned
    silver, path = L.silver_table(spark, sf), _fresh_folder(spark, "dc1")
    write_month_partitions(ps.monthly_state(silver), path)
    merged = ps.merged(read_partitioned(spark, path), "year")
    return ps.verified(merged, silver, "year")


@register("dc5_volume_checks")
def dc5(spark, sf):
    return pf.volume_checks(L.bronze(spark, sf), L.zone_lookup(spark, sf))


@register("dc6_quality_gate")
def dc6(spark, sf):
    return pf.quality_gate(L.bronze(spark, sf), max_critical_ratio=0.125)


# ---- Gold -------------------------------------------------------------------

@register("gd1_dim_date")
def gd1(spark, sf):
    return L.dim_date(spark, sf)


@register("gd6_dim_zone")
def gd6(spark, sf):
    return L.dim_zone(spark, sf)


@register("gf4_fact_trip")
def gf4(spark, sf):
    return L.fact_trip(spark, sf)


@register("mt1_daily_trip_revenue")
def mt1(spark, sf):
    return ex.reported(marts.mart_daily_trip_revenue(L.fact_trip(spark, sf), L.dim_date(spark, sf)))


@register("mt2_hourly_demand")
def mt2(spark, sf):
    return ex.reported(marts.mart_hourly_demand(
        L.fact_trip(spark, sf), L.dim_date(spark, sf), dims.dim_hour(spark)))


@register("mt3_pickup_zone_performance")
def mt3(spark, sf):
    return ex.reported(marts.mart_pickup_zone_performance(L.fact_trip(spark, sf), L.dim_zone(spark, sf)))


@register("mt4_payment_behavior")
def mt4(spark, sf):
    return ex.reported(marts.mart_payment_behavior(L.fact_trip(spark, sf), dims.dim_payment_type(spark)))


@register("mt5_airport_trip_summary")
def mt5(spark, sf):
    return ex.reported(marts.mart_airport_trip_summary(L.fact_trip(spark, sf), L.dim_zone(spark, sf)))


# ---- ad-hoc queries -----------------------------------------------------------

@register("aq0_smoke_read")
def aq0(spark, sf):
    return aq.ordered_smoke_read(L.silver_table(spark, sf))


@register("aq1_monthly_trip_summary")
def aq1(spark, sf):
    return ex.reported(aq.monthly_trip_summary(L.silver_table(spark, sf)))


@register("aq2_payment_type_summary")
def aq2(spark, sf):
    return ex.reported(aq.payment_type_summary(L.silver_table(spark, sf)))


@register("aq3_hourly_demand_pattern")
def aq3(spark, sf):
    return ex.reported(aq.hourly_demand_pattern(L.silver_table(spark, sf)))


@register("aq4_top_pickup_zones")
def aq4(spark, sf):
    return ex.reported(aq.top_pickup_zones(L.silver_table(spark, sf)))


@register("dc3_top_pickup_zones_named")
def dc3(spark, sf):
    return aq.top_pickup_zones_named(L.bronze(spark, sf), L.zone_lookup(spark, sf))


# ---- batch scope --------------------------------------------------------------

def _stored(spark, sf) -> list[tuple[int, int]]:
    """The months present in Bronze, by listing its folders."""
    from fareflow.sources import landing
    from fareflow.sources.bronze import stored_months
    return stored_months(spark, landing.bronze_base(spark, sf))


def _asked_months(spark, sf) -> DataFrame:
    """The stored months and the one after the last, which nothing was delivered for."""
    months = _stored(spark, sf)
    y, m = max(months)
    return bm.months_frame(spark, months + [(y + m // 12, m % 12 + 1)])


@register("bm4_january_scope")
def bm4(spark, sf):
    """BM4: Silver restricted by a months DataFrame (every January)."""
    januaries = _asked_months(spark, sf).where("month = '01'")
    return bm.restrict(L.silver_table(spark, sf), januaries).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("trip_count"), ex.reported_sum("total_amount").alias("total_revenue"))


@register("bm5_pending_months")
def bm5(spark, sf):
    """BM5: every asked month, done or still pending."""
    from fareflow.sources import landing
    months = _asked_months(spark, sf)
    pending = bm.pending_months(spark, months, landing.silver_base(spark, sf)).select("period", F.lit("pending").alias("_p"))
    return months.join(pending, "period", "left").select(
        "period", "year", "month", F.coalesce("_p", F.lit("done")).alias("status"))


@register("bm6_partition_coverage")
def bm6(spark, sf):
    """Silver row count per asked month, passed/failed."""
    return bm.partition_coverage(_asked_months(spark, sf), L.silver_table(spark, sf)) \
        .select("period", "year", "month", "trip_count", "validation")


@register("bm7_gold_completeness")
def bm7(spark, sf):
    """BM7: checks of the built Gold tables against every asked month."""
    from fareflow.sources import landing
    return bm.gold_completeness(spark, landing.gold_paths(spark, sf), _asked_months(spark, sf))


# ---- assertions -----------------------------------------------------------------

def _gold_tables(spark, sf) -> dict[str, DataFrame]:
    """The Gold tables as written by the build; assertions scan these alone."""
    from fareflow.sources import landing
    return {name: spark.read.parquet(path) for name, path in landing.gold_paths(spark, sf).items()}


@register("qt_core_assertions")
def qt_core(spark, sf):
    """QT1-QT4 over the dimensions and the fact table."""
    return checks.run_assertions(spark, _gold_tables(spark, sf), checks.CORE_ASSERTIONS)


@register("qt2_duplicated_trip_ids")
def qt2(spark, sf):
    """QT2: the trip ids that more than one trip of the built fact has, and how many."""
    found, _ = unique.duplicates(_gold_tables(spark, sf)["fact_trip"], "trip_id")
    return found.select(F.col("value").alias("trip_id"), F.col("n").alias("trips"))


@register("qt_mart_assertions")
def qt_marts(spark, sf):
    return checks.run_assertions(spark, _gold_tables(spark, sf), checks.MART_ASSERTIONS)


@register("qt5_default_selection")
def qt5(spark, sf):
    """The default test run: dimensions + daily mart, no relationships."""
    return checks.run_assertions(spark, _gold_tables(spark, sf), checks.default_selection())


@register("qt_domain_assertions")
def qt_domains(spark, sf):
    """QT1 and QT3 over Silver: not-null and accepted-values tests that data can fail."""
    return checks.run_assertions(spark, {"silver": L.silver_table(spark, sf)}, checks.SILVER_ASSERTIONS)
