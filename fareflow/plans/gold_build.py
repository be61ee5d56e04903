"""Gold build in dependency order: dims -> fact -> marts, then assertions.

Each table is written (IO8/IO9) and the next step reads the written table,
so every step starts from files in the shared folder rather than from a
long lineage, and a lost executor only repeats the current step.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.operators import checks, dims, fact as fact_ops, marts
from fareflow.sources.sinks import write_partitioned_table, write_table

CORE_TABLES = ["dim_date", "dim_hour", "dim_payment_type", "dim_rate_code",
               "dim_vendor", "dim_zone", "fact_trip"]
MART_TABLES = ["mart_daily_trip_revenue", "mart_hourly_demand",
               "mart_pickup_zone_performance", "mart_payment_behavior",
               "mart_airport_trip_summary"]


# What the daily revenue report needs, the default build.
DASHBOARD_TABLES = ["dim_date", "dim_hour", "dim_payment_type", "dim_rate_code", "dim_vendor",
                    "fact_trip", "mart_daily_trip_revenue"]


def table_paths(gold_base: str, tables: Iterable[str] = (*CORE_TABLES, *MART_TABLES)) -> dict[str, str]:
    """Table name -> folder under ``gold_base``."""
    return {n: f"{gold_base.rstrip('/')}/{'marts' if n.startswith('mart') else 'core'}/{n}" for n in tables}


def build_gold(spark: SparkSession, silver: DataFrame, zone_lookup: DataFrame | None,
               gold_base: str, tables: Iterable[str] = (*CORE_TABLES, *MART_TABLES)) -> dict[str, str]:
    """Write the named Gold tables (all of them by default); return name -> path.

    A table is built from the tables it needs, so those have to be named as
    well or lie under ``gold_base`` from a build before.
    """
    wanted = list(tables)
    paths = table_paths(gold_base)
    if "fact_trip" in wanted:
        write_partitioned_table(fact_ops.fact_trip(silver), paths["fact_trip"])
    read = lambda n: spark.read.parquet(paths[n])
    if "dim_date" in wanted:
        # dim_date from the written fact: its dates are exactly the non-outlier
        # Silver dates, and the fact is already filtered and column-pruned.
        dates = read("fact_trip").select(F.to_date("pickup_datetime").alias("date")).distinct()
        write_table(dims.dates_to_dim(dates), paths["dim_date"])
    dimensions = {
        "dim_hour": lambda: dims.dim_hour(spark),
        "dim_payment_type": lambda: dims.dim_payment_type(spark),
        "dim_rate_code": lambda: dims.dim_rate_code(spark),
        "dim_vendor": lambda: dims.dim_vendor(spark),
        "dim_zone": lambda: dims.dim_zone(zone_lookup),
    }
    built = {
        "mart_daily_trip_revenue": lambda: marts.mart_daily_trip_revenue(read("fact_trip"), read("dim_date")),
        "mart_hourly_demand": lambda: marts.mart_hourly_demand(read("fact_trip"), read("dim_date"), read("dim_hour")),
        "mart_pickup_zone_performance": lambda: marts.mart_pickup_zone_performance(read("fact_trip"), read("dim_zone")),
        "mart_payment_behavior": lambda: marts.mart_payment_behavior(read("fact_trip"), read("dim_payment_type")),
        "mart_airport_trip_summary": lambda: marts.mart_airport_trip_summary(read("fact_trip"), read("dim_zone")),
    }
    for layer in (dimensions, built):
        _write_all(spark, {n: make() for n, make in layer.items() if n in wanted}, paths)
    return {n: paths[n] for n in wanted}


def _write_all(spark: SparkSession, tables: dict[str, DataFrame], paths: dict[str, str],
               parallel: int = 4) -> None:
    """Write independent tables as concurrent Spark jobs.

    Each table is a small job (a dimension, or one aggregate over the fact);
    submitted together they share the executors instead of queueing one by
    one.  Any failure is raised after all submitted jobs finish.
    """
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        futures = [pool.submit(write_table, df, paths[name]) for name, df in tables.items()]
        for f in futures:
            f.result()


def test_gold(spark: SparkSession, paths: dict[str, str],
              selection: list[checks.Assertion] | None = None) -> DataFrame:
    """Run the assertions over the written tables (default selection: QT5)."""
    tables = {n: spark.read.parquet(p) for n, p in paths.items()}
    chosen = checks.default_selection() if selection is None else selection
    return checks.run_assertions(spark, tables, chosen)
