"""Declarative data-quality assertions (QT1-QT5).

Assertions are data: ``(model, column, test, argument)``.  Running them
yields one row per assertion ``(model, column_name, test_name, failures,
passed)``; failures are reported, never raised.

Per table the work is at most three passes, whatever the number of
assertions:

* one global aggregate computes every ``not_null`` and ``accepted_values``
  count (no shuffle beyond one partial row per task);
* one grouped count over an unpivot of every ``unique`` column finds the
  duplicated values of all of them with a single shuffle (the fact's key, as
  long as the table, takes the two passes of ``operators.unique`` instead);
* one grouped count over an unpivot of every ``relationships`` column,
  anti-joined to the parent keys, finds the orphans of all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.functions.expressions import count_when
from fareflow.operators.unique import count_duplicates


@dataclass(frozen=True)
class Assertion:
    model: str
    column: str
    test: str  # not_null | unique | accepted_values | relationships
    argument: tuple = ()  # accepted values, or (parent_model, parent_column)


def _spec(model: str, columns: dict[str, list]) -> list[Assertion]:
    out = []
    for column, tests in columns.items():
        for t in tests:
            if isinstance(t, str):
                out.append(Assertion(model, column, t))
            else:
                name, arg = t
                out.append(Assertion(model, column, name, tuple(arg)))
    return out


NN, UQ = "not_null", "unique"


def _acc(*values):
    return ("accepted_values", values)


def _rel(model, column):
    return ("relationships", (model, column))


# The assertions declared for the Gold models.
CORE_ASSERTIONS = (
    _spec("dim_zone", {"location_id": [NN, UQ]})
    + _spec("dim_payment_type", {"payment_type_id": [NN, UQ, _acc(1, 2, 3, 4)],
                                 "payment_type_name": [NN]})
    + _spec("dim_rate_code", {"ratecode_id": [NN, UQ], "ratecode_name": [NN]})
    + _spec("dim_vendor", {"vendor_id": [NN, UQ, _acc(1, 2)], "vendor_name": [NN]})
    + _spec("dim_hour", {"hour_key": [NN, UQ], "hour": [NN],
                         "time_period": [NN, _acc("late_night", "morning", "midday",
                                                  "evening", "night")]})
    + _spec("dim_date", {
        "date_key": [NN, UQ], "date": [NN, UQ], "year": [NN],
        "quarter": [NN, _acc(1, 2, 3, 4)], "month": [NN], "month_name": [NN],
        "day_of_month": [NN], "day_of_week": [NN, _acc(1, 2, 3, 4, 5, 6, 7)],
        "day_of_week_name": [NN, _acc("Monday", "Tuesday", "Wednesday", "Thursday",
                                      "Friday", "Saturday", "Sunday")],
        "is_weekend": [NN]})
    + _spec("fact_trip", {
        "trip_id": [NN, UQ], "pickup_datetime": [NN], "dropoff_datetime": [NN],
        "pickup_date_key": [NN, _rel("dim_date", "date_key")],
        "pickup_hour_key": [NN, _rel("dim_hour", "hour_key")],
        "pickup_day_of_week": [NN],
        "vendor_id": [NN, _rel("dim_vendor", "vendor_id")],
        "ratecode_id": [NN, _rel("dim_rate_code", "ratecode_id")],
        "payment_type_id": [NN, _rel("dim_payment_type", "payment_type_id")],
        "pickup_location_id": [NN, _rel("dim_zone", "location_id")],
        "dropoff_location_id": [NN, _rel("dim_zone", "location_id")],
        "trip_distance": [NN], "trip_duration_minutes": [NN], "fare_amount": [NN],
        "total_amount": [NN], "has_warning_quality_issue": [NN]})
)

MART_ASSERTIONS = (
    _spec("mart_daily_trip_revenue", {
        "date_key": [NN, UQ], "date": [NN, UQ],
        **{c: [NN] for c in [
            "total_trips", "total_passengers", "total_revenue", "total_fare_amount",
            "total_tip_amount", "total_tolls_amount", "total_airport_fee",
            "total_congestion_surcharge", "avg_total_amount", "avg_trip_distance",
            "avg_trip_duration_minutes", "credit_card_trips", "cash_trips",
            "airport_fee_trips", "warning_trip_count"]}})
    + _spec("mart_hourly_demand", {
        "date_key": [NN], "hour_key": [NN], "total_trips": [NN],
        "total_passengers": [NN], "total_amount": [NN],
        "time_period": [NN, _acc("late_night", "morning", "midday", "evening", "night")]})
    + _spec("mart_pickup_zone_performance", {
        "pickup_location_id": [NN, UQ], "pickup_borough": [NN], "pickup_zone": [NN],
        "total_trips": [NN], "total_passengers": [NN], "total_amount": [NN]})
    + _spec("mart_payment_behavior", {
        "payment_type_id": [NN, UQ, _acc(1, 2, 3, 4)], "payment_type_name": [NN],
        "total_trips": [NN], "total_amount": [NN], "total_fare_amount": [NN],
        "total_tip_amount": [NN]})
    + _spec("mart_airport_trip_summary", {
        "airport_trip_type": [NN, UQ, _acc("airport_to_airport", "airport_pickup",
                                           "airport_dropoff", "non_airport")],
        "total_trips": [NN], "total_passengers": [NN], "total_amount": [NN],
        "total_airport_fee": [NN]})
)

ALL_ASSERTIONS = CORE_ASSERTIONS + MART_ASSERTIONS

# The coded columns of Silver against the values their flags accept.
SILVER_ASSERTIONS = _spec("silver", {
    "vendor_id": [NN, _acc(1, 2)], "payment_type": [NN, _acc(1, 2, 3, 4, 5, 6)],
    "ratecode_id": [_acc(1, 2, 3, 4, 5, 6, 99)], "store_and_fwd_flag": [_acc("Y", "N")],
    "total_amount": [NN], "pickup_location_id": [NN]})

# QT5 (fixed values): the tables of the default run; it leaves out the zone
# dimension, every relationships test and every test of the fact table.
DEFAULT_MODELS = ("dim_date", "dim_hour", "dim_payment_type", "dim_rate_code",
                  "dim_vendor", "mart_daily_trip_revenue")


def default_selection(assertions: list[Assertion] = ALL_ASSERTIONS) -> list[Assertion]:
    return [a for a in assertions
            if a.model in DEFAULT_MODELS and a.test != "relationships"]


# Tables whose tested keys grow with the trips.
LONG_MODELS = frozenset({"fact_trip"})

RESULT_SCHEMA = ("model string, column_name string, test_name string, "
                 "failures bigint, passed boolean")


def _one_pass(model: str, df: DataFrame, tests: list[Assertion]) -> DataFrame | None:
    """not_null / accepted_values of one table in one aggregate."""
    if not tests:
        return None
    counters: list[tuple[Assertion, Column]] = []
    for a in tests:
        c = F.col(a.column)
        if a.test == "not_null":
            counters.append((a, c.isNull()))
        else:  # accepted_values
            counters.append((a, c.isNotNull() & ~c.isin(*a.argument)))
    agg = df.agg(*[count_when(cond).cast("long").alias(f"_f{i}")
                   for i, (_, cond) in enumerate(counters)])
    return _unpivot(agg, [a for a, _ in counters])


def _relationships(model: str, df: DataFrame, tests: list[Assertion],
                   tables: dict[str, DataFrame]) -> DataFrame | None:
    """Every relationships test of one table with one scan and one small shuffle.

    The child keys of all tested columns are unpivoted and counted per
    distinct key (map-side partial aggregation: a task emits one row per key
    it saw, so the shuffle is bounded by key cardinality, not by rows).  The
    counted keys are then anti-joined to the parent key sets, which are
    small; no broadcast needs a size guess, AQE picks the strategy from the
    real sizes.  Failures are child rows, as in the declarative test.
    """
    if not tests:
        return None
    entries = ", ".join(f"'{a.column}', CAST(`{a.column}` AS STRING)" for a in tests)
    child = (df.select(F.expr(f"stack({len(tests)}, {entries})").alias("column_name", "key"))
             .filter(F.col("key").isNotNull())
             .groupBy("column_name", "key").agg(F.count(F.lit(1)).alias("n")))
    parents = None
    for a in tests:
        pmodel, pcol = a.argument
        keys = tables[pmodel].select(F.lit(a.column).alias("column_name"),
                                     F.col(pcol).cast("string").alias("key"))
        parents = keys if parents is None else parents.unionByName(keys)
    orphans = (child.join(parents.filter(F.col("key").isNotNull()).distinct(),
                          ["column_name", "key"], "left_anti")
               .groupBy("column_name").agg(F.sum("n").alias("failures")))
    names = df.sparkSession.createDataFrame([(a.column,) for a in tests], "column_name string")
    return (names.join(orphans, "column_name", "left")
            .select(F.lit(model).alias("model"), "column_name",
                    F.lit("relationships").alias("test_name"),
                    F.coalesce("failures", F.lit(0)).cast("long").alias("failures")))


def _unpivot(agg: DataFrame, tests: list[Assertion]) -> DataFrame:
    """One-row aggregate (_f0, _f1, ...) -> one row per assertion."""
    entries = ", ".join(
        f"'{a.model}', '{a.column}', '{a.test}', coalesce(_f{i}, 0L)"
        for i, a in enumerate(tests))
    return agg.select(F.expr(f"stack({len(tests)}, {entries})")
                      .alias("model", "column_name", "test_name", "failures"))


def _uniques(model: str, df: DataFrame, tests: list[Assertion]) -> DataFrame | None:
    """All unique tests of one table: one scan, one shuffle of the tested values.

    A single tested column is grouped as it is (typed, no text cast, no
    label); several are unpivoted with a small integer id instead of their
    name.  Map-side partial aggregation collapses a hot value to one row per
    task.  The keys of ``LONG_MODELS`` are counted at once, each in two passes
    of which only the hashes of the first grow with the rows.
    """
    if not tests:
        return None
    if model in LONG_MODELS:
        counted = [(a.model, a.column, a.test, count_duplicates(df, a.column)) for a in tests]
        return df.sparkSession.createDataFrame(
            counted, "model string, column_name string, test_name string, failures bigint")
    if len(tests) == 1:
        col = tests[0].column
        dup_values = (df.select(col).filter(F.col(col).isNotNull())
                      .groupBy(col).agg(F.count(F.lit(1)).alias("n"))
                      .filter(F.col("n") > 1))
        failures = dup_values.agg(F.count(F.lit(1)).alias("failures"))
        return failures.select(F.lit(model).alias("model"), F.lit(col).alias("column_name"),
                               F.lit("unique").alias("test_name"),
                               F.col("failures").cast("long").alias("failures"))
    entries = ", ".join(f"{i}, CAST(`{a.column}` AS STRING)" for i, a in enumerate(tests))
    dup_groups = (df.select(F.expr(f"stack({len(tests)}, {entries})").alias("cid", "value"))
                  .filter(F.col("value").isNotNull())
                  .groupBy("cid", "value").agg(F.count(F.lit(1)).alias("n"))
                  .filter(F.col("n") > 1)
                  .groupBy("cid").agg(F.count(F.lit(1)).alias("failures")))
    names = df.sparkSession.createDataFrame(
        [(i, a.column) for i, a in enumerate(tests)], "cid int, column_name string")
    return (names.join(dup_groups, "cid", "left")
            .select(F.lit(model).alias("model"), "column_name", F.lit("unique").alias("test_name"),
                    F.coalesce("failures", F.lit(0)).cast("long").alias("failures")))


def run_assertions(spark: SparkSession, tables: dict[str, DataFrame],
                   assertions: list[Assertion] = ALL_ASSERTIONS) -> DataFrame:
    """QT1-QT4: evaluate assertions over the given tables.

    The result is lazy but for the unique tests of ``LONG_MODELS``.
    Assertions about a table that is not given fail; their number of failures
    is unknown (NULL).
    """
    parts: list[DataFrame] = []
    for model in dict.fromkeys(a.model for a in assertions):
        mine = [a for a in assertions if a.model == model]
        needs = lambda a: {model} | ({a.argument[0]} if a.test == "relationships" else set())
        absent = [a for a in mine if not needs(a) <= set(tables)]
        if absent:
            parts.append(spark.createDataFrame(
                [(a.model, a.column, a.test, None) for a in absent],
                "model string, column_name string, test_name string, failures bigint"))
            mine = [a for a in mine if a not in absent]
        if model not in tables:
            continue
        df = tables[model]
        by_test = lambda *names: [a for a in mine if a.test in names]
        for part in (_one_pass(model, df, by_test("not_null", "accepted_values")),
                     _uniques(model, df, by_test("unique")),
                     _relationships(model, df, by_test("relationships"), tables)):
            if part is not None:
                parts.append(part)
    if not parts:
        return spark.createDataFrame([], RESULT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.coalesce(F.col("failures") == 0, F.lit(False)))
