"""Batch scope: month lists and per-month bookkeeping (BM1-BM7).

A batch unit is a (year, month); a job's scope is a list of them, held as a
small ``months`` DataFrame with zero-padded string columns ``year``/``month``
(the partition-column form).  Month lists come from arguments or a text file
of ``YYYY-MM`` lines, so they are configuration-sized, never data-sized.
"""

from __future__ import annotations

import re
from datetime import datetime
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.functions.expressions import month_start, next_month_start
from fareflow.sources.bronze import month_path
from fareflow.sources.sinks import MONTH_DONE
from fareflow.sources.paths import has_parquet_files, holds_files, path_exists

MONTHS_SCHEMA = T.StructType([
    T.StructField("line_no", T.LongType(), False),
    T.StructField("period", T.StringType(), False),
    T.StructField("year", T.StringType(), False),
    T.StructField("month", T.StringType(), False),
])

_PERIOD = re.compile(r"(?P<year>\d{4})-(?P<month>0[1-9]|1[0-2])")


def parse_period(value: str) -> tuple[int, int]:
    """A month written as four digits, a hyphen and 01 to 12; else ``ValueError``."""
    found = _PERIOD.fullmatch(value)
    if found is None:
        raise ValueError(f"{value!r} is not a month; write it like 2024-01")
    return int(found["year"]), int(found["month"])


def months_frame(spark: SparkSession, months: Iterable[tuple[int, int]]) -> DataFrame:
    """A months DataFrame from (year, month) pairs, order and duplicates kept."""
    rows = [(i, f"{y:04d}-{m:02d}", f"{y:04d}", f"{m:02d}")
            for i, (y, m) in enumerate(months)]
    return spark.createDataFrame(rows, MONTHS_SCHEMA)


def read_month_list(spark: SparkSession, path: str) -> DataFrame:
    """BM1: parse a months file with Spark.

    Lines are trimmed; a ``#`` starts a comment (whole-line or trailing);
    blank lines are skipped; file order and duplicates are kept.  Any other
    line must be ``YYYY-MM`` with a month 1-12, else ``ValueError`` naming
    the first offending line.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no list of months at {path}")
    value = F.trim(F.regexp_replace(F.col("value"), "#.*$", ""))
    lines = (spark.read.text(path)
             .select(F.monotonically_increasing_id().alias("line_no"), value.alias("period"))
             .filter(F.col("period") != ""))
    valid = F.col("period").rlike(r"^\d{4}-(0[1-9]|1[0-2])$")
    bad = lines.filter(~valid).orderBy("line_no").select("period").limit(1).collect()
    if bad:
        parse_period(bad[0]["period"])  # raises and names the line
    return lines.select("line_no", "period",
                        F.substring("period", 1, 4).alias("year"),
                        F.substring("period", 6, 2).alias("month"))


def choose_scope(spark: SparkSession, year_months: Sequence[str] | None = None,
                 months_file: str | None = None, year: int | None = None,
                 month: int | None = None) -> DataFrame:
    """BM2: listed months first, then the file's; else one year+month; else error."""
    listed = [parse_period(v) for v in (year_months or [])]
    if listed or months_file:
        frame = months_frame(spark, listed)
        if months_file:
            offset = len(listed)
            # A months file is configuration-sized: one small window renumbers it.
            from_file = read_month_list(spark, months_file).withColumn(
                "line_no", F.row_number().over(Window.orderBy("line_no")).cast("long")
                - 1 + offset)
            frame = frame.unionByName(from_file)
        return frame
    if year is not None and month is not None:
        if not 1 <= int(month) <= 12:
            raise ValueError(f"{month} is no month of a year")
        return months_frame(spark, [(int(year), int(month))])
    raise ValueError("no months named: list them, name a file of them, or give a year with a month")


def month_window(spark: SparkSession, year: int, month: int) -> tuple[datetime, datetime]:
    """BM3: the month as a half-open interval, by the expressions the rules use."""
    y, m = F.lit(int(year)), F.lit(int(month))
    row = spark.range(1).select(month_start(y, m).alias("lo"), next_month_start(y, m).alias("hi")).first()
    return row["lo"], row["hi"]


def months_predicate(months: Iterable[tuple[int, int]]) -> Column:
    """Disjunction of (year = 'YYYY' AND month = 'MM') built from the list.

    A predicate on partition columns only: Catalyst turns it into
    ``PartitionFilters`` and no other folder is listed or read.
    """
    by_year: dict[str, list[str]] = {}
    for y, m in months:
        by_year.setdefault(f"{int(y):04d}", []).append(f"{int(m):02d}")
    if not by_year:
        return F.lit(False)
    terms = [(F.col("year") == y) & F.col("month").isin(*sorted(set(ms)))
             for y, ms in sorted(by_year.items())]
    out = terms[0]
    for t in terms[1:]:
        out = out | t
    return out


def restrict(df: DataFrame, months: Iterable[tuple[int, int]] | DataFrame) -> DataFrame:
    """BM4: keep rows of the listed months.

    Either form becomes a literal filter on the partition columns, so folders
    of other months are neither listed nor read.  A months DataFrame is
    configuration (at most 12 rows per year of the calendar once distinct);
    its pairs are read by the driver to build the filter.
    """
    if isinstance(months, DataFrame):
        months = [(int(r["year"]), int(r["month"]))
                  for r in months.select("year", "month").distinct().collect()]
    return df.filter(months_predicate(months))


def existing_months(spark: SparkSession, months: DataFrame, table_base: str) -> DataFrame:
    """Months of ``months`` that are done: data files, or the marker of a
    month that came out empty, lie in their partition folder.

    One listing per listed month (configuration-sized); no data file is
    opened.
    """
    done = [(r["year"], r["month"]) for r in months.select("year", "month").distinct().collect()
            if has_parquet_files(spark, month_path(table_base, r["year"], r["month"]))
            or path_exists(spark, f"{month_path(table_base, r['year'], r['month'])}{MONTH_DONE}")]
    return months_frame(spark, [(int(y), int(m)) for y, m in done]).select("year", "month")


def pending_months(spark: SparkSession, months: DataFrame, table_base: str,
                   force: bool = False) -> DataFrame:
    """BM5: listed months still to process (all of them when ``force``)."""
    if force:
        return months
    return months.join(existing_months(spark, months, table_base), ["year", "month"], "left_anti")


def pending_months_from(months: DataFrame, table: DataFrame, force: bool = False) -> DataFrame:
    """BM5 over a table DataFrame: listed months with no row in ``table``."""
    if force:
        return months
    present = restrict(table, months).select("year", "month").distinct()
    return months.join(present, ["year", "month"], "left_anti")


def partition_coverage(months: DataFrame, table: DataFrame) -> DataFrame:
    """BM6: per listed month the row count and 'passed' (> 0) or 'failed'.

    Only the listed months are read (a literal partition filter); the
    count is a partial aggregate, so the shuffle is one row per month per task.
    """
    counts = (restrict(table, months).groupBy("year", "month")
              .agg(F.count(F.lit(1)).alias("trip_count")))
    return (months.join(counts, ["year", "month"], "left")
            .select("line_no", "period", "year", "month",
                    F.coalesce("trip_count", F.lit(0)).cast("long").alias("trip_count"))
            .withColumn("validation", F.when(F.col("trip_count") > 0, "passed")
                        .otherwise("failed")))


def gold_completeness(spark: SparkSession, tables: dict[str, str], months: DataFrame,
                      fact_name: str = "fact_trip") -> DataFrame:
    """BM7: one row per check; Gold is complete iff every row passed.

    Checks: each table's folder exists and holds data; the fact table has a
    partition with data for every listed month.
    """
    rows = []
    for name, path in tables.items():
        ok = path_exists(spark, path) and _has_data(spark, path)
        rows.append(("table_has_data", name, bool(ok)))
    table_checks = spark.createDataFrame(rows, "check string, target string, passed boolean")
    fact_path = tables.get(fact_name)
    if fact_path and path_exists(spark, fact_path):
        fact = spark.read.parquet(fact_path)
        cov = partition_coverage(months, fact).select(
            F.lit("fact_month_present").alias("check"), F.col("period").alias("target"),
            (F.col("validation") == "passed").alias("passed"))
    else:
        cov = months.select(F.lit("fact_month_present").alias("check"),
                            F.col("period").alias("target"), F.lit(False).alias("passed"))
    return table_checks.unionByName(cov)


def _has_data(spark: SparkSession, path: str) -> bool:
    """True if the table holds a row; an unreadable file raises."""
    if not holds_files(spark, path):
        return False
    return len(spark.read.parquet(path).limit(1).collect()) > 0
