"""Partitioned Silver/Gold tables: catalog, read side (IO4, IO5, IO6)."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.schema import SILVER_COLUMNS, SPLIT_COLUMNS
from fareflow.session import configure
from fareflow.sources.bronze import month_path
from fareflow.sources.paths import path_exists


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """IO6: create the database if missing (optionally at a given location)."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def silver_ddl(table: str, location: str) -> str:
    """IO4: external parquet table partitioned by string year/month."""
    cols = ",\n  ".join(f"`{n}` {t.simpleString()}" for n, t in SILVER_COLUMNS
                        if n not in ("year", "month"))
    return (f"CREATE TABLE IF NOT EXISTS {table} (\n  {cols},\n  `year` string,\n"
            f"  `month` string)\nUSING parquet\nPARTITIONED BY (`year`, `month`)\n"
            f"LOCATION '{location}'")


def add_partitions(spark: SparkSession, table: str, location: str,
                   months: Iterable[tuple[int, int]]) -> None:
    """Make the listed months known to the catalog, and nothing else.

    The job knows which months it wrote, so no folder of the table is listed
    to find them; months that are known already stay as they are.
    """
    listed = list(dict.fromkeys((int(y), int(m)) for y, m in months))
    for i in range(0, len(listed), 100):
        parts = " ".join(f"PARTITION (`year` = '{y:04d}', `month` = '{m:02d}') LOCATION '{month_path(location, y, m)}'"
                         for y, m in listed[i:i + 100])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")


def register_silver_table(spark: SparkSession, table: str, location: str,
                          months: Iterable[tuple[int, int]] | None = None) -> DataFrame:
    """Register the Silver folder as a catalog table.

    With ``months`` only those partitions are added; without, the catalog
    lists the whole folder to find them (a first registration).
    """
    spark.sql(silver_ddl(table, location))
    if months is None:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    else:
        add_partitions(spark, table, location, months)
    spark.catalog.refreshTable(table)
    return spark.table(table)


def read_partitioned(spark: SparkSession, base: str) -> DataFrame:
    """IO4 without a catalog: partition discovery over ``year=/month=`` folders.

    Partition values stay zero-padded strings (type inference is off in the
    session), so ``month = '01'`` prunes as written.
    """
    configure(spark)
    return spark.read.option("basePath", base).parquet(base).drop(*SPLIT_COLUMNS)


@dataclass(frozen=True)
class Projection:
    """IO5: the partitions a table has by rule: years, months, folder template.

    Nothing is registered and no folder is listed to find partitions.  A
    partition that the rule names and that no one has written yet is empty;
    a folder that the rule does not name does not exist for the table.
    """

    first_year: int
    last_year: int
    first_month: int = 1
    last_month: int = 12
    template: str = "year={year:04d}/month={month:02d}"

    def months(self) -> list[tuple[int, int]]:
        return [(y, m) for y in range(self.first_year, self.last_year + 1)
                for m in range(self.first_month, self.last_month + 1)]

    def folder(self, base: str, year: int, month: int) -> str:
        return f"{base.rstrip('/')}/{self.template.format(year=year, month=month)}"


@dataclass(frozen=True)
class ProjectedTable:
    """A table whose partitions follow from a rule when it is read.

    ``columns`` is the stored schema without the partition columns, which are
    zero-padded strings taken from the rule.
    """

    base: str
    columns: T.StructType
    rule: Projection

    def read(self, spark: SparkSession, months: Iterable[tuple[int, int]] | None = None) -> DataFrame:
        """The partitions of the rule (or those of ``months`` that it names) as they are now.

        Each folder is asked for by name, which costs one lookup; only the
        folders that exist are listed, by the scan itself.
        """
        configure(spark)
        named = self.rule.months()
        if months is not None:
            asked = {(int(y), int(m)) for y, m in months}
            named = [ym for ym in named if ym in asked]
        with ThreadPoolExecutor(16) as pool:  # lookups wait on storage
            here = list(pool.map(lambda ym: path_exists(spark, self.rule.folder(self.base, *ym)), named))
        partitions = T.StructType([T.StructField("year", T.StringType()), T.StructField("month", T.StringType())])
        schema = T.StructType(self.columns.fields + partitions.fields)
        paths = [self.rule.folder(self.base, *ym) for ym, there in zip(named, here) if there]
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", self.base.rstrip("/")).parquet(*paths)

    def create_view(self, spark: SparkSession, name: str) -> None:
        """A view for SQL over the partitions as they are now."""
        self.read(spark).createOrReplaceTempView(name)


def projected_silver(base: str, first_year: int, last_year: int) -> ProjectedTable:
    """IO5 for Silver: every month of the visible years."""
    columns = T.StructType([T.StructField(n, t) for n, t in SILVER_COLUMNS if n not in ("year", "month")])
    return ProjectedTable(base, columns, Projection(first_year, last_year))


def visible_years(df: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """IO5: only the projected year range is visible (a partition filter)."""
    return df.filter(F.col("year").between(f"{first_year:04d}", f"{last_year:04d}"))
