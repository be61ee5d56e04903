"""Writers (IO7, IO8, IO9, IO12, IO13).

All writes go through Spark's file commit protocol: a task lost mid-write is
retried, and only committed files become visible.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fareflow.session import configure_wide
from fareflow.sources.bronze import month_path
from fareflow.sources.paths import delete_folder, holds_files, move, touch


MONTH_DONE = "_DONE"

# Row groups of the tables by month.  A task has a file open for each of its
# months, and each holds at most one row group in memory.
ROW_GROUP_BYTES = 32 * 1024 * 1024


def write_month_partitions(df: DataFrame, base: str,
                           months: Iterable[tuple[int, int]] | None = None) -> None:
    """IO7: replace (year, month) partitions; others keep their files.

    Without ``months`` exactly the partitions present in ``df`` are replaced
    (dynamic partition overwrite).  With ``months`` each listed month is
    replaced: one that got no row loses the rows it had, and every listed
    month gets a marker that says it is done, so a month whose rows were all
    rejected is not pending for ever.  Markers go before the write and come
    back after it, so a run that breaks off leaves its months pending.

    Rows are not shuffled to their partition and not sorted; each task writes
    the months it holds side by side (input files are per month, so they are
    few), with ``maxRecordsPerFile`` bounding file size.
    """
    spark = configure_wide(df.sparkSession)
    listed = [] if months is None else list(dict.fromkeys((int(y), int(m)) for y, m in months))
    for y, m in listed:
        delete_folder(spark, f"{month_path(base, y, m)}{MONTH_DONE}")
    seen = Observation()
    # The set of months with rows: at most the number of listed months.
    watched = df.observe(seen, F.collect_set(F.concat_ws("-", "year", "month")).alias("months")) if listed else df
    (watched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("parquet.block.size", ROW_GROUP_BYTES).partitionBy("year", "month").parquet(base))
    if listed:
        filled = set(seen.get["months"])
        for y, m in listed:
            if f"{y:04d}-{m:02d}" not in filled:
                delete_folder(spark, month_path(base, y, m))
            touch(spark, f"{month_path(base, y, m)}{MONTH_DONE}")


def write_split_months(rows: DataFrame, tables: dict[str, str],
                       months: Iterable[tuple[int, int]]) -> dict[tuple[str, int, int], int]:
    """One write of rows that belong to several tables; returns their counts.

    ``rows`` ends with ``outcome, year, month``; ``tables`` maps an outcome to
    the base of its table.  All rows are written once into a hidden folder of
    the first table.  Then each listed month is put in its place: the month of
    every table is replaced as a whole (by moving a folder), a month without
    rows is cleared, and the month of the first table gets its marker last, so
    a run that breaks off leaves its months pending.  Counts per outcome and
    month are taken from the written files' footers and checked against what
    the write itself observed.
    """
    import uuid

    spark = configure_wide(rows.sparkSession)
    listed = list(dict.fromkeys((int(y), int(m)) for y, m in months))
    main = next(iter(tables.values())).rstrip("/")
    stage = f"{main}/_run-{uuid.uuid4().hex}"
    for y, m in listed:
        delete_folder(spark, f"{month_path(main, y, m)}{MONTH_DONE}")
    seen = Observation()
    (rows.observe(seen, F.count(F.lit(1)).alias("rows"))
     .write.option("parquet.block.size", ROW_GROUP_BYTES).partitionBy("outcome", "year", "month").parquet(stage))
    counts: dict[tuple[str, int, int], int] = {}
    if holds_files(spark, stage):
        found = spark.read.parquet(stage).groupBy("outcome", "year", "month").agg(F.count(F.lit(1)).alias("n"))
        counts = {(r["outcome"], int(r["year"]), int(r["month"])): r["n"] for r in found.collect()}
    if sum(counts.values()) != seen.get["rows"]:
        raise RuntimeError(f"{stage} holds {sum(counts.values())} rows of {seen.get['rows']}")
    for y, m in listed:
        for outcome, base in reversed(tables.items()):
            part = month_path("", y, m).strip("/")
            move(spark, f"{stage}/outcome={outcome}/{part}", month_path(base, y, m).rstrip("/"))
        touch(spark, f"{month_path(main, y, m)}{MONTH_DONE}")
    delete_folder(spark, stage)
    return counts


def write_table(df: DataFrame, path: str) -> None:
    """IO8: full rebuild of a Gold table (overwrite the whole folder)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_partitioned_table(df: DataFrame, path: str) -> None:
    """IO9: full rebuild of a Gold table partitioned by year/month (columns last)."""
    configure_wide(df.sparkSession)
    cols = [c for c in df.columns if c not in ("year", "month")] + ["year", "month"]
    (df.select(*cols).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .option("parquet.block.size", ROW_GROUP_BYTES).partitionBy("year", "month").parquet(path))


def write_profile_details(results: dict[str, DataFrame], out_dir: str) -> list[str]:
    """IO12: every profile table as headed CSV, one folder per table and month.

    One write per table, partitioned by the table's own year and month.
    """
    for name, df in results.items():
        (df.repartition("year", "month").write.mode("overwrite").option("header", True)
         .partitionBy("year", "month").csv(f"{out_dir}/{name}"))
    return list(results)


def write_profile_summary(summary: DataFrame, path: str) -> None:
    """IO13: the multi-month summary, one CSV, ordered by year and month.

    The summary has one row per month, so a single output file is small.
    """
    (summary.orderBy("year", "month").coalesce(1)
     .write.mode("overwrite").option("header", True).csv(path))
