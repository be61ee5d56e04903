"""Uniqueness of a column as long as its table (QT2 on the fact's key).

Grouping a key by itself sends every distinct value through the shuffle.
Here two passes over that one column do it:

1. The 64-bit hashes of the values are counted.  A hash is 8 bytes whatever
   the value, so this is the only exchange that grows with the rows.  Hashes
   met more than once are written to the shared folder.
2. Rows with such a hash are the suspects: duplicates, and now and then two
   values that share a hash.  They alone are grouped by value, so this
   exchange grows with the duplicates.

The suspects' hashes are broadcast while their count is at most
``BROADCAST_HASHES`` (8 bytes each).  A table with more duplicated values than
that is grouped by value as it stands, which such a table pays for anyway.
Map-side partial aggregation leaves one row a task of a value that many rows
share, in either pass.

Nulls are not values: they are neither counted nor duplicates.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.session import checkpoint_dir
from fareflow.sources.paths import delete_folder

BROADCAST_HASHES = 1_000_000


def _values(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias("value")).filter(F.col("value").isNotNull())


def repeated_hashes(df: DataFrame, column: str) -> DataFrame:
    """``(hash)``: 64-bit hashes that more than one row of the column has."""
    return (_values(df, column).select(F.xxhash64("value").alias("hash"))
            .groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("hash"))


def suspects(df: DataFrame, column: str, hashes: DataFrame) -> DataFrame:
    """``(value)``: the rows whose hash is among ``hashes``, which are broadcast."""
    return (_values(df, column).withColumn("hash", F.xxhash64("value"))
            .join(F.broadcast(hashes), "hash", "left_semi").select("value"))


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """``(value, n)``: values that more than one row has, with their rows."""
    return (_values(df, column).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def duplicates(df: DataFrame, column: str, bound: int = BROADCAST_HASHES) -> tuple[DataFrame, str]:
    """``(value, n)`` of repeated values in two passes, and the folder of the first.

    The first pass runs at once; the caller deletes the folder when the
    result has been read.
    """
    spark = df.sparkSession
    folder = f"{checkpoint_dir(spark)}/fareflow/unique/{uuid.uuid4().hex}"
    repeated_hashes(df, column).write.parquet(folder)
    hashes = spark.read.schema("hash long").parquet(folder)
    if hashes.limit(bound + 1).count() > bound:
        return repeated_values(df, column), folder
    return repeated_values(suspects(df, column, hashes), "value"), folder


def count_duplicates(df: DataFrame, column: str, bound: int = BROADCAST_HASHES) -> int:
    """How many values of the column more than one row has (runs at once, leaves nothing behind)."""
    found, folder = duplicates(df, column, bound)
    try:
        return found.count()
    finally:
        delete_folder(df.sparkSession, folder)
