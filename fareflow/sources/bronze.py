"""Bronze (raw monthly trip files): scan and schema normalisation (IO1, IO2, SN1, SN2).

Bronze files drift between years: a fee column may be missing, a name may
change case (``Airport_fee``), integer columns may be stored as doubles.
Files that store the same schema are read in one scan; every such group is
normalised to one canonical raw schema before the groups are combined, so no
file's columns depend on what another file stores.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.schema import BRONZE_COLUMNS, FEE_COLUMNS
from fareflow.sources.manifest import schema_groups
from fareflow.sources.paths import child_folders

# Canonical raw types after normalisation (wide enough for every known month).
BRONZE_TYPES: dict[str, T.DataType] = {
    "VendorID": T.LongType(),
    "tpep_pickup_datetime": T.TimestampNTZType(),
    "tpep_dropoff_datetime": T.TimestampNTZType(),
    "passenger_count": T.DoubleType(),
    "trip_distance": T.DoubleType(),
    "RatecodeID": T.DoubleType(),
    "store_and_fwd_flag": T.StringType(),
    "PULocationID": T.LongType(),
    "DOLocationID": T.LongType(),
    "payment_type": T.LongType(),
    "fare_amount": T.DoubleType(),
    "extra": T.DoubleType(),
    "mta_tax": T.DoubleType(),
    "tip_amount": T.DoubleType(),
    "tolls_amount": T.DoubleType(),
    "improvement_surcharge": T.DoubleType(),
    "total_amount": T.DoubleType(),
    "congestion_surcharge": T.DoubleType(),
    "airport_fee": T.DoubleType(),
}

# Columns a month may lack, with their defaults (fees 0.0, flag NULL).
MISSING_DEFAULTS: dict[str, float | None] = {
    **{fee: 0.0 for fee in FEE_COLUMNS},
    "store_and_fwd_flag": None,
}


def month_path(base: str, year: int | str, month: int | str) -> str:
    """``base/year=YYYY/month=MM/`` — the Bronze and Silver path layout."""
    return f"{base.rstrip('/')}/year={int(year):04d}/month={int(month):02d}/"


def normalize_schema(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Resolve drifting names case-insensitively and add missing columns.

    A name that differs only by case (``Airport_fee``, ``Extra``) keeps its
    data under the canonical name; a missing fee column becomes 0.0 and a
    missing ``store_and_fwd_flag`` becomes NULL.  Other missing columns are
    an error.  Output: the 19 canonical raw columns (canonical types), then
    the columns named in ``keep``.
    """
    by_lower = {}
    for name in df.columns:
        by_lower.setdefault(name.lower(), name)
    exprs = []
    for canon in BRONZE_COLUMNS:
        actual = canon if canon in df.columns else by_lower.get(canon.lower())
        if actual is not None:
            exprs.append(F.col(f"`{actual}`").cast(BRONZE_TYPES[canon]).alias(canon))
        elif canon in MISSING_DEFAULTS:
            exprs.append(F.lit(MISSING_DEFAULTS[canon]).cast(BRONZE_TYPES[canon]).alias(canon))
        else:
            raise ValueError(f"Bronze data lacks required column {canon!r}")
    return df.select(*exprs, *[F.col(k) for k in keep])


def read_bronze_month(spark: SparkSession, base: str, year: int, month: int) -> DataFrame:
    """IO1: one month of Bronze, normalised, tagged with its partition."""
    frames = [normalize_schema(spark.read.schema(schema).parquet(*paths))
              for schema, paths in schema_groups(spark, base, [(int(year), int(month))])]
    return (reduce(DataFrame.unionByName, frames)
            .withColumn("year", F.lit(f"{int(year):04d}"))
            .withColumn("month", F.lit(f"{int(month):02d}")))


def stored_months(spark: SparkSession, base: str) -> list[tuple[int, int]]:
    """(year, month) of every ``year=YYYY/month=MM`` folder, by listing alone."""
    out = []
    for y in child_folders(spark, base):
        if y.startswith("year="):
            out += [(int(y[5:]), int(m[6:])) for m in child_folders(spark, f"{base.rstrip('/')}/{y}")
                    if m.startswith("month=")]
    return out


def read_bronze_months(spark: SparkSession, base: str,
                       months: Iterable[tuple[int, int]]) -> DataFrame:
    """The listed months, whatever schema each of them stores.

    The manifest (``sources.manifest``) knows what every file stores.  Files
    of equal schema are one scan, and each scan is normalised on its own, so a
    fee that a file lacks is 0.0 and a column stored as another type is cast,
    in every combination of months and of files within a month.  The union is
    narrow, and a filter on ``year``/``month`` reaches every scan as a
    partition filter.
    """
    months = list(dict.fromkeys((int(y), int(m)) for y, m in months))
    if not months:
        raise ValueError("no months given")
    frames = [normalize_schema(spark.read.schema(schema).option("basePath", base.rstrip("/")).parquet(*paths),
                               keep=("year", "month")) for schema, paths in schema_groups(spark, base, months)]
    return reduce(DataFrame.unionByName, frames)


def read_bronze_table(spark: SparkSession, base: str) -> DataFrame:
    """All months under ``base`` (see ``read_bronze_months``)."""
    return read_bronze_months(spark, base, stored_months(spark, base))
