"""Zone lookup scan (IO3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fareflow.schema import ZONE_CSV_SCHEMA


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Headed CSV with ``LocationID, Borough, Zone, service_zone``.

    The schema is declared, never inferred: no extra pass over the file and
    no type drift between files.
    """
    return spark.read.schema(ZONE_CSV_SCHEMA).option("header", True).csv(path)
