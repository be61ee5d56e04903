"""Fact-to-dimension lookups.

No side is broadcast by a guess: the lookups join aggregates of bounded size,
and adaptive execution picks the strategy from their sizes at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_after_aggregate(aggregated: DataFrame, dim: DataFrame,
                           keys: dict[str, str]) -> DataFrame:
    """Inner join of an aggregate to a dimension on ``{fact_key: dim_key}``.

    Answers "fact JOIN dim GROUP BY dim columns" when the dimension key is
    unique: aggregating the fact first (map-side partial aggregation, one row
    per key per task) and joining afterwards gives the same rows, while the
    join sees one row per key instead of every trip.  A repeated dimension
    key would repeat the aggregate, so the dimension is checked in the same
    plan: a key with several rows raises.
    """
    names = list(keys.values())
    tmp = {fk: f"_fk_{i}" for i, fk in enumerate(keys)}
    left = aggregated.select(*[F.col(c).alias(tmp.get(c, c)) for c in aggregated.columns])
    others = [c for c in dim.columns if c not in names]
    # max() is the value itself where the key is unique.
    unique = dim.groupBy(*names).agg(
        F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(c) for c in others]).select(
        *[F.when(F.col("_n") > 1, F.raise_error(F.lit(
            f"dimension key {', '.join(names)} is not unique")).cast(dim.schema[c].dataType)).otherwise(F.col(c)).alias(c)
          for c in dim.columns])
    cond = None
    for fk, dk in keys.items():
        term = left[tmp[fk]] == unique[dk]
        cond = term if cond is None else cond & term
    return left.join(unique, cond, "inner").drop(*tmp.values())
