"""Connected components by alternating star contraction.

Each round links every node's larger neighbours to its smallest neighbour
(large star) and then its smaller neighbours to the smallest of them (small
star).  Minima are plain grouped aggregates, combined before the shuffle, so a
hub with very many neighbours is no single group.  They are written before
they are joined back to the edges, so that such a join reads two plain
exchanges and adaptive execution may split a hub's edges over tasks.  The joins
are sort-merge joins: rounds follow each other, and relations
broadcast in every one of them would pile up on the driver.  Only one row (an
edge count and checksum) reaches the driver per round.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import remove
from fareflow.session import checkpoint_dir

MAX_ROUNDS = 100


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (u, v)``; root is the least node.

    Self-loops and repeated edges are allowed; null ends are ignored.  An
    empty edge table gives an empty result.
    """
    spark = edges.sparkSession
    base = f"{checkpoint_dir(spark)}/llm/{uuid.uuid4().hex}/components"
    kind = dict(edges.dtypes)["u"]
    schema = f"u {kind}, v {kind}"

    def put(df: DataFrame, name: str, columns: str = schema) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(columns).parquet(f"{base}/{name}")

    def minima(df: DataFrame, name: str) -> DataFrame:
        least = df.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return put(least, name, f"u {kind}, m {kind}").hint("merge")

    def oriented(df: DataFrame) -> DataFrame:
        return df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    current = put(oriented(edges), "0")
    seen = None
    for i in range(1, MAX_ROUNDS):
        # Large star.
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(minima(both, f"low{i}"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star.
        large = put(oriented(large), f"large{i}")
        small = large.join(minima(large, f"least{i}"), "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        current = put(oriented(small), str(i))
        state = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        for name in (i - 1, f"low{i}", f"large{i}", f"least{i}"):
            remove(spark, f"{base}/{name}")
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("connected components did not converge")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
