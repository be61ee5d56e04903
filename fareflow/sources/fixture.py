"""Synthetic Bronze and zone lookup derived from the shared test tables.

The test data holds no trips, so Bronze is derived from ``lineitem`` row by
row (FIXTURES.md §4; one row in 499 is delivered twice): every raw trip column is a deterministic expression of
one lineitem row and a hash ``h`` of its keys, with one modulus per special
value so every rule and flag sees rows.  The Bronze partition (year, month)
is the month of ``l_shipdate``.  The zone lookup (265 rows) is derived from
``nation`` and ``region``.  All of it is narrow, per-row work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.functions.expressions import zero_padded

# The adapter's hash weights and modulus.
HASH_WEIGHTS = {"l_orderkey": 7919, "l_partkey": 104729,
                "l_suppkey": 1299709, "l_linenumber": 15485863}
HASH_MODULUS = 1000003

# Zone ids of the three airports and their names.
AIRPORT_ZONES = {1: "Newark Airport", 132: "JFK Airport", 138: "LaGuardia Airport"}
ZONE_COUNT = 265


def _m(k: int) -> Column:
    """h % k == 0"""
    return (F.col("h") % F.lit(k)) == 0


def _ms(ts: Column, millis: Column) -> Column:
    return F.timestamp_add("MILLISECOND", millis, ts)


def keyed_lineitem(lineitem: DataFrame) -> DataFrame:
    """What a trip is derived from: eight columns of a row, and its year/month."""
    h = sum((F.col(c) * F.lit(w) for c, w in HASH_WEIGHTS.items()), F.lit(0))
    return lineitem.select(
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_shipdate", (h % F.lit(HASH_MODULUS)).alias("h"),
        F.year("l_shipdate").cast("string").alias("year"),
        zero_padded(F.month("l_shipdate"), 2).alias("month"))


def bronze_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Raw trip rows with drifting raw names (``Airport_fee``) plus year/month."""
    return bronze_from_keyed(keyed_lineitem(lineitem))


def bronze_from_keyed(keyed: DataFrame) -> DataFrame:
    """The raw trip rows of ``keyed_lineitem``, row by row."""
    hh = F.col("h")
    step1 = keyed.select(
        "*",
        F.when(_m(101), None).when(_m(53), 6).otherwise(1 + hh % 2).alias("VendorID"),
        # One in 331 a month early, one in 337 a month late.
        F.when(_m(401), None)
         .otherwise(_ms(F.col("l_shipdate"), (hh % 86400) * 1000
                        + F.when(_m(331), -2_678_400_000).when(_m(337), 2_678_400_000).otherwise(0)))
         .alias("tpep_pickup_datetime"),
        F.when(_m(37), None).when(_m(41), 0.0)
         .otherwise((1 + hh % 5).cast("double")).alias("passenger_count"),
        F.when(_m(347), None).when(_m(43), 0.0).when(_m(307), 150.0)
         .when(_m(149) | _m(151), 0.05)
         .otherwise(F.col("l_quantity") / 4.0).alias("trip_distance"),
        F.when(_m(37), None).when(_m(61), 7).when(_m(97), 99)
         .otherwise(1 + hh % 6).alias("RatecodeID"),
        F.when(_m(37), None).when(_m(199), "X").when(_m(29), "Y")
         .otherwise("N").alias("store_and_fwd_flag"),
        F.when(_m(503), None).when(_m(251), 300)
         .otherwise(1 + F.col("l_partkey") % ZONE_COUNT).alias("PULocationID"),
        F.when(_m(521), None).when(_m(137), 0).when(hh % 10 < 6, 1)
         .when(hh % 10 < 9, 2).otherwise(3 + hh % 4).alias("payment_type"),
        F.when(_m(353), None).when(_m(73), -5.0).when(_m(79), 0.0).when(_m(149) | _m(151), 150.0)
         .otherwise(F.floor(F.col("l_extendedprice") / 10.0) / 100.0)
         .alias("fare_amount"),
        F.when(_m(83), None).when(_m(89), -1.0)
         .otherwise(F.col("l_tax") * 10.0).alias("extra"),
        F.when(_m(359), -0.5).otherwise(0.5).alias("mta_tax"),
        F.when(_m(367), -1.0).when(hh % 10 < 6,
               F.floor(F.col("l_extendedprice") * F.col("l_discount") / 10.0) / 100.0)
         .otherwise(0.0).alias("tip_amount"),
        F.when(_m(373), -6.55).when(_m(17), 6.55).otherwise(0.0).alias("tolls_amount"),
        F.when(_m(379), -0.3).otherwise(0.3).alias("improvement_surcharge"),
        F.when(_m(383), -2.5).when(_m(3), 2.5).otherwise(0.0).alias("congestion_surcharge"),
        F.when(_m(389), -1.25).when(_m(13), 1.25).otherwise(0.0).alias("Airport_fee"),
    )
    dropoff_ms = (F.when(_m(67), -60000).when(_m(71), 0).when(_m(227), 500)
                  .when(_m(211), 100000000).when(_m(223), 30000)
                  .otherwise((120 + hh % 5400) * 1000))
    step2 = step1.select(
        "*",
        _ms(F.col("tpep_pickup_datetime"), dropoff_ms).alias("tpep_dropoff_datetime"),
        F.when(_m(509), None).when(_m(257), 301)
         .when(_m(31) | _m(149), F.col("PULocationID"))
         .otherwise(1 + (F.col("l_suppkey") * 7 + hh) % ZONE_COUNT).alias("DOLocationID"),
        F.when(_m(547), None).when(_m(557), -1.0)
         .otherwise(F.col("fare_amount") + F.col("l_tax") * 10.0 + 0.8)
         .alias("total_amount"),
    )
    # One row in 499 is delivered twice.
    step2 = step2.withColumn("_copy", F.explode(F.when(_m(499), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return step2.select(
        "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime",
        "passenger_count", "trip_distance", "RatecodeID", "store_and_fwd_flag",
        "PULocationID", "DOLocationID", "payment_type", "fare_amount", "extra",
        "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
        "total_amount", "congestion_surcharge", "Airport_fee", "year", "month")


def _first_year(df: DataFrame) -> DataFrame:
    return df.drop("Airport_fee", "congestion_surcharge", "store_and_fwd_flag")


def _second_year(df: DataFrame) -> DataFrame:
    return (df.drop("Airport_fee").withColumnRenamed("extra", "Extra")
            .withColumn("passenger_count", F.col("passenger_count").cast("long"))
            .withColumn("RatecodeID", F.col("RatecodeID").cast("double"))
            .withColumn("VendorID", F.col("VendorID").cast("int")))


def _third_year(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("Airport_fee", "airport_fee")


# How the first years are stored: columns missing, other case, other types.
DRIFT = {"1992": _first_year, "1993": _second_year, "1994": _third_year}


def zone_lookup(spark: SparkSession, nation: DataFrame, region: DataFrame) -> DataFrame:
    """The 265-row zone lookup in the published CSV's column names."""
    ids = spark.range(1, ZONE_COUNT + 1).select(F.col("id").cast("int").alias("id"))
    nr = (nation.join(region, nation.n_regionkey == region.r_regionkey)
          .select("n_nationkey", "n_name", "r_name"))
    zone = F.col("id").cast("string")
    name = F.concat(F.col("n_name"), F.lit(" "), zone)
    for zid, zname in AIRPORT_ZONES.items():
        name = F.when(F.col("id") == zid, F.lit(zname)).otherwise(name)
    airports = list(AIRPORT_ZONES)
    # nation x region is 25 rows by the TPC-H definition.
    return (ids.join(F.broadcast(nr), (ids.id - 1) % 25 == nr.n_nationkey)
            .select(F.col("id").alias("LocationID"),
                    F.col("r_name").alias("Borough"),
                    name.alias("Zone"),
                    F.when(F.col("id").isin(*airports), "Airports")
                     .otherwise("Boro Zone").alias("service_zone")))


def read_keyed_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_lineitem(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def read_fixture_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_from_keyed(read_keyed_lineitem(spark, sf_dir))


def read_fixture_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_lookup(spark, spark.read.parquet(f"{sf_dir}/nation.parquet"),
                       spark.read.parquet(f"{sf_dir}/region.parquet"))
