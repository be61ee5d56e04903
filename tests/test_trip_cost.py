"""F2 gf4_fact_trip: landing tells the drifted years by comparing dates, with the same rows."""

from pyspark.sql import functions as F

from fareflow.sources import landing


def test_landing_tells_years_by_comparing_dates(spark, scratch):
    ends = ["1991-12-31 23:59:59.999999", "1992-01-01 00:00:00", "1992-12-31 23:59:59.999999", "1993-01-01 00:00:00",
            "1994-12-31 23:59:59.999999", "1995-01-01 00:00:00", None]
    for kind in ("timestamp_ntz", "timestamp", "date"):
        rows = spark.createDataFrame([(i, s) for i, s in enumerate(ends)], "i long, s string").select(
            F.col("i").alias("l_orderkey"), F.lit(1).cast("long").alias("l_partkey"), F.lit(1).cast("long").alias("l_suppkey"),
            F.lit(1).alias("l_linenumber"), *[F.lit(1.0).alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
            F.col("s").cast("timestamp_ntz").cast(kind).alias("l_shipdate"))
        rows.write.parquet(f"{scratch}/{kind}/lineitem.parquet")
        parts = landing.landing_parts(spark, f"{scratch}/{kind}")
        # h = 7919 i + 16890349 mod 1000003 is no multiple of 499 for any of them: one trip a row.
        assert [sorted(r["year"] for r in p.select("year").collect()) for p in parts] == [
            ["1992", "1992"], ["1993"], ["1994"], ["1991", "1995"]]
        assert not any("as string) = 199" in p._jdf.queryExecution().optimizedPlan().toString() for p in parts)
