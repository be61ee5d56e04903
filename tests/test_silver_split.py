"""The Silver job: one split of Bronze, missing months, the gate, the catalog, partitions by rule."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from fareflow.cli import main
from fareflow.operators import silver as sv
from fareflow.plans.silver_job import rejected_base, run_silver_job
from fareflow.schema import SILVER_COLUMNS
from fareflow.sources.bronze import month_path, read_bronze_months, read_bronze_table
from fareflow.sources.manifest import FOLDER, footer_schemas, month_schemas
from fareflow.sources.tables import Projection, ProjectedTable, projected_silver, read_partitioned, register_silver_table

from test_io import _raw_month


def _land(spark, base, year, month, n=20, bad=0, **columns):
    raw = _raw_month(spark, year, month, n, "plain")
    for name, value in columns.items():
        raw = raw.withColumn(name, value)
    if bad:
        raw = raw.withColumn("fare_amount", F.when(F.col("trip_distance") < 1.5 + bad, F.lit(-1.0)).otherwise(F.col("fare_amount")))
    raw.coalesce(1).write.mode("append").parquet(month_path(base, year, month))


def test_a_month_of_mixed_files_keeps_every_fee(spark, scratch):
    base = f"{scratch}/bronze"
    raw = _raw_month(spark, 2023, 1, 3, "plain")
    raw.drop("airport_fee").coalesce(1).write.parquet(month_path(base, 2023, 1))
    raw.withColumn("airport_fee", F.lit(1.0)).withColumn("passenger_count", F.col("passenger_count").cast("double")) \
        .coalesce(1).write.mode("append").parquet(month_path(base, 2023, 1))
    raw.withColumn("airport_fee", F.lit(None).cast("double")).coalesce(1).write.mode("append").parquet(month_path(base, 2023, 1))
    _land(spark, base, 2023, 2, 4)
    for df in (read_bronze_table(spark, base), read_bronze_months(spark, base, [(2023, 1)])):
        january = df.where("month = '01'").agg(F.sum("airport_fee"), F.count("airport_fee"), F.count(F.lit(1)),
                                               F.sum("passenger_count")).first()
        assert tuple(january) == (3.0, 6, 9, 18.0)
    assert read_bronze_table(spark, base).count() == 13


def test_the_second_query_opens_no_footer(spark, scratch, monkeypatch):
    from fareflow.sources import manifest
    base = f"{scratch}/bronze"
    _land(spark, base, 2023, 1)
    _land(spark, base, 2023, 2)
    read_bronze_table(spark, base)
    assert len(glob.glob(f"{scratch}/bronze/{FOLDER}/*.json")) == 2
    opened = []
    monkeypatch.setattr(manifest, "footer_schemas", lambda s, paths: opened.append(paths) or footer_schemas(s, paths))
    assert read_bronze_table(spark, base).count() == 40 and opened == []
    _land(spark, base, 2023, 2, airport_fee=F.lit("x"))  # another file: only its month is looked at again
    read_bronze_table(spark, base)
    assert len(opened) == 1 and len(opened[0]) == 2 and all("month=02" in p for p in opened[0])


def test_files_that_only_spark_can_open(spark, scratch, monkeypatch):
    from fareflow.sources import manifest
    base = f"{scratch}/bronze"
    _land(spark, base, 2023, 1)
    _land(spark, base, 2023, 1, extra=F.lit(2))
    want = month_schemas(spark, base, [(2023, 1)])[2023, 1]

    def none(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.nulls(b.num_rows, pa.string())], names=["path", "kind"])
    monkeypatch.setattr(manifest, "_footers", none)
    files = [f"{base}/year=2023/month=01/{n}" for n in want]
    assert footer_schemas(spark, files) == {p: want[p.rsplit("/", 1)[1]] for p in files}
    assert len({json.dumps(json.loads(s)) for s in want.values()}) == 2


def test_a_month_without_files_raises_for_the_reader(spark, scratch):
    with pytest.raises(FileNotFoundError, match="month=05"):
        read_bronze_months(spark, f"{scratch}/bronze", [(2023, 5)])


def test_one_scan_leaves_accepted_and_rejected_rows(spark, scratch):
    base, silver = f"{scratch}/bronze", f"{scratch}/silver"
    _land(spark, base, 2023, 1, 30, bad=4)
    _land(spark, base, 2023, 2, 10)
    _land(spark, base, 2023, 3, 5, bad=9)  # every row is rejected
    months = [(2023, 1), (2023, 2), (2023, 3)]
    rows = {r.period: r for r in run_silver_job(spark, base, silver, months).collect()}
    assert [(r.bronze_count, r.silver_count, r.dropped_count) for r in rows.values()] == [(30, 26, 4), (10, 10, 0), (5, 0, 5)]
    bronze = read_bronze_table(spark, base)
    want = sv.to_silver(bronze)
    got = read_partitioned(spark, silver).select(*[n for n, _ in SILVER_COLUMNS])
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    names = sv.rejected(bronze).columns
    stored = sv.stored_rejected(spark.read.parquet(rejected_base(silver))).select(*names)
    assert sorted(map(str, stored.collect())) == sorted(map(str, sv.rejected(bronze).select(*names).collect()))
    assert stored.count() == 9 and not glob.glob(f"{silver}/_run-*")
    plan = sv.split(read_bronze_months(spark, base, months))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    # A rerun replaces both sides of a month.
    _raw_month(spark, 2023, 1, 6, "plain").coalesce(1).write.mode("overwrite").parquet(month_path(base, 2023, 1))
    again = run_silver_job(spark, base, silver, [(2023, 1)], force=True).first()
    assert (again.bronze_count, again.silver_count, again.dropped_count) == (6, 6, 0)
    left = spark.read.parquet(rejected_base(silver))
    assert left.where("month = '01'").count() == 0 and left.where("month = '03'").count() == 5


def test_odd_rejected_values_do_not_stop_the_split(spark, scratch):
    base, silver = f"{scratch}/bronze", f"{scratch}/silver"
    nan = F.when(F.col("trip_distance") < 3, F.lit(float("nan"))).otherwise(F.lit(1e300))
    _land(spark, base, 2023, 1, 5, passenger_count=nan, RatecodeID=nan, fare_amount=F.lit(-1.0))
    r = run_silver_job(spark, base, silver, [(2023, 1)]).first()
    assert (r.bronze_count, r.silver_count) == (5, 0)


def test_a_missing_month_does_not_hold_up_the_others(spark, scratch, capsys):
    base, silver = f"{scratch}/bronze", f"{scratch}/silver"
    _land(spark, base, 2023, 1)
    rows = {r.period: (r.status, r.silver_count) for r in run_silver_job(spark, base, silver, [(2023, 1), (2023, 2)]).collect()}
    assert rows == {"2023-01": ("written", 20), "2023-02": ("missing", None)}
    assert read_partitioned(spark, silver).count() == 20
    args = ["silver", "--bronze", base, "--silver", silver, "--year-months", "2023-01", "2023-02"]
    assert main(args, spark) == 1 and "missing" in capsys.readouterr().out
    _land(spark, base, 2023, 2)
    assert main(args, spark) == 0
    assert read_partitioned(spark, silver).count() == 40


def test_the_gate_leaves_a_failing_month_unwritten(spark, scratch, capsys):
    base, silver = f"{scratch}/bronze", f"{scratch}/silver"
    _land(spark, base, 2023, 1, 20, bad=10)
    _land(spark, base, 2023, 2, 20, bad=1)
    args = ["silver", "--bronze", base, "--silver", silver, "--year-months", "2023-01", "2023-02"]
    assert main([*args, "--max-critical-ratio", "0.2"], spark) == 1
    assert "failed_gate" in capsys.readouterr().out
    assert not glob.glob(f"{silver}/year=2023/month=01/*") and read_partitioned(spark, silver).count() == 19
    assert main([*args, "--max-critical-ratio", "0.6"], spark) == 0
    assert read_partitioned(spark, silver).count() == 29


def test_the_job_registers_only_the_months_it_wrote(spark, scratch):
    base, silver, table = f"{scratch}/bronze", f"{scratch}/silver", "default.job_trips"
    _land(spark, base, 2023, 1)
    _land(spark, base, 2023, 2)
    try:
        run_silver_job(spark, base, silver, [(2023, 1)], table=table)
        partitions = lambda: [r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
        assert partitions() == ["year=2023/month=01"] and spark.table(table).count() == 20
        run_silver_job(spark, base, silver, [(2023, 1), (2023, 2)], table=table)
        assert partitions() == ["year=2023/month=01", "year=2023/month=02"] and spark.table(table).count() == 40
        again = register_silver_table(spark, table, silver, [(2023, 2)])
        assert again.where("month = '02'").count() == 20 and "raw" not in again.columns
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_partitions_by_rule(spark, scratch):
    base, silver = f"{scratch}/bronze", f"{scratch}/silver"
    for y, m in ((2018, 12), (2019, 1), (2024, 12), (2025, 1)):
        _land(spark, base, y, m)
    run_silver_job(spark, base, silver, [(2018, 12), (2019, 1)])
    table = projected_silver(silver, 2019, 2024)
    assert table.read(spark).count() == 20  # before the rule's years: invisible
    run_silver_job(spark, base, silver, [(2024, 12), (2025, 1)])
    assert {(r.year, r.month) for r in table.read(spark).select("year", "month").distinct().collect()} == {("2019", "01"), ("2024", "12")}
    # Folders that the rule does not name are not read, whatever they hold.
    import os
    os.makedirs(f"{silver}/year=20xx/month=1")
    with open(f"{silver}/year=20xx/month=1/part-0.parquet", "wb") as f:
        f.write(b"not parquet")
    metric = spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics
    before = metric.METRIC_FILES_DISCOVERED().getCount()
    df = table.read(spark)
    assert df.count() == 40 and metric.METRIC_FILES_DISCOVERED().getCount() - before == len(df.inputFiles())
    assert all("year=2019/month=01" in f or "year=2024/month=12" in f for f in df.inputFiles())
    assert table.read(spark, [(2024, 12), (2025, 1)]).count() == 20
    table.create_view(spark, "ruled_trips")
    assert spark.sql("SELECT count(*) FROM ruled_trips WHERE year = '2024'").first()[0] == 20
    none = projected_silver(silver, 2030, 2031).read(spark)
    assert none.count() == 0 and none.columns[-2:] == ["year", "month"]


def test_a_rule_with_its_own_template(spark, scratch):
    spark.range(3).write.parquet(f"{scratch}/t/year=2020/month=3")
    spark.range(5).write.parquet(f"{scratch}/t/year=2020/month=4")
    rule = Projection(2020, 2020, 1, 3, "year={year}/month={month}")
    table = ProjectedTable(f"{scratch}/t", spark.range(1).schema, rule)
    assert table.read(spark).groupBy("month").count().collect()[0].asDict() == {"month": "3", "count": 3}
