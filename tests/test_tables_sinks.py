"""Catalog table (IO4/IO6), visible years (IO5), profile CSV sinks (IO12/IO13)."""

import csv
import glob

from pyspark.sql import functions as F

from fareflow.operators import profile as pf
from fareflow.plans import layers as L
from fareflow.sources.sinks import (
    write_month_partitions, write_profile_details, write_profile_summary,
)
from fareflow.sources.tables import (
    create_database, read_partitioned, register_silver_table, visible_years,
)

from conftest import SF_SMALL


def test_catalog_table_prunes_by_string_partitions(spark, scratch):
    silver = L.silver(spark, SF_SMALL).filter(F.col("year").isin("1996", "1997"))
    write_month_partitions(silver, f"{scratch}/silver")
    create_database(spark, "fareflow_test", f"{scratch}/warehouse")
    t = register_silver_table(spark, "fareflow_test.silver_trips", f"{scratch}/silver")
    assert t.schema["month"].dataType.simpleString() == "string"
    one = spark.sql("SELECT count(*) FROM fareflow_test.silver_trips "
                    "WHERE year = '1996' AND month = '01'").first()[0]
    assert one == silver.filter("year = '1996' AND month = '01'").count() > 0
    spark.sql("DROP TABLE fareflow_test.silver_trips")


def test_visible_years(spark, scratch):
    write_month_partitions(L.silver(spark, SF_SMALL), f"{scratch}/silver")
    t = visible_years(read_partitioned(spark, f"{scratch}/silver"), 1996, 1997)
    assert {r.year for r in t.select("year").distinct().collect()} == {"1996", "1997"}


def test_profile_csv_sinks(spark, scratch):
    bronze = L.bronze(spark, SF_SMALL)
    names = write_profile_details(
        {"summary": pf.summary(bronze), "null_checks": pf.null_checks(bronze)},
        f"{scratch}/details")
    assert names == ["summary", "null_checks"]
    assert len(glob.glob(f"{scratch}/details/summary/year=*/month=*/*.csv")) == 83
    write_profile_summary(pf.monthly_summary(bronze), f"{scratch}/summary")
    [path] = glob.glob(f"{scratch}/summary/*.csv")
    with open(path) as f:
        rows = list(csv.DictReader(f))
    periods = [r["period"] for r in rows]
    assert periods == sorted(periods) and len(periods) == 83
    assert sum(int(r["total_rows"]) for r in rows) == bronze.count()


def test_publish_once_writes_once(spark, scratch):
    from fareflow.sources.paths import publish_once
    calls = []

    def write(folder):
        calls.append(folder)
        spark.range(5).write.mode("overwrite").parquet(folder)

    target = f"{scratch}/published/table"
    first = publish_once(spark, target, write)
    assert publish_once(spark, target, write) == first == calls[0] and len(calls) == 1
    assert spark.read.parquet(first).count() == 5


def test_two_writers_end_with_one_complete_table(spark, scratch):
    import os
    from fareflow.sources.paths import publish_once
    target, folders = f"{scratch}/raced/table", []

    def slow(folder):
        # Another writer starts and finishes while this one is still writing.
        spark.range(3).write.parquet(folder)
        if not folders:
            folders.append(publish_once(spark, target, slow_inner))

    def slow_inner(folder):
        spark.range(3).write.parquet(folder)

    got = publish_once(spark, target, slow)
    assert got == folders[0] and spark.read.parquet(got).count() == 3
    assert [d for d in os.listdir(target) if d.startswith("v-")] == [got.rsplit("/", 1)[1]]


def test_landing_key_follows_the_inputs(spark, tmp_path):
    import shutil
    from fareflow.sources.landing import _key
    for t in ("lineitem", "nation", "region"):
        shutil.copyfile(f"{SF_SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")
    a = _key(spark, str(tmp_path))
    assert a == _key(spark, f"file://{tmp_path}")
    (tmp_path / "lineitem.parquet").write_bytes((tmp_path / "nation.parquet").read_bytes())
    assert a != _key(spark, str(tmp_path))


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    import pytest
    from fareflow.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session)
