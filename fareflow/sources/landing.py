"""Landing of the synthetic inputs as files, the way real inputs arrive.

Real Bronze arrives as monthly parquet files under ``year=YYYY/month=MM/``
and the zone lookup as a CSV file.  The test tables hold no trips, so the
adapter output (``sources.fixture``) is written once per test-data folder
into the shared checkpoint folder in exactly that layout, and every query
then reads those files with the ordinary scans (IO1, IO3).  The write is one
narrow job; Spark's commit protocol makes it survive lost executors, and each
landing is written to a private folder that is named by a pointer file once
it is complete (``paths.publish_once``), so a crashed or concurrent run never
exposes a partial folder.
"""

from __future__ import annotations

import hashlib
import pkgutil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.session import checkpoint_dir, configure_wide
from fareflow.sources import fixture
from fareflow.sources.bronze import stored_months
from fareflow.sources.paths import fingerprint, publish_once
from fareflow.sources.sinks import ROW_GROUP_BYTES

MARKER = "_LANDED"
# Bumped whenever the landed layout changes, so a new layout lands in a new
# folder and nothing ever has to be deleted.
LAYOUT_VERSION = "v3"


def _key(spark: SparkSession, sf_dir: str) -> str:
    """Folder key: path, size and change time of the inputs (asked of their
    own file system) and the adapter code, so changed inputs or a changed
    adapter never reuse older landed files."""
    parts = [LAYOUT_VERSION, _code_fingerprint(["sources/fixture.py", "sources/landing.py"])]
    parts += [fingerprint(spark, f"{sf_dir}/{t}.parquet") for t in ("lineitem", "nation", "region")]
    return hashlib.sha1("|".join(parts).encode()).hexdigest()[:16]


def landing_root(spark: SparkSession, sf_dir: str) -> str:
    return f"{checkpoint_dir(spark)}/fareflow/landing/{_key(spark, sf_dir)}"


def land_bronze(spark: SparkSession, sf_dir: str, base: str) -> None:
    """Write the adapter's Bronze rows under ``base/year=YYYY/month=MM/``.

    The first years are stored as older deliveries were (``DRIFT``): without
    some columns, with another name case, with integer counts.  The adapter
    rows are not month-aligned; rebalancing on the partition columns gives
    each month few files, and AQE splits a hot month over several tasks
    instead of sending it to one.  The eight columns that a trip is derived
    from are shuffled, not the trip; each task then writes its months side by
    side, without a sort.
    """
    configure_wide(spark)
    for part in landing_parts(spark, sf_dir):
        (part.write.mode("append").option("parquet.block.size", ROW_GROUP_BYTES)
         .partitionBy("year", "month").parquet(base))


def landing_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The Bronze rows in their stored shapes, one frame a shape, rebalanced by month."""
    rows = fixture.read_keyed_lineitem(spark, sf_dir)
    trips = lambda part: fixture.bronze_from_keyed(part.hint("rebalance", "year", "month"))
    # By comparing dates: the year of a row is computed only where it is kept.
    during = lambda year: ((F.col("l_shipdate") >= F.lit(f"{year}-01-01"))
                           & (F.col("l_shipdate") < F.lit(f"{int(year) + 1}-01-01")))
    shaped = [shape(trips(rows.where(during(year)))) for year, shape in fixture.DRIFT.items()]
    plain = rows
    for year in fixture.DRIFT:
        plain = plain.where(~during(year))
    return [*shaped, trips(plain)]


def bronze_base(spark: SparkSession, sf_dir: str) -> str:
    """Bronze root holding ``year=YYYY/month=MM/`` partitions (written once)."""
    base = f"{landing_root(spark, sf_dir)}/bronze/trips"
    return publish_once(spark, base, lambda folder: land_bronze(spark, sf_dir, folder), MARKER)


# Source files whose code decides the Silver rows; their content is part of
# the Silver folder key, so changed rules never reuse an older Silver.
_SILVER_CODE = ["session.py", "schema.py", "functions/expressions.py", "functions/rules.py",
                "sources/bronze.py", "sources/manifest.py", "sources/sinks.py", "operators/silver.py",
                "plans/silver_job.py"]


def _code_fingerprint(files: list[str]) -> str:
    h = hashlib.sha1()
    for rel in files:
        h.update(rel.encode() + b"\0" + pkgutil.get_data("fareflow", rel))
    return h.hexdigest()[:12]


def silver_base(spark: SparkSession, sf_dir: str) -> str:
    """Silver table (``year=/month=`` partitions) built once by the month batch
    job from the landed Bronze, as the published table the queries read."""
    from fareflow.plans.silver_job import run_silver_job

    bronze = bronze_base(spark, sf_dir)
    target = f"{landing_root(spark, sf_dir)}/silver/trips-{_code_fingerprint(_SILVER_CODE)}"
    return publish_once(
        spark, target,
        lambda folder: run_silver_job(spark, bronze, folder, stored_months(spark, bronze), force=True),
        MARKER)


_GOLD_CODE = _SILVER_CODE + ["operators/dims.py", "operators/fact.py", "operators/marts.py",
                             "plans/joins.py", "plans/gold_build.py"]


def gold_paths(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Folders of all Gold tables, built once from the published Silver."""
    from fareflow.plans import gold_build
    from fareflow.sources.tables import read_partitioned
    from fareflow.sources.zones import read_zone_lookup

    silver, zones = silver_base(spark, sf_dir), zone_csv(spark, sf_dir)
    target = f"{landing_root(spark, sf_dir)}/gold/{_code_fingerprint(_GOLD_CODE)}"
    base = publish_once(
        spark, target,
        lambda folder: gold_build.build_gold(spark, read_partitioned(spark, silver),
                                             read_zone_lookup(spark, zones), folder),
        MARKER)
    return gold_build.table_paths(base)


def zone_csv(spark: SparkSession, sf_dir: str) -> str:
    """Zone lookup as a headed CSV folder (written once)."""
    path = f"{landing_root(spark, sf_dir)}/reference/zone_lookup"
    return publish_once(
        spark, path,
        lambda folder: (fixture.read_fixture_zones(spark, sf_dir).coalesce(1)
                        .write.mode("overwrite").option("header", True).csv(folder)),
        MARKER)
