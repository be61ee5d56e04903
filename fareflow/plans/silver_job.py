"""The Bronze -> Silver batch job for a list of months (IO1 + Silver + IO7 + RC1 + DC2 + DC6 + DC7).

One scan of Bronze splits the rows of all pending months by outcome and one
write stores both sides; accepted rows become Silver, rejected rows a table
beside it.  Row counts per month come from that write.  Months already done
are skipped unless ``force`` (BM5), months that nothing was delivered for are
reported and do not hold up the others, and with a quality bound (DC6) a month
beyond it is reported before anything of it is written.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession

from fareflow.operators import months as bm
from fareflow.operators.profile import quality_gate
from fareflow.operators.silver import ACCEPTED, REJECTED, split
from fareflow.sources.bronze import month_path, read_bronze_months
from fareflow.sources.paths import has_parquet_files
from fareflow.sources.sinks import write_split_months
from fareflow.sources.tables import register_silver_table


def rejected_base(silver_base: str) -> str:
    """Where the rejected rows lie unless the caller says otherwise."""
    return f"{silver_base.rstrip('/')}_rejected"


def run_silver_job(spark: SparkSession, bronze_base: str, silver_base: str,
                   months: Iterable[tuple[int, int]], force: bool = False,
                   strict_payment_domain: bool = False, rejected: str | None = None,
                   max_critical_ratio: float | None = None, table: str | None = None) -> DataFrame:
    """Process the months; return the run summary (DC7) as a DataFrame.

    One row per requested month: ``status`` ('written', 'skipped', 'missing'
    or 'failed_gate'), the month's own bronze, silver and dropped counts (NULL
    unless written), and the output path.  ``rejected`` is the base of the
    rejected rows' table, ``table`` a catalog table that learns the written
    months.
    """
    wanted = list(dict.fromkeys((int(y), int(m)) for y, m in months))
    status = dict.fromkeys(wanted, "skipped")
    frame = bm.months_frame(spark, wanted)
    for r in bm.pending_months(spark, frame, silver_base, force).collect():
        status[int(r["year"]), int(r["month"])] = "written"
    pending = [ym for ym in wanted if status[ym] == "written"]
    with ThreadPoolExecutor(16) as pool:  # listings wait on storage
        delivered = list(pool.map(lambda ym: has_parquet_files(spark, month_path(bronze_base, *ym)), pending))
    status |= {ym: "missing" for ym, there in zip(pending, delivered) if not there}
    run = [ym for ym in pending if status[ym] == "written"]
    if run and max_critical_ratio is not None:
        gate = quality_gate(read_bronze_months(spark, bronze_base, run), max_critical_ratio)
        for r in gate.where("gate = 'failed'").collect():
            status[r["year"], r["month"]] = "failed_gate"
        run = [ym for ym in run if status[ym] == "written"]
    counts: dict = {}
    if run:
        rows = split(read_bronze_months(spark, bronze_base, run), strict_payment_domain)
        counts = write_split_months(rows, {ACCEPTED: silver_base, REJECTED: rejected or rejected_base(silver_base)}, run)
        if table:
            register_silver_table(spark, table, silver_base, run)

    def line(ym):
        own = (None, None, None)
        if status[ym] == "written":
            kept, dropped = counts.get((ACCEPTED, *ym), 0), counts.get((REJECTED, *ym), 0)
            own = (kept + dropped, kept, dropped)
        return (f"{ym[0]:04d}-{ym[1]:02d}", f"{ym[0]:04d}", f"{ym[1]:02d}", status[ym], month_path(silver_base, *ym), *own)

    return spark.createDataFrame(
        [line(ym) for ym in wanted],
        "period string, year string, month string, status string, output_path string, "
        "bronze_count long, silver_count long, dropped_count long")
