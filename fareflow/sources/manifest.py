"""Schema manifest of Bronze: what every file of a month stores.

A month may hold files of different schemas (a fee delivered in one of them
only, counts stored as another type).  Each file's footer is read once: files
the manifest does not know yet go through one Spark job whose tasks read the
footers, and Spark then takes the schema of one file of each kind.  The result
is kept beside the months (``base/_schemas/YYYY-MM.json``), keyed by the
names, sizes and change times of the month's files, so a later query opens no
footer and a redelivered file is looked at again.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from fareflow.sources.paths import listed_files, read_text, write_text

FOLDER = "_schemas"
# Threads of the driver that wait on storage (listings, small files).
WAITING = 16

Month = tuple[int, int]


def schema_groups(spark: SparkSession, base: str, months: Iterable[Month]) -> list[tuple[T.StructType, list[str]]]:
    """The months' files grouped by the schema they store.

    A month whose files all agree appears as its folder, another one as its
    files.  A month without files raises.
    """
    base, months = base.rstrip("/"), list(dict.fromkeys(months))
    known = month_schemas(spark, base, months)
    groups: dict[str, list[str]] = {}
    for y, m in months:
        files = known[y, m]
        folder = f"{base}/year={y:04d}/month={m:02d}"
        if not files:
            raise FileNotFoundError(f"{folder} holds no data file")
        kinds = set(files.values())
        for kind in sorted(kinds):
            paths = groups.setdefault(kind, [])
            paths += [f"{folder}/"] if len(kinds) == 1 else [f"{folder}/{n}" for n, k in files.items() if k == kind]
    return [(T.StructType.fromJson(json.loads(kind)), paths) for kind, paths in groups.items()]


def month_schemas(spark: SparkSession, base: str, months: Iterable[Month]) -> dict[Month, dict[str, str]]:
    """For every month, file name -> schema (JSON); read from the manifest where it is up to date."""
    base, months = base.rstrip("/"), list(months)
    folder = lambda ym: f"{base}/year={ym[0]:04d}/month={ym[1]:02d}"
    kept_at = lambda ym: f"{base}/{FOLDER}/{ym[0]:04d}-{ym[1]:02d}.json"
    with ThreadPoolExecutor(WAITING) as pool:
        files = dict(zip(months, pool.map(lambda ym: listed_files(spark, folder(ym)), months)))
        kept = dict(zip(months, pool.map(lambda ym: _kept(read_text(spark, kept_at(ym)), files[ym]), months)))
        stale = [ym for ym in months if kept[ym] is None]
        if stale:
            found = footer_schemas(spark, [f"{folder(ym)}/{name}" for ym in stale for name, _, _ in files[ym]])
            for ym in stale:
                kept[ym] = {name: found[f"{folder(ym)}/{name}"] for name, _, _ in files[ym]}
            list(pool.map(lambda ym: _keep(spark, kept_at(ym), files[ym], kept[ym]), stale))
    return kept


def _kept(text: str | None, files: list) -> dict[str, str] | None:
    try:
        entry = json.loads(text) if text else {}
    except ValueError:  # another session is just writing it
        return None
    if entry.get("files") != [list(f) for f in files]:
        return None
    return {f[0]: entry["schemas"][i] for f, i in zip(files, entry["of"])}


def _keep(spark: SparkSession, path: str, files: list, schemas: dict[str, str]) -> None:
    if not files:
        return
    kinds = sorted(set(schemas.values()))
    entry = {"files": files, "schemas": kinds, "of": [kinds.index(schemas[f[0]]) for f in files]}
    try:
        write_text(spark, path, json.dumps(entry))
    except Py4JJavaError:
        pass  # Bronze may be read-only; the footers are then read again


def footer_schemas(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Path -> schema as Spark reads it (JSON).

    One job reads all footers and tells the files apart by what they store;
    Spark's reader then names the schema of one file of each kind.  Files in a
    store that only Spark reaches have no footer in the job's result, and
    Spark's reader is asked for each of them.
    """
    if not paths:
        return {}
    told = {}
    tasks = max(1, min(len(paths) // 8, 4 * spark.sparkContext.defaultParallelism))
    frame = spark.createDataFrame([(p,) for p in paths], "path string").repartition(tasks)
    for row in frame.mapInArrow(_footers, "path string, kind string").collect():
        told[row["path"]] = row["kind"] or row["path"]
    first = {kind: path for path, kind in reversed(told.items())}
    with ThreadPoolExecutor(WAITING) as pool:
        schemas = dict(zip(first, pool.map(lambda p: spark.read.parquet(p).schema.json(), first.values())))
    return {path: schemas[kind] for path, kind in told.items()}


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([footer_kind(p) for p in paths], pa.string())],
                                         names=["path", "kind"])


def footer_kind(path: str) -> str | None:
    """A name for what a file's footer declares; None where only Spark can open the file."""
    import pyarrow.fs
    import pyarrow.parquet as pq

    try:
        store, name = pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
        with store.open_input_file(name) as f:
            meta = pq.read_metadata(f)
    except (OSError, pa.ArrowException, NotImplementedError):
        return None
    columns = [(c.path, c.physical_type, str(c.logical_type), c.max_definition_level, c.max_repetition_level)
               for c in (meta.schema.column(i) for i in range(meta.num_columns))]
    written = (meta.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"")
    return hashlib.sha256(repr(columns).encode() + written).hexdigest()
