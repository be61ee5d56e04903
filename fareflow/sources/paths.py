"""File-system checks through the session's Hadoop configuration.

Works for any file system the cluster is configured for (local, HDFS,
object stores), so "does this partition exist" never depends on the
driver's local disk.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def has_parquet_files(spark: SparkSession, path: str) -> bool:
    """True if ``path`` is a folder holding at least one ``.parquet`` file."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    return any(s.getPath().getName().endswith(".parquet") for s in fs.listStatus(p))


def holds_files(spark: SparkSession, path: str) -> bool:
    """True if any ``.parquet`` file lies under ``path``, at any depth."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    files = fs.listFiles(p, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def listed_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, change time) of the data files directly under ``path``, by name.

    One listing of that folder; names that start with ``_`` or ``.`` are not
    data.
    """
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p) if s.isFile()]
    return sorted(f for f in found if not f[0].startswith(("_", ".")))


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole (overwrites)."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Put the folder ``source`` in the place of ``target``; without a source nothing is left there."""
    fs, a = _fs(spark, source)
    _, b = _fs(spark, target)
    fs.delete(b, True)
    if not fs.exists(a):
        return False
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"{source} could not be moved to {target}")
    return True


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file (overwrites an existing one)."""
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def publish_once(spark: SparkSession, target: str, write, marker: str = "_LANDED") -> str:
    """Build a table once and return the folder that holds it.

    ``write(folder)`` fills a private folder beside ``target``.  A finished
    folder is published by creating the pointer file ``target/<marker>``,
    exclusively, with the folder's name in it.  Nothing is ever renamed or
    rebuilt in place: readers follow the pointer to a complete folder, a
    crashed run leaves one that no pointer names, and of two writers that
    race the one that finds the pointer made uses the other's folder and
    deletes its own.
    """
    import uuid

    pointer = f"{target.rstrip('/')}/{marker}"
    found = _pointed(spark, pointer)
    if found:
        return f"{target.rstrip('/')}/{found}"
    name = f"v-{uuid.uuid4().hex}"
    write(f"{target.rstrip('/')}/{name}")
    fs, p = _fs(spark, pointer)
    try:
        out = fs.create(p, False)
    except Py4JJavaError:
        if not fs.exists(p):
            raise
        found = _pointed(spark, pointer, wait=60)
        delete_folder(spark, f"{target.rstrip('/')}/{name}")
        return f"{target.rstrip('/')}/{found}"
    out.write(bytearray(name.encode()))
    out.close()
    return f"{target.rstrip('/')}/{name}"


def _pointed(spark: SparkSession, pointer: str, wait: float = 0) -> str | None:
    """Name in the pointer file; None if there is no pointer.

    The file exists a moment before its content does, so an empty one is
    read again for at most ``wait`` seconds (always a few).
    """
    import time

    fs, p = _fs(spark, pointer)
    end = time.monotonic() + max(wait, 5)
    while fs.exists(p):
        stream = fs.open(p)
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        if text:
            return text
        if time.monotonic() > end:
            raise TimeoutError(f"{pointer} names no folder")
        time.sleep(0.1)
    return None


def fingerprint(spark: SparkSession, path: str) -> str:
    """What a file or folder holds, told by its qualified path, size and newest change."""
    fs, p = _fs(spark, path)
    newest = size = 0
    if fs.exists(p):
        files = fs.listFiles(p, True)
        while files.hasNext():
            f = files.next()
            newest, size = max(newest, f.getModificationTime()), size + f.getLen()
    return f"{fs.makeQualified(p).toString()}:{size}:{newest}"
