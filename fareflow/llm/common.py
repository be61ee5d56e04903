"""Helpers shared by the operators: table reads, saved tables, Arrow batches.

Every Python operator here works on Arrow batches inside tasks and cuts a
batch into slices of a quarter megabyte of text before building arrays, so the
memory of a worker does not depend on how rows fall into batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.session import checkpoint_dir

# Rows and bytes an Arrow batch may hold on its way to a Python worker.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}
SLICE_BYTES = 1 << 18

# ASCII white space: the bytes that separate words.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_MULT = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xFF51AFD7ED558CCD)
_M2 = np.uint64(0xC4CEB9FE1A85EC53)


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches and make sure a checkpoint folder is set."""
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage with a table that every executor can reach; unlike
    ``checkpoint()`` the file is columnar and compressed, which matters for
    the larger intermediate tables.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm/{uuid.uuid4().hex}/{name}"
    schema = df.schema
    df.write.parquet(path)
    table = spark.read.schema(schema).parquet(path)
    table.saved_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``saved`` that no later plan reads."""
    for table in tables:
        remove(table.sparkSession, table.saved_path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def with_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns the text operators need: id and text, null texts as ''."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


_STATE: dict = {}


def worker_state(key=None, make=None):
    """An object that a Python worker keeps from task to task, one at a time.

    A worker serves every operator of a session.  Asking for another key (or
    for none) lets go of what the operator before has cached.
    """
    if key not in _STATE:
        _STATE.clear()
        if key is not None:
            _STATE[key] = make()
    return _STATE.get(key)


def free_name(df: DataFrame, stem: str, taken: tuple[str, ...] = ()) -> str:
    """A column name that the table (and ``taken``) does not have in any case: ``stem`` or a longer one."""
    used = {c.lower() for c in (*df.columns, *taken)}
    while stem.lower() in used:
        stem += "_"
    return stem


class Shared:
    """A broadcast value with a name by which workers know it again."""

    def __init__(self, spark: SparkSession, value):
        self.name = uuid.uuid4().hex
        self.broadcast = spark.sparkContext.broadcast(value)

    @property
    def value(self):
        return self.broadcast.value


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where lambdas use it.

    An expression that stands inside the lambda of a higher-order function is
    evaluated for every element; bound this way it is a variable there.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a text column with their bytes.

    Yields ``(lo, hi, buffer, offsets)``: rows lo..hi-1, their UTF-8 bytes as
    one uint8 array, and hi-lo+1 offsets into it.  A range holds at most
    ``limit`` bytes, or one row.
    """
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[texts.offset:texts.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def word_bounds(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word, and each document's first word index."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    word = ~_SPACE[buf]
    start = word.copy()
    start[1:] &= ~word[:-1]
    end = word.copy()
    end[:-1] &= ~word[1:]
    full = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][full], offsets[1:][full] - 1
    start[first] = word[first]
    end[last] = word[last]
    ws = np.flatnonzero(start)
    return ws, np.flatnonzero(end) + 1, np.searchsorted(ws, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * _M1
    x = x ^ (x >> np.uint64(33))
    x = x * _M2
    return x ^ (x >> np.uint64(33))


_PRIME = np.uint64((1 << 31) - 1)
_BITS = np.uint64(31)


def _reduced(x: np.ndarray) -> np.ndarray:
    """Numbers below 2**62 modulo the prime 2**31 - 1."""
    x = (x & _PRIME) + (x >> _BITS)
    x = (x & _PRIME) + (x >> _BITS)
    return np.where(x >= _PRIME, x - _PRIME, x)


class Rolling:
    """Hashes of arbitrary ranges of a symbol array from prefix sums.

    Two polynomials over the field of 2**31 - 1 elements, each over its own 31
    bits of the symbols' values and at its own point, mixed with the length.
    The hash of [s, e) is the sum of value[i] * r**(i-s), so it depends on the
    symbols alone and not on where they stand.  (A polynomial modulo 2**64
    would not do: there are short words that it cannot tell apart at any odd
    point.)  ``seed`` selects independent families.
    """

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, values: np.ndarray, seed: int = 0):
        n = len(values) + 1
        points = mix(np.arange(2 * seed, 2 * seed + 2, dtype=np.uint64) * _MULT + np.uint64(1)) % (_PRIME - np.uint64(2))
        self._sides = []
        for side, r in enumerate(points.tolist()):
            pw, inv = self._table(r + 2, n)
            part = _reduced((values >> np.uint64(31 * side)) & _PRIME)
            pref = np.zeros(n, np.uint64)
            np.cumsum(_reduced(part * pw[:n - 1]), out=pref[1:])
            self._sides.append((pref, inv))

    @classmethod
    def _table(cls, r: int, n: int):
        have = cls._powers.get(r)
        if have is None or len(have[0]) < n:
            size = max(n, 1 << 16)
            prime = int(_PRIME)
            have = tuple(cls._geometric(x, size) for x in (r % prime, pow(r, -1, prime)))
            if size <= 4 << 20:
                cls._powers[r] = have
        return have

    @staticmethod
    def _geometric(r: int, size: int) -> np.ndarray:
        """1, r, r**2, ... in the field, by doubling."""
        out = np.ones(size, np.uint64)
        k = 1
        while k < size:
            m = min(k, size - k)
            out[k:k + m] = _reduced(out[:m] * np.uint64(pow(r, k, int(_PRIME))))
            k += m
        return out

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        (low, high) = (_reduced(_reduced(pref[end] - pref[start]) * inv[start]) for pref, inv in self._sides)
        return mix((high << _BITS | low) + (end - start).astype(np.uint64) * _MULT)


def byte_values(buf: np.ndarray) -> np.ndarray:
    """A random-looking 64-bit value for each byte."""
    return _BYTE_VALUE[buf]


_BYTE_VALUE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _MULT)


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost minimum of each window of ``width`` values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, pos, span = values, np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        a, b = best[:-step], best[step:]
        take = b < a
        pos = np.where(take, pos[step:], pos[:-step])
        best = np.where(take, b, a)
        span += step
    return pos[:n]
