"""Harmonic packing of documents into sequences of fixed capacity (operator 13).

Lengths are partitioned into reciprocal-capacity classes: class k takes the
lengths of which exactly k fill a sequence up to ``slack`` tokens,
``capacity - slack <= k * length <= capacity``.  A document is cut into the
fewest pieces whose lengths all belong to a class, and every class fills its
sequences with exactly k pieces.  Each task keeps its own open sequences, so
packing is a narrow map: nothing is shuffled, and no key, source or group of
copies can gather in one place.

What is still open when a task ends is bounded by the classes, not by the
data.  Those pieces are cut once more, into powers of two, and laid out from
the longest to the shortest, which fills whole sequences without a gap; the
last one is divided at powers of two, where a sequence needs no padding.

A retried task fills its sequences anew from its own partition and names them
after it, so the rows of one successful attempt always belong together.

Defined cases: a null or empty text is its closing id alone; repeated rows and
rows without id are packed like any other; an empty table gives no piece.
Very long texts become many full sequences.  Only ``id`` and ``text`` are read,
so other columns, whatever their names, play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.llm import vocab
from fareflow.llm.common import SLICE_BYTES, slices, with_text

CAPACITY = 4096
SLACK = CAPACITY // 1024
END_ID = 2
FLUSH_ROWS = 20_000
_TASK_BITS = 40

_PIECE = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
_IDS = T.StructField("ids", T.ArrayType(T.IntegerType(), False))


@lru_cache(maxsize=4)
def first_pieces(capacity: int, slack: int) -> np.ndarray:
    """For every length up to the capacity, the piece to cut from its front.

    Following the table gives the fewest pieces that all belong to a class;
    among equal numbers the longest piece comes first.
    """
    sizes = np.array([n for n in range(capacity, 0, -1) if capacity - capacity // n * n <= slack])
    pieces = np.zeros(capacity + 1, np.int64)
    first = np.zeros(capacity + 1, np.int64)
    for n in range(1, capacity + 1):
        fit = sizes[sizes <= n]
        i = int(np.argmin(pieces[n - fit]))
        first[n], pieces[n] = fit[i], pieces[n - fit[i]] + 1
    return first


class _Packer:
    """The open sequences of one task."""

    def __init__(self, capacity: int, slack: int, task: int):
        self.capacity, self.first = capacity, first_pieces(capacity, slack)
        self.open: dict[int, list] = {}
        self.next_id = task << _TASK_BITS
        self.done: list[tuple] = []

    def _close(self, pieces: list) -> None:
        """Give the pieces, in this order, the next sequence."""
        at = 0
        for doc_id, tokens, start, ids in pieces:
            n = len(ids) // 4
            self.done.append((doc_id, start, n, zlib.crc32(ids), tokens, self.next_id, at, ids))
            at += n
        self.next_id += 1

    def add(self, doc_id, ids: bytes) -> None:
        tokens, at = len(ids) // 4, 0
        while at < tokens:
            n = int(self.first[min(self.capacity, tokens - at)])
            k = self.capacity // n
            row = self.open.setdefault(k, [])
            row.append((doc_id, tokens, at, ids[4 * at:4 * (at + n)]))
            if len(row) == k:
                self._close(self.open.pop(k))
            at += n

    def finish(self) -> None:
        """Lay out what the open sequences hold, cut into powers of two."""
        parts = []
        for k in sorted(self.open):
            for doc_id, tokens, start, ids in self.open[k]:
                n, at = len(ids) // 4, 0
                while at < n:
                    part = 1 << (n - at).bit_length() - 1
                    parts.append((doc_id, tokens, start + at, ids[4 * at:4 * (at + part)]))
                    at += part
        self.open = {}
        parts.sort(key=lambda p: -len(p[3]))
        left, row, room = sum(len(p[3]) // 4 for p in parts), [], 0
        for p in parts:
            if not room:  # the next sequence: full, or the largest power of two that is left
                room = min(self.capacity, 1 << left.bit_length() - 1)
            n = len(p[3]) // 4
            row.append(p)
            room, left = room - n, left - n
            if not room:
                self._close(row)
                row = []


def pack(docs: DataFrame, model: str, capacity: int = CAPACITY, slack: int | None = None, end_id: int = END_ID,
         with_ids: bool = True, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents with their place in a sequence.

    ``model`` is the file of a tokenizer that drops white space; ``end_id`` is
    appended to the ids of every document.  ``capacity`` is a power of two and
    ``slack`` the padding a sequence may need (by default a token in 1,024).
    With ``with_ids`` each piece carries its ids.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError(f"the capacity must be a power of two, not {capacity}")
    slack = capacity // 1024 if slack is None else slack
    spark = docs.sparkSession
    shared = vocab.shared_file(spark, model)
    schema = T.StructType(_PIECE.fields + ([_IDS] if with_ids else []))
    names = schema.fieldNames()
    end = vocab.packed([end_id])

    def flush(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows))
        arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
        if with_ids:
            offsets = np.concatenate(([0], np.cumsum(columns[2]))).astype(np.int32)
            arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(columns[7]), "<i4"))))
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocab.worker_object(shared, vocab.WordEncoder)
        packer = _Packer(capacity, slack, TaskContext.get().partitionId())
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo, hi, buf, offsets in slices(batch.column(1), 4 * SLICE_BYTES):
                raw, at = buf.tobytes(), offsets.tolist()
                coded = encoder.encode([raw[s:e] for s, e in zip(at[:-1], at[1:])])
                for doc_id, found in zip(ids[lo:hi], coded):
                    packer.add(doc_id, found + end)
                if len(packer.done) >= FLUSH_ROWS:
                    yield flush(packer.done)
                    packer.done = []
        packer.finish()
        for i in range(0, len(packer.done), FLUSH_ROWS):
            yield flush(packer.done[i:i + FLUSH_ROWS])

    named = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    return with_text(named).mapInArrow(run, schema)


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """The packed sequences: ids in order, padded, and the documents in them.

    A sequence whose length is a power of two is left as it is.  A group is
    one sequence, so it holds at most ``capacity`` ids.
    """
    rows = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "start", "ids")))
    grouped = pieces.groupBy("sequence_id").agg(rows.alias("rows"), F.sum("length").alias("n_tokens"))
    power = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    ids = F.flatten(F.col("rows.ids"))
    pad = F.array_repeat(F.lit(pad_id), F.when(power, 0).otherwise(F.lit(capacity) - F.col("n_tokens")).cast("int"))
    return grouped.select("sequence_id", "n_tokens", F.concat(ids, pad).alias("ids"),
                          F.transform("rows", lambda r: F.struct(r["doc_id"].alias("doc_id"), r["start"].alias("start"),
                                                                 r["length"].alias("length"))).alias("pieces"))
