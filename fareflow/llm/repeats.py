"""Routing of repeated windows to reference blocks (shared by operators 7 and 9).

A window is ``window`` consecutive symbols (words or bytes) of one document.
Comparing every document with every other is out of the question, so each
window is owned by its anchor: the ``gram`` symbols inside it with the least
hash, the leftmost of equal ones.  Equal windows have equal anchors at equal
places.  Consecutive windows with the same anchor form a segment, and a
segment is all that has to travel: its anchor's hash sends it to the
reference block that holds every other occurrence of its windows.

Only segments whose anchor occurs more than once go further.  Equal segments
are one row from then on, so copies of a passage cost one aggregate however
many there are.  Where an anchor has several different segments, their
symbols are fetched and compared in the block by the operator's own method.
An anchor with more than ``HOT`` different segments (a frequent phrase in ever
new surroundings) would make a block of unbounded size; its windows are told
apart one by one instead, by two 64-bit hashes in grouped aggregates that
combine before the shuffle.

Intermediate tables live in the shared checkpoint folder and are deleted as
soon as the next one is written.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm.common import Rolling, byte_values, remove, slices, sliding_argmin, word_bounds
from fareflow.session import checkpoint_dir

HOT = 2000
BLOCK_BYTES = 4 << 20

_ANCHOR, _SEGMENT, _FIRST, _SECOND, _WORD = 1, 2, 3, 4, 5


@dataclass(frozen=True)
class Unit:
    """What a window is made of."""

    kind: str      # 'words' or 'bytes'
    window: int    # symbols in a window
    gram: int      # symbols in an anchor

    @property
    def width(self) -> int:
        """Places an anchor can take in a window."""
        return self.window - self.gram + 1

    @property
    def symbol(self) -> int:
        """Bytes that one symbol takes in fetched contents."""
        return 8 if self.kind == "words" else 1


class Workspace:
    """Tables of one run under the checkpoint folder."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.base = f"{checkpoint_dir(spark)}/llm/{uuid.uuid4().hex}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        schema = df.schema
        df.write.parquet(f"{self.base}/{name}")
        del df
        self.release()
        return self.spark.read.schema(schema).parquet(f"{self.base}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            remove(self.spark, f"{self.base}/{name}")

    def release(self) -> None:
        """Let Spark clean the shuffle files of plans that nothing holds any more."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def symbols(buf: np.ndarray, offsets: np.ndarray, unit: Unit) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Values of the symbols, each document's first symbol, and byte bounds of words."""
    if unit.kind == "bytes":
        return byte_values(buf), offsets, offsets, offsets
    start, end, first = word_bounds(buf, offsets)
    return Rolling(byte_values(buf), _WORD).of(start, end), first, start, end


def segments(values: np.ndarray, first: np.ndarray, unit: Unit) -> dict[str, np.ndarray]:
    """All segments of the documents of a slice.

    ``doc`` (index in the slice), ``start`` (first window, counted in the
    document), ``nwin`` (windows), ``off`` (place of the anchor in the first
    window), ``anchor`` and ``seg`` (hashes), ``at`` (first symbol).
    """
    n = len(values) - unit.window + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return dict(doc=z, start=z, nwin=z, off=z, anchor=z, seg=z, at=z)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))[:n]
    here = np.arange(n)
    valid = here + unit.window <= first[doc + 1]
    k = np.arange(len(values) - unit.gram + 1)
    grams = Rolling(values, _ANCHOR).of(k, k + unit.gram)
    anchor = sliding_argmin(grams, unit.width)
    same = np.zeros(n, bool)
    same[1:] = valid[1:] & valid[:-1] & (anchor[1:] == anchor[:-1]) & (doc[1:] == doc[:-1])
    a = np.flatnonzero(valid & ~same)
    last = np.zeros(n, bool)
    last[:-1] = valid[:-1] & ~same[1:]
    last[-1] = valid[-1]
    b = np.flatnonzero(last)
    whole = Rolling(values, _SEGMENT).of(a, b + unit.window)
    return dict(doc=doc[a], start=a - first[doc[a]], nwin=b - a + 1, off=anchor[a] - a,
                anchor=grams[anchor[a]].view(np.int64), seg=whole.view(np.int64), at=a)


def all_segments(docs: DataFrame, unit: Unit) -> DataFrame:
    """Segments of all documents: where they are and what they hash to."""
    names = ["doc_id", "start", "nwin", "off", "anchor", "seg"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for lo, _, buf, offsets in slices(batch.column("text")):
                values, first, _, _ = symbols(buf, offsets, unit)
                s = segments(values, first, unit)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo + s["doc"]], pa.int64()), pa.array(s["start"], pa.int32()),
                     pa.array(s["nwin"], pa.int32()), pa.array(s["off"], pa.int32()),
                     pa.array(s["anchor"]), pa.array(s["seg"])], names=names)

    return docs.mapInArrow(run, "doc_id long, start int, nwin int, off int, anchor long, seg long")


def contents(docs: DataFrame, wanted: DataFrame, unit: Unit) -> DataFrame:
    """Symbols of the wanted segments, or the window hashes of hot ones.

    ``wanted`` holds per document the segments to fetch.  A segment of an
    ordinary anchor gives one row with its symbols; one of a hot anchor gives
    a row per window with two hashes and no symbols.
    """
    names = ["key", "second", "doc_id", "start", "nwin", "off", "symbols"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            lists = batch.column("want")
            bounds, flat = lists.offsets.to_numpy(), lists.values
            col = {f: flat.field(f).to_numpy(zero_copy_only=False) for f in ("start", "nwin", "off", "anchor", "hot")}
            for lo, hi, buf, offsets in slices(batch.column("text")):
                values, first, _, _ = symbols(buf, offsets, unit)
                raw = (values.astype("<u8") if unit.kind == "words" else buf).tobytes()
                part = slice(int(bounds[lo]), int(bounds[hi]))
                doc = np.repeat(np.arange(hi - lo), np.diff(bounds[lo:hi + 1]))
                at = first[doc] + col["start"][part]
                nwin, off, hot = col["nwin"][part], col["off"][part], col["hot"][part].astype(bool)
                cold = ~hot
                ends = at + nwin + unit.window - 1
                size = unit.symbol
                yield pa.RecordBatch.from_arrays(
                    [pa.array(col["anchor"][part][cold], pa.int64()), pa.array(np.zeros(cold.sum(), np.int64)),
                     pa.array(ids[lo + doc[cold]], pa.int64()), pa.array(col["start"][part][cold], pa.int32()),
                     pa.array(nwin[cold], pa.int32()), pa.array(off[cold], pa.int32()),
                     pa.array([raw[a * size:b * size] for a, b in zip(at[cold].tolist(), ends[cold].tolist())], pa.binary())],
                    names=names)
                if hot.any():
                    total = int(nwin[hot].sum())
                    which = np.repeat(np.flatnonzero(hot), nwin[hot])
                    step = np.arange(total) - np.repeat(np.cumsum(nwin[hot]) - nwin[hot], nwin[hot])
                    w = at[which] + step
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(Rolling(values, _FIRST).of(w, w + unit.window).view(np.int64)),
                         pa.array(Rolling(values, _SECOND).of(w, w + unit.window).view(np.int64)),
                         pa.array(ids[lo + doc[which]], pa.int64()), pa.array(col["start"][part][which] + step, pa.int32()),
                         pa.array(np.ones(total, np.int32)), pa.array(np.zeros(total, np.int32)),
                         pa.nulls(total, pa.binary())], names=names)

    return docs.join(wanted, "doc_id").select("doc_id", "text", "want").mapInArrow(
        run, "key long, second long, doc_id long, start int, nwin int, off int, symbols binary")


Block = list[tuple[int, int, int, int, bytes]]  # doc_id, start, nwin, off, symbols


def blocks(rows: DataFrame, compare: Callable[[Block], list[tuple[int, int, int]]]) -> DataFrame:
    """Run ``compare`` over reference blocks of whole anchors.

    The rows of an anchor arrive together and in document order; several
    anchors share a block until it holds about ``BLOCK_BYTES``.  A segment
    that repeated rows of a document fetched more than once enters once:
    nothing is compared with itself.
    """
    def done(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
        d, s, n = zip(*found) if found else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(s, pa.int32()), pa.array(n, pa.int32())],
                                          names=["doc_id", "start", "nwin"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last, place, there = [], 0, None, None, set()
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "doc_id", "start", "nwin", "off", "symbols")]
            for key, *row in zip(*columns):
                if size >= BLOCK_BYTES and key != last:
                    yield done(compare(held))
                    held, size = [], 0
                if (key, row[0], row[1]) != place:
                    place, there = (key, row[0], row[1]), set()
                last = key
                if row[-1] in there:
                    continue
                there.add(row[-1])
                held.append(tuple(row))
                size += len(row[-1])
        if held:
            yield done(compare(held))

    return rows.repartition("key").sortWithinPartitions("key", "doc_id", "start").mapInArrow(
        run, "doc_id long, start int, nwin int")


def repeated_windows(docs: DataFrame, unit: Unit, compare: Callable[[Block], list[tuple[int, int, int]]],
                     keep_first: bool, hot: int = HOT) -> tuple[DataFrame, Workspace]:
    """``(doc_id, start, nwin)``: runs of windows that occur elsewhere too.

    With ``keep_first`` the earliest occurrence of a window (least doc_id,
    then least start) is left out.  ``docs`` holds ``doc_id`` (not null) and
    ``text``.  The table returned lies in the workspace returned with it.
    """
    space = Workspace(docs.sparkSession)
    every = space.put("segments", all_segments(docs, unit))
    # Counts are tables before they are joined, so that both sides of a join are
    # plain exchanges and adaptive execution may split a hot anchor.
    shared = space.put("shared", every.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"))
    kept = space.put("kept", every.join(shared, "anchor"))
    space.drop("segments", "shared")
    place = F.struct("doc_id", "start", "nwin", "off")
    distinct = space.put("distinct", kept.groupBy("anchor", "seg").agg(
        F.min(place).alias("first"), F.max(place).alias("last")).select(
        "anchor", "seg", "first", (F.col("first") != F.col("last")).alias("many")))
    # Copies: equal segments at several places need no look at their symbols.
    copies = kept.join(distinct.where("many").select("anchor", "seg", "first"), ["anchor", "seg"])
    if keep_first:
        copies = copies.where((F.col("doc_id") != F.col("first.doc_id")) | (F.col("start") != F.col("first.start")))
    copies = space.put("copies", copies.select("doc_id", "start", "nwin"))
    space.drop("kept")
    # Different segments with one anchor.
    several = space.put("several", distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    wanted = distinct.join(several, "anchor").select(
        "first.*", "anchor", (F.col("n") > hot).alias("hot")).groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "nwin", "off", "anchor", "hot")).alias("want"))
    fetched = space.put("contents", contents(docs, wanted, unit))
    space.drop("distinct", "several")
    cold = blocks(fetched.where("symbols is not null"), compare)
    windows = fetched.where("symbols is null").select("key", "second", "doc_id", "start", "nwin")
    spot = F.struct("doc_id", "start")
    again = space.put("again", windows.groupBy("key", "second").agg(
        F.min(spot).alias("lo"), F.max(spot).alias("hi")).where("lo <> hi"))
    warm = windows.join(again, ["key", "second"])
    if keep_first:
        warm = warm.where((F.col("doc_id") != F.col("lo.doc_id")) | (F.col("start") != F.col("lo.start")))
    found = space.put("found", copies.union(cold).union(warm.select("doc_id", "start", "nwin")))
    space.drop("contents", "copies", "again")
    return found, space


def with_runs(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Documents with their found runs as an array; null where there are none."""
    runs = found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "nwin")).alias("runs"))
    return docs.join(runs, "doc_id", "left")


def covered(size: int, starts: np.ndarray, nwin: np.ndarray, window: int) -> np.ndarray:
    """Which of ``size`` symbols lie in any window of the runs."""
    delta = np.zeros(size + 1, np.int64)
    np.add.at(delta, starts, 1)
    np.add.at(delta, np.minimum(starts + nwin + window - 1, size), -1)
    return np.cumsum(delta[:-1]) > 0


def runs_by_row(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and window counts of each row's runs."""
    lists = batch.column("runs")
    bounds, flat = lists.offsets.to_numpy(), lists.values
    start = flat.field("start").to_numpy(zero_copy_only=False)
    nwin = flat.field("nwin").to_numpy(zero_copy_only=False)
    for i in range(len(lists)):
        a, b = (bounds[i], bounds[i + 1]) if lists[i].is_valid else (0, 0)
        yield start[a:b].astype(np.int64), nwin[a:b].astype(np.int64)


