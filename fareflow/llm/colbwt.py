"""Suffix-array dedup by column-wise construction (operator 9).

The suffixes of a collection are sorted by inserting one symbol per document
and round, from the last column to the first.  A round extends every suffix
by the symbol before it: a stable sort of those symbols (the round's column
of the Burrows-Wheeler transform) turns the order of the old suffixes into
the order of the new ones, and the common prefix of two neighbours is one
longer than that of their remainders, or zero if the symbols differ.

The collection of a reference block (see ``repeats``) is its segments, laid
out with their anchors in one column.  Equal windows have their anchors at
equal places, so equal windows begin in the same column: a round compares
only suffixes of its own column, and the suffixes of closed columns need not
be carried on.  That turns the quadratic cost of rewriting the whole
transform in every round into one pass over the symbols.  A window that has a
common prefix of at least ``WINDOW`` bytes with a neighbour in the order is
repeated.  The sequential external files of the construction are the sorted
shuffle blocks and Parquet tables that Spark writes between the steps; inside
a task the columns of one block, a few megabytes, are read in turn.

Bytes covered by a window that also starts anywhere else, the same document
included, are removed, all copies alike.  Windows are judged on the input.

Defined cases: null texts are empty; texts shorter than a window lose
nothing; rows that repeat a doc_id are one document; rows without an id are
returned but neither compared nor cut; an empty table gives an empty table.
What is left may cut a character in two, so it is returned as binary.  Very
long texts are read whole, one at a time in a worker.  Only ``doc_id`` and
``text`` are read, so other columns, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fareflow.llm.common import with_text
from fareflow.llm.repeats import HOT, Block, Unit, covered, repeated_windows, runs_by_row, with_runs

WINDOW = 400
GRAM = 273
_END = 256


def _columns(block: Block, window: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The block's symbols by column, anchors aligned; first column and windows of each row."""
    off = np.array([r[3] for r in block])
    nwin = np.array([r[2] for r in block])
    left = width - 1 - off
    table = np.full((width - 1 + window, len(block)), _END, np.int16)
    for i, r in enumerate(block):
        table[left[i]:left[i] + len(r[4]), i] = np.frombuffer(r[4], np.uint8)
    return table, left, nwin


def repeated(block: Block, window: int = WINDOW, width: int = WINDOW - GRAM + 1) -> list[tuple[int, int, int]]:
    """Runs of windows ``(doc_id, start, nwin)`` that another segment shares."""
    m = len(block)
    table, left, nwin = _columns(block, window, width)
    order = np.arange(m)
    common = np.zeros(m, np.int32)  # with the suffix before in the order
    flags = np.zeros((width, m), bool)
    for col in range(table.shape[0] - 1, -1, -1):
        symbol = table[col][order]
        to = np.argsort(symbol, kind="stable")
        sorted_symbol = symbol[to]
        low, high = to[:-1], to[1:]
        alike = (sorted_symbol[1:] == sorted_symbol[:-1]) & (sorted_symbol[1:] != _END)
        fresh = np.zeros(m, np.int32)
        # The remainders' common prefix is the least between their old places.
        near = alike & (high == low + 1)
        fresh[1:][near] = common[high[near]] + 1
        far = np.flatnonzero(alike & (high != low + 1))
        if len(far):
            breaks = np.concatenate(([0], np.cumsum(common == 0)))
            broken = breaks[high[far] + 1] > breaks[low[far] + 1]
            fresh[1:][far[broken]] = 1
            far = far[~broken]
            if len(far):
                ends = np.empty(2 * len(far), np.int64)
                ends[::2], ends[1::2] = low[far] + 1, high[far] + 1
                padded = np.append(common, np.int32(0))
                fresh[1:][far] = np.minimum.reduceat(padded, ends)[::2] + 1
        order, common = order[to], fresh
        if col < width:
            best = common.copy()
            best[:-1] = np.maximum(best[:-1], common[1:])
            flags[col, order[best >= window]] = True
    found = []
    starts = np.arange(width)[:, None]
    flags &= (starts >= left) & (starts < left + nwin)
    edge = np.diff(np.concatenate((np.zeros((1, m), np.int8), flags.astype(np.int8), np.zeros((1, m), np.int8))), axis=0)
    row, begin = np.nonzero(edge.T == 1)
    _, end = np.nonzero(edge.T == -1)
    for i, a, b in zip(row.tolist(), begin.tolist(), end.tolist()):
        found.append((block[i][0], block[i][1] + a - int(left[i]), b - a))
    return found


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, kept, spans)`` for every row.

    ``kept`` (binary) is what remains; ``spans`` the removed maximal runs as
    byte offsets (start, end), end exclusive.
    """
    unit = Unit("bytes", window, gram)
    texts = with_text(docs)
    found, _ = repeated_windows(texts.where("doc_id is not null"), unit,
                                lambda b: repeated(b, window, unit.width), False, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept, spans = [], [], [], []
            for text, (start, nwin) in zip(batch.column("text").to_pylist(), runs_by_row(batch)):
                raw = text.encode("utf-8")
                edge = np.zeros(0, np.int64)
                if len(start):
                    gone = covered(len(raw), start, nwin, window)
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
                cut = np.concatenate(([0], edge, [len(raw)]))
                kept.append(b"".join(raw[a:b] for a, b in zip(cut[::2].tolist(), cut[1::2].tolist())))
                total.append(len(raw))
                removed.append(len(raw) - len(kept[-1]))
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                names=["doc_id", "n_bytes", "n_removed", "kept", "spans"])

    return with_runs(texts, found).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, kept binary, spans array<struct<start:int,end:int>>")
