"""Substring dedup by relative Lempel-Ziv parsing (operator 7).

Every window of ``WINDOW`` words belongs to the reference block of its anchor
(see ``repeats``), so a document is factored against every indexed block that
can hold its windows and against no other.  A block is its segments in
document order; its index maps each run of ``WINDOW`` words to the place where
it comes first.  The parser walks a segment: a position whose run is indexed
earlier starts a factor, which is extended greedily, word by word, as long as
text and reference agree; the other positions are literals.  A factor of L
words marks L - WINDOW + 1 duplicate windows.  Windows that cross the end of a
factor may come from another place in the reference, so parsing goes on with
the first window that reaches over the boundary.

Words covered by a window that occurs earlier (smaller doc_id, or the same
document and an earlier start) are removed; all windows are judged on the
input, not on what is left.

Defined cases: a null text has no words; texts shorter than a window lose
nothing; rows that repeat a doc_id are the same document and give equal
results; rows without an id are returned but neither compared nor cut; an
empty table gives an empty table.  A single text may be as long as a row can
be: a worker holds one such text at a time.  Only ``doc_id`` and ``text`` are
read, so other columns, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fareflow.llm.common import Rolling, with_text
from fareflow.llm.repeats import HOT, Block, Unit, covered, repeated_windows, runs_by_row, with_runs

WINDOW = 20
GRAM = 5


def factors(block: Block, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """Duplicate runs of windows ``(doc_id, start, nwin)`` of a block's segments.

    Segments are parsed in the block's order against all that stands before
    them in it, earlier windows of the same segment included.
    """
    words = np.frombuffer(b"".join(r[4] for r in block), "<u8")
    ends = np.cumsum([len(r[4]) // 8 for r in block])
    starts = np.concatenate(([0], ends[:-1]))
    counts = ends - starts - window + 1
    seg = np.repeat(np.arange(len(block)), counts)
    pos = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + starts[seg]
    runs = Rolling(words, 6).of(pos, pos + window)
    _, first, number = np.unique(runs, return_index=True, return_inverse=True)
    source = pos[first[number]]
    marked = np.flatnonzero(source < pos)
    if not len(marked):
        return []
    at, src, owner = pos[marked], source[marked], seg[marked]
    home = np.searchsorted(ends, src, side="right")
    found = []
    i, n = 0, len(marked)
    while i < n:
        p, s, g = int(at[i]), int(src[i]), int(owner[i])
        most = min(int(ends[g]) - p, int(ends[home[i]]) - s)
        agree = words[p:p + most] == words[s:s + most]
        length = most if agree.all() else int(np.argmin(agree))
        if length >= window:
            found.append((block[g][0], block[g][1] + p - int(starts[g]), length - window + 1))
            # The next factor starts with the first window over this one's end.
            i = max(i + 1, int(np.searchsorted(at, p + length - window + 1)))
        else:
            i += 1
    return found


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept, spans)`` for every row.

    ``kept`` are the remaining words joined by one space; ``spans`` the
    removed runs as word offsets (start, end), end exclusive.
    """
    unit = Unit("words", window, gram)
    texts = with_text(docs)
    found, _ = repeated_windows(texts.where("doc_id is not null"), unit, lambda b: factors(b, window), True, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept, spans = [], [], [], []
            for text, (start, nwin) in zip(batch.column("text").to_pylist(), runs_by_row(batch)):
                words = text.encode("utf-8").split()
                gone = covered(len(words), start, nwin, window) if len(start) else np.zeros(len(words), bool)
                edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
                total.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join(w for w, g in zip(words, gone.tolist()) if not g) if len(start) else b" ".join(words))
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array([k.decode("utf-8") for k in kept], pa.string()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                names=["doc_id", "n_words", "n_removed", "kept", "spans"])

    return with_runs(texts, found).mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start:int,end:int>>")


