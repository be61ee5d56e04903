"""Byte-level BPE encoding and decoding (operator 8).

Each match of the splitting pattern is encoded on its own.  A segment tree
over the byte positions of the piece stores, for every node, the leftmost
position whose pair (the live part starting there and the next live part)
has the smallest rank.  The root therefore names the next merge; a merge
touches the merged position, the neighbour that disappears and the live part
to the left, each a point update of logarithmic cost (16 children a node).  A piece of n bytes
costs O(n log n) however many merges it takes, so one enormous word is safe.

Defined cases: a null or empty text gives no ids and decodes to empty bytes;
repeated rows are encoded independently; an empty table gives an empty table
of the same schema.  Other columns pass through under their own names, unless
they are called like an output column, which then replaces them.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fareflow.llm.common import Shared, worker_state

_NONE = 1 << 62
_FAN = 16
_SHIFT = 32
_MASK = (1 << _SHIFT) - 1

# A worker keeps the ids of this many distinct short pieces; older entries are
# forgotten all at once.  It bounds memory and changes no result.
CACHE_PIECES = 500_000
CACHE_CHARS = 64


@lru_cache(maxsize=1)
def load_ranks(path: str) -> dict[bytes, int]:
    """Rank file: one base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece by lowest-rank, leftmost-first merges.

    The tree is wide: every node stands for 16 below it and holds the least
    of their keys, which ``min`` finds in one call.  A key is
    ``rank << 32 | position``, so the smaller one is the lower rank and,
    between equal ranks, the pair further left.
    """
    get = ranks.get
    whole = get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    nxt = list(range(1, n + 2))
    prv = list(range(-1, n))
    leaves = [_NONE if (r := get(piece[i:i + 2])) is None else r << _SHIFT | i for i in range(n)]
    leaves[n - 1] = _NONE
    levels = [leaves]
    while len(levels[-1]) > _FAN:
        low = levels[-1]
        levels.append([min(low[i:i + _FAN]) for i in range(0, len(low), _FAN)])
    top, inner = levels[-1], levels[1:]
    root = min(top)
    while root < _NONE:
        i = root & _MASK
        j = nxt[i]
        k = nxt[i] = nxt[j]
        prv[k] = i
        # The pairs that change: the vanished neighbour's, the merged part's
        # with what follows it, and the one that the part to the left begins.
        leaves[j] = _NONE
        r = get(piece[i:nxt[k]]) if k < n else None
        leaves[i] = _NONE if r is None else r << _SHIFT | i
        h = prv[i]
        if h >= 0:
            r = get(piece[h:k])
            leaves[h] = _NONE if r is None else r << _SHIFT | h
        if inner:
            low, at = leaves, {i // _FAN, j // _FAN, max(h, 0) // _FAN}
            for level in inner:
                for x in at:
                    level[x] = min(low[x * _FAN:(x + 1) * _FAN])
                low, at = level, {x // _FAN for x in at}
        root = min(top)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:nxt[i]]])
        i = nxt[i]
    return ids


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {r: b for b, r in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.cache: dict[str, list[int]] = {}

    def encode(self, text: str) -> array:
        out = array("i")
        extend, get = out.extend, self.cache.get
        for piece in self.split(text):
            ids = get(piece)
            if ids is None:
                ids = array("i", merge_piece(piece.encode("utf-8"), self.ranks))
                if len(piece) <= CACHE_CHARS:
                    if len(self.cache) >= CACHE_PIECES:
                        self.cache.clear()
                    self.cache[piece] = ids
            extend(ids)
        return out


def _encoder(shared, pattern: str) -> Encoder:
    """One encoder per Python worker, kept from task to task."""
    return worker_state((shared.name, pattern), lambda: Encoder(shared.value, pattern))


def _replace(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in schema if f.name != name] + [T.StructField(name, kind)])


def _column(batch: pa.RecordBatch, schema: T.StructType, values: pa.Array) -> pa.RecordBatch:
    kept = [f.name for f in schema][:-1]
    return pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [values],
                                      names=[f.name for f in schema])


def _lists(parts: list, value_type: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate([np.frombuffer(p, np.int32) for p in parts if len(p)]) if offsets[-1] else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, value_type))


def _encoded(texts: pa.Array, encoder: Encoder) -> pa.Array:
    return _lists([encoder.encode(t or "") for t in texts.to_pylist()], pa.int32())


def _decoded(ids: pa.Array, encoder: Encoder) -> list[bytes]:
    values, offs = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
    table = encoder.tokens
    return [b"".join(map(table.__getitem__, values[a:b].tolist())) for a, b in zip(offs[:-1], offs[1:])]


def _shared(df: DataFrame, ranks_path: str) -> Shared:
    """The ranks on every executor; their size is that of the vocabulary, not of the data."""
    return Shared(df.sparkSession, load_ranks(ranks_path))


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``: the token ids (array<int>) of the whole text.

    The rank file is read once by the caller's process and sent to the
    executors.
    """
    shared = _shared(df, ranks_path)
    schema = _replace(df.schema, ids, T.ArrayType(T.IntegerType(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared, pattern)
        for batch in batches:
            yield _column(batch, schema, _encoded(batch.column(text), encoder))

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add ``decoded``: the bytes (binary) that ``ids`` stand for."""
    shared = _shared(df, ranks_path)
    schema = _replace(df.schema, decoded, T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared, pattern)
        for batch in batches:
            yield _column(batch, schema, pa.array(_decoded(batch.column(ids), encoder), pa.binary()))

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``encode`` and then ``decode`` in one pass, with what they came to.

    Adds ``ids``, ``n_tokens``, ``ids_sha256`` (of the ids as little-endian
    unsigned 32-bit integers), ``decoded_sha256`` (of the decoded bytes) and
    ``exact`` (they are the text's bytes).
    """
    shared = _shared(df, ranks_path)
    added = [T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("n_tokens", T.LongType()),
             T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
             T.StructField("exact", T.BooleanType())]
    new = {f.name for f in added}
    kept = [f for f in df.schema if f.name not in new]
    schema = T.StructType(kept + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared, pattern)
        for batch in batches:
            ids = _encoded(batch.column("text"), encoder)
            values, offs = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            packed = [hashlib.sha256(values[a:b].astype("<u4").tobytes()).hexdigest() for a, b in zip(offs[:-1], offs[1:])]
            back = _decoded(ids, encoder)
            same = [b == (t or "").encode("utf-8") for b, t in zip(back, batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [
                    ids, pa.array(np.diff(offs), pa.int64()), pa.array(packed, pa.string()),
                    pa.array([hashlib.sha256(b).hexdigest() for b in back], pa.string()), pa.array(same, pa.bool_())],
                names=[f.name for f in schema])

    return df.mapInArrow(run, schema)
