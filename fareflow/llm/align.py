"""Alignment of two tokenizations by lockstep merging (operator 11).

Both tokenizers cover the same bytes: a space and the text.  The byte offsets
where a token of A and a token of B both end cut the text into groups, and the
two tokens that end there are *linked*.  A batch of documents is merged at
once: a state vector holds the pointers into A and B of every document, and
each step advances the pointer of the token that ends first, or both at a cut.
Documents that are through drop out of the vector.  A long document takes part
in stretches, each with pointers of its own, so the number of steps follows
the stretch and not the longest text.

How often a pair of ids is linked is counted over the whole corpus.  Of two
tokens that end together one is a suffix of the other, so the pairs that can
occur follow from the two vocabularies alone (about half a million here,
however large the corpus).  That bounds the table of counts, which is sent to
all tasks; documents are never shuffled.  Per document only its pair numbers
and how often they occur are kept between the two passes.

Defined cases: a null or empty text, and a text that one of the tokenizers does
not give back byte for byte, has no tokens: zeros and empty strings.  Repeated
rows are aligned and counted like any other, rows without id too.  An empty
table gives an empty table.  Only ``doc_id`` and ``text`` are read, so other
columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.llm import vocab
from fareflow.llm.common import SLICE_BYTES, Shared, saved, slices, with_text, worker_state

STRETCH = 2048
CHUNKS = 500_000
_SHIFT = 16  # both vocabularies have fewer ids than that many bits count


class Vocabularies:
    """Token bytes of both sides and the pairs of ids that can be linked."""

    def __init__(self, a: list[bytes], b: list[bytes], pairs: np.ndarray | None = None):
        self.len_a = np.array([len(t) for t in a], np.int64)
        self.len_b = np.array([len(t) for t in b], np.int64)
        self.bytes_a, self.bytes_b = a, b
        if max(len(a), len(b)) > 1 << _SHIFT:
            raise ValueError("a vocabulary has more ids than a pair number holds")
        if pairs is None:
            pairs = np.unique(np.concatenate([_suffix_pairs(a, b, False), _suffix_pairs(b, a, True)]))
        self.pairs = pairs



def _suffix_pairs(long: list[bytes], short: list[bytes], swap: bool) -> np.ndarray:
    """Pairs in which the token of ``short`` is a suffix of that of ``long``."""
    ids: dict[bytes, list[int]] = {}
    for i, t in enumerate(short):
        if t:
            ids.setdefault(t, []).append(i)
    found = [(j, i) if swap else (i, j) for i, t in enumerate(long)
             for at in range(len(t)) for j in ids.get(t[at:], ())]
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pairs[:, 0] << _SHIFT | pairs[:, 1]


def merge(ends_a: np.ndarray, ends_b: np.ndarray, bounds_a: np.ndarray, bounds_b: np.ndarray,
          stretch: int = STRETCH) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the linked tokens of all documents of a batch.

    ``ends_*`` are ascending byte offsets over the whole batch, ``bounds_*``
    each document's first token.  Documents cover the same bytes on both sides
    and lie one behind the other.  Returns the positions in A and in B, in
    order; every link is a cut.
    """
    if not len(ends_a):
        z = np.zeros(0, np.int64)
        return z, z
    # Stretches: for every document the byte offsets at which its lanes begin.
    stop = ends_a[bounds_a[1:] - 1]
    first = np.concatenate(([0], stop[:-1]))
    lanes = (stop - first + stretch - 1) // stretch
    of = np.repeat(np.arange(len(stop)), lanes)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    begin = first[of] + nth * stretch
    end = np.minimum(begin + stretch, stop[of])
    # The state vector: next token of A and of B, one entry a lane.
    a = np.searchsorted(ends_a, begin, side="right")
    b = np.searchsorted(ends_b, begin, side="right")
    links_a, links_b = [], []
    ends_a = np.append(ends_a, np.iinfo(np.int64).max)
    ends_b = np.append(ends_b, np.iinfo(np.int64).max)
    while len(a):
        at_a, at_b = ends_a[a], ends_b[b]
        live = np.minimum(at_a, at_b) <= end
        if not live.all():  # lanes that are through leave the vector
            a, b, end, at_a, at_b = a[live], b[live], end[live], at_a[live], at_b[live]
        cut = at_a == at_b
        links_a.append(a[cut])
        links_b.append(b[cut])
        a = a + (at_a <= at_b)
        b = b + (at_b <= at_a)
    links_a, links_b = np.concatenate(links_a), np.concatenate(links_b)
    order = np.argsort(links_a, kind="stable")
    return links_a[order], links_b[order]


class _Aligner:
    """Both tokenizers of a worker, with the ids of the chunks it remembers."""

    def __init__(self, model_a: bytes, model_b: bytes, pairs: np.ndarray):
        self.a, self.b = vocab.ByteLevel(model_a), vocab.Pieces(model_b)
        self.words = Vocabularies(self.a.token_bytes(), self.b.token_bytes(), pairs)
        self.known = vocab.Remembered(CHUNKS)
        self.digits = _digits(max(len(self.words.len_a), len(self.words.len_b)))

    def _learn(self, chunks: list[bytes]) -> dict:
        """Ids of chunks not met before; ``False`` where a tokenizer does not give the bytes back."""
        texts = [c.decode("utf-8") for c in chunks]
        sides = ((self.a(texts), self.words.bytes_a), (self.b(texts), self.words.bytes_b))
        want = b" " + b" ".join(chunks)
        same = [True] * len(chunks)
        for ids, table in sides:
            if b"".join(map(table.__getitem__, chain.from_iterable(ids))) != want:
                same = [s and b"".join(map(table.__getitem__, i)) == b" " + c for s, i, c in zip(same, ids, chunks)]
        return {c: (vocab.packed(a), vocab.packed(b)) if s else False
                for c, a, b, s in zip(chunks, sides[0][0], sides[1][0], same)}

    def encode(self, texts: list[bytes]) -> list[tuple[bytes, bytes] | None]:
        """Packed ids of every text behind a space by A and by B."""
        found = self.known.look_up([vocab.chunks(t) if t else [] for t in texts], self._learn)
        return [None if not f or False in f else (b"".join(a for a, _ in f), b"".join(b for _, b in f)) for f in found]


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0..n-1 as rows of characters, with room for a separator."""
    text = [str(i).encode() for i in range(n)]
    width = len(text[-1]) + 1
    return (np.frombuffer(b"".join(t.ljust(width, b"\0") for t in text), np.uint8).reshape(n, width),
            np.array([len(t) for t in text], np.int64))


def _groups_text(ids_a, ids_b, link_a, link_b, digits, first_link) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` of all documents in one array, and each document's end.

    Tokens are laid out group by group, A before B; each is followed by the
    separator that belongs there, except the last of its document.
    """
    table, width = digits
    n_a, n_b = len(ids_a), len(ids_b)
    # A token's group is the one that the next link at or behind it closes.
    size_a = np.diff(link_a, prepend=-1)
    size_b = np.diff(link_b, prepend=-1)
    place_a = np.arange(n_a) + np.repeat(np.concatenate(([0], link_b[:-1] + 1)), size_a)
    place_b = np.arange(n_b) + np.repeat(link_a + 1, size_b)
    ids = np.empty(n_a + n_b, np.int64)
    ids[place_a], ids[place_b] = ids_a, ids_b
    rows, long = table[ids], width[ids]
    mark = np.full(len(ids), ord(","), np.uint8)
    mark[place_a[link_a]] = ord("|")
    mark[place_b[link_b]] = ord(";")
    mark[place_b[link_b[first_link[1:] - 1]]] = 0
    rows[np.arange(len(ids)), long] = mark
    kept = rows != 0
    ends = np.cumsum(kept.sum(axis=1))
    return rows[kept], ends[place_b[link_b[first_link[1:] - 1]]]


_FOUND = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()),
    T.StructField("n_groups", T.LongType()), T.StructField("n_links", T.LongType()),
    T.StructField("groups_sha256", T.StringType()),
    T.StructField("pairs", T.ArrayType(T.IntegerType(), False)), T.StructField("times", T.ArrayType(T.IntegerType(), False))])


def _align_slice(aligner: _Aligner, ids: list, buf: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    """One row a document of a slice."""
    n = len(offsets) - 1
    raw, at = buf.tobytes(), offsets.tolist()
    coded = aligner.encode([raw[s:e] for s, e in zip(at[:-1], at[1:])])
    have = [i for i, c in enumerate(coded) if c is not None]
    words = aligner.words
    counts = np.zeros((n, 4), np.int64)
    digest = [""] * n
    pairs_at = np.zeros(n, np.int64)
    numbers = times = np.zeros(0, np.int32)
    if have:
        ids_a = np.frombuffer(b"".join(coded[i][0] for i in have), "<u4").astype(np.int64)
        ids_b = np.frombuffer(b"".join(coded[i][1] for i in have), "<u4").astype(np.int64)
        bound_a = np.concatenate(([0], np.cumsum([len(coded[i][0]) // 4 for i in have])))
        bound_b = np.concatenate(([0], np.cumsum([len(coded[i][1]) // 4 for i in have])))
        link_a, link_b = merge(np.cumsum(words.len_a[ids_a]), np.cumsum(words.len_b[ids_b]), bound_a, bound_b)
        first_link = np.searchsorted(link_a, bound_a)
        text, ends = _groups_text(ids_a, ids_b, link_a, link_b, aligner.digits, first_link)
        starts = np.concatenate(([0], ends[:-1]))
        links = np.diff(first_link)
        counts[have] = np.stack([np.diff(bound_a), np.diff(bound_b), links, links], axis=1)
        for i, s, e in zip(have, starts.tolist(), ends.tolist()):
            digest[i] = hashlib.sha256(text[s:e]).hexdigest()
        # A document's pairs, each once with its number of links.
        of = np.repeat(np.arange(len(have)), links)
        both, times = np.unique(of << 2 * _SHIFT | ids_a[link_a] << _SHIFT | ids_b[link_b], return_counts=True)
        numbers = np.searchsorted(words.pairs, both & (1 << 2 * _SHIFT) - 1).astype(np.int32)
        times = times.astype(np.int32)
        pairs_at[have] = np.bincount(both >> 2 * _SHIFT, minlength=len(have))
    lists = pa.array(np.concatenate(([0], np.cumsum(pairs_at))).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64())] + [pa.array(counts[:, i]) for i in range(4)] + [
            pa.array(digest, pa.string()), pa.ListArray.from_arrays(lists, pa.array(numbers, pa.int32())),
            pa.ListArray.from_arrays(lists, pa.array(times, pa.int32()))], names=_FOUND.fieldNames())


def _models(model_a: str, model_b: str) -> tuple[bytes, bytes]:
    with open(model_a, "rb") as a, open(model_b, "rb") as b:
        return a.read(), b.read()


def vocabularies(model_a: str, model_b: str) -> Vocabularies:
    a, b = _models(model_a, model_b)
    return Vocabularies(vocab.ByteLevel(a).token_bytes(), vocab.Pieces(b).token_bytes())


def links(docs: DataFrame, model_a: str, model_b: str, words: Vocabularies | None = None) -> DataFrame:
    """Tokens, groups and linked pairs of every document, one row each.

    ``pairs`` are numbers of pairs (positions in ``Vocabularies.pairs``), each
    once, and ``times`` how many links of the document hold it.
    """
    words = words or vocabularies(model_a, model_b)
    shared = Shared(docs.sparkSession, (*_models(model_a, model_b), words.pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_state((shared.name, "align"), lambda: _Aligner(*shared.value))
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo, hi, buf, offsets in slices(batch.column(1), 4 * SLICE_BYTES):
                yield _align_slice(aligner, ids[lo:hi], buf, offsets)

    return with_text(docs).mapInArrow(run, _FOUND)


def _counts(found: DataFrame) -> DataFrame:
    """Links of the corpus by number of pair."""
    return found.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).groupBy(
        F.col("p.pairs").alias("pair")).agg(F.sum("p.times").cast("long").alias("links"))


def alignment(docs: DataFrame, model_a: str, model_b: str) -> DataFrame:
    """Groups and links of every document, weighed by the corpus-wide counts.

    ``count_sum`` adds up the counts of a document's links; ``n_best`` counts
    the links of which no other pair with the same B id is more frequent.
    """
    spark = docs.sparkSession
    words = vocabularies(model_a, model_b)
    found = saved(links(docs, model_a, model_b, words), "aligned")
    counted = _counts(found).toArrow()  # at most as many rows as the vocabularies have pairs
    total = np.zeros(len(words.pairs), np.int64)
    total[counted.column("pair").to_numpy()] = counted.column("links").to_numpy()
    of_b = words.pairs & (1 << _SHIFT) - 1
    most = np.zeros(len(words.len_b), np.int64)
    np.maximum.at(most, of_b, total)
    counts = Shared(spark, (total, total == most[of_b]))
    schema = T.StructType([f for f in _FOUND if f.name not in ("pairs", "times")]
                          + [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, best = counts.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times")
            number, n = pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            bounds = np.concatenate(([0], np.cumsum(pc.list_value_length(pairs).to_numpy())))
            sums = [np.concatenate(([0], np.cumsum(v))) for v in (best[number] * n, total[number] * n)]
            rows = [batch.column(c) for c in _FOUND.fieldNames()[:6]] + [pa.array(s[bounds[1:]] - s[bounds[:-1]]) for s in sums]
            yield pa.RecordBatch.from_arrays(rows, names=schema.fieldNames())

    return found.mapInArrow(run, schema)


def pair_counts(docs: DataFrame, model_a: str, model_b: str) -> DataFrame:
    """How many links of the corpus hold each pair: ``a_id, b_id, links``."""
    words = vocabularies(model_a, model_b)
    names = docs.sparkSession.createDataFrame(pa.table({
        "pair": np.arange(len(words.pairs), dtype=np.int32), "a_id": words.pairs >> _SHIFT,
        "b_id": words.pairs & (1 << _SHIFT) - 1}))
    return _counts(links(docs, model_a, model_b, words)).join(names, "pair").select("a_id", "b_id", "links")
