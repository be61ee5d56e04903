"""SimHash near-duplicates by meet-in-the-middle ball hashing (operator 4).

Two fingerprints that differ in at most r bits meet at some value within r/2
of both, so it is enough that every fingerprint emits all values within half
the radius and that equal values are brought together by a shuffle.

Emitting the 2,081 values within two bits of a 64-bit fingerprint for every
document would multiply the table by 2,081.  The ball is therefore hashed on
each 32-bit half first: of two fingerprints at most 4 bits apart, one half
differs in at most 2 bits, so its two values meet within one bit, and a
fingerprint emits 2 x 33 values.  Fingerprints that meet in a small bucket
are paired and verified on all 64 bits.  A bucket above ``PAIR_LIMIT``
fingerprints is never paired: its members emit the whole 64-bit ball instead.
All fingerprints that meet at one 64-bit value are within 4 bits of each
other, so they are linked to the least of them, a star, with no pairs at all;
such a bucket holds at most 2,081 fingerprints, however many copies exist.

Everything works on distinct fingerprints: a million exact copies are one
row.  Defined cases: texts without words (null or empty too) have fingerprint
zero and are linked like any other; repeated rows share a component; rows
with a null id get the component of their fingerprint; an empty table gives
an empty table.  Very long texts are read whole, their shingles hashed in
chunks.  Only ``doc_id`` and ``text`` are read, so other columns, whatever
their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import discard, saved, with_text, worker_state
from fareflow.llm.graph import components

SHINGLE = 4
RADIUS = 4
SEED = 42
PAIR_LIMIT = 64
_CHUNK = 1 << 15


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the whole text, as an unsigned number."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) <= shingle:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[:len(words) - shingle + 1], ends[shingle - 1:]
    digest, seed = xxhash.xxh64_intdigest, SEED
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(starts), _CHUNK):
        h = np.array([digest(joined[a:b], seed) for a, b in
                      zip(starts[lo:lo + _CHUNK].tolist(), ends[lo:lo + _CHUNK].tolist())], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)``; fp holds the 64 bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state()
        for batch in batches:
            fp = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return with_text(docs).mapInArrow(run, "doc_id long, fp long")


def _half_ball(fps: DataFrame) -> DataFrame:
    """``(key, fp, flip)``: every 32-bit half with all values within one bit of it.

    The key carries the half's number above the value; ``flip`` is the bit
    that was changed, 0 for none.
    """
    flips = F.array(*[F.lit(0).cast("long")] + [F.lit(1 << i).cast("long") for i in range(32)])
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32)
    second = F.lit(1 << 32)
    emitted = fps.select("fp", low.alias("low"), high.alias("high"), F.explode(flips).alias("flip"))
    return emitted.select("fp", "flip", F.explode(F.array(
        F.col("low").bitwiseXOR(F.col("flip")),
        F.col("high").bitwiseXOR(F.col("flip")).bitwiseOR(second))).alias("key"))


def _close(u, v, radius: int):
    """True where members u < v of a bucket are within the radius and meet here first.

    Halves that are equal meet at themselves, halves one bit apart where the
    lesser fingerprint is unchanged, halves two bits apart where the lesser
    fingerprint changes the lower bit; so a bucket lists no pair that another
    bucket of the same half lists too.
    """
    first = F.when(v["flip"] == 0, u["flip"] == 0).otherwise(u["flip"] < v["flip"])
    return first & (F.bit_count(u["fp"].bitwiseXOR(v["fp"])) <= radius)


def _whole_ball(fps: DataFrame) -> DataFrame:
    """``(key, fp)``: all 2,081 values within two bits of the fingerprint."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    flips = [0] + [1 << i for i in range(64)]
    one = F.array(*[F.lit(signed(x)) for x in flips])
    # A second flip above the first one; flipping nothing first leaves 0 or 1 flips.
    first = fps.select("fp", F.posexplode(one).alias("i", "a"))
    rest = F.when(F.col("i") == 0, one).otherwise(F.slice(one, F.col("i") + 2, F.lit(64) - F.col("i")))
    return first.select("fp", "a", F.explode(rest).alias("b")).select(
        F.col("fp").bitwiseXOR(F.col("a")).bitwiseXOR(F.col("b")).alias("key"), "fp")


def links(fps: DataFrame, radius: int = RADIUS, pair_limit: int = PAIR_LIMIT, made: list[DataFrame] | None = None) -> DataFrame:
    """``(u, v)``: links that connect all distinct ``fp`` within ``radius`` bits.

    Every pair within the radius is connected, directly or by way of links
    that are themselves within the radius; no other fingerprints are.  The
    tables that the links are read from are added to ``made``.
    """
    if radius != 4:
        raise ValueError("the balls are laid out for a radius of 4 bits")
    # Spread over all shuffle partitions before every row becomes 66.
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ball = _half_ball(fps.repartition(parts, "fp"))
    # A table, so that both sides of the join are plain exchanges that adaptive
    # execution may split.
    sizes = saved(ball.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
    # The planner does not count what explode multiplies and might broadcast a
    # ball for the few fingerprints it comes from; hence the merge hints.
    met = saved(ball.join(sizes.hint("merge"), "key"), "met")
    if made is not None:
        made += [sizes, met]
    lists = met.where(F.col("n") <= pair_limit).groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("fp", "flip"))).alias("m"))
    near = lists.select(F.posexplode("m").alias("i", "u"), "m").select("u.fp", F.explode(F.filter(
        F.slice("m", F.col("i") + 2, F.size("m")), lambda v: _close(F.col("u"), v, radius))).alias("v")).select(
        F.col("fp").alias("u"), F.col("v.fp").alias("v")).distinct()
    crowd = met.where(F.col("n") > pair_limit).select("fp").distinct()
    whole = _whole_ball(crowd)
    hubs = whole.groupBy("key").agg(F.min("fp").alias("u"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "u")
    stars = whole.join(hubs.hint("merge"), "key").where("u <> fp").select("u", F.col("fp").alias("v")).distinct()
    return near.union(stars)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                    pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every document."""
    marks = saved(fingerprints(docs, shingle), "fingerprints")
    fps = marks.groupBy("fp").agg(F.min("doc_id").alias("first"))
    made: list[DataFrame] = []
    roots = components(links(fps.select("fp"), radius, pair_limit, made))
    discard(*made)  # the links are tables of the component search by now
    # Tables, so that the join on a root that many fingerprints share reads two
    # plain exchanges, which adaptive execution may split.
    grouped = saved(fps.join(roots, fps.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")), "grouped")
    least = saved(grouped.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    member = grouped.join(least, "root").select("fp", "component_id")
    return marks.join(member, "fp").select("doc_id", "fp", "component_id")


def report(found: DataFrame) -> DataFrame:
    """The fingerprint as 16 lower-case hexadecimal digits."""
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
