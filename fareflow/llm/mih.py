"""Exact top-k search of binary codes by incremental multi-index hashing (operator 1).

A vector's code holds the signs of its coordinates.  The 64 bits are cut into
pieces of about log2(number of codes) bits, so that a probe meets a bounded
number of codes however many there are, and a table maps every value of every
piece to the codes that have it there.  If two codes differ in at most m(r + 1) - 1 bits, one of
their m pieces differs in at most r bits; so round r probes, in every piece,
all values exactly r bits from the query's and meets every code that the
earlier rounds could not exclude.  A candidate is kept where it is met first
(the least piece distance, then the lowest piece), which makes it unique
without a distinct.  A query leaves the search as soon as its k best rows are
no further than the distance the finished rounds provably cover; the others
go on with the next radius, and from then on the join itself drops candidates
beyond their k + 1 best codes so far.  Where few wide pieces would need more
than ``PROBES`` values in a round, the queries that are still open (those with
no near neighbours) go on with ``SEGMENTS`` narrower pieces from radius 0,
under the bound they have reached.

Codes, not rows, are indexed and searched: equal codes are one entry with its
k + 1 least ids, since no result can hold more of them.  Those ids come from
a ranking that is limited before the shuffle, so one code may belong to any
share of all rows.  One number per round, the count of open queries, reaches
the driver.

Results are ordered by distance, then id; a row is not its own neighbour.
Defined cases: rows without id or vector are neither queries nor results;
null and NaN coordinates count as not positive; repeated rows are one; vectors of
more than 64 coordinates are folded (coordinate j adds to bit j modulo 64);
fewer than k other rows give all of them; an empty table gives no results.
"""

from __future__ import annotations

from itertools import takewhile
from math import comb, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.common import discard, saved

BITS = 64
SEGMENTS = 4
PROBES = 1 << 18
K = 10


def sign_code(vector: Column) -> Column:
    """64 signs of a vector as a long; bit i for coordinate i."""
    bits = [1 << i if i < BITS - 1 else -(1 << i) for i in range(BITS)]
    none = F.lit(0).cast("long")
    table = F.lit(bits).cast("array<long>")

    def folded(i):
        total = F.aggregate(F.filter(vector, lambda x, j: j % BITS == i), F.lit(0.0),
                            lambda acc, x: acc + F.coalesce(F.nanvl(x.cast("double"), F.lit(0.0)), F.lit(0.0)))
        return F.when(total > 0, F.lit(bits[i]).cast("long")).otherwise(none)
    plain = F.aggregate(F.transform(vector, lambda x, j: F.when((x > 0) & ~F.isnan(x), F.element_at(table, j + 1)).otherwise(none)),
                        none, lambda acc, x: acc.bitwiseOR(x))
    long = none
    for i in range(BITS):
        long = long.bitwiseOR(folded(i))
    return F.when(F.size(vector) <= BITS, plain).otherwise(long)


def codes(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(id, code)`` of every row that has both."""
    return vectors.where(F.col(id_col).isNotNull() & F.col(vector).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), sign_code(F.col(vector)).alias("code"))


def segments_for(n_codes: int) -> int:
    """Pieces of about log2(n) bits: four for small tables, two for billions of codes."""
    return min(SEGMENTS, max(2, round(BITS / max(1.0, log2(max(2, n_codes))))))


def _cuts(segments: int) -> list[tuple[int, int]]:
    """(first bit, width) of every piece, as equal as possible."""
    base, more = divmod(BITS, segments)
    widths = [base + (i < more) for i in range(segments)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def _radii(segments: int, probes: int) -> list[int]:
    """Radii to search with so many pieces: all of them, or while a piece needs no more than ``probes`` values."""
    width = _cuts(segments)[0][1]
    return list(takewhile(lambda r: segments >= SEGMENTS or comb(width, r) <= probes, range(width + 1)))


def _pieces(code: str, segments: int) -> Column:
    """Piece values, the piece's number above the 32 bits that a value may take."""
    return F.array(*[F.shiftrightunsigned(F.col(code), start).bitwiseAND(F.lit((1 << width) - 1))
                     .bitwiseOR(F.lit(i << 32)) for i, (start, width) in enumerate(_cuts(segments))])


def _met_first(segments: int, radius: int) -> Column:
    """True where piece ``seg`` is the first at the least piece distance, ``radius``."""
    away = F.col("q").bitwiseXOR(F.col("code"))
    first = F.lit(True)
    for i, (start, width) in enumerate(_cuts(segments)):
        d = F.bit_count(F.shiftrightunsigned(away, start).bitwiseAND(F.lit((1 << width) - 1)))
        first = first & F.when(F.col("seg") > i, d > radius).when(F.col("seg") < i, d >= radius).otherwise(F.lit(True))
    return first


def _probes(still: DataFrame, segments: int, radius: int) -> DataFrame:
    """``(q, bound, seg, key)``: all piece values exactly ``radius`` bits from the query's.

    Bits are flipped in ascending order, one ``explode`` for each.
    """
    widths = F.array(*[F.lit(w) for _, w in _cuts(segments)])
    flipped = still.select("q", "bound", F.posexplode(_pieces("q", segments)).alias("seg", "key")).select(
        "q", "bound", "seg", "key", F.element_at(widths, F.col("seg") + 1).alias("width"), F.lit(-1).alias("bit")).where(
        F.col("width") >= radius)
    for left in range(radius, 0, -1):
        flipped = flipped.select("q", "bound", "seg", "key", "width", F.explode(
            F.sequence(F.col("bit") + 1, F.col("width") - left)).alias("bit")).select(
            "q", "bound", "seg", F.expr("key ^ shiftleft(1L, bit)").alias("key"), "width", "bit")
    return flipped.select("q", "bound", "seg", "key")


def search(rows: DataFrame, queries: DataFrame, k: int = K, segments: int | None = None, probes: int = PROBES) -> DataFrame:
    """``(query_id, rank, id, distance)``: the k nearest rows of every query.

    ``rows`` and ``queries`` hold ``(id, code)``; a row with the query's id is
    left out.  ``segments`` is the number of pieces to begin with (two to
    eight; chosen from the number of codes if not given).
    """
    least = Window.partitionBy("code").orderBy("id")
    entries = saved(rows.distinct().withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1).groupBy("code").agg(
        F.sort_array(F.collect_list("id")).alias("ids")), "entries")
    n_codes = entries.count()
    wanted = saved(queries.distinct(), "queries")
    still = saved(wanted.select(F.col("code").alias("q")).distinct().withColumn("bound", F.lit(BITS)), "open")
    kind = "q long, code long, least long, rows int, distance int"
    order = Window.partitionBy("q").orderBy("distance", "least")
    whole = Window.partitionBy("q")
    finished = []
    first = segments or segments_for(n_codes)
    rounds = [(m, radius) for m in dict.fromkeys((first, max(first, SEGMENTS))) for radius in _radii(m, probes)]
    pieces = 0
    for m, radius in rounds:
        if m != pieces:
            if pieces:
                discard(index)
            pieces = m
            index = saved(entries.select("code", F.element_at("ids", 1).alias("least"), F.size("ids").alias("rows"),
                                         F.explode(_pieces("code", m)).alias("key")), f"index{m}")
            best = rows.sparkSession.createDataFrame([], kind)
        # The planner does not count what explode multiplies and would broadcast
        # the probes for the few queries they come from; hence the hint.
        distance = F.bit_count(F.col("q").bitwiseXOR(F.col("code")))
        found = _probes(still, m, radius).join(index.hint("merge"), "key").where(
            _met_first(m, radius) & (distance <= F.col("bound"))).select(
            "q", "code", "least", "rows", distance.alias("distance"))
        ranked = best.union(found).withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).drop("n")
        covered = m * (radius + 1) - 1
        sure = F.sum(F.when(F.col("distance") <= covered, F.col("rows")).otherwise(0)).over(whole) >= k + 1
        every = F.count(F.lit(1)).over(whole) >= n_codes
        state = saved(ranked.withColumn("done", sure | every | F.lit(radius == _cuts(m)[0][1])), f"best{m}-{radius}")
        finished.append(state.where("done").drop("done"))
        best = state.where("not done").drop("done")
        # Once k + 1 codes are known, nothing beyond the last of them matters.
        last = best.groupBy("q").agg(F.when(F.count(F.lit(1)) > k, F.max("distance")).alias("last"))
        asked = still
        still = saved(still.join(finished[-1].select("q").distinct(), "q", "left_anti").join(last, "q", "left").select(
            "q", F.coalesce("last", "bound").alias("bound")), f"open{m}-{radius}")
        discard(asked)
        if not still.limit(1).count():
            break
    discard(index, still)
    nearest = finished[0]
    for more in finished[1:]:
        nearest = nearest.union(more)
    # From the best codes to rows, and from codes asked for to queries.
    spread = nearest.join(entries, "code").select("q", "distance", F.explode("ids").alias("id"))
    by_row = Window.partitionBy("q").orderBy("distance", "id")
    spread = spread.withColumn("n", F.row_number().over(by_row)).where(F.col("n") <= k + 1)
    per_code = spread.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("distance", "id"))).alias("near"))
    answers = wanted.join(per_code, F.col("code") == F.col("q"))
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, k)
    return answers.select(F.col("id").alias("query_id"), F.posexplode(others).alias("rank", "hit")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.id").alias("id"), F.col("hit.distance").alias("distance"))
