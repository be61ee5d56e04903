"""Interaction audit of document filters by wide packed counters (operator 12).

A document is reduced to its *mask* (which filters it fails) and two labels.
Every such state is mapped to one big integer whose fields hold the outcome
of all steps of all filter orders: 120 orders of five filters, five steps
each, six counts a step.  A part's integers are summed, each as often as the
state occurs, and the fields of the sum are the part's counts.  A field is 64
bits wide and no count exceeds the number of rows, so no sum can run over
into the next field.

The corpus is read once.  States are counted per part before anything meets
(at most 128 a part), so a part with a third of all rows is a few rows per
task.  Only the filter that looks for identical texts needs other documents:
digests, never texts, are shuffled; copies are counted per part and text
before the least id of a text is looked up.

Defined cases: a null text is empty, a null part is the empty string.  Only
rows with an id have smaller ids before them, so a row without id is never a
copy; rows that repeat the least id of their text are not copies of each
other.  Of several label rows of a document one that says 1 decides.  An empty
table has no part and gives no row.  Very long texts are read whole.  Only
``doc_id``, ``text`` and the part are read, so other columns play no part.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import let, saved

FILTERS = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
FIELD_BYTES = 8
WORD_GAP = "[ \\x09-\\x0D]+"
MARKS = "[#$%&*|]"


def failures(text: Column) -> Column:
    """Mask of the four filters that look at one text (bits 0 to 3).

    A: fewer than 50 words.  B: fewer than 65 distinct words in 100.
    C: more than 5 letters A-Z in 100 characters.  D: one of ``#$%&*|``.
    """
    def of_words(words):
        n, distinct = F.size(words), F.size(F.array_distinct(words))
        return (F.when(n < 50, 1).otherwise(0)
                + F.when(F.lit(100) * distinct < F.lit(65) * n, 2).otherwise(0))

    words = F.filter(F.split(text, WORD_GAP), lambda w: w != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return (let(words, of_words)
            + F.when(F.lit(100).cast("long") * capitals > F.lit(5) * F.length(text), 4).otherwise(0)
            + F.when(text.rlike(MARKS), 8).otherwise(0)).cast("int")


def states(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """Rows of each state: ``part, mask, good, toxic, n``.

    ``mask`` has bit i set for documents that fail filter i of ``FILTERS``.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = saved(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"), failures(text).alias("mask")), "filtered")
    marks = labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    # Rows without id have no label; kept out of the join, they cannot crowd one key of it.
    named = rows.where("doc_id is not null").join(marks, "doc_id", "left").select(
        "doc_id", "digest", "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    cell = ["digest", "part", "mask", "good", "toxic"]
    same_id = named.groupBy("doc_id", *cell).agg(F.count("*").alias("c"))
    cells = saved(same_id.groupBy(*cell).agg(F.sum("c").alias("n"), F.min(F.struct("doc_id", "c")).alias("least")), "cells")
    # A text that stands in one cell is its own first; the others look up their first.
    shared = cells.groupBy("digest").agg(F.min("least.doc_id").alias("first"), F.count("*").alias("cells")).where("cells > 1")
    first = F.coalesce(F.col("first"), F.col("least.doc_id"))
    originals = F.when(F.col("least.doc_id") == first, F.col("least.c")).otherwise(0)
    # The cells are grouped by digest already, so this join is even: a digest has at most a few cells a part.
    counted = cells.join(shared.select("digest", "first"), "digest", "left").select(
        "part", "mask", "good", "toxic", originals.alias("own"), (F.col("n") - originals).alias("copies"))
    counted = counted.groupBy("part", "mask", "good", "toxic").agg(F.sum("own").alias("own"), F.sum("copies").alias("copies"))
    both = counted.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask"), F.col("own").alias("n")),
        F.struct((F.col("mask") + 16).alias("mask"), F.col("copies").alias("n")))).alias("s")).select("part", "s.mask", "good", "toxic", "s.n")
    loose = rows.where("doc_id is null").groupBy("part", "mask").agg(F.count("*").alias("n")).select(
        "part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"), "n")
    return both.union(loose).where("n > 0").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


@lru_cache(maxsize=2)
def steps(filters: str = FILTERS) -> list[tuple[str, int, int]]:
    """(order, step, bit of its filter) for all steps of all orders, in the fields' order."""
    return [("".join(o), i + 1, filters.index(f)) for o in permutations(filters) for i, f in enumerate(o)]


@lru_cache(maxsize=1024)
def packed_outcomes(mask: int, good: bool, toxic: bool, filters: str = FILTERS) -> int:
    """The big integer of one state: a 0 or 1 for every count of every step."""
    fields = np.zeros((len(steps(filters)), len(COUNTS)), "<u8")
    for row, (order, step, bit) in enumerate(steps(filters)):
        fails = mask >> bit & 1
        before = any(mask >> filters.index(f) & 1 for f in order[:step - 1])
        removed = fails and not before
        fields[row] = (not fails and not before, removed, fails and before, mask == 1 << bit, removed and good, removed and toxic)
    return int.from_bytes(fields.tobytes(), "little")


def unpacked(total: int, filters: str = FILTERS) -> np.ndarray:
    """The fields of a sum of packed outcomes: steps x counts."""
    size = len(steps(filters)) * len(COUNTS) * FIELD_BYTES
    return np.frombuffer(total.to_bytes(size, "little"), "<u8").reshape(-1, len(COUNTS)).astype(np.int64)


_ROWS = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS) + ", shapley long"


def audit(counted: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Counts of every step of every order, per part, from counted states.

    ``shapley`` is the number of documents the step's filter removes, summed
    over all orders.
    """
    def count(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(int(n) * packed_outcomes(int(m), bool(g), bool(t), filters)
                    for m, g, t, n in zip(group["mask"], group["good"], group["toxic"], group["n"]))
        counts = unpacked(total, filters)
        bits = np.array([b for _, _, b in steps(filters)])
        by_filter = np.zeros(len(filters), np.int64)
        np.add.at(by_filter, bits, counts[:, 1])
        out = pd.DataFrame(counts, columns=COUNTS)
        out.insert(0, "part", group["part"].iloc[0])
        out.insert(1, "filter_order", [o for o, _, _ in steps(filters)])
        out.insert(2, "step", np.array([s for _, s, _ in steps(filters)], np.int32))
        out["shapley"] = by_filter[bits]
        return out

    return counted.groupBy("part").applyInPandas(count, _ROWS)
