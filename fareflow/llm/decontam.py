"""Benchmark decontamination by templates (operator 10, built-in functions only).

Texts are cut into letter runs and numbers, and every token is reduced to a
template token: numbers become ``<num>``, a unit behind a number ``<unit>``,
a capitalised word inside a sentence ``<name>``, and any other word its lower
case.  Windows of ``WINDOW`` template tokens of the documents are hash-joined
to those of the benchmark, so that a question whose figures or names were
exchanged still matches.  Windows with fewer than ``LITERAL`` plain words say
too little as templates, so they are indexed by their literal tokens (lower
case, whatever their type), and so is the whole of an item of fewer than
``WINDOW`` tokens.

A document and an item that share windows are then checked slot by slot, one
occurrence at a time.  Windows at one shift (place in the document less place
in the item) are aligned and form an occurrence.  A copy with words put in or
left out drifts, so shifts less than ``DRIFT`` apart are also pooled (on two
grids, half a step apart), and so are all windows of the pair.  In a
re-parameterised copy each placeholder is filled consistently: wherever the
item has one value, the occurrence has one value.  ``CONSISTENT`` of the
item's distinct slot values must pass.  An item leaks into a document if any
occurrence passes that and holds at least ``COVER`` of the item's windows, or
``ENOUGH`` of them (``WINDOW + ENOUGH - 1`` running tokens); counted over its
template windows alone, where it has any, or over all of them.

The document side of the first join carries a hash, an id and a position per
window (and again per length of the literal windows that the benchmark has, at
most ``WINDOW`` lengths) and joins the benchmark's windows by hash: broadcast while the counted
windows are at most ``BROADCAST_ROWS``, shuffled above that.  Texts are read a
second time only for documents with matches; the list of their ids is
broadcast up to ``BROADCAST_IDS`` (8 bytes each) and shuffled above that.

Defined cases: null texts are empty and match nothing; so does an item without
a letter or digit; an item of a few tokens leaks into every document that has
them in a row; a text without blanks is one token per run of letters, so an
item in such a script is found between punctuation marks; equal items are each reported; rows that
repeat a doc_id are one document whose windows are pooled, and each row gets
the same answer; rows with a null id are kept and are never matched; an empty
table on either side gives no matches.  Only ``doc_id`` and ``text`` of the
documents and ``item_id`` and ``text`` of the benchmark are read, so other
columns, whatever their names, play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import let, saved, with_text

WINDOW = 8
LITERAL = 5
COVER = 0.5
ENOUGH = 6
CONSISTENT = 0.8
DRIFT = 8
BROADCAST_ROWS = 200_000
BROADCAST_IDS = 1_000_000

# Units that may follow a number.
UNITS = ("km", "m", "cm", "mm", "kg", "g", "mg", "l", "ml", "h", "min", "s", "ms", "mph", "kmh", "eur", "euro", "euros",
         "usd", "dollar", "dollars", "cent", "cents", "percent", "hour", "hours", "minute", "minutes", "second",
         "seconds", "day", "days", "week", "weeks", "month", "months", "year", "years", "mile", "miles", "inch",
         "inches", "foot", "feet", "meter", "meters", "gram", "grams", "pound", "pounds", "liter", "liters")

# Private-use characters mark the words that context has typed.
_NAME, _UNIT = "", ""
_NUMBER = r"\d+(?:[.,]\d+)*"


def tokens(text: Column) -> Column:
    """Numbers and letter runs of a text; names and units carry a mark in front."""
    plain = F.regexp_replace(text, f"[{_NAME}{_UNIT}]", " ")
    names = F.regexp_replace(plain, r"(?<=[\p{L}\p{N},;:]\x20)(?=\p{Lu})", _NAME)
    units = F.when(names.rlike(r"\d"), F.regexp_replace(
        names, rf"(?<=\d)(\x20?)(?=(?i:{'|'.join(UNITS)})(?!\p{{L}}))", "$1" + _UNIT)).otherwise(names)
    return F.regexp_extract_all(units, F.lit(rf"([{_NAME}{_UNIT}]?\p{{L}}+|{_NUMBER})"), F.lit(1))


def template(words: Column) -> Column:
    """Template token of each token."""
    def one(w):
        return (F.when(w >= _UNIT, F.lit("<unit>")).when(w >= _NAME, F.lit("<name>"))
                .when(w < ":", F.lit("<num>")).otherwise(F.lower(w)))
    return F.transform(words, one)


def literal(words: Column) -> Column:
    """Lower case of each token, without the mark."""
    return F.transform(words, lambda w: F.lower(F.translate(w, _NAME + _UNIT, "")))


def _hash(words: Column, exact: Column) -> Column:
    """Hash of one window; ``exact`` is its length if it is literal, or 0."""
    return F.when(exact == 0, F.xxhash64(template(words))).otherwise(F.xxhash64(exact, literal(words)))


def _windows(words: Column, lengths: list[int]) -> Column:
    """``(pos, exact, hash)`` of every template window, and every literal one of ``lengths``."""
    def cut(tokens_: Column, size: int, one):
        return let(tokens_, lambda s: F.when(F.size(s) >= size, F.transform(
            F.sequence(F.lit(0), F.size(s) - size), lambda i: one(i, F.slice(s, i + 1, size)))).otherwise(F.array()))

    def of(exact, hashed):
        return lambda i, w: F.struct(i.alias("pos"), F.lit(exact).alias("exact"), hashed(w).alias("hash"))

    def all_of(w):
        parts = [cut(template(w), WINDOW, of(0, F.xxhash64))]
        parts += [cut(literal(w), n, of(n, lambda x, n=n: F.xxhash64(F.lit(n), x))) for n in lengths]
        return F.concat(*parts) if lengths else parts[0]
    return let(words, all_of)


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """``(item_id, at, exact, hash, filled, n_windows, n_exact)``: indexed windows of every item.

    ``exact`` is the length of a window indexed by its literal tokens, and 0
    where the template is indexed.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    cut = items.select("item_id", tokens(F.col("text")).alias("words")).where(F.size("words") > 0)
    rows = cut.select("item_id", "words", template(F.col("words")).alias("shapes"), F.explode(F.sequence(
        F.lit(1), F.greatest(F.size("words") - (WINDOW - 1), F.lit(1)))).alias("at"))
    rows = rows.select("item_id", "at", F.slice("words", F.col("at"), WINDOW).alias("filled"),
                       F.slice("shapes", F.col("at"), WINDOW).alias("shape"))
    plain = F.size(F.filter("shape", lambda w: ~w.startswith("<")))
    rows = rows.withColumn("exact", F.when((F.size("shape") == WINDOW) & (plain >= LITERAL), 0).otherwise(F.size("shape")))
    rows = rows.select("item_id", "at", "exact", _hash(F.col("filled"), F.col("exact")).alias("hash"), "filled")
    # Counted over the item's distinct windows, as matches are.
    total = rows.groupBy("item_id").agg(F.countDistinct(F.when(F.col("exact") == 0, F.col("hash"))).alias("n_windows"),
                                        F.countDistinct(F.when(F.col("exact") > 0, F.col("hash"))).alias("n_exact"))
    return rows.join(total, "item_id")


def _share(slots: Column) -> Column:
    """Share of the item's slot values that the document fills with one value."""
    def of(s):
        values = F.array_distinct(F.transform(s, lambda x: x["b"]))
        fit = let(values, lambda v: F.size(F.filter(v, lambda b: F.size(F.filter(s, lambda x: x["b"] == b)) == 1)) / F.size(v))
        return F.when(F.size(s) == 0, F.lit(1.0)).otherwise(fit)
    return let(slots, of)


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, n_matched, n_windows, share)``: leaked items of documents."""
    index = saved(benchmark_windows(benchmark), "index")
    small = index.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    bounded = F.broadcast if small else (lambda df: df)
    texts = with_text(docs).where("doc_id is not null")
    # At most WINDOW numbers.
    lengths = sorted(r.exact for r in index.where("exact > 0").select("exact").distinct().collect())

    windows = texts.select("doc_id", F.explode(_windows(tokens(F.col("text")), lengths)).alias("w")).select("doc_id", "w.*")
    keys = index.select("exact", "hash").distinct()
    met = saved(windows.join(bounded(keys), ["exact", "hash"], "left_semi"), "met")

    # Second look at the documents that matched, for their slot values.
    hit = met.groupBy("doc_id").agg(F.collect_set(F.struct("pos", "exact")).alias("at"))
    ids = met.select("doc_id").distinct()
    ids = F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids
    again = texts.join(ids, "doc_id", "left_semi").select("doc_id", tokens(F.col("text")).alias("words"))
    size = lambda p: F.when(p["exact"] == 0, WINDOW).otherwise(p["exact"])
    again = again.join(hit.hint("merge"), "doc_id").select("doc_id", F.explode(F.transform("at", lambda p: F.struct(
        p["pos"].alias("pos"), p["exact"].alias("exact"), F.slice("words", p["pos"] + 1, size(p)).alias("found")))).alias("w"))
    again = again.select("doc_id", "w.*").where(F.size("found") == size({"exact": F.col("exact")}))
    again = again.withColumn("hash", _hash(F.col("found"), F.col("exact")))
    pairs = saved(again.join(bounded(index), ["exact", "hash"]).select(
        "doc_id", "item_id", (F.col("pos") - F.col("at")).alias("shift"), "exact", "hash", "filled", "found",
        "n_windows", "n_exact"), "pairs")

    # Slots are pairs of the item's and the document's value; literal windows have none.
    slots = F.when(F.col("exact") == 0, F.filter(
        F.zip_with("filled", "found", lambda b, d: F.struct(b.alias("b"), d.alias("d"))),
        lambda s: (s["b"] >= _NAME) | (s["b"] < ":"))).otherwise(F.array())
    totals = [F.first(c).alias(c) for c in ("n_windows", "n_exact")]
    aligned = pairs.select("doc_id", "item_id", "shift", F.struct((F.col("exact") > 0).alias("exact"), "hash").alias("hit"),
                           slots.alias("slots"), "n_windows", "n_exact").groupBy("doc_id", "item_id", "shift").agg(
        F.collect_set("hit").alias("hit"), F.array_distinct(F.flatten(F.collect_list("slots"))).alias("slots"), *totals)
    part = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), key.cast("long").alias("key")) for kind, key in enumerate(
        (F.col("shift"), F.floor(F.col("shift") / DRIFT), F.floor((F.col("shift") + DRIFT // 2) / DRIFT), F.lit(0)))]))
    occurrences = aligned.withColumn("part", part).groupBy("doc_id", "item_id", "part").agg(
        F.array_distinct(F.flatten(F.collect_list("hit"))).alias("hit"),
        F.array_distinct(F.flatten(F.collect_list("slots"))).alias("slots"), *totals)
    occurrences = occurrences.select(
        "doc_id", "item_id", "slots", "n_windows", F.size("hit").cast("long").alias("n_matched"),
        F.size(F.filter("hit", lambda h: ~h["exact"])).alias("shaped"), (F.col("n_windows") + F.col("n_exact")).alias("n_all"))
    enough = ((F.col("shaped") > 0) & (F.col("shaped") >= F.lit(COVER) * F.col("n_windows"))) | (
        F.col("n_matched") >= F.lit(COVER) * F.col("n_all")) | (F.col("n_matched") >= ENOUGH)
    passed = occurrences.where(enough).withColumn("share", _share(F.col("slots"))).where(F.col("share") >= CONSISTENT)
    return passed.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("n_matched", F.col("n_all").alias("n_windows"), "share")).alias("best")).select(
        "doc_id", "item_id", "best.*")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, contaminated, items)`` for every row of ``docs``."""
    leaks = matches(docs, benchmark).groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    return ids.join(leaks, "doc_id", "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"))
