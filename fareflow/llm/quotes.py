"""Quotation linking of conversations (operator 2, built-in functions only).

A line of a message that starts with one or more ``>`` is quoted at that
level.  Mail clients wrap quoted text anew and users quote parts of it, so a
message is taken apart twice: into its lines, and into the sentences of its
runs, where a run is consecutive lines of one level joined by blanks (an empty
line ends it).  Lines and sentences are normalised (lower case, runs of
anything but letters and digits to one blank) and hashed; the distinct ones of
a level are its *passages*.  A line that introduces a quotation ("On ...
wrote:" before lines of a higher level) belongs to the quotation and is no
passage.

Every quoted passage is joined to the latest earlier message of its
conversation that says it unquoted.  A message replies to the message to which
most of its first-level passages lead, the later one if two have as many.
Messages without such a passage start a thread of their own.  The result holds
every message without its quoted and introducing lines, and orders by
``(conv_id, thread, turn)``: a thread is the turn of its first message, and a
reply always comes after what it replies to.

The latest earlier message is an as-of lookup.  It runs in two levels: inside
spans of ``SPAN`` turns, and over the latest mention of each span.  A passage
that is repeated all through one giant conversation is so cut into pieces of
bounded size.  Originals are first reduced to passages that are quoted at
all.  Threads are found by pointer doubling over linked messages only.

Defined cases: null texts are empty; messages without conv_id or turn are
kept, start their own thread and are never linked; repeated rows are one
message for linking and are all returned; passages without letters or digits
are dropped with the quote but never linked; a passage quoted from the middle
of a sentence is linked only by the whole lines it holds; an empty table gives
an empty table.  Very long messages are read whole.  Only ``conv_id``,
``turn``, ``role`` and ``text`` are read, so other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.common import let, saved

SPAN = 1024
_MARKS = r"^((?:[ \t]{0,3}>)*)"
MAX_ROUNDS = 64
# Lines that introduce a quotation, in the languages of the corpus.
INTRODUCTION = r"^\s*(?:On|Le|Am|El)\b.*\b(?:wrote|a \u00e9crit|schrieb|escribi\u00f3)\s*:\s*$"
# Where a run is cut into sentences: behind closing marks.
SENTENCE_END = r"(?<=[.!?\u2026])\s+|(?<=[\u3002\uff01\uff1f])"
_GAP = "\u0001"


def lines(text: Column) -> Column:
    """Lines of a message as (level, said): quote level and text without marks."""
    def one(line):
        marks = F.regexp_extract(line, _MARKS, 1)
        level = F.length(F.regexp_replace(marks, "[^>]", ""))
        said = F.when(level > 0, F.regexp_replace(F.substring(line, F.length(marks) + 1, F.length(line)), r"^[ \t]", "")).otherwise(line)
        return F.struct(level.alias("level"), said.alias("said"))
    return F.transform(F.split(text, "\r?\n"), one)


def marked(text: Column) -> Column:
    """Lines as (level, said, intro): ``intro`` marks those that introduce a quotation."""
    def of(found):
        def one(x, i):
            after, later = F.get(found, i + 1), F.get(found, i + 2)
            quoted = (after["level"] > x["level"]) | ((F.trim(after["said"]) == "") & (later["level"] > x["level"]))
            return F.struct(x["level"].alias("level"), x["said"].alias("said"),
                            F.coalesce(quoted & x["said"].rlike(INTRODUCTION), F.lit(False)).alias("intro"))
        return F.transform(found, one)
    return let(lines(text), of)


def passages(text: Column) -> Column:
    """Lines and sentences of a message as (level, said), not yet normalised."""
    def of(found):
        said = F.transform(F.filter(found, lambda x: ~x["intro"]), lambda x: F.struct(x["level"].alias("level"), x["said"].alias("said")))

        def runs(level):
            here = F.transform(found, lambda x: F.when(
                (x["level"] == level) & ~x["intro"] & (F.trim(x["said"]) != ""), x["said"]).otherwise(_GAP))
            cut = F.split(F.array_join(here, " "), f" *{_GAP}[ {_GAP}]*")
            return F.transform(F.flatten(F.transform(cut, lambda run: F.split(run, SENTENCE_END))),
                               lambda sentence: F.struct(level.alias("level"), sentence.alias("said")))
        levels = F.array_distinct(F.transform(found, lambda x: x["level"]))
        return F.concat(said, F.flatten(F.transform(levels, runs)))
    return let(marked(text), of)


def normal(said: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(said), r"[^\p{L}\p{N}]+", " "))


def _passages(messages: DataFrame) -> DataFrame:
    """``(conv_id, turn, level, h1, h2)``: normalised lines and sentences of every message."""
    said = messages.where("conv_id is not null and turn is not null").select(
        "conv_id", "turn", F.explode(passages(F.col("text"))).alias("l")).select(
        "conv_id", "turn", F.col("l.level").alias("level"), normal(F.col("l.said")).alias("said")).where("said <> ''")
    return said.select("conv_id", "turn", "level", F.xxhash64("said").alias("h1"),
                       F.xxhash64(F.reverse("said"), F.lit(1)).alias("h2"))


def links(messages: DataFrame, span: int = SPAN) -> DataFrame:
    """``(conv_id, turn, level, h1, h2, source)``: quoted passages and where they come from.

    ``source`` is null for passages that no earlier message says.
    """
    key = ["conv_id", "h1", "h2"]
    passages = _passages(messages)
    quoted = saved(passages.where("level > 0").distinct(), "quoted")
    originals = passages.where("level = 0").join(quoted.select(*key).distinct(), key, "left_semi").select(*key, "turn").distinct()
    none = F.lit(None).cast("int")
    events = quoted.select(*key, "turn", "level").union(originals.select(*key, "turn", none.alias("level")))
    events = events.withColumn("part", F.floor(F.col("turn") / span))
    original = F.when(F.col("level").isNull(), F.col("turn"))
    # Inside a span: mentions at earlier turns (a message does not quote itself).
    inside = Window.partitionBy(*key, "part").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    near = events.withColumn("near", F.max(original).over(inside)).where("level is not null")
    # Across spans: the latest mention of all spans before.
    tops = events.groupBy(*key, "part").agg(F.max(original).alias("top"))
    before = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.withColumn("far", F.max("top").over(before)).drop("top")
    found = near.join(tops, [*key, "part"])
    return found.select("conv_id", "turn", "level", "h1", "h2", F.coalesce("near", "far").alias("source"))


def replies(linked: DataFrame) -> DataFrame:
    """``(conv_id, turn, reply_to)``: the message that most first-level passages lead to."""
    votes = linked.where("level = 1 and source is not null").groupBy("conv_id", "turn", "source").agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy("conv_id", "turn").agg(F.max_by("source", F.struct("n", "source")).alias("reply_to"))


def threads(parents: DataFrame) -> DataFrame:
    """``(conv_id, turn, thread, depth)`` of replying messages, by pointer doubling."""
    state = saved(parents.select("conv_id", "turn", F.col("reply_to").alias("up"), F.lit(1).cast("long").alias("depth")), "threads0")
    for i in range(1, MAX_ROUNDS):
        above = state.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("up").alias("up2"), F.col("depth").alias("d2"))
        hops = state.join(above, (F.col("conv_id") == F.col("c")) & (F.col("up") == F.col("t")), "left")
        moved = hops.agg(F.count("t")).first()[0]
        if not moved:
            break
        state = saved(hops.select("conv_id", "turn", F.coalesce("up2", "up").alias("up"),
                                  (F.col("depth") + F.coalesce("d2", F.lit(0))).alias("depth")), f"threads{i}")
    return state.withColumnRenamed("up", "thread")


def own_text(text: Column) -> Column:
    """The message without its quoted lines and what introduces them."""
    kept = F.transform(F.filter(marked(text), lambda x: (x["level"] == 0) & ~x["intro"]), lambda x: x["said"])
    return F.when(text.rlike(r"(?m)^[ \t]{0,3}>"), F.trim(F.array_join(kept, "\n"))).otherwise(text)


def conversations(messages: DataFrame, span: int = SPAN) -> DataFrame:
    """Every message with its place in the reply order and without quotes.

    ``(conv_id, turn, role, thread, depth, reply_to, n_quoted, n_linked,
    text)``; ``n_quoted`` and ``n_linked`` count distinct quoted passages.
    """
    source = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role",
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    linked = saved(links(source, span), "links")
    counts = linked.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n_quoted"), F.count("source").alias("n_linked"))
    parents = saved(replies(linked), "replies")
    about = counts.join(parents, ["conv_id", "turn"], "left").join(threads(parents), ["conv_id", "turn"], "left")
    return source.join(about, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", F.coalesce("thread", "turn").alias("thread"),
        F.coalesce("depth", F.lit(0).cast("long")).alias("depth"), "reply_to",
        F.coalesce("n_quoted", F.lit(0).cast("long")).alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"), own_text(F.col("text")).alias("text"))
