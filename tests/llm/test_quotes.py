import random
import re

import pytest

from fareflow.llm import quotes
from fareflow.llm.common import prepare


def plain(rows):
    """Links, replies, threads and own texts by scanning every conversation."""
    def parse(text):
        out = []
        for line in re.split("\r?\n", text or ""):
            marks = re.match(r"((?:[ \t]{0,3}>)*)", line).group(1)
            level = marks.count(">")
            said = re.sub(r"^[ \t]", "", line[len(marks):]) if level else line
            out.append((level, said))
        kept = []
        for i, (level, said) in enumerate(out):
            ahead = out[i + 1:i + 2] if out[i + 1:i + 2] and out[i + 1][1].strip(" ") else out[i + 1:i + 3]
            intro = re.search(quotes.INTRODUCTION, said) and any(lv > level for lv, _ in ahead)
            kept.append((None if intro else level, said))
        return kept

    def norm(s):
        return re.sub(r"[\W_]+", " ", s.lower()).strip()

    def said_at(text):
        """(level, normalised passage): lines, and sentences of consecutive lines of a level."""
        out, run = set(), []
        for level, said in [*parse(text), (None, "")]:
            blank = not said.strip(" ")
            if level is not None:
                out.add((level, norm(said)))
            if run and (level != run[0] or blank):
                out |= {(run[0], norm(x)) for x in re.split(quotes.SENTENCE_END, " ".join(run[1]))}
                run = []
            if level is not None and not blank:
                run = run or (level, [])
                run[1].append(said)
        return {(lv, x) for lv, x in out if x}

    info = {}
    msgs = {(c, t): x for c, t, _, x in rows if c is not None and t is not None}
    for (c, t), text in sorted(msgs.items()):
        quoted = {(lv, x) for lv, x in said_at(text) if lv}
        votes, linked = {}, 0
        for lv, s in quoted:
            source = max((u for (d, u), x in msgs.items() if d == c and u < t and (0, s) in said_at(x)), default=None)
            linked += source is not None
            if lv == 1 and source is not None:
                votes[source] = votes.get(source, 0) + 1
        reply = max(votes, key=lambda u: (votes[u], u)) if votes else None
        thread, depth = (info[c, reply][0], info[c, reply][1] + 1) if reply is not None else (t, 0)
        info[c, t] = (thread, depth, reply, len(quoted), linked)
    out = []
    for c, t, role, text in rows:
        own = text or ""
        if any(lv for lv, _ in parse(text)):
            own = "\n".join(s for lv, s in parse(text) if lv == 0).strip(" ")
        out.append((c, t, role, *info.get((c, t), (t, 0, None, 0, 0)), own))
    return sorted(out, key=str)


def check(spark, rows, span=quotes.SPAN):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, level int, source string")
    got = [(r.conv_id, r.turn, r.role, r.thread, r.depth, r.reply_to, r.n_quoted, r.n_linked, r.text) for r in quotes.conversations(df, span).collect()]
    assert sorted(got, key=str) == plain(rows)
    return got


@pytest.mark.parametrize("seed,span", [(1, 1024), (2, 3), (3, 1)])
def test_random_threads(spark, seed, span):
    prepare(spark)
    rnd = random.Random(seed)
    said = ["Hello there, friend!", "hello THERE friend", "Où est-il ?", "Thanks. Bye", "x > y", "12 apples", "!!!", "", "one. two.", "two.",
            "On Monday Ann wrote:", "Am 1. Mai schrieb Bob:"]
    rows = []
    for c in range(4):
        for t in range(25):
            lines = [rnd.choice(said) for _ in range(rnd.randint(0, 3))]
            lines += [rnd.choice([">", "> ", ">> ", " > > ", ">\t"]) + rnd.choice(said + ["never said"]) for _ in range(rnd.randint(0, 3))]
            rnd.shuffle(lines)
            rows.append((c, t, rnd.choice(["user", "assistant"]), rnd.choice(["\n", "\r\n"]).join(lines)))
    check(spark, rows, span)


def test_nested_reply(spark):
    prepare(spark)
    rows = [(1, 0, "user", "First point.\nSecond point."), (1, 1, "assistant", "> First point.\nI agree."),
            (1, 2, "user", ">> First point.\n> I agree.\nGood."), (1, 3, "user", "> Second   POINT\nHow?"), (2, 1, "user", "> First point.\nOther talk")]
    got = {(r[0], r[1]): r for r in check(spark, rows)}
    assert got[1, 2][3:8] == (0, 2, 1, 2, 2) and got[1, 2][8] == "Good."
    assert got[1, 3][5] == 0 and got[2, 1][5] is None


def test_wrapped_and_excerpted_quotes(spark):
    prepare(spark)
    rows = [(1, 0, "user", "The first sentence is a rather long one. The second one follows it! A third."),
            (1, 1, "assistant", "On 3 May 2024, Ann <a@x.org> wrote:\n> The first sentence is a\n> rather long one. The second\n> one follows it!\n\nYes."),
            (1, 2, "user", "Le 4 mai, Bob a écrit :\n\n> Yes.\n>> The second one\n>> follows it!\nGood."),
            (1, 3, "user", "On Friday she wrote: nothing quoted here"), (1, 4, "user", "> A third.")]
    got = {(r[0], r[1]): r for r in check(spark, rows)}
    assert got[1, 1][3:6] == (0, 1, 0) and got[1, 1][7] == 2 and got[1, 1][8].strip() == "Yes."
    assert got[1, 2][3:6] == (0, 2, 1) and got[1, 2][8].strip() == "Good."
    assert got[1, 3][8] == rows[3][3] and got[1, 4][5] == 0


def test_odd_rows(spark):
    prepare(spark)
    rows = [(1, 0, "user", "a b"), (1, 0, "user", "a b"), (1, 1, None, "> a b"), (None, 2, "user", "> a b\nc"), (1, None, "user", "> a b"),
            (3, 0, "user", None), (3, 1, "user", ""), (3, 2, "user", ">"), (4, 10**12, "user", "> a b\n" + "z" * 100_000)]
    check(spark, rows)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert quotes.conversations(empty).collect() == []
