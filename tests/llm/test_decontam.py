import re
from collections import defaultdict

from pyspark.sql import functions as F

from fareflow.llm import decontam
from fareflow.llm.common import prepare, read

SF = "/root/testdata/sf0.01"
W = decontam.WINDOW


def plain_tokens(text):
    """(template, value) of each token, typed from its own context."""
    out = []
    for m in re.finditer(r"\d+(?:[.,]\d+)*|[^\W\d_]+", text or ""):
        v, before = m.group(), text[:m.start()]
        if v[0].isdigit():
            out.append(("<num>", v))
        elif v.lower() in decontam.UNITS and re.search(r"\d\x20?$", before):
            out.append(("<unit>", v))
        elif v[0].isupper() and re.search(r"[^\W_,;:]\x20$|[,;:\d]\x20$", before):
            out.append(("<name>", v))
        else:
            out.append((v.lower(), v))
    return out


def plain(docs, items):
    index, total, value = defaultdict(list), {}, {}
    for i, text in items:
        t = plain_tokens(text)
        keys = set()
        for a in range(len(t) - W + 1):
            shape = tuple(x for x, _ in t[a:a + W])
            if sum(not x.startswith("<") for x in shape) >= decontam.LITERAL:
                index[shape].append((i, [v for _, v in t[a:a + W]]))
                keys.add(shape)
        total[i] = len(keys)
    found = {}
    for d, text in docs:
        t = plain_tokens(text)
        seen, slots = defaultdict(set), defaultdict(lambda: defaultdict(set))
        for a in range(len(t) - W + 1):
            shape = tuple(x for x, _ in t[a:a + W])
            for i, filled in index.get(shape, ()):
                seen[i].add(shape)
                for x, b, (_, v) in zip(shape, filled, t[a:a + W]):
                    if x.startswith("<"):
                        slots[i][b, x].add(v)
        leaked = []
        for i, s in seen.items():
            share = sum(len(v) == 1 for v in slots[i].values()) / len(slots[i]) if slots[i] else 1.0
            if (len(s) >= decontam.COVER * total[i] or len(s) >= decontam.ENOUGH) and share >= decontam.CONSISTENT:
                leaked.append(i)
        found[d] = sorted(leaked)
    return found


def run(spark, docs, items, **extra):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return decontam.contamination(d, b).collect()


ITEM = "A train leaves the station in Paris at 60 km per hour and arrives after 3 hours in Lyon, how far did it go"


def test_reparameterised_questions(spark):
    prepare(spark)
    docs = [
        (1, "Intro words. " + ITEM + " and more."),
        (2, ITEM.replace("60", "85").replace("3", "7,5").replace("Paris", "Berlin").replace("Lyon", "Munich")),
        (3, "Nothing of that kind is said in this text about trains and stations at all."),
        (4, "*** " + ITEM.replace(" ", "%% ").upper()),
        (5, " ".join(ITEM.split()[:9])),
    ]
    got = {r.doc_id: r.items for r in run(spark, docs, [(10, ITEM), (11, "too short"), (12, None)])}
    assert got[1] == [10] and got[2] == [10] and got[3] == [] and got[5] == []


def test_inconsistent_slots_are_no_copy(spark):
    prepare(spark)
    item = " ".join("we gave Anna the red box and we told Anna the blue plan and".split())
    same = item.replace("Anna", "Berta")
    parts = item.split("Anna")
    mixed = parts[0] + "Clara" + parts[1] + "Dora" + parts[2]
    got = {r.doc_id: r.items for r in run(spark, [(1, same), (2, mixed)], [(1, item)])}
    assert got == {1: [1], 2: []}


def test_against_brute_force(spark):
    prepare(spark)
    docs, items = read(spark, SF, "documents"), read(spark, SF, "benchmark")
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    got = {r.doc_id: r.items for r in decontam.contamination(docs, items).collect()}
    assert sum(map(bool, want.values())) > 5
    assert got == want


def test_shuffled_index_gives_the_same(spark, monkeypatch):
    prepare(spark)
    docs, items = read(spark, SF, "documents"), read(spark, SF, "benchmark")
    first = {tuple(r) for r in decontam.matches(docs, items).select("doc_id", "item_id").collect()}
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(decontam, "BROADCAST_IDS", 1)
    assert {tuple(r) for r in decontam.matches(docs, items).select("doc_id", "item_id").collect()} == first


def test_edge_rows(spark):
    prepare(spark)
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, ITEM, 3), (3, ITEM, 3), (None, ITEM, 4), (9, "word " * 50_000, 5)],
                                 "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(7, ITEM, 1), (8, ITEM, 2), (7, ITEM, 1), (None, "word " * 20, 0)], "item_id long, text string, doc_id int")
    got = sorted(((r.doc_id or 0, r.contaminated, r["items"]) for r in decontam.contamination(docs, items).collect()))
    assert got[0] == (0, False, []) and got[3:5] == [(3, True, [7, 8])] * 2 and len(got) == 6
    assert decontam.contamination(docs.limit(0), items).collect() == []
    assert {r.contaminated for r in decontam.contamination(docs, items.limit(0)).collect()} == {False}


REPEAT = ("Ann has 5 red apples in the box at home, later she has 7 red apples in the box at home again today")


def test_verbatim_copy_of_an_item_that_repeats_a_template_window(spark):
    prepare(spark)
    item = REPEAT.replace("Ann has", "then she has")
    other = item.replace("5", "11").replace("7", "13")
    docs = [(1, REPEAT), (2, "Some words before. " + item + " and after."), (3, other)]
    got = {r.doc_id: r.items for r in run(spark, docs, [(1, REPEAT), (2, item)])}
    assert 1 in got[1] and 2 in got[2] and 2 in got[3]


def test_two_copies_and_two_items_of_one_template(spark):
    prepare(spark)
    other = ITEM.replace("60", "85").replace("3", "7").replace("Paris", "Berlin").replace("Lyon", "Munich")
    third = ITEM.replace("60", "20").replace("3", "9").replace("Paris", "Rome").replace("Lyon", "Milan")
    drifted = ITEM.replace("per hour and arrives", "per hour and then arrives")
    docs = [(1, ITEM + ". " + other), (2, other + " - " + third), (3, ITEM + ". " + ITEM), (4, drifted + ". " + third)]
    got = {r.doc_id: r.items for r in run(spark, docs, [(1, ITEM), (2, other)])}
    assert got == {1: [1, 2], 2: [1, 2], 3: [1, 2], 4: [1, 2]}


def test_short_items_and_windows_of_few_plain_words(spark):
    prepare(spark)
    names = "Anna Maria Lopez, born 3 May 1985, Peter Paul Schmidt, born 12 June 1990"
    items = [(1, "What is 12 + 7 * 3 - 4 / 2?"), (2, names), (3, "法国的首都是哪里？请回答。"), (4, "?"), (5, "Who wrote Faust?")]
    docs = [(1, "Question: What is 12 + 7 * 3 - 4 / 2? Answer that."), (2, "What is 12 + 7 * 3 - 4 / 5?"),
            (3, "see " + names + " and more"), (4, names.replace("1985", "1986").replace("12", "13").replace("Lopez", "Perez")),
            (5, "题目：法国的首都是哪里？请回答。"), (6, "法国的首都"), (7, "so who wrote Faust, then?"), (8, "who then wrote Faust")]
    got = {r.doc_id: r.items for r in run(spark, docs, items)}
    assert got == {1: [1], 2: [], 3: [2], 4: [], 5: [3], 6: [], 7: [5], 8: []}
