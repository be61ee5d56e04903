from itertools import permutations

import pytest

from fareflow.llm import audit
from fareflow.llm.common import prepare


def brute(docs, labels):
    """Every filter order applied document by document."""
    rank = lambda d: d if d is not None else None
    good, toxic = {d for d, q, t in labels if d is not None and q == 1}, {d for d, q, t in labels if d is not None and t == 1}
    fails = []
    for doc_id, text, part in docs:
        text = text or ""
        words = text.encode().split()
        f = set()
        if len(words) < 50:
            f.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            f.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text):
            f.add("C")
        if any(c in "#$%&*|" for c in text):
            f.add("D")
        if doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _ in docs):
            f.add("E")
        fails.append((part or "", f, rank(doc_id) in good, rank(doc_id) in toxic))
    out, shapley = {}, {}
    for part in {p for p, *_ in fails}:
        here = [x for x in fails if x[0] == part]
        for order in permutations("ABCDE"):
            for i, c in enumerate(order):
                prior = set(order[:i])
                removed = [x for x in here if c in x[1] and not x[1] & prior]
                out[part, "".join(order), i + 1] = (
                    sum(not x[1] & (prior | {c}) for x in here), len(removed), sum(c in x[1] and bool(x[1] & prior) for x in here),
                    sum(x[1] == {c} for x in here), sum(x[2] for x in removed), sum(x[3] for x in removed))
                shapley[part, c] = shapley.get((part, c), 0) + len(removed)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def run(spark, docs, labels, types="doc_id long, text string, source string"):
    prepare(spark)
    d = spark.createDataFrame(docs, types)
    l = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")  # noqa: E741
    rows = audit.audit(audit.states(d, l)).collect()
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}


def corpus():
    long = " ".join(f"w{i}" for i in range(60))
    poor = "same words again " * 30
    texts = [long, poor, long.upper(), "short", None, "", " \n", long + " #", poor + "|", "A" * 300, "x " * 10000, "é" * 40 + "ABC"]
    docs, i = [], 0
    for copy in range(4):
        for t in texts[copy:]:
            docs.append((i, t, ["a", "b", None, ""][i % 4]))
            i += 1
    docs += [(3, docs[3][1], "a"), (3, docs[3][1], "a"), (0, long, "b")]  # repeated rows, one in another part
    docs += [(None, long, "a"), (None, long, None), (None, "short", "c")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 30)] + [(2, 1, None), (2, None, 1), (None, 1, 1), (999, 1, 1)]
    return docs, labels


def test_all_orders_against_brute_force(spark):
    docs, labels = corpus()
    got = run(spark, docs, labels)
    assert got == brute(docs, labels)
    assert len(got) == 600 * 4  # a, b, c and the empty string


def test_clashing_columns(spark):
    docs, labels = corpus()
    wide = [(*d, b"x", 1, True, 2) for d in docs]
    types = "doc_id long, text string, source string, digest binary, mask int, good boolean, part int"
    assert run(spark, wide, labels, types) == run(spark, docs, labels)


def test_one_group_of_copies_and_no_labels(spark):
    docs = [(i, "one text", "hot") for i in range(500)] + [(i, "one text", f"p{i}") for i in range(500, 520)]
    got = run(spark, docs, [])
    assert got["hot", "EABCD", 1][:2] == (1, 499) and got["p510", "EABCD", 1][:2] == (0, 1)


def test_empty_table(spark):
    assert run(spark, [], []) == {}


def test_fields_do_not_run_over():
    big = (1 << 62) + 12345
    total = big * audit.packed_outcomes(0b00101, True, False) + 7 * audit.packed_outcomes(0, False, False)
    counts = audit.unpacked(total)
    for (order, step, bit), row in zip(audit.steps(), counts):
        first = min(order.index("A"), order.index("C"))
        removed = big if order[step - 1] in "AC" and order.index(order[step - 1]) == first else 0
        assert row[1] == removed and row[4] == removed and row[5] == 0
        assert row[0] == 7 + (big if step - 1 < first else 0)


@pytest.mark.parametrize("mask", range(32))
def test_each_document_is_removed_once_an_order(mask):
    counts = audit.unpacked(audit.packed_outcomes(mask, True, True))
    assert counts.shape == (600, 6)
    removed = counts[:, 1].reshape(120, 5).sum(axis=1)
    assert (removed == (mask > 0)).all()
