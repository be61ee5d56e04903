import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareflow.llm import crf
from fareflow.llm.common import prepare, read

SF = "/root/testdata/sf0.01"


def brute(model, emissions):
    """Marginals by summing over every state sequence."""
    n = len(emissions)
    total, toxic = 0.0, np.zeros(n)
    for states in itertools.product((0, 1), repeat=n):
        s = model.start[states[0]]
        for i, y in enumerate(states):
            s += (emissions[i] + model.bias) * y
            if i:
                s += model.moves[states[i - 1]][y]
        w = np.exp(s)
        total += w
        toxic += w * np.array(states)
    return toxic / total


def test_marginals_equal_enumeration():
    model = crf.Model(start=(0.3, -0.4), moves=((0.5, -1.0), (-0.7, 0.9)), bias=-1.2)
    chain = crf.Chain(model)
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 9):
        for _ in range(20):
            at = sorted(rng.choice(n, size=rng.integers(0, n + 1), replace=False).tolist())
            emission = rng.normal(0, 2, len(at)).tolist()
            full = np.zeros(n)
            full[at] = emission
            points, p = chain.marginals(n, at, emission)
            assert np.allclose(p, brute(model, full)[points])
            assert set(at) <= set(points)


def test_long_stretch_of_plain_tokens_is_finite():
    chain = crf.Chain(crf.Model(moves=((0.5, -3.0), (-0.7, 0.9)), bias=-2.0))
    _, p = chain.marginals(5_000_000, [7, 4_000_000], [6.0, 6.0])
    assert np.isfinite(p).all() and p.max() < 1


def test_held_out_rule(spark):
    import zlib
    got = spark.range(0, 200).select(F.col("id").alias("doc_id")).withColumn("h", crf.held_out()).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


@pytest.fixture(scope="module")
def learned(spark):
    prepare(spark)
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    return docs, labels, crf.learn(docs, labels)


def test_held_out_accuracy(spark, learned):
    docs, labels, model = learned
    rows = crf.tag(docs, model).join(labels, "doc_id").where(crf.held_out()).select("score", "toxic").collect()
    assert len(rows) > 50
    right = sum((r.score >= 0.3) == bool(r.toxic) for r in rows)
    assert right / len(rows) >= 0.9


def test_held_out_labels_are_never_used(spark, learned):
    docs, labels, model = learned
    other = labels.withColumn("toxic", F.when(crf.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert crf.learn(docs, other) == model


def test_spans_are_code_points_of_the_text(spark, learned):
    docs, _, model = learned
    word = max((w for w in model.weights if not w.endswith("*")), key=lambda w: (model.weights[w], w))
    text = f"\U0001F600 İstanbul é {word.upper()}, plain"
    rows = spark.createDataFrame([(1, text), (2, None), (3, ""), (3, ""), (None, "plain words")], "doc_id long, text string")
    got = crf.tag(rows, model).collect()
    assert len(got) == 5
    spans = next(r.spans for r in got if r.doc_id == 1)
    assert (text.index(word.upper()), text.index(word.upper()) + len(word)) in [(s.start, s.end) for s in spans]
    empty = {r.score for r in got if r.doc_id in (2, 3)}
    assert len(empty) == 1 and 0 <= empty.pop() <= 1


def test_without_usable_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in crf.tag(docs, crf.learn(docs, none)).collect()} == {0.0}
    odd = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (99, 0, 1), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert {r.score for r in crf.tag(docs, crf.learn(docs, odd)).collect()} == {0.0}
    assert crf.tag(docs.limit(0), crf.Model()).collect() == []


def test_windows_reach_the_end_of_a_long_text(spark):
    from fareflow.llm import crf
    prepare(spark)
    words = ["plain"] * 4000
    for at in range(0, 4000, 100):
        words[at] = "early"
    words[3999] = "late"
    df = spark.createDataFrame([(" ".join(words), 1)], "text string, toxic int")
    marked = [f for r in crf._windows(df, {"early": 0, "late": 1}, 100, places=8).collect() for f in r.x]
    assert 0 in marked
    spread = crf._windows(df, {"early": 0, "late": 1}, 1000, places=41).collect()
    assert any(1 in r.x for r in spread) and len(spread) <= 43
    assert len(crf._windows(df, {"early": 0, "late": 1}, 1000).collect()) <= crf.PLACES + 2
