import corpus_pipeline as cp
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from fareflow.llm import bpe, crf, decontam, secrets, simhash
from fareflow.llm.common import prepare, read, saved

SF = "/root/testdata/sf0.001"


def test_each_stage_decides_on_its_own_input(spark):
    prepare(spark)
    docs = saved(read(spark, SF, "documents"), "start")
    names = docs.columns
    labels, bench = read(spark, SF, "labels"), read(spark, SF, "benchmark")

    def stage(i, before):
        name, fn = cp.STAGES[i]
        return saved(fn(spark, before, SF), name)

    first = stage(0, docs)
    assert first.columns == names
    score = {r.doc_id: r.score for r in crf.tag(docs, crf.learn(docs, labels)).select("doc_id", "score").collect()}
    assert {r.doc_id for r in first.collect()} == {d for d, s in score.items() if s < cp.REJECT}

    second = stage(1, first)
    assert second.columns == names
    groups = simhash.near_duplicates(first).collect()
    assert sorted(r.doc_id for r in second.collect()) == sorted({r.component_id for r in groups})

    third = stage(2, second)
    assert third.columns == names
    leaked = {r.doc_id for r in decontam.matches(second, bench).collect()}
    assert {r.doc_id for r in third.collect()} == {r.doc_id for r in second.collect()} - leaked

    fourth = stage(3, third)
    assert fourth.columns == names
    before = {r.doc_id: r for r in secrets.scan(third).collect()}
    for r in fourth.collect():
        old = before[r.doc_id]
        text, at = "", 0
        for s in old.secret_spans:
            text += old.text[at:s.start] + "[secret]" if s.start >= at else ""
            at = max(at, s.end)
        text += old.text[at:]
        assert r.text == text and r.n_chars == (len(text) if old.secret_spans else old.n_chars)

    fifth = stage(4, fourth)
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    texts = {r.doc_id: r.text for r in fourth.collect()}
    rows = fifth.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.exact and r.ids == lib.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids)


def test_odd_rows_pass_through_every_stage(spark):
    prepare(spark)
    good = read(spark, SF, "documents").limit(40)
    odd = spark.createDataFrame(
        [(10**9, None, None, None, None), (10**9 + 1, "", "en", "x", 0), (None, "some words of no id", "en", "x", 3),
         (10**9 + 2, "a repeated row with words", "en", "x", 25), (10**9 + 2, "a repeated row with words", "en", "x", 25)],
        good.schema)
    docs = saved(good.union(odd), "odd")
    for name, stage in cp.STAGES:
        docs = saved(stage(spark, docs, SF), name)
    ids = [r.doc_id for r in docs.collect()]
    assert ids.count(10**9 + 2) == 1 and ids.count(10**9) == 1 and ids.count(10**9 + 1) == 0 and ids.count(None) == 1


def test_empty_input(spark):
    prepare(spark)
    docs = saved(read(spark, SF, "documents").limit(0), "none")
    for name, stage in cp.STAGES:
        docs = saved(stage(spark, docs, SF), name)
    assert docs.count() == 0


def test_toxicity_rejects_what_the_operator_predicts(spark, monkeypatch):
    scores = {1: 0.29, 2: 0.3, 3: 0.45, 4: 0.9}
    docs = spark.createDataFrame([(d, "text") for d in scores], "doc_id long, text string")
    value = F.element_at(F.create_map(*[F.lit(x) for pair in scores.items() for x in pair]), F.col("doc_id").cast("int"))
    monkeypatch.setattr(crf, "learn", lambda *a: None)
    monkeypatch.setattr(crf, "tag", lambda df, model, score="score", spans="spans": df.withColumn(score, value))
    assert [r.doc_id for r in cp.toxicity(spark, docs, SF).collect()] == [1]


def test_stages_keep_columns_of_any_name(spark):
    prepare(spark)
    names = ["_base", "_more", "_runs", "secret_spans", "found_spans", "_leaked", "leaked_id", "_toxicity", "toxicity_score",
             "_spans", "toxic_spans", "score", "spans", "fp", "component_id", "first", "root", "item_id", "Toxicity_Score_"]
    docs = read(spark, SF, "documents").limit(30).select("*", *[F.concat(F.lit(f"{n}:"), "doc_id").alias(n) for n in names])
    docs = saved(docs, "wide")
    for name, stage in cp.STAGES[:-1]:
        docs = saved(stage(spark, docs, SF), name)
        assert docs.columns[-len(names):] == names
    rows = docs.collect()
    assert rows
    for r in rows:
        assert [r[n] for n in names] == [f"{n}:{r.doc_id}" for n in names]
    last = cp.STAGES[-1][1](spark, docs, SF).collect()
    assert len(last) == len(rows)
