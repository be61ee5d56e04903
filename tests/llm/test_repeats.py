import hashlib
import random

import numpy as np
import pytest

from fareflow.llm import colbwt, rlz
from fareflow.llm.common import prepare, read

SF = "/root/testdata/sf0.01"


def plain_words(docs, window):
    """Kept words of each document by a table of all windows."""
    first, words = {}, {}
    for d in sorted(docs):
        words[d] = (docs[d] or "").encode().split()
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i:i + window]), (d, i))
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] != (d, i):
                gone[i:i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[d] = (len(w), sum(gone), kept)
    return out


def plain_bytes(docs, window):
    count = {}
    raw = {d: (t or "").encode() for d, t in docs.items()}
    for b in raw.values():
        for i in range(len(b) - window + 1):
            k = hashlib.blake2b(b[i:i + window], digest_size=12).digest()
            count[k] = count.get(k, 0) + 1
    out = {}
    for d, b in raw.items():
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - window + 1):
            if count[hashlib.blake2b(b[i:i + window], digest_size=12).digest()] > 1:
                gone[i:i + window] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(np.int8)))) == 1).sum())
        out[d] = (len(b), int(gone.sum()), spans, b"".join(b[i:i + 1] for i in range(len(b)) if not gone[i]))
    return out


def corpus(seed, n=60, vocabulary=40):
    """Documents that share passages, copies, runs of one word and edits."""
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["a", "bé", "ccc", "Dd", "e."]) + str(rnd.randrange(vocabulary))
    passages = [[word() for _ in range(rnd.randint(10, 70))] for _ in range(8)]
    docs = {}
    for d in range(n):
        w = []
        for _ in range(rnd.randint(0, 6)):
            kind = rnd.random()
            if kind < 0.5:
                w += rnd.choice(passages)[rnd.randint(0, 8):]
            elif kind < 0.6:
                w += ["same"] * rnd.randint(1, 60)
            else:
                w += [word() for _ in range(rnd.randint(0, 40))]
        if d and rnd.random() < 0.2:
            w = (docs[rnd.randrange(d)] or "").split()
            if w and rnd.random() < 0.6:
                w[rnd.randrange(len(w))] = "edit"
        docs[d] = rnd.choice([" ", "\n", " \t "]).join(w)
    docs[n] = None
    docs[n + 1] = "  \n "
    docs[n + 2] = ("xyz" * 700)
    docs[n + 3] = "one two " * 300
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(d, t, "clash", 0) for d, t in docs.items()], "doc_id long, text string, start string, runs int")


@pytest.mark.parametrize("seed,window,gram,hot", [(1, 20, 5, 2000), (2, 20, 5, 2), (3, 8, 3, 1), (4, 20, 16, 3)])
def test_words_against_all_windows(spark, seed, window, gram, hot):
    prepare(spark)
    docs = corpus(seed)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept.encode()) for r in rlz.dedup(frame(spark, docs), window, gram, hot).collect()}
    assert got == plain_words(docs, window)


@pytest.mark.parametrize("seed,window,gram,hot", [(5, 60, 41, 2000), (6, 60, 20, 2), (7, 400, 273, 2000), (8, 50, 30, 1)])
def test_bytes_against_all_windows(spark, seed, window, gram, hot):
    prepare(spark)
    docs = corpus(seed)
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in colbwt.dedup(frame(spark, docs), window, gram, hot).collect()}
    want = plain_bytes(docs, window)
    assert got == want
    assert sum(w[1] for w in want.values()) > 0


def test_queries_on_all_documents(spark):
    prepare(spark)
    from fareflow.llm.queries import QUERIES
    docs = {r.doc_id: r.text for r in read(spark, SF, "documents").select("doc_id", "text").collect()}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op7_relative_lz_dedup"](spark, SF).collect()}
    assert got == {d: (n, g, hashlib.sha256(k).hexdigest()) for d, (n, g, k) in plain_words(docs, 20).items()}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op9_column_bwt_dedup"](spark, SF).collect()}
    assert got == {d: (n, g, s, hashlib.sha256(k).hexdigest()) for d, (n, g, s, k) in plain_bytes(docs, 400).items()}


def test_repeated_rows_and_rows_without_id(spark):
    prepare(spark)
    text = " ".join(f"w{i}" for i in range(30))
    long = text * 5
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text), (3, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_removed) for r in rlz.dedup(df).collect())
    assert got == [(0, 0), (1, 0), (1, 0), (2, 30), (3, 0)]
    df = spark.createDataFrame([(1, long), (1, long), (None, long), (3, "")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_removed) for r in colbwt.dedup(df, 200, 100).collect())
    assert got[0] == (0, 0) and got[1] == got[2] and got[3] == (3, 0)
    assert rlz.dedup(df.limit(0)).collect() == [] and colbwt.dedup(df.limit(0)).collect() == []


@pytest.mark.parametrize("hot", [2000, 1])
def test_repeated_row_beside_a_document_that_shares_a_part(spark, hot):
    prepare(spark)
    shared = [f"s{i}" for i in range(30)]
    one = " ".join([f"a{i}" for i in range(40)] + shared + [f"b{i}" for i in range(40)])
    two = " ".join([f"c{i}" for i in range(40)] + shared + [f"d{i}" for i in range(40)])
    df = spark.createDataFrame([(1, one), (1, one), (2, two), (2, two)], "doc_id long, text string")
    words, raw = plain_words({1: one, 2: two}, 20), plain_bytes({1: one, 2: two}, 60)
    got = [(r.doc_id, (r.n_words, r.n_removed, r.kept.encode())) for r in rlz.dedup(df, 20, 5, hot).collect()]
    assert len(got) == 4 and all(words[d] == v for d, v in got)
    got = [(r.doc_id, (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept))) for r in colbwt.dedup(df, 60, 20, hot).collect()]
    assert len(got) == 4 and all(raw[d] == v for d, v in got)


def thue_morse(k):
    w = "a"
    for _ in range(k):
        w += w.translate(str.maketrans("ab", "ba"))
    return w


@pytest.mark.parametrize("hot", [2000, 1])
def test_words_that_powers_of_two_cannot_tell_apart(spark, hot):
    prepare(spark)
    one = thue_morse(10)
    two = one.translate(str.maketrans("ab", "ba"))
    common = [f"s{i}" for i in range(19)]
    docs = {1: " ".join(common + [one]), 2: " ".join(common + [two]), 3: " ".join(common[::-1] + [two] + common)}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept.encode()) for r in rlz.dedup(frame(spark, docs), 20, 5, hot).collect()}
    assert got == plain_words(docs, 20) and all(n == 0 for _, n, _ in got.values())
    long = {i: t for i, t in enumerate([one * 2 + "x" * 500, two * 2 + "y" * 500, one + two + one])}
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in colbwt.dedup(frame(spark, long), 400, 273, hot).collect()}
    assert got == plain_bytes(long, 400)


def test_rolling_hashes_follow_the_symbols():
    from fareflow.llm.common import Rolling, byte_values
    rnd = np.random.default_rng(1)
    text = rnd.integers(97, 100, 3000).astype(np.uint8)
    for seed in (0, 3, 6):
        hashes = Rolling(byte_values(text), seed)
        seen = {}
        for n in (1, 2, 5, 40):
            a = np.arange(len(text) - n + 1)
            for i, h in zip(a.tolist(), hashes.of(a, a + n).tolist()):
                assert seen.setdefault(h, text[i:i + n].tobytes()) == text[i:i + n].tobytes()
        words = {}
        for h, w in seen.items():
            assert words.setdefault(w, h) == h
    tm = np.frombuffer(thue_morse(12).encode(), np.uint8)
    half = len(tm) // 2
    one, two = Rolling(byte_values(tm), 1).of(np.array([0, half]), np.array([half, 2 * half]))
    assert one != two
