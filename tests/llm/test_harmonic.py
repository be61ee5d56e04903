import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fareflow.llm import harmonic, vocab
from fareflow.llm.common import prepare, read
from fareflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
W = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(W)


def checked(pieces, want, capacity, slack):
    """All rules of a packing; ``want`` holds each document's ids."""
    docs, rows = {}, {}
    for p in pieces:
        docs.setdefault(p.doc_id, []).append(p)
        rows.setdefault(p.sequence_id, []).append(p)
    assert docs.keys() == want.keys()
    for d, ps in docs.items():
        ids, at = want[d], 0
        for p in sorted(ps, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            part = np.array(ids[at:at + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(part)
            at += p.length
        assert at == len(ids)
    padding = 0
    for ps in rows.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
        if at & (at - 1):
            padding += capacity - at
            assert capacity - at <= slack
    return padding


def odd_texts():
    rnd = random.Random(5)
    bits = ["the", "A", "Ünïté", "É", "日本", "🙂", " ", "\n", " ", "'s", "I'LL", "12", "...", "<|endoftext|>", "<|ENDOFTEXT|>", "ﬁ",
            "J̌", "é", "İ", "Σ", "\x1c", "\x00", "×", "ß"]
    made = ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 30))) for _ in range(300)]
    return made + [None, "", " ", "x" * 9000, "word " * 20000, "a" * 64 + " " + "b" * 65]


def test_chunks_give_the_ids_of_the_whole_text(library):
    encoder = vocab.WordEncoder(open(W, "rb").read())
    encoder.known.limit = 50
    texts = [t or "" for t in odd_texts()]
    for group in (texts[:7], texts[7:100], texts[100:], texts):
        for t, found in zip(group, encoder.encode([t.encode() for t in group])):
            assert np.frombuffer(found, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("capacity,slack,parts", [(4096, 4, 1), (64, 0, 3), (16, 2, 2), (1, 0, 2)])
def test_odd_texts_clashing_columns_and_no_id(spark, library, capacity, slack, parts):
    prepare(spark)
    texts = odd_texts()[-80:] if capacity < 64 else odd_texts()
    rows = [(None if i == 3 else i, t, "x", i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length string, start int").repartition(parts)
    pieces = harmonic.pack(df, W, capacity, slack).collect()
    want = {(None if i == 3 else i): library.encode(t or "", add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}
    checked(pieces, want, capacity, slack)
    for p in pieces:
        assert p.ids == want[p.doc_id][p.start:p.start + p.length]


def test_repeated_rows_each_have_their_pieces(spark):
    prepare(spark)
    df = spark.createDataFrame([(1, "some words here")] * 5, "doc_id long, text string")
    pieces = harmonic.pack(df, W).collect()
    assert sum(p.length for p in pieces) == 5 * pieces[0].doc_tokens
    assert len({(p.sequence_id, p.offset) for p in pieces}) == len(pieces)


def test_empty_table_and_wrong_capacity(spark):
    prepare(spark)
    df = spark.createDataFrame([], "doc_id long, text string")
    assert harmonic.pack(df, W).collect() == []
    with pytest.raises(ValueError):
        harmonic.pack(df, W, capacity=100)


def test_pieces_are_the_fewest():
    first = harmonic.first_pieces(64, 1)
    sizes = {n for n in range(1, 65) if 64 - 64 // n * n <= 1}
    best = [0] + [99] * 64
    for n in range(1, 65):
        best[n] = 1 + min(best[n - s] for s in sizes if s <= n)
        at, count = n, 0
        while at:
            assert first[at] in sizes
            at, count = at - first[at], count + 1
        assert count == best[n]


def test_full_sequences_hold_the_class_number_of_pieces(spark):
    prepare(spark)
    df = read(spark, SF, "documents")
    rows = {}
    for p in harmonic.pack(df, W, 256, with_ids=False).collect():
        rows.setdefault(p.sequence_id, []).append(p.length)
    full = [r for r in rows.values() if len({256 // n for n in r}) == 1 and sum(r) >= 255]
    assert all(len(r) == 256 // r[0] for r in full) and len(full) > 0.95 * len(rows)


def test_sequences_hold_the_ids_in_order(spark, library):
    prepare(spark)
    texts = {i: "word " * (i * 7) for i in range(60)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(2)
    pieces = harmonic.pack(df, W, 64, 3)
    for r in harmonic.sequences(pieces.checkpoint(), 64, 9).collect():
        ids = []
        for p in r.pieces:
            ids += (library.encode(texts[p.doc_id], add_special_tokens=False).ids + [2])[p.start:p.start + p.length]
        assert r.n_tokens == len(ids)
        power = len(ids) & (len(ids) - 1) == 0
        assert r.ids == ids + ([] if power else [9] * (64 - len(ids)))


def test_query_against_the_library(spark, library):
    docs = {r.doc_id: r.text for r in read(spark, SF, "documents").select("doc_id", "text").collect()}
    want = {d: library.encode(t or "", add_special_tokens=False).ids + [2] for d, t in docs.items()}
    pieces = QUERIES["op13_harmonic_packing"](spark, SF).collect()
    padding = checked(pieces, want, 4096, 4)
    assert padding < sum(map(len, want.values())) / 1000
