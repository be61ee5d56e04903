import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fareflow.llm import align, vocab
from fareflow.llm.common import prepare, read
from fareflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """Tokens of whole texts by the libraries, with their bytes."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    words = align.vocabularies(A, B)

    def tokens(text):
        if not text:
            return [], []
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw = (" " + text).encode()
        if b"".join(words.bytes_a[i] for i in x) != raw or b"".join(words.bytes_b[i] for i in y) != raw:
            return [], []
        return [(i, len(words.bytes_a[i])) for i in x], [(i, len(words.bytes_b[i])) for i in y]
    return tokens


def brute(texts, tokens):
    """The contract's columns from sets of token ends."""
    per, total = [], Counter()
    for t in texts:
        a, b = tokens(t)
        ends_a, ends_b = np.cumsum([n for _, n in a]).tolist(), np.cumsum([n for _, n in b]).tolist()
        common = sorted(set(ends_a) & set(ends_b))
        groups, links, at_a, at_b = [], [], 0, 0
        for c in common:
            to_a, to_b = ends_a.index(c, at_a) + 1, ends_b.index(c, at_b) + 1
            groups.append(",".join(str(i) for i, _ in a[at_a:to_a]) + "|" + ",".join(str(i) for i, _ in b[at_b:to_b]))
            links.append((a[to_a - 1][0], b[to_b - 1][0]))
            at_a, at_b = to_a, to_b
        total.update(links)
        per.append((len(a), len(b), groups, links))
    most = Counter()
    for (_, y), n in total.items():
        most[y] = max(most[y], n)
    return [(n_a, n_b, len(g), len(k), sum(total[p] == most[p[1]] for p in k), sum(total[p] for p in k),
             hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for n_a, n_b, g, k in per]


def columns(r):
    return (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)


def odd_texts():
    rnd = random.Random(3)
    bits = ["the", "a", "Ünïté", "日本", "🙂", " ", "  ", "\n", "\t", " ", " ", "'s", "x'", "12", "...", "<|endoftext|>",
            "<s>", "é", "ﬁ", "\x1c", "\x85", "▁", "é", "　", "\x00"]
    made = ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 25))) for _ in range(400)]
    return made + [None, "", " ", "  ", "a ", " a", "\n", "a\n b", "x" * 9000, "word " * 3000, "a▁b", "trailing  "]


def test_chunks_give_the_ids_of_the_whole_text(plain):
    a, b = vocab.ByteLevel(open(A, "rb").read()), vocab.Pieces(open(B, "rb").read())
    for t in [t for t in odd_texts() if t]:
        parts = vocab.chunks(t.encode())
        assert b" " + b" ".join(parts) == (" " + t).encode()
        texts = [p.decode() for p in parts]
        assert sum(a(texts), []) == a([t])[0]
        if "▁" not in t:  # B's mark for a space: such a text has no tokens at all
            assert sum(b(texts), []) == b([t])[0]


@pytest.mark.parametrize("stretch", [1, 7, 64, 2048])
def test_merge_finds_all_common_ends(stretch):
    rnd = np.random.default_rng(stretch)
    for _ in range(30):
        sizes = rnd.integers(1, 300, rnd.integers(1, 6))
        ends = [[], []]
        for i, n in enumerate(sizes):
            for side in ends:
                inner = rnd.choice(np.arange(1, n), rnd.integers(0, n), replace=False) if n > 1 else []
                side.append(np.sort(np.append(inner, n)).astype(np.int64) + int(sizes[:i].sum()))
        flat = [np.concatenate(s) for s in ends]
        bounds = [np.concatenate(([0], np.cumsum([len(x) for x in s]))) for s in ends]
        a, b = align.merge(*flat, *bounds, stretch)
        want = np.intersect1d(*flat)
        assert (flat[0][a] == want).all() and (flat[1][b] == want).all()


def test_odd_texts_clashing_columns_and_repeats(spark, plain):
    prepare(spark)
    texts = odd_texts() + ["the same row"] * 3
    rows = [(None if i == 5 else i, t, [1], "x", i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pairs array<int>, n_a string, at int").repartition(3)
    got = {(r.doc_id if r.doc_id is not None else 5): columns(r) for r in align.alignment(df, A, B).collect()}
    want = brute(texts, plain)
    assert len(got) == len(texts)
    for i, w in enumerate(want):
        assert got[i] == w, texts[i]


def test_empty_table(spark):
    prepare(spark)
    df = spark.createDataFrame([], "doc_id long, text string")
    assert align.alignment(df, A, B).collect() == []


def test_pair_counts(spark, plain):
    prepare(spark)
    texts = ["one two", "two one two", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.a_id, r.b_id): r.links for r in align.pair_counts(df, A, B).collect()}
    assert sum(got.values()) == sum(w[3] for w in brute(texts, plain))


def test_query_against_brute_force(spark, plain):
    docs = {r.doc_id: r.text for r in read(spark, SF, "documents").select("doc_id", "text").collect()}
    got = {r.doc_id: columns(r) for r in QUERIES["op11_lockstep_alignment"](spark, SF).collect()}
    assert got == dict(zip(docs, brute(docs.values(), plain)))
