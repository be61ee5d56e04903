import hashlib
import random
import struct

import pytest
import public_tokenizers
import tiktoken

from fareflow.llm import bpe
from fareflow.llm.common import prepare, with_text

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.load_ranks(RANKS), public_tokenizers.PATTERN)


@pytest.mark.parametrize("text", [
    "", " ", "a", "  \n\n\t x  ", "I'll say 'tis 2024!", "日本語テキスト🙂 é", "<|endoftext|>",
    "a" * 5000, "0" * 500 + "!?" * 300, "\u0000  ", "abcdefgh" * 3000,
])
def test_same_ids_as_the_library(encoder, library, text):
    assert list(encoder.encode(text)) == library.encode_ordinary(text)


def test_same_ids_on_random_text(encoder, library):
    rnd = random.Random(7)
    for _ in range(1500):
        s = "".join(rnd.choice("abeéèünth 01.'\n") for _ in range(rnd.randint(0, 80)))
        assert list(encoder.encode(s)) == library.encode_ordinary(s)


def test_round_trip_nulls_repeats_and_clashing_columns(spark, library):
    prepare(spark)
    rows = [(1, None, "x", 5), (2, "", "y", 6), (3, "Hello  world", "z", 7),
            (3, "Hello  world", "z", 7), (None, "é" * 3, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, exact int")
    enc = bpe.encode(df, RANKS, public_tokenizers.PATTERN)
    assert enc.columns == ["doc_id", "text", "exact", "ids"]
    got = bpe.decode(enc, RANKS, public_tokenizers.PATTERN).collect()
    assert len(got) == 5
    for r in got:
        assert bytes(r.decoded).decode() == (r.text or "")
        assert r.ids == library.encode_ordinary(r.text or "")
    both = bpe.round_trip(df, RANKS, public_tokenizers.PATTERN).collect()
    assert len(both) == 5
    for r in both:
        ids = library.encode_ordinary(r.text or "")
        assert r.ids == ids and r.n_tokens == len(ids) and r.exact
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_empty_table(spark):
    df = with_text(spark.createDataFrame([], "doc_id long, text string"))
    assert bpe.encode(df, RANKS, public_tokenizers.PATTERN).collect() == []
    assert bpe.round_trip(df, RANKS, public_tokenizers.PATTERN).collect() == []
