import random

import pytest

from fareflow.llm import mih
from fareflow.llm.common import prepare


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain(rows, queries, k):
    rows, out = sorted(set(rows)), []
    for q, code in sorted(set(queries)):
        near = sorted((bin(code ^ c).count("1"), i) for i, c in rows if i != q)[:k]
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("segments,k,n,probes", [(4, 10, 250, 1), (8, 3, 120, 1), (4, 5, 4, 1), (None, 10, 1, 1), (2, 10, 250, 600),
                                                 (3, 10, 250, 300), (2, 3, 150, 32), (None, 10, 250, 1)])
def test_exact_against_all_pairs(spark, segments, k, n, probes):
    prepare(spark)
    rnd = random.Random(n)
    centres = [rnd.getrandbits(64) for _ in range(5)]
    rows = []
    for i in range(n):
        x = rnd.choice(centres) if rnd.random() < 0.7 else rnd.getrandbits(64)
        for b in rnd.sample(range(64), rnd.choice([0, 0, 1, 3, 12])):
            x ^= 1 << b
        rows.append((i, x))
    rows += [(1000 + i, centres[0]) for i in range(n // 5)] + rows[:2]
    df = spark.createDataFrame([(i, signed(c)) for i, c in rows], "id long, code long")
    queries = [r for r in rows if r[0] % 10 == 0]
    got = mih.search(df, df.where("id % 10 = 0"), k, segments, probes).collect()
    assert sorted((r.query_id, r["rank"], r.id, r.distance) for r in got) == plain(rows, queries, k)


def test_codes_of_odd_vectors(spark):
    rows = [(1, [1.0, -1.0, 0.5]), (2, None), (None, [1.0]), (3, []), (4, [None, 2.0]), (5, [0.0] * 63 + [1.0]), (6, [1.0] * 64 + [-3.0, 1.0])]
    got = {r.id: r.code for r in mih.codes(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert got == {1: 0b101, 3: 0, 4: 0b10, 5: -(1 << 63), 6: signed((1 << 64) - 2)}


def test_empty(spark):
    prepare(spark)
    df = spark.createDataFrame([], "id long, code long")
    assert mih.search(df, df).collect() == []


def test_pieces_follow_the_number_of_codes():
    assert [mih.segments_for(n) for n in (0, 1, 1000, 2**18, 2**21, 2**26, 10**10, 10**14)] == [4, 4, 4, 4, 3, 2, 2, 2]
    for m in range(2, 9):
        cuts = mih._cuts(m)
        assert sum(w for _, w in cuts) == 64 and [a for a, _ in cuts[1:]] == [a + w for a, w in cuts[:-1]]


def test_clashing_columns_and_coordinates_without_a_sign(spark):
    df = spark.createDataFrame([(1, [float("nan"), 1.0, None], 7, "x"), (2, [-1.0, 2.0, 0.0], 8, "y")],
                               "vec_id long, embedding array<double>, code long, id string")
    assert {r.id: r.code for r in mih.codes(df).collect()} == {1: 2, 2: 2}
