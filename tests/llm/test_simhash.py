import random

import pytest
import xxhash

from fareflow.llm import graph, simhash
from fareflow.llm.common import prepare, read

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
             .replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    """Component of each row by comparing all pairs."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i][1] ^ fps[j][1]).count("1") <= 4:
                parent[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(fps):
        groups.setdefault(find(i), []).append(doc)
    return [(doc, min(d for d in groups[find(i)] if d is not None)) for i, (doc, _) in enumerate(fps)]


@pytest.mark.parametrize("text", ["", " \n", "One", "A b c", "A b c d", "a B\tc d e É é f", "x " * 50])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("pair_limit", [64, 2, 1])
def test_links_find_every_pair_within_four_bits(spark, pair_limit):
    prepare(spark)
    rnd = random.Random(5)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):
        x = rnd.getrandbits(64)
        fps.add(x)
        for _ in range(10):
            y = x
            for b in rnd.sample(range(64), rnd.randint(1, 6)):
                y ^= 1 << b
            fps.add(y)
    # Many that share one half, so that buckets are crowded.
    base = rnd.getrandbits(32)
    fps |= {base << 32 | rnd.getrandbits(32) & 0xFFF for _ in range(150)}
    rows = [(i, f) for i, f in enumerate(sorted(fps))]
    df = spark.createDataFrame([(signed(f),) for _, f in rows], "fp long")
    got = graph.components(simhash.links(df, pair_limit=pair_limit)).collect()
    root = {r.node: r.root for r in got}
    expected = dict(plain_components(rows))
    mine = {}
    for i, f in rows:
        mine.setdefault(root.get(signed(f), signed(f)), []).append(i)
    assert {i: min(g) for g in mine.values() for i in g} == expected


def test_documents_against_brute_force(spark):
    prepare(spark)
    docs = read(spark, SF, "documents")
    rows = [(r.doc_id, plain_fingerprint(r.text or "")) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.report(simhash.near_duplicates(docs)).collect()}
    assert got == {doc: (f"{fp:016x}", comp) for (doc, fp), (_, comp) in zip(rows, plain_components(rows))}


def test_edge_rows(spark):
    prepare(spark)
    rows = [(5, "", "k", 1), (3, None, "k", 2), (7, "some words here now", None, 3), (7, "some words here now", None, 3),
            (None, "some words here now", "z", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, key int")
    got = simhash.report(simhash.near_duplicates(df)).collect()
    assert len(got) == 5
    assert {(r.doc_id, r.component_id) for r in got} == {(5, 3), (3, 3), (7, 7), (None, 7)}
    assert {r.fingerprint for r in got if r.doc_id in (3, 5)} == {"0" * 16}
    assert simhash.near_duplicates(df.limit(0)).collect() == []


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(path, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}}


@pytest.mark.parametrize("center", ["least", "greatest", "middle"])
def test_components_of_hubs_and_chains(spark, center):
    """A hub with many neighbours, a chain, and a hub at the end of a chain, against a plain search."""
    prepare(spark)
    hub = {"least": 0, "greatest": 10_000, "middle": 500}[center]
    edges = [(hub, x) for x in range(1, 1_000) if x != hub] + [(20_000 + i, 20_001 + i) for i in range(60)]
    edges += [(30_000, 20_030)] + [(30_000, 30_001 + i) for i in range(50)] + [(7, 7), (40_000, 40_001), (40_001, 40_000), (None, 5)]
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        if None not in (u, v) and u != v:
            a, b = sorted((top(u), top(v)))
            parent[b] = a
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.root for r in graph.components(df).collect()}
    assert got == {x: top(x) for x in list(parent)}
