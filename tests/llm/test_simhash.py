import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidewright.llm import simhash


def slow_fingerprint(text):
    w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if x]
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps, radius=2):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


def test_fingerprint():
    rng = random.Random(1)
    for t in [None, "", "a", "A b", "É a b", "x y z\x0bw", *(" ".join(rng.choices("ab cd ef Gh".split(), k=rng.randint(1, 40))) for _ in range(40))]:
        got = simhash.fingerprint(t.encode() if t is not None else None)
        assert got % 2**64 == slow_fingerprint(t)


@pytest.mark.parametrize("levels", [3, 4])
def test_links_find_every_pair(spark, monkeypatch, levels):
    monkeypatch.setattr(simhash, "LEVELS", (levels, levels))
    rng = random.Random(levels)
    fps = {0, 2**64 - 1}
    while len(fps) < 400:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 5])):
            fps.add(x)
            for _ in range(rng.randint(0, 3)):
                x ^= 1 << rng.randrange(64)
    fps = sorted(fps)
    rng.shuffle(fps)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3)
    roots = {r.u: r.v for r in simhash.components(simhash.links(nodes)).collect()}
    got = {}
    for f in signed:
        got.setdefault(roots.get(f, f), set()).add(f)
    want = {}
    for f, c in zip(signed, slow_components(fps), strict=True):
        want.setdefault(c, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_large_leaf_goes_on_down_the_tree():
    """A dense leaf, many variants of one template and a few others, against all pairs."""
    rng = random.Random(9)
    base, fps = rng.getrandbits(64), set()
    while len(fps) < 2600:
        x = base if rng.random() < 0.8 else rng.getrandbits(64)
        for _ in range(rng.randint(1, 9)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    a = np.array(sorted(fps), np.uint64).view(np.int64)
    rng2 = np.random.default_rng(1)
    a = rng2.permutation(a)
    stored, visiting = a[:1900], a[1900:]

    def groups(u, v):
        at = {x: i for i, x in enumerate(a.tolist())}
        label = simhash.connected(len(a), np.array([at[x] for x in u.tolist()], int), np.array([at[x] for x in v.tolist()], int))
        return label.tolist()

    got = simhash.leaf_links(stored, visiting)
    assert len(got[0]) < len(a)
    assert groups(*got) == groups(*simhash._side_by_side(stored, visiting, 2))


def test_hubs_and_chains(spark):
    """A star, a chain, and a clique through the smallest node, some of over ``HUB`` links."""
    edges = [(1, n) for n in range(2, 300)] + [(n, n + 1) for n in range(1000, 1040)] + [(a, b) for a in range(2000, 2015) for b in range(2000, a)] + [(5000, n) for n in range(4000, 4200)]
    got = {r.u: r.v for r in simhash.components(spark.createDataFrame(edges, "u long, v long").repartition(4)).collect()}
    want = {n: 1 for n in range(2, 300)} | {n: 1000 for n in range(1001, 1041)} | {n: 2000 for n in range(2001, 2015)} | {n: 4000 for n in [*range(4001, 4200), 5000]}
    assert got == want


def test_query_against_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted(docs.select("doc_id", "text").collect())
    fps = [slow_fingerprint(r.text) for r in rows]
    want = {(r.doc_id, f"{f:016x}", rows[c].doc_id) for r, f, c in zip(rows, fps, slow_components(fps), strict=True)}
    assert {tuple(r) for r in simhash.op6_simhash(spark, sf_dir).collect()} == want


def test_odd_rows(spark):
    rows = [(5, None, 1), (3, "", 2), (7, "a b", 3), (None, "a b", 4), (7, "a b", 5), (9, "word " * 30000, 6), (None, "only this one", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp long")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (7, 7), (None, 7), (7, 7), (9, 9), (None, None)], key=str)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 7, None, 9, None], key=str)
    assert simhash.near_duplicates(docs.where(F.lit(False))).count() == 0
