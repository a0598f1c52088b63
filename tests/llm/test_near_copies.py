import random

import numpy as np
import pytest

from tidewright.llm import simhash


def grams(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(len(w) - 4)} or ({b" ".join(w)} if w else set())


def slow_groups(texts, similar=0.8):
    """For each text the smallest position that links of Jaccard similarity reach."""
    sets = [grams(t) for t in texts]
    at = {}
    for i, s in enumerate(sets):
        for g in s or {None}:
            at.setdefault(g, []).append(i)
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for met in {(i, j) for together in at.values() for i in together for j in together if j < i}:
        i, j = met
        if not sets[i] and not sets[j] or len(sets[i] & sets[j]) >= similar * len(sets[i] | sets[j]):
            root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


def test_stage_finds_similar_documents(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(60):
        w = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(60, 300))]
        texts.append(" ".join(w))
        for share in (0.005, 0.012, 0.02, 0.05):
            texts.append(" ".join(f"x{rng.randrange(9)}" if rng.random() < share else x for x in w))
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got, groups = {r.doc_id for r in kept.collect()}, slow_groups(texts)
    want = set(groups)
    assert want <= got  # only similar documents are linked
    assert len(got - want) <= 0.05 * (len(texts) - len(want))  # recall
    assert len(want) < 200


def test_rows_that_share_an_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a, "s"), (2, a, "s"), (2, b, "s"), (3, c, "s"), (3, b + " more", "t"), (5, "", "s"), (5, c, "s"), (None, c + " x", "s"), (None, "alone", "s"), (None, "alone", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = sorted((tuple(r) for r in simhash.keep_one(docs).collect()), key=str)
    assert got == sorted([(1, a, "s"), (2, b, "s"), (3, c, "s"), (5, "", "s"), (None, c + " x", "s"), (None, "alone", "s")], key=str)


@pytest.mark.parametrize("n", [40, 1500])
def test_pairs_of_a_bucket_connect_what_all_pairs_do(n):
    rng = np.random.default_rng(n)
    f = rng.integers(0, 2**63, (n, 2)).astype(np.uint64)
    f[: n // 2] = f[0] ^ (np.uint64(1) << rng.integers(0, 8, (n // 2, 2)).astype(np.uint64))
    bucket, size = np.repeat([3, 9], [n - 5, 5]), rng.choice([80, 100], n)
    i, j = simhash.bucket_pairs(bucket, size, f[:, 0], f[:, 1])
    a, b = np.nonzero(np.tri(n, k=-1))
    d = np.bitwise_count(f[a] ^ f[b]).astype(int).sum(axis=1)
    all_ = (bucket[a] == bucket[b]) & (d <= simhash.STAGE_RADIUS)
    assert (simhash.connected(n, i, j) == simhash.connected(n, a[all_], b[all_])).all()
    assert len(i) <= 8 * n + n or n <= simhash.LAGS


def test_tree_meets_every_near_pair_once():
    """Rows in a leaf of the stage's tree against all pairs within its radius."""
    rng = np.random.default_rng(5)
    f = rng.integers(0, 2**63, (3000, 2)).astype(np.uint64)
    f[1000:2000] = f[:1000] ^ (np.uint64(1) << rng.integers(0, 63, (1000, 2)).astype(np.uint64))
    f[2000:] = f[0] ^ (np.uint64(1) << rng.integers(0, 63, (1000, 2)).astype(np.uint64))
    places, mask = simhash.tree_bits(3, 7)
    assert len(places) == 7 and sum(int(m).bit_count() for m in mask) == simhash.SAMPLE
    seen, leaves = [], 0
    for stored, visiting in simhash.tree_leaves(f[:, 0], f[:, 1], mask, np.arange(3000), np.zeros(0, np.int64)):
        i, j = np.nonzero(np.tri(len(stored) + len(visiting), len(stored), -1, dtype=bool))
        both = np.concatenate([stored, visiting])
        seen.append(np.minimum(both[i], stored[j]) * 3000 + np.maximum(both[i], stored[j]))
        leaves += 1
    seen = np.concatenate(seen)
    a, b = np.nonzero(np.tri(3000, k=-1, dtype=bool).T)
    d = sum(np.bitwise_count((f[a, c] ^ f[b, c]) & mask[c]).astype(int) for c in (0, 1))
    near = (a * 3000 + b)[d <= simhash.SAMPLE_RADIUS]
    assert leaves > 10 and len(seen) == len(np.unique(seen)) < 0.8 * len(a)
    assert np.isin(near, seen).all()


def test_shards_and_trees_grow_with_the_table():
    few, many = simhash.forest_for(200), simhash.forest_for(10**9)
    assert few[0] == 0 and 10**9 / 2 ** many[0] <= simhash.SHARD
    assert few[1] < many[1] < 1000


def test_links_behind_pairs_that_fail_are_found(spark):
    """Many texts about as alike as the limit: a forest of nearest pairs has few of their links."""
    rng = random.Random(8)
    base, texts = [f"w{i}" for i in range(400)], []
    for i in range(260):
        w = list(base)
        for at in rng.sample(range(400), 6):
            w[at] = f"x{i}"
        texts.append(" ".join(w))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    groups = slow_groups(texts)
    assert 10 < len(set(groups)) < 250
    assert {r.doc_id for r in simhash.keep_one(docs).collect()} == set(groups)


def test_shards_in_the_tasks_give_the_same_documents(spark, monkeypatch):
    """Small shards and leaves, so that trees are parted and go on down."""
    rng = random.Random(4)
    texts = []
    for _ in range(300):
        w = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(60, 200))]
        texts += [" ".join(w), " ".join(f"x{rng.randrange(9)}" if rng.random() < 0.012 else x for x in w)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for name, value in (("SHARD", 200), ("STAGE_LEAF", 16), ("LAGS", 32)):
        monkeypatch.setattr(simhash, name, value)
    got, want = {r.doc_id for r in simhash.keep_one(docs).collect()}, set(slow_groups(texts))
    assert want <= got and len(got - want) <= 0.01 * (len(texts) - len(want))
