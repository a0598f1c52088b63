"""Windows of validity: overlaps, crowded keys, case, nulls."""

import random

import pytest

from tidewright.operators import reference

DIMS = "sym string, name string, rank int, valid_from long, valid_to long"


def brute(facts, dims):
    """For each fact the first covering row by (rank, start, end)."""
    end = lambda d: d[4] if d[4] is not None else 2**63
    for key, at, tag in facts:
        good = [d for d in dims if None not in (key, at, d[0], d[3]) and d[0].lower() == key.lower() and d[3] <= at < end(d)]
        best = min(good, key=lambda d: (d[2] is not None, d[2] or 0, d[3], end(d)), default=None)
        yield key, at, tag, best[1] if best else None


@pytest.mark.parametrize("page", [1, 3, 1000])
@pytest.mark.parametrize("seed", range(2))
def test_first_covering(spark, monkeypatch, page, seed):
    monkeypatch.setattr(reference, "PAGE", page)
    rng = random.Random(seed)
    day = 86_400_000_000_000
    at = lambda: rng.choice([rng.randrange(0, 40), rng.randrange(0, 20 * day, day // 3)])
    dims = []
    for i in range(60):
        start = at()
        dims.append((rng.choice(["a", "A", "b", "c", None]), f"n{i}", rng.choice([None, i, i]), rng.choice([start] * 9 + [None]), rng.choice([None, start + rng.randrange(-1, 5 * day), start + 7])))
    dims += [("d", f"d{i}", i, i * day, (i + 1) * day) for i in range(12)]  # no overlap
    facts = [(rng.choice(["a", "A", "b", "C", "d", "z", None]), rng.choice([at(), at(), None]), i) for i in range(150)] + [("a", 5, 900)] * 2
    f = spark.createDataFrame(facts, "sym string, at long, rank long")
    d = spark.createDataFrame(dims, DIMS)
    key = lambda r: tuple((x is None, x) for x in r)
    want = sorted(brute(facts, dims), key=key)
    got = reference.first_covering(f.withColumnRenamed("rank", "tag"), d, ["sym"], "at", ["rank"], "left", ("sym",))
    assert sorted((tuple(r)[:4] for r in got.collect()), key=key) == want
    inner = reference.first_covering(f.withColumnRenamed("rank", "tag"), d, ["sym"], "at", ["rank"], "inner", ("sym",))
    assert sorted((tuple(r)[:4] for r in inner.collect()), key=key) == [w for w in want if w[3] is not None]
    windows = reference.disjoint_windows(d.where("sym IS NOT NULL"), ["sym"], ["rank"]).collect()
    for s in {w.sym for w in windows}:
        mine = sorted((w.valid_from, w.valid_to) for w in windows if w.sym == s) if s != "a" else []
        assert all(b is not None and b <= c for (_, b), (c, _) in zip(mine, mine[1:], strict=False))


def test_a_key_of_many_windows(spark):
    """A hundred thousand windows of one key within one day: a fact meets one page."""
    n = 100_000
    d = spark.range(n).selectExpr("'x' AS sym", "id AS valid_from", "id + 1 AS valid_to", "id AS no")
    f = spark.range(0, n, 7).selectExpr("'X' AS sym", "id AS at")
    out = reference.first_covering(f, d, ["sym"], "at", ["no"], folded=("sym",))
    assert out.where("no = at").count() == out.count() == f.count()


def test_nothing(spark):
    none = spark.createDataFrame([], DIMS)
    f = spark.createDataFrame([("a", 1)], "sym string, at long")
    assert reference.first_covering(f, none, ["sym"], "at", ["rank"]).count() == 0
    assert [tuple(r) for r in reference.first_covering(f, none, ["sym"], "at", ["rank"], "left").collect()] == [("a", 1, None, None)]
