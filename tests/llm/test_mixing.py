import pytest
from pyspark.sql import functions as F

from tidewright.llm import mixing
from tidewright.llm.queries import ORACLE_SQL


def slow_targets(sizes, budget):
    """Share by weight, give back what is above twice a size, share again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, full, left = dict.fromkeys(names, 0.0), set(), budget
    while True:
        open_ = [s for s in names if s not in full]
        if not open_:
            return target
        total = sum(weight[s] for s in open_)
        share = {s: (budget - sum(2 * sizes[f] for f in full)) * weight[s] / total for s in open_}
        over = [s for s in open_ if share[s] >= 2 * sizes[s]]
        if not over:
            return {s: 2.0 * sizes[s] if s in full else share[s] for s in names}
        full.update(over)
        target |= {s: 2.0 * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 1000, "b": 10, "c": 3000, "d": 5, None: 400}, {"a": 10}, {"a": 0, "b": 90}, {"x": 1, "y": 1, "z": 1}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = slow_targets(sizes, 1.5 * sum(sizes.values()))
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_query_against_sql(spark, sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    got = mixing.op3_mixing(spark, sf_dir)
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(map(tuple, con.sql(ORACLE_SQL["op3_mixing"]).fetchall()))
    assert rows == sorted(map(tuple, mixing.op3_mixing(spark, sf_dir).collect()))


@pytest.mark.parametrize("seed", range(4))
def test_every_packet_ranged(spark, seed):
    """Against all packets sorted, for sources of very different sizes and many ties."""
    import hashlib
    import random

    rng = random.Random(seed)
    rows = [(rng.choice([None, i % 7, i]), rng.choice(["a b c", f"t{i} " * rng.choice([1, 3, 255, 256, 257, 900])]), rng.choice(["x", "x", "x", "y", "z", None, f"s{i % 5}"])) for i in range(120)]
    rows += [(None, "same text here", "hot")] * 60
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    goal = slow_targets(sizes, 1.5 * sum(sizes.values()))
    keyed = sorted((hashlib.md5(f"mix:{'null' if i is None else i}:{hashlib.md5(t.encode()).hexdigest()}".encode()).hexdigest(), n) for n, (i, t, _) in enumerate(rows))
    at, packets = dict.fromkeys(sizes, 0), []
    for key, n in keyed:
        _, t, s = rows[n]
        size = len(t.split())
        for r in range(2):
            packets += [((r * sizes[s] + at[s] + min(k + 256, size)) / goal[s], key, r, k, n, min(256, size - k)) for k in range(0, size, 256)]
        at[s] += size
    left, taken = int(1.5 * sum(sizes.values())), [0] * len(rows)
    for *_, n, words in sorted(packets):
        taken[n] += min(words, left)
        left -= min(words, left)
    got = mixing.mix(spark.createDataFrame(rows, "doc_id int, text string, source string").repartition(3))
    count = lambda x: sorted(map(str, x))
    assert count((r.doc_id, r.source, r.size, r.taken) for r in got.collect()) == count((i, s, len(t.split()), taken[n]) for n, (i, t, s) in enumerate(rows))


def test_near_targets_and_odd_rows(spark):
    rows = [(i, f"w{i} " * (5 + i % 400), f"s{i % 3}" if i % 2 else "s0", 1) for i in range(600)] + [(None, "a b c", None, 1), (1, None, "s1", 1), (2, "", "s2", 1), (7, "one two\tthree " * 20000, "s1", 1), (9, "x y", "s9", 1), (9, "x y", "s9", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mixing.mix(df).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max(F.col("taken") - 2 * F.col("size")).alias("over")).collect()
    assert all(abs(r.taken - r.target) <= mixing.PACKET and r.over <= 0 for r in got)
    assert abs(sum(r.taken for r in got) - 1.5 * mixing.mix(df).agg(F.sum("size")).first()[0]) <= 1
    out = mixing.emit(df)
    assert out.columns == df.columns
    sent = out.groupBy("source").agg(F.sum(F.size(F.array_remove(F.split("text", r"\s+"), ""))).alias("n"))
    assert {r.source: r.n for r in sent.collect()} == {r.source: r.taken for r in got if r.taken}
    names = df.withColumns({c: F.lit(c) for c in ("_i", "_s", "_d", "_n", "_size", "_words", "_taken", "row", "whole", "taken", "words", "bucket", "key", "start", "sent")})
    clash = mixing.emit(names)
    assert clash.columns == names.columns
    assert sorted(map(tuple, clash.select(*df.columns).collect()), key=str) == sorted(map(tuple, out.collect()), key=str)
    assert clash.where(" AND ".join(f"{c} = '{c}'" for c in names.columns[4:])).count() == clash.count()
    empty = df.where(F.lit(False))
    assert mixing.mix(empty).count() == 0 and mixing.emit(empty).count() == 0
