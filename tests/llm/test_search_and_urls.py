import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewright.llm import url_filter, vector_search
from tidewright.llm.queries import ORACLE_SQL


def slow_top(rows, k=5, every=50):
    good = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ints = [(i, [math.floor(256 * x) for x in v]) for i, v in good]
    out = []
    for n, (q, v) in enumerate(ints):
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for m, (i, w) in enumerate(ints) if m != n and len(w) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("scale", [0.2, 3.0, 1e6])
def test_search_like_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(vector_search, "CANDIDATES", 120)
    monkeypatch.setattr(vector_search, "QUERIES", 3)
    rng = random.Random(str(scale))
    rows = [(i, [rng.gauss(0, scale) for _ in range(8)]) for i in range(400)]
    rows += [(1000 + i, [0.25] * 8) for i in range(60)] + [(2000, [0.25] * 8), (2000, [0.25] * 8), (None, [0.25] * 8), (3000, None), (3001, [None] * 8), (3002, [float("nan")] * 8), (3050, [1.0] * 3), (3100, []), (3150, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in vector_search.search(df).collect()]
    assert sorted(got) == slow_top(rows)
    assert vector_search.search(df.where(F.lit(False))).count() == 0


def test_search_in_two_rounds(spark, monkeypatch):
    """Many vectors within the bounds of the best, one close to all queries, large groups of equal ones."""
    monkeypatch.setattr(vector_search, "CANDIDATES", 150)
    monkeypatch.setattr(vector_search, "HUB", 3)
    rng = random.Random(4)
    rows = [(i, [4.0 + rng.gauss(0, 0.02) for _ in range(16)]) for i in range(600)]
    rows += [(10_000 + i, [4.02] * 16) for i in range(400)] + [(7, [9.0] * 16), (7, [9.0] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    assert sorted(tuple(r) for r in vector_search.search(df).collect()) == slow_top(rows)


def test_zeros_meet_few(spark, monkeypatch):
    """Queries of zeros, to which all are alike, take ``k`` candidates of a block."""
    rng = random.Random(6)
    c = pd.DataFrame([(n, i, *vector_search.cells(vector_search.whole(np.array([rng.gauss(0, 1) for _ in range(4)])))) for n, i in enumerate(rng.sample(range(5000), 900))], columns=["row", "vec_id", "cell", "step", "far", "length"])
    least = c.sort_values("vec_id")["row"].tolist()
    [(i, j, upper)] = vector_search.reaching(np.zeros((2, 4)), np.array([least[1], 10_000]), c, 5)
    assert {n: {int(x) for x in c["row"].to_numpy()[j[i == n]]} for n in (0, 1)} == {0: {least[0], *least[2:6]}, 1: set(least[:5])}
    assert not upper.any()
    monkeypatch.setattr(vector_search, "CANDIDATES", 100)
    rows = [(i, [0.0] * 4 if i % 3 == 0 else [rng.gauss(0, 1) for _ in range(4)]) for i in range(700)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    assert sorted(tuple(r) for r in vector_search.search(df).collect()) == slow_top(rows)


@pytest.mark.parametrize("large", [1e14, 1e17, 1e30, 1e160, 1e306, 1.7e308])
def test_search_with_huge_components(spark, large):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(120)]
    rows += [(50, [large, 0.5, -large, 1.0]), (1, [large, 0.0, 0.0, 0.0]), (2, [-large, 1.0, large, 0.0]), (3, [-large] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    ints = [(i, [math.floor(x * 256) if abs(x) < 2**53 else int(x) * 256 for x in v]) for i, v in rows]
    want = []
    for n, (q, v) in enumerate(ints):
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for m, (i, w) in enumerate(ints) if m != n)[:5]
            want += [(q, r + 1, i, min(max(-s, -(2**63)), 2**63 - 1)) for r, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in vector_search.search(df).collect()) == sorted(want)


@pytest.mark.parametrize("name", ["op7_url_filter", "op10_vector_topk"])
def test_queries_against_sql(spark, sf_dir, name):
    duckdb = pytest.importorskip("duckdb")
    from tidewright.llm.queries import QUERIES

    con = duckdb.connect()
    for t in ("pages", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got, want = QUERIES[name](spark, sf_dir), con.sql(ORACLE_SQL[name])
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_lists_over_time(spark):
    d = lambda n: dt.date(2024, 1, n)
    log = [("Bad.com", d(3), True), ("bad.com", d(4), True), ("bad.com", d(10), False), ("bad.com", d(20), True), ("sub.bad.com", d(5), True), ("same.day", d(5), True), ("same.day", d(5), False), (None, d(1), True), ("x.org", None, True)]
    entries = spark.createDataFrame(log, "domain string, dated date, listed boolean")
    spans = url_filter.intervals(entries)
    assert sorted((r.domain, r.valid_from.day, r.valid_to and r.valid_to.day) for r in spans.collect()) == [("bad.com", 3, 10), ("bad.com", 20, None), ("sub.bad.com", 5, None)]
    asked = [(1, "http://BAD.com/x", d(2)), (1, "http://bad.com:80/x", d(3)), (2, "https://u@www.bad.com", d(9)), (3, "http://bad.com", d(10)), (4, "http://a.sub.bad.com?q", d(25)), (5, "http://notbad.com", d(25)), (6, None, d(25)), (7, "no url", d(25)), (8, "http://bad.com", None), (9, "http://same.day", d(9)), (2, "https://u@www.bad.com", d(9))]
    asked += [(10, "http://" + "a." * 20000 + "bad.com", d(9)), (11, "http://bad.com./x", d(9)), (12, "http://[2001:db8::1]:80/bad.com", d(9))]
    pages = spark.createDataFrame(asked, "page_id long, url string, fetched date").withColumn("domain", F.lit("clash"))
    got = sorted(((r.page_id, r.blocked, r.matched_domain) for r in url_filter.evaluate(pages, spans).collect()), key=str)
    assert got == sorted([(1, False, None), (1, True, "bad.com"), (2, True, "bad.com"), (2, True, "bad.com"), (3, False, None), (4, True, "sub.bad.com"), *((i, False, None) for i in range(5, 11)), (11, True, "bad.com"), (12, False, None)], key=str)
    assert url_filter.evaluate(pages.where(F.lit(False)), spans).count() == 0
    assert url_filter.evaluate(pages, spans.where(F.lit(False))).where("blocked").count() == 0


def test_parents_that_all_captures_share(spark):
    """A top-level domain that no list has meets nothing; a listed one blocks all its hosts, and the longer name is given."""
    d = lambda n: dt.date(2024, 1, n)
    pages = spark.range(4000).select(
        F.col("id").alias("page_id"),
        F.when(F.col("id") % 3 == 0, F.lit("https://hot.example.com/a")).otherwise(F.concat(F.lit("http://h"), F.col("id").cast("string"), F.lit(".site.com/"))).alias("url"),
        F.lit(d(10)).alias("fetched"),
    )
    entries = spark.createDataFrame([("example.com", d(2), True), ("h7.site.com", d(9), True), ("h8.site.com", d(11), True)], "domain string, dated date, listed boolean")
    got = {r.page_id: r.matched_domain for r in url_filter.evaluate(pages, url_filter.intervals(entries)).collect()}
    assert got == {i: "example.com" if i % 3 == 0 else "h7.site.com" if i == 7 else None for i in range(4000)}
    entries = entries.unionByName(spark.createDataFrame([("com", d(10), True), ("site.com", d(3), True), ("site.com", d(8), False)], "domain string, dated date, listed boolean"))
    got = {r.page_id: r.matched_domain for r in url_filter.evaluate(pages, url_filter.intervals(entries)).collect()}
    assert got == {i: "example.com" if i % 3 == 0 else "h7.site.com" if i == 7 else "com" for i in range(4000)}


def test_listed_rows_do_not_grow_with_blocks(spark, monkeypatch):
    """Many blocks of candidates list the very rows that one block lists, also for queries of few rows."""
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(3000)] + [(4000 + 50 * i, [1.0] * 3) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    prepared = vector_search.prepared(df).cache()
    asked = prepared.where("vec_id % 50 = 0").select(F.col("row").alias("query_row"), "dim", F.col("x").alias("q"))
    found = {}
    for size in (10_000, 100):
        monkeypatch.setattr(vector_search, "CANDIDATES", size)
        got = [(r.query_row, r.row) for r in vector_search.listed(vector_search.approximation(prepared), asked, 64).collect()]
        assert len(got) == len(set(got))
        found[size] = set(got)
    assert found[100] == found[10_000]
    assert 5 * 60 <= len(found[100]) < 20 * 60
