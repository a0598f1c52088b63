import math

import duckdb
import numpy as np
import pytest

from tidewright.llm import vector_codes as V


def plain(vectors, parts, entries, rounds):
    """By plain loops over Python's integers; vectors in the order of their ids."""
    dims = -(-max(map(len, vectors)) // parts) * parts
    rows = [[int(math.floor(c * 4096)) if abs(c) < 2**40 else int(c) * 4096 for c in v] + [0] * (dims - len(v)) for v in vectors]
    w = dims // parts
    cut = [[r[p * w : p * w + w] for p in range(parts)] for r in rows]
    books = [[r[p] for r in cut[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda x, book: min(range(len(book)), key=lambda e: (far(x, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            of = [near(r[p], books[p]) for r in cut]
            for e in range(len(books[p])):
                mine = [r[p] for r, o in zip(cut, of, strict=True) if o == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    codes = [[near(r[p], books[p]) for p in range(parts)] for r in cut]
    errors = [sum(far(r[p], books[p][c]) for p, c in enumerate(code)) for r, code in zip(cut, codes, strict=True)]
    return codes, errors, books


@pytest.mark.parametrize(("count", "dims", "scale"), [(90, 16, 1.0), (5, 12, 1.0), (40, 5, 1e6), (40, 8, 1e30), (1, 3, 0.0)])
def test_like_plain_loops(spark, monkeypatch, count, dims, scale):
    monkeypatch.setattr(V, "BLOCK", 16)
    rng = np.random.default_rng(count)
    vectors = [[float(c) for c in rng.normal(size=dims - (i % 3 == 2)) * scale] for i in range(count)]
    vectors += [vectors[0]] * 3  # repeated rows
    labels = [None if i % 4 == 0 else i % 3 for i in range(len(vectors))]
    rows = [(i, v, lab, "x") for i, (v, lab) in enumerate(zip(vectors, labels, strict=True))]
    bad = [(-1, None, 1, "x"), (-2, [1.0, None] + [0.0] * (dims - 2), 1, "x"), (-3, [math.nan] * dims, None, "x"), (-4, [math.inf] * dims, None, "x")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int, code string").repartition(3)
    out, books = V.compress(df)
    codes, errors, want = plain(vectors, V.PARTS, V.ENTRIES, V.ROUNDS)
    assert books.tolist() == want
    got = sorted(out.collect())
    total = {lab: sum(e for e, x in zip(errors, labels, strict=True) if x == lab) for lab in set(labels)}
    top = lambda e: min(e, V.LONG)
    assert [r.vec_id for r in got] == list(range(len(vectors)))
    assert [r.code for r in got] == ["".join(f"{c:02x}" for c in code) for code in codes]
    assert [r.error for r in got] == [top(e) for e in errors]
    if max(errors) < V.LONG:
        assert [r.label_error for r in got] == [top(total[x]) for x in labels]


def test_many_labels_and_nothing(spark, monkeypatch, sf_dir):
    want = {tuple(r) for r in V.op12_vector_codes(spark, sf_dir).collect()}
    monkeypatch.setattr(V, "FEW_LABELS", 0)
    assert {tuple(r) for r in V.op12_vector_codes(spark, sf_dir).collect()} == want
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    out, books = V.compress(none)
    assert out.count() == 0
    assert books.shape[1] == 0


def test_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = con.sql(V.ORACLE).df()
    got = V.op12_vector_codes(spark, sf_dir).toPandas()[list(want.columns)]
    order = lambda df: sorted(map(tuple, df.astype(object).itertuples(index=False)))
    assert order(got) == order(want)
