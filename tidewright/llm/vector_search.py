"""Exact top-k inner-product search with a vector-approximation file.

Vectors become integers, floor(256 * x). The file holds one byte a component, the
number of its cell on an even grid over the vector's own range, and how far the
vector lies from the middle of its cells; that bounds every inner product from both
sides (Cauchy-Schwarz). Only the file and the queries are dealt: candidates and
queries form blocks, and each pair of blocks is one group of a cogroup. With several
blocks of candidates a first pass gives each query's k highest lower bounds of every block,
of which the k-th over all blocks is its limit. A candidate is listed if its upper bound
reaches that, so the rows listed for a query do not grow with the number of blocks.

Exact vectors are then read by upper bound in two rounds: the k candidates of the
highest bounds, then those whose bounds reach the k-th exact score found. No other
can be among the best, so the result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewright.llm.common import cut, stored

K = 5
SCALE = 256
QUERY_EVERY = 50
CANDIDATES, QUERIES = 8192, 2048
#: Queries whose bounds are held at a time.
AT_ONCE = 128
#: Cells to either side of zero.
HALF = 127
#: Rounding of the bounds, against the largest product that the two lengths allow.
SLACK = 1e-9
#: A key of more than this share of all pairs, and of more pairs than HUB, is joined apart from the others.
HUB, HUB_SHARE = 1000, 1000
LONG = 2**63


def prepared(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """row, vec_id, dim, x (doubles, or floats where they are given). Rows without an id, and
    vectors that are null or hold a null or a non-finite component, are left out."""
    floats = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    x = F.col(vector_col) if floats else F.transform(vector_col, lambda c: c.cast("double"))
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & good).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), F.size(vector_col).alias("dim"), x.alias("x")
    )


def whole(x: np.ndarray) -> np.ndarray:
    """floor(256 * x), exact as a double unless it leaves their range."""
    with np.errstate(over="ignore"):
        return np.floor(x * SCALE)


def cells(v: np.ndarray) -> tuple[bytes, float, float, float]:
    """Cell numbers of a vector, the width of a cell, its distance from the cells' middle, and the middle's length."""
    top = float(np.abs(v).max(initial=0.0))
    if not top < 1e150:  # squares would leave the range of doubles; such bounds bound nothing
        return bytes(len(v)), 0.0, math.inf, 0.0
    step = top / HALF if top else 1.0
    number = np.rint(v / step)
    middle = number * step
    far = float(np.sqrt(np.square(v - middle).sum())) * (1 + SLACK)
    return number.astype(np.int8).tobytes(), step, far, float(np.sqrt(np.square(middle).sum()))


def approximation(rows: DataFrame) -> DataFrame:
    """row, vec_id, dim, cell, step, far, length, and a digest of 128 bits of the vector (h1, h2) for each of ``rows``."""
    shape = "row long, vec_id long, dim int, h1 long, h2 long, cell binary, step double, far double, length double"

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [cells(whole(np.asarray(x, dtype=np.float64))) for x in b.column(5).to_pylist()]
            cols = [pa.array([m[i] for m in made], t) for i, t in enumerate((pa.binary(), pa.float64(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], *cols], names=["row", "vec_id", "dim", "h1", "h2", "cell", "step", "far", "length"])

    return rows.select("row", "vec_id", "dim", F.xxhash64(F.lit(1), "x").alias("h1"), F.xxhash64(F.lit(2), "x").alias("h2"), "x").mapInArrow(make, shape)


def bounds(q: np.ndarray, own: np.ndarray, c: pd.DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For parts of the queries: the number of the first, lengths, upper and lower bounds against
    a block, and where a query meets its own row (there no bound is reached)."""
    rows, step, far, length = (c[x].to_numpy() for x in ("row", "step", "far", "length"))
    cell = np.frombuffer(b"".join(c["cell"]), dtype=np.int8).reshape(len(c), -1)
    with np.errstate(all="ignore"):
        for at in range(0, len(q), AT_ONCE):
            part = q[at : at + AT_ONCE]
            norm = np.sqrt(np.square(part).sum(axis=1))[:, None]
            middle = (part @ cell.T.astype(np.float64)) * step
            reach = norm * far + SLACK * norm * (length + far)
            upper, lower = np.nan_to_num(middle + reach, nan=np.inf, posinf=np.inf, neginf=np.inf), np.nan_to_num(middle - reach, nan=-np.inf, posinf=-np.inf, neginf=-np.inf)
            self_ = own[at : at + AT_ONCE, None] == rows
            upper[self_], lower[self_] = -np.inf, -np.inf
            yield at, norm, upper, lower, self_


def highest(q: np.ndarray, own: np.ndarray, c: pd.DataFrame, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of queries, and the up to ``k`` highest lower bounds of each in a block; those that bound nothing are left out."""
    for at, _, _, lower, _ in bounds(q, own, c):
        best = np.partition(lower, len(c) - k, axis=1)[:, len(c) - k :] if len(c) > k else lower
        i, j = np.nonzero(best > -np.inf)
        yield i + at, best[i, j]


def reaching(q: np.ndarray, own: np.ndarray, c: pd.DataFrame, k: int, limit: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Numbers of queries and of candidates of a block, and the upper bounds of those
    candidates that reach the query's ``limit`` and the k-th lower bound of the block.

    To a query of zeros all are alike, so it meets the ``k`` of the smallest ids.
    """
    first = np.lexsort((c["row"], c["vec_id"]))[: k + 1]
    limit = np.full(len(q), -np.inf) if limit is None else limit
    for at, norm, upper, lower, self_ in bounds(q, own, c):
        kth = np.partition(lower, len(c) - k, axis=1)[:, len(c) - k] if len(c) > k else np.full(len(lower), -np.inf)
        reached = (upper >= np.maximum(kth, limit[at : at + AT_ONCE])[:, None]) & ~self_
        for zero in np.flatnonzero(norm == 0):
            reached[zero], upper[zero] = False, 0.0
            reached[zero, first[~self_[zero, first]][:k]] = True
        i, j = np.nonzero(reached)
        yield i + at, j, upper[i, j]


def inner(q: list[float], x: list[float]) -> int:
    """The exact inner product of two vectors' integers."""
    a, b = whole(np.asarray(q, dtype=np.float64)), whole(np.asarray(x, dtype=np.float64))
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, len(a)) < 2**53:
        return int(a @ b) if len(a) else 0

    def integers(c: list[float]) -> list[int]:  # from 2**53 on a double is whole
        return [math.floor(y * SCALE) if abs(y) < 2**53 else int(y) * SCALE for y in c]

    return sum(s * t for s, t in zip(integers(q), integers(x), strict=True))


def _met(pairs: DataFrame, table: DataFrame, key: str, of: DataFrame, total: int) -> DataFrame:
    """``pairs`` with the columns of ``table``; at most ``HUB_SHARE`` keys that have very many of all pairs ``of`` are broadcast."""
    hubs = of.groupBy(key).count().where(F.col("count") > max(HUB, total // HUB_SHARE)).select(key)
    rest = pairs.join(F.broadcast(hubs), key, "left_anti").join(table, key)
    return rest.unionByName(pairs.join(F.broadcast(table.join(F.broadcast(hubs), key, "left_semi")), key))


def listed(file: DataFrame, asked: DataFrame, n_queries: int, k: int = K) -> DataFrame:
    """query_row, row, upper: the rows of the ``file`` that may be among a query's ``k`` best.

    ``asked`` has query_row, dim and q. The rows are those that one block of all rows would
    give, however many blocks there are; only a query of zeros takes ``k`` rows of each block.
    """
    c_blocks, q_blocks = max(1, -(-file.count() // CANDIDATES)), max(1, -(-n_queries // QUERIES))
    c_all, q_all = F.sequence(F.lit(0), F.lit(c_blocks - 1)), F.sequence(F.lit(0), F.lit(q_blocks - 1))
    block = lambda c, b, salt: F.pmod(F.xxhash64(c, F.lit(salt)), F.lit(b)).cast("int")
    key = ["dim", "c", "b"]
    candidates = file.select("dim", block("row", c_blocks, "c").alias("c"), F.explode(q_all).alias("b"), "row", "vec_id", "cell", "step", "far", "length")

    def dealt(queries: DataFrame, made: Callable[[pd.DataFrame, np.ndarray, np.ndarray, pd.DataFrame], list[pd.DataFrame]], **columns: str) -> DataFrame:
        def scan(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
            found = []
            if len(q) and len(c):
                found = made(q, whole(np.array(q["q"].tolist(), dtype=np.float64).reshape(len(q), -1)), q["query_row"].to_numpy(), c)
            return pd.concat(found) if found else pd.DataFrame({n: pd.Series(dtype=t) for n, t in columns.items()})

        asked = queries.select("dim", F.explode(c_all).alias("c"), block("query_row", q_blocks, "q").alias("b"), "query_row", "q", "limit")
        shape = ", ".join(f"{n} {'long' if t == 'int64' else 'double'}" for n, t in columns.items())
        return asked.groupBy(*key).cogroup(candidates.groupBy(*key)).applyInPandas(scan, shape)

    def lows(q: pd.DataFrame, v: np.ndarray, own: np.ndarray, c: pd.DataFrame) -> list[pd.DataFrame]:
        return [pd.DataFrame({"query_row": own[i], "low": low}) for i, low in highest(v, own, c, k)]

    def reach(q: pd.DataFrame, v: np.ndarray, own: np.ndarray, c: pd.DataFrame) -> list[pd.DataFrame]:
        limit, ids = q["limit"].to_numpy(dtype=np.float64), c["row"].to_numpy()
        return [pd.DataFrame({"query_row": own[i], "row": ids[j], "upper": u}) for i, j, u in reaching(v, own, c, k, limit)]

    free = asked.withColumn("limit", F.lit(-math.inf))
    if c_blocks > 1:  # the limit of one block is its own
        by_low = W.partitionBy("query_row").orderBy(F.desc("low"))
        top = dealt(free, lows, query_row="int64", low="float64").withColumn("n", F.row_number().over(by_low)).where(F.col("n") <= k)
        limits = cut(top.where(F.col("n") == k).select("query_row", F.col("low").alias("limit")))
        free = asked.join(limits, "query_row", "left").withColumn("limit", F.coalesce("limit", F.lit(-math.inf)))
    return dealt(free, reach, query_row="int64", row="int64", upper="float64")


def search(vectors: DataFrame, k: int = K, every: int = QUERY_EVERY, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` highest inner products, ties to smaller ids.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows
    but the query's own, also further rows of the same id. Vectors of different
    lengths are not compared; empty ones score 0. Any finite component counts as it
    is: ranks go by exact integers, and only the ``score`` shown ends at the limits of
    a long. Of equal vectors the ``k + 1`` rows of the smallest ids are candidates, as
    no query can list others. Other columns play no part. An empty table gives no rows.
    """
    rows = stored(prepared(vectors, id_col, vector_col))
    asked = rows.where(F.col("vec_id") % every == 0).select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), "dim", F.col("x").alias("q"))
    # only copies of one vector share a key, and each task passes on k + 1 rows of a key at most; what is dealt is the file
    alike = F.row_number().over(W.partitionBy("h1", "h2").orderBy("vec_id", "row"))
    file = cut(approximation(rows).withColumn("alike", alike).where(F.col("alike") <= k + 1).drop("h1", "h2", "alike"))
    largest, longest, n_queries = rows.agg(F.max(F.array_max(F.transform("x", F.abs))), F.max("dim"), F.count_if(F.col("vec_id") % every == 0)).first()
    # bytes that hold any score, shifted to be positive
    width = (2 * (max(0, math.frexp(largest or 0.0)[1]) + 9) + int(longest or 1).bit_length() + 2) // 8 + 1
    near = cut(listed(file, asked, n_queries, k))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [inner(q, x) for q, x in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)]
            order = [(s + (1 << (8 * width - 1))).to_bytes(width, "big") for s in got]
            least = [math.nextafter(float(s), -math.inf) if abs(s) < 2**1000 else -math.inf for s in got]
            shown = [min(max(s, -LONG), LONG - 1) for s in got]
            made = [pa.array(order, pa.binary()), pa.array(least, pa.float64()), pa.array(shown, pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *made], names=["query_row", "query_id", "vec_id", "order", "least", "score"])

    def read(pairs: DataFrame) -> DataFrame:
        total = pairs.count()
        both = _met(pairs.select("query_row", "row"), rows.select("row", "vec_id", "x"), "row", pairs, total)
        both = _met(both, asked.drop("dim"), "query_row", pairs, total)
        return cut(both.select("query_row", "query_id", "vec_id", "q", "x").mapInArrow(score, "query_row long, query_id long, vec_id long, order binary, least double, score long"))

    by_bound = W.partitionBy("query_row").orderBy(F.desc("upper"), "row")
    first = cut(near.withColumn("n", F.row_number().over(by_bound)).where(F.col("n") <= k))
    scored = read(first)
    # the k-th exact score so far; a query with fewer than k rows has no others
    enough = scored.groupBy("query_row").agg(F.min("least").alias("least"), F.count("*").alias("n")).where(F.col("n") == k).drop("n")
    rest = near.join(enough, "query_row").where(F.col("upper") >= F.col("least")).select("query_row", "row", "upper")
    rest = cut(rest.join(first.select("query_row", "row"), ["query_row", "row"], "left_anti"))
    rank = F.row_number().over(W.partitionBy("query_row").orderBy(F.desc("order"), "vec_id"))
    return scored.unionByName(read(rest)).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_vector_topk(spark, sf_dir: str) -> DataFrame:
    from tidewright.llm.common import read

    return search(read(spark, sf_dir, "embeddings"))


ORACLE = """
WITH e AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM e q JOIN e c ON q.rid <> c.rid AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
