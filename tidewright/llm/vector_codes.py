"""Product codes of vectors, trained by integer k-means.

Components become whole numbers, floor(4096 * x); a vector is cut into parts, and each
part position has a codebook of its own. Blocks of vectors are stored once as
dictionaries: for every dimension the distinct values that the block holds, and one code
a component. A round tabulates, for each dimension, the squared differences of every
distinct value to that dimension of all entries; the distance of a part to an entry is
then the sum of a few gathers from those tables. Only sums by entry leave a task, and
only the codebooks, a few numbers for each dimension, pass through the driver.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import stored

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Vectors of a block.
BLOCK = 4096
#: Components beyond this are counted with Python's integers, others in 64 bits.
SMALL = 1 << 24
LONG = (1 << 63) - 1
#: Labels that are broadcast with their sums; more are joined by a shuffle.
FEW_LABELS = 100_000


def kept(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """_id, _label, _x of the rows whose vector is there and has finite components only."""
    x = F.transform(vector_col, lambda c: c.cast("double"))
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.where(F.col(vector_col).isNotNull() & good).select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), x.alias("_x"))


def whole(x: list[float] | np.ndarray) -> list[int] | np.ndarray:
    """floor(4096 * x): in 64 bits, or as Python's integers where a component is large."""
    v = np.asarray(x, dtype=np.float64)
    if np.abs(v).max(initial=0.0) * SCALE < SMALL:
        return np.floor(v * SCALE).astype(np.int64)
    # from 2**53 on a double is whole
    made = [math.floor(c * SCALE) if abs(c) < 2**53 else int(c) * SCALE for c in v.ravel().tolist()]
    return np.array(made, dtype=object).reshape(v.shape)


def coded(block: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each dimension of a block its distinct values, and each vector's code among them."""
    both = [np.unique(block[:, d], return_inverse=True) for d in range(block.shape[1])]
    return [b[0] for b in both], [b[1].astype(np.min_scalar_type(len(b[0]))) for b in both]


def distances(values: list[np.ndarray], codes: list[np.ndarray], book: np.ndarray) -> np.ndarray:
    """Squared distances of a block's parts to the entries ``book`` (entries x dimensions): gathers from tables by value, added up."""
    total = None
    for d, (v, c) in enumerate(zip(values, codes, strict=True)):
        table = (v[:, None] - book[None, :, d]) ** 2
        total = table[c] if total is None else total + table[c]
    return total


def nearest(block: tuple[list[np.ndarray], list[np.ndarray]], books: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each part its number, the nearest entry of each vector (ties to the lower), and that distance."""
    width = books.shape[2]
    for p in range(len(books)):
        at = slice(p * width, (p + 1) * width)
        found = distances(block[0][at], block[1][at], books[p])
        best = np.argmin(found, axis=1) if found.dtype != object else np.array([min(range(len(r)), key=r.__getitem__) for r in found], dtype=np.int64)
        yield p, best, found[np.arange(len(found)), best]


def blocks(rows: DataFrame, dims: int) -> DataFrame:
    """n, block: up to ``BLOCK`` vectors of a task as dictionaries, with their ids and labels in ``ids`` (an Arrow stream)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                lists = part.column(2)
                x = np.zeros((part.num_rows, dims))
                length = np.diff(np.asarray(lists.offsets))
                x[np.arange(dims) < length[:, None]] = np.asarray(lists.flatten())
                sink = pa.BufferOutputStream()
                named = pa.RecordBatch.from_arrays(part.columns[:2], names=["id", "label"])
                with pa.ipc.new_stream(sink, named.schema) as out:
                    out.write_batch(named)
                made = [[part.num_rows], [pickle.dumps(coded(whole(x)), protocol=5)], [sink.getvalue().to_pybytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(made, (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["n", "block", "ids"])

    return rows.mapInArrow(make, "n long, block binary, ids binary")


def _sums(table: DataFrame, books: np.ndarray) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(part, entry) -> how many parts are nearest to it, and the sum of each of their components; entries without any are left out."""
    n_parts, n_entries, width = books.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((n_parts, n_entries), dtype=np.int64)
        total = np.zeros((n_parts, n_entries, width), dtype=object)
        for batch in batches:
            for raw in batch.column(0):
                values, codes = block = pickle.loads(raw.as_py())
                for p, best, _ in nearest(block, books):
                    count[p] += np.bincount(best, minlength=n_entries)
                    for j in range(width):
                        v = values[p * width + j]
                        # how often an entry's vectors have each value, summed by value
                        seen = np.zeros((n_entries, len(v)), dtype=np.int64)
                        np.add.at(seen, (best, codes[p * width + j]), 1)
                        total[p, :, j] += seen.astype(v.dtype) @ v
        out = [(p, e, str(count[p, e]), ",".join(map(str, total[p, e]))) for p in range(n_parts) for e in range(n_entries) if count[p, e]]
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.string(), pa.string()))], names=["part", "entry", "n", "total"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:  # one row a task and key, whole numbers of any size
        total = [sum(map(int, c)) for c in zip(*(t.split(",") for t in rows["total"]), strict=True)]
        return pd.DataFrame({"part": rows["part"][:1], "entry": rows["entry"][:1], "n": str(sum(map(int, rows["n"]))), "total": ",".join(map(str, total))})

    schema = "part int, entry int, n string, total string"
    summed = table.select("block").mapInArrow(partial, schema).groupBy("part", "entry").applyInPandas(add, schema)
    # at most one row for each codebook entry
    return {(r.part, r.entry): (int(r.n), list(map(int, r.total.split(",")))) for r in summed.collect()}


def trained(table: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """The codebooks after ``rounds`` rounds; an entry that no part is nearest to stays as it is."""
    for _ in range(rounds):
        new = books.astype(object)
        for (p, e), (n, total) in _sums(table, books).items():
            new[p, e] = [t // n for t in total]
        books = _fitting(new)
    return books


def _fitting(books: np.ndarray) -> np.ndarray:
    """Whole numbers in 64 bits if they are small."""
    return books.astype(np.int64) if all(abs(c) <= SMALL for c in books.ravel()) else books


def text(books: np.ndarray) -> str:
    """All components by part, entry and position."""
    return ",".join(str(int(c)) for c in books.ravel())


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(id_col, label_col, code, error, label_error) of every kept vector, and the codebooks (parts x entries x width).

    Rows whose vector is null or holds a null or a non-finite component are dropped. A
    codebook starts as the parts of the rows of the smallest ids (nulls last, ties by the
    vector); with fewer rows than ``entries`` it has as many entries as there are rows, and
    an empty table has none and gives no rows. Repeated rows count and are returned as
    often as they come. Vectors are filled up with zeros to the longest one's length, and
    that to a multiple of ``parts``. Components of any finite size count exactly; an error
    that is no long ends at its limit. Null labels are one label; other columns are left
    behind. ``code`` has two hexadecimal digits a part.
    """
    if entries > 256:
        raise ValueError("an entry's number has two hexadecimal digits")
    rows = stored(kept(vectors, id_col, vector_col, label_col))
    longest = rows.agg(F.max(F.size("_x"))).first()[0] or 0
    width = max(1, -(-longest // parts))
    dims = width * parts
    first = rows.orderBy(F.col("_id").asc_nulls_last(), "_x").limit(entries).select("_x").collect()
    start = whole(np.array([r[0] + [0.0] * (dims - len(r[0])) for r in first]).reshape(len(first), dims))
    books = _fitting(np.ascontiguousarray(start.reshape(len(first), parts, width).transpose(1, 0, 2)))
    table = stored(blocks(rows.select("_id", "_label", "_x"), dims))
    if len(first):
        books = trained(table, books, rounds)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, ids in zip(batch.column(0), batch.column(1), strict=True):
                named = pa.ipc.open_stream(ids.as_py()).read_all().combine_chunks().to_batches()[0]
                best, far = zip(*((b, f) for _, b, f in nearest(pickle.loads(raw.as_py()), books)), strict=True)
                code = [bytes(c).hex() for c in np.stack(best, axis=1).astype(np.uint8)]
                error = sum(f.astype(object) for f in far)
                made = [pa.array(code), pa.array([min(int(e), LONG) for e in error], pa.int64())]
                yield pa.RecordBatch.from_arrays([*named.columns, *made], names=[id_col, label_col, "code", "error"])

    kinds = {c: vectors.schema[c].dataType.simpleString() for c in (id_col, label_col)}
    out = stored(table.select("block", "ids").mapInArrow(assign, f"`{id_col}` {kinds[id_col]}, `{label_col}` {kinds[label_col]}, code string, error long"))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(str(LONG)).cast("decimal(38,0)")).cast("long")
    sums = stored(out.groupBy(F.col(label_col).alias("_label")).agg(total.alias("label_error")))
    sums = F.broadcast(sums) if sums.count() <= FEW_LABELS else sums
    return out.join(sums, F.col(label_col).eqNullSafe(F.col("_label"))).drop("_label"), books


def op12_vector_codes(spark, sf_dir: str) -> DataFrame:
    from tidewright.llm.common import read

    out, books = compress(read(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(text(books).encode()).hexdigest()).alias("codebooks_sha256"))


def _oracle() -> str:
    """DuckDB's version, round by round: distances as sums over zipped lists, means as sums by entry and position."""

    def assigned(k: int) -> str:
        d = "list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        return f"""a{k} AS (
  SELECT rid, part, arg_min(entry, {{'d': d, 'e': entry}}) AS entry, CAST(min(d) AS BIGINT) AS d
  FROM (SELECT p.rid, p.part, b.entry, {d} AS d FROM parts p JOIN b{k} b USING (part)) x GROUP BY rid, part)"""

    def next_book(k: int) -> str:
        return f"""m{k} AS (
  SELECT part, entry, list(CAST(floor(CAST(s AS DECIMAL(38,0)) / n) AS BIGINT) ORDER BY pos) AS v FROM (
    SELECT a.part, a.entry, u.pos, sum(p.v[u.pos]) AS s, count(*) AS n FROM a{k} a JOIN parts p USING (rid, part), (SELECT unnest(range(1, (SELECT w FROM width) + 1)) AS pos) u GROUP BY ALL) y
  GROUP BY part, entry),
b{k + 1} AS (SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{k} b LEFT JOIN m{k} m USING (part, entry))"""

    steps = ",\n".join(f"{assigned(k)},\n{next_book(k)}" for k in range(ROUNDS))
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), width AS (SELECT CAST(max(len(v)) // {PARTS} AS BIGINT) AS w FROM kept),
parts AS (SELECT rid, part, v[part * w + 1 : part * w + w] AS v FROM kept, width, (SELECT unnest(range({PARTS})) AS part) q),
b0 AS (SELECT part, rid - 1 AS entry, v FROM parts WHERE rid <= {ENTRIES}),
{steps},
{assigned(ROUNDS)},
coded AS (SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY rid),
sha AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM kept JOIN coded USING (rid), sha
"""


ORACLE = _oracle()
