"""A factorisation machine over hashed words, structure statistics and metadata.

Every feature has a weight and a short factor vector; the score adds the
weighted features and, through the factors, all their pairwise products. The
sum-of-squares identity makes that linear in the number of features:

    sum over i < j of <v_i, v_j> x_i x_j
        = (|sum of v_i x_i|^2 - sum of |v_i x_i|^2) / 2

Words enter as the set of their hash buckets, scaled to unit length; structure
statistics of the text and the metadata ``n_chars`` enter standardised. The
model is fitted with AdaGrad on a bounded sample of labelled rows, whose features
are made on the executors; its size is fixed, so it goes to the tasks as it is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.sampling import held_out, labelled_sample

SAMPLE = 6000
BUCKETS, FACTORS, STATISTICS = 1 << 14, 8, 15
EPOCHS, BATCH, RATE, PENALTY = 8, 128, 0.08, 1e-4
#: Words whose buckets are remembered in a task.
CACHE = 400_000


class Features:
    """Buckets and statistics of texts."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def buckets(self, tokens: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > CACHE:
            known.clear()
        for w in [w for w in set(tokens) if w not in known]:
            known[w] = zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS
        return np.unique(np.fromiter(map(known.__getitem__, tokens), np.int32, len(tokens)))

    @staticmethod
    def statistics(text: str, tokens: list[str], n_chars: float | None) -> np.ndarray:
        byte = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
        total, n = max(1, int(byte.sum())), max(1, len(tokens))
        lines = [x for x in text.split("\n") if x.strip()]
        upper, lower = byte[65:91].sum(), byte[97:123].sum() + byte[128:].sum() / 2
        marks = byte[[ord(c) for c in "#*$%&|<>"]].sum()
        return np.array(
            [
                np.log1p(len(tokens)), np.log1p(total), np.log1p(max(0.0, n_chars or 0.0)), min(50.0, total / n), upper / (upper + lower + 1), byte[48:58].sum() / total,
                marks / n, byte[ord("!")] / n, byte[ord("|")] / n, byte[[ord(c) for c in ".,;:?"]].sum() / n, byte[128:].sum() / total, np.log1p(len(lines)),
                len(set(lines)) / max(1, len(lines)), len(set(tokens)) / n, len({*zip(tokens, tokens[1:], strict=False)}) / n,
            ]
        )

    def of(self, text: str | None, n_chars: float | None) -> tuple[np.ndarray, np.ndarray]:
        text = text or ""
        tokens = text.lower().split()
        return self.buckets(tokens), self.statistics(text, text.split(), n_chars)


class Machine:
    """Weights, factors and the scale of the statistics. Rows after BUCKETS are the statistics."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.bias = 0.0
        self.w = np.zeros(BUCKETS + STATISTICS)
        self.v = rng.normal(0, 0.01, (BUCKETS + STATISTICS, FACTORS))

    def row(self, buckets: np.ndarray, statistics: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers and values."""
        z = np.clip((statistics - self.mean) / self.scale, -4, 4) / np.sqrt(STATISTICS)
        at = np.concatenate([buckets, np.arange(BUCKETS, BUCKETS + STATISTICS)])
        return at, np.concatenate([np.full(len(buckets), 1 / np.sqrt(max(1, len(buckets)))), z])

    def margin(self, at: np.ndarray, x: np.ndarray) -> float:
        vx = self.v[at] * x[:, None]
        return self.bias + self.w[at] @ x + 0.5 * float((vx.sum(axis=0) ** 2).sum() - (vx**2).sum())

    def probability(self, at: np.ndarray, x: np.ndarray) -> float:
        return 1 / (1 + float(np.exp(-np.clip(self.margin(at, x), -30, 30))))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int = 2) -> None:
        rng = np.random.default_rng(seed)
        sums = [np.full_like(p, 1e-6) for p in (self.w, self.v)]
        share = np.clip(y.mean(), 0.01, 0.99)
        self.bias, bias_sum = float(np.log(share / (1 - share))), 1e-6
        for _ in range(EPOCHS):
            order = rng.permutation(len(rows))
            for k in range(0, len(order), BATCH):
                some = order[k : k + BATCH]
                at, x = (np.concatenate([rows[i][j] for i in some]) for j in (0, 1))
                sizes = np.array([len(rows[i][0]) for i in some])
                starts, of = np.r_[0, np.cumsum(sizes)[:-1]], np.repeat(np.arange(len(some)), sizes)
                vx = self.v[at] * x[:, None]
                total = np.add.reduceat(vx, starts)
                linear = np.add.reduceat(self.w[at] * x, starts)
                margin = self.bias + linear + 0.5 * ((total**2).sum(axis=1) - np.add.reduceat((vx**2).sum(axis=1), starts))
                slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[some]) / len(some)
                g = (slope[of] * x)[:, None] * (total[of] - vx)
                touched, where = np.unique(at, return_inverse=True)
                gw = np.bincount(where, slope[of] * x, len(touched)) + PENALTY * self.w[touched]
                gv = np.stack([np.bincount(where, g[:, f], len(touched)) for f in range(FACTORS)], axis=1) + PENALTY * self.v[touched]
                for p, s, d in ((self.w, sums[0], gw), (self.v, sums[1], gv)):
                    s[touched] += d**2
                    p[touched] -= RATE * d / np.sqrt(s[touched])
                bias_sum += slope.sum() ** 2
                self.bias -= RATE * slope.sum() / np.sqrt(bias_sum)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Machine:
    """A machine fitted on at most ``sample`` labelled rows; without any it says 0.5 to all."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Features()
        for b in batches:
            got = [made.of(t, n) for t, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            seen = pa.array([zlib.crc32((t or "").encode("utf-8", "surrogatepass")) for t in b.column(0).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.list_(pa.float64())), b.column(2), seen], names=["b", "s", "y", "h"])

    chosen = labelled_sample(docs.withColumn("_meta", F.col("n_chars").cast("double")), labels, label, sample, others=("_meta",))
    got = chosen.select("text", "_meta", "label", "deal").repartition(24, "deal").drop("deal").mapInArrow(features, "b array<int>, s array<double>, y double, h long").toPandas()
    got = got.sort_values(["h", "y"], kind="stable", ignore_index=True)  # the same order each time; rows that tie have one text
    if got.empty:
        machine = Machine(np.zeros(STATISTICS), np.ones(STATISTICS))
        machine.v[:] = 0
        return machine
    stats = np.stack(got["s"].to_numpy())
    machine = Machine(stats.mean(axis=0), stats.std(axis=0) + 1e-3)
    machine.fit([machine.row(np.asarray(b, np.int32), s) for b, s in zip(got["b"], stats, strict=True)], got["y"].to_numpy())
    return machine


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score for each row; null and empty texts are scored by their statistics.

    Texts are read whole, however long; repeated rows have equal scores, an empty table
    gives no rows, and columns other than the text, the id and ``n_chars`` are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Features()
        for b in batches:
            out = [machine.probability(*machine.row(*made.of(t, n))) for t, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col("n_chars").cast("double")).mapInArrow(rows, f"doc_id {kind}, score double")


def op4_quality_fm(spark, sf_dir: str) -> DataFrame:
    from tidewright.llm.common import read

    docs = read(spark, sf_dir, "documents")
    scored = score(docs, train(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


