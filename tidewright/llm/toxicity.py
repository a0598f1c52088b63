"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear SVM.

The kernel of two words counts the three-letter subsequences that they share within
five letters, each weighted by its gaps, so that an insult with a letter put in, or
spelt with other signs between its letters, still looks like itself. A word is
taken in lower case between two end marks; signs in it are dropped, and single
letters in a row are read as one word.

Landmarks are the words that tell toxic from other labelled texts best. A sentence
is described by the largest kernel value that any of its words has with each
landmark, whitened by the landmarks' own kernel matrix (Nyström), and a linear SVM
with hinge loss separates sentences: those of other texts, and those of toxic texts
that have a word near a landmark. A text's score is a logistic function of how many
such sentences and words it has for its length, fitted on the same sample.

Only words near a landmark enter a sentence; with these all their kernel values do.
Only words that share something with a landmark cost more than a lookup: kernel
values are sums over an index of the landmarks' subsequences, and words seen before
are remembered.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.sampling import held_out, labelled_sample

SAMPLE, LANDMARKS = 6000, 160
DECAY, SPAN = 0.4, 5
#: A word is near the landmarks if one of its kernel values is at least this; words farther off say nothing.
NEAR = 0.6
#: Bits of a letter's code, its code point; 0 stands between words, 1 and 2 are end marks.
BITS = 21
#: Bits of a hash of subsequences that tells most of those that no landmark has.
SIEVE = 16
MIX = np.uint64(0x9E3779B97F4A7C15)
EPOCHS, PENALTY = 60, 1e-3
#: A landmark is in so many toxic texts of the sample at least, and in this many times
#: as large a share of them as of the others.
MIN_TEXTS, MIN_LIFT = 4, 20
#: Rounds in which the SVM chooses anew which sentences of toxic texts are toxic.
ROUNDS = 3
CACHE = 400_000
#: Words whose kernel values are made at once.
WORDS = 512
#: Tasks that make the sample's features.
PARTS = 24
LIMIT = 0.7
#: (first gap end, second gap end, weight) of the subsequences of three.
SHAPES = [(a, b, DECAY ** (b - 2)) for b in range(2, SPAN) for a in range(1, b)]


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code of each letter with end marks and zeros between words; and the word of each."""
    text = "".join(f"\x01{w}\x02" + "\x00" * SPAN for w in words)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    sizes = np.array([len(w) + 2 + SPAN for w in words])
    return code, np.repeat(np.arange(len(words)), sizes)


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, number and weight of every subsequence of three."""
    code, word = _letters(words)
    out = []
    for a, b, weight in SHAPES:
        x, y, z = code[: -b or None], code[a : len(code) - b + a], code[b:]
        ok = np.flatnonzero((x > 0) & (y > 0) & (z > 0) & (word[: len(x)] == word[b:]))
        out.append((word[ok], (x[ok] << 2 * BITS) | (y[ok] << BITS) | z[ok], np.full(len(ok), weight)))
    return tuple(np.concatenate(p) for p in zip(*out, strict=True))


def _least_norms(words: list[str]) -> np.ndarray:
    """Length of a word's kernel vector if none of its subsequences came twice; else it is longer."""
    n = np.array([len(w) + 2 for w in words])
    return np.sqrt(np.maximum(1e-9, sum(w * w * np.maximum(0, n - b) for _, b, w in SHAPES)))


def _norms(words: list[str]) -> np.ndarray:
    """Length of a word's kernel vector: the root of its kernel with itself."""
    word, number, weight = subsequences(words)
    order = np.lexsort((number, word))
    word, number, weight = word[order], number[order], weight[order]
    starts = np.flatnonzero(np.r_[True, (word[1:] != word[:-1]) | (number[1:] != number[:-1])]) if len(word) else np.zeros(0, np.int64)
    total = np.add.reduceat(weight, starts) if len(starts) else np.zeros(0)
    return np.sqrt(np.maximum(1e-9, np.bincount(word[starts], total**2, len(words))))


class Kernel:
    """Kernel values of words with a fixed set of landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        word, number, weight = subsequences(landmarks) if landmarks else (np.zeros(0, int),) * 3
        self.numbers, at = np.unique(number, return_inverse=True)
        self.index = np.zeros((len(self.numbers), len(landmarks)), np.float32)
        np.add.at(self.index, (at, word), weight / (_norms(landmarks)[word] if landmarks else 1))
        self.sieve = np.zeros(1 << SIEVE, bool)
        self.sieve[self._hash(self.numbers)] = True

    @staticmethod
    def _hash(number: np.ndarray) -> np.ndarray:
        return (number.astype(np.uint64) * MIX) >> np.uint64(64 - SIEVE)

    def values(self, words: list[str]) -> np.ndarray:
        """A row for each word, made some words at a time."""
        parts = [self._values(words[k : k + WORDS]) for k in range(0, len(words), WORDS)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.landmarks)), np.float32)

    def _values(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        if not self.landmarks:
            return out
        word, number, weight = subsequences(words)
        hit = np.flatnonzero(self.sieve[self._hash(number)])
        slot = np.minimum(np.searchsorted(self.numbers, number[hit]), len(self.numbers) - 1)
        known = self.numbers[slot] == number[hit]
        hit, held = hit[known], slot[known]
        if len(hit):
            slot = np.zeros(len(number), np.int64)
            slot[hit] = held
            hit = hit[np.argsort(word[hit], kind="stable")]
            word, weight, slot = word[hit], weight[hit], slot[hit]
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            out[word[starts]] = np.add.reduceat(self.index[slot] * weight[:, None].astype(np.float32), starts)
        # a bound first, then the true values of the few words that may be near
        near = np.flatnonzero((out / _least_norms(words)[:, None]).max(axis=1, initial=0) >= NEAR)
        values = np.zeros_like(out)
        if len(near):
            values[near] = out[near] / _norms([words[i] for i in near])[:, None]
            values[values.max(axis=1, initial=0) < NEAR] = 0
        return values


class Reader:
    """Texts to the kernel values of their sentences."""

    def __init__(self, kernel: Kernel):
        self.kernel = kernel
        self.reset()

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.near: list[np.ndarray] = []  # kernel values of the words near a landmark
        self.near_words: list[str] = []
        self.row = np.zeros(0, np.int64)  # code -> place in near, or -1
        self.ends = np.zeros(0, bool)
        self.single = np.zeros(0, bool)

    @staticmethod
    def plain(token: str) -> str:
        return token if token.isalpha() else "".join(c for c in token if c.isalpha())

    def learn(self, tokens: list[str]) -> None:
        for k in range(0, len(tokens), 4096):
            part = tokens[k : k + 4096]
            words = [self.plain(t) for t in part]
            values = self.kernel.values(words)
            hit = values.any(axis=1)
            rows = np.full(len(part), -1)
            rows[hit] = len(self.near) + np.arange(int(hit.sum()))
            self.near += list(values[hit])
            self.near_words += [words[i] for i in np.flatnonzero(hit)]
            self.known.update(zip(part, range(len(self.row), len(self.row) + len(part)), strict=True))
            self.row = np.r_[self.row, rows]
            self.ends = np.r_[self.ends, [t[-1] in ".!?" for t in part]]
            self.single = np.r_[self.single, [len(w) == 1 for w in words]]

    def read(self, text: str | None) -> tuple[int, int, np.ndarray, list[int]]:
        """Words, sentences, and for words near a landmark: their sentence and place in ``near``."""
        tokens = (text or "").lower().split()
        if not tokens:
            return 0, 0, np.zeros(0, np.int64), []
        new = [t for t in set(tokens) if t not in self.known]
        if len(self.known) + len(new) > CACHE and self.known:
            self.reset()
            new = list(set(tokens))
        if new:
            self.learn(new)
        code = np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))
        sentence = np.r_[0, np.cumsum(self.ends[code])[:-1]]
        at = np.flatnonzero(self.row[code] >= 0)
        where, rows = sentence[at], self.row[code[at]].tolist()
        # letters that stand alone, three or more in a row, are one spelt-out word
        single = np.r_[False, self.single[code], False].astype(np.int8)
        begin, end = np.flatnonzero(np.diff(single) == 1), np.flatnonzero(np.diff(single) == -1)
        for b, e in zip(begin, end, strict=True):
            if e - b >= 3:
                word = self.plain("".join(tokens[b:e]))
                values = self.kernel.values([word])[0]
                if values.any():
                    rows.append(len(self.near))
                    self.near.append(values)
                    self.near_words.append(word)
                    where = np.r_[where, sentence[b]]
        return len(tokens), int(sentence[-1]) + 1, where, rows

    def values(self, rows: list[int]) -> np.ndarray:
        return np.stack([self.near[r] for r in rows]) if rows else np.zeros((0, len(self.kernel.landmarks)), np.float32)


class Model:
    def __init__(self, landmarks: list[str]):
        self.kernel = Kernel(landmarks)
        own = self.kernel.values(landmarks).astype(float)
        values, vectors = np.linalg.eigh((own + own.T) / 2 + 1e-6 * np.eye(len(landmarks))) if landmarks else (np.ones(0), np.zeros((0, 0)))
        self.whiten = vectors / np.sqrt(np.maximum(values, 0.05))
        self.w, self.b = np.zeros(len(landmarks)), -1.0
        self.logistic = np.zeros(6)

    def sentences(self, where: np.ndarray, values: np.ndarray) -> np.ndarray:
        """A row for each sentence with a word near a landmark."""
        order = np.argsort(where, kind="stable")
        starts = np.flatnonzero(np.r_[True, where[order][1:] != where[order][:-1]])
        return np.maximum.reduceat(values[order], starts) @ self.whiten.astype(np.float32)

    def fit_svm(self, x: np.ndarray, y: np.ndarray, seed: int = 3) -> None:
        """Hinge loss by averaged subgradient steps, both classes weighing the same."""
        rng = np.random.default_rng(seed)
        weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
        w, b, total_w, total_b, steps = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0, 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(y))
            for k in range(0, len(order), 256):
                some = order[k : k + 256]
                wrong = some[y[some] * (x[some] @ w + b) < 1]
                rate = 1.0 / (1 + epoch)
                g = weight[wrong] * y[wrong] / len(some)
                w = (1 - rate * PENALTY) * w + rate * (g @ x[wrong])
                b += rate * g.sum()
                total_w, total_b, steps = total_w + w, total_b + b, steps + 1
        self.w, self.b = total_w / steps, total_b / steps

    def fit_sentences(self, x: list[np.ndarray], toxic: list[bool]) -> None:
        """The SVM over sentences of texts. Of a toxic text, at first all its sentences count as
        toxic, then those on the toxic side and the one farthest there; the rest are left out."""
        chosen = [np.ones(len(s), bool) for s in x]
        for _ in range(ROUNDS):
            self.fit_svm(np.concatenate([s[c] for s, c in zip(x, chosen, strict=True)]), np.concatenate([np.full(int(c.sum()), 1.0 if t else -1.0) for c, t in zip(chosen, toxic, strict=True)]))
            for k, t in enumerate(toxic):
                if t:
                    margin = x[k] @ self.w + self.b
                    chosen[k] = (margin > 0) | (margin == margin.max())

    def summary(self, got: tuple[int, int, np.ndarray, np.ndarray]) -> np.ndarray:
        n_words, n_sentences, where, values = got
        if not len(where):
            return np.array([1.0, -1, 0, np.log(0.3 / (n_words + 30)), np.log(0.2 / (n_sentences + 3)), 0])
        margins = self.sentences(where, values) @ self.w + self.b
        sure = 1 / (1 + np.exp(-np.clip(3 * margins, -30, 30)))
        per_word = 1 / (1 + np.exp(-np.clip(3 * (values @ self.whiten @ self.w + self.b), -30, 30)))
        words, many = per_word.sum(), sure.sum()
        return np.array([1.0, np.tanh(margins.max()), np.log1p(words), np.log((words + 0.3) / (n_words + 30)), np.log((many + 0.2) / (n_sentences + 3)), words > 1.5])

    def fit_logistic(self, z: np.ndarray, y: np.ndarray) -> None:
        """Newton steps with a small ridge."""
        c = np.zeros(z.shape[1])
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(z @ c, -30, 30)))
            h = (z * (p * (1 - p))[:, None]).T @ z + 0.5 * np.eye(len(c))
            step = np.linalg.solve(h, z.T @ (y - p) - 0.5 * c)
            c += step
            if np.abs(step).max() < 1e-6:
                break
        self.logistic = c

    def probability(self, summary: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(summary @ self.logistic, -30, 30))))


def landmarks(sample: DataFrame, count: int = LANDMARKS) -> list[str]:
    """The words that most tell texts labelled 1 from the others, by weighted log odds."""
    word = F.explode(F.array_distinct(F.transform(F.split(F.lower("text"), r"\s+"), lambda w: F.regexp_replace(w, r"[^\p{L}]", ""))))
    sizes = sample.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    toxic, other = float(sizes[0] or 0), float(sizes[1] or 0)
    if not toxic or not other:
        return []
    counted = sample.select("label", word.alias("w")).where("length(w) between 3 and 30").groupBy("w").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("o"))
    odds = (F.col("t") / toxic) * F.log((F.col("t") + 0.1) / (toxic + 1) / ((F.col("o") + 0.5) / (other + 1)))
    best = counted.where((F.col("t") >= min(MIN_TEXTS, toxic)) & ((F.col("o") + 0.5) / other * MIN_LIFT < F.col("t") / toxic)).orderBy(odds.desc(), "w").limit(count)
    return [r.w for r in best.select("w").collect()]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model fitted on at most ``sample`` labelled rows; without both labels it says 0.5 to all."""
    from tidewright.llm.common import cut

    chosen = cut(labelled_sample(docs, labels, label, sample).select("text", "label", "deal"))
    model = Model(landmarks(chosen))
    if not model.kernel.landmarks:
        return model

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.kernel)
        for b in batches:
            got = []
            for t in b.column(0).to_pylist():
                n, s, at, near = reader.read(t)
                got.append((n, s, at, [reader.near_words[r] for r in near], zlib.crc32((t or "").encode("utf-8", "surrogatepass"))))
            if not got:
                continue
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.int64())
            yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(zip(*got, strict=True), kinds, strict=True)), b.column(1)], names=["n", "s", "at", "w", "h", "y"])

    rows = chosen.repartition(PARTS, "deal").drop("deal").mapInArrow(features, "n long, s long, at array<long>, w array<string>, h long, y double").toPandas()
    rows = rows.sort_values(["y", "n", "s", "h"], kind="stable", ignore_index=True)  # rows that tie have one text
    words = sorted({w for ws in rows["w"] for w in ws})
    place, near = {w: k for k, w in enumerate(words)}, model.kernel.values(words)
    got = [(int(n), int(s), np.asarray(at, np.int64), near[[place[w] for w in ws]]) for n, s, at, ws in zip(rows["n"], rows["s"], rows["at"], rows["w"], strict=True)]
    y = rows["y"].to_numpy()
    some = [i for i, g in enumerate(got) if len(g[2])]
    if some:
        model.fit_sentences([model.sentences(got[i][2], got[i][3]) for i in some], [bool(y[i] > 0) for i in some])
    model.fit_logistic(np.stack([model.summary(g) for g in got]), y)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score for each row; a null or empty text has the score of one without insults.

    Texts are read whole, however long; repeated rows have equal scores, an empty table
    gives no rows, and columns other than the text and the id are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.kernel)
        for b in batches:
            out = []
            for t in b.column(1).to_pylist():
                n, s, at, near = reader.read(t)
                out.append(model.probability(model.summary((n, s, at, reader.values(near)))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(rows, f"doc_id {kind}, score double")


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    from tidewright.llm.common import read

    docs = read(spark, sf_dir, "documents")
    scored = score(docs, train(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"))
