"""Language identification with bit-sliced Bloom filters of character trigrams.

One table has a row for every hash position and a bit for every language (64 in a
word, as many words as the languages need), so the AND of a trigram's rows gives all
languages whose filter holds it. A text's trigrams are counted for each language (the
popcount of that bit over them), the count is corrected for the filter's false
positives, and the language with the largest share decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewright.llm.common import bucket32, cut, stored

FOLDS, HELD = 4, 2
#: Rows to learn from, at most, of each language.
SAMPLE = 2000
ROWS_LOG2, HASHES = 18, 3
#: Parts of a language in which its first rows are looked for.
PARTS = 64
#: A trigram enters a language's filter if this share of the language's sampled texts has it.
MIN_SHARE = 0.05
UNKNOWN = "und"
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
SPACE = 32


def held_out(key: Column) -> Column:
    return F.coalesce(F.pmod(bucket32(key), F.lit(FOLDS)) == HELD, F.lit(False))


class Letters:
    """Texts to trigrams of letters, with a space for what stands between words."""

    def __init__(self) -> None:
        self.table = np.zeros(0x110000, bool)
        for a in range(0, 0x33000, 256):
            self.table[a : a + 256] = [chr(c).isalpha() for c in range(a, a + 256)]

    def trigrams(self, text: str | None) -> np.ndarray | None:
        """One number for each trigram that has two letters or more; None without a letter."""
        code = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = self.table[code]
        if not letter.any():
            return None
        keep = letter | np.r_[True, letter[:-1]]  # of a run of other characters the first stays
        code, letter = np.where(letter, code, SPACE)[keep].astype(np.uint64), letter[keep]
        if len(code) < 3:
            return np.zeros(0, np.uint64)
        grams = (code[:-2] << np.uint64(42)) | (code[1:-1] << np.uint64(21)) | code[2:]
        return grams[letter[1:-1] & (letter[:-2] | letter[2:])]


def positions(grams: np.ndarray) -> list[np.ndarray]:
    mixed = grams ^ (grams >> np.uint64(29))
    return [((mixed * np.uint64(m)) >> np.uint64(64 - ROWS_LOG2)).astype(np.int64) for m in MULTIPLIERS[:HASHES]]


class Filters:
    """The table (rows by 64-bit words), and for each language its false-positive rate."""

    def __init__(self, languages: list[str], table: np.ndarray):
        self.languages, self.table = languages, table.reshape(len(table), -1)
        self.false = np.array([float(self._holds(self.table, k).mean()) ** HASHES for k in range(len(languages))])

    @staticmethod
    def _holds(mask: np.ndarray, k: int) -> np.ndarray:
        return (mask[:, k // 64] & np.uint64(1 << k % 64)) != 0

    def shares(self, grams: np.ndarray) -> np.ndarray:
        """For each language the share of the trigrams that its filter truly holds, as estimated."""
        first, *others = positions(grams)
        mask = self.table[first]
        for p in others:
            mask = mask & self.table[p]
        held = np.array([np.count_nonzero(self._holds(mask, k)) for k in range(len(self.languages))], float)
        return np.clip((held / max(1, len(grams)) - self.false) / (1 - self.false), 0, 1)

    def decide(self, grams: np.ndarray | None) -> tuple[str, float]:
        if grams is None or not self.languages:
            return UNKNOWN, 0.0
        share = self.shares(grams)
        best = int(share.argmax())
        return self.languages[best], float(share[best] / share.sum()) if share.sum() > 0 else 0.0


def train(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Filters:
    """Filters from at most ``sample`` rows of each language outside the held-out part, those of the smallest id hash.

    Rows with a null id or language teach nothing; rows that repeat an id all learn if
    one does. Without any row to learn from there are no languages.
    """
    known = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    known = known.where(F.col("lang").isNotNull() & F.col("i").isNotNull() & ~held_out(F.col("i"))).withColumn("h", F.xxhash64(F.col("i").cast("string"), F.lit("language")))
    # ids and languages alone say which rows learn: the first of each part of a language, then the first of all its parts
    first = known.select("lang", "h", F.pmod("h", F.lit(PARTS)).alias("part"))
    for keys in (("lang", "part"), ("lang",)):
        first = first.withColumn("n", F.row_number().over(W.partitionBy(*keys).orderBy("h"))).where(F.col("n") <= sample).drop("n")
    edges = stored(first.groupBy("lang").agg(F.max("h").alias("edge")))
    chosen = known.join(edges, "lang").where("h <= edge")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                got = letters.trigrams(text)
                if got is not None:
                    own = np.r_[np.uint64(0), np.unique(got)].astype(np.int64)  # zero counts the texts
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(own)], names=["lang", "gram"])

    counted = cut(chosen.select("lang", "text").mapInArrow(grams, "lang string, gram long").groupBy("lang", "gram").count())
    texts = counted.where("gram = 0").select("lang", F.col("count").alias("texts"))
    names = sorted(r.lang for r in texts.collect())
    width = max(1, -(-len(names) // 64))
    table = np.zeros((1 << ROWS_LOG2, width), np.uint64)
    if not names:
        return Filters([], table)
    # a row for each language on either side
    number = counted.sparkSession.createDataFrame([(n, k) for k, n in enumerate(names)], "lang string, bit int")
    frequent = counted.where("gram <> 0").join(texts, "lang").where(F.col("count") >= F.greatest(F.lit(1.0), F.col("texts") * MIN_SHARE)).join(number, "lang").select("gram", "bit")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            gram = b.column(0).to_numpy().astype(np.uint64)
            bit = b.column(1).to_numpy(zero_copy_only=False).astype(np.uint64)
            one = (np.uint64(1) << bit % np.uint64(64)).view(np.int64)
            cols = [np.concatenate(positions(gram)), np.tile((bit // np.uint64(64)).astype(np.int64), HASHES), np.tile(one, HASHES)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["at", "word", "bits"])

    slices = frequent.mapInArrow(rows, "at long, word long, bits long").groupBy("at", "word").agg(F.bit_or("bits").alias("bits")).toPandas()
    table[slices["at"].to_numpy(), slices["word"].to_numpy()] = slices["bits"].to_numpy(np.int64).view(np.uint64)
    return Filters(names, table)


def identify(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for each row; ``und`` and 0 where a text is null or has no letter.

    Of languages with equal shares the first by name is taken; so it is, with the score
    0, where no filter holds anything of a text, such as a single letter. Texts are read
    whole, however long; repeated rows are answered alike; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for b in batches:
            got = [filters.decide(letters.trigrams(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(rows, f"doc_id {kind}, lang_pred string, score double")


def op9_language(spark, sf_dir: str) -> DataFrame:
    from tidewright.llm.common import read

    docs = read(spark, sf_dir, "documents")
    return identify(docs, train(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
