"""Bounded, repeatable samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import bucket32

#: The remainder of crc32(doc_id) modulo FOLDS that is held out where labels are learnt.
FOLDS, HELD = 3, 1


def held_out(key: Column, folds: int = FOLDS, held: int = HELD) -> Column:
    """Whether a row's id puts it in the held-out part; a null id does not."""
    return F.coalesce(F.pmod(bucket32(key), F.lit(folds)) == held, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str = "doc_id", text_col: str = "text", others: tuple[str, ...] = ()) -> DataFrame:
    """text, label, ``deal`` and ``others`` of the documents of at most ``rows`` labelled ids outside the held-out part.

    They are those of the smallest hash of the id, so a larger table gives an
    equally mixed sample. Rows with a null id, label or text are left out, and an
    id that is labelled twice counts as 1 if either label is. Where documents share an
    id, at most ``2 * rows`` of them are taken, those of the smallest text hash.
    ``deal`` is a hash of the id by which the rows may be dealt to tasks.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(label).cast("double").alias("label"))
    chosen = known.orderBy(F.xxhash64(F.col("_id").cast("string"), F.lit("sample")), "_id").limit(rows)
    read = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"), *others).where(F.col(text_col).isNotNull())
    # at most ``rows`` short rows are broadcast
    both = read.join(F.broadcast(chosen), "_id").withColumn("deal", F.xxhash64(F.col("_id").cast("string"), F.lit("deal"))).drop("_id")
    return both.orderBy(F.xxhash64("text"), "deal").limit(2 * rows)
