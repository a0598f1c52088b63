"""The event sink: each event of a stream once, by batch first, then by venue and day.

A batch is a folder of its own, known by its number and written whole before its number
is listed, so a batch that is cut off and runs again replaces what it left. ``compact``
gathers listed batches into (venue, date) folders of a run, and lists the run last; from
then on readers take those batches from the run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.sources.tables import _exists, routed

BATCHES, RUNS = "batch BIGINT", "run BIGINT, first BIGINT, last BIGINT"


def _listed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def _note(spark: SparkSession, path: str, schema: str, row: tuple) -> None:
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(path)


def by_batch(root: str, today: Callable[[], str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: events with their date and whether they are late, to the folder of their batch."""

    def apply(batch: DataFrame, number: int) -> None:
        routed(batch, today()).write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/incoming/batch={number}")
        _note(batch.sparkSession, f"{root}/_batches", BATCHES, (number,))

    return apply


def _compacted(spark: SparkSession, root: str) -> int:
    """The last batch that readers take from a run; -1 for none."""
    last = _listed(spark, f"{root}/_runs", RUNS).agg(F.max("last")).first()[0]
    return -1 if last is None else last


def _incoming(spark: SparkSession, root: str, above: int) -> DataFrame | None:
    """Events of the listed batches above a number."""
    if not _exists(spark, f"{root}/incoming"):
        return None
    batches = _listed(spark, f"{root}/_batches", BATCHES).where(F.col("batch") > above).distinct()
    found = spark.read.option("basePath", f"{root}/incoming").parquet(f"{root}/incoming").withColumn("batch", F.col("batch").cast("long"))
    return found.where(F.col("batch") > above).join(batches, "batch", "left_semi")


def compact(spark: SparkSession, root: str, upto: int) -> int:
    """Gather the batches up to ``upto`` that no run has yet; their number as a run, or -1 if there are none.

    Nothing is removed, so readers of the former runs go on. A run that is cut off has no
    row in the list and is written again.
    """
    above = _compacted(spark, root)
    new = _incoming(spark, root, above)
    if new is None or upto <= above or new.where(F.col("batch") <= upto).isEmpty():
        return -1
    rows = new.where(F.col("batch") <= upto).drop("batch")
    rows = rows.repartition("venue", "date", F.pmod(F.xxhash64("instrument"), F.lit(64))).sortWithinPartitions("venue", "date", "instrument", "venue_ts")
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy("venue", "date").parquet(f"{root}/days/run={upto}")
    _note(spark, f"{root}/_runs", RUNS, (upto, above + 1, upto))
    return upto


def events(spark: SparkSession, root: str) -> DataFrame:
    """All events of the stream, each once: of the listed runs, and of the listed batches after them."""
    done = _compacted(spark, root)
    new = _incoming(spark, root, done)
    if done < 0:
        if new is None:
            raise FileNotFoundError(f"no batch at {root}")
        return new.drop("batch")
    runs = F.broadcast(_listed(spark, f"{root}/_runs", RUNS).select("run").distinct())
    old = spark.read.option("basePath", f"{root}/days").parquet(f"{root}/days").withColumn("run", F.col("run").cast("long")).join(runs, "run", "left_semi").drop("run")
    return old if new is None else old.unionByName(new.drop("batch"))
