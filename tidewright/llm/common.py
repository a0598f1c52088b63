"""What the operators share: reading, checkpoints, words, and a let for arrays."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable
from types import ModuleType

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions of this package travel to the executors by value, so that a job
# does not depend on what is installed there.
cloudpickle.register_pickle_by_value(sys.modules["tidewright.llm"])

#: One run of the six white-space characters that part words.
SPACES = r"[ \t-\r]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make sure that checkpoint() has a folder.

    A cluster names a shared one in ``spark.checkpoint.dir``. Only a local
    master may fall back on a folder of this machine.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = sc.getConf().get("spark.checkpoint.dir")
    if named is None:
        if not (sc.master.startswith("local[") or sc.master == "local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="spark-checkpoint-")
    sc.setCheckpointDir(named)


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the checkpoint folder; later reads start there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as a Parquet table in the checkpoint folder; later reads take only the columns they need."""
    ensure_checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def once(key: tuple, make: Callable[[], object]) -> object:
    """``make()``, made once in a Python worker and kept for its further tasks.

    Functions and classes of this package reach a task as new copies, so the values are
    kept beside them, in a module of their own that is never sent anywhere.
    """
    held = vars(sys.modules.setdefault("_tidewright_held", ModuleType("_tidewright_held"))).setdefault("values", {})
    if key not in held:
        held[key] = make()
    return held[key]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once for each row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text, as an array; null gives an empty one."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def bucket32(key: Column) -> Column:
    """crc32 of a key's text, as the splits into learnt and held-out rows use it."""
    return F.crc32(key.cast("string").cast("binary"))
