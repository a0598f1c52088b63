"""Publishing closed days: each once, whole or not at all, and each on its own.

A day's tables are staged under the number of their run, where no reader looks. The
publisher reads them back and checks them; a row of the registry, written last, makes
that run the day's. A reader takes for each day the run of its newest row, so it finds
the former run or the new one at any time, also on stores that cannot rename a folder.
What a run without a row has left is never read; the next run of the day is another one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.sources.tables import QUIET_S, _exists, laid_out

REGISTRY = "venue STRING, date STRING, run STRING, status STRING, failures ARRAY<STRING>, rows MAP<STRING, BIGINT>, published_at BIGINT"
OUTCOME = "venue STRING, date STRING, outcome STRING, status STRING, reason STRING"
PASS, FAIL = "pass", "fail"


def registry(spark: SparkSession, root: str) -> DataFrame:
    """The newest row of each published day."""
    path = f"{root}/_published"
    rows = spark.read.schema(REGISTRY).parquet(path) if _exists(spark, path) else spark.createDataFrame([], REGISTRY)
    newest = rows.groupBy("venue", "date").agg(F.max_by(F.struct("run", "status", "failures", "rows", "published_at"), F.struct("published_at", "run")).alias("r"))
    return newest.select("venue", "date", "r.*")


def _place(root: str, table: str, venue: str, date: str, run: str) -> str:
    return f"{root}/{table}/venue={venue}/date={date}/run={run}"


def publish_day(spark: SparkSession, root: str, venue: str, date: str, tables: dict[str, DataFrame], check: Callable[[dict[str, DataFrame]], list[str]], run: str, now_ns: int) -> str:
    """Stage a day's tables, check what was staged, and list it; the status, pass or fail.

    ``check`` gets the staged tables and gives what fails the day, as texts. A day that
    fails its checks is published with them; one whose tables or checks raise is not.
    """
    for name, df in tables.items():
        laid_out(df.drop("venue", "date")).mode("overwrite").parquet(_place(root, name, venue, date, run))
    staged = {name: spark.read.schema(df.drop("venue", "date").schema).parquet(_place(root, name, venue, date, run)) for name, df in tables.items()}
    failures = check(staged)
    rows = {name: df.count() for name, df in staged.items()}
    status = FAIL if failures else PASS
    spark.createDataFrame([(venue, date, run, status, failures, rows, now_ns)], REGISTRY).coalesce(1).write.mode("append").parquet(f"{root}/_published")
    return status


def due_days(written: DataFrame, published: DataFrame, as_of: str, now: str, quiet_s: int = QUIET_S) -> DataFrame:
    """venue, date, quiet: the days before ``as_of`` that are not published, and whether their files have rested.

    ``written`` has venue, date and modified_at (a timestamp) of the files of captured days.
    """
    days = written.groupBy("venue", F.col("date").cast("string").alias("date")).agg(F.max("modified_at").alias("last")).where(F.col("date") < as_of)
    rested = F.col("last") <= F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {quiet_s} SECONDS")
    return days.join(published.select("venue", "date"), ["venue", "date"], "left_anti").select("venue", "date", rested.alias("quiet"))


def sweep(spark: SparkSession, root: str, days: Iterable[tuple[str, str, bool]], tables_of: Callable[[str, str], dict[str, DataFrame]], check: Callable[[dict[str, DataFrame]], list[str]], run: str, now_ns: int) -> DataFrame:
    """Publish days one by one, as ``due_days`` lists them; venue, date, outcome, status, reason.

    The outcome is published, fresh (its files have not rested), or failed with the reason;
    a day that fails leaves the others as they are and comes again in the next sweep.
    """
    out = []
    for venue, date, quiet in days:
        if not quiet:
            out.append((venue, date, "fresh", None, None))
            continue
        try:
            status = publish_day(spark, root, venue, date, tables_of(venue, date), check, run, now_ns)
            out.append((venue, date, "published", status, None))
        except Exception as error:  # noqa: BLE001  whatever is wrong with one day is that day's outcome
            out.append((venue, date, "failed", None, f"{type(error).__name__}: {error}"[:500]))
    return spark.createDataFrame(out, OUTCOME)


def read_published(spark: SparkSession, root: str, table: str, schema: str, passed_only: bool = False) -> DataFrame:
    """A table's rows of the days' runs that count, with venue and date; of passed days only if so asked."""
    path = f"{root}/{table}"
    full = f"{schema}, venue STRING, date STRING, run STRING"
    if not _exists(spark, path):
        return spark.createDataFrame([], full).drop("run")
    days = registry(spark, root)
    days = days.where(F.col("status") == PASS) if passed_only else days
    # a row for each published day; it also prunes the partitions that are read
    return spark.read.schema(full).parquet(path).join(F.broadcast(days.select("venue", "date", "run")), ["venue", "date", "run"]).drop("run")
