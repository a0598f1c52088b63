"""Reading and publishing the tables of a market-data lake.

Tables are Parquet partitioned by venue and date (or month). A day is published
once: its tables are written to their partitions, its verdict is taken, and last a
row is added to the registry. Readers that need published days join the registry,
so a day without its row does not exist for them and is written again.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tidewright import schemas
from tidewright.functions.market import date_of, within

REGISTRY = "venue STRING, date DATE, status STRING, failures BIGINT, published_at BIGINT"
QUIET_S = 600
#: Days before today that are published by day.
LOOK_BACK = 32
#: Rows of a row group at most.
GROUP_ROWS = 500_000
#: Sort columns of a file, as far as a table has them; settlements go by time first.
ORDER, SETTLED = ("instrument", "venue_ts"), ("funding_time", "instrument")


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``, as its file system has it; nothing is listed or read."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def event_log(spark: SparkSession, path: str, venue: str | None = None, date: str | None = None, kind: str | None = None, start: int | None = None, end: int | None = None) -> DataFrame:
    """The typed event log; venue and date prune partitions, kind and the half-open window of local times row groups."""
    log = spark.read.schema(f"{schemas.EVENT_LOG}, date DATE").parquet(path)
    for c, v in (("venue", venue), ("date", date), ("kind", kind)):
        if v is not None:
            log = log.where(F.col(c) == v)
    if start is not None:
        log = log.where((F.col("local_ts") >= start) & (F.col("date") >= date_of(F.lit(start))))
    if end is not None:
        log = log.where((F.col("local_ts") < end) & (F.col("date") <= date_of(F.lit(end - 1))))
    return log


def write_event_log(log: DataFrame, path: str, group_rows: int = GROUP_ROWS) -> None:
    """The event log (with ``date``) by venue and date; within a file by kind, then local time."""
    laid_out(log.repartitionByRange("venue", "date", "kind", "local_ts").sortWithinPartitions("venue", "date", "kind", "local_ts"), ("venue", "date", "kind", "local_ts"), group_rows).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("venue", "date").parquet(path)


def raw_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RAW).parquet(path)


def settlements(spark: SparkSession, path: str, start: int, end: int) -> DataFrame:
    """Settlements of a half-open time window; a missing dataset is an empty one, null rates stay."""
    schema = "instrument STRING, funding_time BIGINT, rate DOUBLE"
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path).where(within(F.col("funding_time"), start, end))


def dated_dumps(spark: SparkSession, path: str, latest: bool = False) -> DataFrame:
    """venue, dump_date, body of the files <path>/<venue>/<date>.json; other names are ignored."""
    read = spark.read.text(path, wholetext=True, recursiveFileLookup=True).withColumnRenamed("value", "body")
    file = F.col("_metadata.file_path")
    found = read.select(F.regexp_extract(file, r"([^/]+)/[^/]+$", 1).alias("venue"), F.expr("try_to_date(regexp_extract(_metadata.file_name, '^([0-9]{4}-[0-9]{2}-[0-9]{2})[.]json$', 1), 'yyyy-MM-dd')").alias("dump_date"), "body")
    found = found.where("dump_date IS NOT NULL")
    if not latest:
        return found
    return found.groupBy("venue").agg(F.max("dump_date").alias("dump_date"), F.max_by("body", "dump_date").alias("body"))


def curated(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A hand-kept CSV table; a row that does not fit the schema fails the read."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)


def registry(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/_registry"
    return spark.read.schema(REGISTRY).parquet(path) if _exists(spark, path) else spark.createDataFrame([], REGISTRY)


def closed_days(log: DataFrame, published: DataFrame, as_of: str) -> DataFrame:
    """venue, date of the days before ``as_of`` that are not published."""
    days = log.select("venue", "date").distinct().where(F.col("date") < F.lit(as_of).cast("date"))
    return days.join(published.select("venue", "date"), ["venue", "date"], "left_anti")


def quiet_files(files: DataFrame, now: str, seconds: int = QUIET_S) -> DataFrame:
    """Files (binaryFile columns) that were not written within the last ``seconds``."""
    return files.where(F.col("modificationTime") < F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {seconds} SECONDS"))


def routed(events: DataFrame, today: str) -> DataFrame:
    """Events with the date of their local time, and whether they are late for it."""
    out = events.withColumn("date", date_of(F.col("local_ts")))
    return out.withColumn("is_late", F.col("date") < F.lit(today).cast("date"))


def laid_out(df: DataFrame, by: tuple[str, ...] = (), group_rows: int = GROUP_ROWS) -> DataFrameWriter:
    """A writer of ``df`` whose files are in the order of their table, in row groups of at most so many rows.

    So the least and largest values of a row group are close, and a filter on instrument and
    time passes over most groups.
    """
    order = [c for c in (*by, *(SETTLED if "funding_time" in df.columns and "rate" in df.columns else ORDER)) if c in df.columns]
    out = df.sortWithinPartitions(*order).write if order else df.write
    # a group is checked for its size at least this often
    often = min(group_rows, 10_000)
    options = {"parquet.block.row.count.limit": group_rows, "parquet.page.row.count.limit": min(group_rows, 20_000), "parquet.page.size.row.check.min": 100, "parquet.page.size.row.check.max": often}
    return out.option("compression", "zstd").options(**options)


def write_tables(tables: dict[str, DataFrame], root: str, by: tuple[str, ...] = ("venue", "date"), group_rows: int = GROUP_ROWS) -> None:
    """Each table to its partitions, replacing those it has rows for; rows in the table's order within a file.

    A table without rows makes no partition.
    """
    for name, df in tables.items():
        laid_out(df, by, group_rows).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(f"{root}/{name}")


def publish(spark: SparkSession, tables: dict[str, DataFrame], verdicts: DataFrame, root: str, now_ns: int) -> None:
    """Write the tables, then the registry rows of the days in ``verdicts`` (venue, date, status, failures)."""
    write_tables(tables, root)
    verdicts.select("venue", "date", "status", "failures", F.lit(now_ns).cast("long").alias("published_at")).write.mode("append").parquet(f"{root}/_registry")


def published(table: DataFrame, days: DataFrame, passed_only: bool = False) -> DataFrame:
    """Rows of published days, of passed ones only if so asked."""
    wanted = days.where("status = 'pass'") if passed_only else days
    return table.join(wanted.select("venue", "date").distinct(), ["venue", "date"], "left_semi")


def blocking_reasons(days: DataFrame, registry_rows: DataFrame) -> DataFrame:
    """venue, date, reason: null, or why a day cannot be used yet."""
    known = registry_rows.groupBy("venue", "date").agg(F.max_by("status", "published_at").alias("status"))
    reason = F.when(F.col("status").isNull(), "not published").when(F.col("status") != "pass", "failed its checks")
    return days.join(known, ["venue", "date"], "left").select("venue", "date", reason.alias("reason"))


def publish_periods(rows: DataFrame, root: str, by: str, now: str, first: str | None = None) -> DataFrame:
    """Rows to partitions of ``by`` (``month`` or ``date``); by, rows and outcome of each period they have.

    ``now`` is the open period, ``first`` the earliest one looked at. A closed period that
    is published whole is skipped (outcome existing) and its rows are not read. The open one
    is marked partial, and replaced each time, at last by its final form. Periods after
    ``now`` wait. One value for each period of the calendar goes through the driver.
    """
    path = f"{root}/{by}s"
    looked_at = (F.col(by) <= F.lit(now)) & (F.col(by) >= F.lit(first) if first else F.lit(True))
    marked = rows.where(looked_at).withColumn("is_partial", F.col(by) == F.lit(now))
    whole = rows.sparkSession.read.schema(marked.schema)
    done = []
    if _exists(rows.sparkSession, path):
        done = [r[0] for r in whole.parquet(path).where(looked_at & ~F.col("is_partial")).select(by).distinct().collect()]
    write_tables({f"{by}s": marked.where(~F.col(by).isin(done)) if done else marked}, root, by=(by,))
    written = whole.parquet(path).where(looked_at).groupBy(by).agg(F.count("*").alias("rows"), F.max("is_partial").alias("open"))
    outcome = F.when(F.col(by).isin(done) if done else F.lit(False), "existing").when(F.col("open"), "partial").otherwise("published")
    return written.select(by, "rows", outcome.alias("outcome"))


def publish_months(rows: DataFrame, root: str, open_month: str) -> DataFrame:
    """Rows (with ``month``, yyyy-MM) to month partitions."""
    return publish_periods(rows, root, "month", open_month)


def publish_days(rows: DataFrame, root: str, today: str, back: int = LOOK_BACK) -> DataFrame:
    """Rows (with ``date``) of the last ``back`` days and of today to day partitions."""
    return publish_periods(rows, root, "date", today, str(date.fromisoformat(today) - timedelta(days=back)))


def rebuild(df: DataFrame, root: str, version: str) -> None:
    """A full new version of a dataset, in as many files as ``df`` has partitions, and then a row that points to it.

    Pointers are only added, so a reader finds the former version or the new one.
    """
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/version={version}")
    pointer = df.sparkSession.range(1).select(F.lit(version).alias("version"), F.unix_micros(F.current_timestamp()).alias("rebuilt_at"))
    pointer.write.mode("append").json(f"{root}/_versions")


def current(spark: SparkSession, root: str) -> DataFrame:
    """The version that was rebuilt last."""
    pointers = spark.read.schema("version STRING, rebuilt_at BIGINT").json(f"{root}/_versions")
    return spark.read.parquet(f"{root}/version={pointers.agg(F.max_by('version', 'rebuilt_at')).first()[0]}")


def write_report(report: DataFrame, path: str) -> None:
    """A report as Parquet, and as one JSON line for each row."""
    report.write.mode("overwrite").parquet(f"{path}/parquet")
    report.select(F.to_json(F.struct(*report.columns)).alias("value")).write.mode("overwrite").text(f"{path}/json")
