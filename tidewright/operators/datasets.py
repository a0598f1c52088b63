"""Assembling datasets: unions, deduplication, work lists, reconciliation, analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewright.functions.market import day_of

RATE_EPS = 1e-10
MAX_STREAK = 400
#: Matched settlements that a comparison should have.
MATCHED = 100


def last_write_wins(inputs: list[DataFrame], keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row for each key: of the latest input that has it, and there the last by ``order``."""
    tagged = [df.withColumn("_priority", F.lit(i)) for i, df in enumerate(inputs)]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    by = W.partitionBy(*keys).orderBy(F.desc("_priority"), *(F.desc(c) for c in order or []))
    return out.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n", "_priority")


def first_seen(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    by = W.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n")


def settlement_intervals(settlements: DataFrame) -> DataFrame:
    """Time since the instrument's previous settlement."""
    before = F.lag("funding_time").over(W.partitionBy("venue", "instrument").orderBy("funding_time"))
    return settlements.withColumn("realized_interval", F.col("funding_time") - before)


def reconcile(expected: DataFrame, captured: DataFrame, eps: float = RATE_EPS) -> DataFrame:
    """venue, instrument, funding_time, outcome: matched, missing, extra or mismatch.

    A null captured rate is no mismatch.
    """
    keys = ["venue", "instrument", "funding_time"]
    e = expected.select(*keys, F.col("rate").alias("e"), F.lit(True).alias("in_e"))
    c = captured.select(*keys, F.col("rate").alias("c"), F.lit(True).alias("in_c"))
    differs = F.coalesce(F.abs(F.col("e") - F.col("c")) > eps, F.lit(False))
    outcome = F.when(F.col("in_c").isNull(), "missing").when(F.col("in_e").isNull(), "extra").when(differs, "mismatch").otherwise("matched")
    return e.join(c, keys, "full_outer").select(*keys, outcome.alias("outcome"))


def assembled(tables: DataFrame, log: DataFrame, verdicts: DataFrame, order: list[str] | None = None) -> DataFrame:
    """venue, day, instrument, funding_time, rate: what was captured of every day's settlements.

    ``tables`` and ``log`` have venue, instrument, funding_time, rate and ``captured``, the
    day number of the table or log in which a row stands; ``verdicts`` has venue, day and
    status of published days. A day is taken from its own table, from the next day's table
    if that day has passed, and from the next day's log, which needs no verdict; of one
    settlement the last of these counts, and there the last by ``order``. Nothing further
    ahead is looked at. Days that have not passed give nothing (see ``assembly_gate``).
    """
    day = day_of(F.col("funding_time"))
    passed = verdicts.where("status = 'pass'").select("venue", F.col("day").alias("captured")).distinct()
    near = lambda df: df.withColumn("day", day).where((F.col("captured") - F.col("day")).between(0, 1))
    listed = near(tables).join(passed, ["venue", "captured"], "left_semi")
    inputs = [listed.where("captured = day"), listed.where("captured = day + 1"), near(log).where("captured = day + 1")]
    out = last_write_wins(inputs, ["venue", "instrument", "funding_time"], order)
    return out.join(passed.withColumnRenamed("captured", "day"), ["venue", "day"], "left_semi").select("venue", "day", "instrument", "funding_time", "rate")


def assembly_gate(days: DataFrame, verdicts: DataFrame) -> DataFrame:
    """venue, day, reason: null, or why a day is blocked: not published, or did not pass its checks."""
    known = verdicts.groupBy("venue", "day").agg(F.max("status").alias("status"))
    reason = F.when(F.col("status").isNull(), "not published").when(F.col("status") != "pass", F.concat(F.lit("checks: "), "status"))
    return days.select("venue", "day").distinct().join(known, ["venue", "day"], "left").select("venue", "day", reason.alias("reason"))


def reconcile_days(expected: DataFrame, tables: DataFrame, log: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Every day's counts and coverage against ``expected``, status (pass, fail or blocked) and reason.

    A blocked day has what was expected as its count, and compares nothing.
    """
    e = expected.withColumn("day", day_of(F.col("funding_time")))
    gate = assembly_gate(e, verdicts)
    open_ = gate.where("reason IS NULL").select("venue", "day")
    detail = reconcile(e.join(open_, ["venue", "day"], "left_semi"), assembled(tables, log, verdicts)).withColumn("day", day_of(F.col("funding_time")))
    counts = daily_coverage(detail).drop("passed")
    blocked = gate.where("reason IS NOT NULL").join(e.groupBy("venue", "day").agg(F.count("*").alias("expected")), ["venue", "day"])
    wrong = F.col("missing") + F.col("extra") + F.col("mismatch")
    n = F.col("matched") + F.col("missing") + F.col("mismatch")
    found = counts.select("venue", "day", n.alias("expected"), "matched", "missing", "extra", "mismatch", "coverage_pct", F.when(wrong == 0, "pass").otherwise("fail").alias("status"), F.lit(None).cast("string").alias("reason"))
    none = [F.lit(0).cast("long").alias(c) for c in ("matched", "missing", "extra", "mismatch")]
    return found.unionByName(blocked.select("venue", "day", "expected", *none, F.lit(0.0).alias("coverage_pct"), F.lit("blocked").alias("status"), "reason"))


def differences(detail: DataFrame) -> DataFrame:
    """What is missing or extra, by time and instrument."""
    return detail.where(F.col("outcome").isin("missing", "extra")).orderBy("funding_time", "instrument", "venue")


def expected_rows(rows: DataFrame, least: int = MATCHED) -> DataFrame:
    """One row: how many ``rows`` there are, and whether they are at least so many."""
    n = F.count("*")
    return rows.agg(n.alias("rows"), (n >= least).alias("enough"))


def daily_coverage(detail: DataFrame, day: str = "day") -> DataFrame:
    """Counts of outcomes per venue and day, coverage in percent, and whether the day passes."""
    count = lambda k: F.count_if(F.col("outcome") == k)
    out = detail.groupBy("venue", day).agg(*(count(k).alias(k) for k in ("matched", "missing", "extra", "mismatch")))
    expected = F.col("matched") + F.col("missing") + F.col("mismatch")
    got = F.col("matched") + F.col("mismatch")
    out = out.withColumn("coverage_pct", F.when(expected == 0, 100.0).otherwise(got * 100.0 / expected))
    return out.withColumn("passed", (F.col("missing") + F.col("extra") + F.col("mismatch")) == 0)


def green_streaks(daily: DataFrame, day: str = "day", most: int = MAX_STREAK) -> DataFrame:
    """venue, day, streak: passed days in a row up to the day (at most ``most`` before it)."""
    by = W.partitionBy("venue").orderBy(day)
    green = daily.where("passed").select("venue", day, (F.col(day) - F.row_number().over(by)).alias("island"))
    n = F.row_number().over(W.partitionBy("venue", "island").orderBy(day))
    return green.select("venue", day, F.least(n, F.lit(most + 1)).cast("long").alias("streak"))


def work_list(first: str, last: str, published: DataFrame, spark=None) -> DataFrame:
    """Months from ``first`` to ``last`` (yyyy-MM-01) that ``published.month`` (yyyy-MM) lacks."""
    months = published.sparkSession.range(1).select(F.explode(F.expr(f"sequence(DATE '{first}', DATE '{last}', INTERVAL 1 MONTH)")).alias("d")).select(F.date_format("d", "yyyy-MM").alias("month"))
    return months.join(published.select("month").distinct(), "month", "left_anti")


def partition_outcomes(rows: DataFrame, months: DataFrame, open_month: str) -> DataFrame:
    """month, rows, outcome: published (closed), partial (the open month) or empty."""
    counted = rows.groupBy("month").agg(F.count("*").alias("rows"))
    out = months.select("month").distinct().join(counted, "month", "left").withColumn("rows", F.coalesce("rows", F.lit(0)).cast("long"))
    return out.withColumn("outcome", F.when(F.col("rows") == 0, "empty").when(F.col("month") == open_month, "partial").otherwise("published"))


def outcome_totals(outcomes: DataFrame) -> DataFrame:
    """outcome, periods, rows: what a run of publishing came to, by outcome."""
    return outcomes.groupBy("outcome").agg(F.count("*").alias("periods"), F.sum("rows").cast("long").alias("rows"))


def sample_density(samples: DataFrame, grid: int = 288) -> DataFrame:
    """Samples per instrument and day against a full grid."""
    return samples.groupBy("instrument", "day").agg(F.count("*").alias("samples")).withColumn("density_pct", F.col("samples") * 100.0 / grid)


def funding_spread(mapped: DataFrame, venues: tuple[str, str], start: int, days: int, top: int = 15) -> DataFrame:
    """Annualized funding of both venues for each key, and the ``top`` largest spreads."""
    a, b = venues
    recent = mapped.where((F.col("funding_time") >= start) & F.col("rate").isNotNull() & F.col("venue").isin(a, b))
    yearly = lambda v: F.sum(F.when(F.col("venue") == v, F.col("rate"))) * (365.0 / days)
    n = lambda v: F.count_if(F.col("venue") == v)
    out = recent.groupBy("canonical").agg(yearly(a).alias("first"), yearly(b).alias("second"), n(a).alias("n_first"), n(b).alias("n_second")).where("n_first > 0 AND n_second > 0")
    spread = F.round(F.col("first") - F.col("second"), 9)
    return out.select("canonical", F.round("first", 9).alias("first"), F.round("second", 9).alias("second"), "n_first", "n_second", spread.alias("spread")).orderBy(F.abs("spread").desc(), "canonical").limit(top)


def replay_order(events: DataFrame, clock: str = "local_ts") -> DataFrame:
    """Events in replay order: the clock, then venue time, local time and position."""
    keys = list(dict.fromkeys([clock, "venue_ts", "local_ts", "pos"]))
    return events.repartitionByRange(*keys).sortWithinPartitions(*keys)


def manifest(table: DataFrame, name: str, keys: tuple[str, ...] = ("venue", "day")) -> DataFrame:
    return table.groupBy(*keys).agg(F.count("*").alias("rows"), F.min("local_ts").alias("min_ts"), F.max("local_ts").alias("max_ts")).withColumn("table_name", F.lit(name))


def same_counts(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Keys at which two (keys, n) tables differ, with both counts."""
    both = first.select(*keys, F.col("n").alias("a")).join(second.select(*keys, F.col("n").alias("b")), keys, "full_outer").fillna(0, ["a", "b"])
    return both.where("a <> b")
