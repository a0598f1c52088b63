"""Monitors as Structured Streaming queries. Their batch twins are in ``operators``.

Each takes a streaming DataFrame of events (envelope columns and ``kind``) and
returns one; the caller starts it with a checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewright.operators.reference import changes

FAILURES = 3


def counters(events: DataFrame) -> DataFrame:
    """Events by kind so far (update or complete mode), with reconnects and dropped messages."""
    return events.groupBy("kind").agg(
        F.count("*").alias("events"), F.max("local_ts").alias("last_local_ts"), F.count_if(F.col("control_kind") == "conn_down").alias("reconnects"),
        F.coalesce(F.sum(F.when(F.col("control_kind") == "gap", F.col("dropped"))), F.lit(0)).alias("dropped"),
    )


def heartbeat(events: DataFrame, width: str = "1 minute", late: str = "2 minutes") -> DataFrame:
    """Events and events a second by kind in windows of local time; later rows than ``late`` are not waited for.

    ``beats`` counts every row; this is for charts by the log's own time.
    """
    timed = events.withColumn("t", F.timestamp_micros((F.col("local_ts") / 1000).cast("long"))).withWatermark("t", late)
    window = F.window("t", width)
    seconds = F.unix_seconds(F.col("window.end")) - F.unix_seconds(F.col("window.start"))
    return timed.groupBy(window, "kind").agg(F.count("*").alias("events")).select("window", "kind", "events", (F.col("events") / seconds).alias("per_second"))


class Beats(StatefulProcessor):
    """Counts of a kind in the beat in which its rows come, whatever their own time, and since the start."""

    def __init__(self, width_ms: int):
        self.width_ms = width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("beat", "beat BIGINT, events BIGINT, total BIGINT")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        beat, events, total = self.state.get() if self.state.exists() else (-1, 0, 0)
        n, now = 0, beat
        for r in rows:
            n, now = n + len(r), max(now, int(r["now_ms"].max()) // self.width_ms)
        events = n if now != beat else events + n
        total += n
        self.state.update((int(now), int(events), int(total)))
        yield pd.DataFrame({"kind": [key[0]], "beat": [now], "events": [events], "per_second": [events * 1000 / self.width_ms], "total": [total]})

    def close(self) -> None:
        pass


def beats(events: DataFrame, width_ms: int = 60_000) -> DataFrame:
    """kind, beat, events, per_second, total: the running count of each beat of the wall clock, and of the stream.

    No row is late: it counts in the beat in which it comes. A beat's last row for a kind
    is its count, so these add up to the log. Needs the RocksDB state store; what goes to
    the processor is a row for each event, of one small column.
    """
    schema = "kind STRING, beat BIGINT, events BIGINT, per_second DOUBLE, total BIGINT"
    # the time of the batch; without timers the stream also ends where its trigger says so
    timed = events.select("kind", F.unix_millis(F.current_timestamp()).alias("now_ms"))
    return timed.groupBy("kind").transformWithStateInPandas(Beats(width_ms), outputStructType=schema, outputMode="update", timeMode="none")


def last_beats(written: DataFrame) -> DataFrame:
    """kind, beat, events, per_second, total: the last row of each beat of what ``beats`` wrote."""
    return written.groupBy("kind", "beat").agg(F.max_by(F.struct("events", "per_second", "total"), "total").alias("r")).select("kind", "beat", "r.*")


class Staleness(StatefulProcessor):
    """Reports a kind of which nothing came for an age, again after each further age, and that it is back."""

    def __init__(self, age_ms: int):
        self.age_ms = age_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("last", "local_ts BIGINT, seen_ms BIGINT, stale BOOLEAN")

    @staticmethod
    def _row(kind: str, state: str, local_ts: int, age_ms: int) -> pd.DataFrame:
        return pd.DataFrame({"kind": [kind], "state": [state], "last_local_ts": [local_ts], "age_ms": [age_ms]})

    def _wait(self, now: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(now + self.age_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        last, seen, stale = self.state.get() if self.state.exists() else (None, now, False)
        newest = max(int(r["local_ts"].max()) for r in rows)
        newest = newest if last is None else max(newest, last)
        self.state.update((newest, int(now), False))
        self._wait(now)
        if stale:
            yield self._row(key[0], "live", newest, now - seen)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        last, seen, _ = self.state.get()
        self.state.update((last, seen, True))
        self._wait(now)
        yield self._row(key[0], "stale", last, now - seen)

    def close(self) -> None:
        pass


def staleness(events: DataFrame, age_ms: int) -> DataFrame:
    """kind, state (stale or live), last_local_ts, age_ms (wall clock since the last event came).

    Timers are part of the state, so a kind that has stopped is also reported after a
    restart. Needs the RocksDB state store and a trigger that goes on without data.
    """
    schema = "kind STRING, state STRING, last_local_ts BIGINT, age_ms BIGINT"
    return events.select("kind", "local_ts").groupBy("kind").transformWithStateInPandas(Staleness(age_ms), outputStructType=schema, outputMode="update", timeMode="processingTime")


class Sessions(StatefulProcessor):
    """First updates of instruments in each session of a source: the map of those seen is emptied by a lost connection."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.session = handle.getValueState("session", "session BIGINT")
        self.seen = handle.getMapState("seen", "instrument STRING", "pos BIGINT")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        session = self.session.get()[0] if self.session.exists() else 0
        losses: list[int] = []
        first: dict[tuple[int, str], int] = {}
        # only losses and a row for each instrument between two of them are held
        for part in rows:
            losses += part.loc[part["lost"], "pos"].tolist()
            fed = part.loc[~part["lost"]].groupby("instrument")["pos"].apply(list) if not part["lost"].all() else {}
            for instrument, at in fed.items():
                for pos in at:
                    first[pos, instrument] = pos
        losses.sort()
        out, seen, at = [], set(), 0
        for pos, instrument in sorted(first):
            while at < len(losses) and losses[at] <= pos:
                at += 1
                seen.clear()
                if self.seen.exists():
                    self.seen.clear()
            if instrument in seen:
                continue
            seen.add(instrument)
            if not self.seen.containsKey((instrument,)):
                self.seen.updateValue((instrument,), (pos,))
                out.append((key[0], key[1], session + at, instrument, pos))
        if at < len(losses) and self.seen.exists():
            self.seen.clear()
        self.session.update((session + len(losses),))
        yield pd.DataFrame(out, columns=["venue", "source", "session", "instrument", "pos"])

    def close(self) -> None:
        pass


def session_starts(updates: DataFrame, losses: DataFrame) -> DataFrame:
    """venue, source, session, instrument, pos: for which updates a snapshot is to be asked.

    ``updates`` (venue, source, instrument, pos) and ``losses`` (venue, source, pos) are two
    streams of one log; batches follow each other in the log's order. Needs the RocksDB
    state store. Its batch twin is ``qa.session_first_updates``.
    """
    fed = updates.select("venue", F.col("source").cast("int").alias("source"), "instrument", "pos", F.lit(False).alias("lost"))
    lost = losses.select("venue", F.col("source").cast("int").alias("source"), F.lit(None).cast("string").alias("instrument"), "pos", F.lit(True).alias("lost"))
    schema = "venue STRING, source INT, session BIGINT, instrument STRING, pos BIGINT"
    return fed.unionByName(lost).groupBy("venue", "source").transformWithStateInPandas(Sessions(), outputStructType=schema, outputMode="append", timeMode="none")


def first_settlements(rows: DataFrame, horizon: str = "2 hours") -> DataFrame:
    """Settlements without those seen within the horizon (by venue, instrument and funding time)."""
    timed = rows.withColumn("t", F.timestamp_micros((F.col("funding_time") / 1000).cast("long"))).withWatermark("t", horizon)
    return timed.dropDuplicatesWithinWatermark(["venue", "instrument", "funding_time"]).drop("t")


class Health(StatefulProcessor):
    """Up on the first success or a recovery, down at the third failure in a row."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("health", "up INT, fails INT")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        up, fails = self.state.get() if self.state.exists() else (0, 0)
        out = []
        for r in pd.concat(list(rows)).sort_values("pos").itertuples():
            if r.ok:
                if not up:
                    out.append((key[0], r.pos, "up"))
                up, fails = 1, 0
            else:
                fails += 1
                if fails == FAILURES:
                    out.append((key[0], r.pos, "down"))
                    up = 0
        self.state.update((int(up), int(fails)))
        yield pd.DataFrame(out, columns=["label", "pos", "state"])

    def close(self) -> None:
        pass


def health(outcomes: DataFrame) -> DataFrame:
    """label, pos, state of transitions; needs the RocksDB state store."""
    return outcomes.groupBy("label").transformWithStateInPandas(Health(), outputStructType="label STRING, pos BIGINT, state STRING", outputMode="append", timeMode="none")


def universe_changes(root: str, keys: list[str], attributes: list[str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: each batch is a full observation, compared with the stored one before it.

    Observations are kept by batch number, so that a batch that runs again is compared
    with the same one and replaces its own output. The first is a baseline without
    changes.
    """
    from tidewright.sources.tables import _exists

    def apply(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        snapshots = f"{root}/snapshots"
        now = batch.select(*keys, *attributes).dropDuplicates(keys)
        if _exists(spark, snapshots):
            older = spark.read.parquet(snapshots).where(F.col("batch") < number)
            last = older.agg(F.max("batch")).first()[0]
            if last is not None:
                found = changes(older.where(F.col("batch") == last), now, keys, attributes)
                found.write.mode("overwrite").parquet(f"{root}/changes/batch={number}")
        now.write.mode("overwrite").parquet(f"{snapshots}/batch={number}")

    return apply


def candidates(root: str, keys: list[str], attributes: list[str], wanted: Column) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: ``universe_changes``, and of what was added the rows for which ``wanted`` holds, to ``candidates``.

    What the first observation lists is no candidate, and a candidate comes from one
    difference only.
    """
    from tidewright.sources.tables import _exists

    changed = universe_changes(root, keys, attributes)

    def apply(batch: DataFrame, number: int) -> None:
        changed(batch, number)
        path = f"{root}/changes/batch={number}"
        if not batch.isEmpty() and _exists(batch.sparkSession, path):
            added = batch.sparkSession.read.parquet(path).where("change = 'added'").select(*keys)
            found = batch.where(wanted).dropDuplicates(keys).join(added, keys, "left_semi")
            found.write.mode("overwrite").parquet(f"{root}/candidates/batch={number}")

    return apply
