import itertools
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewright.operators import qa
from tidewright.plans.bindings import frame
from tidewright.sources import tables
from tidewright.streaming import monitors, sink


def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def run(spark, stream, name, mode="append"):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


def landed(spark, df, path, parts=3):
    df.repartitionByRange(parts, "pos").write.parquet(str(path))
    return spark.readStream.schema(df.schema).parquet(str(path))


def test_counters_and_heartbeat(spark, sf_dir, tmp_path):
    ev = frame(spark, sf_dir, "ev").withColumn("dropped", F.lit(2)).withColumn("qty", F.col("qty").cast("double"))
    stream = landed(spark, ev, tmp_path / "ev")
    got = {r.kind: (r.events, r.last_local_ts) for r in run(spark, monitors.counters(stream), "counters", "complete").collect()}
    assert got == {r.kind: (r.n, r.t) for r in ev.groupBy("kind").agg(F.count("*").alias("n"), F.max("local_ts").alias("t")).collect()}
    beat = run(spark, monitors.heartbeat(stream, "1 hour"), "beat", "complete")
    assert beat.agg(F.sum("events")).first()[0] == ev.count()


def test_health_equals_batch(spark, sf_dir, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    polls = frame(spark, sf_dir, "polls")
    got = run(spark, monitors.health(landed(spark, polls, tmp_path / "polls", 1)), "health")
    want = qa.health_transitions(polls)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_dedup_and_universe(spark, tmp_path):
    rows = [("v", "a", 10**15, 1), ("v", "a", 10**15, 2), ("v", "b", 10**15, 3)]
    stream = landed(spark, spark.createDataFrame(rows, "venue string, instrument string, funding_time long, pos long"), tmp_path / "f", 1)
    assert run(spark, monitors.first_settlements(stream), "dedup").count() == 2
    apply = monitors.universe_changes(str(tmp_path / "u"), ["symbol"], ["status"])
    for n, day in enumerate([[("a", "x"), ("b", "x")], [("a", "y"), ("c", "x")], [("a", "y"), ("c", "x")]]):
        apply(spark.createDataFrame(day, "symbol string, status string"), n)
        apply(spark.createDataFrame(day, "symbol string, status string"), n)  # a batch may run again
    got = spark.read.parquet(str(tmp_path / "u" / "changes")).collect()
    assert sorted((r.batch, r.symbol, r.change) for r in got) == [(1, "a", "changed"), (1, "b", "delisted"), (1, "c", "added")]


class Handle:
    """What a processor's handle keeps, in plain variables."""

    def __init__(self):
        self.timers = set()

    def getValueState(self, name, schema):
        class Value:
            held = None
            exists = lambda self: self.held is not None
            get = lambda self: self.held

            def update(self, v):
                self.held = v

        return Value()

    def listTimers(self):
        return iter(sorted(self.timers))

    def registerTimer(self, t):
        self.timers.add(t)

    def deleteTimer(self, t):
        self.timers.discard(t)


class Clock:
    def __init__(self, now=0):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_staleness_by_a_manual_clock():
    handle, clock = Handle(), Clock(1000)
    p = monitors.Staleness(500)
    p.init(handle)
    feed = lambda *ts: [tuple(r) for out in p.handleInputRows(("trades",), iter([pd.DataFrame({"local_ts": list(ts)})]), clock) for r in out.itertuples(index=False)]

    def pass_time(to):
        clock.now = to
        out = []
        for t in sorted(handle.timers):
            if t <= to:
                handle.deleteTimer(t)
                out += [tuple(r) for df in p.handleExpiredTimer(("trades",), clock, None) for r in df.itertuples(index=False)]
        return out

    assert feed(5, 9, 7) == []
    assert pass_time(1400) == []
    assert feed(8) == []  # late, yet something came
    assert pass_time(1899) == []
    assert pass_time(1900) == [("trades", "stale", 9, 500)]
    assert pass_time(2399) == []
    assert pass_time(2400) == [("trades", "stale", 9, 1000)]
    assert feed(20) == [("trades", "live", 20, 1000)]
    assert handle.timers == {2900}
    assert pass_time(2900) == [("trades", "stale", 20, 500)]


def test_beats_by_a_manual_clock():
    p = monitors.Beats(1000)
    p.init(Handle())
    feed = lambda now, n: tuple(next(p.handleInputRows(("k",), iter([pd.DataFrame({"now_ms": [now] * n})]), None)).iloc[0])
    got = [feed(now, n) for now, n in ((10, 3), (900, 2), (1100, 4), (9999, 1))]
    assert got == [("k", 0, 3, 3.0, 3), ("k", 0, 5, 5.0, 5), ("k", 1, 4, 4.0, 9), ("k", 9, 1, 1.0, 10)]


def test_staleness_and_beats_over_a_restart(spark, tmp_path):
    """A kind that stops is reported, also by a stream that is started again; no late row is lost from the beats."""
    rocks(spark)
    cols = "kind string, local_ts long"
    hour = 3_600_000_000_000
    put = lambda *rows: spark.createDataFrame(list(rows), cols).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    put(("a", 10 * hour), ("b", 10 * hour))
    source = lambda: spark.readStream.schema(cols).parquet(str(tmp_path / "in"))

    rows = []

    def start():
        out = monitors.staleness(source(), 1500).writeStream.foreachBatch(lambda batch, n: rows.extend(batch.collect()))
        return out.outputMode("update").option("checkpointLocation", str(tmp_path / "c-stale")).trigger(processingTime="300 milliseconds").start()

    def stale_until(q, n):
        try:
            for _ in range(120):
                if sum(r.kind == "b" for r in rows) >= n:
                    return
                if q.exception():
                    raise q.exception()
                time.sleep(0.25)
            raise AssertionError("nothing was reported")
        finally:
            q.stop()

    stale_until(start(), 1)
    before = sum(r.kind == "b" for r in rows)
    put(("a", 2 * hour), ("a", 11 * hour))
    stale_until(start(), before + 1)
    got = [r for r in rows if r.kind == "b"]
    assert {(r.state, r.last_local_ts) for r in got} == {("stale", 10 * hour)}
    assert min(r.age_ms for r in got) >= 1500

    for _ in range(2):  # the second time rows that are hours late come in
        q = monitors.beats(source(), 1000).writeStream.foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(str(tmp_path / "beats" / f"batch={n}")))
        q = q.outputMode("update").option("checkpointLocation", str(tmp_path / "c-beats")).trigger(availableNow=True).start()
        q.awaitTermination()
        put(("a", 1 * hour), ("b", 3 * hour), ("b", 12 * hour))
    got = monitors.last_beats(spark.read.parquet(str(tmp_path / "beats")))
    assert {r.kind: r.n for r in got.groupBy("kind").agg(F.sum("events").alias("n")).collect()} == {"a": 4, "b": 3}


def test_session_starts_equal_batch(spark, sf_dir, tmp_path):
    """Three batches in the log's order, with a restart after each."""
    rocks(spark)
    upd, downs = frame(spark, sf_dir, "upd"), frame(spark, sf_dir, "downs")
    want = sorted(tuple(r) for r in qa.session_first_updates(upd, downs).select("venue", "source", "session", "instrument", "pos").collect())
    both = upd.select("venue", "source", "instrument", "pos").unionByName(downs.select("venue", "source", F.lit(None).cast("string").alias("instrument"), "pos"))
    edges = [0, *both.approxQuantile("pos", [0.3, 0.7], 0.01), 1e18]
    schema = both.schema
    for lo, hi in itertools.pairwise(edges):
        both.where((F.col("pos") >= lo) & (F.col("pos") < hi)).repartition(2).write.mode("append").parquet(str(tmp_path / "in"))
        s = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        out = monitors.session_starts(s.where("instrument IS NOT NULL"), s.where("instrument IS NULL"))
        q = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("venue", "source", "session", "instrument", "pos").collect()) == want


def test_sink_gives_every_event_once(spark, sf_dir, tmp_path):
    """A batch that fails after it was written runs again; compaction in between, and one that is cut off, change nothing."""
    ev = frame(spark, sf_dir, "ev").select("venue", "instrument", "venue_ts", "local_ts", "pos", "kind")
    parts = 4
    for i in range(parts):
        ev.where(F.col("pos") % parts == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    root = str(tmp_path / "sink")
    write, failed = sink.by_batch(root, lambda: "2024-01-10"), []

    def breaks(batch, n):
        if n == 2 and not failed:
            failed.append(n)
            batch.limit(5).write.parquet(f"{root}/incoming/batch={n}")  # half a batch
            raise RuntimeError("stopped")
        write(batch, n)

    def start():
        s = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        return s.writeStream.foreachBatch(breaks).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()

    with pytest.raises(Exception, match="stopped"):
        start().awaitTermination()
    half = sink.events(spark, root)
    assert 0 < half.count() == half.select("pos").distinct().count() < ev.count()
    assert sink.compact(spark, root, 0) == 0
    start().awaitTermination()
    assert sink.events(spark, root).count() == ev.count()
    # a run that was cut off is not listed
    sink._incoming(spark, root, -1).drop("batch").limit(3).write.partitionBy("venue", "date").parquet(f"{root}/days/run=2")
    assert sink.events(spark, root).count() == ev.count()
    assert [sink.compact(spark, root, n) for n in (2, 2, 1, 99, 99)] == [2, -1, -1, 99, -1]
    got = sink.events(spark, root)
    assert got.count() == got.select("pos").distinct().count() == ev.count()
    late = tables.routed(ev, "2024-01-10").where("is_late").count()
    assert got.where("is_late").count() == late > 0
    assert {p.name.split("=")[0] for p in (tmp_path / "sink" / "days" / "run=2").iterdir() if p.is_dir()} == {"venue"}


def test_candidates(spark, tmp_path):
    apply = monitors.candidates(str(tmp_path / "u"), ["symbol"], ["status"], (F.col("class") == "perp") & (F.col("status") == "trading"))
    days = [[("a", "trading", "perp")], [("a", "trading", "perp"), ("b", "trading", "perp"), ("c", "halted", "perp"), ("d", "trading", "future")], [("a", "trading", "perp"), ("b", "trading", "perp"), ("c", "trading", "perp")]]
    for n, day in enumerate(days):
        for _ in range(2):
            apply(spark.createDataFrame(day, "symbol string, status string, class string"), n)
    got = spark.read.parquet(str(tmp_path / "u" / "candidates"))
    assert [(r.batch, r.symbol) for r in got.collect()] == [(1, "b")]
