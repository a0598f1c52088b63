"""Publishing days, the event log's layout, and assembling days."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidewright.operators import datasets
from tidewright.sources import publishing, tables

NS_DAY = 86_400_000_000_000
SCHEMA = "instrument STRING, venue_ts BIGINT, price DOUBLE"


def day(spark, *rows):
    return {"mark_price": spark.createDataFrame(list(rows), SCHEMA)}


def seen(spark, root, **kw):
    return sorted((r.date, r.instrument, r.price) for r in publishing.read_published(spark, root, "mark_price", SCHEMA, **kw).collect())


@pytest.mark.parametrize("step", ["tables", "check", "marker"])
def test_stopped_between_two_steps(spark, tmp_path, monkeypatch, step):
    """Whatever step a run is stopped at, readers have the day as it was; the next run replaces it."""
    root, good = str(tmp_path / "lake"), lambda staged: []
    assert publishing.publish_day(spark, root, "v", "2024-01-01", day(spark, ("a", 1, 1.0)), good, "r1", 1) == "pass"

    class Stopped(BaseException):
        pass

    def stop(*_):
        raise Stopped

    with monkeypatch.context() as m, pytest.raises(Stopped):
        if step == "tables":
            m.setattr(publishing, "laid_out", stop)
        if step == "marker":
            m.setattr(spark, "createDataFrame", stop)
        new = {"mark_price": spark.range(2).selectExpr("'b' AS instrument", "id AS venue_ts", "2.0D AS price")}
        publishing.publish_day(spark, root, "v", "2024-01-01", new, stop if step == "check" else good, "r2", 2)
    assert seen(spark, root) == [("2024-01-01", "a", 1.0)]
    assert publishing.publish_day(spark, root, "v", "2024-01-01", day(spark, ("c", 1, 3.0)), lambda s: ["odd"] if s["mark_price"].count() != 2 else [], "r3", 3) == "fail"
    assert seen(spark, root) == [("2024-01-01", "c", 3.0)]
    assert seen(spark, root, passed_only=True) == []
    assert [(r.run, r.failures, r.rows) for r in publishing.registry(spark, root).collect()] == [("r3", ["odd"], {"mark_price": 1})]


def test_sweep(spark, tmp_path):
    """A bad day does not stop a good one, a fresh day waits, a published one is left alone."""
    root = str(tmp_path / "lake")
    files = [("v", "2024-01-01", "2024-01-02 00:00:05"), ("v", "2024-01-02", "2024-01-03 00:00:01"), ("v", "2024-01-02", "2024-01-02 10:00:00"), ("w", "2024-01-02", "2024-01-04 11:55:00"), ("w", "2024-01-04", "2024-01-04 12:00:00"), ("x", "2024-01-03", "2024-01-04 00:00:00")]
    written = spark.createDataFrame(files, "venue string, date string, modified_at string").withColumn("modified_at", F.to_timestamp("modified_at"))

    def tables_of(venue, date):
        if date == "2024-01-01" and broken:
            return {"mark_price": spark.createDataFrame([("x", 1, 1.0)], SCHEMA).withColumn("price", F.raise_error(F.lit("bad day")).cast("double"))}
        return day(spark, (venue, 1, 1.0))

    def run(n):
        due = publishing.due_days(written, publishing.registry(spark, root), "2024-01-04", "2024-01-04 12:00:00")
        got = publishing.sweep(spark, root, [tuple(r) for r in due.orderBy("venue", "date").collect()], tables_of, lambda s: ["none"] if s["mark_price"].where("instrument = 'x'").count() else [], f"r{n}", n)
        return [(r.venue, r.date, r.outcome, r.status) for r in got.collect()], [r.reason for r in got.collect() if r.reason]

    broken = True
    got, why = run(1)
    assert got == [("v", "2024-01-01", "failed", None), ("v", "2024-01-02", "published", "pass"), ("w", "2024-01-02", "fresh", None), ("x", "2024-01-03", "published", "fail")]
    assert len(why) == 1
    assert "bad day" in why[0]
    assert seen(spark, root) == [("2024-01-02", "v", 1.0), ("2024-01-03", "x", 1.0)]
    broken = False
    assert run(2)[0] == [("v", "2024-01-01", "published", "pass"), ("w", "2024-01-02", "fresh", None)]
    assert seen(spark, root, passed_only=True) == [("2024-01-01", "v", 1.0), ("2024-01-02", "v", 1.0)]
    assert seen(spark, str(tmp_path / "none")) == []


def scanned(df):
    """The plan's scan, and how many files and rows it read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    while "Scan" not in leaf.nodeName():
        leaf = leaf.executedPlan().collectLeaves().head() if hasattr(leaf, "executedPlan") else leaf.plan().collectLeaves().head()
    return leaf.toString(), leaf.metrics().apply("numFiles").value(), leaf.metrics().apply("numOutputRows").value()


def test_partitions_and_row_groups_are_passed_over(spark, tmp_path):
    from tidewright import schemas

    n, path = 40_000, str(tmp_path / "log")
    base = 19_800 * NS_DAY
    rows = spark.range(n).selectExpr(
        "concat('v', id % 2) AS venue", "concat('i', id % 50) AS instrument", f"{base} + id * {2 * NS_DAY // n} AS local_ts", "id AS pos", "1 AS source", "CASE WHEN id % 4 < 2 THEN 'trades' ELSE 'control' END AS kind"
    )
    whole = spark.createDataFrame([], schemas.EVENT_LOG).unionByName(rows, allowMissingColumns=True)
    tables.write_event_log(tables.routed(whole, "2024-03-20").drop("is_late"), path, group_rows=1000)
    files = sorted((tmp_path / "log").glob("venue=*/date=*/*.parquet"))
    groups = [pq.ParquetFile(f).metadata for f in files]
    assert max(g.row_group(i).num_rows for g in groups for i in range(g.num_row_groups)) <= 1000
    assert sum(g.num_rows for g in groups) == n
    assert len({f.parent for f in files}) == 4
    one, start = "2024-03-19", base + NS_DAY + NS_DAY // 2
    plan, read, out = scanned(tables.event_log(spark, path, "v1", one, "trades", start, start + NS_DAY // 20).select("pos"))
    assert "PartitionFilters: [isnotnull(venue" in plan
    assert "EqualTo(kind,trades)" in plan
    assert "GreaterThanOrEqual(local_ts" in plan
    assert read < len(files)
    assert out <= 2000  # of 10,000 rows in that partition
    got = tables.event_log(spark, path, "v1", None, "trades", start, start + NS_DAY // 20)
    assert got.count() == rows.where(f"venue = 'v1' AND kind = 'trades' AND local_ts >= {start} AND local_ts < {start + NS_DAY // 20}").count() > 0
    settled = spark.range(100).selectExpr("concat('i', id % 7) AS instrument", "100 - id AS funding_time", "0.1D AS rate", "'v' AS venue", "'d' AS date")
    tables.write_tables({"funding": settled.coalesce(1), "none": settled.limit(0)}, str(tmp_path / "t"))
    file, = (tmp_path / "t" / "funding").glob("*/*/*.parquet")
    assert pq.read_table(file)["funding_time"].to_pylist() == list(range(1, 101))
    assert not list((tmp_path / "t" / "none").glob("venue=*"))


def test_a_day_with_the_next_ones_table_and_log(spark):
    """Late rows are found one day ahead, not further; a table counts only if its day passed, the log always."""
    cols = "venue string, instrument string, funding_time long, rate double, captured long"
    at = lambda d: d * NS_DAY + 5
    rows = [("v", "own", at(1), 0.1, 1), ("v", "late", at(1), 0.2, 2), ("v", "later", at(1), 0.3, 3), ("v", "twice", at(1), 0.4, 1), ("v", "twice", at(1), 0.5, 2), ("v", "own", at(2), 0.1, 2), ("v", "late", at(2), 0.2, 3), ("v", "own", at(4), 0.1, 4)]
    log = [("v", "logged", at(1), 0.6, 2), ("v", "twice", at(1), 0.7, 2), ("v", "logged", at(2), 0.6, 3), ("v", "logged", at(3), 0.6, 3)]
    tables_, log_ = spark.createDataFrame(rows, cols), spark.createDataFrame(log, cols)
    verdicts = spark.createDataFrame([("v", 1, "pass"), ("v", 2, "pass"), ("v", 3, "fail"), ("v", 5, "pass")], "venue string, day long, status string")
    got = sorted((r.day, r.instrument, r.rate) for r in datasets.assembled(tables_, log_, verdicts).collect())
    assert got == [(1, "late", 0.2), (1, "logged", 0.6), (1, "own", 0.1), (1, "twice", 0.7), (2, "logged", 0.6), (2, "own", 0.1)]
    expected = spark.createDataFrame([("v", "own", at(d), 0.1) for d in (1, 2, 3, 4)] + [("v", "late", at(1), 0.2), ("v", "logged", at(1), 0.6), ("v", "twice", at(1), 0.7), ("v", "gone", at(2), 1.0)], "venue string, instrument string, funding_time long, rate double")
    out = {r.day: (r.expected, r.matched, r.missing, r.extra, r.status, r.reason) for r in datasets.reconcile_days(expected, tables_, log_, verdicts).collect()}
    assert out == {1: (4, 4, 0, 0, "pass", None), 2: (2, 1, 1, 1, "fail", None), 3: (1, 0, 0, 0, "blocked", "checks: fail"), 4: (1, 0, 0, 0, "blocked", "not published")}
