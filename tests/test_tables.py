from pyspark.sql import functions as F

from tidewright.functions import market
from tidewright.sources import tables


def test_publish_and_gate(spark, tmp_path):
    root = str(tmp_path / "lake")
    ns = 1_700_000_000_000_000_000
    rows = [("v", "a", ns, ns, 1.0), ("v", "b", ns, ns + 86_400_000_000_000, 2.0), ("w", "a", None, ns, 3.0)]
    log = tables.routed(spark.createDataFrame(rows, "venue string, instrument string, venue_ts long, local_ts long, price double"), "2023-11-15")
    assert sorted(r.is_late for r in log.collect()) == [False, True, True]
    assert tables.registry(spark, root).count() == 0
    assert tables.closed_days(log, tables.registry(spark, root), "2023-11-15").count() == 2
    verdicts = spark.createDataFrame([("v", "pass", 0), ("w", "fail", 2)], "venue string, status string, failures long").withColumn("date", F.lit("2023-11-14").cast("date"))
    for _ in range(2):  # publishing a day again replaces it
        tables.publish(spark, {"mark_price": log.drop("is_late")}, verdicts, root, ns)
    got = spark.read.parquet(f"{root}/mark_price")
    assert got.count() == 3
    registry = tables.registry(spark, root)
    assert tables.closed_days(log, registry, "2023-11-15").count() == 0
    assert tables.published(got, registry, passed_only=True).count() == 1
    reasons = {(r.venue, str(r.date)): r.reason for r in tables.blocking_reasons(log.select("venue", "date").distinct(), registry).collect()}
    assert reasons == {("v", "2023-11-14"): None, ("v", "2023-11-15"): "not published", ("w", "2023-11-14"): "failed its checks"}


def test_periods_are_published_once(spark, tmp_path):
    def rows(*days):
        return spark.createDataFrame([(d, v) for d, v in days], "date string, v long").withColumn("date", F.col("date").cast("date"))

    def seen(df, by="date"):
        return sorted((str(r[by]), r["rows"], r.outcome) for r in df.collect())

    root = str(tmp_path / "oi")
    first = tables.publish_days(rows(("2024-03-01", 1), ("2024-01-01", 1), ("2024-03-02", 2), ("2024-03-03", 3)), root, "2024-03-02")
    assert seen(first) == [("2024-03-01", 1, "published"), ("2024-03-02", 1, "partial")]  # too old, or still to come
    again = tables.publish_days(rows(("2024-03-01", 7), ("2024-03-01", 8), ("2024-03-02", 4), ("2024-03-02", 5), ("2024-03-03", 6)), root, "2024-03-03")
    assert seen(again) == [("2024-03-01", 1, "existing"), ("2024-03-02", 2, "published"), ("2024-03-03", 1, "partial")]
    got = spark.read.parquet(f"{root}/dates")
    assert sorted((r.v, r.is_partial) for r in got.collect()) == [(1, False), (4, False), (5, False), (6, True)]
    assert seen(tables.publish_days(rows(), root, "2024-03-03")) == [("2024-03-01", 1, "existing"), ("2024-03-02", 2, "existing"), ("2024-03-03", 1, "partial")]
    months = spark.createDataFrame([("2023-12", 1), ("2024-01", 2)], "month string, v long")
    for outcome in ("published", "existing"):
        assert seen(tables.publish_months(months, root, "2024-01"), "month") == [("2023-12", 1, outcome), ("2024-01", 1, "partial")]
    assert tables.publish_months(months.limit(0), str(tmp_path / "none"), "2024-01").count() == 0


def test_dumps_versions_and_curated(spark, tmp_path):
    for venue, day in (("x", "2024-01-02"), ("x", "2024-01-10"), ("y", "2023-05-05"), ("y", "notes")):
        (tmp_path / "dumps" / venue).mkdir(parents=True, exist_ok=True)
        (tmp_path / "dumps" / venue / f"{day}.json").write_text('{"d": "' + day + '"}')
    assert tables.dated_dumps(spark, str(tmp_path / "dumps")).count() == 3
    assert {r.venue: r.body for r in tables.dated_dumps(spark, str(tmp_path / "dumps"), latest=True).collect()} == {"x": '{"d": "2024-01-10"}', "y": '{"d": "2023-05-05"}'}
    for v in ("1", "2"):
        tables.rebuild(spark.range(int(v)), str(tmp_path / "ref"), v)
    assert tables.current(spark, str(tmp_path / "ref")).count() == 2
    assert tables.settlements(spark, str(tmp_path / "none"), 0, 1).count() == 0
    tables.write_report(spark.range(2), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report" / "json")).count() == 2


def test_scalar_rules(spark):
    day = market.NS_DAY
    df = spark.createDataFrame([(-1, "x"), (0, "1.5"), (day - 1, None), (day, "NaN")], "ns long, t string")
    got = df.select(market.day_of(F.col("ns")), market.micros(F.col("ns")), market.exact(F.col("t"))).collect()
    assert [r[0] for r in got] == [-1, 0, 0, 1]
    assert [r[1] for r in got] == [0, 0, (day - 1) // 1000, day // 1000]
    assert [r[2] is None for r in got] == [True, False, True, True]
    words = spark.createDataFrame([("CLOSE", "PERPETUAL"), ("DELIVERED", "CURRENT_QUARTER"), ("odd", None)], "s string, c string").select(market.lifecycle(F.col("s")), market.contract_class(F.col("c"))).collect()
    assert [tuple(r) for r in words] == [("delisted", "perp"), ("delisted", "future"), ("halted", None)]
