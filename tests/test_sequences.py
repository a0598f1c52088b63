"""Window forms of the log checks against sequential models on random logs."""

import random

import pytest
from pyspark.sql import functions as F

from tidewright.operators import datasets, normalize, qa, reference


def random_log(seed, n=220):
    rng = random.Random(seed)
    log, last = [], {}
    for pos in range(n):
        inst, source, what = rng.choice("abc"), rng.choice([1, 2]), rng.choice(["update"] * 6 + ["snapshot"] * 2 + ["down"])
        ts = pos * 1_000_000_000 + rng.randrange(5)
        u = last.get(inst, 0)
        if what == "update":
            first = u + 1 - rng.choice([0, 0, 0, 2])
            final = u + rng.randint(1, 6)
            log.append(("update", inst, source, pos, ts, first, final, rng.choice([u, u, u, u - 1, None])))
            last[inst] = final
        elif what == "snapshot":
            log.append(("snapshot", inst, 0, pos, ts, u + rng.randint(-6, 6), None, None))
        else:
            log.append(("down", None, source, pos, ts, None, None, None))
    return log


def sequential(log):
    state, breaks, snaps = {}, {}, []
    for what, inst, source, pos, ts, a, b, pu in log:
        if what == "down":
            for st in state.values():
                if st["source"] == source:
                    st["pending"] = True
                    for s in st["snaps"]:
                        if not s["spliced"]:
                            s["abandoned"] = True
            continue
        st = state.setdefault(inst, {"last": None, "source": None, "pending": False, "snaps": []})
        if what == "snapshot":
            s = {"key": (inst, pos), "id": a, "ts": ts, "spliced": False, "abandoned": False}
            st["snaps"].append(s)
            snaps.append(s)
            continue
        if pu is not None and st["last"] is not None and pu != st["last"]:
            breaks[inst, pos] = st["pending"]
        st.update(last=b, source=source, pending=False)
        for s in st["snaps"]:
            s["spliced"] |= a <= s["id"] + 1 <= b
    end = max(r[4] for r in log)
    word = lambda s: "spliced" if s["spliced"] else "abandoned" if s["abandoned"] else "pending" if s["ts"] + 60_000_000_000 >= end else "unspliced"
    return breaks, {s["key"]: word(s) for s in snaps}


@pytest.mark.parametrize("seed", range(6))
def test_chain_and_snapshots(spark, seed, monkeypatch):
    monkeypatch.setattr(qa, "POSITIONS", 16)
    log = random_log(seed)
    df = spark.createDataFrame(log, "what string, instrument string, source int, pos long, local_ts long, a long, b long, pu long").withColumn("venue", F.lit("v"))
    upd = df.where("what = 'update'").select("venue", "instrument", "source", "pos", "local_ts", F.col("a").alias("first_update_id"), F.col("b").alias("final_update_id"), F.col("pu").alias("prev_final_update_id"))
    snap = df.where("what = 'snapshot'").select("venue", "instrument", "pos", "local_ts", F.col("a").alias("last_update_id"))
    downs = df.where("what = 'down'").select("venue", "source", "pos")
    breaks, states = sequential(log)
    assert {(r.instrument, r.pos): r.explained for r in qa.explained(qa.chain(upd).where("is_break"), downs).collect()} == breaks
    ends = df.groupBy("venue").agg(F.max("local_ts").alias("max_local_ts"))
    assert {(r.instrument, r.pos): r.state for r in qa.snapshot_states(snap, upd, downs, ends).collect()} == states


def test_latency_tails_and_percentiles(spark):
    df = spark.createDataFrame([("v", "k", i * 1_000_000) for i in range(1, 101)] + [("v", "t", x) for x in (-2_000_000_000, -500_000_000, 20_000_000_000)], "venue string, kind string, delta long")
    got = {r.kind: (r.p50_us, r.p95_us, r.p99_us, r.min_us, r.max_us) for r in qa.latency_percentiles(qa.latency_histogram(df)).collect()}
    assert got["k"] == (51_000, 96_000, 100_000, 1_000, 100_000)
    assert got["t"] == (-499_000, 20_000_000, 20_000_000, -2_000_000, 20_000_000)


@pytest.mark.parametrize("seed", range(5))
def test_health_and_history(spark, seed):
    rng = random.Random(seed)
    rows = [("p", i, rng.random() < 0.5) for i in range(80)]
    up, fails, want = False, 0, []
    for _, pos, ok in rows:
        if ok:
            if not up:
                want.append((pos, "up"))
            up, fails = True, 0
        else:
            fails += 1
            if fails == 3:
                want.append((pos, "down"))
                up = False
    got = qa.health_transitions(spark.createDataFrame(rows, "label string, pos long, ok boolean")).collect()
    assert sorted((r.pos, r.state) for r in got) == sorted(want)
    dumps = [("s", d, rng.choice([None, "x", "y"])) for d in range(0, 300, 10) if rng.random() < 0.8] + [("all", d, "z") for d in range(0, 300, 10)]
    folded, open_ = [], None
    mine = {d: a for s, d, a in dumps if s == "s"}
    for d in range(0, 300, 10):
        if open_ and (d not in mine or mine[d] != open_[1]):
            folded.append((*open_, d))
            open_ = None
        if d in mine and not open_:
            open_ = (d, mine[d])
    if open_:
        folded.append((*open_, None))
    out = reference.fold_history(spark.createDataFrame(dumps, "symbol string, dump_day long, status string"), ["status"]).where("symbol = 's'").collect()
    assert sorted(((r.valid_from, r.status, r.valid_to) for r in out), key=str) == sorted(folded, key=str)


def test_reconcile_null_rate_is_no_mismatch(spark):
    cols = "venue string, instrument string, funding_time long, rate double"
    e = spark.createDataFrame([("v", "a", 1, 0.1), ("v", "a", 2, 0.1), ("v", "a", 3, 0.1)], cols)
    c = spark.createDataFrame([("v", "a", 1, None), ("v", "a", 2, 0.2), ("v", "a", 4, 0.1)], cols)
    assert {r.funding_time: r.outcome for r in datasets.reconcile(e, c).collect()} == {1: "matched", 2: "mismatch", 3: "missing", 4: "extra"}


def test_orders_and_expectations(spark):
    detail = spark.createDataFrame([("v", "b", 2, "missing"), ("v", "a", 2, "extra"), ("v", "z", 1, "extra"), ("v", "a", 1, "matched")], "venue string, instrument string, funding_time long, outcome string").repartition(3)
    assert [(r.funding_time, r.instrument) for r in datasets.differences(detail).collect()] == [(1, "z"), (2, "a"), (2, "b")]
    assert tuple(datasets.expected_rows(detail, 4).first()) == (4, True)
    assert tuple(datasets.expected_rows(detail.limit(0)).first()) == (0, False)
    dumps = spark.createDataFrame([("b", 1, "x"), ("a", 1, "x"), ("a", 2, "y")], "symbol string, dump_day long, status string")
    assert [(r.symbol, r.valid_from) for r in reference.history(dumps, ["status"]).collect()] == [("a", 1), ("a", 2), ("b", 1)]


def test_sessions_by_bucket(spark, monkeypatch):
    monkeypatch.setattr(qa, "POSITIONS", 10)
    downs = [3, 4, 25, 47]
    asked = list(range(0, 60, 7))
    a = spark.createDataFrame([("v", "s", p) for p in asked], "venue string, source string, at long")
    d = spark.createDataFrame([("v", "s", p) for p in downs] + [("v", "t", 1)], "venue string, source string, pos long")
    got = {r.at: r.session for r in qa.session_of(a, d).collect()}
    assert got == {p: sum(x <= p for x in downs) for p in asked}
    assert {r.session for r in qa.session_of(a, d.limit(0)).collect()} == {0}


def test_history_from_dumps(spark):
    """Empty and unreadable dumps, and interval lists of days with and without an exchange dump."""
    import json

    def body(*symbols):
        return json.dumps({"symbols": [{"symbol": x, "status": "TRADING", "contractType": "PERPETUAL", "baseAsset": "A", "quoteAsset": "Q", "marginAsset": "Q", "filters": []} for x in symbols]})

    def hours(**of):
        return json.dumps([{"symbol": k, "fundingIntervalHours": v} for k, v in of.items()])

    exchange = [(1, body("A", "B")), (2, body("A")), (3, "{broken"), (4, body("A")), (5, body()), (6, body("A")), (7, body("A"))]
    lists = [(1, hours(A=1, B=2)), (3, hours(A=4)), (6, "[]"), (7, "[{"), (8, hours(A=2))]
    dumps = spark.createDataFrame(exchange, "dump_day long, body string")
    snaps = normalize.day_snapshots(dumps, spark.createDataFrame(lists, "dump_day long, body string"))
    h = 3_600_000_000_000
    got = {(r.symbol, r.dump_day): r.interval_ns // h for r in snaps.collect()}
    assert got == {("a", 1): 1, ("b", 1): 2, ("a", 2): 1, ("a", 4): 4, ("a", 6): 8, ("a", 7): 8}
    spans = reference.history(snaps, ["interval_ns"], days=normalize.dump_days(dumps))
    assert [(r.symbol, r.interval_ns // h, r.valid_from, r.valid_to) for r in spans.collect()] == [("a", 1, 1, 4), ("a", 4, 4, 5), ("a", 8, 6, None), ("b", 2, 1, 2)]
    between = spark.createDataFrame([(1, body("A")), (3, body("A"))], "dump_day long, body string")
    snaps = normalize.day_snapshots(between, spark.createDataFrame([(2, hours(A=4))], "dump_day long, body string"))
    assert {r.interval_ns // h for r in snaps.collect()} == {8}


def test_wide_id_ranges(spark):
    """Ranges of any width are met, at both of their ends and beyond none of them."""
    widths = [0, 1, 255, 256, 70_000, 10**9, 10**13, 2**62]
    upd = [("v", f"w{i}", 10, 5, 5 + w) for i, w in enumerate(widths)] + [("v", "back", 10, 9, 3)]
    snap = [("v", f"w{i}", p, at - 1) for i, w in enumerate(widths) for p, at in ((1, 5), (2, 5 + w), (3, 5 + w // 2), (4, 4), (5, 6 + w), (11, 5))] + [("v", "back", 1, 4), ("v", "none", 1, 4)]
    u = spark.createDataFrame(upd, "venue string, instrument string, pos long, first_update_id long, final_update_id long")
    s = spark.createDataFrame(snap, "venue string, instrument string, pos long, last_update_id long")
    got = sorted((r.instrument, r.pos) for r in qa.spliced(s, u).collect())
    assert got == sorted((f"w{i}", p) for i in range(len(widths)) for p in (1, 2, 3))


@pytest.mark.parametrize("width", [1, 7, 4096])
def test_one_instrument_in_many_buckets(spark, monkeypatch, width):
    """Chains and regressions of one hot instrument do not depend on the buckets, and go on from day to day."""
    monkeypatch.setattr(qa, "POSITIONS", width)
    rng = random.Random(width)
    rows, last = [], None
    for pos in sorted(rng.sample(range(300), 120)):
        final = rng.choice([None, pos * 10, pos * 10])
        rows.append(("v", "hot", rng.choice([1, 2]), pos, pos * 10 - 9, final, rng.choice([last, last, 1, None])))
        last = final if final is not None else last
    cols = "venue string, instrument string, source int, pos long, first_update_id long, final_update_id long, prev_final_update_id long"
    df = spark.createDataFrame(rows, cols).repartition(3)
    want, before = [], (None, None, None)
    for _, _, source, pos, first, final, pu in rows:
        linked = pu is not None and before[0] is not None
        broken = linked and pu != before[0]
        want.append((pos, *before, broken, linked and not broken and first <= before[0]))
        before = (final if final is not None else before[0], pos, source)
    out = ("pos", "last_final", "prev_pos", "prev_source", "is_break", "is_overlap")
    key = lambda r: r[0]
    assert sorted((tuple(r) for r in qa.chain(df).select(*out).collect()), key=key) == want
    day1, day2, day3 = (df.where(c) for c in ("pos < 100", "pos >= 100 AND pos < 200", "pos >= 200"))
    carry, got = None, []
    for day in (day1, day2.limit(0), day2, day3):
        got += [tuple(r) for r in qa.chain(day, carry).select(*out).collect()]
        carry = qa.chain_ends(day, carry)
        carry = spark.createDataFrame(carry.collect(), carry.schema)
    assert sorted(got, key=key) == want
    assert [tuple(r)[2:] for r in carry.collect()] == [before]
