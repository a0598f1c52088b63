"""The library's queries on the given tables, each with its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.market import NS_DAY, canonical_key, day_of, month_bounds, month_next, month_of
from tidewright.operators import datasets, demux, qa, reference
from tidewright.plans.bindings import duck, frame

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Times at which the point-in-time queries ask, and the trailing window of the spread.
AT = 850_000_000_000_000_000
SPREAD_START, SPREAD_DAYS = 820_454_400_000_000_000, 730
DAY_SQL = f"((x - ((x % {NS_DAY}) + {NS_DAY}) % {NS_DAY}) // {NS_DAY})"


def query(name: str, views: tuple[str, ...], sql: str):
    """Register a function of (get), where get(view) is a DataFrame, under a name with its SQL."""

    def add(f: Callable[[Callable[[str], DataFrame]], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(lambda view: frame(spark, sf_dir, view))
        ORACLE_SQL[name] = duck(sql, *views)
        return f

    return add


def _sql_day(x: str) -> str:
    return f"CAST(floor({x} / {float(NS_DAY)}) AS BIGINT)"


# ---------------------------------------------------------------- point in time

_MAPPED = f"""WITH mapped AS (
  SELECT f.venue, f.instrument, f.funding_time, f.rate, m.base AS canonical FROM fund f JOIN mapping m
  ON f.venue = m.venue AND f.instrument = m.instrument AND f.funding_time >= m.valid_from AND (m.valid_to IS NULL OR f.funding_time < m.valid_to)
)
;
"""


def _mapped(get) -> DataFrame:
    dims = get("mapping").select("venue", "instrument", F.col("base").alias("canonical"), "valid_from", "valid_to")
    return reference.first_covering(get("fund"), dims, ["venue", "instrument"], "funding_time", ["canonical"], folded=("instrument",))


@query("funding_spread_topk", ("fund", "mapping"), _MAPPED + f"""
SELECT canonical, round(a, 9) AS first, round(b, 9) AS second, n_first, n_second, round(a - b, 9) AS spread FROM (
  SELECT canonical, sum(CASE WHEN venue = 'v0' THEN rate END) * (365.0 / {SPREAD_DAYS})::DOUBLE AS a, sum(CASE WHEN venue = 'v1' THEN rate END) * (365.0 / {SPREAD_DAYS})::DOUBLE AS b,
         count(*) FILTER (venue = 'v0') AS n_first, count(*) FILTER (venue = 'v1') AS n_second
  FROM mapped WHERE funding_time >= {SPREAD_START} GROUP BY canonical) WHERE n_first > 0 AND n_second > 0
ORDER BY abs(round(a - b, 9)) DESC, canonical LIMIT 15""")
def _(get):
    return datasets.funding_spread(_mapped(get), ("v0", "v1"), SPREAD_START, SPREAD_DAYS)


@query("canonical_pit_join", ("fund", "mapping"), _MAPPED + "SELECT * FROM mapped")
def _(get):
    return _mapped(get).select("venue", "instrument", "funding_time", "rate", "canonical")


@query("canonical_reverse_lookup", ("mapping",), f"""
SELECT q.venue, q.canonical, m.instrument FROM (SELECT DISTINCT venue, base AS canonical FROM mapping) q
JOIN mapping m ON m.venue = q.venue AND m.base = q.canonical AND {AT} >= m.valid_from AND (m.valid_to IS NULL OR {AT} < m.valid_to)""")
def _(get):
    m = get("mapping").withColumnRenamed("base", "canonical")
    asked = m.select("venue", "canonical").distinct().withColumn("at", F.lit(AT))
    return reference.point_in_time(asked, m.select("venue", "canonical", "instrument", "valid_from", "valid_to"), ["venue", "canonical"], "at").select("venue", "canonical", "instrument")


@query("matched_keys", ("mapping",), f"""
SELECT base AS canonical FROM mapping WHERE {AT} >= valid_from AND (valid_to IS NULL OR {AT} < valid_to) AND venue IN ('v0', 'v1') GROUP BY base HAVING count(DISTINCT venue) = 2""")
def _(get):
    return reference.matched_keys(get("mapping").withColumnRenamed("base", "canonical"), ["v0", "v1"], AT)


@query("mapping_overrides", ("mapping", "overrides"), """
SELECT m.venue, m.instrument, coalesce(o.base, m.base) AS base, concat_ws('-', coalesce(o.base, m.base), m.segment, 'perp', m.segment) AS canonical,
       CASE WHEN o.venue IS NULL THEN 'dump' ELSE 'override' END AS origin
FROM mapping m LEFT JOIN (SELECT * FROM overrides QUALIFY row_number() OVER (PARTITION BY venue, instrument ORDER BY pos DESC) = 1) o USING (venue, instrument)
WHERE NOT coalesce(o.exclude, false)""")
def _(get):
    out = reference.apply_overrides(get("mapping"), get("overrides"))
    return out.select("venue", "instrument", "base", canonical_key(F.col("base"), F.col("segment"), F.lit("perp"), F.lit(None).cast("string")).alias("canonical"), "origin")


@query("mapping_build_summary", ("mapping", "overrides"), """
SELECT m.venue, count(*) FILTER (NOT coalesce(o.exclude, false)) AS rows, count(*) FILTER (NOT o.exclude) AS overridden, count(*) FILTER (o.exclude) AS excluded
FROM mapping m LEFT JOIN (SELECT * FROM overrides QUALIFY row_number() OVER (PARTITION BY venue, instrument ORDER BY pos DESC) = 1) o USING (venue, instrument) GROUP BY m.venue""")
def _(get):
    return reference.build_summary(get("mapping"), get("overrides"))


@query("scd_fold", ("dump",), """WITH days AS (SELECT dump_day, row_number() OVER (ORDER BY dump_day) AS r, lead(dump_day) OVER (ORDER BY dump_day) AS nx FROM (SELECT DISTINCT dump_day FROM dump)),
l AS (SELECT d.*, r, nx, CASE WHEN lag(r) OVER w = r - 1 AND lag(status) OVER w IS NOT DISTINCT FROM status AND lag(priority) OVER w IS NOT DISTINCT FROM priority THEN 0 ELSE 1 END AS fresh
      FROM dump d JOIN days USING (dump_day) WINDOW w AS (PARTITION BY symbol ORDER BY dump_day)),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY symbol ORDER BY dump_day) AS island FROM l)
;
SELECT symbol, min(status) AS status, min(priority) AS priority, min(dump_day) AS valid_from,
       CASE WHEN max(coalesce(nx, 9e18::BIGINT)) = 9e18::BIGINT THEN -1 ELSE max(nx) END AS valid_to FROM i GROUP BY symbol, island""")
def _(get):
    return reference.fold_history(get("dump"), ["status", "priority"]).select("symbol", "status", "priority", "valid_from", F.coalesce("valid_to", F.lit(-1)).alias("valid_to"))


@query("scd_pit_lookup", ("dump", "fund"), """WITH days AS (SELECT DISTINCT dump_day FROM dump), spans AS (SELECT symbol, status, dump_day AS valid_from, (SELECT min(x.dump_day) FROM days x WHERE x.dump_day > d.dump_day) AS valid_to FROM dump d)
;
SELECT f.instrument AS symbol, f.venue, f.funding_time, s.status FROM fund f JOIN spans s ON s.symbol = f.instrument AND f.funding_time >= s.valid_from AND (s.valid_to IS NULL OR f.funding_time < s.valid_to)""")
def _(get):
    spans = reference.fold_history(get("dump"), ["status", "priority"]).select("symbol", "status", "valid_from", "valid_to")
    facts = get("fund").select(F.col("instrument").alias("symbol"), "venue", "funding_time")
    return reference.point_in_time(facts, spans, ["symbol"], "funding_time")


@query("asof_carry_forward", ("dump",), f"""WITH part AS (SELECT symbol, dump_day, priority AS value FROM dump WHERE {_sql_day('dump_day')} % 3 = 0),
used AS (SELECT d.dump_day, (SELECT max(s.dump_day) FROM part s WHERE s.dump_day <= d.dump_day) AS u FROM (SELECT DISTINCT dump_day FROM dump) d)
;
SELECT d.symbol, d.dump_day, coalesce(s.value, 'default') AS value FROM dump d JOIN used ON d.dump_day = used.dump_day LEFT JOIN part s ON s.symbol = d.symbol AND s.dump_day = used.u""")
def _(get):
    dump = get("dump")
    some = dump.where(day_of(F.col("dump_day")) % 3 == 0).select("symbol", "dump_day", F.col("priority").alias("value"))
    return reference.carried_forward(dump.select("symbol", "dump_day"), some).select("symbol", "dump_day", F.coalesce("value", F.lit("default")).alias("value"))


@query("fee_asof", ("fees", "fund"), """WITH w AS (SELECT *, lead(valid_from) OVER (PARTITION BY venue, tier ORDER BY valid_from) AS valid_to FROM fees)
;
SELECT f.venue, w.tier, count(*) AS settlements, round(avg(w.maker)::DOUBLE, 9) AS maker FROM fund f JOIN w ON f.venue = w.venue AND f.funding_time >= w.valid_from AND (w.valid_to IS NULL OR f.funding_time < w.valid_to)
GROUP BY f.venue, w.tier""")
def _(get):
    fees = reference.as_windows(get("fees"), ["venue", "tier"])
    joined = reference.point_in_time(get("fund"), fees, ["venue"], "funding_time")
    return joined.groupBy("venue", "tier").agg(F.count("*").alias("settlements"), F.round(F.avg(F.col("maker").cast("double")), 9).alias("maker"))


@query("first_covering_window", ("dump", "fund"), """WITH w AS (SELECT symbol, status, dump_day, dump_day + 8640000000000000 AS until FROM dump)
;
SELECT venue, instrument, funding_time, coalesce(status, 'none') AS status, coalesce(dump_day, -1) AS dump_day FROM (
  SELECT f.venue, f.instrument, f.funding_time, w.status, w.dump_day, row_number() OVER (PARTITION BY f.venue, f.instrument, f.funding_time ORDER BY w.status, w.dump_day) AS n
  FROM fund f LEFT JOIN w ON w.symbol = f.instrument AND f.funding_time >= w.dump_day AND f.funding_time < w.until) x WHERE n = 1""")
def _(get):
    """Listings that hold for a hundred days, so those of four months overlap, under symbols in upper case."""
    hundred_days = 100 * NS_DAY
    w = get("dump").select(F.upper("symbol").alias("instrument"), "status", "dump_day", F.col("dump_day").alias("valid_from"), (F.col("dump_day") + hundred_days).alias("valid_to"))
    facts = get("fund").select("venue", "instrument", "funding_time")
    out = reference.first_covering(facts, w, ["instrument"], "funding_time", ["status", "dump_day"], "left", ("instrument",))
    return out.fillna("none", ["status"]).fillna(-1, ["dump_day"])


@query("fee_violations", ("fees",), "SELECT venue, tier, valid_from FROM fees WHERE maker IS NULL OR abs(maker) > 0.05 OR taker IS NULL OR abs(taker) > 0.05 OR valid_from IS NULL")
def _(get):
    fees = get("fees").withColumns({c: F.col(c).cast("double") for c in ("maker", "taker")})
    return reference.fee_violations(fees).select("venue", "tier", "valid_from")


@query("unknown_instruments", ("fund", "mapping"), "SELECT DISTINCT instrument FROM fund WHERE instrument NOT IN (SELECT instrument FROM mapping WHERE segment = 'BUILDING')")
def _(get):
    return reference.unknown_instruments(get("fund").select("instrument").distinct(), get("mapping").where("segment = 'BUILDING'"))


@query("universe_diff", ("dump",), """WITH days AS (SELECT dump_day, lag(dump_day) OVER (ORDER BY dump_day) AS b, lead(dump_day) OVER (ORDER BY dump_day) AS a FROM (SELECT DISTINCT dump_day FROM dump)),
n AS (SELECT d.*, days.b FROM dump d JOIN days USING (dump_day)), o AS (SELECT d.symbol, days.a AS dump_day, d.status, d.priority FROM dump d JOIN days USING (dump_day) WHERE days.a IS NOT NULL)
;
SELECT * FROM (SELECT coalesce(n.symbol, o.symbol) AS symbol, coalesce(n.dump_day, o.dump_day) AS dump_day,
  CASE WHEN n.symbol IS NULL THEN 'delisted' WHEN n.b IS NULL THEN 'baseline' WHEN o.symbol IS NULL THEN 'added'
       WHEN n.status IS DISTINCT FROM o.status OR n.priority IS DISTINCT FROM o.priority THEN 'changed' END AS change
FROM n FULL JOIN o ON n.symbol = o.symbol AND n.dump_day = o.dump_day) WHERE change IS NOT NULL""")
def _(get):
    return reference.consecutive_changes(get("dump"), ["status", "priority"])


@query("autosubscribe_candidates", ("dump",), """WITH days AS (SELECT dump_day, lag(dump_day) OVER (ORDER BY dump_day) AS b FROM (SELECT DISTINCT dump_day FROM dump))
;
SELECT d.symbol, d.dump_day FROM dump d JOIN days USING (dump_day) WHERE days.b IS NOT NULL AND d.status = 'O'
AND NOT EXISTS (SELECT 1 FROM dump p WHERE p.symbol = d.symbol AND p.dump_day = days.b)""")
def _(get):
    dump = get("dump")
    added = reference.consecutive_changes(dump, ["status", "priority"]).where("change = 'added'")
    return added.join(dump.where("status = 'O'").select("symbol", "dump_day"), ["symbol", "dump_day"], "left_semi").select("symbol", "dump_day")


# ---------------------------------------------------------------- reconciliation and datasets

_DETAIL = """WITH detail AS (
  SELECT coalesce(e.venue, c.venue) AS venue, coalesce(e.instrument, c.instrument) AS instrument, coalesce(e.funding_time, c.funding_time) AS funding_time,
         CASE WHEN c.venue IS NULL THEN 'missing' WHEN e.venue IS NULL THEN 'extra' WHEN coalesce(abs(e.rate - c.rate) > 1e-10, false) THEN 'mismatch' ELSE 'matched' END AS outcome
  FROM fund e FULL JOIN capt c ON e.venue = c.venue AND e.instrument = c.instrument AND e.funding_time = c.funding_time
)"""
_DAILY = _DETAIL + f""", daily AS (
  SELECT venue, {_sql_day('funding_time')} AS day, count(*) FILTER (outcome = 'matched') AS matched, count(*) FILTER (outcome = 'missing') AS missing,
         count(*) FILTER (outcome = 'extra') AS extra, count(*) FILTER (outcome = 'mismatch') AS mismatch FROM detail GROUP BY 1, 2
)"""


def _detail(get) -> DataFrame:
    return datasets.reconcile(get("fund"), get("capt"))


def _daily(get) -> DataFrame:
    return datasets.daily_coverage(_detail(get).withColumn("day", day_of(F.col("funding_time"))))


@query("reconcile_detail", ("fund", "capt"), _DETAIL + "\n;\nSELECT * FROM detail")
def _(get):
    return _detail(get)


@query("reconcile_differences", ("fund", "capt"), _DETAIL + "\n;\nSELECT venue, instrument, funding_time, outcome FROM detail WHERE outcome IN ('missing', 'extra')")
def _(get):
    return datasets.differences(_detail(get)).select("venue", "instrument", "funding_time", "outcome")


@query("reconcile_enough", ("fund", "capt"), _DETAIL + "\n;\nSELECT count(*) AS rows, count(*) >= 100 AS enough FROM detail WHERE outcome = 'matched'")
def _(get):
    return datasets.expected_rows(_detail(get).where("outcome = 'matched'"))


@query("reconcile_daily", ("fund", "capt"), _DAILY + """
;
SELECT venue, day, matched, missing, extra, mismatch, round(CASE WHEN matched + missing + mismatch = 0 THEN 100.0 ELSE (matched + mismatch) * 100.0 / (matched + missing + mismatch) END::DOUBLE, 6) AS coverage_pct,
       missing + extra + mismatch = 0 AS passed FROM daily""")
def _(get):
    return _daily(get).withColumn("coverage_pct", F.round(F.col("coverage_pct").cast("double"), 6))


@query("green_streak", ("fund", "capt"), _DAILY + """, g AS (SELECT venue, day, day - row_number() OVER (PARTITION BY venue ORDER BY day) AS island FROM daily WHERE missing + extra + mismatch = 0)
;
SELECT venue, day, CAST(least(row_number() OVER (PARTITION BY venue, island ORDER BY day), 401) AS BIGINT) AS streak FROM g""")
def _(get):
    return datasets.green_streaks(_daily(get))


@query("reconcile_assembled", ("fund", "capt"), f"""WITH c AS (SELECT *, {_sql_day('funding_time')} AS day, CAST(substr(instrument, 2) AS BIGINT) % 7 AS h FROM capt),
t AS (SELECT venue, instrument, funding_time, rate, day + CASE WHEN h = 5 THEN 1 WHEN h = 6 THEN 2 ELSE 0 END AS captured, day FROM c WHERE h <> 4),
l AS (SELECT venue, instrument, funding_time, rate + 0.5 AS rate, day + 1 AS captured, day FROM c WHERE h IN (3, 4)),
v AS (SELECT DISTINCT venue, captured AS day, CASE WHEN captured % 10 = 9 THEN 'fail' ELSE 'pass' END AS status FROM t WHERE captured % 10 <> 8),
p AS (SELECT venue, day FROM v WHERE status = 'pass'),
a AS (SELECT venue, instrument, funding_time, day, arg_max(rate, o) AS rate FROM (
  SELECT t.venue, t.instrument, t.funding_time, t.day, t.rate, t.captured - t.day AS o FROM t JOIN p ON p.venue = t.venue AND p.day = t.captured WHERE t.captured - t.day <= 1
  UNION ALL SELECT venue, instrument, funding_time, day, rate, 2 AS o FROM l) x GROUP BY ALL),
e AS (SELECT *, {_sql_day('funding_time')} AS day FROM fund),
g AS (SELECT d.venue, d.day, CASE WHEN v.status IS NULL THEN 'not published' WHEN v.status <> 'pass' THEN 'checks: ' || v.status END AS reason FROM (SELECT DISTINCT venue, day FROM e) d LEFT JOIN v USING (venue, day)),
b AS (SELECT coalesce(x.venue, y.venue) AS venue, coalesce(x.day, y.day) AS day, CASE WHEN y.venue IS NULL THEN 'missing' WHEN x.venue IS NULL THEN 'extra' WHEN abs(x.rate - y.rate) > 1e-10 THEN 'mismatch' ELSE 'matched' END AS o
  FROM (SELECT e.* FROM e JOIN p USING (venue, day)) x FULL JOIN (SELECT a.* FROM a JOIN p USING (venue, day)) y ON x.venue = y.venue AND x.instrument = y.instrument AND x.funding_time = y.funding_time),
n AS (SELECT venue, day, count(*) FILTER (o <> 'extra') AS expected, count(*) FILTER (o = 'matched') AS matched, count(*) FILTER (o = 'missing') AS missing, count(*) FILTER (o = 'extra') AS extra, count(*) FILTER (o = 'mismatch') AS mismatch FROM b GROUP BY 1, 2)
;
SELECT venue, day, expected, matched, missing, extra, mismatch, round((CASE WHEN expected = 0 THEN 100.0 ELSE (matched + mismatch) * 100.0 / expected END)::DOUBLE, 6) AS coverage_pct,
       CASE WHEN missing + extra + mismatch = 0 THEN 'pass' ELSE 'fail' END AS status, 'none' AS reason FROM n
UNION ALL SELECT g.venue, g.day, count(*), 0, 0, 0, 0, 0.0, 'blocked', g.reason FROM g JOIN e USING (venue, day) WHERE g.reason IS NOT NULL GROUP BY g.venue, g.day, g.reason""")
def _(get):
    """Captured settlements stand in the table of their day, of the next one or the one after, or only in the next day's log; a tenth of the days failed, a tenth was not published."""
    c = get("capt").withColumns({"day": day_of(F.col("funding_time")), "h": F.substring("instrument", 2, 20).cast("long") % 7})
    tables = c.where("h <> 4").withColumn("captured", F.col("day") + F.when(F.col("h") == 5, 1).when(F.col("h") == 6, 2).otherwise(0)).drop("h")
    log = c.where("h IN (3, 4)").withColumns({"captured": F.col("day") + 1, "rate": F.col("rate") + 0.5}).drop("h")
    verdicts = tables.where("captured % 10 <> 8").select("venue", F.col("captured").alias("day"), F.when(F.col("captured") % 10 == 9, "fail").otherwise("pass").alias("status")).distinct()
    out = datasets.reconcile_days(get("fund"), tables.drop("day"), log.drop("day"), verdicts)
    return out.withColumn("coverage_pct", F.round(F.col("coverage_pct").cast("double"), 6)).fillna("none", ["reason"])


@query("live_history_union", ("fund", "capt"), """
SELECT venue, instrument, funding_time, rate FROM fund
UNION ALL SELECT venue, instrument, funding_time, rate FROM capt c WHERE NOT EXISTS (SELECT 1 FROM fund f WHERE f.venue = c.venue AND f.instrument = c.instrument AND f.funding_time = c.funding_time)""")
def _(get):
    return datasets.last_write_wins([get("capt"), get("fund")], ["venue", "instrument", "funding_time"])


@query("last_write_wins", ("fund", "capt"), """
SELECT venue, instrument, max_by(rate, funding_time) AS rate, max(funding_time) AS funding_time FROM (
  SELECT *, 0 AS p FROM fund UNION ALL SELECT *, 1 AS p FROM capt) x WHERE p = CASE WHEN EXISTS (SELECT 1 FROM capt c WHERE c.venue = x.venue AND c.instrument = x.instrument) THEN 1 ELSE 0 END GROUP BY venue, instrument""")
def _(get):
    return datasets.last_write_wins([get("fund"), get("capt")], ["venue", "instrument"], ["funding_time"]).select("venue", "instrument", "rate", "funding_time")


@query("first_seen_dedup", ("fund", "capt"), """
SELECT venue, instrument, funding_time, coalesce(any_value(rate) FILTER (p = 0), any_value(rate) FILTER (p = 1)) AS rate FROM (
  SELECT *, 0 AS p FROM fund UNION ALL SELECT *, 1 AS p FROM capt) GROUP BY venue, instrument, funding_time""")
def _(get):
    rows = get("fund").withColumn("page", F.lit(0)).unionByName(get("capt").withColumn("page", F.lit(1)))
    return datasets.first_seen(rows, ["venue", "instrument", "funding_time"], ["page"]).drop("page")


@query("settlement_interval", ("fund",), "SELECT venue, instrument, funding_time, rate, coalesce(funding_time - lag(funding_time) OVER (PARTITION BY venue, instrument ORDER BY funding_time), -1) AS realized_interval FROM fund")
def _(get):
    return datasets.settlement_intervals(get("fund")).fillna(-1, ["realized_interval"])


@query("backfill_worklist", (), """
SELECT strftime(d, '%Y-%m') AS month FROM (SELECT unnest(generate_series(TIMESTAMP '1992-01-01', TIMESTAMP '1999-12-01', INTERVAL 1 MONTH)) AS d)
WHERE strftime(d, '%Y-%m') NOT IN (SELECT strftime(o_orderdate, '%Y-%m') FROM orders WHERE extract(MONTH FROM o_orderdate) % 4 > 0)""")
def _(get):
    published = get("orders").where("month(o_orderdate) % 4 > 0").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return datasets.work_list("1992-01-01", "1999-12-01", published)


@query("month_partitions", ("fund",), """WITH last AS (SELECT strftime(make_timestamp(max(funding_time) // 1000), '%Y-%m') AS m FROM fund)
;
SELECT month, count(f.rate) AS rows, CASE WHEN count(f.rate) = 0 THEN 'empty' WHEN month = (SELECT m FROM last) THEN 'partial' ELSE 'published' END AS outcome
FROM (SELECT strftime(d, '%Y-%m') AS month FROM (SELECT unnest(generate_series(TIMESTAMP '1992-01-01', TIMESTAMP '1999-12-01', INTERVAL 1 MONTH)) AS d)) c
LEFT JOIN fund f ON strftime(make_timestamp(f.funding_time // 1000), '%Y-%m') = c.month GROUP BY month""")
def _(get):
    fund = get("fund").withColumn("month", month_of(F.col("funding_time")))
    last = fund.agg(F.max("month")).first()[0]
    months = fund.sparkSession.range(1).select(F.explode(F.expr("sequence(DATE '1992-01-01', DATE '1999-12-01', INTERVAL 1 MONTH)")).alias("d")).select(F.date_format("d", "yyyy-MM").alias("month"))
    return datasets.partition_outcomes(fund, months, last or "")


@query("sample_density", ("ev",), f"SELECT instrument, {_sql_day('local_ts')} AS day, count(*) AS samples, count(*) * 100.0::DOUBLE / 288 AS density_pct FROM ev GROUP BY 1, 2")
def _(get):
    out = datasets.sample_density(get("ev").withColumn("day", day_of(F.col("local_ts"))))
    return out.withColumn("density_pct", F.col("density_pct").cast("double"))


# ---------------------------------------------------------------- checks of a captured log

_CHAIN = """WITH lagged AS (SELECT *, lag(final_update_id) OVER w AS last_final, lag(pos) OVER w AS prev_pos, lag(source) OVER w AS prev_source FROM upd WINDOW w AS (PARTITION BY venue, instrument ORDER BY pos)),
flags AS (SELECT *, coalesce(prev_final_update_id <> last_final, false) AS is_break, coalesce(prev_final_update_id = last_final AND first_update_id <= last_final, false) AS is_overlap FROM lagged),
checked AS (SELECT f.*, is_break AND EXISTS (SELECT 1 FROM downs d WHERE d.venue = f.venue AND d.source = f.prev_source AND d.pos > f.prev_pos AND d.pos < f.pos) AS explained FROM flags f)"""
_STATES = """, ends AS (SELECT venue, max(local_ts) AS m FROM ev GROUP BY venue),
spans AS (SELECT venue, instrument, source, pos AS since, lead(pos) OVER (PARTITION BY venue, instrument ORDER BY pos) AS until FROM upd),
lost AS (SELECT s.venue, s.instrument, max(d.pos) AS lost FROM spans s JOIN downs d ON d.venue = s.venue AND d.source = s.source AND d.pos > s.since AND (s.until IS NULL OR d.pos < s.until) GROUP BY 1, 2),
spliced AS (SELECT s.venue, s.instrument, s.pos FROM snap s WHERE EXISTS (SELECT 1 FROM upd u WHERE u.venue = s.venue AND u.instrument = s.instrument AND u.pos > s.pos AND u.first_update_id <= s.last_update_id + 1 AND s.last_update_id + 1 <= u.final_update_id)),
states AS (SELECT s.*, CASE WHEN p.pos IS NOT NULL THEN 'spliced' WHEN l.lost > s.pos THEN 'abandoned' WHEN s.local_ts + 60000000000 >= e.m THEN 'pending' ELSE 'unspliced' END AS state
  FROM snap s JOIN ends e ON e.venue = s.venue LEFT JOIN spliced p ON p.venue = s.venue AND p.instrument = s.instrument AND p.pos = s.pos LEFT JOIN lost l ON l.venue = s.venue AND l.instrument = s.instrument)"""
_DEPTH = _CHAIN + _STATES + """, depth AS (
  SELECT venue, instrument, coalesce(updates, 0) AS updates, coalesce(be, 0) AS breaks_explained, coalesce(bu, 0) AS breaks_unexplained, coalesce(ov, 0) AS overlaps,
         coalesce(snapshots, 0) AS snapshots, coalesce(us, 0) AS unspliced, coalesce(pe, 0) AS pending, coalesce(ab, 0) AS abandoned
  FROM (SELECT venue, instrument, count(*) AS updates, count(*) FILTER (is_break AND explained) AS be, count(*) FILTER (is_break AND NOT explained) AS bu, count(*) FILTER (is_overlap) AS ov FROM checked GROUP BY 1, 2) u
  FULL JOIN (SELECT venue, instrument, count(*) AS snapshots, count(*) FILTER (state = 'unspliced') AS us, count(*) FILTER (state = 'pending') AS pe, count(*) FILTER (state = 'abandoned') AS ab FROM states GROUP BY 1, 2) s USING (venue, instrument)
)"""
_TRADES = """WITH num AS (SELECT *, TRY_CAST(trade_id AS BIGINT) AS id FROM trd),
sp AS (SELECT venue, instrument, pos, lag(pos) OVER w AS prev_pos, lag(source) OVER w AS prev_source FROM trd WINDOW w AS (PARTITION BY venue, instrument ORDER BY pos)),
reg AS (SELECT * FROM (SELECT *, lag(id) OVER (PARTITION BY venue, instrument ORDER BY pos, idx) AS last_id FROM num WHERE id IS NOT NULL) JOIN sp USING (venue, instrument, pos) WHERE id <= last_id),
reg2 AS (SELECT r.*, EXISTS (SELECT 1 FROM downs d WHERE d.venue = r.venue AND d.source = r.prev_source AND d.pos > r.prev_pos AND d.pos < r.pos) AS explained FROM reg r),
tr AS (SELECT * FROM (SELECT *, lag(update_id) OVER (PARTITION BY venue, instrument ORDER BY pos) AS last_id FROM tick) WHERE update_id <= last_id)"""


def _checked(get) -> DataFrame:
    flagged = qa.chain(get("upd"))
    broken = qa.explained(flagged.where("is_break"), get("downs")).select("venue", "instrument", "pos", "explained")
    return flagged.join(broken, ["venue", "instrument", "pos"], "left").fillna(False, ["explained"])


def _states(get) -> DataFrame:
    ends = get("ev").groupBy("venue").agg(F.max("local_ts").alias("max_local_ts"))
    return qa.snapshot_states(get("snap"), get("upd"), get("downs"), ends)


def _regressions(get) -> DataFrame:
    return qa.explained(qa.id_regressions(get("trd")), get("downs"))


@query("chain_breaks", ("upd",), _CHAIN.split(",\nchecked")[0] + "\n;\nSELECT venue, instrument, pos, is_break, is_overlap FROM flags WHERE is_break OR is_overlap")
def _(get):
    return qa.chain(get("upd")).where("is_break OR is_overlap").select("venue", "instrument", "pos", "is_break", "is_overlap")


@query("explained_breaks", ("upd", "downs"), _CHAIN + "\n;\nSELECT venue, instrument, pos, explained FROM checked WHERE is_break")
def _(get):
    return _checked(get).where("is_break").select("venue", "instrument", "pos", "explained")


@query("snapshot_splice", ("snap", "upd"), """
SELECT venue, instrument, pos FROM snap s WHERE EXISTS (SELECT 1 FROM upd u WHERE u.venue = s.venue AND u.instrument = s.instrument AND u.pos > s.pos AND u.first_update_id <= s.last_update_id + 1 AND s.last_update_id + 1 <= u.final_update_id)""")
def _(get):
    return qa.spliced(get("snap"), get("upd")).select("venue", "instrument", "pos")


@query("snapshot_state", ("ev", "snap", "upd", "downs"), _CHAIN + _STATES + "\n;\nSELECT venue, instrument, pos, state FROM states")
def _(get):
    return _states(get).select("venue", "instrument", "pos", "state")


@query("depth_summary", ("ev", "snap", "upd", "downs"), _DEPTH + "\n;\nSELECT *, updates > 0 AND snapshots = 0 AS missing_snapshot FROM depth")
def _(get):
    return qa.depth_summary(_checked(get), _states(get))


@query("qa_verdict", ("ev", "snap", "upd", "downs"), _DEPTH + """
;
SELECT v.venue, CAST(coalesce(sum((breaks_unexplained > 0)::INT + (unspliced > 0)::INT + (updates > 0 AND snapshots = 0)::INT), 0) AS BIGINT) AS failures,
       CASE WHEN coalesce(sum((breaks_unexplained > 0)::INT + (unspliced > 0)::INT + (updates > 0 AND snapshots = 0)::INT), 0) = 0 THEN 'pass' ELSE 'fail' END AS status
FROM (SELECT DISTINCT venue FROM ev) v LEFT JOIN depth d ON d.venue = v.venue GROUP BY v.venue""")
def _(get):
    venues = get("ev").groupBy("venue").agg(F.count("*").alias("events"))
    return qa.verdict(qa.depth_summary(_checked(get), _states(get)), venues)


@query("qa_failures", ("ev", "snap", "upd", "downs"), _DEPTH + """
;
SELECT * FROM (SELECT venue, unnest([CASE WHEN breaks_unexplained > 0 THEN concat(instrument, ': ', breaks_unexplained, ' unexplained depth chain break(s)') END,
  CASE WHEN unspliced > 0 THEN concat(instrument, ': ', unspliced, ' snapshot(s) never spliceable against the update stream') END,
  CASE WHEN updates > 0 AND snapshots = 0 THEN concat(instrument, ': depth updates but no REST snapshot all file') END]) AS message FROM depth) WHERE message IS NOT NULL""")
def _(get):
    venues = get("ev").groupBy("venue").agg(F.count("*").alias("events"))
    return qa.failures(qa.depth_summary(_checked(get), _states(get)), venues)


@query("trade_id_regressions", ("trd", "downs"), _TRADES.split(",\ntr AS")[0] + "\n;\nSELECT venue, instrument, pos, id, last_id, explained FROM reg2")
def _(get):
    return _regressions(get).select("venue", "instrument", "pos", F.col("id").cast("long"), F.col("last_id").cast("long"), "explained")


@query("ticker_regressions", ("tick",), "SELECT venue, instrument, pos, update_id, last_id FROM (SELECT *, lag(update_id) OVER (PARTITION BY venue, instrument ORDER BY pos) AS last_id FROM tick) WHERE update_id <= last_id")
def _(get):
    return qa.ticker_regressions(get("tick")).select("venue", "instrument", "pos", F.col("update_id").cast("long"), F.col("last_id").cast("long"))


@query("duplicate_summary", ("trd", "tick", "downs"), _TRADES + """
;
SELECT venue, instrument, CAST(sum(e) AS BIGINT) AS trades_explained, CAST(sum(n) AS BIGINT) AS trades_unexplained, CAST(sum(k) AS BIGINT) AS tickers FROM (
  SELECT venue, instrument, explained::INT AS e, (NOT explained)::INT AS n, 0 AS k FROM reg2 UNION ALL SELECT venue, instrument, 0, 0, 1 FROM tr) GROUP BY 1, 2""")
def _(get):
    return qa.duplicate_summary(_regressions(get), qa.ticker_regressions(get("tick")))


@query("counts_by_kind", ("ev",), "SELECT venue, kind, count(*) AS events FROM ev GROUP BY 1, 2")
def _(get):
    return qa.counts_by_kind(get("ev"))


@query("coverage", ("ev",), """SELECT venue, instrument, count(*) AS events, count(DISTINCT kind) AS kinds, min_by(local_ts, pos) AS first_local_ts, max_by(local_ts, pos) AS last_local_ts
FROM ev WHERE kind <> 'control' GROUP BY 1, 2""")
def _(get):
    return qa.coverage(get("ev"))


@query("control_counts", ("control",), """SELECT venue, count(*) FILTER (control_kind = 'conn_up') AS conn_up, count(*) FILTER (control_kind = 'conn_down') AS conn_down,
count(*) FILTER (control_kind = 'gap') AS gap_events, CAST(coalesce(sum(dropped) FILTER (control_kind = 'gap'), 0) AS BIGINT) AS dropped FROM control GROUP BY venue""")
def _(get):
    return qa.control_counts(get("control"))


@query("control_acks", ("control", "ev"), """SELECT venue, count(*) FILTER (control_kind = 'conn_up') AS conn_up, count(*) FILTER (control_kind = 'conn_down') AS conn_down, count(*) FILTER (control_kind = 'gap') AS gap_events,
CAST(coalesce(sum(dropped) FILTER (control_kind = 'gap'), 0) AS BIGINT) AS dropped, count(*) FILTER (ok) AS sub_ack_ok, count(*) FILTER (NOT ok) AS sub_ack_failed FROM (
  SELECT venue, control_kind, dropped, NULL::BOOLEAN AS ok FROM control UNION ALL SELECT venue, 'sub_ack', NULL, pos % 4 > 0 FROM ev) GROUP BY venue""")
def _(get):
    acks = get("ev").select("venue", F.lit("sub_ack").alias("control_kind"), (F.col("pos") % 4 > 0).alias("ok"))
    return qa.control_counts(get("control").unionByName(acks, allowMissingColumns=True))


_TIMELINE = """SELECT *, CASE pos % 7 WHEN 0 THEN 'sub_ack' WHEN 1 THEN 'snapshot_begin' WHEN 2 THEN 'snapshot_end' WHEN 3 THEN 'reorg' ELSE control_kind END AS k FROM control"""


@query("control_timeline", ("control",), f"""SELECT venue, n, concat('local_ts=', CAST(local_ts AS VARCHAR), ' ', CASE k WHEN 'sub_ack' THEN concat('SubAck id=', pos, ' ok=', pos % 4 > 0) WHEN 'snapshot_begin' THEN 'SnapshotBegin' WHEN 'snapshot_end' THEN 'SnapshotEnd'
  WHEN 'reorg' THEN concat('Reorg {{ from_block: ', pos, ' }}') WHEN 'conn_up' THEN concat('ConnUp c', source) WHEN 'conn_down' THEN concat('ConnDown c', source, ': lost') ELSE concat('Gap lost: ', dropped) END) AS entry, total > 500 AS truncated FROM (
  SELECT *, row_number() OVER (PARTITION BY venue ORDER BY pos) AS n, count(*) OVER (PARTITION BY venue) AS total FROM ({_TIMELINE})) WHERE n <= 500""")
def _(get):
    """Control events of all kinds, by turns."""
    pos = F.col("pos")
    kind = F.when(pos % 7 == 0, "sub_ack").when(pos % 7 == 1, "snapshot_begin").when(pos % 7 == 2, "snapshot_end").when(pos % 7 == 3, "reorg").otherwise(F.col("control_kind"))
    told = {"control_kind": kind, "label": F.concat(F.lit("c"), F.col("source").cast("string")), "reason": F.lit("lost"), "request_id": pos, "ok": pos % 4 > 0, "from_block": pos}
    return qa.control_timeline(get("control").withColumns(told))


@query("coverage_kinds", ("ev",), "SELECT venue, instrument, kind, count(*) AS events FROM ev WHERE kind <> 'control' GROUP BY 1, 2, 3")
def _(get):
    return qa.coverage_kinds(get("ev"))


@query("event_delay_percentiles", ("upd",), """WITH d AS (SELECT venue, ((pos % 25) - 3) * 1000000 AS x FROM upd WHERE pos % 11 > 0), r AS (SELECT venue, x, row_number() OVER (PARTITION BY venue ORDER BY x) AS i, count(*) OVER (PARTITION BY venue) AS n FROM d),
e AS (SELECT *, (x // 1000000 + 1) * 1000 AS edge FROM r)
;
SELECT venue, 'event_minus_transaction' AS kind, max(n) AS n, min(edge) FILTER (i >= ceil(0.5 * n)) AS p50_us, min(edge) FILTER (i >= ceil(0.95 * n)) AS p95_us, min(edge) FILTER (i >= ceil(0.99 * n)) AS p99_us, min(x) // 1000 AS min_us, max(x) // 1000 AS max_us FROM e GROUP BY venue""")
def _(get):
    """Depth updates whose event time is from three milliseconds before their transaction time to 21 after it; an eleventh have none."""
    told = F.when(F.col("pos") % 11 > 0, F.col("venue_ts") + (F.col("pos") % 25 - 3) * 1_000_000)
    return qa.latency_percentiles(qa.latency_histogram(qa.event_delays(get("upd").withColumn("event_time", told))))


@query("qa_failures_of_logs", ("ev", "snap", "upd", "downs"), _DEPTH + """, v AS (SELECT venue, count(*) AS n, count(*) FILTER (pos % CASE venue WHEN 'v0' THEN 50 ELSE 200 END = 0) AS bad FROM ev GROUP BY venue)
;
SELECT venue, count(*) AS messages, sum((message LIKE 'corrupt%')::INT)::BIGINT AS corrupt, sum((message LIKE 'file contains%')::INT)::BIGINT AS empty FROM (
  SELECT venue, unnest([CASE WHEN breaks_unexplained > 0 THEN 'break' END, CASE WHEN unspliced > 0 THEN 'unspliced' END, CASE WHEN updates > 0 AND snapshots = 0 THEN 'missing' END]) AS message FROM depth
  UNION ALL SELECT venue, 'corrupt' FROM v WHERE bad::DOUBLE / n > 0.01 UNION ALL SELECT 'v9', 'file contains') WHERE message IS NOT NULL GROUP BY venue""")
def _(get):
    """Logs of which a fiftieth or a two-hundredth is no frame, and one without any event."""
    ev = get("ev")
    venues = ev.groupBy("venue").agg(F.count("*").alias("events"), F.count_if(F.col("pos") % F.when(F.col("venue") == "v0", 50).otherwise(200) == 0).alias("bad"))
    frames = venues.select("venue", (F.col("bad") / F.col("events")).alias("skipped_ratio"))
    none = ev.limit(1).select(F.lit("v9").alias("venue"), F.lit(0).cast("long").alias("events"))
    bad = qa.failures(qa.depth_summary(_checked(get), _states(get)), venues.select("venue", "events").unionByName(none), frames)
    return bad.groupBy("venue").agg(F.count("*").alias("messages"), F.count_if(F.col("message").startswith("corrupt")).alias("corrupt"), F.count_if(F.col("message").startswith("file contains")).alias("empty"))


@query("mapping_build_record", ("mapping", "overrides"), f"""WITH o AS (SELECT * FROM overrides QUALIFY row_number() OVER (PARTITION BY venue, instrument ORDER BY pos DESC) = 1),
m AS (SELECT m.*, coalesce(o.exclude, false) AS gone, o.venue IS NOT NULL AS met, coalesce(o.base, m.base) AS key FROM mapping m LEFT JOIN o USING (venue, instrument)),
k AS (SELECT key FROM m WHERE NOT gone AND {AT} >= valid_from AND (valid_to IS NULL OR {AT} < valid_to) GROUP BY key HAVING count(DISTINCT venue) = 2)
;
SELECT venue, count(*) FILTER (NOT gone) AS rows, max(valid_from) AS input, (SELECT count(*) FROM k) AS matched, (SELECT count(*) FROM m WHERE met AND NOT gone) AS overridden, (SELECT count(*) FROM m WHERE gone) AS excluded, {AT} AS built_at FROM m GROUP BY venue""")
def _(get):
    """The record of a build, a row for each of its inputs; keys are bases."""
    mapping = get("mapping")
    record = reference.build_record(mapping, get("overrides"), mapping.select("venue", F.col("valid_from").alias("dump_day")), ["v0", "v1"], AT, F.col("base"))
    rows = record.select(F.explode("rows_per_venue").alias("venue", "rows"), "inputs", "matched", "overridden", "excluded", "built_at")
    return rows.select("venue", "rows", F.col("inputs")[F.col("venue")].alias("input"), "matched", "overridden", "excluded", "built_at")


@query("partition_totals", ("fund",), """WITH m AS (SELECT strftime(make_timestamp(funding_time // 1000), '%Y-%m') AS month, count(*) AS n FROM fund GROUP BY 1), c AS (SELECT strftime(d, '%Y-%m') AS month FROM (SELECT unnest(generate_series(TIMESTAMP '1992-01-01', TIMESTAMP '1999-12-01', INTERVAL 1 MONTH)) AS d))
;
SELECT outcome, count(*) AS periods, CAST(sum(n) AS BIGINT) AS rows FROM (SELECT c.month, coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN 'empty' WHEN c.month = (SELECT max(month) FROM m) THEN 'partial' ELSE 'published' END AS outcome FROM c LEFT JOIN m USING (month)) GROUP BY outcome""")
def _(get):
    fund = get("fund").withColumn("month", month_of(F.col("funding_time")))
    last = fund.agg(F.max("month")).first()[0]
    months = fund.sparkSession.range(1).select(F.explode(F.expr("sequence(DATE '1992-01-01', DATE '1999-12-01', INTERVAL 1 MONTH)")).alias("d")).select(F.date_format("d", "yyyy-MM").alias("month"))
    return datasets.outcome_totals(datasets.partition_outcomes(fund, months, last or ""))


@query("month_bounds", ("fund",), """SELECT strftime(make_timestamp(funding_time // 1000), '%Y-%m') AS month, count(*) AS rows, epoch_us(date_trunc('month', make_timestamp(min(funding_time) // 1000))) * 1000 AS start, epoch_us(date_trunc('month', make_timestamp(min(funding_time) // 1000)) + INTERVAL 1 MONTH) * 1000 AS "end",
  strftime(date_trunc('month', make_timestamp(min(funding_time) // 1000)) + INTERVAL 1 MONTH, '%Y-%m') AS following, true AS inside FROM fund GROUP BY 1""")
def _(get):
    rows = get("fund").withColumn("month", month_of(F.col("funding_time"))).withColumn("b", month_bounds(F.col("month")))
    inside = F.min((F.col("funding_time") >= F.col("b.start")) & (F.col("funding_time") < F.col("b.end")))
    return rows.groupBy("month").agg(F.count("*").alias("rows"), F.first("b").alias("b"), inside.alias("inside")).select("month", "rows", "b.start", "b.end", month_next(F.col("month")).alias("following"), "inside")


_HIST = """WITH d AS (SELECT venue, kind, local_ts - venue_ts + CASE WHEN pos % 101 = 0 THEN -2000000000 WHEN pos % 103 = 0 THEN 20000000000 ELSE 0 END AS x FROM ev),
h AS (SELECT venue, kind, CASE WHEN x < -1000000000 THEN -1 WHEN x >= 10000000000 THEN 11000 ELSE (x + 1000000000) // 1000000 END AS bucket, count(*) AS n, min(x) AS low, max(x) AS high FROM d GROUP BY 1, 2, 3)"""


def _histogram(get) -> DataFrame:
    odd = F.when(F.col("pos") % 101 == 0, -2_000_000_000).when(F.col("pos") % 103 == 0, 20_000_000_000).otherwise(0)
    return qa.latency_histogram(get("ev").select("venue", "kind", (F.col("local_ts") - F.col("venue_ts") + odd).alias("delta")))


@query("latency_histogram", ("ev",), _HIST + "\n;\nSELECT venue, kind, CAST(bucket AS BIGINT) AS bucket, n, low, high FROM h")
def _(get):
    return _histogram(get)


@query("latency_percentiles", ("ev",), _HIST + """, c AS (SELECT *, sum(n) OVER (PARTITION BY venue, kind ORDER BY bucket) AS seen, sum(n) OVER (PARTITION BY venue, kind) AS total,
  CASE WHEN bucket < 0 THEN (min(low) OVER (PARTITION BY venue, kind)) // 1000 WHEN bucket = 11000 THEN (max(high) OVER (PARTITION BY venue, kind)) // 1000 ELSE ((bucket + 1) * 1000000 - 1000000000) // 1000 END AS edge FROM h)
;
SELECT venue, kind, CAST(max(total) AS BIGINT) AS n, CAST(min_by(edge, bucket) FILTER (seen >= greatest(1, ceil(0.5::DOUBLE * total))) AS BIGINT) AS p50_us, CAST(min_by(edge, bucket) FILTER (seen >= greatest(1, ceil(0.95::DOUBLE * total))) AS BIGINT) AS p95_us,
       CAST(min_by(edge, bucket) FILTER (seen >= greatest(1, ceil(0.99::DOUBLE * total))) AS BIGINT) AS p99_us, CAST(min(low) // 1000 AS BIGINT) AS min_us, CAST(max(high) // 1000 AS BIGINT) AS max_us FROM c GROUP BY 1, 2""")
def _(get):
    return qa.latency_percentiles(_histogram(get))


@query("health_transitions", ("polls",), """WITH r AS (SELECT *, sum(ok::INT) OVER (PARTITION BY label ORDER BY pos) AS run FROM polls),
f AS (SELECT *, sum((NOT ok)::INT) OVER (PARTITION BY label, run ORDER BY pos) AS fails FROM r), w AS (SELECT *, coalesce(lag(fails) OVER (PARTITION BY label ORDER BY pos), 3) AS was FROM f)
;
SELECT label, pos, CASE WHEN ok THEN 'up' ELSE 'down' END AS state FROM w WHERE (ok AND (run = 1 OR was >= 3)) OR (NOT ok AND fails = 3)""")
def _(get):
    return qa.health_transitions(get("polls"))


@query("session_first_update", ("upd", "downs"), """WITH m AS (SELECT venue, source, instrument, pos, 0 AS down FROM upd UNION ALL SELECT venue, source, NULL, pos, 1 FROM downs),
s AS (SELECT *, CAST(sum(down) OVER (PARTITION BY venue, source ORDER BY pos) AS BIGINT) AS session FROM m)
;
SELECT venue, source, session, instrument, min(pos) AS pos FROM s WHERE down = 0 GROUP BY 1, 2, 3, 4""")
def _(get):
    return qa.session_first_updates(get("upd"), get("downs"))


# ---------------------------------------------------------------- monitors as batch, and what the design adds


@query("heartbeat_rates", ("ev",), "SELECT kind, local_ts // 3600000000000 AS hour, count(*) AS events, round(count(*)::DOUBLE / 3600, 9) AS per_second FROM ev GROUP BY 1, 2")
def _(get):
    hour = ((F.col("local_ts") - F.col("local_ts") % 3_600_000_000_000) / 3_600_000_000_000).cast("long")
    return get("ev").groupBy("kind", hour.alias("hour")).agg(F.count("*").alias("events")).withColumn("per_second", F.round(F.col("events") / 3600, 9))


@query("staleness", ("ev",), "SELECT kind, (SELECT max(local_ts) FROM ev) - max(local_ts) AS age_ns FROM ev GROUP BY kind")
def _(get):
    last = get("ev").groupBy("kind").agg(F.max("local_ts").alias("last"))
    return last.join(F.broadcast(last.agg(F.max("last").alias("now"))), F.lit(True)).select("kind", (F.col("now") - F.col("last")).alias("age_ns"))


@query("stream_dedup", ("fund", "capt"), "SELECT DISTINCT venue, instrument, funding_time FROM (SELECT venue, instrument, funding_time FROM fund UNION ALL SELECT venue, instrument, funding_time FROM capt)")
def _(get):
    keys = ["venue", "instrument", "funding_time"]
    return get("fund").select(*keys).unionByName(get("capt").select(*keys)).dropDuplicates(keys)


@query("manifest", ("ev",), f"SELECT venue, {_sql_day('local_ts')} AS day, count(*) AS rows, min(local_ts) AS min_ts, max(local_ts) AS max_ts, kind AS table_name FROM ev WHERE kind = 'trades' GROUP BY ALL")
def _(get):
    return datasets.manifest(get("ev").where("kind = 'trades'").withColumn("day", day_of(F.col("local_ts"))), "trades")


@query("replay_order", ("ev",), "SELECT venue, instrument, venue_ts, local_ts, pos FROM ev ORDER BY venue_ts, local_ts, pos")
def _(get):
    return datasets.replay_order(get("ev"), "venue_ts").select("venue", "instrument", "venue_ts", "local_ts", "pos")


@query("late_records", ("ev",), f"SELECT venue, {_sql_day('local_ts')} AS day, count(*) AS events, count(*) FILTER ({_sql_day('local_ts')} < 19732) AS late FROM ev GROUP BY 1, 2")
def _(get):
    from tidewright.sources.tables import routed

    marked = routed(get("ev"), "2024-01-10").withColumn("day", day_of(F.col("local_ts")))
    return marked.groupBy("venue", "day").agg(F.count("*").alias("events"), F.count_if("is_late").alias("late"))


@query("skipped_events", ("ev",), """SELECT venue, count(*) FILTER (pos % 9 = 0 AND kind <> 'control') AS no_instrument, count(*) FILTER (kind = 'book_ticker') AS reserved
FROM ev GROUP BY venue""")
def _(get):
    """A ninth of the events without an instrument, and tickers as a reserved kind."""
    log = get("ev").select("venue", F.when(F.col("pos") % 9 != 0, F.col("instrument")).alias("instrument"), F.when(F.col("kind") == "book_ticker", "chain").otherwise(F.col("kind")).alias("kind"))
    return demux.skipped(log)


@query("first_events", ("ev",), "SELECT pos, venue, instrument, kind FROM ev ORDER BY pos LIMIT 5")
def _(get):
    return get("ev").select("pos", "venue", "instrument", "kind").orderBy("pos").limit(5)


@query("mapping_history", ("dump",), """WITH days AS (SELECT dump_day, row_number() OVER (ORDER BY dump_day) AS r, lead(dump_day) OVER (ORDER BY dump_day) AS nx FROM (SELECT DISTINCT dump_day FROM dump)),
l AS (SELECT d.symbol, d.dump_day, r, nx, CASE WHEN lag(r) OVER (PARTITION BY symbol ORDER BY dump_day) = r - 1 THEN 0 ELSE 1 END AS fresh FROM dump d JOIN days USING (dump_day)),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY symbol ORDER BY dump_day) AS island FROM l)
;
SELECT symbol, min(dump_day) AS valid_from, coalesce(max_by(coalesce(nx, -1), dump_day), -1) AS valid_to FROM i GROUP BY symbol, island""")
def _(get):
    listed = get("dump").select("symbol", "dump_day", F.lit(1).alias("listed"))
    return reference.fold_history(listed, ["listed"]).select("symbol", "valid_from", F.coalesce("valid_to", F.lit(-1)).alias("valid_to"))


@query("earliest_onboard_month", ("mapping",), "SELECT venue, strftime(make_timestamp(min(valid_from) // 1000), '%Y-%m') AS first_month FROM mapping GROUP BY venue")
def _(get):
    return get("mapping").groupBy("venue").agg(F.min("valid_from").alias("v")).select("venue", month_of(F.col("v")).alias("first_month"))


@query("converted_vs_checked", ("ev", "trd"), """WITH c AS (SELECT venue, count(*) AS b FROM trd WHERE pos % 31 > 0 GROUP BY venue), q AS (SELECT venue, count(*) AS a FROM ev WHERE kind = 'trades' GROUP BY venue)
;
SELECT venue, a, b FROM q JOIN c USING (venue) WHERE a <> b""")
def _(get):
    checked = get("ev").where("kind = 'trades'").groupBy("venue").agg(F.count("*").alias("n"))
    return datasets.same_counts(checked, get("trd").where("pos % 31 > 0").groupBy("venue").agg(F.count("*").alias("n")), ["venue"])


@query("listing_filter", ("mapping",), f"SELECT venue, instrument FROM mapping WHERE valid_from < {AT} AND segment <> 'MACHINERY'")
def _(get):
    """Symbols that had listed before the period ended."""
    return get("mapping").where((F.col("valid_from").isNull() | (F.col("valid_from") < AT)) & (F.col("segment") != "MACHINERY")).select("venue", "instrument")


@query("session_snapshots_wanted", ("upd", "downs"), """WITH m AS (SELECT venue, source, instrument, pos, 0 AS down FROM upd UNION ALL SELECT venue, source, NULL, pos, 1 FROM downs),
s AS (SELECT *, sum(down) OVER (PARTITION BY venue, source ORDER BY pos) AS session FROM m), f AS (SELECT venue, source, session, instrument FROM s WHERE down = 0 GROUP BY 1, 2, 3, 4)
;
SELECT venue, source, count(*) AS requests FROM f GROUP BY 1, 2""")
def _(get):
    return qa.session_first_updates(get("upd"), get("downs")).groupBy("venue", "source").agg(F.count("*").alias("requests"))
