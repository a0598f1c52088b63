"""Queries on raw messages: normalizers and demultiplexing.

The messages are written by Spark from the events table, in the venues' formats; the
DuckDB twins say what must come out, straight from the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.operators import demux, normalize, reference
from tidewright.plans.bindings import duck, frame

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

_MS = "venue_ts DIV 1000000"
#: JSON of each message, as Spark SQL over the views ev, upd and tick.
MESSAGES = {
    "ticker": f"""SELECT venue, source, local_ts, pos, concat('{{{{"e":"bookTicker","u":', update_id, ',"E":1,"T":', {_MS}, ',"s":"', upper(instrument), '","b":"', price, '","B":"', qty, '","a":"', price + 1, '","A":2}}}}') AS body FROM {{tick}}""",
    "trade": f"""SELECT venue, source, local_ts, pos, concat('{{{{"e":"trade","E":1,"T":', {_MS}, ',"s":"', upper(instrument), '","t":', pos, ',"p":"', price, '","q":"', qty, '","X":"MARKET","m":', pos % 2 = 0, '}}}}') AS body FROM {{ev}} WHERE kind = 'trades' AND pos % 3 > 0""",
    "agg": f"""SELECT venue, source, local_ts, pos, concat('{{{{"e":"aggTrade","E":1,"T":', {_MS}, ',"s":"', upper(instrument), '","a":', pos, ',"p":"', price, '","q":"', qty, '","m":', pos % 2 = 0, '}}}}') AS body FROM {{ev}} WHERE kind = 'trades' AND pos % 3 = 0""",
    "depth": f"""SELECT u.venue, u.source, u.local_ts, u.pos, concat('{{{{"e":"depthUpdate","E":', {_MS} + 1, ',"T":', {_MS}, ',"s":"', upper(u.instrument), '","U":', first_update_id, ',"u":', final_update_id,
      CASE WHEN prev_final_update_id IS NULL THEN '' ELSE concat(',"pu":', prev_final_update_id) END, ',"b":[["', pos % 100, '.5","1"],["', pos % 90, '","0"]],"a":', CASE WHEN pos % 4 = 0 THEN '[]' WHEN pos % 4 = 1 THEN '[["7.25","x"]]' ELSE '[["7.25",3]]' END, '}}}}') AS body FROM {{upd}} u""",
    "mark": f"""SELECT venue, source, local_ts, pos, concat('[{{{{"e":"markPriceUpdate","E":', {_MS}, ',"s":"', upper(instrument), '","p":"', price, '","i":"', qty, '","r":"0.0001","T":', {_MS} + 1000, '}}}}', CASE WHEN pos % 5 = 0 THEN ',{{{{"e":"markPriceUpdate"}}}}' ELSE '' END, ']') AS body FROM {{ev}} WHERE kind = 'book_snapshot'""",
    "force": f"""SELECT venue, source, local_ts, pos, concat('{{{{"e":"forceOrder","E":1,"o":{{{{"s":"', upper(instrument), '","S":"SELL","p":"', price, '","q":"', qty, '","ap":"', price, '","z":"1","X":"FILLED","T":', {_MS}, '}}}}}}}}') AS body FROM {{ev}} WHERE kind = 'control'""",
    "broken": "SELECT venue, source, local_ts, pos, CASE pos % 3 WHEN 0 THEN concat('{{\"result\":null,\"id\":', source, '}}') WHEN 1 THEN concat('{{\"error\":{{\"code\":2}},\"id\":', pos % 5, '}}') ELSE props END AS body FROM {ev}",
}
_VIEWS = {"ticker": "tick", "depth": "upd"}


def messages(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    view = _VIEWS.get(name, "ev")
    return spark.sql(MESSAGES[name], **{view: frame(spark, sf_dir, view)})


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log of all messages."""
    return normalize.socket_events(normalize.union(*(messages(spark, sf_dir, m) for m in MESSAGES)))


def query(name: str, views: tuple[str, ...], sql: str):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name], ORACLE_SQL[name] = f, duck(sql, *views)
        return f

    return add


_ENV = "venue, pos, instrument, venue_ts // 1000000 * 1000000 AS venue_ts, local_ts, CAST(source AS INT) AS source"
_KEEP = ("venue", "pos")


@query("demux_book_ticker", ("tick",), f"SELECT {_ENV}, update_id, price AS bid_price, qty::DOUBLE AS bid_qty, round(price + 1, 6) AS ask_price, 2.0::DOUBLE AS ask_qty FROM tick")
def _(spark, sf_dir):
    return demux.flat(log(spark, sf_dir), "book_ticker", _KEEP).withColumn("ask_price", F.round("ask_price", 6))


@query("demux_trades", ("ev",), f"SELECT {_ENV}, CAST(pos AS VARCHAR) AS trade_id, price, qty::DOUBLE AS qty, CASE WHEN pos % 2 = 0 THEN 'sell' ELSE 'buy' END AS side, CASE WHEN pos % 3 > 0 THEN 'MARKET' END AS kind FROM ev WHERE kind = 'trades'")
def _(spark, sf_dir):
    return demux.trades(log(spark, sf_dir), _KEEP)


@query("demux_book_update", ("upd",), f"""
SELECT {_ENV}, first_update_id, final_update_id, coalesce(prev_final_update_id, -1) AS prev_final_update_id, (venue_ts // 1000000 + 1) * 1000000 AS event_time, l.s AS side, l.p AS price, l.q AS qty FROM (
  SELECT *, unnest([{{'s': 'bid', 'p': (pos % 100 + 0.5)::DOUBLE, 'q': 1.0::DOUBLE}}, {{'s': 'bid', 'p': (pos % 90)::DOUBLE, 'q': 0.0::DOUBLE}}, {{'s': CASE WHEN pos % 4 > 0 THEN 'ask' END, 'p': 7.25::DOUBLE, 'q': 3.0::DOUBLE}}]) AS l FROM upd WHERE pos % 4 <> 1 AND first_update_id >= 0) WHERE l.s IS NOT NULL""")
def _(spark, sf_dir):
    return demux.book_update(log(spark, sf_dir), _KEEP).fillna(-1, ["prev_final_update_id"])


@query("demux_mark_price", ("ev",), f"SELECT {_ENV}, price FROM ev WHERE kind = 'book_snapshot' AND pos % 5 > 0")
def _(spark, sf_dir):
    return demux.price(log(spark, sf_dir), "mark_price", _KEEP)


@query("demux_index_price", ("ev",), f"SELECT {_ENV}, qty::DOUBLE AS price FROM ev WHERE kind = 'book_snapshot' AND pos % 5 > 0")
def _(spark, sf_dir):
    return demux.price(log(spark, sf_dir), "index_price", _KEEP)


@query("demux_funding_rate", ("ev",), f"SELECT {_ENV}, 0.0001::DOUBLE AS rate, (venue_ts // 1000000 + 1000) * 1000000 AS next_funding_time, 28800000000000 AS interval_ns FROM ev WHERE kind = 'book_snapshot' AND pos % 5 > 0")
def _(spark, sf_dir):
    return demux.flat(log(spark, sf_dir), "funding_prediction", _KEEP).select(*_KEEP, *demux.ENVELOPE, "rate", "next_funding_time", "interval_ns")


@query("demux_liquidation", ("ev",), f"SELECT {_ENV}, 'sell' AS side, price, qty::DOUBLE AS qty, 1.0::DOUBLE AS filled_qty, price AS avg_price, 'FILLED' AS order_status FROM ev WHERE kind = 'control'")
def _(spark, sf_dir):
    return demux.flat(log(spark, sf_dir), "liquidation", _KEEP)


@query("normalize_frames", ("ev",), "SELECT venue, pos, pos % 5 > 0 AS is_data FROM ev WHERE kind = 'book_snapshot'")
def _(spark, sf_dir):
    return normalize.frames(messages(spark, sf_dir, "mark")).select("venue", "pos", "is_data")


@query("normalize_replies", ("ev",), """SELECT venue, source, pos, CASE pos % 3 WHEN 0 THEN CASE WHEN source = 1 THEN 'ack_ok' ELSE 'ignored' END WHEN 1 THEN CASE WHEN pos % 5 = 1 THEN 'ack_error' ELSE 'venue_error' END ELSE 'ignored' END AS action FROM ev""")
def _(spark, sf_dir):
    other = normalize.frames(messages(spark, sf_dir, "broken")).where("NOT is_data")
    awaited = other.select("venue", "source").distinct().withColumn("awaited_id", F.lit(1).cast("long"))
    return normalize.replies(other, awaited)


@query("log_counts", ("ev", "upd", "tick"), """SELECT venue, kind, count(*) AS events FROM (
  SELECT venue, 'book_ticker' AS kind FROM tick UNION ALL SELECT venue, 'book_update' FROM upd WHERE pos % 4 <> 1 AND first_update_id >= 0 UNION ALL SELECT venue, 'trades' FROM ev WHERE kind = 'trades' UNION ALL SELECT venue, 'liquidation' FROM ev WHERE kind = 'control'
  UNION ALL SELECT venue, unnest(['mark_price', 'index_price', 'funding_prediction']) FROM ev WHERE kind = 'book_snapshot' AND pos % 5 > 0) GROUP BY 1, 2""")
def _(spark, sf_dir):
    return log(spark, sf_dir).groupBy("venue", "kind").agg(F.count("*").alias("events"))


#: A message of each form, right or with one fault: text, then whether it is data and how many events it gives.
_GOOD_TRADE = '{"e":"trade","T":5,"s":"I","t":7,"p":"1","q":2.5,"X":"M","m":true}'
_MARK = '{"e":"markPriceUpdate","E":4,"s":"I","p":"1","i":"2","r":"1e-4","T":9}'
_FORCE = '{"e":"forceOrder","o":{"s":"I","S":"BUY","p":"1","q":"2","T":9}}'
_DEPTH = '{"e":"depthUpdate","E":2,"T":3,"s":"I","U":1,"u":2,"b":[["1","2"]],"a":[]}'
_TICKER = '{"e":"bookTicker","u":1,"T":3,"s":"I","b":"1","B":"2","a":"3","A":"4"}'
FORMS = [
    (_GOOD_TRADE, True, 1), (_GOOD_TRADE.replace('"1"', '"x"'), False, 0), (_GOOD_TRADE.replace("true", '"zz"'), False, 0), (_GOOD_TRADE.replace('"T":5', '"T":-5'), False, 0),
    (_GOOD_TRADE.replace('"T":5', '"T":"zz"'), False, 0), (_GOOD_TRADE.replace('"T":5', '"T":5.5'), False, 0), (_GOOD_TRADE.replace(',"X":"M"', ""), True, 1), (_GOOD_TRADE.replace('"q":2.5,', ""), False, 0),
    ('{"e":"surprise","T":1,"s":"I"}', False, 0), (f'[{_GOOD_TRADE},{{"e":"trade","T":5}}]', False, 0), (f"[{_GOOD_TRADE},{_MARK}]", True, 4), ("[]", True, 0), ("no json", False, 0),
    (_MARK, True, 3), (_MARK.replace('"i":"2",', ""), False, 0), (_MARK.replace('"r":"1e-4",', ""), False, 0), (_MARK.replace(',"T":9', ""), False, 0),
    (_FORCE, True, 1), (_FORCE.replace('"p":"1",', ""), False, 0), (_FORCE.replace('"q":"2"', '"q":"2","z":"none"'), False, 0), (_FORCE.replace('"q":"2"', '"q":"2","z":null,"ap":"3"'), True, 1),
    (_DEPTH, True, 1), (_DEPTH.replace('"2"]', '"x"]'), False, 0), (_DEPTH.replace('"2"]', '"2","3"]'), False, 0), (_DEPTH.replace('"U":1', '"U":1,"pu":"a"'), False, 0), (_DEPTH.replace('"U":1', '"U":1,"pu":0'), True, 1), (_DEPTH.replace(',"a":[]', ""), False, 0),
    (_TICKER, True, 1), (_TICKER.replace('"B":"2",', ""), False, 0), (_TICKER.replace('"T":3,', ""), False, 0), (_TICKER.replace('"u":1', '"u":"one"'), False, 0),
]
_FORM_SQL = "CASE pos % {} " + " ".join(f"WHEN {i} THEN {{}}" for i in range(len(FORMS))) + " END"


def _by_form(values: list[str]) -> str:
    return _FORM_SQL.format(len(FORMS), *values)


@query("normalize_malformed", ("ev",), f"SELECT venue, pos, {_by_form([str(f[1]) for f in FORMS])} AS is_data, CAST({_by_form([str(f[2]) for f in FORMS])} AS BIGINT) AS events FROM ev")
def _(spark, sf_dir):
    """Messages of every form, right ones and each fault that rejects one, by turns."""
    body = F.element_at(F.array(*(F.lit(f[0]) for f in FORMS)), (F.col("pos") % len(FORMS) + 1).cast("int"))
    raw = frame(spark, sf_dir, "ev").select("venue", "source", "local_ts", "pos", body.alias("body"))
    events = normalize.socket_events(raw).groupBy("pos").agg(F.count("*").alias("events"))
    single = normalize.frames(raw).select("venue", "pos", "is_data").distinct()
    return single.join(events, "pos", "left").fillna(0, ["events"])


@query("demux_control", ("control",), """SELECT venue, pos, local_ts, CAST(source AS INT) AS source, control_kind AS kind, CASE control_kind WHEN 'conn_up' THEN concat('{"ConnUp":{"label":"c', source, '"}}')
  WHEN 'conn_down' THEN concat('{"ConnDown":{"label":"c', source, '","reason":"lost"}}') ELSE concat('{"Gap":{"reason":"lost","dropped":', dropped, '}}') END AS detail FROM control""")
def _(spark, sf_dir):
    rows = frame(spark, sf_dir, "control").withColumns({"label": F.concat(F.lit("c"), F.col("source").cast("string")), "reason": F.lit("lost"), "instrument": F.lit(None).cast("string"), "venue_ts": F.lit(None).cast("long")})
    log = normalize.tagged(rows, "control", F.col("control_kind"), {"conn_up": ["label"], "conn_down": ["label", "reason"], "gap": ["reason", "dropped"]})
    return demux.flat(log, "control", _KEEP).drop("instrument", "venue_ts")


@query("demux_reference", ("dump",), """WITH days AS (SELECT dump_day, lag(dump_day) OVER (ORDER BY dump_day) AS b, lead(dump_day) OVER (ORDER BY dump_day) AS a FROM (SELECT DISTINCT dump_day FROM dump)),
n AS (SELECT d.*, days.b FROM dump d JOIN days USING (dump_day) WHERE days.b IS NOT NULL),
x AS (SELECT n.symbol, n.dump_day, n.status, n.priority, CASE WHEN o.symbol IS NULL THEN 'instrument_added' WHEN n.status IS DISTINCT FROM o.status OR n.priority IS DISTINCT FROM o.priority THEN 'instrument_changed' END AS kind
  FROM n LEFT JOIN dump o ON o.symbol = n.symbol AND o.dump_day = n.b)
;
SELECT symbol AS instrument, dump_day AS local_ts, kind, concat('{"', CASE kind WHEN 'instrument_added' THEN 'InstrumentAdded' ELSE 'InstrumentChanged' END, '":{"instrument":{"symbol":"', symbol, '","status":"', status, '","priority":', coalesce('"' || priority || '"', 'null'), '}}}') AS detail
FROM x WHERE kind IS NOT NULL
UNION ALL SELECT d.symbol, days.a, 'instrument_delisted', concat('{"InstrumentDelisted":{"instrument_id":{"value":"', d.symbol, '"}}}') FROM dump d JOIN days USING (dump_day)
WHERE days.a IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dump n WHERE n.symbol = d.symbol AND n.dump_day = days.a)
UNION ALL SELECT symbol, dump_day, 'market_resolved', concat('{"MarketResolved":{"outcome":"', status, '"}}') FROM dump WHERE priority IS NULL""")
def _(spark, sf_dir):
    """What each dump adds, changes and no longer lists, and a resolution wherever there is no priority."""
    dump = frame(spark, sf_dir, "dump")
    found = reference.consecutive_changes(dump, ["status", "priority"]).where("change <> 'baseline'").withColumn("change", F.concat(F.lit("instrument_"), "change"))
    resolved = dump.where("priority IS NULL").select("symbol", "dump_day", F.lit("market_resolved").alias("change"))
    rows = found.unionByName(resolved).join(dump.select("symbol", "dump_day", "status", "priority"), ["symbol", "dump_day"], "left")
    rows = rows.select(
        F.lit("v").alias("venue"), F.col("symbol").alias("instrument_"), F.lit(None).cast("long").alias("venue_ts"), F.col("dump_day").alias("local_ts"), F.lit(0).alias("source"), F.lit(0).alias("pos"), "change",
        F.struct("symbol", "status", "priority").alias("listed"), F.struct(F.col("symbol").alias("value")).alias("instrument_id"), F.col("status").alias("outcome"),
    )
    fields = {"instrument_added": ["listed AS instrument"], "instrument_changed": ["listed AS instrument"], "instrument_delisted": ["instrument_id"], "market_resolved": ["outcome"]}
    log = normalize.tagged(rows.withColumn("instrument", F.col("instrument_")), "reference", F.col("change"), fields)
    return demux.flat(log, "reference").select("instrument", "local_ts", "kind", "detail")


@query("normalize_paged_instruments", ("mapping",), """SELECT concat(instrument, venue) AS symbol, CASE WHEN c % 5 = 0 THEN 'future' ELSE 'perp' END AS class, base, 'USDT' AS quote, CASE WHEN c % 9 > 0 THEN valid_from // 1000000 * 1000000 ELSE -1 END AS onboard_ts, (60 + c % 3) * 60000000000 AS interval_ns
FROM (SELECT *, CAST(substr(instrument, 2) AS BIGINT) AS c FROM mapping) WHERE c // 100 % 4 <> 3""")
def _(spark, sf_dir):
    """Pages of a hundred instruments of a venue, four to an answer, the last of which failed; a start that is no number is none."""
    return normalize.paged_instruments(_rows(spark, sf_dir, "mapping", _PAGED_INSTRUMENTS)).select("symbol", "class", "base", "quote", F.coalesce("onboard_ts", F.lit(-1)).alias("onboard_ts"), "interval_ns")


@query("failed_pages", ("mapping",), """SELECT venue, page FROM (SELECT venue, CAST(substr(instrument, 2) AS BIGINT) // 100 AS page FROM mapping) WHERE page % 4 <> 0 GROUP BY 1, 2""")
def _(spark, sf_dir):
    """Of four pages one succeeded, one failed, one has no code and one is no JSON."""
    return normalize.failed_pages(_rows(spark, sf_dir, "mapping", _FAILED)).select("venue", "page")


# ---------------------------------------------------------------- REST answers


def _rows(spark: SparkSession, sf_dir: str, view: str, sql: str) -> DataFrame:
    return spark.sql(sql, **{view: frame(spark, sf_dir, view)})


_PAGED_INSTRUMENTS = """SELECT venue, concat('[', array_join(collect_list(concat('{{"retCode":', CASE WHEN page % 4 = 3 THEN 10001 ELSE 0 END, ',"result":{{"list":[', list, ']}}}}')), ','), ']') AS body FROM (
  SELECT venue, c DIV 100 AS page, array_join(collect_list(to_json(named_struct('symbol', upper(concat(instrument, venue)), 'contractType', CASE WHEN c % 5 = 0 THEN 'LinearFutures' ELSE 'LinearPerpetual' END, 'status', 'Trading', 'baseCoin', base, 'quoteCoin', 'USDT', 'settleCoin', 'USDT',
    'launchTime', CASE WHEN c % 9 > 0 THEN string(valid_from DIV 1000000) ELSE 'soon' END, 'fundingInterval', 60 + c % 3))), ',') AS list FROM (SELECT *, CAST(substr(instrument, 2) AS BIGINT) AS c FROM {mapping}) GROUP BY venue, c DIV 100) GROUP BY venue, page DIV 4"""
_FAILED = """SELECT venue, page, CASE page % 4 WHEN 0 THEN '{{"retCode":0,"result":{{}}}}' WHEN 1 THEN '{{"retCode":10006}}' WHEN 2 THEN '{{"result":{{}}}}' ELSE 'down' END AS body FROM (SELECT DISTINCT venue, CAST(substr(instrument, 2) AS BIGINT) DIV 100 AS page FROM {mapping})"""
_PREMIUM = """SELECT venue, 0 AS source, max(local_ts) AS local_ts, min(pos) AS pos, concat('[', array_join(collect_list(to_json(named_struct('symbol', upper(instrument), 'markPrice', string(price), 'indexPrice', string(qty),
 'lastFundingRate', '0.0003', 'nextFundingTime', CASE WHEN pos % 2 = 0 THEN 0 ELSE venue_ts DIV 1000000 END, 'time', venue_ts DIV 1000000))), ','), ']') AS body FROM {ev} WHERE kind = 'book_ticker' GROUP BY venue, pos DIV 500"""


@query("normalize_premium_index", ("ev",), """SELECT venue, x.k AS kind, instrument, count(*) AS events, round(sum(x.v), 4) AS value FROM (
  SELECT venue, instrument, unnest([{'k': 'mark_price', 'v': price}, {'k': 'index_price', 'v': qty::DOUBLE}, {'k': CASE WHEN pos % 2 > 0 THEN 'funding_prediction' END, 'v': 0.0003::DOUBLE}]) AS x FROM ev WHERE kind = 'book_ticker') WHERE x.k IS NOT NULL GROUP BY 1, 2, 3""")
def _(spark, sf_dir):
    out = normalize.premium_index(_rows(spark, sf_dir, "ev", _PREMIUM))
    value = F.coalesce("mark_price", "index_price", "funding_prediction.rate").cast("double")
    return out.groupBy("venue", "kind", "instrument").agg(F.count("*").alias("events"), F.round(F.sum(value), 4).alias("value"))


_FUNDING = """SELECT venue, 0 AS source, max(funding_time) AS local_ts, min(funding_time) AS pos, concat('[', array_join(collect_list(to_json(named_struct('symbol', upper(instrument), 'fundingTime', funding_time DIV 1000000, 'fundingRate', string(rate)))), ','), ']') AS body
FROM {fund} GROUP BY venue, funding_time DIV 864000000000000"""


@query("normalize_funding_rate", ("fund", "mapping"), """SELECT f.venue, f.instrument, f.funding_time, round(rate, 12) AS rate, CASE WHEN CAST(substr(f.instrument, 2) AS BIGINT) % 4 = 0 THEN 4 ELSE 8 END * 3600000000000 AS interval_ns FROM fund f""")
def _(spark, sf_dir):
    raw = _rows(spark, sf_dir, "fund", _FUNDING)
    info_sql = "SELECT concat('[', array_join(collect_list(to_json(named_struct('symbol', upper(instrument), 'fundingIntervalHours', 4))), ','), ']') AS body FROM (SELECT DISTINCT instrument FROM {mapping} WHERE CAST(substr(instrument, 2) AS BIGINT) % 4 = 0) GROUP BY CAST(substr(instrument, 2) AS BIGINT) DIV 500"
    info = normalize.funding_info(_rows(spark, sf_dir, "mapping", info_sql))
    out = normalize.funding_rate(raw.unionByName(raw), info)
    return out.select("venue", "instrument", F.col("funding_realized.funding_time").alias("funding_time"), F.round(F.col("funding_realized.rate").cast("double"), 12).alias("rate"), F.col("funding_realized.interval_ns").alias("interval_ns"))


_PAGES = """SELECT concat('{{"retCode":', min(CASE WHEN d % 11 = 0 THEN 10001 ELSE 0 END), ',"result":{{"list":[', array_join(collect_list(to_json(named_struct('symbol', upper(concat(instrument, venue)), 'fundingRate', string(rate), 'fundingRateTimestamp', CASE WHEN h % 37 = 0 THEN 'bad' ELSE string(funding_time DIV 1000000) END))), ','), ']}}}}') AS body
FROM (SELECT *, funding_time DIV 86400000000000 AS d, CAST(substr(instrument, 2) AS BIGINT) AS h FROM {fund}) GROUP BY venue, d"""


@query("normalize_paged_funding", ("fund",), """SELECT concat(instrument, venue) AS instrument, funding_time, round(rate, 12) AS rate FROM fund WHERE (funding_time // 86400000000000) % 11 <> 0 AND CAST(substr(instrument, 2) AS BIGINT) % 37 <> 0 AND funding_time >= 800000000000000000 AND funding_time < 900000000000000000""")
def _(spark, sf_dir):
    out = normalize.paged_funding(_rows(spark, sf_dir, "fund", _PAGES), 800_000_000_000_000_000, 900_000_000_000_000_000)
    return out.select("instrument", "funding_time", F.round("rate", 12).alias("rate"))


_DUMP = """SELECT concat('{{"symbols":[', array_join(collect_list(to_json(named_struct('symbol', upper(concat(instrument, venue)), 'contractType', CASE WHEN c % 5 = 0 THEN 'CURRENT_QUARTER' ELSE 'PERPETUAL' END, 'baseAsset', base, 'quoteAsset', 'USDT', 'marginAsset', CASE WHEN c % 3 = 0 THEN base WHEN c % 3 = 1 THEN 'USDT' END, 'status', CASE WHEN c % 7 = 0 THEN 'SETTLING' WHEN c % 7 < 3 THEN 'DELIVERED' ELSE 'CLOSE' END,
 'onboardDate', CASE WHEN c % 9 > 0 THEN valid_from DIV 1000000 END, 'deliveryDate', 4133404800000, 'filters', array(named_struct('filterType', 'PRICE_FILTER', 'tickSize', '0.01', 'stepSize', NULL), named_struct('filterType', 'LOT_SIZE', 'tickSize', NULL, 'stepSize', string(c)))))), ','), ']}}') AS body
FROM (SELECT *, CAST(substr(instrument, 2) AS BIGINT) AS c FROM {mapping}) GROUP BY venue, c DIV 500"""


@query("normalize_instruments", ("mapping",), """SELECT concat(instrument, venue) AS symbol, CASE WHEN c % 7 = 0 THEN 'halted' ELSE 'delisted' END AS lifecycle, CASE WHEN c % 5 = 0 THEN 'future' ELSE 'perp' END AS class, CASE WHEN c % 3 = 0 THEN 'inverse' WHEN c % 3 = 1 THEN 'linear' END AS linearity,
  0.01::DOUBLE AS tick_size, c::DOUBLE AS lot_size, CASE WHEN c % 5 = 0 THEN -1 WHEN c % 2 = 0 THEN 4 * 3600000000000 ELSE 8 * 3600000000000 END AS interval_ns FROM (SELECT *, CAST(substr(instrument, 2) AS BIGINT) AS c FROM mapping)""")
def _(spark, sf_dir):
    raw = _rows(spark, sf_dir, "mapping", _DUMP)
    info = frame(spark, sf_dir, "mapping").where("CAST(substr(instrument, 2) AS BIGINT) % 2 = 0").select(F.concat("instrument", "venue").alias("symbol"), F.lit(4 * 3_600_000_000_000).alias("interval_ns"))
    return normalize.instruments(raw, info).select("symbol", "lifecycle", "class", "linearity", "tick_size", "lot_size", F.coalesce("interval_ns", F.lit(-1)).alias("interval_ns"))


@query("normalize_mapping_rows", ("mapping",), """SELECT 'binance' AS venue, concat(instrument, venue) AS instrument, base, 'USDT' AS quote, 'perp' AS class, CASE WHEN c % 3 = 0 THEN base ELSE 'USDT' END AS settle, CASE WHEN c % 9 > 0 THEN valid_from // 1000000 * 1000000 ELSE 850000000000000000 END AS valid_from, 'dump' AS origin
  FROM (SELECT *, CAST(substr(instrument, 2) AS BIGINT) AS c FROM mapping) WHERE c % 5 <> 0""")
def _(spark, sf_dir):
    return normalize.mapping_rows(normalize.instruments(_rows(spark, sf_dir, "mapping", _DUMP)), "binance", 850_000_000_000_000_000).drop("valid_to")


# The answers below are pages of a bounded span, so none grows with the table.
_KLINES = """SELECT instrument AS symbol, concat('[', array_join(collect_list(concat('[', h * 3600000, ',"', o, '","', hi, '","', lo, '","', c, '","', v, '",', h * 3600000 + 3599999, ',"1.5",', n, ',"2","3","0"]')), ','), ']') AS body FROM (
 SELECT instrument, local_ts DIV 3600000000000 AS h, min_by(price, pos) AS o, max(price) AS hi, min(price) AS lo, max_by(price, pos) AS c, count(*) AS v, count(*) AS n FROM {ev} GROUP BY 1, 2) GROUP BY instrument, h DIV 500"""


@query("normalize_klines", ("ev",), """SELECT instrument, h * 3600000000000 AS open_time, (h * 3600000 + 3599999) * 1000000 AS close_time, o AS open, hi AS high, lo AS low, c AS close, n::DOUBLE AS volume, n AS trades FROM (
 SELECT instrument, local_ts // 3600000000000 AS h, min_by(price, pos) AS o, max(price) AS hi, min(price) AS lo, max_by(price, pos) AS c, count(*) AS n FROM ev GROUP BY 1, 2)""")
def _(spark, sf_dir):
    return normalize.klines(_rows(spark, sf_dir, "ev", _KLINES)).select("instrument", "open_time", "close_time", "open", "high", "low", "close", "volume", "trades")


_OI = """SELECT concat('[', array_join(collect_list(to_json(named_struct('symbol', upper(instrument), 'sumOpenInterest', string(price), 'sumOpenInterestValue', string(qty), 'timestamp', local_ts DIV 1000000))), ','), ']') AS body FROM {ev} GROUP BY instrument, local_ts DIV 3600000000000"""


@query("normalize_oi_history", ("ev",), "SELECT instrument, local_ts // 1000000 * 1000000 AS venue_ts, price AS open_interest, qty::DOUBLE AS open_interest_value FROM ev WHERE local_ts // 1000000 * 1000000 >= 1700000000000000000 OR local_ts // 1000000 * 1000000 < 1700000000000000000")
def _(spark, sf_dir):
    return normalize.oi_history(_rows(spark, sf_dir, "ev", _OI), 0, 9_000_000_000_000_000_000)


_INTEREST = """SELECT venue, 0 AS source, local_ts, pos, to_json(named_struct('symbol', upper(instrument), 'openInterest', CASE WHEN pos % 13 = 0 THEN 'bad' ELSE string(qty) END, 'time', local_ts DIV 1000000)) AS body FROM {ev}"""


@query("demux_open_interest", ("ev",), "SELECT venue, pos, instrument, local_ts // 1000000 * 1000000 AS venue_ts, local_ts, 0 AS source, CASE WHEN pos % 13 > 0 THEN qty::DOUBLE END AS open_interest FROM ev")
def _(spark, sf_dir):
    return demux.flat(normalize.open_interest(_rows(spark, sf_dir, "ev", _INTEREST)), "open_interest", _KEEP).drop("open_interest_value")


@query("demux_funding_realized", ("fund",), "SELECT venue, instrument, funding_time AS venue_ts, 0 AS source, round(rate, 12) AS rate, funding_time, 8 * 3600000000000 AS interval_ns FROM fund")
def _(spark, sf_dir):
    none = spark.createDataFrame([], "symbol string, interval_ns long")
    out = demux.flat(normalize.funding_rate(_rows(spark, sf_dir, "fund", _FUNDING), none), "funding_realized", ("venue",))
    return out.drop("local_ts").withColumn("rate", F.round("rate", 12))


@query("normalize_perpetuals", ("mapping",), """SELECT concat(instrument, venue) AS symbol, CASE WHEN c % 9 > 0 THEN valid_from // 1000000 * 1000000 ELSE -1 END AS onboard_ts, CASE WHEN c % 2 = 0 THEN 4 * 3600000000000 ELSE -1 END AS interval_ns
  FROM (SELECT *, CAST(substr(instrument, 2) AS BIGINT) AS c FROM mapping) WHERE c % 5 <> 0""")
def _(spark, sf_dir):
    info = frame(spark, sf_dir, "mapping").where("CAST(substr(instrument, 2) AS BIGINT) % 2 = 0").select(F.concat("instrument", "venue").alias("symbol"), F.lit(4 * 3_600_000_000_000).alias("interval_ns"))
    return normalize.perpetuals(_rows(spark, sf_dir, "mapping", _DUMP), info).fillna(-1)


_DATED = """SELECT dump_day, concat('{{"symbols":[', array_join(collect_list(to_json(named_struct('symbol', upper(symbol), 'contractType', CASE WHEN c % 5 = 0 THEN 'CURRENT_QUARTER' ELSE 'PERPETUAL' END, 'baseAsset', 'A', 'quoteAsset', 'USDT', 'marginAsset', 'USDT',
 'status', CASE status WHEN 'O' THEN 'DELIVERED' WHEN 'F' THEN 'CLOSE' ELSE 'SETTLING' END))), ','), ']}}') AS body FROM (SELECT *, CAST(substr(symbol, 2) AS BIGINT) AS c FROM {dump}) GROUP BY dump_day"""
_DATED_INTERVALS = """SELECT dump_day, concat('[', array_join(collect_list(to_json(named_struct('symbol', upper(symbol), 'fundingIntervalHours', CASE status WHEN 'O' THEN 1 WHEN 'F' THEN 4 ELSE 2 END))), ','), ']') AS body
 FROM {dump} WHERE dump_day DIV 86400000000000 % 3 = 0 AND priority IS NOT NULL GROUP BY dump_day"""


@query("scd_from_dumps", ("dump",), """WITH lists AS (SELECT symbol, dump_day, CASE status WHEN 'O' THEN 1 WHEN 'F' THEN 4 ELSE 2 END AS hours FROM dump WHERE dump_day // 86400000000000 % 3 = 0 AND priority IS NOT NULL),
listed AS (SELECT d.symbol, d.dump_day, CASE WHEN d.status IN ('O', 'F') THEN 'delisted' ELSE 'halted' END AS lifecycle, CAST(substr(d.symbol, 2) AS BIGINT) % 5 = 0 AS dated,
  (SELECT max(x.dump_day) FROM lists x WHERE x.dump_day <= d.dump_day) AS used FROM dump d),
snaps AS (SELECT l.symbol, l.dump_day, l.lifecycle, CASE WHEN NOT dated THEN coalesce(h.hours, 8) * 3600000000000 END AS interval_ns FROM listed l LEFT JOIN lists h ON h.symbol = l.symbol AND h.dump_day = l.used),
days AS (SELECT dump_day, row_number() OVER (ORDER BY dump_day) AS r, lead(dump_day) OVER (ORDER BY dump_day) AS nx FROM (SELECT DISTINCT dump_day FROM dump)),
marked AS (SELECT s.*, r, nx, CASE WHEN lag(r) OVER w = r - 1 AND lag(lifecycle) OVER w = lifecycle AND lag(interval_ns) OVER w IS NOT DISTINCT FROM interval_ns THEN 0 ELSE 1 END AS fresh FROM snaps s JOIN days USING (dump_day) WINDOW w AS (PARTITION BY symbol ORDER BY dump_day)),
spans AS (SELECT *, sum(fresh) OVER (PARTITION BY symbol ORDER BY dump_day) AS span FROM marked)
;
SELECT symbol, min(lifecycle) AS lifecycle, coalesce(min(interval_ns), -1) AS interval_ns, min(dump_day) AS valid_from, coalesce(max_by(coalesce(nx, -1), dump_day), -1) AS valid_to FROM spans GROUP BY symbol, span""")
def _(spark, sf_dir):
    dumps = _rows(spark, sf_dir, "dump", _DATED)
    snaps = normalize.day_snapshots(dumps, _rows(spark, sf_dir, "dump", _DATED_INTERVALS))
    return reference.history(snaps.select("symbol", "dump_day", "lifecycle", "interval_ns"), ["lifecycle", "interval_ns"], days=normalize.dump_days(dumps)).fillna(-1, ["interval_ns", "valid_to"])


_SNAPSHOT = """SELECT venue, 5 AS source, local_ts, pos, upper(instrument) AS symbol, concat('{{"lastUpdateId":', last_update_id, ',"T":', local_ts DIV 1000000, ',"bids":[["', pos % 50, '","1"],["1.5","2"]],"asks":[["9","', pos % 7, '"]]}}') AS body FROM {snap}"""


@query("demux_book_snapshot", ("snap",), """SELECT venue, pos, instrument, local_ts // 1000000 * 1000000 AS venue_ts, 0 AS source, CAST(last_update_id AS BIGINT) AS last_update_id, l.s AS side, CAST(l.i AS INT) AS level_idx, l.p AS price, l.q AS qty FROM (
  SELECT *, unnest([{'s': 'bid', 'i': 0, 'p': (pos % 50)::DOUBLE, 'q': 1.0::DOUBLE}, {'s': 'bid', 'i': 1, 'p': 1.5::DOUBLE, 'q': 2.0::DOUBLE}, {'s': 'ask', 'i': 0, 'p': 9.0::DOUBLE, 'q': (pos % 7)::DOUBLE}]) AS l FROM snap)""")
def _(spark, sf_dir):
    return demux.book_snapshot(normalize.depth_snapshot(_rows(spark, sf_dir, "snap", _SNAPSHOT)), _KEEP).drop("local_ts")
