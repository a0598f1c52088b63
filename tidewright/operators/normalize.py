"""Normalizers: raw venue messages to events of one envelope.

Input rows have venue, source, local_ts, pos, body. Output rows have the envelope,
``kind``, and the payload in the column of that name (see ``schemas.EVENT_LOG``).
Unknown fields are ignored, missing optional ones are null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright import schemas as S
from tidewright.functions.market import DEFAULT_FUNDING_INTERVAL, NS_HOUR, aggressor, contract_class, exact, lifecycle, linearity, ns_from_ms, picked, within
from tidewright.operators.reference import carried_forward


def _event(df: DataFrame, kind: str, instrument: Column, venue_ts: Column, payload: Column) -> DataFrame:
    return df.select(
        "venue", F.lower(instrument).alias("instrument"), venue_ts.cast("long").alias("venue_ts"), "local_ts", F.col("source").cast("int").alias("source"), "pos",
        F.lit(kind).alias("kind"), payload.cast(S.PAYLOADS[kind]).alias(kind),
    )


def _levels(pairs: Column) -> Column:
    return F.transform(pairs, lambda x: F.struct(exact(x[0]).alias("price"), exact(x[1]).alias("qty")))


#: A decimal number as text.
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _read(text: Column) -> Column:
    """A message's fields as a struct with columns f0, f1, ... and its order's as o0, o1, ...; one parse."""
    inner = ", ".join(f"`{n}`: {t}" for n, t in S.ORDER.items())
    named = ", ".join(f"`{n}` {t}" for n, t in S.MESSAGE.items())
    places = ", ".join(f"f{i}: {t}" for i, t in enumerate(S.MESSAGE.values()))
    within_order = ", ".join(f"o{i}: {t}" for i, t in enumerate(S.ORDER.values()))
    return F.from_json(text, f"{named}, `o` STRUCT<{inner}>").cast(f"STRUCT<{places}, o: STRUCT<{within_order}>>")


def _at(m: Column, path: str) -> Column:
    """A field of a message that was read, by the venue's name."""
    if path.startswith("o."):
        return m["o"][f"o{list(S.ORDER).index(path[2:])}"]
    return m[f"f{list(S.MESSAGE).index(path)}"]


def _decimal(text: Column) -> Column:
    return F.when(text.rlike(DECIMAL), exact(text))


def _complete(x: Column) -> Column:
    """Whether a message (struct of m, bids and asks) is of a known type and has what that type must have."""
    m = x["m"]
    pair = lambda level: F.coalesce((F.size(level) == 2) & _decimal(level[0]).isNotNull() & _decimal(level[1]).isNotNull(), F.lit(False))
    whole = lambda c: F.coalesce(c.try_cast("long") >= 0, F.lit(False))
    tests = {
        "text": lambda c: c.isNotNull(), "flag": lambda c: c.isNotNull(), "whole": whole, "decimal": lambda c: _decimal(c).isNotNull(),
        "maybe_whole": lambda c: c.isNull() | whole(c), "maybe_decimal": lambda c: c.isNull() | _decimal(c).isNotNull(),
    }
    out = F.lit(False)
    for kind, rules in S.RULES.items():
        has = F.lit(True)
        for rule, paths in rules.items():
            for path in paths.split():
                if rule == "levels":
                    side = x["bids" if path == "b" else "asks"]
                    has = has & side.isNotNull() & F.forall(side, pair)
                else:
                    has = has & tests[rule](_at(m, path))
        out = F.when(_at(m, "e") == kind, has).otherwise(out)
    return F.coalesce(out, F.lit(False))


def _framed(raw: DataFrame) -> DataFrame:
    """venue, source, local_ts, pos, parts (the texts of a frame's messages), read (as structs of m, bids and asks) and is_data."""
    array = F.col("body").startswith("[")
    parts = F.when(array, F.from_json("body", "array<string>")).otherwise(F.array("body"))
    side = lambda m, path: F.when(_at(m, "e") == "depthUpdate", F.from_json(_at(m, path), S.PAIRS))
    held = raw.select("venue", "source", "local_ts", "pos", "body", parts.alias("parts"))
    # each step is a projection of its own, so what is read is not read again for every use
    held = held.withColumn("m", F.transform("parts", _read))
    held = held.withColumn("read", F.transform("m", lambda m: F.struct(m.alias("m"), side(m, "b").alias("bids"), side(m, "a").alias("asks")))).drop("m")
    return held.withColumn("is_data", F.coalesce(F.forall("read", _complete), F.lit(False)))


def frames(raw: DataFrame) -> DataFrame:
    """Single messages out of single or array frames: the rows of ``raw`` with ``idx`` and ``is_data``.

    A message must have all that its type requires: texts, unsigned whole numbers, flags,
    decimals (as numbers or texts), and levels that are pairs of decimals; optional numbers
    may be missing, but not be anything else. One element that does not, or is of an unknown
    type, rejects its whole frame; a rejected frame stays as one row that is no data. An
    empty array is data without messages: one row without a body. Decimals beyond 20 whole
    digits and whole numbers beyond 63 bits are rejected as well.
    """
    kept = F.when(F.col("is_data"), F.col("parts")).otherwise(F.array("body"))
    return _framed(raw).select("venue", "source", "local_ts", "pos", "is_data", F.posexplode_outer(kept).alias("idx", "body"))


def replies(other: DataFrame, awaited: DataFrame) -> DataFrame:
    """Frames that are no data, as ack_ok, ack_error, venue_error or ignored.

    ``awaited`` has venue, source and the request id whose answer is awaited there.
    """
    r = other.join(awaited, ["venue", "source"], "left").withColumn("m", F.from_json("body", S.REPLY))
    own = F.coalesce(F.col("m.id") == F.col("awaited_id"), F.lit(False))
    action = F.when(F.col("m.error").isNotNull(), F.when(own, "ack_error").otherwise("venue_error")).when(own & F.col("m.result").isNull(), "ack_ok").otherwise("ignored")
    return r.select("venue", "source", "pos", action.alias("action"))


def _rows(kind_of: Column, of: str, instrument: Column, venue_ts: Column, **payloads: Column) -> Column:
    """Events of a message of type ``of`` as an array of structs, one for each payload; none of other types."""
    made = [
        F.struct(
            F.lit(kind).alias("kind"), F.lower(instrument).alias("instrument"), venue_ts.alias("venue_ts"),
            *((p if k == kind else F.lit(None)).cast(t).alias(k) for k, t in S.PAYLOADS.items()),
        )
        for kind, p in payloads.items()
    ]
    return F.when(kind_of == of, F.array(*made))


def _prediction(rate: Column, time: Column, premium: Column | None = None, interval: Column | None = None) -> Column:
    none = F.lit(None)
    return F.struct(exact(rate), ns_from_ms(time), none if interval is None else interval, none if premium is None else exact(premium), none, none)


def socket_events(raw: DataFrame, info: DataFrame | None = None) -> DataFrame:
    """All events of socket messages, as rows of the event log: one pass, each message read once.

    Best prices, trades and aggregated trades (one fill each), depth changes, mark price
    (three events: mark, index, predicted funding), and liquidations. Predictions have the
    interval and the limits of ``info`` (symbol, interval_ns, cap, floor, as
    ``funding_info`` gives them); eight hours and none where it does not list them.
    """
    data = _framed(raw).where("is_data").select("venue", "source", "local_ts", "pos", F.explode("read").alias("x"))
    x = F.col("x")
    at = lambda path: _at(x["m"], path)
    fill = lambda id_, kind: F.array(F.struct(id_.cast("string"), exact(at("p")), exact(at("q")), aggressor(at("m")), kind))
    ns = lambda path: ns_from_ms(at(path))
    e, s = at("e"), at("s")
    book = F.struct(at("U"), at("u"), at("pu").try_cast("long"), ns("E"), _levels(x["bids"]), _levels(x["asks"]))
    forced = F.struct(F.when(at("o.S") == "SELL", "sell").otherwise("buy"), *(exact(at(f"o.{c}")) for c in ("p", "q", "z", "ap")), at("o.X"))
    events = F.coalesce(
        _rows(e, "bookTicker", s, ns("T"), book_ticker=F.struct(at("u"), *(exact(at(c)) for c in ("b", "B", "a", "A")))),
        _rows(e, "trade", s, ns("T"), trades=fill(at("t"), at("X"))),
        _rows(e, "aggTrade", s, ns("T"), trades=fill(at("a"), F.lit(None).cast("string"))),
        _rows(e, "depthUpdate", s, ns("T"), book_update=book),
        _rows(e, "markPriceUpdate", s, ns("E"), mark_price=exact(at("p")), index_price=exact(at("i")), funding_prediction=_prediction(at("r"), at("T"), interval=F.lit(DEFAULT_FUNDING_INTERVAL))),
        _rows(e, "forceOrder", at("o.s"), ns("o.T"), liquidation=forced),
    )
    out = data.select("venue", "local_ts", F.col("source").cast("int").alias("source"), "pos", F.explode(events).alias("x"))
    out = out.select("venue", "x.instrument", "x.venue_ts", "local_ts", "source", "pos", "x.kind", *(f"x.{k}" for k in S.PAYLOADS))
    if info is None:
        return out
    listed = info.select(F.col("symbol").alias("_s"), "interval_ns", "cap", "floor")
    met = out.join(listed, (F.col("instrument") == F.col("_s")) & (F.col("kind") == "funding_prediction"), "left")
    known = F.col("funding_prediction").withField("interval_ns", F.coalesce("interval_ns", F.lit(DEFAULT_FUNDING_INTERVAL))).withField("clamp_min", F.col("floor")).withField("clamp_max", F.col("cap"))
    return met.withColumn("funding_prediction", F.when(F.col("kind") == "funding_prediction", known)).select(*out.columns)


def premium_index(raw: DataFrame) -> DataFrame:
    """Mark and index price, and predicted funding where a next funding time is set; each message is parsed once."""
    m = raw.select("venue", "source", "local_ts", "pos", F.explode(F.from_json("body", S.PREMIUM_INDEX)).alias("m"))
    kinds = ("mark_price", "index_price", "funding_prediction")
    made = {"mark_price": exact(F.col("m.markPrice")), "index_price": exact(F.col("m.indexPrice")), "funding_prediction": _prediction(F.col("m.lastFundingRate"), F.col("m.nextFundingTime"))}
    one = lambda kind: F.struct(F.lit(kind).alias("kind"), *((made[k] if k == kind else F.lit(None)).cast(S.PAYLOADS[k]).alias(k) for k in kinds))
    events = F.array(one("mark_price"), one("index_price"), F.when(F.col("m.nextFundingTime") > 0, one("funding_prediction")))
    out = m.select("*", F.explode(F.filter(events, lambda x: x.isNotNull())).alias("x"))
    return out.select("venue", F.lower("m.symbol").alias("instrument"), ns_from_ms(F.col("m.time")).alias("venue_ts"), "local_ts", F.col("source").cast("int").alias("source"), "pos", "x.*")


#: Names of control and reference kinds in the log's JSON detail (fixed values).
CONTROL_TAGS = {"conn_up": "ConnUp", "conn_down": "ConnDown", "gap": "Gap", "snapshot_begin": "SnapshotBegin", "snapshot_end": "SnapshotEnd", "sub_ack": "SubAck", "reorg": "Reorg"}
REFERENCE_TAGS = {"instrument_added": "InstrumentAdded", "instrument_changed": "InstrumentChanged", "instrument_delisted": "InstrumentDelisted", "market_resolved": "MarketResolved"}


def tagged(rows: DataFrame, payload: str, kind: Column, fields: dict[str, list[str]]) -> DataFrame:
    """Events of ``payload`` (control or reference) whose detail is JSON under the kind's tag.

    ``rows`` has venue, instrument, venue_ts, local_ts, source, pos and the columns named
    in ``fields`` (kind -> its columns, or SQL expressions over them); a kind without any is its tag alone.
    """
    tags = CONTROL_TAGS if payload == "control" else REFERENCE_TAGS
    detail = F.lit(None).cast("string")
    for k, tag in tags.items():
        body = F.to_json(F.struct(*(F.expr(c) for c in fields[k])), {"ignoreNullFields": "false"}) if fields.get(k) else None
        detail = F.when(kind == k, F.lit(f'"{tag}"') if body is None else F.concat(F.lit(f'{{"{tag}":'), body, F.lit("}"))).otherwise(detail)
    return rows.select("venue", "instrument", "venue_ts", "local_ts", F.col("source").cast("int").alias("source"), "pos", F.lit(payload).alias("kind"), F.struct(kind.alias("kind"), detail.alias("detail")).alias(payload))


def open_interest(raw: DataFrame) -> DataFrame:
    m = raw.withColumn("m", F.from_json("body", S.OPEN_INTEREST))
    return _event(m, "open_interest", F.col("m.symbol"), ns_from_ms(F.col("m.time")), F.struct(exact(F.col("m.openInterest")), F.lit(None)))


def funding_rate(raw: DataFrame, info: DataFrame) -> DataFrame:
    """Settlements with the interval of ``info`` (symbol, interval_ns), eight hours where it has none.

    A settlement on several pages is taken from the first.
    """
    m = raw.select("*", F.explode(F.from_json("body", S.FUNDING_RATE)).alias("m")).withColumn("symbol", F.lower("m.symbol"))
    m = m.join(info.select("symbol", "interval_ns"), "symbol", "left")
    out = _event(
        m, "funding_realized", F.col("symbol"), ns_from_ms(F.col("m.fundingTime")),
        F.struct(exact(F.col("m.fundingRate")), ns_from_ms(F.col("m.fundingTime")), F.coalesce("interval_ns", F.lit(DEFAULT_FUNDING_INTERVAL))),
    )
    cols = [c for c in out.columns if c not in ("venue", "instrument", "venue_ts")]
    first = out.groupBy("venue", "instrument", "venue_ts").agg(F.min_by(F.struct(*cols), "pos").alias("r"))
    return first.select("venue", "instrument", "venue_ts", "r.*").select(*out.columns)


def depth_snapshot(raw: DataFrame) -> DataFrame:
    """``raw`` has the symbol beside the body; the source is always 0."""
    m = raw.withColumn("m", F.from_json("body", S.DEPTH_SNAPSHOT)).withColumn("source", F.lit(0))
    return _event(m, "book_snapshot", F.col("symbol"), ns_from_ms(F.col("m.T")), F.struct(F.col("m.lastUpdateId"), _levels(F.col("m.bids")), _levels(F.col("m.asks"))))


def funding_info(raw: DataFrame, default: bool = True) -> DataFrame:
    """symbol, interval_ns, cap, floor; eight hours where none are given, unless ``default`` is off."""
    m = raw.select(F.explode(F.from_json("body", S.FUNDING_INFO)).alias("m"))
    hours = F.coalesce(F.col("m.fundingIntervalHours"), F.lit(8)) if default else F.col("m.fundingIntervalHours")
    return m.select(F.lower("m.symbol").alias("symbol"), (hours * NS_HOUR).alias("interval_ns"), exact(F.col("m.adjustedFundingRateCap")).alias("cap"), exact(F.col("m.adjustedFundingRateFloor")).alias("floor"))


def instruments(raw: DataFrame, info: DataFrame | None = None) -> DataFrame:
    """A row for each symbol of an exchange dump: class, lifecycle, linearity, sizes, interval, expiry."""
    m = raw.select(*(c for c in raw.columns if c != "body"), F.explode(F.from_json("body", S.EXCHANGE_INFO)["symbols"]).alias("m"))
    out = m.select(
        *(c for c in m.columns if c != "m"), F.lower("m.symbol").alias("symbol"), F.col("m.status").alias("status"), lifecycle(F.col("m.status")).alias("lifecycle"),
        contract_class(F.col("m.contractType")).alias("class"), F.col("m.baseAsset").alias("base"), F.col("m.quoteAsset").alias("quote"), F.col("m.marginAsset").alias("settle"),
        linearity(F.col("m.marginAsset"), F.col("m.quoteAsset")).alias("linearity"), picked(F.col("m.filters"), "PRICE_FILTER", "tickSize").alias("tick_size"),
        picked(F.col("m.filters"), "LOT_SIZE", "stepSize").alias("lot_size"), picked(F.col("m.filters"), "MIN_NOTIONAL", "notional").alias("min_notional"),
        ns_from_ms(F.col("m.onboardDate")).alias("onboard_ts"), F.when(F.col("m.contractType") != "PERPETUAL", ns_from_ms(F.col("m.deliveryDate"))).alias("expiry_ts"),
    )
    if info is None:
        return out
    # only perpetuals are funded
    interval = F.when(F.col("class") == "perp", F.coalesce("interval_ns", F.lit(DEFAULT_FUNDING_INTERVAL)))
    return out.join(info.select("symbol", "interval_ns"), "symbol", "left").withColumn("interval_ns", interval)


def dump_days(dumps: DataFrame) -> DataFrame:
    """The days of the exchange dumps (dump_day, body) that can be read, also of those that list nothing."""
    return dumps.where(F.from_json("body", S.EXCHANGE_INFO)["symbols"].isNotNull()).select("dump_day").distinct()


def day_snapshots(dumps: DataFrame, interval_dumps: DataFrame) -> DataFrame:
    """The instruments of dated exchange dumps (dump_day, body), as ``fold_history`` takes them.

    Perpetuals have the funding interval of the latest list of intervals on or before
    the day, eight hours where that one does not list them. Lists count only on days of
    exchange dumps, readable or not; an empty list replaces the one before it, a list
    that cannot be read does not.
    """
    listed = instruments(dumps)
    lists = interval_dumps.select("dump_day", F.from_json("body", S.FUNDING_INFO).alias("list")).where("list IS NOT NULL")
    intervals = lists.select("dump_day", F.explode_outer("list").alias("m"))
    hours = F.coalesce(F.col("m.fundingIntervalHours"), F.lit(8))
    values = intervals.groupBy("dump_day", F.lower("m.symbol").alias("symbol")).agg(F.max(hours * NS_HOUR).alias("value"))
    asked = listed.select("symbol", "dump_day").unionByName(dumps.select(F.lit(None).cast("string").alias("symbol"), "dump_day"))
    carried = carried_forward(asked, values).withColumnRenamed("value", "interval_ns")
    interval = F.when(F.col("class") == "perp", F.coalesce("interval_ns", F.lit(DEFAULT_FUNDING_INTERVAL)))
    return listed.join(carried, ["symbol", "dump_day"], "left").withColumn("interval_ns", interval)


def perpetuals(raw: DataFrame, info: DataFrame) -> DataFrame:
    """Symbol, onboard time and listed interval (null where unlisted) of the perpetuals of a dump."""
    return instruments(raw).where("class = 'perp'").join(info.select("symbol", "interval_ns"), "symbol", "left").select("symbol", "onboard_ts", "interval_ns")


def klines(raw: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Positional bars to named columns; ``raw`` has the symbol. Bound on the open time."""
    m = raw.select("symbol", F.explode(F.from_json("body", S.KLINES)).alias("k"))
    at = lambda i: F.col("k")[i]
    num = lambda i: at(i).try_cast("double")
    out = m.select(
        F.lower("symbol").alias("instrument"), ns_from_ms(at(0)).alias("open_time"), ns_from_ms(at(6)).alias("close_time"), *(num(i).alias(n) for i, n in ((1, "open"), (2, "high"), (3, "low"), (4, "close"), (5, "volume"), (7, "quote_volume"))),
        at(8).try_cast("long").alias("trades"), num(9).alias("taker_buy_volume"), num(10).alias("taker_buy_quote_volume"),
    )
    return out if start is None else out.where(within(F.col("open_time"), start, end))


def oi_history(raw: DataFrame, start: int, end: int) -> DataFrame:
    m = raw.select(F.explode(F.from_json("body", S.OI_HISTORY)).alias("m"))
    out = m.select(F.lower("m.symbol").alias("instrument"), ns_from_ms(F.col("m.timestamp")).alias("venue_ts"), F.col("m.sumOpenInterest").try_cast("double").alias("open_interest"), F.col("m.sumOpenInterestValue").try_cast("double").alias("open_interest_value"))
    return out.where(within(F.col("venue_ts"), start, end))


def paged_funding(raw: DataFrame, start: int, end: int) -> DataFrame:
    """Settlements of answer pages with text times; bad times are skipped, failed pages are left out."""
    m = raw.withColumn("m", F.from_json("body", S.BYBIT_FUNDING)).where("m.retCode = 0").select(F.explode("m.result.list").alias("r"))
    out = m.select(F.lower("r.symbol").alias("instrument"), ns_from_ms(F.col("r.fundingRateTimestamp").try_cast("long")).alias("funding_time"), F.col("r.fundingRate").try_cast("double").alias("rate"))
    return out.where(F.col("funding_time").isNotNull() & within(F.col("funding_time"), start, end)).distinct()


def failed_pages(raw: DataFrame) -> DataFrame:
    return raw.where(F.coalesce(F.get_json_object("body", "$.retCode").try_cast("int"), F.lit(-1)) != 0)


def paged_instruments(raw: DataFrame) -> DataFrame:
    """Instruments of an array of answer pages; launch time in ms as text, interval in minutes."""
    page = raw.select(F.explode(F.from_json("body", S.BYBIT_INSTRUMENTS)).alias("p")).where("p.retCode = 0").select(F.explode("p.result.list").alias("i"))
    return page.select(
        F.lower("i.symbol").alias("symbol"), "i.status", contract_class(F.col("i.contractType")).alias("class"), F.col("i.baseCoin").alias("base"), F.col("i.quoteCoin").alias("quote"), F.col("i.settleCoin").alias("settle"),
        ns_from_ms(F.col("i.launchTime").try_cast("long")).alias("onboard_ts"), (F.col("i.fundingInterval") * 60_000_000_000).alias("interval_ns"),
    )


def mapping_rows(listed: DataFrame, venue: str, dump_time: int) -> DataFrame:
    """Perpetuals of a dump as mapping rows; settle falls back to quote, the start to the dump's time."""
    return listed.where("class = 'perp'").select(
        F.lit(venue).alias("venue"), F.col("symbol").alias("instrument"), "base", "quote", "class", F.coalesce("settle", "quote").alias("settle"),
        F.coalesce("onboard_ts", F.lit(dump_time)).alias("valid_from"), F.lit(None).cast("long").alias("valid_to"), F.lit("dump").alias("origin"),
    )


def union(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
