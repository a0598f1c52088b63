"""Schemas of raw messages and of the event log, as DDL. Nothing is inferred."""

from __future__ import annotations

# Raw messages (fixed values: field names and types are the venues').
# A message is read once, into columns named by place, as its fields differ by case only.
# Fields of several types, decimals and optional numbers are read as text and checked after.
MESSAGE = {
    "e": "STRING", "s": "STRING", "E": "BIGINT", "T": "BIGINT", "U": "BIGINT", "u": "BIGINT", "pu": "STRING", "t": "BIGINT", "p": "STRING", "q": "STRING", "i": "STRING", "r": "STRING",
    "b": "STRING", "B": "STRING", "a": "STRING", "A": "STRING", "m": "BOOLEAN", "X": "STRING",
}
ORDER = {"s": "STRING", "S": "STRING", "p": "STRING", "q": "STRING", "z": "STRING", "ap": "STRING", "X": "STRING", "T": "BIGINT"}
# What a message of each type must have: texts, unsigned whole numbers, decimals, and optional ones of either kind.
RULES = {
    "bookTicker": {"text": "s", "whole": "u T", "decimal": "b B a A"},
    "trade": {"text": "s", "whole": "t T", "decimal": "p q", "flag": "m"},
    "aggTrade": {"text": "s", "whole": "a T", "decimal": "p q", "flag": "m"},
    "depthUpdate": {"text": "s", "whole": "E T U u", "levels": "b a", "maybe_whole": "pu"},
    "markPriceUpdate": {"text": "s", "whole": "E T", "decimal": "p i r"},
    "forceOrder": {"text": "o.s o.S", "whole": "o.T", "decimal": "o.p o.q", "maybe_decimal": "o.ap o.z"},
}
# Words of dumps: a status's meaning here, and the contract types that are perpetual.
LIFECYCLES = {"TRADING": "trading", "PENDING_TRADING": "pending_trading", "DELIVERED": "delisted", "CLOSE": "delisted"}
PERPETUALS = ("PERPETUAL", "LinearPerpetual")
PAIRS = "ARRAY<ARRAY<STRING>>"
REPLY = "result STRING, error STRING, id BIGINT"
PREMIUM_INDEX = "ARRAY<STRUCT<symbol: STRING, markPrice: STRING, indexPrice: STRING, lastFundingRate: STRING, nextFundingTime: BIGINT, time: BIGINT>>"
OPEN_INTEREST = "symbol STRING, openInterest STRING, time BIGINT"
FUNDING_RATE = "ARRAY<STRUCT<symbol: STRING, fundingTime: BIGINT, fundingRate: STRING>>"
DEPTH_SNAPSHOT = "lastUpdateId BIGINT, T BIGINT, bids ARRAY<ARRAY<STRING>>, asks ARRAY<ARRAY<STRING>>"
FUNDING_INFO = "ARRAY<STRUCT<symbol: STRING, fundingIntervalHours: BIGINT, adjustedFundingRateCap: STRING, adjustedFundingRateFloor: STRING>>"
EXCHANGE_INFO = (
    "symbols ARRAY<STRUCT<symbol: STRING, contractType: STRING, baseAsset: STRING, quoteAsset: STRING, marginAsset: STRING, status: STRING, onboardDate: BIGINT, deliveryDate: BIGINT, "
    "filters: ARRAY<STRUCT<filterType: STRING, tickSize: STRING, stepSize: STRING, notional: STRING>>>>"
)
KLINES = "ARRAY<ARRAY<STRING>>"
OI_HISTORY = "ARRAY<STRUCT<symbol: STRING, sumOpenInterest: STRING, sumOpenInterestValue: STRING, timestamp: BIGINT>>"
BYBIT_FUNDING = "retCode INT, result STRUCT<list: ARRAY<STRUCT<symbol: STRING, fundingRate: STRING, fundingRateTimestamp: STRING>>>"
BYBIT_INSTRUMENTS = (
    "ARRAY<STRUCT<retCode: INT, result: STRUCT<list: ARRAY<STRUCT<symbol: STRING, contractType: STRING, status: STRING, baseCoin: STRING, quoteCoin: STRING, settleCoin: STRING, launchTime: STRING, fundingInterval: BIGINT>>>>>"
)

LEVELS = "ARRAY<STRUCT<price: DECIMAL(38,18), qty: DECIMAL(38,18)>>"
FILLS = "ARRAY<STRUCT<id: STRING, price: DECIMAL(38,18), qty: DECIMAL(38,18), side: STRING, kind: STRING>>"
#: One column for each payload; all but the row's own are null.
PAYLOADS = {
    "book_ticker": "STRUCT<update_id: BIGINT, bid_price: DECIMAL(38,18), bid_qty: DECIMAL(38,18), ask_price: DECIMAL(38,18), ask_qty: DECIMAL(38,18)>",
    "trades": FILLS,
    "mark_price": "DECIMAL(38,18)",
    "index_price": "DECIMAL(38,18)",
    "funding_prediction": "STRUCT<rate: DECIMAL(38,18), next_funding_time: BIGINT, interval_ns: BIGINT, premium_index: DECIMAL(38,18), clamp_min: DECIMAL(38,18), clamp_max: DECIMAL(38,18)>",
    "funding_realized": "STRUCT<rate: DECIMAL(38,18), funding_time: BIGINT, interval_ns: BIGINT>",
    "book_snapshot": f"STRUCT<last_update_id: BIGINT, bids: {LEVELS}, asks: {LEVELS}>",
    "book_update": f"STRUCT<first_update_id: BIGINT, final_update_id: BIGINT, prev_final_update_id: BIGINT, event_time: BIGINT, bids: {LEVELS}, asks: {LEVELS}>",
    "liquidation": "STRUCT<side: STRING, price: DECIMAL(38,18), qty: DECIMAL(38,18), filled_qty: DECIMAL(38,18), avg_price: DECIMAL(38,18), order_status: STRING>",
    "open_interest": "STRUCT<open_interest: DECIMAL(38,18), open_interest_value: DECIMAL(38,18)>",
    "control": "STRUCT<kind: STRING, detail: STRING>",
    "reference": "STRUCT<kind: STRING, detail: STRING>",
}
ENVELOPE = "venue STRING, instrument STRING, venue_ts BIGINT, local_ts BIGINT, source INT, pos BIGINT, kind STRING"
EVENT_LOG = ENVELOPE + ", " + ", ".join(f"{k} {v}" for k, v in PAYLOADS.items())
RAW = "venue STRING, source INT, local_ts BIGINT, pos BIGINT, body STRING"
