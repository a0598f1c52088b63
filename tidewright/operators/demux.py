"""Demultiplexing: the event log into one table for each kind."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENVELOPE = ["instrument", "venue_ts", "local_ts", "source"]
#: Names of two tables differ from those of their kinds.
TABLE_OF = {"funding_prediction": "funding_rate", "funding_realized": "funding_rate_realized"}
FLAT = {
    "book_ticker": ["update_id", "bid_price", "bid_qty", "ask_price", "ask_qty"],
    "funding_prediction": ["rate", "next_funding_time", "interval_ns", "premium_index", "clamp_min", "clamp_max"],
    "funding_realized": ["rate", "funding_time", "interval_ns"],
    "liquidation": ["side", "price", "qty", "filled_qty", "avg_price", "order_status"],
    "open_interest": ["open_interest", "open_interest_value"],
    "control": ["kind", "detail"],
    "reference": ["kind", "detail"],
}
EXACT = "decimal(38,18)"


def _plain(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, as the tables have them."""
    return df.select(*(F.col(c).cast("double").alias(c) if t == EXACT else F.col(c) for c, t in df.dtypes))


def _of(log: DataFrame, kind: str) -> DataFrame:
    rows = log.where(F.col("kind") == kind)
    return rows if kind in ("control", "reference") else rows.where(F.col("instrument").isNotNull())


def flat(log: DataFrame, kind: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return _plain(_of(log, kind).select(*keep, *ENVELOPE, *(F.col(f"{kind}.{c}").alias(c) for c in FLAT[kind])))


def price(log: DataFrame, kind: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """mark_price or index_price."""
    return _plain(_of(log, kind).select(*keep, *ENVELOPE, F.col(kind).alias("price")))


def trades(log: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """A row for each fill."""
    rows = _of(log, "trades").select(*keep, *ENVELOPE, F.explode("trades").alias("t"))
    return _plain(rows.select(*keep, *ENVELOPE, F.col("t.id").alias("trade_id"), "t.price", "t.qty", "t.side", "t.kind"))


def _sides(kind: str):
    side = lambda name: F.transform(F.coalesce(f"{kind}.{name}s", F.array()), lambda x, i: F.struct(F.lit(name).alias("side"), i.alias("level_idx"), x["price"].alias("price"), x["qty"].alias("qty")))
    return F.concat(side("bid"), side("ask"))


def book_snapshot(log: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """A row for each level with its rank, bids first."""
    rows = _of(log, "book_snapshot").select(*keep, *ENVELOPE, F.col("book_snapshot.last_update_id").alias("last_update_id"), F.explode(_sides("book_snapshot")).alias("l"))
    return _plain(rows.select(*keep, *ENVELOPE, "last_update_id", "l.side", "l.level_idx", "l.price", "l.qty"))


def book_update(log: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """A row for each changed level; an update without levels gives none."""
    ids = ["first_update_id", "final_update_id", "prev_final_update_id", "event_time"]
    rows = _of(log, "book_update").select(*keep, *ENVELOPE, *(F.col(f"book_update.{c}").alias(c) for c in ids), F.explode(_sides("book_update")).alias("l"))
    return _plain(rows.select(*keep, *ENVELOPE, *ids, "l.side", "l.price", "l.qty"))


def tables(log: DataFrame, keep: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """All twelve tables of a log, by name."""
    out = {TABLE_OF.get(k, k): flat(log, k, keep) for k in FLAT}
    out |= {k: price(log, k, keep) for k in ("mark_price", "index_price")}
    return out | {"trades": trades(log, keep), "book_snapshot": book_snapshot(log, keep), "book_update": book_update(log, keep)}


def skipped(log: DataFrame) -> DataFrame:
    """Events that go to no table: without an instrument, or of a reserved kind."""
    lost = F.col("instrument").isNull() & ~F.col("kind").isin("control", "reference")
    return log.groupBy("venue").agg(F.count_if(lost).alias("no_instrument"), F.count_if(F.col("kind").isin("chain", "account")).alias("reserved"))
