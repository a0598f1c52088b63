"""Scalar rules of market data, as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewright.schemas import LIFECYCLES, PERPETUALS

NS_DAY = 86_400_000_000_000
NS_HOUR = 3_600_000_000_000
DEFAULT_FUNDING_INTERVAL = 8 * NS_HOUR

#: Kinds of instruments that there are names for.
KNOWN_CLASSES = ("perp", "future", "spot", "option")


def ns_from_ms(ms: Column) -> Column:
    """Null where the text is no whole number."""
    return ms.try_cast("long") * 1_000_000


def ns_of(ts: Column) -> Column:
    """Nanoseconds since 1970 of a timestamp (session time zone UTC)."""
    return F.unix_micros(ts.cast("timestamp")) * 1000


def micros(ns: Column) -> Column:
    """Nanoseconds to microseconds, towards zero."""
    return F.when(ns >= 0, F.floor(ns / 1000)).otherwise(-F.floor(-ns / 1000)).cast("long")


def day_of(ns: Column) -> Column:
    """Days since 1970 of a time in nanoseconds."""
    return ((ns - F.pmod(ns, F.lit(NS_DAY))) / NS_DAY).cast("long")


def date_of(ns: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), day_of(ns).cast("int"))


def month_of(ns: Column) -> Column:
    return F.date_format(date_of(ns), "yyyy-MM")


def month_parsed(text: Column) -> Column:
    """The first day of a month written yyyy-MM; null where it is none."""
    return F.when(text.rlike("^[0-9]{4}-(0[1-9]|1[0-2])$"), F.concat(text, F.lit("-01")).cast("date"))


def month_next(text: Column) -> Column:
    return F.date_format(F.add_months(month_parsed(text), 1), "yyyy-MM")


def month_bounds(text: Column) -> Column:
    """start and end (exclusive) of a month in nanoseconds."""
    day = month_parsed(text)
    ns = lambda d: F.unix_date(d).cast("long") * NS_DAY
    return F.struct(ns(day).alias("start"), ns(F.add_months(day, 1)).alias("end"))


def number(text: Column) -> Column:
    """A decimal text as double; null where it is none."""
    return text.try_cast("double")



def exact(text: Column) -> Column:
    return text.try_cast("decimal(38,18)")


def canonical_key(base: Column, quote: Column, kind: Column, settle: Column) -> Column:
    return F.concat_ws("-", base, quote, kind, F.coalesce(settle, quote))


def mapped(word: Column, names: dict[str, str], otherwise: str) -> Column:
    out = F.lit(otherwise)
    for k, v in names.items():
        out = F.when(word == k, v).otherwise(out)
    return F.when(word.isNull(), F.lit(None)).otherwise(out)


def lifecycle(status: Column) -> Column:
    """What a venue's status word means; any other word means halted."""
    return mapped(status, LIFECYCLES, "halted")


def contract_class(contract: Column) -> Column:
    """perp, and a dated future for whatever is none."""
    return mapped(contract, dict.fromkeys(PERPETUALS, "perp"), "future")


def known_class(name: Column) -> Column:
    """The name itself; an unsupported one is an error."""
    return F.when(name.isin(*KNOWN_CLASSES), name).otherwise(F.raise_error(F.concat(F.lit("unsupported class "), name)))


def linearity(settle: Column, quote: Column) -> Column:
    """linear if settled in the quote, else inverse; null where the settling asset is not known."""
    return F.when(settle == quote, "linear").when(settle.isNotNull(), "inverse")


def picked(entries: Column, kind: str, field: str) -> Column:
    """A numeric field of the first entry whose filterType is ``kind``."""
    return F.get(F.filter(entries, lambda x: x["filterType"] == kind), 0)[field].try_cast("double")


def covers(at: Column, start: Column, end: Column) -> Column:
    """Whether a validity window, open-ended where its end is null, holds ``at``."""
    return (at >= start) & (end.isNull() | (at < end))


def within(at: Column, start: int, end: int) -> Column:
    """Half-open window."""
    return (at >= start) & (at < end)


def aggressor(buyer_is_maker: Column) -> Column:
    """The side that took; null where it is not known."""
    return F.when(buyer_is_maker, "sell").when(~buyer_is_maker, "buy")


def latency(local_ts: Column, venue_ts: Column) -> Column:
    return local_ts - venue_ts
