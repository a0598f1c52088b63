"""Checks of a captured event log: sequence chains, splices, regressions, latency, verdict.

Order is the position in the log (``pos``), never time. Every window over events is
keyed by venue, instrument and a bucket of positions, with what the earlier buckets
ended on carried along; lost connections are matched by bucket too. So neither an
instrument's nor a source's whole history meets in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KEY = ("venue", "instrument")
#: Width of a bucket of positions.
POSITIONS = 4096
#: Widths of buckets of ids, for ranges of any width.
LEVELS = tuple(256 << 8 * i for i in range(7)) + (2**62,)
PENDING_NS = 60_000_000_000
TIMELINE = 500
#: A day with a larger share of bytes outside frames fails.
MAX_SKIPPED = 0.01
BUCKET_NS, LOW_NS, HIGH_NS = 1_000_000, -1_000_000_000, 10_000_000_000


def _bucket() -> Column:
    return F.floor(F.col("pos") / POSITIONS)


def _carried(rows: DataFrame, values: dict[str, Column], keys: tuple[str, ...] = KEY) -> DataFrame:
    """keys, _bucket and, for each of ``values``, its last non-null value by position in earlier buckets.

    A bucket has one row here, so what is ordered over a key's whole history is one row for
    each bucket of positions, not each event.
    """
    last = [F.max_by(v, F.when(v.isNotNull(), F.col("_at"))).alias(name) for name, v in values.items()]
    at = F.struct("pos", "idx") if "idx" in rows.columns else F.col("pos")
    ends = rows.withColumns({"_at": at, "_bucket": _bucket()}).groupBy(*keys, "_bucket").agg(*last)
    before = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    return ends.select(*keys, "_bucket", *(F.last(name, ignorenulls=True).over(before).alias(f"_{name}") for name in values))


def with_previous(rows: DataFrame, values: dict[str, Column], carry: DataFrame | None = None, keys: tuple[str, ...] = KEY) -> DataFrame:
    """``rows`` with, under each name of ``values``, its last non-null value before the row (by key, in the order of positions).

    Windows hold a bucket of positions of a key; what went before comes from earlier
    buckets, and before them from ``carry`` (the keys and the names), as ``last_values`` of
    an earlier part of the log gives it.
    """
    order = ["pos", "idx"] if "idx" in rows.columns else ["pos"]
    in_bucket = W.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    out = rows.withColumn("_bucket", _bucket()).join(_carried(rows, values, keys), [*keys, "_bucket"])
    found = {name: F.coalesce(F.last(v, ignorenulls=True).over(in_bucket), F.col(f"_{name}")) for name, v in values.items()}
    if carry is not None:
        out = out.join(carry.select(*keys, *(F.col(name).alias(f"_c_{name}") for name in values)), list(keys), "left")
        found = {name: F.coalesce(c, F.col(f"_c_{name}")) for name, c in found.items()}
    return out.withColumns(found).select(*rows.columns, *values)


def last_values(rows: DataFrame, values: dict[str, Column], carry: DataFrame | None = None, keys: tuple[str, ...] = KEY) -> DataFrame:
    """keys and the last non-null value of each of ``values``: what the next part of a log goes on from."""
    at = F.struct("pos", "idx") if "idx" in rows.columns else F.col("pos")
    out = rows.withColumn("_at", at).groupBy(*keys).agg(*(F.max_by(v, F.when(v.isNotNull(), F.col("_at"))).alias(name) for name, v in values.items()))
    if carry is None:
        return out
    older = carry.select(*keys, *(F.col(name).alias(f"_c_{name}") for name in values))
    return out.join(older, list(keys), "full_outer").select(*keys, *(F.coalesce(name, f"_c_{name}").alias(name) for name in values))


def _chain_values() -> dict[str, Column]:
    return {"last_final": F.col("final_update_id"), "prev_pos": F.col("pos"), "prev_source": F.col("source")}


def chain(updates: DataFrame, carry: DataFrame | None = None) -> DataFrame:
    """Updates with ``is_break``, ``is_overlap``, and the previous update's ``prev_pos``, ``prev_source``.

    ``carry`` is ``chain_ends`` of the days before, whose positions lie before these.
    """
    linked = F.col("prev_final_update_id").isNotNull() & F.col("last_final").isNotNull()
    return (
        with_previous(updates, _chain_values(), carry)
        .withColumn("is_break", F.coalesce(linked & (F.col("prev_final_update_id") != F.col("last_final")), F.lit(False)))
        .withColumn("is_overlap", F.coalesce(linked & ~F.col("is_break") & (F.col("first_update_id") <= F.col("last_final")), F.lit(False)))
    )


def chain_ends(updates: DataFrame, carry: DataFrame | None = None) -> DataFrame:
    """venue, instrument, last_final, prev_pos, prev_source: each instrument's last update, with ``carry`` for those without one."""
    return last_values(updates, _chain_values(), carry)


def _losses(asked: DataFrame, downs: DataFrame) -> DataFrame:
    """``asked`` (venue, source, at, ...) with the losses of ``at``'s bucket (_own), and the last one and the number before it.

    Losses are kept by bucket of positions, with what all earlier buckets held carried
    along, so each asked row meets one row of at most a bucket's losses.
    """
    key = ["venue", "source", "_bucket"]
    a = asked.withColumn("_bucket", F.floor(F.col("at") / POSITIONS))
    own = downs.groupBy("venue", "source", F.floor(F.col("pos") / POSITIONS).alias("_bucket")).agg(F.collect_list("pos").alias("_own"))
    before = W.partitionBy("venue", "source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    held = a.select(*key).distinct().join(own, key, "full_outer")
    held = held.withColumns({"_carried": F.max(F.array_max("_own")).over(before), "_seen": F.coalesce(F.sum(F.size(F.coalesce("_own", F.array()))).over(before), F.lit(0))})
    return a.join(held, key, "left")


def last_loss(asked: DataFrame, downs: DataFrame) -> DataFrame:
    """``asked`` (venue, source, at, ...) with ``last_loss``: the last lost connection of the source before ``at``."""
    last = F.coalesce(F.array_max(F.filter("_own", lambda x: x < F.col("at"))), F.col("_carried"))
    return _losses(asked, downs).withColumn("last_loss", last).drop("_bucket", "_own", "_carried", "_seen")


def session_of(asked: DataFrame, downs: DataFrame) -> DataFrame:
    """``asked`` (venue, source, at, ...) with ``session``: how many connections the source lost up to ``at``."""
    own = F.coalesce(F.size(F.filter(F.coalesce("_own", F.array()), lambda x: x <= F.col("at"))), F.lit(0))
    return _losses(asked, downs).withColumn("session", (F.col("_seen") + own).cast("long")).drop("_bucket", "_own", "_carried", "_seen")


def explained(flagged: DataFrame, downs: DataFrame) -> DataFrame:
    """The flagged rows with ``explained``: their previous source went down in between.

    ``flagged`` has venue, source, pos, prev_pos, prev_source; ``downs`` has venue,
    source and pos of lost connections.
    """
    asked = flagged.withColumns({"_source": F.col("source"), "source": F.col("prev_source"), "at": F.col("pos")})
    out = last_loss(asked, downs).withColumns({"explained": F.coalesce(F.col("last_loss") > F.col("prev_pos"), F.lit(False)), "source": F.col("_source")})
    return out.drop("_source", "at", "last_loss")


def spliced(snapshots: DataFrame, updates: DataFrame) -> DataFrame:
    """Snapshots that a later update continues: first <= last_update_id + 1 <= final.

    Ranges of ids are met by buckets whose width goes with the range's own: a range is put
    into the level of the smallest width of which it touches two buckets at most, and a
    snapshot asks at the levels that occur.
    """
    key = list(KEY)
    wide = F.col("final_update_id") - F.col("first_update_id")
    ranges = updates.where(wide >= 0).select(*key, "pos", "first_update_id", "final_update_id")
    level = F.lit(LEVELS[-1]).cast("long")
    for width in reversed(LEVELS[:-1]):
        level = F.when(wide < width, F.lit(width).cast("long")).otherwise(level)
    ranges = ranges.withColumn("_width", level)
    down = lambda c: F.floor(F.col(c).cast("decimal(20,0)") / F.col("_width")).cast("long")
    u = ranges.withColumn("_bucket", F.explode(F.array_distinct(F.array(down("first_update_id"), down("final_update_id"))))).alias("u")
    need = snapshots.withColumn("_need", F.col("last_update_id") + 1)
    # the widths that occur are a few rows for each instrument
    used = ranges.select(*key, "_width").distinct()
    s = need.join(used, key).withColumn("_bucket", down("_need")).alias("s")
    on = [F.col(f"s.{k}") == F.col(f"u.{k}") for k in (*key, "_width", "_bucket")]
    on += [F.col("u.pos") > F.col("s.pos"), F.col("u.first_update_id") <= F.col("s._need"), F.col("s._need") <= F.col("u.final_update_id")]
    met = s.join(u, on, "left_semi").select(*(F.col(f"s.{k}").alias(k) for k in key), F.col("s.pos").alias("pos")).distinct()
    return snapshots.join(met, [*key, "pos"], "left_semi").select(*snapshots.columns)


def abandoned(snapshots: DataFrame, updates: DataFrame, downs: DataFrame) -> DataFrame:
    """Snapshots after which the source that then fed their instrument went down.

    An update's source feeds its instrument until the next update, so the last loss
    within any such span decides: it must come after the snapshot.
    """
    # a span ends at its next update, whose previous one it is; an instrument's last span ends with the log
    fed = {"since": F.col("pos"), "fed": F.col("source")}
    inner = with_previous(updates.select(*KEY, "pos", "source"), fed).where("since IS NOT NULL").select(*KEY, F.col("fed").alias("source"), "since", F.col("pos").alias("at"))
    ends = downs.groupBy("venue").agg((F.max("pos") + 1).alias("at"))
    last = last_values(updates, fed).select(*KEY, F.col("fed").alias("source"), "since").join(F.broadcast(ends), "venue")
    spans = inner.unionByName(last).where("at > since")
    lost = last_loss(spans, downs).where("last_loss > since").groupBy(*KEY).agg(F.max("last_loss").alias("lost"))
    return snapshots.join(lost, list(KEY)).where("lost > pos").select(*snapshots.columns)


def snapshot_states(snapshots: DataFrame, updates: DataFrame, downs: DataFrame, end_ts: DataFrame) -> DataFrame:
    """Snapshots with ``state``: spliced, abandoned, pending or unspliced, in this order.

    ``end_ts`` has venue and max_local_ts over all events of the log.
    """
    mark = lambda df, name: df.select(*KEY, "pos", F.lit(True).alias(name)).distinct()
    out = snapshots.join(mark(spliced(snapshots, updates), "_s"), [*KEY, "pos"], "left").join(mark(abandoned(snapshots, updates, downs), "_a"), [*KEY, "pos"], "left").join(end_ts, "venue")
    state = F.when(F.col("_s"), "spliced").when(F.col("_a"), "abandoned").when(F.col("local_ts") + PENDING_NS >= F.col("max_local_ts"), "pending").otherwise("unspliced")
    return out.withColumn("state", state).select(*snapshots.columns, "state")


def id_regressions(trades: DataFrame) -> DataFrame:
    """Fills whose numeric id is not above the previous numeric one of the instrument; ids are unsigned 64-bit numbers, others are skipped."""
    number = F.when(F.col("trade_id").rlike("^[0-9]+$"), F.col("trade_id")).try_cast("decimal(20,0)")
    numeric = trades.withColumn("id", F.when(number < F.lit(str(2**64)).cast("decimal(20,0)"), number))
    events = W.partitionBy(*KEY).orderBy("pos")
    # the previous trades event, whatever its ids, is what a lost connection is counted from
    events = numeric.select(*KEY, "pos", "source").distinct()
    spans = with_previous(events, {"prev_pos": F.col("pos"), "prev_source": F.col("source")}).drop("source")
    return with_previous(numeric, {"last_id": F.col("id")}).where("id <= last_id").join(spans, [*KEY, "pos"])


def ticker_regressions(tickers: DataFrame) -> DataFrame:
    return with_previous(tickers, {"last_id": F.col("update_id")}).where("update_id <= last_id")


def counts_by_kind(events: DataFrame) -> DataFrame:
    return events.groupBy("venue", "kind").agg(F.count("*").alias("events"))


def coverage(events: DataFrame) -> DataFrame:
    """Events, kinds, and the local time of the first and last event in log order, per instrument."""
    return events.where("kind <> 'control' AND instrument IS NOT NULL").groupBy(*KEY).agg(
        F.count("*").alias("events"), F.countDistinct("kind").alias("kinds"), F.min_by("local_ts", "pos").alias("first_local_ts"), F.max_by("local_ts", "pos").alias("last_local_ts")
    )


def coverage_kinds(events: DataFrame) -> DataFrame:
    """venue, instrument, kind, events: what ``coverage`` counts, by kind."""
    return events.where("kind <> 'control' AND instrument IS NOT NULL").groupBy(*KEY, "kind").agg(F.count("*").alias("events"))


def depth_summary(checked: DataFrame, states: DataFrame) -> DataFrame:
    """Counts per instrument: ``checked`` is chain() with explained, ``states`` snapshot_states()."""
    count = lambda c, name: F.count_if(c).alias(name)
    u = checked.groupBy(*KEY).agg(
        F.count("*").alias("updates"), count(F.col("is_break") & F.col("explained"), "breaks_explained"), count(F.col("is_break") & ~F.col("explained"), "breaks_unexplained"), count(F.col("is_overlap"), "overlaps")
    )
    s = states.groupBy(*KEY).agg(F.count("*").alias("snapshots"), *(count(F.col("state") == x, x) for x in ("unspliced", "pending", "abandoned")))
    out = u.join(s, list(KEY), "full_outer").fillna(0)
    return out.withColumn("missing_snapshot", (F.col("updates") > 0) & (F.col("snapshots") == 0))


def duplicate_summary(trade_regressions: DataFrame, ticker: DataFrame) -> DataFrame:
    """Regressions per instrument that has any; the trades' rows carry ``explained``."""
    one = lambda c: F.when(c, 1).otherwise(0).cast("long")
    t = trade_regressions.select(*KEY, one(F.col("explained")).alias("e"), one(~F.col("explained")).alias("n"), F.lit(0).cast("long").alias("k"))
    b = ticker.select(*KEY, F.lit(0).cast("long").alias("e"), F.lit(0).cast("long").alias("n"), F.lit(1).cast("long").alias("k"))
    return t.unionByName(b).groupBy(*KEY).agg(F.sum("e").alias("trades_explained"), F.sum("n").alias("trades_unexplained"), F.sum("k").alias("tickers"))


def control_counts(control: DataFrame) -> DataFrame:
    """Control events of each venue by kind; with a column ``ok`` also subscriptions that were accepted or refused."""
    count = lambda k: F.count_if(F.col("control_kind") == k)
    ack = F.col("control_kind") == "sub_ack"
    acks = [F.count_if(ack & F.col("ok")).alias("sub_ack_ok"), F.count_if(ack & ~F.col("ok")).alias("sub_ack_failed")] if "ok" in control.columns else []
    return control.groupBy("venue").agg(
        count("conn_up").alias("conn_up"), count("conn_down").alias("conn_down"), count("gap").alias("gap_events"),
        F.coalesce(F.sum(F.when(F.col("control_kind") == "gap", F.col("dropped"))), F.lit(0)).cast("long").alias("dropped"), *acks,
    )


#: What a control event says of itself in a timeline (fixed values: the words of the report).
SAYS = {
    "conn_up": ("ConnUp ", "label"), "conn_down": ("ConnDown ", "label", ": ", "reason"), "gap": ("Gap ", "reason", ": ", "dropped"), "sub_ack": ("SubAck id=", "request_id", " ok=", "ok"),
    "snapshot_begin": ("SnapshotBegin",), "snapshot_end": ("SnapshotEnd",), "reorg": ("Reorg { from_block: ", "from_block", " }"),
}


def control_text(control: DataFrame) -> Column:
    """A control event as text: its time, its kind, and what its kind tells of label, reason, count, request or block.

    Columns that ``control`` lacks, and nulls, are left empty; an unknown kind is its own name.
    """
    text = F.col("control_kind")
    for kind, parts in SAYS.items():
        # texts and names of columns by turns
        said = [F.lit(p) if i % 2 == 0 else F.coalesce(F.col(p).cast("string"), F.lit("")) if p in control.columns else F.lit("") for i, p in enumerate(parts)]
        text = F.when(F.col("control_kind") == kind, F.concat(*said)).otherwise(text)
    return F.concat(F.lit("local_ts="), F.col("local_ts").cast("string"), F.lit(" "), text)


def control_timeline(control: DataFrame, cap: int = TIMELINE) -> DataFrame:
    """The first ``cap`` control events of each venue as text, and whether more came."""
    w = W.partitionBy("venue")
    # a window group limit keeps the first rows before the shuffle; the total is a separate count
    first = control.withColumn("n", F.row_number().over(w.orderBy("pos")).cast("long")).where(F.col("n") <= cap)
    totals = control.groupBy("venue").agg(F.count("*").alias("total"))
    return first.join(F.broadcast(totals), "venue").select("venue", "n", control_text(control).alias("entry"), (F.col("total") > cap).alias("truncated"))


def event_delays(updates: DataFrame) -> DataFrame:
    """venue, kind, delta (ns): event time less transaction time of depth updates that have both, as ``latency_histogram`` takes them."""
    return updates.where("event_time IS NOT NULL AND venue_ts IS NOT NULL").select("venue", F.lit("event_minus_transaction").alias("kind"), (F.col("event_time") - F.col("venue_ts")).alias("delta"))


def latency_histogram(samples: DataFrame) -> DataFrame:
    """venue, kind, bucket, n, low, high of ``delta`` (ns): 1 ms buckets, -1 below, the last above."""
    top = (HIGH_NS - LOW_NS) // BUCKET_NS
    d = F.col("delta")
    bucket = F.when(d < LOW_NS, -1).when(d >= HIGH_NS, top).otherwise(F.floor((d - LOW_NS) / BUCKET_NS)).cast("long")
    return samples.groupBy("venue", "kind", bucket.alias("bucket")).agg(F.count("*").alias("n"), F.min("delta").alias("low"), F.max("delta").alias("high"))


def latency_percentiles(histogram: DataFrame, shares: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Percentiles in µs at the upper edge of a bucket; the tails give the exact least and largest."""
    by = W.partitionBy("venue", "kind")
    all_ = by.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    running = histogram.withColumns({"seen": F.sum("n").over(by.orderBy("bucket")), "total": F.sum("n").over(all_), "least": F.min("low").over(all_), "most": F.max("high").over(all_)})
    trunc = lambda c: F.when(c >= 0, F.floor(c / 1000)).otherwise(-F.floor(-c / 1000)).cast("long")
    top = (HIGH_NS - LOW_NS) // BUCKET_NS
    edge = F.when(F.col("bucket") < 0, trunc(F.col("least"))).when(F.col("bucket") == top, trunc(F.col("most"))).otherwise(((F.col("bucket") + 1) * BUCKET_NS + LOW_NS) / 1000).cast("long")
    rank = lambda p: F.greatest(F.least(F.ceil(F.lit(float(p)) * F.col("total")), F.col("total")), F.lit(1))
    out = [F.min_by(F.when(F.col("seen") >= rank(p), edge), F.when(F.col("seen") >= rank(p), F.col("bucket"))).alias(f"p{round(100 * p)}_us") for p in shares]
    return running.groupBy("venue", "kind").agg(F.max("total").alias("n"), *out, trunc(F.min("least")).alias("min_us"), trunc(F.max("most")).alias("max_us"))


def failures(depth: DataFrame, venues: DataFrame, frames: DataFrame | None = None) -> DataFrame:
    """venue, message: what fails a captured day. ``venues`` lists all venues with their events.

    The sentences are the report's (fixed values).

    ``frames``, if given, has venue and skipped_ratio, the share of bytes outside frames.
    """
    number = lambda c: F.col(c).cast("string")
    bad = depth.select(
        "venue",
        F.explode(
            F.filter(
                F.array(
                    F.when(F.col("breaks_unexplained") > 0, F.concat("instrument", F.lit(": "), number("breaks_unexplained"), F.lit(" unexplained depth chain break(s)"))),
                    F.when(F.col("unspliced") > 0, F.concat("instrument", F.lit(": "), number("unspliced"), F.lit(" snapshot(s) never spliceable against the update stream"))),
                    F.when(F.col("missing_snapshot"), F.concat("instrument", F.lit(": depth updates but no REST snapshot all file"))),
                ),
                lambda x: x.isNotNull(),
            )
        ).alias("message"),
    )
    bad = bad.unionByName(venues.where("events = 0").select("venue", F.lit("file contains zero decodable events").alias("message")))
    if frames is not None:
        ratio = F.concat(F.lit("corrupt bytes ratio "), F.format_number("skipped_ratio", 4), F.lit(f" exceeds {MAX_SKIPPED}"))
        bad = bad.unionByName(frames.where(F.col("skipped_ratio") > MAX_SKIPPED).select("venue", ratio.alias("message")))
    return bad


def verdict(depth: DataFrame, venues: DataFrame, frames: DataFrame | None = None) -> DataFrame:
    """venue, status, failures: the number of messages that ``failures`` gives."""
    bad = failures(depth, venues, frames)
    found = bad.groupBy("venue").agg(F.count("*").alias("failures"))
    return venues.select("venue").join(found, "venue", "left").select("venue", F.coalesce("failures", F.lit(0)).cast("long").alias("failures")).withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def health_transitions(outcomes: DataFrame, key: str = "label", failures: int = 3) -> DataFrame:
    """Rows at which a poller goes up (first success, or recovery) or down (so many failures in a row)."""
    by = W.partitionBy(key).orderBy("pos")
    runs = outcomes.withColumn("run", F.sum(F.col("ok").cast("int")).over(by))
    in_run = W.partitionBy(key, "run").orderBy("pos")
    n = runs.withColumn("fails", F.sum((~F.col("ok")).cast("int")).over(in_run))
    before = n.withColumn("was", F.coalesce(F.lag("fails").over(by), F.lit(failures)))
    # the first success comes up whatever went before it
    up = F.col("ok") & ((F.col("run") == 1) | (F.col("was") >= failures))
    return before.withColumn("state", F.when(up, "up").when(~F.col("ok") & (F.col("fails") == failures), "down")).where("state IS NOT NULL").select(key, "pos", "state")


def session_first_updates(updates: DataFrame, downs: DataFrame) -> DataFrame:
    """The first update of each instrument in each session of its source; a loss ends a session."""
    asked = session_of(updates.select("venue", "source", "instrument", F.col("pos").alias("at")), downs)
    return asked.groupBy("venue", "source", "session", "instrument").agg(F.min("at").alias("pos"))
