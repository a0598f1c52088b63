"""Reference data: validity windows, point-in-time joins, history folding, universe changes."""

from __future__ import annotations

import heapq
import itertools

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewright.functions.market import covers, day_of

#: An end that is later than any time.
FOREVER = 2**63 - 1
#: Windows of a key that a fact is compared with at most.
PAGE = 64


def point_in_time(facts: DataFrame, dims: DataFrame, keys: list[str], at: str, order: list[str] | None = None, how: str = "inner") -> DataFrame:
    """Facts with the dimension row whose window holds ``at``.

    Dimension columns valid_from and valid_to are dropped. Where windows may
    overlap, ``order`` names the dimension columns by which the first one wins.
    The join is on the keys with the window as a condition, so Spark picks the
    side to broadcast by its size.
    """
    f, d = facts.alias("f"), dims.alias("d")
    on = [F.col(f"f.{k}") == F.col(f"d.{k}") for k in keys] + [covers(F.col(f"f.{at}"), F.col("d.valid_from"), F.col("d.valid_to"))]
    extra = [c for c in dims.columns if c not in {*keys, "valid_from", "valid_to"}]
    if not order:
        return f.join(d, on, how).select("f.*", *(F.col(f"d.{c}") for c in extra))
    numbered = facts.withColumn("_row", F.monotonically_increasing_id()).alias("f")
    best = numbered.join(d, on, how).withColumn("_n", F.row_number().over(W.partitionBy("_row").orderBy(*(F.col(f"d.{c}") for c in order)))).where("_n = 1")
    return best.select(*(F.col(f"f.{c}") for c in facts.columns), *(F.col(f"d.{c}") for c in extra))


def disjoint_windows(dims: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows of ``dims`` with windows that do not overlap: where several of a key cover a time, the first by ``order`` has it.

    Ties go to the window that starts, then ends, first. Windows without a start, or that
    end before they start, cover nothing. Only keys with overlaps are swept, each once over
    its starts and ends with the open windows in a heap; a row may come out with several
    windows.
    """
    good = dims.where("valid_from IS NOT NULL AND (valid_to IS NULL OR valid_to > valid_from)")
    by = W.partitionBy(*keys)
    earlier = by.orderBy("valid_from").rowsBetween(W.unboundedPreceding, -1)
    reached = F.max(F.coalesce("valid_to", F.lit(FOREVER))).over(earlier)
    overlaps = good.select(*keys, (reached > F.col("valid_from")).alias("_over")).where("_over").select(*keys).distinct()
    clean, mixed = good.join(overlaps, keys, "left_anti"), good.join(overlaps, keys, "left_semi")
    # sorted by Spark, so that nulls and ties go as they do elsewhere
    ends = F.coalesce("valid_to", F.lit(FOREVER))
    ranked = mixed.withColumn("_place", F.row_number().over(by.orderBy(*order, "valid_from", ends)))

    def sweep(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("valid_from")
        begin, until, place = (rows[c].tolist() for c in ("valid_from", "_end", "_place"))
        times = sorted({*begin, *until})
        waiting: list[tuple[int, int]] = []
        out: list[list[int]] = []
        at = 0
        for t, nxt in itertools.pairwise(times):
            while at < len(begin) and begin[at] <= t:
                heapq.heappush(waiting, (place[at], until[at]))
                at += 1
            while waiting and waiting[0][1] <= t:
                heapq.heappop(waiting)
            if waiting and out and out[-1][0] == waiting[0][0] and out[-1][2] == t:
                out[-1][2] = nxt
            elif waiting:
                out.append([waiting[0][0], t, nxt])
        return pd.DataFrame([(*rows[keys].iloc[0], *o) for o in out], columns=[*keys, "_place", "_from", "_to"])

    kinds = ", ".join(f"`{k}` {dims.schema[k].dataType.simpleString()}" for k in keys)
    swept = ranked.select(*keys, "_place", "valid_from", ends.alias("_end")).groupBy(*keys).applyInPandas(sweep, f"{kinds}, _place INT, _from BIGINT, _to BIGINT")
    parts = ranked.join(swept, [*keys, "_place"]).withColumns({"valid_from": F.col("_from"), "valid_to": F.when(F.col("_to") < FOREVER, F.col("_to"))})
    return clean.select(*dims.columns).unionByName(parts.select(*dims.columns))


def first_covering(facts: DataFrame, dims: DataFrame, keys: list[str], at: str, order: list[str], how: str = "inner", folded: tuple[str, ...] = ()) -> DataFrame:
    """Facts with the first row of ``dims`` (by ``order``) whose window holds ``at``: at most one for each fact.

    Which row that is, is settled before the join (``disjoint_windows``). Keys named in
    ``folded`` are compared in lower case. ``how`` is inner or left; null keys and times
    meet nothing. Keys with few windows are met by an equi-join with the window as a
    condition. Where a key has more than ``PAGE``, a key's windows are pages of so many in
    the order of their starts; a fact finds its page among those that begin on its day, or
    takes the last one before, and meets that page only.
    """
    columns = [c for c in dims.columns if c not in {*keys, "valid_from", "valid_to"}]
    k = [f"_{x}" for x in keys]
    own = lambda df: df.withColumns({f"_{x}": F.lower(x) if x in folded else F.col(x) for x in keys})
    f, d = own(facts), disjoint_windows(own(dims).drop(*keys), k, order)
    most = d.groupBy(*k).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if most <= PAGE:
        row = F.struct(*columns, F.lit(True).alias("_hit"))
        w = d.select(*(F.col(c).alias(f"d{c}") for c in k), "valid_from", "valid_to", row.alias("_row"))
        on = [F.col(c) == F.col(f"d{c}") for c in k] + [covers(F.col(f"f.{at}"), F.col("d.valid_from"), F.col("d.valid_to"))]
        out = f.alias("f").join(w.alias("d"), on, how)
    else:
        by = W.partitionBy(*k).orderBy("valid_from")
        d = d.withColumn("_page", F.floor((F.row_number().over(by) - 1) / PAGE))
        pages = d.groupBy(*k, "_page").agg(F.collect_list(F.struct("valid_from", "valid_to", *columns)).alias("_own"), F.min("valid_from").alias("_start"))
        begun = pages.groupBy(*k, day_of(F.col("_start")).alias("_day")).agg(F.collect_list(F.struct("_start", "_page")).alias("_starts"))
        asked = f.select(*k, day_of(F.col(at)).alias("_day")).dropna().distinct()
        before = W.partitionBy(*k).orderBy("_day").rowsBetween(W.unboundedPreceding, -1)
        days = asked.join(begun, [*k, "_day"], "full_outer").withColumn("_last", F.max(F.array_max(F.col("_starts._page"))).over(before))
        started = F.array_max(F.transform(F.filter("_starts", lambda x: x["_start"] <= F.col(at)), lambda x: x["_page"]))
        found = f.withColumn("_day", day_of(F.col(at))).join(days, [*k, "_day"], "left").withColumn("_page", F.coalesce(started, F.col("_last"))).drop("_starts", "_last", "_day")
        hit = F.filter("_own", lambda x: covers(F.col(at), x["valid_from"], x["valid_to"]))
        out = found.join(pages.drop("_start"), [*k, "_page"], "left").withColumn("_row", F.get(hit, 0))
        out = out.where("_row IS NOT NULL") if how == "inner" else out
    return out.select(*(F.col(c) for c in facts.columns), *(F.col(f"_row.{c}").alias(c) for c in columns))


def listed_everywhere(mapping: DataFrame, venues: list[str], at: int, key: str = "canonical") -> DataFrame:
    """Keys that every one of ``venues`` lists at a time."""
    live = mapping.where(covers(F.lit(at), F.col("valid_from"), F.col("valid_to")) & F.col("venue").isin(*venues))
    return live.groupBy(key).agg(F.countDistinct("venue").alias("n")).where(F.col("n") == len(set(venues))).select(key)


def matched_keys(mapping: DataFrame, venues: list[str], at: int, key: str = "canonical") -> DataFrame:
    """The same, ascending."""
    return listed_everywhere(mapping, venues, at, key).orderBy(key)


def apply_overrides(mapping: DataFrame, overrides: DataFrame) -> DataFrame:
    """Mapping rows patched or dropped by (venue, instrument) overrides; the last one of a key wins.

    Overrides have venue, instrument, exclude, pos, and those of base, quote and settle
    that they patch, as far as the mapping has them.
    """
    patched = [c for c in ("base", "quote", "settle") if c in overrides.columns and c in mapping.columns]
    last = overrides.withColumn("_n", F.row_number().over(W.partitionBy("venue", "instrument").orderBy(F.desc("pos")))).where("_n = 1")
    o = last.select("venue", F.lower("instrument").alias("instrument"), "exclude", *(F.col(c).alias(f"_{c}") for c in patched))
    out = mapping.join(o, ["venue", "instrument"], "left").where(~F.coalesce("exclude", F.lit(False)))
    new = {c: F.coalesce(f"_{c}", c) for c in patched}
    return out.withColumns(new | {"origin": F.when(F.col("exclude").isNotNull(), "override").otherwise("dump")}).drop("exclude", *(f"_{c}" for c in patched))


def build_summary(mapping: DataFrame, overrides: DataFrame) -> DataFrame:
    """venue, rows, overridden, excluded: rows that stay after the overrides, those they patch, and those they drop."""
    last = overrides.groupBy("venue", F.lower("instrument").alias("instrument")).agg(F.max_by("exclude", "pos").alias("exclude"))
    met = mapping.select("venue", "instrument").join(last, ["venue", "instrument"], "left")
    gone = F.coalesce("exclude", F.lit(False))
    return met.groupBy("venue").agg(F.count_if(~gone).alias("rows"), F.count_if(F.col("exclude").isNotNull() & ~gone).alias("overridden"), F.count_if(gone).alias("excluded"))


def build_record(mapping: DataFrame, overrides: DataFrame, dumps: DataFrame, venues: list[str], at: int, key: Column) -> DataFrame:
    """One row: what a mapping was built from and what came of it.

    built_at, inputs (venue -> day of the dump used, the latest of ``dumps``: venue,
    dump_day), rows_per_venue, matched (keys that all ``venues`` list at the time),
    overridden and excluded. ``key`` is made of the mapping's columns as the overrides leave
    them.
    """
    latest = dumps.groupBy("venue").agg(F.max("dump_day").alias("day"))
    inputs = latest.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("venue", "day")))).alias("inputs"))
    summary = build_summary(mapping, overrides)
    counts = summary.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("venue", "rows")))).alias("rows_per_venue"), F.sum("overridden").alias("overridden"), F.sum("excluded").alias("excluded"))
    matched = listed_everywhere(apply_overrides(mapping, overrides).withColumn("_key", key), venues, at, "_key").agg(F.count("*").alias("matched"))
    # each of the three is one row
    return inputs.crossJoin(counts).crossJoin(matched).withColumn("built_at", F.lit(at))


def as_windows(dated: DataFrame, keys: list[str], start: str = "valid_from") -> DataFrame:
    """Dated rows with ``valid_to``: the start of the key's next row."""
    return dated.withColumn("valid_to", F.lead(start).over(W.partitionBy(*keys).orderBy(start)))


def fold_history(snapshots: DataFrame, attributes: list[str], key: str = "symbol", day: str = "dump_day", days: DataFrame | None = None) -> DataFrame:
    """Validity windows of unchanged attributes over dump days.

    A change or a missing dump closes a window at the next day on which there was any
    dump. Nulls equal nulls. The days are a short table of their own: ``days`` where
    given, which may have days whose dumps list nothing, else those of ``snapshots``.
    """
    days = (snapshots if days is None else days).select(day).distinct()
    in_order = W.orderBy(day)
    days = days.select(day, F.row_number().over(in_order).alias("_rank"), F.lead(day).over(in_order).alias("_next"))
    by = W.partitionBy(key).orderBy(day)
    ranked = snapshots.select(key, day, *attributes).join(F.broadcast(days), day)
    same = F.lit(True)
    for a in attributes:
        same = same & F.lag(a).over(by).eqNullSafe(F.col(a))
    opened = ranked.withColumn("_new", F.when((F.lag("_rank").over(by) == F.col("_rank") - 1) & same, 0).otherwise(1))
    island = opened.withColumn("_island", F.sum("_new").over(by))
    return island.groupBy(key, "_island").agg(
        *(F.first(a).alias(a) for a in attributes), F.min(day).alias("valid_from"), F.max_by("_next", day).alias("valid_to")
    ).drop("_island")


def history(snapshots: DataFrame, attributes: list[str], key: str = "symbol", day: str = "dump_day", days: DataFrame | None = None) -> DataFrame:
    """``fold_history`` in the order of its table: by key, then start."""
    return fold_history(snapshots, attributes, key, day, days).orderBy(key, "valid_from")


def carried_forward(days: DataFrame, dumps: DataFrame, key: str = "symbol", day: str = "dump_day") -> DataFrame:
    """For every day and key the value of the latest dump on or before it, if that dump has the key.

    ``days`` has key and day; ``dumps`` key, day and value. A dump replaces the whole
    earlier map.
    """
    dump_days = dumps.select(day).distinct().withColumn("_dump", F.col(day))
    all_days = days.select(day).distinct().join(dump_days, day, "left")
    used = all_days.withColumn("_used", F.last("_dump", ignorenulls=True).over(W.orderBy(day))).select(day, "_used")
    values = dumps.select(F.col(key), F.col(day).alias("_used"), "value")
    return days.join(F.broadcast(used), day).join(values, [key, "_used"], "left").drop("_used")


def changes(before: DataFrame, after: DataFrame, keys: list[str], attributes: list[str]) -> DataFrame:
    """keys, change: added, changed or delisted between two snapshots."""
    side = lambda df: df.select(*keys, F.struct(*attributes).alias("row"))
    both = side(before).withColumnRenamed("row", "old").join(side(after).withColumnRenamed("row", "new"), keys, "full_outer")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "delisted").when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    return both.withColumn("change", change).where("change IS NOT NULL").select(*keys, "change")


def consecutive_changes(snapshots: DataFrame, attributes: list[str], key: str = "symbol", day: str = "dump_day") -> DataFrame:
    """Changes between each dump day and the one before; on the first day all are ``baseline``."""
    days = snapshots.select(day).distinct().select(day, F.lag(day).over(W.orderBy(day)).alias("_before"), F.lead(day).over(W.orderBy(day)).alias("_after"))
    s = snapshots.select(key, day, F.struct(*attributes).alias("row")).join(F.broadcast(days), day)
    old = s.select(key, F.col("_after").alias(day), F.col("row").alias("old")).where(F.col(day).isNotNull())
    both = s.select(key, day, "_before", F.col("row").alias("new")).join(old, [key, day], "full_outer")
    kind = (
        F.when(F.col("new").isNull(), "delisted").when(F.col("_before").isNull(), "baseline").when(F.col("old").isNull(), "added").when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    )
    return both.withColumn("change", kind).where("change IS NOT NULL").select(key, day, "change")


def fee_violations(fees: DataFrame, limit: float = 0.05) -> DataFrame:
    """Fee rows whose rates are not finite or too large, or whose date is missing."""
    bad = lambda c: F.col(c).isNull() | F.isnan(c) | (F.abs(c) > limit)
    return fees.where(bad("maker") | bad("taker") | F.col("valid_from").isNull())


def unknown_instruments(configured: DataFrame, universe: DataFrame, key: str = "instrument") -> DataFrame:
    return configured.join(universe.select(key).distinct(), key, "left_anti")
