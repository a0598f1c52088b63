"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Every source is a queue whose documents wait in shuffled order, up to two
rounds of them. A long document waits as packets of at most ``packet`` words.
A packet's virtual finish time is the number of words its source has sent up
to its end, divided by the source's target. All packets are ranged by finish
time, and the mix ends where the total budget is used up.

Packets leave a queue in order, so what a source sends is known from one number, the
words it has sent when the mix ends. As the targets add up to the budget, that is near
virtual time 1: packets that finish by then are taken without looking at them, and only
the few around it are ranged one by one. A document's share then follows from its
bucket of the shuffle order, and in the bucket where its source ends from its place
there. So no task sees a whole source, no text is shuffled, and the windows without
a small bucket run over a row or a few for each source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewright.llm.common import cut, stored, words

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: The mix's words as a share of all words, and the most rounds of one source.
BUDGET, MAX_ROUNDS = 1.5, 2
#: Words of a packet.
PACKET = 256
#: Buckets of the shuffle order within a source.
ORDER_BUCKETS = 4096


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carried: bool = False) -> DataFrame:
    """row, doc_id, source, words, shuffle key and its bucket of each row; a null text has no words.

    The key is a hash of the id and the text, so that rows of one id, or of none, do not
    share a bucket. With ``carried`` the whole row comes too, as the struct ``whole``.
    """
    digest = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    key = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), digest).cast("binary"))
    whole = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole")] if carried else []
    out = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.size(words(F.col(text_col))).cast("long").alias("size"), key.alias("key"), *whole
    )
    return out.withColumn("bucket", _order_bucket())


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, rounds: int = MAX_ROUNDS) -> DataFrame:
    """source, source_size, target: the budget by weight, at most ``rounds`` times a source's size.

    Sharing out the excess again and again ends where every source gets
    ``min(rounds * size, level * weight)``; the level follows from running sums
    over the sources in the order in which they fill up. One row for each
    source: the windows here are over that short table.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = by_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")))
    fill = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    rest = fill.rowsBetween(0, W.unboundedFollowing)
    total = F.sum("source_size").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    level = (total * F.lit(budget) - rounds * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(rest)
    leveled = ranked.withColumn("level", level).withColumn("capped", F.col("level") * F.col("weight") >= rounds * F.col("source_size"))
    # the sources that fill up come first in this order; the others share the first level at which one does not
    shared = F.first(F.when(~F.col("capped"), F.col("level")), ignorenulls=True).over(fill.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    full = F.coalesce(F.max(F.col("capped").cast("int")).over(fill.rowsBetween(0, W.unboundedFollowing)), F.lit(0)) == 1
    target = F.when(full, rounds * F.col("source_size")).otherwise(F.least(rounds * F.col("source_size"), shared * F.col("weight")))
    return leveled.select("source", "source_size", target.cast("double").alias("target"))


def _order_bucket() -> Column:
    return (F.conv(F.substring("key", 1, 4), 16, 10).cast("long") / F.lit(65536 // ORDER_BUCKETS)).cast("long")


def _ends(sized: DataFrame, goal: DataFrame, packet: int) -> tuple[DataFrame, DataFrame]:
    """Where the sources end, and the rows about there.

    First: source, source_size, target, sent (words that the mix takes of it), and for
    both rounds the bucket that holds the end (-1: before all, ORDER_BUCKETS: after all).
    Second: row, start of the rows in buckets around the ends.
    """
    per_bucket = sized.where("size > 0").groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)) - F.col("words")
    buckets = per_bucket.withColumn("before", upto).withColumnRenamed("source", "s").join(goal, F.col("s").eqNullSafe(F.col("source"))).drop("s")
    # from virtual time 1 on at most a packet of each source is left of the budget; the sources that are
    # not used up send that much, and a packet each, by this time
    open_ = F.sum(F.when(F.col("target") < MAX_ROUNDS * F.col("source_size"), F.col("target")))
    bound = goal.agg(F.floor(F.sum("source_size") * F.lit(BUDGET)).alias("budget"), (2 * packet * F.count("*") / open_).alias("late"))
    buckets = buckets.join(F.broadcast(bound), F.lit(True)).withColumn("until", F.col("target") * (1 + F.coalesce("late", F.lit(0.0))) + 2 * packet)
    rounds = F.explode(F.sequence(F.lit(0), F.lit(MAX_ROUNDS - 1)))
    begins = F.col("round") * F.col("source_size") + F.col("before")
    near = stored(buckets.withColumn("round", rounds).where((begins + F.col("words") >= F.col("target")) & (begins <= F.col("until"))))
    once = near.select(F.col("source").alias("s"), F.col("bucket").alias("b"), "before").distinct()
    inside = F.sum("size").over(W.partitionBy("source", "bucket").orderBy("key", "row").rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    narrow = sized.select("row", "source", "bucket", "key", "size").where("size > 0")
    rows = narrow.join(once, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")), "inner").withColumn("start", F.col("before") + inside)
    rows = stored(rows.select("row", "source", "bucket", "key", "size", "start"))
    at = near.select(F.col("source").alias("s"), F.col("bucket").alias("b"), "round", "source_size", "target", "until")
    placed = rows.join(at, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).withColumn("p", F.col("round") * F.col("source_size") + F.col("start"))
    whole = F.when(F.col("p") + F.col("size") <= F.col("target"), F.col("size")).otherwise(F.floor((F.col("target") - F.col("p")) / packet) * packet)
    sure = placed.where("p <= target").groupBy("source").agg(F.max(F.col("p") + whole).cast("long").alias("sure"))
    sure = cut(goal.select(F.col("source").alias("g"), "target").join(sure, F.col("g").eqNullSafe(F.col("source")), "left").select(F.col("g").alias("source"), F.coalesce("sure", F.lit(0)).alias("sure")))
    left = bound.join(F.broadcast(sure.agg(F.coalesce(F.sum("sure"), F.lit(0)).alias("used"))), F.lit(True)).select((F.col("budget") - F.col("used")).alias("left"))
    # packets about the end, ranged one by one
    late = placed.join(sure.withColumnRenamed("source", "g"), F.col("source").eqNullSafe(F.col("g"))).where((F.col("p") + F.col("size") > F.col("sure")) & (F.col("p") < F.col("until")))
    first = F.greatest(F.lit(0).cast("long"), F.floor((F.col("sure") - F.col("p")) / packet)) + 1
    last = F.least(F.ceil(F.col("size") / packet), F.ceil((F.col("until") - F.col("p")) / packet))
    packets = late.select("*", F.explode(F.sequence(first, F.greatest(first, last))).alias("n")).where(F.col("n") <= F.ceil(F.col("size") / packet))
    end = F.least(F.col("n") * packet, F.col("size"))
    packets = packets.withColumns({"words": end - (F.col("n") - 1) * packet, "finish": (F.col("p") + end) / F.col("target")}).where(F.col("p") + end > F.col("sure"))
    running = F.sum("words").over(W.orderBy("finish", "key", "round", "n", "row").rowsBetween(W.unboundedPreceding, 0)) - F.col("words")
    extra = packets.withColumn("running", running).join(F.broadcast(left), F.lit(True)).withColumn("more", F.greatest(F.lit(0), F.least(F.col("words"), F.col("left") - F.col("running"))))
    extra = extra.groupBy("source").agg(F.sum("more").alias("more"))
    sent = sure.join(extra.withColumnRenamed("source", "g"), F.col("source").eqNullSafe(F.col("g")), "left").select("source", (F.col("sure") + F.coalesce("more", F.lit(0))).alias("sent"))
    sent = goal.join(sent.withColumnRenamed("source", "g"), F.col("source").eqNullSafe(F.col("g"))).drop("g")
    # the bucket in which each round ends: one of the near ones, or none
    of = near.select(F.col("source").alias("g"), "bucket", "round", "before", "words")
    met = sent.join(of, F.col("source").eqNullSafe(F.col("g")), "left").withColumn("reach", F.col("sent") - F.col("round") * F.col("source_size"))
    holds = (F.col("reach") > F.col("before")) & (F.col("reach") < F.col("before") + F.col("words"))
    here = lambda r: F.max(F.when(holds & (F.col("round") == r), F.col("bucket")))
    # before an end that lies between two buckets all buckets up to the one that ends there are whole
    upto = lambda r: F.max(F.when((F.col("round") == r) & (F.col("reach") >= F.col("before") + F.col("words")), F.col("bucket")))
    least = lambda r: F.min(F.when(F.col("round") == r, F.col("bucket")))
    ends = met.groupBy("source").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.first("sent").alias("sent"),
        *(x for r in range(MAX_ROUNDS) for x in (here(r).alias(f"here{r}"), F.coalesce(here(r), upto(r) + 1, least(r)).alias(f"from{r}"))),
    )
    for r in range(MAX_ROUNDS):
        reach = F.col("sent") - r * F.col("source_size")
        ends = ends.withColumn(f"from{r}", F.when(reach <= 0, 0).when(reach >= F.col("source_size"), ORDER_BUCKETS).otherwise(F.col(f"from{r}")))
    return stored(ends), rows.select("row", "start")


def _taken(sized: DataFrame, packet: int) -> DataFrame:
    """The stored rows of ``sizes`` with source_size, target and taken."""
    goal = cut(targets(sized))
    ends, starts = _ends(sized, goal, packet)
    all_ = sized.join(ends.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    at_end = F.lit(False)
    for r in range(MAX_ROUNDS):
        at_end = at_end | F.coalesce(F.col("bucket") == F.col(f"here{r}"), F.lit(False))
    at_end = at_end & (F.col("size") > 0)
    rounds = sum(((F.col("bucket") < F.col(f"from{r}")).cast("long") for r in range(MAX_ROUNDS)), F.lit(0).cast("long"))
    plain = all_.where(~at_end).withColumn("taken", F.col("size") * rounds)
    share = lambda r: F.least(F.col("size"), F.greatest(F.lit(0), F.col("sent") - r * F.col("source_size") - F.col("start")))
    edge = all_.where(at_end).join(starts, "row").withColumn("taken", sum((share(r) for r in range(MAX_ROUNDS)), F.lit(0)))
    return plain.unionByName(edge.select(*plain.columns))


def mix(docs: DataFrame, packet: int = PACKET, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, taken for each row of ``docs``.

    ``taken`` counts the words that the mix takes of a document, from its start,
    in both rounds together. Empty documents are taken with no words. Rows that
    share an id are separate documents; those that share their text too are next to
    each other in the shuffle. The same table gives the same mix each time, however its
    rows are dealt: ties in the finish time go by the key, and rows of one key are equal
    in all that counts. Very long texts are packets like others; an empty table gives no rows.
    """
    return _taken(stored(sizes(docs, id_col, text_col, source_col)), packet).select("doc_id", "source", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


def emit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", packet: int = PACKET) -> DataFrame:
    """The rows of the mix: ``docs`` as often as taken, the last copy cut after its last word.

    Documents of which nothing is taken, and those without words, are left out.
    ``n_chars``, if there, is counted anew where a text was cut. Rows are stored with
    their sizes and read again, so other columns may have any name.
    """
    both = _taken(stored(sizes(docs, id_col, text_col, source_col, carried=True)), packet).where("taken > 0")
    copies = F.filter(F.array(F.least("taken", "size"), F.col("taken") - F.least("taken", "size")), lambda n: n > 0)
    out = both.select("whole", "size", F.explode(copies).alias("words"))
    own = lambda c: F.col("whole").getField(c)
    gap, word = r"[ \t-\r]", r"[^ \t-\r]"
    first = F.concat(F.lit(f"^{gap}*+(?:{word}++{gap}++){{"), (F.col("words") - 1).cast("string"), F.lit(f"}}+{word}++"))
    text = F.when(F.col("words") == F.col("size"), own(text_col)).otherwise(F.regexp_substr(own(text_col), first))
    columns = {text_col: text}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col("words") == F.col("size"), own("n_chars")).otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType)
    return out.select(*(columns.get(c, own(c)).alias(c) for c in docs.columns))


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    from tidewright.llm.common import read

    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '')) AS BIGINT) AS size,
         md5(concat('mix:', coalesce(CAST(doc_id AS VARCHAR), 'null'), ':', md5(coalesce(text, '')))) AS key FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, list_value(5, 2, 1)[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight FROM d GROUP BY source
), r AS (
  SELECT *, (sum(source_size) OVER () * 1.5 - 2 * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM s WINDOW o AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST)
), g AS (
  SELECT source, source_size, CASE WHEN level * weight >= 2 * source_size THEN 2.0 * source_size
         ELSE (SELECT min_by(level, source_size::DOUBLE / weight) FROM r WHERE level * weight < 2 * source_size) * weight END::DOUBLE AS target FROM r
), q AS (
  SELECT d.*, g.source_size, g.target, sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size, rid ROWS UNBOUNDED PRECEDING) - size AS start
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
), p AS (
  SELECT rid, key, round, n, least(n * 256, size) - (n - 1) * 256 AS words, ((round * source_size + start + least(n * 256, size))::DOUBLE / target) AS finish
  FROM (SELECT *, unnest(range(1, (size + 255) // 256 + 1)) AS n FROM (SELECT *, unnest([0, 1]) AS round FROM q WHERE size > 0))
), c AS (
  SELECT rid, words, sum(words) OVER (ORDER BY finish, key, round, n, rid ROWS UNBOUNDED PRECEDING) AS upto, (SELECT floor(sum(size) * 1.5) FROM d) AS budget FROM p
), t AS (
  SELECT rid, CAST(sum(greatest(0, least(words, budget - upto + words))) AS BIGINT) AS taken FROM c GROUP BY rid
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM q LEFT JOIN t USING (rid)
"""
