"""Quality rules with host verdicts, in DataFrame functions only.

Each document gets rule statistics over its whole text, and from them its strain:
how much of the limit of the soft rule that it comes nearest to it uses up (above 1
it fails that rule). A host is judged by the share of its documents that fail any
rule, shrunk towards the share of all documents by a beta prior. The prior is a
beta-binomial fit to the hosts by moments: the spread of the hosts' rates that their
numbers of documents do not explain sets its weight, so that a host of one document
is not condemned on one failure.

The host verdict is joined back as an allowance for the strain of the host's documents:
the share of failures among all documents divided by the host's own, between a half and
two. A host that fails as often as all do leaves the limits where they are, one that
fails twice as often halves them, one that fails half as often doubles them. Base rules
are not touched by it.

Only counts leave the scan: the text is read once, the statistics (a few
numbers for each document) are stored, and the join back is on a salted
host key, so that a host with a third of all documents does not end up in one
task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import cut, let, stored, words

MIN_WORDS = 10
WINDOW = 5
MAX_REPEAT_PERCENT = 20
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
MEAN_WORD_CHARS = (3, 12)
#: Least and most that a host's verdict makes of the soft limits.
LEAST, MOST = 0.5, 2.0
#: Most weight of the prior, in documents: where the hosts' rates differ no more than chance has it.
MAX_WEIGHT = 100.0
SALTS = 64
#: Hosts that are broadcast; more are joined by shuffle.
FEW_HOSTS = 100_000


def repeated_words(tokens: Column, window: int = WINDOW) -> Column:
    """Number of words that lie in a window found twice or more in ``tokens``.

    Windows are compared by 64-bit hash. Texts without a repeated window, by
    far the most, stop after one hash set.
    """

    def covered(hashes: Column) -> Column:
        keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = let(
            keyed,
            lambda k: F.array_sort(
                F.transform(
                    F.filter(k, lambda x, j: (x["h"] == F.get(k, j - 1)["h"]) | F.coalesce(x["h"] == F.get(k, j + 1)["h"], F.lit(False))),
                    lambda x: x["i"],
                )
            ),
        )
        # a start covers a whole window, or as much of it as lies before the next start
        steps = let(starts, lambda s: F.transform(s, lambda p, j: F.least(F.lit(window), F.coalesce(F.get(s, j + 1) - p, F.lit(window)))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def counted(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - window), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(window))))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))

    return let(tokens, lambda w: F.when(F.size(w) > window, counted(w)).otherwise(0)).cast("long")


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row for each document: id, host and rule statistics.

    Null and empty texts count as having no words and no lines. Rows that share
    an id are separate documents. Columns other than the three named are not read,
    so their names cannot clash.
    """
    return docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), measured(F.col(text_col)).alias("q")).select("doc_id", "host", "q.*")


def measured(text: Column) -> Column:
    """The statistics of a text, as a struct."""

    def of(t: Column) -> Column:
        w = let(words(t), lambda w: F.struct(F.size(w).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("chars"), repeated_words(w).alias("repeat")))
        lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.trim(F.translate(x, "\t\x0b\x0c\r", ""))) > 0)
        l = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))  # noqa: E741
        symbols = (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long")
        return let(F.struct(w.alias("w"), l.alias("l"), symbols.alias("s")), lambda x: F.struct(
            x["w"]["n"].alias("n_words"), x["w"]["chars"].alias("word_chars"), x["w"]["repeat"].alias("n_repeat_words"),
            x["l"]["n"].alias("n_lines"), x["l"]["dup"].alias("n_dup_lines"), x["s"].alias("n_symbols")))

    return let(F.coalesce(text, F.lit("")), of)


def base_failed(of: str = "") -> Column:
    """Whether the statistics (columns, or fields of the struct ``of``) fail a base rule."""
    c = lambda name: F.col(f"{of}.{name}" if of else name)
    return (c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > MAX_REPEAT_PERCENT * c("n_words"))


def strain(of: str = "") -> Column:
    """The largest share of a soft limit that the statistics use up; above 1 the rule fails."""
    c = lambda name: F.col(f"{of}.{name}" if of else name).cast("double")
    part = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return F.greatest(
        part(100 * c("n_symbols"), MAX_SYMBOL_PERCENT * c("n_words")),
        part(100 * c("n_dup_lines"), MAX_DUP_LINE_PERCENT * c("n_lines")),
        part(100 * c("n_repeat_words"), MAX_REPEAT_PERCENT * c("n_words")),
    )


def odd_words(of: str = "") -> Column:
    """Whether words are too short or too long on average; no host's verdict makes up for that."""
    c = lambda name: F.col(f"{of}.{name}" if of else name)
    low, high = MEAN_WORD_CHARS
    return (c("word_chars") < low * c("n_words")) | (c("word_chars") > high * c("n_words"))


def host_verdicts(judged: DataFrame) -> DataFrame:
    """One row for each host: documents n, failures, shrunk host_rate, allowance.

    ``judged`` has host, base_failed, odd_words and strain. A null host is a host of its
    own. The prior comes from one row of sums, attached to each host by a join on a
    constant key. If no document fails, or all do, every allowance is 1.
    """
    fails = F.col("base_failed") | F.col("odd_words") | (F.col("strain") > 1)
    hosts = judged.groupBy("host").agg(F.count("*").alias("n"), F.sum(fails.cast("long")).alias("failed")).withColumn("one", F.lit(1))
    square = F.col("failed").cast("double") * F.col("failed") / F.col("n")
    sums = hosts.groupBy("one").agg(
        F.count("*").alias("h"), F.sum("n").alias("all_n"), F.sum("failed").alias("all_failed"), F.sum(square).alias("ff"), F.sum(F.col("n").cast("double") * F.col("n")).alias("nn")
    )
    m = F.col("all_failed") / F.col("all_n")
    noise = F.col("h") - 1
    spread = (F.col("ff") - F.col("all_n") * m * m) / (m * (1 - m)) - noise
    room = F.col("all_n") - F.col("nn") / F.col("all_n") - noise
    weight = F.when((m > 0) & (m < 1) & (spread > 0) & (room > 0), F.least(F.greatest(room / spread - 1, F.lit(1.0)), F.lit(MAX_WEIGHT))).otherwise(MAX_WEIGHT)
    prior = sums.select("one", m.alias("m"), weight.alias("k"))
    rate = (F.col("failed") + F.col("m") * F.col("k")) / (F.col("n") + F.col("k"))
    allowance = F.when(F.col("host_rate") > 0, F.least(F.greatest(F.col("m") / F.col("host_rate"), F.lit(LEAST)), F.lit(MOST))).otherwise(1.0)
    return hosts.join(F.broadcast(prior), "one").withColumn("host_rate", rate).select("host", "n", "failed", "host_rate", allowance.alias("allowance"))


def verdict() -> Column:
    """Whether a document is kept, from base_failed, odd_words, strain and its host's allowance."""
    return ~F.col("base_failed") & ~F.col("odd_words") & (F.col("strain") <= F.col("allowance"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Statistics, base failure, host rate, allowance and verdict for each row of ``docs``.

    A document is kept unless it fails a base rule, its words are odd, or its strain is
    above its host's allowance. An empty table gives no rows.
    """
    judged = cut(statistics(docs, id_col, text_col, host_col).withColumns({"base_failed": base_failed(), "odd_words": odd_words(), "strain": strain()}))
    salted = judged.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)))
    verdicts = host_verdicts(judged).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))
    out = salted.alias("d").join(verdicts.alias("h"), (F.col("d.salt") == F.col("h.salt")) & F.col("d.host").eqNullSafe(F.col("h.host")), "left")
    return out.select(
        "doc_id", F.col("d.host").alias("host"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "odd_words", "strain", "host_rate", "allowance", verdict().alias("kept")
    )


def keep(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``docs`` without the rejected ones; columns, whatever their names, and repeated rows stay as they are.

    Rows are stored once with their measures beside them; the hosts are then counted
    from the measures alone, and the rows read again with their host's allowance.
    Up to ``FEW_HOSTS`` hosts are broadcast, so that no text is shuffled.
    """
    q = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(host_col).alias("host"), measured(F.col(text_col)).alias("q"))
    q = stored(q.select("row", "host", base_failed("q").alias("base_failed"), odd_words("q").alias("odd_words"), strain("q").alias("strain")))
    hosts = cut(host_verdicts(q).select(F.col("host").alias("of"), "allowance"))
    if hosts.count() <= FEW_HOSTS:
        q = q.join(F.broadcast(hosts), F.col("host").eqNullSafe(F.col("of")), "left")
    else:
        q = q.withColumn("salt", F.pmod(F.xxhash64(F.col("row").getField(text_col)), F.lit(SALTS)))
        spread = hosts.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))
        q = q.join(spread, (F.col("salt") == F.col("s")) & F.col("host").eqNullSafe(F.col("of")), "left")
    return q.where(verdict()).select("row.*")


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    from tidewright.llm.common import read

    return judge(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, host, t, list_filter(regexp_split_to_array(t, '[ \t-\r]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS ls FROM d
), win AS (
  SELECT rid, i, list_aggregate(ws[i:i+4], 'string_agg', ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)
), dup AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1
), rep AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM dup) GROUP BY rid
), s AS (
  SELECT w.rid, doc_id, host, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN rep USING (rid)
), j AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, word_chars < 3 * n_words OR word_chars > 12 * n_words AS odd_words,
         greatest(CASE WHEN n_words > 0 THEN (100 * n_symbols)::DOUBLE / (10 * n_words) ELSE 0 END, CASE WHEN n_lines > 0 THEN (100 * n_dup_lines)::DOUBLE / (30 * n_lines) ELSE 0 END,
                  CASE WHEN n_words > 0 THEN (100 * n_repeat_words)::DOUBLE / (20 * n_words) ELSE 0 END) AS strain FROM s
), h AS (
  SELECT host, count(*) AS n, sum(CAST(base_failed OR odd_words OR strain > 1 AS INT))::DOUBLE AS failed FROM j GROUP BY host
), a AS (SELECT sum(failed) / sum(n) AS m, count(*) - 1 AS noise, sum(n)::DOUBLE AS total, sum(failed * failed / n) AS ff, sum(n::DOUBLE * n) AS nn FROM h
), e AS (SELECT m, CASE WHEN m > 0 AND m < 1 THEN (ff - total * m * m) / (m * (1 - m)) - noise END AS spread, total - nn / total - noise AS room FROM a
), x AS (SELECT m, CASE WHEN spread > 0 AND room > 0 THEN least(greatest(room / spread - 1, 1.0), 100.0) ELSE 100.0 END AS k FROM e
), v AS (SELECT host, CASE WHEN r > 0 THEN least(greatest(m / r, 0.5), 2.0) ELSE 1.0 END AS allowance FROM (SELECT host, m, (failed + m * k) / (n + k) AS r FROM h, x))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT odd_words AND strain <= allowance AS kept
FROM j JOIN v ON j.host IS NOT DISTINCT FROM v.host
"""
