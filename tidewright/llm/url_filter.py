"""URL filters as a temporal join with dated domain lists.

A list is a log of dated entries: a domain is added, removed, added again. Its
entries become validity intervals, and a capture is evaluated against the
intervals that hold at the time it was fetched, for its host and every parent
domain. A capture from before an entry, or from after its removal, passes.

The as-of join is in two steps: hosts, each once, meet the listed ones of their parent
domains, and captures meet the intervals of their host by an equi-join with a check of
the interval. So the entries of a domain need not meet its captures in one ordered
window. The sides with intervals are repeated over a few salts, which part the hosts of
one popular domain and the captures of one popular host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SALTS = 16
#: Scheme, user and port are not part of a host (a fixed value, also in the SQL below); an address in brackets is one.
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?(\[[0-9a-fA-F:.]+\]|[^/:?#]+)"
#: Longer names are no hosts (a limit of the domain name system).
HOST_CHARS = 253


def host_of(url: Column) -> Column:
    """The lower-case host of a URL without a dot at its end; null where there is none, or one too long."""
    host = F.regexp_replace(F.lower(F.rtrim(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))), r"\.+$", "")
    return F.when(F.length(host).between(1, HOST_CHARS), host)


def intervals(entries: DataFrame) -> DataFrame:
    """domain, valid_from, valid_to (null: still listed) from domain, dated, listed (boolean).

    Of several entries of a domain at one time a removal wins. An entry that
    changes nothing is ignored; entries with a null in them are left out.
    """
    known = entries.select(F.lower("domain").alias("domain"), "dated", "listed").dropna()
    daily = known.groupBy("domain", "dated").agg(F.min("listed").alias("listed"))
    by_date = W.partitionBy("domain").orderBy("dated")
    changes = daily.withColumn("was", F.coalesce(F.lag("listed").over(by_date), F.lit(False))).where("listed <> was")
    spans = changes.withColumn("valid_to", F.lead("dated").over(by_date)).where("listed")
    return spans.select("domain", F.col("dated").alias("valid_from"), "valid_to")


def evaluate(captures: DataFrame, spans: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """id, host, fetched, blocked, matched_domain, listed_since for each row of ``captures``.

    Of several matching domains the longest is named; of intervals of one domain that hold at
    once, the latest. A capture without a host or without a time passes; a name of over
    ``HOST_CHARS`` characters is no host. Repeated rows stay; other columns are not read.
    Without captures nothing is returned, and without intervals all captures pass.

    Each host's parents are met with the listed domains once, however many captures it has, so a
    parent that very many captures share costs one row a host, and no row at all where no
    list has it. A capture then meets only the intervals of its own host.
    """
    host = host_of(F.col(url_col))
    seen = captures.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), host.alias("host"), F.col(time_col).alias("fetched"))
    parts = F.split(F.col("host"), r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    hosts = seen.where("host IS NOT NULL AND fetched IS NOT NULL").select("host").distinct()
    asked = hosts.select("host", F.explode(parents).alias("domain")).withColumn("salt", F.pmod(F.xxhash64("host"), F.lit(SALTS)))
    listed = spans.select("domain", "valid_from", "valid_to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")).alias("salt"))
    of_host = asked.join(listed, ["domain", "salt"]).select(F.col("host").alias("of"), "domain", "valid_from", "valid_to")
    # a host's intervals come to each of its salts, which part the captures of one popular host
    of_host = of_host.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))
    active = (F.col("fetched") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to")))
    met = seen.join(of_host, (F.col("host") == F.col("of")) & (F.pmod(F.col("row"), F.lit(SALTS)) == F.col("deal")) & active, "left")
    best = F.max(F.when(F.col("domain").isNotNull(), F.struct(F.length("domain").alias("n"), "domain", F.col("valid_from").alias("since"))))
    out = met.groupBy("row").agg(F.first("id").alias(id_col), F.first("host").alias("host"), F.first("fetched").alias("fetched"), best.alias("best"))
    return out.select(id_col, "host", "fetched", F.col("best").isNotNull().alias("blocked"), F.col("best.domain").alias("matched_domain"), F.col("best.since").alias("listed_since"))


def op7_url_filter(spark, sf_dir: str) -> DataFrame:
    """Every page against a list log made from the hosts of all pages.

    The table has neither capture times nor lists, so both follow from its rows:
    page p is fetched on day p mod 365 of 2024, and of the hosts those whose hash
    says so are listed, some removed 60 days later, some of these listed again.
    """
    from tidewright.llm.common import read

    pages = read(spark, sf_dir, "pages")
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n)
    captures = pages.select("page_id", "url", day((F.col("page_id") % 365).cast("int")).alias("fetched"))
    hosts = pages.select(F.regexp_replace(host_of(F.col("url")), r"^(www|m|blog)\.", "").alias("domain")).dropna().distinct()
    hashed = hosts.withColumn("h", F.conv(F.substring(F.md5(F.col("domain").cast("binary")), 1, 6), 16, 10).cast("int")).where("h % 5 < 2")
    first = (F.col("h") % 200).cast("int")
    log = F.array(
        F.struct(day(first).alias("dated"), F.lit(True).alias("listed")),
        F.struct(F.when(F.col("h") % 3 > 0, day(first + 60)).alias("dated"), F.lit(False).alias("listed")),
        F.struct(F.when(F.col("h") % 3 == 2, day(first + 120)).alias("dated"), F.lit(True).alias("listed")),
    )
    entries = hashed.select("domain", F.inline(log))
    found = evaluate(captures, intervals(entries))
    return found.withColumns({c: F.col(c).cast("string") for c in ("fetched", "listed_since")})


ORACLE = r"""
WITH p AS (
  SELECT page_id, CASE WHEN length(named) BETWEEN 1 AND 253 THEN named END AS host,
         CAST(DATE '2024-01-01' + CAST(page_id % 365 AS INT) AS DATE) AS fetched
  FROM (SELECT page_id, regexp_replace(lower(rtrim(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?(\[[0-9a-fA-F:.]+\]|[^/:?#]+)', 1))), '\.+$', '') AS named FROM pages)
), h AS (
  SELECT domain, CAST('0x' || substr(md5(domain), 1, 6) AS INT) AS h
  FROM (SELECT DISTINCT regexp_replace(host, '^(www|m|blog)\.', '') AS domain FROM p WHERE host IS NOT NULL)
), s AS (
  SELECT domain, CAST(DATE '2024-01-01' + h % 200 AS DATE) AS valid_from, CASE WHEN h % 3 > 0 THEN CAST(DATE '2024-01-01' + (h % 200 + 60) AS DATE) END AS valid_to FROM h WHERE h % 5 < 2
  UNION ALL SELECT domain, CAST(DATE '2024-01-01' + (h % 200 + 120) AS DATE), NULL FROM h WHERE h % 5 < 2 AND h % 3 = 2
), m AS (
  SELECT p.page_id, max_by(s.domain, length(s.domain)) AS matched_domain, max_by(s.valid_from, length(s.domain)) AS listed_since
  FROM p JOIN s ON (p.host = s.domain OR ends_with(p.host, '.' || s.domain)) AND p.fetched >= s.valid_from AND (s.valid_to IS NULL OR p.fetched < s.valid_to)
  GROUP BY p.page_id
)
SELECT p.page_id, host, CAST(fetched AS VARCHAR) AS fetched, matched_domain IS NOT NULL AS blocked, matched_domain, CAST(listed_since AS VARCHAR) AS listed_since
FROM p LEFT JOIN m USING (page_id)
"""
