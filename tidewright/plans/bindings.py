"""The given tables as an event log, settlements, dumps and a mapping.

One text for each view serves Spark and DuckDB; only the conversion of a timestamp
to nanoseconds differs. Breaks, overlaps, regressions and misses are set by
remainders, so every engine sees the same ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "orders", "events")

VIEWS = {
    "ev": """
SELECT event_id AS pos, concat('v', CAST(user_id % 2 AS STRING)) AS venue,
       concat('i', CAST(CAST(floor(user_id / 2) AS BIGINT) AS STRING)) AS instrument,
       1 + user_id % 4 AS source, NS(ts) - (event_id % 40) * 1000000 AS venue_ts, NS(ts) AS local_ts,
       value AS price, 1.0 + event_id % 5 AS qty, props,
       CASE event_type WHEN 'view' THEN 'book_update' WHEN 'click' THEN 'trades' WHEN 'signup' THEN 'book_snapshot'
            WHEN 'purchase' THEN 'book_ticker' ELSE 'control' END AS kind,
       CASE event_id % 3 WHEN 0 THEN 'conn_down' WHEN 1 THEN 'conn_up' ELSE 'gap' END AS control_kind
FROM {events}""",
    "control": "SELECT venue, source, pos, local_ts, control_kind, pos % 10 AS dropped FROM {ev} WHERE kind = 'control'",
    "downs": "SELECT venue, source, pos FROM {control} WHERE control_kind = 'conn_down'",
    "upd": """
SELECT venue, instrument, source, pos, local_ts, venue_ts, 10 * k AS final_update_id,
       10 * k - 9 - CASE WHEN pos % 23 = 0 THEN 3 ELSE 0 END AS first_update_id,
       CASE WHEN k = 1 THEN NULL WHEN pos % 17 = 0 THEN 10 * (k - 1) - 1 ELSE 10 * (k - 1) END AS prev_final_update_id
FROM (SELECT *, row_number() OVER (PARTITION BY venue, instrument ORDER BY pos) AS k FROM {ev} WHERE kind = 'book_update') u""",
    "snap": """
SELECT venue, instrument, pos, local_ts, 10 * n + CASE WHEN pos % 7 = 0 THEN -25 ELSE 4 END AS last_update_id
FROM (SELECT *, sum(CASE WHEN kind = 'book_update' THEN 1 ELSE 0 END) OVER (PARTITION BY venue, instrument ORDER BY pos) AS n FROM {ev}) s
WHERE kind = 'book_snapshot'""",
    "trd": """
SELECT venue, instrument, source, pos, 0 AS idx, price, qty,
       CASE WHEN pos % 29 = 0 THEN concat('x', CAST(k AS STRING)) WHEN pos % 13 = 0 THEN CAST(k - 2 AS STRING) ELSE CAST(k AS STRING) END AS trade_id
FROM (SELECT *, 10 + row_number() OVER (PARTITION BY venue, instrument ORDER BY pos) AS k FROM {ev} WHERE kind = 'trades') t""",
    "tick": """
SELECT venue, instrument, source, pos, local_ts, venue_ts, price, qty, CASE WHEN pos % 19 = 0 THEN k - 1 ELSE k END AS update_id
FROM (SELECT *, row_number() OVER (PARTITION BY venue, instrument ORDER BY pos) AS k FROM {ev} WHERE kind = 'book_ticker') b""",
    "fund": """
SELECT venue, instrument, funding_time, rate FROM (
  SELECT concat('v', CAST(o_custkey % 2 AS STRING)) AS venue, concat('c', CAST(CAST(floor(o_custkey / 2) AS BIGINT) AS STRING)) AS instrument,
         NS(o_orderdate) AS funding_time, (o_totalprice - 250000.0) / 1000000000.0 AS rate,
         row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn
  FROM {orders}) f WHERE rn = 1""",
    "capt": """
SELECT venue, instrument, CASE WHEN h % 43 = 0 THEN funding_time + 1000000 ELSE funding_time END AS funding_time,
       CASE WHEN h % 41 = 0 THEN rate + 0.00001 ELSE rate END AS rate
FROM (SELECT *, CAST(substr(instrument, 2) AS BIGINT) + CAST(floor(funding_time / 86400000000000) AS BIGINT) AS h FROM {fund}) c WHERE h % 40 <> 0""",
    "dump": """
SELECT symbol, dump_day, status, priority FROM (
  SELECT concat('c', CAST(o_custkey % 20 AS STRING)) AS symbol, NS(date_trunc('month', o_orderdate)) AS dump_day, o_orderstatus AS status,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'std' END AS priority,
         row_number() OVER (PARTITION BY o_custkey % 20, date_trunc('month', o_orderdate) ORDER BY o_orderkey) AS rn
  FROM {orders} WHERE (o_custkey % 20 + extract(MONTH FROM o_orderdate)) % 11 <> 0) d WHERE rn = 1""",
    "mapping": """
SELECT concat('v', CAST(c_custkey % 2 AS STRING)) AS venue, concat('c', CAST(CAST(floor(c_custkey / 2) AS BIGINT) AS STRING)) AS instrument,
       concat('B', CAST(CAST(floor(c_custkey / 2) AS BIGINT) AS STRING)) AS base, c_mktsegment AS segment,
       CAST(788918400000000000 AS BIGINT) + (c_custkey % 365) * CAST(86400000000000 AS BIGINT) AS valid_from,
       CASE WHEN c_custkey % 3 = 0 THEN CAST(946684800000000000 AS BIGINT) ELSE NULL END AS valid_to
FROM {customer}""",
    "overrides": """
SELECT concat('v', CAST(c_custkey % 2 AS STRING)) AS venue, concat('c', CAST(CAST(floor(c_custkey / 2) AS BIGINT) AS STRING)) AS instrument,
       c_custkey % 50 = 0 AS exclude, CASE WHEN c_custkey % 50 = 1 THEN c_mktsegment END AS base, c_custkey AS pos FROM {customer} WHERE c_custkey % 50 < 3""",
    "fees": """
SELECT concat('v', CAST(n_nationkey % 2 AS STRING)) AS venue, r_name AS tier, (n_nationkey - 5) / 250.0 AS maker, n_nationkey / 400.0 AS taker,
       CAST(694224000000000000 AS BIGINT) + n_nationkey * CAST(10000000000000000 AS BIGINT) AS valid_from FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "polls": "SELECT concat('p', CAST(user_id % 50 AS STRING)) AS label, event_id AS pos, event_type <> 'error' AS ok FROM {events}",
}

_NEEDS = {v: [n for n in (*TABLES, *VIEWS) if f"{{{n}}}" in text] for v, text in VIEWS.items()}


def _ns(text: str, before: str, after: str) -> str:
    """``NS(x)`` written out; x has balanced brackets."""
    while (at := text.find("NS(")) >= 0:
        depth, end = 1, at + 3
        while depth:
            depth += {"(": 1, ")": -1}.get(text[end], 0)
            end += 1
        text = f"{text[:at]}{before}{text[at + 3 : end - 1]}{after}{text[end:]}"
    return text


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view or table as a DataFrame."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    needs = {n: frame(spark, sf_dir, n) for n in _NEEDS[name]}
    return spark.sql(_ns(VIEWS[name], "unix_micros(CAST(", " AS TIMESTAMP)) * 1000"), **needs)


def duck(query: str, *views: str) -> str:
    """A DuckDB query with the views it needs in front; ``query`` starts with SELECT or with further WITH parts."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for n in _NEEDS.get(name, []):
            add(n)
        if name in VIEWS and name not in ordered:
            ordered.append(name)

    for v in views:
        add(v)
    names = {n: n for n in (*TABLES, *VIEWS)}
    parts = [f"{v} AS ({_ns(VIEWS[v].format(**names), '(epoch_us(', ') * 1000)')})" for v in ordered]
    query = query.strip()
    head, body = (query[5:].split("\n;\n", 1) if query.startswith("WITH ") else ("", query))
    parts += [head.strip()] if head else []
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body.strip()
