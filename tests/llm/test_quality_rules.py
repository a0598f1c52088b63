import random
import re

import pytest
from pyspark.sql import functions as F

from tidewright.llm import quality_rules
from tidewright.llm.queries import ORACLE_SQL


def slow(text):
    t = text or ""
    w = [x for x in re.split(r"[ \t-\r]+", t) if x]
    lines = [x for x in t.split("\n") if re.search(r"[^ \t-\r]", x)]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    covered = {i + k for i, g in enumerate(windows) if windows.count(g) > 1 for k in range(5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_statistics_like_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", " \n\t ", "a", "\x0ba\x0c\rb", "é😀 #|\n\nx\nx \nx", "a b c d e " * 3, "a b c d e f a b c d e", "a a a a a a", "# " * 400]
    texts += ["".join(rng.choices(["a", "b", "c", " ", " ", "\n", "\t", "|"], k=rng.randint(0, 120))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("source", F.lit(None).cast("string"))
    for r in quality_rules.statistics(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == slow(texts[r.doc_id]), repr(texts[r.doc_id])


def test_query_against_sql(spark, sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    got = quality_rules.op2_quality_rules(spark, sf_dir)
    assert sorted(map(tuple, got.collect())) == sorted(con.sql(ORACLE_SQL["op2_quality_rules"]).fetchall())


def fitted(hosts):
    """Mean and weight of a beta-binomial fit by moments to (documents, failures) of hosts."""
    total, failed = sum(n for n, _ in hosts), sum(f for _, f in hosts)
    m = failed / total
    spread = sum(n * (f / n - m) ** 2 for n, f in hosts) / (m * (1 - m)) - (len(hosts) - 1)
    room = total - sum(n * n for n, _ in hosts) / total - (len(hosts) - 1)
    return m, min(max(room / spread - 1, 1), quality_rules.MAX_WEIGHT) if spread > 0 and room > 0 else quality_rules.MAX_WEIGHT


def test_hosts_and_odd_rows(spark):
    words = [f"word{i}" for i in range(100)]
    good, symbols, junk = " ".join(words), " ".join(f"{w} #" for w in words), "a b c d e f g h i j " * 9
    lines = lambda dup: "\n".join(words[0] if i % 2 == 0 and i <= 2 * dup else words[i + 1] for i in range(20))
    some, many = lines(5), lines(8)  # 0.83 and 1.33 of the limit
    rows = [(i, good, "fine", 1) for i in range(300)] + [(1000, symbols, "fine", 1), (1001, symbols, "bad", 1), (1002, good, "bad", 1), (1003, some, "bad", 1), (1004, some, "fine", 1), (1005, many, "fine", 1), (1006, many, "plain", 1), (1007, some, "plain", 1)]
    rows += [(2000 + i, junk, "bad", 1) for i in range(60)] + [(5000 + i, good, "plain", 1) for i in range(40)] + [(6000 + i, symbols, "plain", 1) for i in range(9)]
    rows += [(None, good, None, 1), (3000, None, None, 1), (3001, good, "tiny", 1), (3001, good, "tiny", 1), (3002, "ab " * 3 + "a b c " * 30, "odd", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, strain int").withColumns({"row": F.lit(1), "_row": F.lit(2), "host": F.lit("h"), "of": F.lit(3)})
    judged = quality_rules.judge(df).collect()
    hosts = {}
    for r in judged:
        n, f = hosts.get(r.host, (0, 0))
        hosts[r.host] = n + 1, f + (r.base_failed or r.odd_words or r.strain > 1)
    m, k = fitted(list(hosts.values()))
    for r in judged:
        n, f = hosts[r.host]
        rate = (f + m * k) / (n + k)
        assert abs(r.host_rate - rate) < 1e-9 and abs(r.allowance - min(max(m / rate, 0.5), 2)) < 1e-9
        assert r.kept == (not r.base_failed and not r.odd_words and r.strain <= r.allowance)
    kept = {r.doc_id: r.kept for r in judged}
    assert not kept[1000] and not kept[1001] and kept[1002] and not kept[1003] and kept[1004] and kept[1005] and not kept[1006] and kept[1007]
    assert not kept[2000] and not kept[6000] and kept[5000] and kept[None] and not kept[3000] and not kept[3002]
    out = quality_rules.keep(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted([r[0] for r in rows if kept[r[0]]], key=str)
    empty = df.where(F.lit(False))
    assert quality_rules.judge(empty).count() == 0 and quality_rules.keep(empty).count() == 0


def test_hosts_of_one_document_are_not_condemned(spark):
    good, junk = " ".join(f"word{i}" for i in range(40)), "a b c d e f g h i j " * 9
    df = spark.createDataFrame([(i, junk if i % 10 == 0 else good, f"h{i}") for i in range(300)], "doc_id long, text string, source string")
    assert quality_rules.judge(df).where("allowance < 0.9 OR allowance > 1.1").count() == 0


def test_the_verdict_decides_documents(spark):
    """On the given documents too, where hosts hardly differ."""
    got = quality_rules.judge(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(4)).where("NOT base_failed AND NOT odd_words").collect()
    assert any(r.kept != (r.strain <= 1) for r in got)


def test_keep_beyond_the_broadcast(spark, monkeypatch, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = sorted(r.doc_id for r in quality_rules.keep(docs).select("doc_id").collect())
    monkeypatch.setattr(quality_rules, "FEW_HOSTS", -1)
    assert sorted(r.doc_id for r in quality_rules.keep(docs).select("doc_id").collect()) == first
