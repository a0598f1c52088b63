import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from test_near_copies import slow_groups  # noqa: E402
from test_packing import check_pieces  # noqa: E402
from test_pii import slow  # noqa: E402

from tidewright.llm import pii  # noqa: E402


def redacted(text):
    out, at = "", 0
    for s, k, e in slow(text):
        if s >= at:
            out += text[at:s] + f"<{pii.KINDS[k]}>"
        at = max(at, e)
    return out + text[at:]


def test_every_stage(spark, sf_dir, tmp_path):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        out[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
    # quality: what the query keeps
    from tidewright.llm.quality_rules import op2_quality_rules

    kept = {r.doc_id for r in op2_quality_rules(spark, sf_dir).where("kept").collect()}
    assert sorted(r.doc_id for r in out["quality_rules"]) == sorted(kept)
    # near-duplicates: the smallest id of each group whose five-word shingles are 0.8 alike
    rows = sorted((before[k] for k in kept), key=lambda r: r.doc_id)
    comps = slow_groups([r.text for r in rows])
    assert sorted(r.doc_id for r in out["simhash"]) == sorted({rows[c].doc_id for c in comps})
    # personal data: every text without its base spans (these tables have nothing to add to them), else as it was
    clean = {r.doc_id: r.text for r in out["pii"]}
    assert clean == {r.doc_id: redacted(before[r.doc_id].text) for r in out["simhash"]}
    assert any(slow(before[k].text) for k in clean)
    # mixing: no text more than twice, copies are whole or a prefix
    copies = {}
    for r in out["mixing"]:
        assert clean[r.doc_id].startswith(r.text)
        copies.setdefault(r.doc_id, []).append(r.text)
    assert all(len(c) <= 2 and clean[k] in c or len(c) == 1 for k, c in copies.items())
    total = sum(len(t.split()) for t in clean.values())
    assert abs(sum(len(t.split()) for c in copies.values() for t in c) - 1.5 * total) <= 1
    # packing: every copy once; ids repeat, so their tokens are counted, and those that come once are compared
    tokens, got = {}, {}
    for r in out["packing"]:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
        if r.start == 0:
            tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.doc_tokens
    assert got == tokens and {k: sum(r.start == 0 for r in out["packing"] if r.doc_id == k) for k in copies} == {k: len(c) for k, c in copies.items()}
    once = {k: c[0] for k, c in copies.items() if len(c) == 1}
    check_pieces([r for r in out["packing"] if r.doc_id in once], once, gaps=True)


def test_clashing_columns(spark, sf_dir):
    """Columns named like those that the stages make come through as they were."""
    names = ["row", "_row", "whole", "_id", "_own", "_new", "_spans", "_n", "_i", "_s", "_d", "_size", "_words", "_taken", "base", "size", "key", "_key", "host", "of", "strain", "spans", "deal", "node", "root"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    wide = docs.withColumns({n: F.lit(n) for n in names})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        wide, docs = stage(spark, wide, sf_dir).cache(), stage(spark, docs, sf_dir).cache()
        assert wide.columns == [*docs.columns, *names]
        assert sorted(map(tuple, wide.select(*docs.columns).collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)
        assert wide.where(" AND ".join(f"`{n}` = '{n}'" for n in names)).count() == docs.count() > 0


def test_run_and_odd_rows(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    long_text = " ".join(f"w{i}x" for i in range(3000))
    rows = [(1, long_text, None, None, 5), (1, long_text, None, None, 5), (None, long_text + " more", "en", "s", 1), (2, None, "en", "s", 0), (3, "", None, "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for data in (docs, docs.where(F.lit(False))):
        for _, stage in corpus_pipeline.STAGES:
            data = stage(spark, data, sf_dir).cache()
            data.count()
