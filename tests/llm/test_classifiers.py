import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.llm import language_id, quality_classifier, toxicity

SF = "/root/testdata/sf0.01"


def odd(spark, docs):
    rows = [(None, None), (1, ""), (2, "x" * 100_000), (2, "same"), (2, "same"), (3, "12 34 !!"), (4, "word " * 50_000)]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(None).cast(docs.schema[c].dataType) for c in docs.columns if c not in ("doc_id", "text")}).withColumn("score", F.lit("clash"))


@pytest.mark.parametrize(("module", "query", "label", "least"), [(quality_classifier, "op4_quality_fm", "quality", 0.95), (toxicity, "op5_toxicity", "toxic", 0.9)])
def test_held_out_accuracy_and_odd_rows(spark, module, query, label, least):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    scored = getattr(module, query)(spark, SF)
    assert scored.count() == docs.count() and scored.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    held = scored.where("held_out").join(labels, "doc_id")
    assert held.agg(F.avg((F.col("predicted") == F.col(label)).cast("double"))).first()[0] >= least
    # nothing but the text (and its length) counts
    model = module.train(docs, labels)
    changed = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("yy"), "doc_id": F.col("doc_id") + 10**9})
    a = {r.doc_id: r.score for r in module.score(docs, model).collect()}
    b = {r.doc_id - 10**9: r.score for r in module.score(changed, model).collect()}
    assert a == b
    rows = module.score(odd(spark, docs), model).collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
    none = module.train(docs, labels.where(F.lit(False)))
    assert {round(r.score, 6) for r in module.score(docs.limit(5), none).collect()} == {0.5}
    assert module.score(docs.where(F.lit(False)), model).count() == 0


def test_machine_equals_all_pairs():
    rng = np.random.default_rng(0)
    m = quality_classifier.Machine(np.zeros(15), np.ones(15))
    m.w, m.v = rng.normal(size=m.w.shape), rng.normal(size=m.v.shape)
    at, x = rng.choice(len(m.w), 30, replace=False), rng.normal(size=30)
    pairs = sum(m.v[at[i]] @ m.v[at[j]] * x[i] * x[j] for i in range(30) for j in range(i))
    assert np.isclose(m.margin(at, x), m.w[at] @ x + pairs)


def slow_kernel(s, t):
    def features(word):
        marked, out = f"^{word}$", {}
        for i in range(len(marked)):
            for j in range(i + 1, len(marked)):
                for k in range(j + 1, min(len(marked), i + toxicity.SPAN)):
                    key = marked[i] + marked[j] + marked[k]
                    out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i - 2)
        return out

    a, b = features(s), features(t)
    return sum(v * b.get(k, 0) for k, v in a.items())


def test_kernel_like_brute_force(monkeypatch):
    monkeypatch.setattr(toxicity, "NEAR", 0.0)
    rng = random.Random(1)
    words = ["idiot", "idxiot", "réeux", "a", "aaaa"] + ["".join(rng.choices("abcdé", k=rng.randint(1, 9))) for _ in range(30)]
    marks = ["idiot", "trash", "aabba"]
    got = toxicity.Kernel(marks).values(words) * np.outer(toxicity._norms(words), toxicity._norms(marks))
    assert np.allclose(got, [[slow_kernel(w, m) for m in marks] for w in words], atol=1e-4)


def test_gapped_insults_stay_near():
    reader = toxicity.Reader(toxicity.Kernel(["idiot", "stupid"]))
    for text in ("You IDIOT.", "you i-d-i-o-t", "you i d i o t now", "you idioot", "you stu*pid"):
        assert len(reader.read(text)[3]) == 1, text
    assert reader.read("the quiet river. another line")[3] == []
    assert reader.read(None) [:2] == (0, 0)


def test_letters_are_told_apart():
    k = toxicity.Kernel(["réeux", "ωδη"])
    same = k.values(["réeux", "rëeux", "ωδη", "пдη"])
    assert np.isclose(same[0, 0], 1) and np.isclose(same[2, 1], 1)
    assert same[1].max() < 0.9 and same[3].max() < 0.9


def test_a_rare_and_a_sixty_fifth_language(spark):
    """Each of seventy languages writes words of its own; one has a single text, one nearly all rows."""
    rng = random.Random(7)
    alphabet = [chr(c) for c in range(0x4E00, 0x4E00 + 70 * 12)]
    text = lambda n: " ".join("".join(rng.choices(alphabet[12 * n : 12 * n + 12], k=5)) for _ in range(60))
    langs = [0] * 300 + [n for n in range(1, 69) for _ in range(6)] + [69]
    ids = [i for i in range(3000) if language_id_remainder(i) != 2]
    df = spark.createDataFrame([(i, text(n), f"l{n:02d}") for i, n in zip(ids, langs, strict=False)], "doc_id long, text string, lang string").repartition(5)
    filters = language_id.train(df, sample=50)
    assert len(filters.languages) == 70 and filters.table.shape[1] == 2
    asked = [(n, text(n)) for n in range(69)] + [(69, df.where("lang = 'l69'").first().text)]
    got = {r.doc_id: r.lang_pred for r in language_id.identify(spark.createDataFrame(asked, "doc_id long, text string"), filters).collect()}
    assert got == {n: f"l{n:02d}" for n in range(70)}


def language_id_remainder(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 4


def test_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.op9_language(spark, SF)
    held = got.where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] >= 0.98
    filters = language_id.train(docs)
    rows = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(odd(spark, docs), filters).collect()}
    assert rows[None] == rows[1] == rows[3] == ("und", 0.0)
    assert rows[4][0] in filters.languages and 0 <= rows[4][1] <= 1
    assert language_id.identify(docs.limit(3), language_id.train(docs.where(F.lit(False)))).select("lang_pred").distinct().collect()[0][0] == "und"
    assert language_id.identify(docs.where(F.lit(False)), filters).count() == 0


def test_filters_like_sets():
    rng = np.random.default_rng(2)
    sets = [rng.integers(1, 2**62, 3000).astype(np.uint64) for _ in range(3)]
    table = np.zeros(1 << language_id.ROWS_LOG2, np.uint64)
    for k, s in enumerate(sets):
        for p in language_id.positions(s):
            table[p] |= np.uint64(1 << k)
    filters = language_id.Filters(["a", "b", "c"], table)
    text = np.concatenate([sets[0][:600], sets[1][:300], rng.integers(1, 2**62, 100).astype(np.uint64)])
    assert np.allclose(filters.shares(text), [0.6, 0.3, 0.0], atol=0.01)
