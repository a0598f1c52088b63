import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidewright.llm import token_alignment as T
from tidewright.llm.common import read

A, B = public_tokenizers.path(T.FIRST), public_tokenizers.path(T.SECOND)
ODD = ["", None, "▁x y", "日本語 テキスト 😀😀", "a" * 5000, " " * 3000 + "x", "é́ ﬁ\0 <|endoftext|> </s>", "\n\n\t x", "ﷺ" * 40 + "हिन्दी में", "x" * 37 + "😀" * 50 + "123456789 " * 20, "same same", "same same", "'s 'LL don't"]


@pytest.fixture(scope="module")
def plain():
    """A text's groups by the two libraries and a set of common ends; None for a text without tokens."""
    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    both = T.Both.shared(A, B)

    def groups(text):
        if not text:
            return None
        a, b = first.encode(f" {text}", add_special_tokens=False).ids, second.encode(text)
        spelled = [b"".join(t.bytes[i] for i in ids) for t, ids in ((both.a, a), (both.b, b))]
        if spelled != [f" {text}".encode()] * 2:
            return None
        ends = [np.cumsum([len(t.bytes[i]) for i in ids]).tolist() for t, ids in ((both.a, a), (both.b, b))]
        out, at = [], [0, 0]
        for e in sorted(set(ends[0]) & set(ends[1])):
            to = [x.index(e) + 1 for x in ends]
            out.append((a[at[0] : to[0]], b[at[1] : to[1]]))
            at = to
        return out

    return groups


def expected(texts, plain):
    """Contract's rows by plain loops."""
    found = [plain(t) or [] for t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in found]
    docs = Counter(p for c in links for p in c)
    most = {}
    for (x, _), n in docs.items():
        most[x] = max(n, most.get(x, 0))
    for g, c in zip(found, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        best = sum(n for p, n in c.items() if docs[p] == most[p[0]])
        yield sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()), best, sum(n * docs[p] for p, n in c.items()), text


@pytest.mark.parametrize(("few", "at_once"), [(T.FEW_PAIRS, T.PAIRS), (0, 40)])
def test_odd_texts(spark, plain, few, at_once):
    docs = spark.createDataFrame([(i // 2, t, "x") for i, t in enumerate(ODD)], "doc_id long, text string, pairs string").repartition(2)
    out, counts = T.align(docs, A, B, few_pairs=few, pairs_at_once=at_once)
    got = sorted(tuple(r) for r in out.collect())
    assert got == sorted((i // 2, *w) for i, w in enumerate(expected(ODD, plain)))
    assert counts.count() == counts.select("pair").distinct().count()
    assert T.align(docs.where("false"), A, B)[0].count() == 0


def test_common_ends():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = (np.unique([*rng.integers(1, 60, rng.integers(1, 50)), 60]) for _ in range(2))
        want = np.isin(a, b)
        assert (T.common_ends(a, b, np.array([0]), np.array([len(a)])) == want).all()


def test_query(spark, sf_dir, plain):
    rows = read(spark, sf_dir, "documents").select("doc_id", "text").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest() if t else ""
    want = sorted((r.doc_id, *w[:6], sha(w[6])) for r, w in zip(rows, expected([r.text for r in rows], plain), strict=True))
    assert sorted(tuple(r) for r in T.op13_token_alignment(spark, sf_dir).collect()) == want
