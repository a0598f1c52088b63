import hashlib

import public_tokenizers
import pytest
import sentencepiece

from tidewright.llm import sentence_pieces
from tidewright.llm.common import read

PATH = public_tokenizers.path(sentence_pieces.MODEL)
ODD = ["", " ", "  a  b ", "a\nb\t　c", "▁x▁ y", "é ﬁ é", "a\0b", "<s>x</s><unk><0x0A>", "日本語x\U0001f600", "x" * 5000, " " * 3001, "word" * 2000 + "\n\n", "\n", "a,b;c.d", "ﷺ‍"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_odd_texts(spark, library):
    rows = [(i, t, "en") for i, t in enumerate(ODD)] + [(1, ODD[2], "de"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sentence_pieces.encode(docs, PATH).collect()
    want = [(k, library.encode(t or ""), library.decode(library.encode(t)) if t else "") for k, t, _ in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in got), key=key) == sorted(want, key=key)
    assert all(r.agrees for r in got)
    assert sentence_pieces.digests(docs.where("false"), PATH).count() == 0


def test_agendas_agree(library):
    pieces = sentence_pieces.Pieces.shared(PATH)
    for t in ("▁unbelievable", "aaaaaaaaaaaaaaaaaaaaaaa", "▁▁▁▁▁▁▁x", "xyzzy😀,;", "é" * 30):
        assert pieces.listed(t) == pieces.heaped(t)
    for ids in ([0, 5, 300], [200, 131, 300], [], [28705, 28705, 5], [1, 300]):
        if 1 not in ids:
            assert pieces.decode(ids) == library.decode(ids)


def test_parts_that_are_remembered_go_over(monkeypatch, library):
    monkeypatch.setattr(sentence_pieces, "CACHE", 5)
    pieces = sentence_pieces.Pieces(PATH)
    texts = [f"one two three {i} four five six seven" for i in range(20)]
    assert [ids for ids, _ in pieces.encoded(texts)] == [",".join(map(str, library.encode(t))) for t in texts]
    assert max(len(pieces.known), len(pieces.words)) <= 5 + 8


def test_query(spark, sf_dir, library):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {tuple(r) for r in sentence_pieces.op11_sentencepiece(spark, sf_dir).collect()}
    want = set()
    for r in read(spark, sf_dir, "documents").collect():
        ids = library.encode(r.text or "")
        want.add((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids) if ids else ""), True))
    assert got == want


def test_disagreement_is_seen():
    pieces = sentence_pieces.Pieces(PATH)
    texts = ["a strange word", "two  spaces", "a word"]
    got = pieces.encoded(texts)
    assert pieces.agreeing(texts, got) == [True, True, True]
    assert pieces.agreeing(["two  spaces"], [("1,2", "x")]) == [False]
    pieces.agenda = lambda part: [5]
    texts = ["quite another", "a word", ""]
    assert pieces.agreeing(texts, pieces.encoded(texts)) == [False, True, True]
