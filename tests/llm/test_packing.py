import random
import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewright.llm import packing


@cache
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def ids_of(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids + [2]


def check_pieces(rows, texts, gaps=False):
    """Every id in one piece, sequences gapless and within 4096; returns the share of padding."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for k, pieces in by_doc.items():
        ids, at = ids_of(texts[k]), 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            at += p.length
            assert p.ids_crc32 == zlib.crc32(np.asarray(ids[p.start : at], dtype="<u4").tobytes())
        assert at == len(ids)
    used = padding = 0
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert gaps or p.offset == at
            at += p.length
        assert at <= 4096
        used += at
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    return padding / (used + padding)


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert check_pieces(packing.op8_packing(spark, sf_dir).collect(), texts) < 0.001


def test_odd_rows(spark):
    texts = {1: None, 2: "", 3: "It's O'Neil's, don't! 12.5% ²½ ÀÉ <|endoftext|> İstanbul ΣΑΣ́ é 日本 \x1c x y", 4: "né " * 30000, 5: "<|startoftext|>a<|", 6: "\x00 a\tb", 7: "a" * 9000}
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in texts.items()], "doc_id long, text string, start string, length int")
    assert check_pieces(packing.pack(docs.coalesce(1)).collect(), texts) < 0.001
    again = packing.pack(docs.unionByName(docs)).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).where("n <> 2 * t")
    assert again.count() == 0
    assert packing.pack(docs.where(F.lit(False))).count() == 0


def test_costs_are_balanced():
    rng = random.Random(3)
    pieces = [packing.Piece((i, b""), 0, rng.choice([30, 200, 900, 2500])) for i in range(4000)]
    total = sum(p.end for p in pieces)
    full, left = packing.assign(pieces, 4096)
    assert sum(p.end - p.start for p in left) == total % 4096
    assert all(sum(p.end - p.start for p in s) == 4096 for s in full)
    costs = np.array([sum(packing.cost(p.end - p.start) for p in s) for s in full])
    assert costs.std() / costs.mean() < 0.2
