"""Cost-balanced packing of documents into training sequences.

A sequence holds up to ``capacity`` tokens. Its estimated cost is the sum over
its pieces of a linear term and the quadratic term of attention within the
piece. Documents are taken in descending order of length, and each goes to the
sequence of lowest cost that still has room for it; what fits nowhere whole is
cut, again to the sequence of lowest cost with room.

Each task streams its part of the table and packs window by window, so nothing
is shuffled and memory holds one window of tokens. A window fills all of its
sequences to the last token and hands what is left to the next one. The end of
a task's last window goes to sequences whose lengths are powers of two, which
need no padding.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import ChainMap
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 4096
END_ID = 2
#: Sequences of a window: tokens of a window are this many times the capacity.
WINDOW = 256
#: Cost of a piece of n tokens: n + n * n / QUADRATIC.
QUADRATIC = 2048.0
#: Words whose ids are remembered in a task.
CACHE = 700_000

#: Texts of these characters only are split into words here; in others, and where a
#: special token is spelled out, the tokenizer splits.
PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
#: Words of a plain lower-case text (fixed values: the split pattern of the tokenizer for these characters).
WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\s0-9a-zß-öø-ÿ]+")


class Encoder:
    """Texts to ids, as bytes of little-endian unsigned 32-bit numbers.

    The ids of what stands between two white spaces do not depend on the rest of
    the text, so they are remembered, up to ``CACHE`` of them.
    """

    def __init__(self, name: str):
        import public_tokenizers
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.model = self.tokenizer.model
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.known: dict[str, bytes] = {}

    @staticmethod
    def shared(name: str) -> Encoder:
        """The encoder of this Python worker, which Spark uses for task after task."""
        import public_tokenizers

        held = vars(public_tokenizers).setdefault("shared_encoders", {})
        if name not in held:
            held[name] = Encoder(name)
        return held[name]

    def whole(self, texts: list[str]) -> list[bytes]:
        """By the tokenizer's own splitting."""
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in encoded]

    def _spaced(self, token: str) -> bytes:
        ids: list[int] = []
        for word in WORD.findall(token):
            if not word.isascii():
                word = self.as_bytes.pre_tokenize_str(word)[0][0]
            ids += [t.id for t in self.model.tokenize(word)]
        return np.asarray(ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [t.lower().split() if PLAIN.fullmatch(t) and "<|" not in t else None for t in texts]
        known = self.known
        new = {w: self._spaced(w) for w in {w for ws in split if ws for w in ws} if w not in known}
        find = known.__getitem__
        if len(known) < CACHE:
            known.update(new)
        else:
            find = ChainMap(new, known).__getitem__
        odd = iter(self.whole([t for t, ws in zip(texts, split, strict=True) if ws is None]))
        return [next(odd) if ws is None else b"".join(map(find, ws)) for ws in split]


def cost(n: int) -> float:
    return n + n * n / QUADRATIC


class Piece:
    """Tokens ``start`` to ``end`` of a document."""

    __slots__ = ("doc", "end", "start")

    def __init__(self, doc: tuple[Any, bytes], start: int, end: int):
        self.doc, self.start, self.end = doc, start, end

    def split(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.start + n), Piece(self.doc, self.start + n, self.end)


def assign(pieces: list[Piece], capacity: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Full sequences of ``capacity`` tokens, and the pieces (under ``capacity`` tokens in all) left over."""
    done: list[list[Piece]] = []
    rest: list[Piece] = []
    for p in pieces:
        while p.end - p.start >= capacity:
            full, p = p.split(capacity)
            done.append([full])
        if p.end > p.start:
            rest.append(p)
    n = sum(p.end - p.start for p in rest) // capacity
    if not n:
        return done, rest
    rest.sort(key=lambda p: p.start - p.end)
    open_: list[list[Piece]] = [[] for _ in range(n)]
    costs, room = np.zeros(n), np.full(n, capacity)
    later: list[Piece] = []
    for p in rest:
        size = p.end - p.start
        fits = np.where(room >= size, costs, np.inf)
        i = int(fits.argmin())
        if room[i] < size:
            later.append(p)
            continue
        open_[i].append(p)
        costs[i] += cost(size)
        room[i] -= size
    gaps = [(costs[i], i) for i in range(n) if room[i]]
    heapq.heapify(gaps)
    left: list[Piece] = []
    for p in later:
        while p.end > p.start and gaps:
            _, i = gaps[0]
            part, p = p.split(min(int(room[i]), p.end - p.start))
            open_[i].append(part)
            costs[i] += cost(part.end - part.start)
            room[i] -= part.end - part.start
            if room[i]:
                heapq.heapreplace(gaps, (costs[i], i))
            else:
                heapq.heappop(gaps)
        if p.end > p.start:
            left.append(p)
    return done + open_, left


def powers(pieces: list[Piece]) -> list[list[Piece]]:
    """The last pieces as sequences whose lengths are the powers of two of their sum."""
    total = sum(p.end - p.start for p in pieces)
    out: list[list[Piece]] = []
    queue = sorted(pieces, key=lambda p: p.start - p.end)
    for bit in reversed(range(total.bit_length())):
        if total >> bit & 1:
            need, seq = 1 << bit, []
            while need:
                p = queue.pop(0)
                part, p = p.split(min(need, p.end - p.start))
                seq.append(part)
                need -= part.end - part.start
                if p.end > p.start:
                    queue.insert(0, p)
            out.append(seq)
    return out


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every row of ``docs`` is a document of its own, whatever its id. A null or
    empty text has the closing id alone. ``capacity`` is a power of two. A
    sequence is known by its task and its number there.
    """
    end = np.asarray([END_ID], dtype="<u4").tobytes()
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = Encoder.shared(tokenizer)
        first = TaskContext.get().partitionId() << 36
        number = 0
        schema = None

        def written(sequences: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal number
            cols: list[list] = [[] for _ in range(7)]
            for seq in sequences:
                offset = 0
                for p in seq:
                    n = p.end - p.start
                    row = (p.doc[0], p.start, n, zlib.crc32(memoryview(p.doc[1])[4 * p.start : 4 * p.end]), len(p.doc[1]) // 4, first + number, offset)
                    for c, v in zip(cols, row, strict=True):
                        c.append(v)
                    offset += n
                number += 1
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types, strict=True)], schema=schema)

        waiting: list[Piece] = []
        tokens = 0
        for batch in batches:
            if schema is None:
                schema = pa.schema([("doc_id", batch.schema.field(0).type)] + [(c, pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for key, ids in zip(part.column(0).to_pylist(), encoder.encode(texts), strict=True):
                    doc = (key, ids + end)
                    waiting.append(Piece(doc, 0, len(doc[1]) // 4))
                    tokens += len(doc[1]) // 4
                if tokens >= window * capacity:
                    full, waiting = assign(waiting, capacity)
                    tokens = sum(p.end - p.start for p in waiting)
                    yield written(full)
        if waiting:
            full, waiting = assign(waiting, capacity)
            yield written(full + powers(waiting))

    out = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(rows, out)


def op8_packing(spark, sf_dir: str) -> DataFrame:
    from tidewright.llm.common import read

    return pack(read(spark, sf_dir, "documents"))
