"""Alignment of two tokenizers' tokens on the same bytes.

Both token sequences of a text end somewhere in the same bytes. Where both have an end
they are cut; what lies between two cuts is a group, and all its tokens of one side are
linked with all of the other. Cuts are found by divide and conquer: in every open
interval a common end near the middle is looked for by bisecting the other side's ends
with the middle one and this side's with the one found, and both halves are open again.
All texts of a portion are divided together, level by level.

How often two ids are linked is counted corpus-wide in documents. The tokens are made
once; their groups and distinct id pairs are written to the checkpoint folder.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import once, stored

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters of a portion of texts.
AT_ONCE = 500_000
#: Candidates for distinct pairs that are held at a time.
PAIRS = 2_000_000
#: A row with more links than this many times its tokens has its groups reduced to distinct ids first.
DENSE = 8
#: Id pairs that are broadcast with their counts (16 bytes each); more are joined by a shuffle.
FEW_PAIRS = 2_000_000
SECOND_BITS = 32

#: Texts of these characters, without long runs of spaces, are split alike by every version of the Unicode tables.
PLAIN = re.compile("[\\t\\n\\r\\x20-\\x7e\\u00a1-\\u024f]*")
LONG_RUN = re.compile(r"\s{500}")
#: The split pattern of byte-level tokenizers (a fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteLevel:
    """The first tokenizer: ids, and each id's bytes."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # the byte that each character of a token stands for
        letters = [pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(c)[0][0] for c in map(chr, range(128))]
        taken = {ord(c): i for i, c in enumerate(letters)}
        spelled = {**taken, **{c: c for c in [*range(0xA1, 0xAD), *range(0xAE, 0x100)]}}
        rest = [b for b in range(128, 256) if b not in spelled.values()]
        spelled |= dict(zip(range(256 + sum(b >= 256 for b in taken), 256 + 68), rest, strict=True))
        model = json.loads(self.tokenizer.to_str())["model"]
        self.bytes = [b""] * self.tokenizer.get_vocab_size()
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.bytes[i] = bytes(spelled[ord(c)] for c in token) if token in model["vocab"] else token.encode()
        if not {bytes([i]) for i in range(256)} <= set(self.bytes):
            raise ValueError("a byte-level vocabulary has every byte, so its tokens spell any text")
        # ranks are ids only where merges made the tokens in the order of their ids
        made = [model["vocab"]["".join(m)] for m in model["merges"]]
        self.fast = None
        if made == list(range(256, 256 + len(made))):
            self.fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks={self.bytes[i]: i for i in model["vocab"].values()}, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        plain = [self.fast is not None and PLAIN.fullmatch(t) is not None and not LONG_RUN.search(t) for t in texts]
        other = iter(self.tokenizer.encode_batch_fast([t for t, p in zip(texts, plain, strict=True) if not p], add_special_tokens=False))
        return [self.fast.encode_ordinary(t) if p else next(other).ids for t, p in zip(texts, plain, strict=True)]


class PieceLevel:
    """The second tokenizer: ids, and each id's bytes; it puts a space in front by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = m = sentencepiece.SentencePieceProcessor(model_file=path)
        spell = lambda i: bytes([int(m.id_to_piece(i)[1:-1], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode()
        self.bytes = [spell(i) for i in range(m.get_piece_size())]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


class Both:
    """The two tokenizers of this Python worker, with lengths of tokens and the digits that groups are written with."""

    def __init__(self, first: str, second: str):
        self.a, self.b = ByteLevel(first), PieceLevel(second)
        self.a_length, self.b_length = (np.array([len(x) for x in t.bytes], dtype=np.int64) for t in (self.a, self.b))
        na, nb = len(self.a.bytes), len(self.b.bytes)
        # an id's digits with what follows: another id of its side, or the other side or group
        self.digits = [f"{i}{after}" for n, end in ((na, "|"), (nb, ";")) for after in (",", end) for i in range(n)]
        self.starts = 0, na, 2 * na, 2 * na + nb

    @classmethod
    def shared(cls, first: str, second: str) -> Both:
        return once(("both", first, second), lambda: cls(first, second))

    def tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides; none for texts that are null or empty, or whose tokens do not spell a space and the text."""
        given = [t for t in texts if t]
        sides = ([], [])
        for t, first, second in zip(given, self.a.encode([f" {t}" for t in given]), self.b.encode(given) if given else [], strict=True):
            want = f" {t}".encode()
            a, b = np.array(first, dtype=np.int64), np.array(second, dtype=np.int64)
            same = b"".join(map(self.b.bytes.__getitem__, second)) == want and int(self.a_length[a].sum()) == len(want)
            for side, ids in zip(sides, (a, b), strict=True):
                side.append(ids if same else ids[:0])
        found = [iter(side) for side in sides]
        none = np.zeros(0, dtype=np.int64)
        both = [tuple(next(f) for f in found) if t else (none, none) for t in texts]
        return [x[0] for x in both], [x[1] for x in both]


def common_ends(a: np.ndarray, b: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Which of the ends ``a`` (ascending) are among the ends ``b`` (ascending too), by divide and conquer.

    ``starts`` and ``stops`` are the intervals of ``a`` to divide. In each the middle end
    is bisected into ``b``, and the end met there back into ``a``: that is the nearest
    candidate for a common one behind the middle. Whether it is one or not, what is left on
    both sides is divided further, so every end is either cut or shown to be no common one.
    """
    cut = np.zeros(len(a), dtype=bool)
    lo, hi = starts, stops
    while len(lo):
        live = lo < hi
        lo, hi = lo[live], hi[live]
        if not len(lo) or not len(b):
            break
        mid = (lo + hi) >> 1
        j = np.minimum(np.searchsorted(b, a[mid]), len(b) - 1)
        # the first end of a that is not before the end met: mid itself where it is common
        near = np.where(b[j] == a[mid], mid, np.searchsorted(a, b[j]))
        met = (near >= mid) & (near < hi)
        met[met] = a[near[met]] == b[j[met]]
        cut[near[met]] = True
        # no end of b lies between mid and the end met, so none of a from mid to there is common
        lo, hi = np.concatenate([lo, np.where(met, near + 1, np.maximum(near, mid + 1))]), np.concatenate([mid, hi])
    return cut


def _runs(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of these lengths: each item's run, and its number in it."""
    run = np.repeat(np.arange(len(lengths)), lengths)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(lengths) - lengths, lengths)


class Groups:
    """The groups of all texts of a portion: ids of both sides, their groups, and the groups' texts."""

    def __init__(self, both: Both, a: list[np.ndarray], b: list[np.ndarray]):
        self.n_a, self.n_b = (np.array([len(x) for x in side], dtype=np.int64) for side in (a, b))
        self.a, self.b = (np.concatenate([*side, np.zeros(0, dtype=np.int64)]) for side in (a, b))
        a_end, b_end = np.cumsum(both.a_length[self.a]), np.cumsum(both.b_length[self.b])
        stops = np.cumsum(self.n_a)
        a_cut = common_ends(a_end, b_end, stops - self.n_a, stops)
        b_cut = np.zeros(len(self.b), dtype=bool)
        b_cut[np.searchsorted(b_end, a_end[a_cut])] = True
        # every text ends with a cut, so groups never span two
        self.a_group, self.b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
        self.n = int(a_cut.sum())
        self.text = np.repeat(np.arange(len(a)), self.n_a)[a_cut]
        self.a_size, self.b_size = np.bincount(self.a_group, minlength=self.n), np.bincount(self.b_group, minlength=self.n)
        self.n_groups = np.bincount(self.text, minlength=len(a))
        self.n_links = np.bincount(self.text, weights=None if not self.n else (self.a_size * self.b_size).astype(float), minlength=len(a)).astype(np.int64) if self.n else np.zeros(len(a), dtype=np.int64)
        self.a_cut, self.b_cut = a_cut, b_cut

    def written(self, both: Both) -> list[str]:
        """The groups of each text: ids of the one side, |, ids of the other, and ; between groups."""
        before_b, before_a = np.cumsum(self.b_size) - self.b_size, np.cumsum(self.a_size)
        s = both.starts
        code = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        code[np.arange(len(self.a)) + before_b[self.a_group]] = self.a + np.where(self.a_cut, s[1], s[0])
        code[np.arange(len(self.b)) + before_a[self.b_group]] = self.b + np.where(self.b_cut, s[3], s[2])
        digits = list(map(both.digits.__getitem__, code.tolist()))
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(digits[at:to])[:-1] for at, to in zip([0, *ends], ends, strict=False)]

    def pairs(self, limit: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Number of a text, distinct id pairs (first << 32 | second) linked in it and how often.

        A text whose pairs are many comes several times, each time with other first ids.
        """
        a_to, b_to, g_to = np.cumsum(self.n_a), np.cumsum(self.n_b), np.cumsum(self.n_groups)
        for t in np.flatnonzero(self.n_groups):
            a_at, b_at, g = slice(a_to[t] - self.n_a[t], a_to[t]), slice(b_to[t] - self.n_b[t], b_to[t]), slice(g_to[t] - self.n_groups[t], g_to[t])
            a, a_group, b, b_group, b_size = self.a[a_at], self.a_group[a_at] - g.start, self.b[b_at], self.b_group[b_at] - g.start, self.b_size[g]
            a_n = b_n = None
            if self.n_links[t] > DENSE * (len(a) + len(b)):
                both, a_n = np.unique(a_group << 32 | a, return_counts=True)
                a, a_group = both & 0xFFFFFFFF, both >> 32
                both, b_n = np.unique(b_group << 32 | b, return_counts=True)
                b, b_size = both & 0xFFFFFFFF, np.bincount(both >> 32, minlength=len(b_size))
            weight, b_start = b_size[a_group], np.cumsum(b_size) - b_size
            parts = [np.arange(len(a))]
            if weight.sum() > limit:
                order = np.argsort(a, kind="stable")
                lot = np.cumsum(weight[order]) // limit
                first = np.flatnonzero(np.diff(a[order], prepend=-1))  # cut between different ids only
                cuts = first[np.flatnonzero(np.diff(lot[first], prepend=-1))]
                parts = np.split(order, cuts[1:])
            for part in parts:
                run, number = _runs(weight[part])
                i = part[run]
                j = b_start[a_group[i]] + number
                key = a[i] << SECOND_BITS | b[j]
                if a_n is None:
                    yield int(t), *np.unique(key, return_counts=True)
                else:
                    found, where = np.unique(key, return_inverse=True)
                    n = np.zeros(len(found), dtype=np.int64)
                    np.add.at(n, where, a_n[i] * b_n[j])
                    yield int(t), found, n


def _portions(texts: list[str | None]) -> Iterator[list[str | None]]:
    held: list[str | None] = []
    size = 0
    for t in texts:
        held.append(t)
        size += len(t or "")
        if size >= AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


LINKED = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"


def linked(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, pairs_at_once: int = PAIRS) -> DataFrame:
    """row, id_col, n_a, n_b, n_groups, n_links, groups, pairs and times of every row of ``docs``.

    ``groups`` is their text, or its SHA-256 with ``digest`` ('' where there is none);
    ``pairs`` are the distinct id pairs, and ``times`` how often each is linked. A row whose
    pairs are very many goes on in further rows with the same ``row``, whose n_a is null.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    written = (lambda g: hashlib.sha256(g.encode()).hexdigest() if g else "") if digest else (lambda g: g)
    names = ["row", id_col, "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Both.shared(first, second)
        for batch in batches:
            at = 0
            for texts in _portions(batch.column(2).to_pylist()):
                keys = batch.slice(at, len(texts))
                at += len(texts)
                g = Groups(both, *both.tokens(texts))
                said = [written(x) for x in g.written(both)]
                begun = np.zeros(len(texts), dtype=bool)

                def made(lot: list[tuple[int, np.ndarray, np.ndarray]], keys=keys, g=g, said=said, begun=begun) -> pa.RecordBatch:
                    t = np.array([x[0] for x in lot], dtype=np.int64)
                    new = []
                    for x in t:
                        new.append(not begun[x])
                        begun[x] = True
                    hide = ~np.array(new, dtype=bool)
                    numbers = [pa.array(c[t], pa.int64(), mask=hide) for c in (g.n_a, g.n_b, g.n_groups, g.n_links)]
                    ends = np.cumsum([0, *(len(x[1]) for x in lot)])
                    lists = [pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(np.concatenate([x[k] for x in lot]), pa.int64())) for k in (1, 2)]
                    lists = [x.cast(pa.list_(pa.int64())) for x in lists]
                    cols = [keys.column(0).take(pa.array(t)), keys.column(1).take(pa.array(t)), *numbers, pa.array([None if h else said[x] for x, h in zip(t, hide, strict=True)], pa.string()), *lists]
                    return pa.RecordBatch.from_arrays(cols, names=names)

                none = np.zeros(0, dtype=np.int64)
                lot, held = [(int(t), none, none) for t in np.flatnonzero(g.n_groups == 0)], 0
                for one in g.pairs(pairs_at_once):
                    lot.append(one)
                    held += len(one[1])
                    if held >= pairs_at_once:
                        yield made(lot)
                        lot, held = [], 0
                if lot:
                    yield made(lot)

    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col), F.col(text_col).cast("string"))
    return read.mapInArrow(rows, f"row long, `{id_col}` {kind}, {LINKED}")


def pair_counts(table: DataFrame) -> DataFrame:
    """pair, docs, best: in how many documents two ids are linked, and whether that is the most of the first id's pairs."""
    counted = stored(table.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs")))
    first = F.shiftright("pair", SECOND_BITS)
    # a row for each id of the first vocabulary at most
    most = counted.groupBy(first.alias("_first")).agg(F.max("docs").alias("_most"))
    return counted.join(F.broadcast(most), first == F.col("_first")).select("pair", "docs", (F.col("docs") == F.col("_most")).alias("best"))


def align(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, few_pairs: int = FEW_PAIRS, pairs_at_once: int = PAIRS) -> tuple[DataFrame, DataFrame]:
    """(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row of ``docs``, and ``pair_counts``.

    Every row counts as a document of its own, whatever its id. Null and empty texts, and
    those whose tokens do not spell a space and the text, have no tokens: zeros and ''.
    Texts are taken whole, however long; groups of any size are whole, their distinct pairs
    are made from distinct ids. Ties of an id's highest count all are best. Other columns are
    left behind, and an empty table gives no rows.
    """
    table = stored(linked(docs, first, second, id_col, text_col, digest, pairs_at_once))
    counts = stored(pair_counts(table))
    known = F.broadcast(counts) if counts.count() <= few_pairs else counts
    links = table.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    met = links.join(known, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum"))
    own = table.where("n_a IS NOT NULL").drop("pairs", "times")
    out = own.join(met, "row", "left").select(id_col, "n_a", "n_b", "n_groups", "n_links", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")), "groups")
    return out, counts


def op13_token_alignment(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tidewright.llm.common import read

    out, _ = align(read(spark, sf_dir, "documents"), public_tokenizers.path(FIRST), public_tokenizers.path(SECOND), digest=True)
    return out.withColumnRenamed("groups", "groups_sha256")
