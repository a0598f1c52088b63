"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text becomes symbols, one for each character, and an agenda holds the adjacent
pairs that together are a piece, by score and then from left to right. The best pair
is merged, its new neighbours join the agenda, and pairs of which a side has changed
meanwhile are passed over. Characters without a piece become the pieces of their bytes.

Merges never cross a place that no piece of the vocabulary spans, so a text is cut
there and the ids of its short parts and words are remembered. In each Arrow batch the library's
own encoder and decoder check every word that is new, and whole texts that do not consist
of words with one space between them.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
import string
from collections.abc import Callable, Iterator
from itertools import groupby, repeat
from operator import add

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import once

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Parts of this many characters at most are remembered, and so many of them in a task.
SHORT, CACHE = 48, 800_000
#: Bits of an agenda entry for the number of a symbol and for a piece's length.
PLACE, LENGTH = 40, 12
PLACES, LENGTHS = (1 << PLACE) - 1, (1 << LENGTH) - 1
#: Later than any score.
NEVER = 1 << 62
#: Texts of so many characters, or so many texts, are checked at a time.
AT_ONCE, TEXTS = 4_000_000, 256

# one replacement character for each byte that is not UTF-8
codecs.register_error("each_byte", lambda e: ("�", e.start + 1))


class Known(dict):
    """Values of strings, made once; strings alone, which the garbage collector passes over.

    When ``CACHE`` are held, those that are met again go over to the next such lot.
    """

    def __init__(self, make: Callable[[str], str]):
        super().__init__()
        self.make = make
        self.older: dict[str, str] = {}

    def __missing__(self, key: str) -> str:
        self[key] = value = self.older[key] if key in self.older else self.make(key)
        return value

    def turn(self) -> None:
        """Between texts: forget long strings, and begin a new lot where this one is full."""
        if len(self) >= CACHE:
            self.older = {p: v for p, v in self.items() if len(p) <= SHORT}
            self.clear()


class Pieces:
    """A vocabulary with its agenda encoder and its decoder."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        m, n = self.library, self.library.get_piece_size()
        self.pieces = [m.id_to_piece(i) for i in range(n)]
        apart = {i for i in range(n) if m.is_control(i) or m.is_unknown(i) or m.is_byte(i)}
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in apart}
        #: a piece's entry on the agenda: the place of its score, room for the left symbol's number, its length
        scores = sorted({-m.get_score(i) for i in self.ids.values()})
        place = {score: k for k, score in enumerate(scores)}
        self.turns = {p: place[-m.get_score(i)] << PLACE + LENGTH | len(p) for p, i in self.ids.items()}
        self.places = {p: place[-m.get_score(i)] for p, i in self.ids.items()}
        self.bytes = {int(self.pieces[i][1:-1], 16): i for i in apart if m.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown = m.unk_id()
        special = {i: "" if m.is_control(i) else " ⁇ " for i in apart}
        self.surfaces = [special.get(i, p.replace(SPACE, " ")) for i, p in enumerate(self.pieces)]
        joined = [p for p in self.ids if len(p) > 1]
        self.parts = self._parts(joined)
        #: ids of parts, and of words with the space before them
        self.known, self.words = Known(self._part), Known(self._word)
        #: parts and words that decode to something else than themselves, and words of which the library has other ids or another text
        self.odd_parts: set[str] = set()
        self.odd: set[str] = set()
        self.bad: set[str] = set()
        #: words that were met first since the last check, with their ids
        self.new: list[tuple[str, str]] = []

    @classmethod
    def shared(cls, path: str) -> Pieces:
        """The vocabulary of this Python worker, which Spark uses for task after task."""
        return once(("pieces", path), lambda: cls(path))

    @staticmethod
    def _parts(joined: list[str]) -> re.Pattern | None:
        """Finds the parts of a text between places that no piece of several characters spans; None if there are none such.

        Such places are before spaces, about tabs and line ends, and between a letter and a
        mark, as far as the vocabulary has it so.
        """
        if any(SPACE in p.lstrip(SPACE) for p in joined):
            return None
        single = "".join(c for c in "\n\t" if not any(c in p for p in joined))
        spanned = {p[i] for p in joined for i in range(1, len(p)) if p[i - 1].isalpha()}
        marks = "".join(re.escape(c) for c in string.punctuation if c not in spanned)
        finds = [f"[{single}]"] if single else []
        finds += [f"{SPACE}*[^\\W\\d_]+(?=[{marks}])"] if marks else []
        return re.compile("|".join([*finds, f"{SPACE}*[^{SPACE}{single}]+", f"{SPACE}+"]))

    def agenda(self, text: str) -> list[int]:
        """Ids of a text whose spaces are written as pieces have them."""
        symbols = self.listed(text) if len(text) <= SHORT else self.heaped(text)
        try:
            return [self.ids[s] for s in symbols]
        except KeyError:
            other = lambda s: [self.bytes[b] for b in s.encode()] if self.bytes else [self.unknown]
            return [i for s in symbols for i in ([self.ids[s]] if s in self.ids else other(s))]

    def listed(self, text: str) -> list[str]:
        """The symbols that are left of a short text, by an agenda kept as a list in the order of the text."""
        find = self.places.get
        symbols = list(text)
        agenda = list(map(find, map(add, text, text[1:]), repeat(NEVER)))
        while agenda and (first := min(agenda)) < NEVER:
            i = agenda.index(first)
            symbols[i] = piece = symbols[i] + symbols.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = find(piece + symbols[i + 1], NEVER)
            if i:
                agenda[i - 1] = find(symbols[i - 1] + piece, NEVER)
        return symbols

    def heaped(self, text: str) -> list[str]:
        """The symbols that are left of a text, by an agenda kept as a heap: n log n steps."""
        symbols: list[str | None] = list(text)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        find, push, pop = self.turns.get, heapq.heappush, heapq.heappop
        waiting = [turn + (i << LENGTH) for i in range(n - 1) if (turn := find(text[i : i + 2])) is not None]
        heapq.heapify(waiting)
        while waiting:
            entry = pop(waiting)
            left = entry >> LENGTH & PLACES
            a, right = symbols[left], after[left]
            if a is None or right < 0:
                continue
            piece = a + symbols[right]
            if len(piece) != entry & LENGTHS:  # a side has changed meanwhile
                continue
            symbols[left], symbols[right] = piece, None
            nxt = after[left] = after[right]
            if nxt >= 0:
                before[nxt] = left
                if (turn := find(piece + symbols[nxt])) is not None:
                    push(waiting, turn + (left << LENGTH))
            prev = before[left]
            if prev >= 0 and (turn := find(symbols[prev] + piece)) is not None:
                push(waiting, turn + (prev << LENGTH))
        return [s for s in symbols if s is not None]

    def spelled(self, ids: list[int]) -> str:
        """What the pieces of ``ids`` spell, with spaces; runs of byte pieces are read as UTF-8."""
        if self.byte_of.keys().isdisjoint(ids):
            return "".join(map(self.surfaces.__getitem__, ids))
        out: list[str] = []
        for as_bytes, run in groupby(ids, self.byte_of.__contains__):
            out.append(bytes(map(self.byte_of.__getitem__, run)).decode(errors="each_byte") if as_bytes else "".join(map(self.surfaces.__getitem__, run)))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``, without the space that encoding puts in front."""
        text = self.spelled(ids)
        return text[1:] if ids and self.pieces[ids[0]].startswith(SPACE) else text

    def _part(self, part: str) -> str:
        ids = self.agenda(part)
        if self.spelled(ids) != part.replace(SPACE, " "):
            self.odd_parts.add(part)
        return ",".join(map(str, ids))

    def _word(self, word: str) -> str:
        # letters alone are one part
        parts = [SPACE + word] if word.isalpha() else self._split(SPACE + word)
        ids = ",".join(map(self.known.__getitem__, parts)) if len(parts) > 1 else self.known[parts[0]]
        if not self.odd_parts.isdisjoint(parts):
            self.odd.add(word)
        self.new.append((word, ids))
        return ids

    def _in_words(self, words: list[str]) -> bool:
        """Whether a text's words, parted by one space each, can be encoded one by one."""
        return self.parts is not None and "" not in words

    def encoded(self, texts: list[str]) -> list[tuple[str, str]]:
        """Ids, as decimal numbers joined by commas, and the decoded text, for each text; the empty text has none."""
        out = []
        for t in texts:
            words = t.split(" ") if SPACE not in t else [""]
            if self._in_words(words):
                ids = ",".join(map(self.words.__getitem__, words))
                # each part was decoded when it was first met
                plain = self.odd.isdisjoint(words)
            else:
                ids = ",".join(map(self.known.__getitem__, self._split(SPACE + t.replace(" ", SPACE)) if t else ()))
                plain = False
            out.append((ids, t if plain else self.decode(list(map(int, ids.split(","))) if ids else [])))
            self.known.turn()
            self.words.turn()
        return out

    def _differ(self, own: list[tuple[str, str, str]]) -> list[bool]:
        """Whether the library has other ids or another text for these (text, ids, decoded)."""
        if not own:
            return []
        theirs = self.library.encode([t for t, _, _ in own], num_threads=1)
        back = iter(self.library.decode([ids for ids in theirs if ids], num_threads=1) if any(theirs) else [])
        return [(ids, text) != (",".join(map(str, t)), next(back) if t else "") for (_, ids, text), t in zip(own, theirs, strict=True)]

    def agreeing(self, texts: list[str], got: list[tuple[str, str]]) -> list[bool]:
        """Whether the library agrees with what ``encoded`` gave.

        Words are compared when they are first met, and texts as a whole where they were not
        taken word by word.
        """
        new, self.new = self.new, []
        own = [(w, ids, self.decode(list(map(int, ids.split(",")))) if w in self.odd else w) for w, ids in new]
        self.bad |= {w for (w, _), differs in zip(new, self._differ(own), strict=True) if differs}
        words = [t.split(" ") if SPACE not in t else [""] for t in texts]
        whole = [i for i, w in enumerate(words) if not self._in_words(w)]
        out = [self.bad.isdisjoint(w) for w in words]
        for i, differs in zip(whole, self._differ([(texts[i], *got[i]) for i in whole]), strict=True):
            out[i] = not differs
        return out

    def _split(self, text: str) -> list[str]:
        return self.parts.findall(text) if self.parts else [text]


def _portions(texts: list[str]) -> Iterator[list[str]]:
    """``texts`` in order, a bounded number and length at a time."""
    held: list[str] = []
    size = 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= AT_ONCE or len(held) >= TEXTS:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", check: bool = True) -> DataFrame:
    """id_col, ids (array), decoded and, with ``check``, agrees: whether the library has the same ids and the same text.

    Every row of ``docs`` gives one row, whatever its id. A null text counts as the empty
    one, which has no ids and decodes to itself. Texts are taken whole, however long; a
    part without a cut of any length takes n log n steps. Other columns are left behind,
    and an empty table gives no rows.
    """
    return _encoded(docs, path, id_col, text_col, check, False)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", check: bool = True) -> DataFrame:
    """id_col, n_tokens, ids_sha256, decoded_sha256 and agrees of what ``encode`` gives, made where the ids are."""
    return _encoded(docs, path, id_col, text_col, check, True)


def _encoded(docs: DataFrame, path: str, id_col: str, text_col: str, check: bool, digest: bool) -> DataFrame:
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.shared(path)
        for batch in batches:
            at = 0
            for texts in _portions([t or "" for t in batch.column(1).to_pylist()]):
                keys = batch.column(0).slice(at, len(texts))
                at += len(texts)
                got = pieces.encoded(texts)
                same = pieces.agreeing(texts, got) if check else [None] * len(texts)
                pieces.new.clear()
                if digest:
                    cols = [pa.array([ids.count(",") + bool(ids) for ids, _ in got], pa.int64()), *(pa.array([sha(g[k]) for g in got], pa.string()) for k in (0, 1))]
                    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "agrees"]
                else:
                    cols = [pa.array([list(map(int, ids.split(","))) if ids else [] for ids, _ in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.string())]
                    names = [id_col, "ids", "decoded", "agrees"]
                yield pa.RecordBatch.from_arrays([keys, *cols, pa.array(same, pa.bool_())], names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    made = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded string"
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(rows, f"`{id_col}` {kind}, {made}, agrees boolean")


def op11_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tidewright.llm.common import read

    return digests(read(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
