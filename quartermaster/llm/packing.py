"""Packing of documents into training sequences, online in bounded space.

A document is its token ids with an end id. Each task keeps at most ``OPEN``
open windows of ``size`` ids and places what is left of a document after its
full windows into the open window that it fits best. When it fits in none, the
fullest window goes: topped up with the first ids of the piece (the rest is
placed like a new piece), or as it is when fewer than ``least_cut`` places
are free.

The windows that a task leaves open are few whatever it has read. Their
pieces are dealt to fewer tasks and placed again, longest first, until what
is left is small enough for one task; there the last open windows are joined,
and the last sequence of all is cut at powers of two, which need no padding.

What a level has made is written before the next one reads it, so that a task
that runs again cannot place a document twice.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.llm.common import ids_and_texts, map_batches, read, stage

TOKENIZER = "byte_bpe_50k.json"
SIZE, END_ID, OPEN, LEAST_CUT = 1024, 0, 64, 8
#: ids of open windows that one task of a later level places, at least (and four tasks' open windows)
GATHERED = 1 << 19
#: entries of a worker's tables of words (and as many old ones), and the longest word kept
MEMO, MEMO_CHARS = 400_000, 48
#: characters after which a long text is cut for encoding, where no token can reach across
_LONG = 1 << 20
#: bytes of ids in a batch of results
_BATCH_BYTES = 1 << 22

# Ranges whose character classes are the same in the Unicode
# tables of ``regex`` and of ``tokenizers``; texts with others are encoded whole.
_SURE = ((0x0, 0x557), (0x590, 0x87F), (0x900, 0xC5B), (0xC5D, 0xCDB), (0xCDD, 0x208E), (0x20A0, 0xA7CD),
         (0xA7F2, 0xAB6B), (0xAB6E, 0xFFFF), (0x1F000, 0x1FBFF), (0x20000, 0x2B738))
#: first character after the Latin letters, whose classes do not change
_LATIN_END = "\u0250"


# ------------------------------------------------------------------- tokens

class _Memo(dict):
    """Ids of words, as bytes. It fills itself; when it is full, its entries
    become the old ones and those that are not asked for until it is full
    again go, so that common words stay."""

    def __init__(self, make):
        self.make, self.old = make, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.make(word)
            if len(word) > MEMO_CHARS:
                return ids
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids


def _letters_of_bytes() -> dict[int, str]:
    """The character that byte-level models write for each byte: itself where
    it is printable in Latin-1, otherwise the next one from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    others = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


class Tokens:
    """A byte-level BPE of the tokenizers library: texts to ids, which stand
    one after the other as unsigned little-endian 32-bit numbers.

    Merges stay within the words that the tokenizer's pattern cuts, and no
    word holds a space but at its beginning. So texts are cut before spaces
    that follow other characters than white space; each different unit is cut
    by the pattern and its words are encoded by the library's model, and the
    ids are kept in a table. Texts with special tokens, or with characters
    whose classes are not sure, and all texts of tokenizers that have other
    steps, are encoded by the library as a whole."""

    def __init__(self, path: str, pattern: str):
        import numpy as np
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        steps = json.loads(tokenizer.to_str())
        before = steps["pre_tokenizer"] or {}
        self.plain = (before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
                      and steps["model"]["type"] == "BPE" and not steps["model"].get("dropout")
                      and not any(steps.get(k) for k in ("normalizer", "truncation", "padding")))
        model, letters = tokenizer.model, _letters_of_bytes()

        def whole(text: str) -> bytes:
            return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

        def word(text: str) -> bytes:
            return b"".join([t.id.to_bytes(4, "little") for t in model.tokenize(text.encode().decode("latin-1").translate(letters))])

        self.whole, self.words = whole, regex.compile(pattern)
        narrow = pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\sA-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
        self.ascii_words = re.compile(narrow, re.A) if r"\p" not in narrow else self.words
        self.unsure = regex.compile("[^" + "".join(f"{chr(a)}-{chr(b)}" for a, b in _SURE) + "]")
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.border = regex.compile(r"(?<=\S)(?=\s)")
        self.spaces = re.compile(r"[\s\x85]\x20")  # a space that must not be cut before
        self.make = word
        self.word, self.after_space = _Memo(word), _Memo(self._unit)

    def _unit(self, unit: str) -> bytes:
        """The ids of a unit and the space before it."""
        if unit.isalpha() and (unit.isascii() or max(unit) < _LATIN_END):
            return self.make(" " + unit)
        first, *more = (self.ascii_words if unit.isascii() else self.words).findall(" " + unit)
        if not more:
            return self.make(first)
        return (self.after_space[first[1:]] if first != " " else self.word[first]) + b"".join(map(self.word.__getitem__, more))

    def _words(self, text: str) -> bytes:
        return b"".join(map(self.word.__getitem__, (self.ascii_words if text.isascii() else self.words).findall(text)))

    def _encode(self, text: str) -> bytes:
        if not self.plain or self.unsure.search(text) or any(s in text for s in self.special):
            return self.whole(text)
        if text.startswith(" ") or self.spaces.search(text):
            return self._words(text)
        units = text.split(" ")
        return self._words(units[0]) + b"".join(map(self.after_space.__getitem__, units[1:]))

    def encode(self, text: str) -> bytes:
        """The ids of a text, special tokens in it included, none added."""
        parts, at = [], 0
        while len(text) - at > _LONG and self.plain:
            cut = self.border.search(text, at + _LONG)
            if not cut:
                break
            parts.append(self._encode(text[at:cut.start()]))
            at = cut.start()
        parts.append(self._encode(text[at:]))
        return b"".join(parts)


@lru_cache(maxsize=2)
def tokens(name: str) -> Tokens:
    """One tokenizer a worker process, from the public tokenizers that every
    machine has installed."""
    import public_tokenizers
    return Tokens(public_tokenizers.path(name), public_tokenizers.PATTERN)


# ------------------------------------------------------------------ windows

class Windows:
    """Open windows of ``size`` ids. A piece is ``(doc_id, start, ids,
    doc_tokens)`` with four bytes an id; ``put`` and ``join`` yield windows
    that are done, each a list of pieces."""

    def __init__(self, size: int = SIZE, most: int = OPEN, least_cut: int = LEAST_CUT):
        self.size, self.most, self.least_cut = size, most, least_cut
        self.free: list[tuple[int, int]] = []  # (free places, window), sorted
        self.pieces: dict[int, list] = {}
        self.made = 0

    def put(self, doc, start: int, ids: bytes, total: int) -> Iterator[list]:
        size = self.size
        whole = len(ids) // 4 // size * size
        for a in range(0, whole, size):
            yield [(doc, start + a, ids[4 * a:4 * (a + size)], total)]
        start, ids = start + whole, ids[4 * whole:]
        while ids:
            n = len(ids) // 4
            i = bisect_left(self.free, (n, -1))
            if i < len(self.free):  # the least free places that are enough
                free, w = self.free.pop(i)
                self.pieces[w].append((doc, start, ids, total))
                if free == n:
                    yield self.pieces.pop(w)
                else:
                    insort(self.free, (free - n, w))
                return
            if len(self.free) < self.most:
                self.pieces[self.made] = [(doc, start, ids, total)]
                insort(self.free, (size - n, self.made))
                self.made += 1
                return
            free, w = self.free.pop(0)
            done = self.pieces.pop(w)
            if free >= self.least_cut:
                done.append((doc, start, ids[:4 * free], total))
                start, ids = start + free, ids[4 * free:]
            yield done

    def rest(self) -> list[list]:
        """The open windows, fullest first."""
        return [self.pieces[w] for _, w in self.free]

    def join(self) -> Iterator[list]:
        """The open windows one after the other, cut into full ones; the last
        one cut at powers of two."""
        done, room = [], self.size
        left = sum(len(p[2]) // 4 for w in self.rest() for p in w)
        for doc, start, ids, total in (p for w in self.rest() for p in w):
            while ids:
                if not done:
                    room = self.size if left >= self.size else 1 << left.bit_length() - 1
                n = min(room, len(ids) // 4)
                done.append((doc, start, ids[:4 * n], total))
                start, ids, room, left = start + n, ids[4 * n:], room - n, left - n
                if not room:
                    yield done
                    done = []


class _Rows:
    """Windows as record batches of bounded size."""

    def __init__(self, kind: pa.DataType, level: int):
        self.kind, self.next = kind, level << 56 | TaskContext.get().partitionId() << 32
        self.rows, self.bytes = [], 0

    def add(self, window: list, is_open: bool = False) -> None:
        offset = 0
        for doc, start, ids, total in window:
            self.rows.append((doc, start, ids, total, self.next, offset, is_open))
            offset += len(ids) // 4
        self.bytes += 4 * offset + 64 * len(window)
        self.next += 1

    def full(self) -> bool:
        return self.bytes > _BATCH_BYTES

    def batch(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows)) or [()] * 7
        self.rows, self.bytes = [], 0
        kinds = (self.kind, pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=_NAMES)


_NAMES = ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset", "open"]


def _pieces_of_texts(batch: pa.RecordBatch, tokenizer: str, end: bytes) -> Iterator[tuple]:
    encode = tokens(tokenizer).encode
    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        ids = encode(text.as_py() or "") + end
        yield doc, 0, ids, len(ids) // 4


def _pieces_of_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(batch.column(i).to_pylist() for i in range(4)))


def _placed(df: DataFrame, pieces, level: int, last: bool, size: int, most: int, least_cut: int) -> DataFrame:
    """Every partition's pieces placed into windows of its own."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, rows = Windows(size, most, least_cut), None
        for batch in it:
            rows = rows or _Rows(batch.schema.field(0).type, level)
            for piece in pieces(batch):
                for done in windows.put(*piece):
                    rows.add(done)
                if rows.full():
                    yield rows.batch()
        if rows:
            for w in windows.join() if last else windows.rest():
                rows.add(w, not last)
            yield rows.batch()

    kind = df.schema["doc_id"].dataType.simpleString()
    return map_batches(df, batches, f"doc_id {kind}, start long, ids binary, doc_tokens long, sequence_id long, offset int, open boolean")


def pack(docs: DataFrame, size: int = SIZE, tokenizer: str = TOKENIZER, end_id: int = END_ID,
         most_open: int = OPEN, least_cut: int = LEAST_CUT) -> DataFrame:
    """``(doc_id, start, ids, doc_tokens, sequence_id, offset)``: one row per
    piece. ``ids`` are unsigned little-endian 32-bit numbers (binary),
    ``start`` counts the document's ids before the piece, ``doc_tokens`` all
    its ids with the end id, ``offset`` is the piece's place in its sequence.

    A NULL or empty text is the end id alone; rows without doc_id and rows
    that repeat are documents of their own; very long texts fill windows of
    their own and are encoded in parts; an empty table gives an empty result;
    other columns are not looked at. ``sequence_id`` is unique, not gapless.
    """
    how = size, most_open, least_cut
    gathered = max(GATHERED, 4 * most_open * size)
    end = end_id.to_bytes(4, "little")
    placed = stage(_placed(ids_and_texts(docs), lambda b: _pieces_of_texts(b, tokenizer, end), 0, False, *how))
    out, level, last = placed.filter("not open"), 0, False
    while not last:
        rest, level = placed.filter("open"), level + 1
        left = rest.agg(F.sum(F.octet_length("ids") / 4)).first()[0] or 0
        if not left:
            break
        last = left <= gathered
        parts = 1 if last else int(left // gathered) + 1  # each leaves most_open windows at most
        dealt = rest.repartition(parts)
        # a total order, whichever way the rows came
        dealt = dealt.sortWithinPartitions(F.octet_length("ids").desc(), "sequence_id", "offset").select(*_NAMES[:4])
        placed = stage(_placed(dealt, _pieces_of_rows, level, last, *how))
        out = out.unionByName(placed.filter("not open"))
    return out.drop("open")


def n_ids(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents")).select(
        "doc_id", "start", n_ids(F.col("ids")).alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", F.col("offset").cast("long").alias("offset"))
