"""SentencePiece (BPE) encoding and decoding.

The encoder never keeps a heap of merges. It walks the text from the left:
the longest vocabulary piece at a position comes from an Aho-Corasick
automaton (run over the reversed text, so that matches *start* where they
are reported), and a piece may follow another only if merging the two
pieces' characters anew gives exactly these two (merges are local, so a
sequence whose neighbours all agree is the one that merging the whole text
gives). A piece that may not follow is replaced by its longest shorter
prefix; when none is left, the position is marked as failed in a bit field
and the piece before it is taken back.

Texts are cut where no vocabulary piece can reach across (before white
space that follows other characters, around line feeds, after letters); results for these
units are kept in a bounded table per worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.llm.common import byte_chunks, ids_and_texts, map_batches, read

SPACE = "▁"
MODEL = "piece_bpe_32k.model"
#: entries of a worker's table of units, and the longest unit kept
MEMO, MEMO_CHARS = 400_000, 48


class _Memo(dict):
    """A table that fills itself and starts anew when it is full."""

    def __init__(self, make, most: int):
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self.make(key)
        if len(key) <= MEMO_CHARS:
            self[key] = value
        return value


class Pieces:
    """A BPE piece model with byte fallback, read from a model file.

    Pieces are numbered by their ids; a character that is no piece stands
    for itself as a negative number until its UTF-8 bytes are written out.
    """

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.eos = sp.eos_id()
        self.text, self.rank, self.byte_id, self.byte_of = [""] * n, {}, {}, {}
        order = []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_of[i] = int(piece[3:5], 16)
                self.byte_id[self.byte_of[i]] = i
            elif sp.is_unknown(i):
                self.text[i] = " ⁇ "
            elif not sp.is_control(i) and not sp.is_unused(i):
                self.text[i] = piece
                order.append((-sp.get_score(i), i))
        self.id_of = {self.text[i]: i for _, i in order}
        self.rank = {self.text[i]: score for score, i in order}
        self.plain = [t.replace(SPACE, " ") for t in self.text]
        for i, b in self.byte_of.items():
            if b < 128:
                self.plain[i] = chr(b)
        self.high = np.array(sorted(i for i, b in self.byte_of.items() if b >= 128), np.int64)
        self.longest = max(map(len, self.id_of))
        self.automaton = ahocorasick.Automaton()
        for t in self.id_of:
            self.automaton.add_word(t[::-1], t)
        self.automaton.make_automaton()
        self.cut = self._cuts()
        self.units = _Memo(self._encode_unit, MEMO)
        self.agree = _PairMemo(self, MEMO)
        self.shorter = _Memo(self._shorter, MEMO)

    def _cuts(self) -> re.Pattern | None:
        """A pattern whose matches are the units of a text: it cuts before
        white space that follows something else, around line feeds, and
        between a letter and such other characters as follow a letter in no
        piece. None when some piece reaches across such a place."""
        if any(SPACE in t.lstrip(SPACE) for t in self.id_of) or any("\n" in t and len(t) > 1 for t in self.id_of):
            return None
        letter = re.compile(r"[^\W\d_]")
        follow = {b for t in self.id_of for a, b in zip(t, t[1:]) if letter.match(a) and not letter.match(b)}
        other = f"(?![{SPACE}\n])[\\W\\d_]"
        stay = f"[{re.escape(''.join(sorted(follow)))}]" if follow else "(?!)"
        return re.compile(rf"(?!\n){SPACE}*(?:{other})*(?:[^\W\d_]+(?:{stay}(?:{other})*)?)*|\n")

    # -- encoding

    def merge(self, text: str) -> list[str]:
        """Plain merging: again and again the adjacent two whose joined text
        has the best score, the leftmost of equals. For short texts."""
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            best = min(((rank[j], i) for i in range(len(parts) - 1) if (j := parts[i] + parts[i + 1]) in rank), default=None)
            if best is None:
                break
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _shorter(self, piece: str) -> str:
        """The longest piece that is a proper prefix ('' if none); a single
        character always counts as one."""
        for n in range(len(piece) - 1, 1, -1):
            if piece[:n] in self.id_of:
                return piece[:n]
        return piece[:1] if len(piece) > 1 else ""

    def backtrack(self, text: str) -> list[str]:
        """The pieces of ``text`` by longest match and backtracking."""
        n = len(text)
        longest = list(text)
        seen = -1
        for end, piece in self.automaton.iter(text[::-1]):
            if end != seen:  # the first one reported at an end is the longest
                seen = end
                longest[-1 - end] = piece
        failed = 0  # bit field: no way to go on from these positions
        out: list[str] = []
        pos, last = 0, ""
        agree, shorter = self.agree, self.shorter
        while pos < n:
            piece = longest[pos]
            while True:
                end = pos + len(piece)
                if not failed >> end & 1 and agree[last, piece]:
                    out.append(piece)
                    pos, last = end, piece
                    break
                piece = shorter[piece]
                while not piece:  # take the piece before back, go on with shorter ones
                    failed |= 1 << pos
                    piece = out.pop()
                    pos -= len(piece)
                    last = out[-1] if out else ""
                    piece = shorter[piece]
        return out

    def _encode_unit(self, unit: str) -> tuple[int, ...]:
        ids: list[int] = []
        for p in self.backtrack(unit):
            i = self.id_of.get(p)
            if i is None:
                ids.extend(self.byte_id[b] for b in p.encode())
            else:
                ids.append(i)
        return tuple(ids)

    def encode(self, text: str) -> np.ndarray:
        """The ids of one text, the end id last."""
        if not text:
            return np.array([self.eos], np.int32)
        text = SPACE + text.replace(" ", SPACE)
        units = self.cut.findall(text) if self.cut else [text]
        return np.fromiter(chain(chain.from_iterable(map(self.units.__getitem__, units)), (self.eos,)), np.int32)

    # -- decoding

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces joined, runs of byte pieces read as UTF-8
        (U+FFFD for each byte that is not part of a character), the space
        put before the text taken away, control ids left out."""
        if len(ids) and np.isin(ids, self.high).any():
            out, run = [], bytearray()
            for i in ids.tolist():
                if i in self.byte_of:
                    run.append(self.byte_of[i])
                    continue
                if run:
                    out.append(_utf8(bytes(run)))
                    run.clear()
                out.append(self.plain[i])
            out.append(_utf8(bytes(run)))
            text = "".join(out)
        else:
            text = "".join(map(self.plain.__getitem__, ids.tolist()))
        return text[1:] if text.startswith(" ") else text


class _PairMemo(dict):
    """Whether the second piece may follow the first ('' : none before)."""

    def __init__(self, model: Pieces, most: int):
        self.model, self.most = model, most

    def __missing__(self, pair):
        if len(self) >= self.most:
            self.clear()
        a, b = pair
        value = self[pair] = self.model.merge(a + b) == ([a, b] if a else [b])
        return value


def _utf8(run: bytes) -> str:
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(run):
            for n in (1, 2, 3, 4):
                try:
                    out.append(run[i:i + n].decode())
                    i += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                i += 1
        return "".join(out)


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    """One model a worker process."""
    return Pieces(path)


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encode_decode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``(doc_id, ids array<int>, decoded string)`` for every row of ``docs``:
    the ids of its whole text, with the end id last, and the text that they
    decode to.

    A NULL text is the empty text (the end id alone, decoded ''); NULL ids
    and repeated rows are kept as they are, other columns are not looked at,
    an empty table gives an empty result. ``model`` is a file name of the
    public tokenizers, which every machine has installed.
    """
    d = ids_and_texts(docs)
    kind = d.schema["doc_id"].dataType.simpleString()

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model_path(model))
        for batch in it:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in byte_chunks(texts):
                ids = [pieces.encode(t) for t in texts[a:b]]
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids))),
                     pa.array([pieces.decode(x) for x in ids], pa.string())], names=["doc_id", "ids", "decoded"])

    return map_batches(d, batches, f"doc_id {kind}, ids array<int>, decoded string")


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """``(doc_id, *more, n_tokens, ids_sha256, decoded_sha256)``."""
    return encoded.select("doc_id", *more, F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode_decode(read(spark, sf_dir, "documents")))
