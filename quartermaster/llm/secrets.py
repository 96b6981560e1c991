"""Secret scans: fixed patterns plus a guess-cost estimate of values that
stand in a credential context.

Base kinds (leftmost, non-overlapping, each kind by itself): ``assign``
(a credential word, ``:`` or ``=``, a value of 6 or more), ``access``
(``AKIA`` keys of 20 or more) and ``hex`` (24 or more digits).

The method adds kind ``guess``: a value after a credential word (a wider
set of words and separators) is cut, by dynamic programming, into dictionary
words (some 30,000, ranked by how common they are), dates, repeats, keyboard walks and brute-force spans such that the
product of the parts' guesses is smallest; the value is a secret when even
that cheapest way takes ``10 ** MIN_LOG_GUESSES`` guesses. Prose after "is",
placeholders and code are left alone.

All spans are code points, end exclusive, and cover the whole match (the
value alone for ``guess``).
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.llm.common import ids_and_texts, map_batches, read

KINDS = ("assign", "access", "hex", "guess")
#: values that take fewer guesses, or are shorter, are left alone
MIN_LOG_GUESSES, MIN_CHARS = 10.0, 8

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a run is one match, so this is the runs of 24 and more
# the base words anywhere, the others where a word starts, also in camel case
_CONTEXT = re.compile(r"""(?:(?:(?<![A-Za-z0-9])|(?-i:(?<=[a-z0-9])(?=[A-Z])))(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|auth|login|(?:api|access|private|secret)[_-]?key)|password|passwd|secret|token|api[_-]?key)["']?\x20*([:=]|=>|->|\bis\b)\x20*["']?([^\s"',;<>()]{8,})""", re.I | re.A)
#: every context holds one of these (a cheap test before the patterns)
_HINTS = ("pass", "pwd", "secret", "token", "credential", "auth", "login", "key")

#: vocabulary of a public tokenizer: its whole words rank by how early they were merged, which is how common they are
VOCABULARY = "byte_bpe_50k.json"
LEAST_WORD = 3
#: what a piece of the vocabulary begins with where a word begins
_WORD_START = chr(0x120)

# Words that people put into passwords, most common first; they
# rank before the vocabulary's.
WORDS = """password admin welcome login master dragon monkey letmein qwerty
sunshine princess football baseball shadow superman batman trustno hello
freedom whatever secret token test default root user guest changeme change
temp example sample demo dummy none null true false your here insert enter
value string secretkey apikey api key access auth love summer winter spring
autumn monday friday january june july august october december michael
jordan jennifer thomas charlie ashley daniel computer internet server
database system service account private public company office money
iloveyou""".split()

# Values that are no secret, whatever they would cost to guess. Prose ("the
# password is forgotten"):
_PROSE = re.compile(r"[^\W\d_]+(?:[-'\u2019][^\W\d_]+)*")
# variables, templates and masks to be filled in:
_PLACEHOLDER = re.compile(r"\$\{[^}]*\}?|\$\(.*|\$(?:[A-Z_]+|[a-z_]+)|%\(?(?:[A-Z_]+|[a-z_]+)\)?[sd%]?|\{+[^{}]*\}*|\*+|[xX]+|\.+|-+|_+")
# names in code: paths, constants and variables of several words without digits,
_NAME = re.compile(r"[A-Za-z_]+(?:(?:\.|::|->)[A-Za-z_]+)+|[A-Z]+(?:_[A-Z]+)+|[a-z]+(?:_[a-z]+)+")
# and whatever is called or indexed
_CALLED = re.compile(r"[A-Za-z_]\w*(?:(?:\.|::|->)[A-Za-z_]\w*)*[(\[]", re.A)

# Rows of a US keyboard, each a half key right of the one above.
KEY_ROWS = ("`1234567890-=", " qwertyuiop[]\\", " asdfghjkl;'", " zxcvbnm,./")

# Characters that stand for letters.
LEET = {"4": "a", "@": "a", "3": "e", "1": "i", "!": "i", "0": "o", "5": "s", "$": "s", "7": "t"}

_DATES = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?"
                    r"|(?:0?[1-9]|[12]\d|3[01])[-/._](?:0?[1-9]|1[0-2])[-/._](?:(?:19|20)\d\d|\d\d)")


# --------------------------------------------------------------- guess cost

@lru_cache(maxsize=1)
def _adjacent() -> dict[str, frozenset[str]]:
    at = {c: (r, i) for r, row in enumerate(KEY_ROWS) for i, c in enumerate(row) if c != " "}
    steps = ((0, -1), (0, 1), (-1, 0), (-1, 1), (1, -1), (1, 0))
    by_place = {p: c for c, p in at.items()}
    return {c: frozenset(by_place[p] for dr, di in steps if (p := (r + dr, i + di)) in by_place) for c, (r, i) in at.items()}


@lru_cache(maxsize=1)
def _words() -> tuple[dict[str, int], int]:
    """Ranks of words (from 1), and the longest one's length: ``WORDS``, then
    the words of the vocabulary that stand for themselves, in its order."""
    import public_tokenizers

    with open(public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    rank = {}
    for w in chain(WORDS, (p[1:].lower() for p in sorted(vocabulary, key=vocabulary.get) if p[0] == _WORD_START and p[1:].isascii() and p[1:].isalpha())):
        if len(w) >= LEAST_WORD:
            rank.setdefault(w, len(rank) + 1)
    return rank, max(map(len, rank))


def _alphabet(text: str) -> int:
    """How many characters a brute-force guesser would try at each place."""
    n = (26 * any("a" <= c <= "z" for c in text) + 26 * any("A" <= c <= "Z" for c in text)
         + 10 * any(c.isdigit() for c in text) + 33 * any(not c.isalnum() and c < "\x7f" for c in text)
         + 100 * any(c >= "\x7f" for c in text))
    return max(n, 2)


def spans_with_cost(value: str) -> Iterator[tuple[int, int, str, float]]:
    """``(start, end, kind, log10 of guesses)``: words, dates, repeats and
    keyboard walks in ``value``. Runs (repeats and walks) are given whole and
    from each start on to their end."""
    low = value.lower()
    plain = "".join(LEET.get(c, c) for c in low)
    rank, longest = _words()
    n = len(value)
    for i in range(n):
        for j in range(i + 3, min(n, i + longest) + 1):
            for form, leet in ((low[i:j], 0), (plain[i:j], 1)):
                if form in rank and not (leet and low[i:j] == form):
                    upper = value[i:j] != low[i:j]
                    yield i, j, "word", math.log10(rank[form] * 2 ** (upper + leet) + 1)
                    break
    for i in range(n):
        m = _DATES.match(value, i)
        if m:
            yield i, m.end(), "date", math.log10(365 * 200 if m.end() - i > 4 else 200)
    i = 0
    while i < n:  # one character again and again
        j = i + 1
        while j < n and value[j] == value[i]:
            j += 1
        for a in range(i, j - 2):
            yield a, j, "repeat", math.log10(_alphabet(value[i]) * (j - a))
        i = j
    for m in re.finditer(r"(.{2,12}?)\1+", value, re.S):  # a block again and again
        block = m.group(1)
        yield m.start(), m.end(), "repeat", len(block) * math.log10(_alphabet(block)) + math.log10((m.end() - m.start()) // len(block))
    near = _adjacent()
    i = 0
    while i < n:
        j, turns, last = i + 1, 1, None
        while j < n and low[j] in near.get(low[j - 1], ()):
            step = (ord(low[j]) - ord(low[j - 1]))
            turns += last is not None and step != last
            last = step
            j += 1
        for a in range(i, j - 2):
            yield a, j, "walk", math.log10(47 * (j - a) * 4 ** min(turns, j - a))
        i = j


def log_guesses(value: str) -> float:
    """log10 of the guesses that the cheapest segmentation takes: the parts'
    guesses multiplied, and a factor of 2 for each part after the first (the
    guesser does not know where parts end). Time grows with the length."""
    n = len(value)
    ending: dict[int, list[tuple[int, float]]] = {}
    for i, j, _, cost in spans_with_cost(value):
        ending.setdefault(j, []).append((i, cost))
    char = math.log10(_alphabet(value))
    part = math.log10(2)
    best = [0.0] + [math.inf] * n  # up to here, at a border
    brute = math.inf  # up to here, within a brute-force span
    for j in range(1, n + 1):
        brute = min(brute, best[j - 1] + (part if j > 1 else 0.0)) + char
        best[j] = min([brute, *(best[i] + cost + (part if i else 0.0) for i, cost in ending.get(j, ()))])
    return best[n]


# -------------------------------------------------------------------- spans

def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the fixed patterns."""
    low = text.lower()
    found = [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if any(h in low for h in _HINTS):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    return found


def guess_spans(text: str) -> list[tuple[int, int, str, float]]:
    """``(start, end, "guess", log10 of guesses)`` of values in a credential
    context that are hard to guess."""
    low = text.lower()
    if not any(h in low for h in _HINTS):
        return []
    found = []
    for m in _CONTEXT.finditer(text):
        value, start = m.group(2).rstrip(".:!?"), m.start(2)
        if len(value) < MIN_CHARS or _is_no_secret(m.group(1), value, text[start:start + len(m.group(2)) + 1]):
            continue
        if (cost := log_guesses(value)) >= MIN_LOG_GUESSES:
            found.append((start, start + len(value), "guess", cost))
    return found


def _is_no_secret(sign: str, value: str, before_next: str) -> bool:
    """Prose after "is", placeholders and code."""
    return bool(sign.lower() == "is" and _PROSE.fullmatch(value) or _PLACEHOLDER.fullmatch(value) or _NAME.fullmatch(value)
                or _CALLED.match(before_next))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("log_guesses", pa.float64())])


def _scan(text: str) -> list[dict]:
    found = [(*s, None) for s in base_spans(text)] + guess_spans(text)
    found.sort(key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return [{"start": a, "end": b, "kind": k, "log_guesses": g} for a, b, k, g in found]


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans array<struct<kind, start, end, log_guesses>>)`` for
    every row of ``docs``, spans by start, then in the order of ``KINDS``.

    NULL and empty texts have none; rows that repeat are scanned each; a NULL
    doc_id is kept; an empty table gives an empty result; other columns are
    not looked at.
    """
    d = ids_and_texts(docs)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            spans = [_scan(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(_SPAN))], names=["doc_id", "spans"])

    return map_batches(d, batches, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, "
                                   "spans array<struct<kind string, start int, end int, log_guesses double>>")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return scan(read(spark, sf_dir, "documents")).select(
        "doc_id", _count("assign").alias("n_assign"), _count("access").alias("n_access"), _count("hex").alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
        _count("guess").alias("n_guess"))
