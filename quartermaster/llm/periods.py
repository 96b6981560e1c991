"""Runs of words that repeat with a period, by multi-scale minimizers.

A run is a maximal stretch of consecutive words with smallest period ``q``
that is at least ``EXPONENT`` (4) periods and ``LEAST`` (6) words long.

*Scales*: for ``g`` = 16, 32, 64, ... the hashes of all ``g`` consecutive
words (a gram) are made from those of half as many. Scale ``g`` finds the
periods from ``g / 2 + 1`` to ``g``. Of every ``g / 2`` consecutive grams the
one with the smallest hash is selected, the rightmost of equals. Inside a run
with such a period q the grams repeat at distance q and at no smaller one (a
gram is as long as the period: a smaller distance would be a smaller period),
so equal windows of grams select equal places; as the run has
``4 q - g + 1 >= q + g / 2`` grams, two selected grams lie q apart in it.

*Seeds*: selected grams with equal hashes that follow each other at a
distance of the scale's periods. Two such grams overlap or touch, so a seed
already lies in a stretch that repeats; it is extended to both sides by
comparing the words, and stretches that are too short, or whose period is a
multiple of a smaller one, go.

*Short periods*, 1 to 8, are found by comparing each word with the one q
before it.

Texts of a batch are searched together, parted by numbers that occur once.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.llm.common import binary_column, byte_chunks, ids_and_texts, map_batches, read

EXPONENT, LEAST = 4, 6
#: the longest period that is looked for by comparing words at its distance
SHORT = 8
WORD = r"[^\x20\x09-\x0D]+"


# ----------------------------------------------------------------- one array

def _stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of True of at least ``least``."""
    turns = np.flatnonzero(np.diff(np.concatenate(([False], equal, [False])).view(np.int8)))
    starts, lengths = turns[::2], turns[1::2] - turns[::2]
    long = lengths >= least
    return starts[long], lengths[long]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _selected(h: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest of every ``window`` (a power of two) consecutive
    hashes, the rightmost of equals."""
    least, place = h, np.arange(len(h))
    width = 1
    while width < window:
        a, b = least[:-width], least[width:]
        right = b <= a
        least, place = np.where(right, b, a), np.where(right, place[width:], place[:-width])
        width *= 2
    return place[np.concatenate(([True], place[1:] != place[:-1]))] if len(place) else place


def _same_ahead(w: np.ndarray, p: int, q: int) -> int:
    """How many words from ``p`` on equal the ones ``q`` later."""
    n, step = p, 64
    while True:
        a, b = w[n:n + step], w[n + q:n + q + step]
        a = a[:len(b)]
        other = np.flatnonzero(a != b)
        if len(other):
            return n + int(other[0]) - p
        n += len(a)
        if len(a) < step:
            return n - p
        step *= 2


def _same_behind(w: np.ndarray, p: int, q: int) -> int:
    """How many words right before ``p`` equal the ones ``q`` later."""
    n, step = p, 64
    while n:
        low = max(0, n - step)
        other = np.flatnonzero(w[low:n] != w[low + q:n + q])
        if len(other):
            return p - (low + int(other[-1]) + 1)
        n, step = low, step * 2
    return p


def _divided(w: np.ndarray, start: int, q: int) -> bool:
    """Whether a stretch of period ``q`` (twice as long at least) has a
    smaller period: then one that divides q by a prime."""
    rest, f = q, 2
    while rest > 1:
        if f * f > rest:
            f = rest
        if rest % f == 0:
            d = q // f
            if np.array_equal(w[start:start + q], w[start + d:start + d + q]):
                return True
            while rest % f == 0:
                rest //= f
        f += 1
    return False


def runs(w: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, length, period)`` of all runs in ``w`` (numbers of words;
    texts are parted by numbers that occur once), by start, then period.
    ``longest`` is the number of words of the longest text."""
    found = []

    def short(q: int) -> None:
        if len(w) > q:
            starts, lengths = _stretches(w[q:] == w[:-q], max(EXPONENT * q, LEAST) - q)
            for s, n in zip(starts.tolist(), lengths.tolist()):
                if not _divided(w, s, q):
                    found.append((s, n + q, q))

    for q in range(1, min(SHORT, max(1, longest // EXPONENT)) + 1):
        short(q)
    g = 1
    h = _mix(w.astype(np.uint64) + np.uint64(1))
    while True:
        if len(h) <= g:
            break
        h = _mix(h[:-g] * np.uint64(0x9E3779B97F4A7C15) + (h[g:] ^ (h[g:] >> np.uint64(29))))
        g *= 2
        if EXPONENT * (g // 2 + 1) > longest:
            break
        if g <= SHORT:
            continue
        at = _selected(h, g // 2)
        order = np.argsort(h[at], kind="stable")
        place, key = at[order], h[at[order]]
        gap = np.diff(place)
        seed = np.flatnonzero((key[1:] == key[:-1]) & (gap > g // 2) & (gap <= g))
        done: dict[int, int] = {}  # period -> end of its last stretch
        for p, q in sorted(zip(place[seed].tolist(), gap[seed].tolist())):
            if p < done.get(q, 0):
                continue
            ahead = _same_ahead(w, p, q)
            start = p - _same_behind(w, p, q)
            length = p + ahead + q - start
            done[q] = p + ahead
            if length >= max(EXPONENT * q, LEAST) and not _divided(w, start, q):
                found.append((start, length, q))
    found.sort(key=lambda r: (r[0], r[2]))
    return tuple(np.array(c, np.int64) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 3


# -------------------------------------------------------------------- texts

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _search(texts: list[bytes]) -> tuple[list[int], list[list[tuple[int, int, int]]], list[str]]:
    """For each text its number of words, its runs, and its words without
    those that repeat a run's first period."""
    number = defaultdict(count(len(texts)).__next__)  # smaller ones part the texts
    words = [t.split() for t in texts]  # bytes: ASCII white space only
    sizes = [len(x) for x in words]
    starts = np.concatenate(([0], np.cumsum(np.array(sizes, np.int64) + 1)))
    w = np.empty(int(starts[-1]), np.int64)
    for i, x in enumerate(words):
        a = int(starts[i])
        w[a:a + len(x)] = np.fromiter(map(number.__getitem__, x), np.int64, len(x))
        w[a + len(x)] = i
    start, length, period = runs(w, max(sizes, default=0))
    text = np.searchsorted(starts, start, "right") - 1
    per_text: list[list] = [[] for _ in texts]
    for t, s, n, q in zip(text.tolist(), start.tolist(), length.tolist(), period.tolist()):
        per_text[t].append((s - int(starts[t]), n, q))
    kept = []
    for x, found in zip(words, per_text):
        if found:
            change = np.zeros(len(x) + 1, np.int64)
            for s, n, q in found:
                change[s + q] += 1
                change[s + n] -= 1
            x = [x[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
        kept.append(b" ".join(x).decode())
    return sizes, per_text, kept


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, runs array<struct<start, length, period>>,
    collapsed)`` for every row of ``docs``: its runs by start, then period,
    in numbers of words from 0, and its words joined by one space, without
    those that some run holds after its first period.

    NULL and empty texts, and texts without words, have no runs and collapse
    to the empty text; a text of any length is searched whole; a NULL doc_id
    is kept; rows that repeat each get their result; an empty table gives an
    empty one; other columns are not looked at.
    """
    d = ids_and_texts(docs)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts = binary_column(batch, "text")
            for a, b in byte_chunks(texts):
                sizes, found, kept = _search(texts[a:b])
                found = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], pa.array(sizes, pa.int64()), pa.array(found, pa.list_(_RUN)), pa.array(kept, pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    kind = d.schema["doc_id"].dataType.simpleString()
    return map_batches(d, batches, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


# -------------------------------------------------------------------- query

def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` where documents whose ``crc32(doc_id)`` is divisible
    by 10 go on, from a word that the rest of that number picks, with a
    repeated stretch of their own. A NULL doc_id has no such number."""
    d = ids_and_texts(docs).withColumn("h", F.crc32(F.col("doc_id").cast("string")))
    d = d.withColumn("words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    d = d.withColumn("n", F.when(n > 0, n)).withColumn("a", (g % F.col("n")).cast("int"))
    d = d.withColumn("p", (F.floor((F.col("n") - F.col("a")) / (3 + g % 8)) + 1).cast("int"))
    again = F.transform("words", lambda x, i: F.when(i < F.col("a"), x).otherwise(
        F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return d.select("doc_id", F.when(F.col("n").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def _longest(name: str) -> Column:
    # greatest length, smallest start, smallest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return best[name]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = periodic_runs(with_planted_periods(read(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                   r["period"].cast("string"), F.lit("\n")))
    length, period = _longest("length"), -_longest("period")
    return d.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-_longest("start")).alias("start"), length.alias("length"),
        period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
