"""SimHash near-duplicates, found through anchor points of a covering code.

*Fingerprint*: A-Z lower-cased, words are runs without ASCII white space,
shingles of four words (all words when there are fewer), repeats counted;
a bit is 1 when it is 1 in more than half of the shingles' XXH64 hashes.

*Links*: fingerprints that differ in at most ``distance`` (4) of 64 bits.
The 64 bits are cut into three blocks of 22, 21 and 21. When two
fingerprints differ in at most 4 bits, two of the three blocks together hold
at most 2 of them (the third, the one with most, holds at least 2 as soon as
there are 4; with 3 or fewer it holds at least 1). For each of the three
pairs of blocks the anchors are the 2^24 pairs of words of the binary Golay
code, which covers its 23 bits with radius 3 (blocks are padded with zeros).
A point half way between two fingerprints is at most one bit from either, so
each fingerprint goes to the anchors of all points within one bit of it: its
own anchor and those at distance radius + 1 that one flip makes the nearest.
Both then meet at the anchor of the half-way point: no link is missed.

*Comparison per anchor*: equal fingerprints are one item; a hot anchor is
cut into parts and every two parts meet in a task of their own; a task emits
a spanning set of links (item, smallest item it reaches here), never all
pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.llm.common import binary_column, free_name, ids_and_texts, long_array, map_batches, materialize, read, row_key
from quartermaster.llm.components import connected_components

SHINGLE_WORDS = 4
DISTANCE = 4
SEED = 42
#: an anchor with more items than this is compared in parts of this size
PART = 1024
#: groups up to this size are compared by shifting the sorted column
_SHIFTS = 8
_BLOCKS = ((0, 22), (22, 21), (43, 21))  # (lowest bit, bits)
_PAIRS = ((0, 1), (0, 2), (1, 2))
_LONG_TEXT = 1 << 22
_SPACE = re.compile(rb"[\x09-\x0D\x20]")
_BROADCAST_ROWS = 1 << 16


# ------------------------------------------------------------- fingerprints

def _word_runs(text: bytes, keep: int) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size cut at white space; each
    list after the first repeats the last ``keep`` words before it. A list has
    more than ``keep`` words unless the whole text has not."""
    text = text.lower()  # bytes: A-Z only
    if len(text) <= _LONG_TEXT:
        yield text.split()  # bytes: ASCII white space only
        return
    at, words, some = 0, [], False
    while at < len(text):
        space = _SPACE.search(text, at + _LONG_TEXT)
        end = space.end() if space else len(text)
        words += text[at:end].split()
        at = end
        if len(words) > keep:
            yield words
            some = True
            words = words[len(words) - keep:]
    if not some:
        yield words


def _shingle_hashes(words: list[bytes], k: int, seed: int) -> list[int]:
    digest = xxhash.xxh64_intdigest
    if len(words) < k:
        return [digest(b" ".join(words), seed)] if words else []
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return [digest(line[a:b], seed) for a, b in zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())]


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits."""
    total = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 15):
        part = np.ascontiguousarray(hashes[a:a + (1 << 15)]).view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return total


def fingerprint(text: bytes, k: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The 64-bit SimHash of one UTF-8 text (0 when it has no word)."""
    counts, n = np.zeros(64, np.int64), 0
    for words in _word_runs(text, k - 1):
        h = np.array(_shingle_hashes(words, k, seed), np.uint64)
        counts += _bit_counts(h)
        n += len(h)
    if not n:
        return 0
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = np.array([fingerprint(t) for t in binary_column(batch, "text")], np.uint64)
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), long_array(fps)], names=[*names, "fp"])


def fingerprints(docs: DataFrame, keyed: bool = False) -> DataFrame:
    """``(doc_id, fp)``: fp is the fingerprint's 64 bits as a signed long;
    with ``keyed`` also the row's ``key``."""
    d = ids_and_texts(docs)
    kind = d.schema["doc_id"].dataType.simpleString()
    if not keyed:
        return map_batches(d, _fingerprint_batches, f"doc_id {kind}, fp long")
    d = docs.select(docs["doc_id"].alias("doc_id"), row_key(docs).alias("key"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    return map_batches(d, _fingerprint_batches, f"doc_id {kind}, key long, fp long")


# ------------------------------------------------------------------ anchors

@lru_cache(maxsize=1)
def _golay() -> tuple[np.ndarray, np.ndarray]:
    """For every syndrome of the binary Golay code of length 23 the error of
    weight <= 3 that has it, and for every bit its syndrome."""
    generator = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1

    def remainder(x: int) -> int:
        for i in range(22, 10, -1):
            if x >> i & 1:
                x ^= generator << (i - 11)
        return x

    columns = np.array([remainder(1 << i) for i in range(23)], np.int64)
    errors = np.full(1 << 11, -1, np.int64)
    errors[0] = 0
    for i in range(23):
        errors[columns[i]] = 1 << i
        for j in range(i):
            errors[columns[i] ^ columns[j]] = 1 << i | 1 << j
            for k in range(j):
                errors[columns[i] ^ columns[j] ^ columns[k]] = 1 << i | 1 << j | 1 << k
    assert (errors >= 0).all()
    return errors, columns


def _nearest(block: np.ndarray) -> np.ndarray:
    """The code word nearest to each 23-bit value, as its upper 12 bits
    (the code is systematic)."""
    errors, columns = _golay()
    syndrome = np.zeros(len(block), np.int64)
    for i in range(23):
        syndrome ^= np.where(block >> i & 1, columns[i], 0)
    return (block ^ errors[syndrome]) >> 11


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For unsigned fingerprints: ``(item, key)`` where ``item`` numbers the
    fingerprint and ``key`` is pair of blocks and anchor; each once."""
    fps = fps.astype(np.uint64, copy=False)
    own, near = [], []
    for low, bits in _BLOCKS:
        block = (fps >> np.uint64(low) & np.uint64((1 << bits) - 1)).astype(np.int64)
        own.append(_nearest(block))
        near.append([_nearest(block ^ (1 << i)) for i in range(bits)])
    n = len(fps)
    items, keys = [], []
    for p, (x, y) in enumerate(_PAIRS):
        found = [own[x] << 12 | own[y], *(c << 12 | own[y] for c in near[x]), *(own[x] << 12 | c for c in near[y])]
        found = np.sort(np.stack(found, axis=1), axis=1)
        new = np.ones(found.shape, bool)
        new[:, 1:] = found[:, 1:] != found[:, :-1]
        items.append(np.repeat(np.arange(n), new.sum(axis=1)))
        keys.append(found[new] | p << 24)
    return np.concatenate(items), np.concatenate(keys)


def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        whole = batch.column(0).to_numpy(zero_copy_only=False)
        for a in range(0, len(whole), 4096):
            fps = whole[a:a + 4096]
            item, key = anchors(fps.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fps[item])], names=["anchor", "fp"])


# --------------------------------------------------------------- comparison

def _spanning(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Items and the smallest item of theirs that links reach, of one group."""
    unsigned = fps.view(np.uint64)
    label = np.arange(len(fps))
    left = np.ones(len(fps), bool)
    for i in range(len(fps)):
        if not left[i]:
            continue
        reached = np.zeros(len(fps), bool)
        reached[i] = True
        todo = [i]
        while todo:
            hit = left & ~reached & (np.bitwise_count(unsigned ^ unsigned[todo.pop()]) <= distance)
            reached |= hit
            todo.extend(np.flatnonzero(hit).tolist())
        left &= ~reached
        label[reached] = i
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return fps[moved], fps[label[moved]]


def _links_of_sorted(key: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside whole groups of equal key."""
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(start, len(key)))
    small = np.repeat(size <= _SHIFTS + 1, size)
    a, b = [], []
    for d in range(1, _SHIFTS + 1):
        if len(key) <= d:
            break
        hit = np.flatnonzero((key[d:] == key[:-d]) & small[d:]
                             & (np.bitwise_count((fps[d:] ^ fps[:-d]).view(np.uint64)) <= distance))
        a.append(fps[hit])
        b.append(fps[hit + d])
    for g in np.flatnonzero(size > _SHIFTS + 1):
        x, y = _spanning(fps[start[g]:start[g] + size[g]], distance)
        a.append(x)
        b.append(y)
    return (np.concatenate(a), np.concatenate(b)) if a else (fps[:0], fps[:0])


def _compare_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by key; a group may run over several."""
    rest_key = rest_fp = np.empty(0, np.int64)

    def links(key: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        a, b = _links_of_sorted(key, fps, DISTANCE)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        key = np.concatenate((rest_key, batch.column(0).to_numpy()))
        fps = np.concatenate((rest_fp, batch.column(1).to_numpy()))
        whole = np.searchsorted(key, key[-1]) if len(key) else 0
        rest_key, rest_fp = key[whole:], fps[whole:]
        if whole:
            yield links(key[:whole], fps[:whole])
    if len(rest_key):
        yield links(rest_key, rest_fp)


def links(fps: DataFrame) -> DataFrame:
    """``(a, b)``: links between different fingerprints of column ``fp``
    that connect exactly what all links within the distance connect."""
    at = materialize(map_batches(fps.select("fp").distinct(), _anchor_batches, "anchor long, fp long"))
    hot = materialize(at.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > PART)
                      .select("anchor", F.ceil(F.col("n") / PART).cast("long").alias("parts")))
    if hot.count() <= _BROADCAST_ROWS:  # measured; two longs a row
        hot = F.broadcast(hot)
    # a hot anchor: part p of an item, and one task for each two parts
    part = F.pmod(F.xxhash64("fp"), F.col("parts"))
    both = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1),
                       lambda j: F.struct(F.least(j, F.col("p")).alias("x"), F.greatest(j, F.col("p")).alias("y")))
    cut = (at.join(hot, "anchor").withColumn("p", part)
           .select("anchor", "fp", F.explode(both).alias("t"))
           .select(F.xxhash64("anchor", "t.x", "t.y").alias("key"), "fp"))
    rest = at.join(hot, "anchor", "left_anti").select(F.xxhash64("anchor").alias("key"), "fp")
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = rest.union(cut).repartition(n, "key").sortWithinPartitions("key")
    return map_batches(groups, _compare_batches, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    ``fingerprint`` is 16 lower-case hex digits, ``component_id`` the smallest
    doc_id among all documents that links reach, its own included.

    A NULL or empty text has fingerprint zero and links like any other; rows
    that repeat share fingerprint and component; a NULL doc_id is kept and is
    never the smallest (its component is NULL only if no member has an id);
    an empty table gives an empty result; other columns are not looked at.
    """
    fps = materialize(fingerprints(docs))
    named = _named(fps)
    # written before it is joined back, so that Spark can split a large component
    least = materialize(named.groupBy("c").agg(F.min("low").alias("component_id")))
    of_fp = materialize(named.join(least, "c").select("fp", "component_id"))
    return (fps.join(of_fp, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def _named(fps: DataFrame) -> DataFrame:
    """``(fp, low, c)``: the smallest doc_id of each fingerprint, and the
    fingerprint that stands for its component."""
    comp = connected_components(links(fps), "a", "b").withColumnRenamed("node", "fp")
    low = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    return materialize(low.join(comp, "fp", "left").select("fp", "low", F.coalesce("component", "fp").alias("c")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay: one of each group of
    linked documents, that with the smallest doc_id; rows without doc_id stay
    only when no member of their group has one. Rows that share a doc_id count
    as one document, of which one row stays; of rows that repeat, one."""
    fps = materialize(fingerprints(docs, keyed=True))
    named = _named(fps)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("key"))).alias("best")
    # first by fingerprint, so that a large component's rows do not travel
    of_fp = fps.groupBy("fp").agg(best)
    best = F.min("best").alias("best")
    chosen = materialize(of_fp.join(named.select("fp", "c"), "fp").groupBy("c").agg(best).select("best.doc_id", "best.key"))
    chosen = (chosen.filter("doc_id is not null").groupBy("doc_id").agg(F.min("key").alias("key"))
              .unionByName(chosen.filter("doc_id is null")))
    times = materialize(fps.join(chosen.withColumnsRenamed({"doc_id": "__i", "key": "__k"}),
                                 (F.col("key") == F.col("__k")) & F.col("doc_id").eqNullSafe(F.col("__i")), "left_semi")
                        .groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n")))
    ident, key = free_name(docs, "__id"), free_name(docs, "__key")
    times = times.withColumnsRenamed({"doc_id": ident, "key": key})

    def rows(of: DataFrame) -> DataFrame:
        return docs.join(of, (row_key(docs) == of[key]) & docs["doc_id"].eqNullSafe(of[ident]), "left_semi")

    out, more = rows(times.filter("n = 1")), times.filter("n > 1")
    if more.take(1):
        out = out.union(rows(more).withColumn(key, row_key(docs)).dropDuplicates(["doc_id", key]).drop(key))
    return out


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
