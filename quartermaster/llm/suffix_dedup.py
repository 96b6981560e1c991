"""Suffix dedup: remove bytes covered by long strings that repeat.

Every byte that a ``length``-byte string covers which also starts anywhere
else in the table (same text or another) goes; strings are judged on the
input. Matches never cross texts.

1. Each text is cut into content-defined segments (``anchors``): they divide
   its windows of ``length`` bytes, and equal windows lie in segments with
   the same 32-byte gram. One narrow row per segment (about 1 in 85 bytes).
2. Grams that occur once drop out. Where all segments of a gram are equal,
   all their windows repeat, without looking further.
3. Of the rest, the bytes of each distinct segment are fetched, dealt out by
   gram, and indexed in blocks of about a megabyte of whole gram groups: a
   run-compressed Burrows-Wheeler transform with sampled run ends
   (``run_index``), whose matching statistics are streamed and marked where
   they reach ``length``. A window lies in one segment only, so a match
   within a block is a match between two places of the table.
4. A gram with very many segments is dealt out in parts, so that no group
   grows with the table. The blocks of such grams also give out a digest of
   each distinct window they hold; a window that is unique in its block but
   has its digest in another one repeats as well.
5. The spans of each text are merged and cut out of it.

Only narrow rows (a few numbers per segment) and the bytes of step 3 are
shuffled besides the texts themselves, which two joins deal out by row.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.llm import anchors
from quartermaster.llm.common import binary_column, long_array, map_batches, read, row_key, stage
from quartermaster.llm.run_index import SEPARATOR, RunIndex

LENGTH = 200
#: bytes in one index, and the most segments of a gram in one part
BLOCK, HOT = 1 << 20, 4096

ORACLE = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, s, md5(substr(h, 2 * s + 1, 400)) AS win
      FROM (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 199, 0))) AS s FROM d)),
r AS (SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY win) AS n FROM w) WHERE n > 1),
i AS (SELECT doc_id, s, sum(CASE WHEN s > prev + 200 OR prev IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS k
      FROM (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS prev FROM r)),
p AS (SELECT doc_id, k, min(s) AS a, max(s) + 200 AS b FROM i GROUP BY doc_id, k),
g AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM p),
c AS (SELECT g.doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
             string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
      FROM g JOIN d ON d.doc_id = g.doc_id GROUP BY g.doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN c ON d.doc_id = c.doc_id
"""


# ----------------------------------------------------------------- segments

def _segment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, key, text) -> a row for each segment."""
    for batch in batches:
        for texts, rows, offsets in anchors.pieces(binary_column(batch, "text"), LENGTH):
            text, first, windows, gram, content = anchors.segments(texts, LENGTH)
            if not len(text):
                continue
            row = pa.array(np.asarray(rows)[text])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row), pa.array(first + np.asarray(offsets)[text]),
                 pa.array(windows.astype(np.int32)), long_array(gram), long_array(content)],
                names=["doc_id", "key", "first", "windows", "gram", "content"])


def _repeated(docs: DataFrame) -> DataFrame:
    """Segments of grams that occur at least twice: ``(doc_id, key, first,
    windows, gram, content, n, alike)``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = map_batches(
        docs.select("doc_id", "key", "text"), _segment_batches, f"doc_id {kind}, key long, first long, windows int, gram long, content long")
    grams = (rows.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("content").alias("lo"), F.max("content").alias("hi"))
             .filter("n > 1").select("gram", "n", (F.col("lo") == F.col("hi")).alias("alike")))
    # written first: the join then reads two plain shuffles, and Spark can split a hot gram
    return rows.join(stage(grams), "gram")


# ------------------------------------------------------------------- blocks

def _runs(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of True."""
    edge = np.diff(np.concatenate(([0], marked.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def repeated_windows(segments: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each byte string, which of its windows occur again in the list."""
    sizes = np.fromiter(map(len, segments), np.int64, len(segments))
    text = np.frombuffer(bytes([SEPARATOR]).join(segments), np.uint8)
    long = RunIndex(text).matching_statistics() >= length
    begin = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    return [long[a:a + n - length + 1] for a, n in zip(begin.tolist(), sizes.tolist())]


def _fetch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, key, text, wanted) -> (route, hot, doc_id, key, first, bytes)."""
    for batch in batches:
        texts = binary_column(batch, "text")
        rows, route, hot, first, parts, size = [], [], [], [], [], 0
        for row, wanted in enumerate(batch.column(batch.schema.get_field_index("wanted")).to_pylist()):
            for w in wanted:
                rows.append(row)
                route.append(w["route"])
                hot.append(w["hot"])
                first.append(w["first"])
                parts.append(texts[row][w["first"]:w["first"] + w["windows"] + LENGTH - 1])
                size += len(parts[-1])
                if size > BLOCK:
                    yield _fetched(batch, rows, route, hot, first, parts)
                    rows, route, hot, first, parts, size = [], [], [], [], [], 0
        if rows:
            yield _fetched(batch, rows, route, hot, first, parts)


def _fetched(batch, rows, route, hot, first, parts) -> pa.RecordBatch:
    at = pa.array(rows, pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(route, pa.int64()), pa.array(hot, pa.bool_()), batch.column(0).take(at), batch.column(1).take(at),
         pa.array(first, pa.int64()), pa.array(parts, pa.binary())],
        names=["route", "hot", "doc_id", "key", "first", "bytes"])


def _index_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by route -> spans (doc_id, key, start, end) of repeated
    windows, and for hot rows also a row with a digest for each distinct
    window of the block; ``alone`` says that the block holds it once."""
    held: list[pa.RecordBatch] = []
    size = 0

    def results(rows: pa.Table) -> pa.RecordBatch:
        parts, first, hot = (rows.column(c).to_pylist() for c in ("bytes", "first", "hot"))
        at, start, end, digest, alone = [], [], [], [], []
        seen = set()
        for i, marked in enumerate(repeated_windows(parts)):
            a, b = _runs(marked)
            at += [i] * len(a)
            start += (first[i] + a).tolist()
            end += (first[i] + b + LENGTH).tolist()
            digest += [None] * len(a)
            alone += [False] * len(a)
            if not hot[i]:
                continue
            for k, again in enumerate(marked.tolist()):
                d = blake2b(parts[i][k:k + LENGTH], digest_size=16).digest()
                if again and d in seen:
                    continue
                seen.add(d)
                at.append(i)
                start.append(first[i] + k)
                end.append(first[i] + k + LENGTH)
                digest.append(d)
                alone.append(not again)
        ids = rows.select(["doc_id", "key"]).take(pa.array(at, pa.int64())).combine_chunks()
        one = lambda c: c.chunk(0) if c.num_chunks else pa.array([], c.type)
        return pa.RecordBatch.from_arrays(
            [one(ids.column(0)), one(ids.column(1)), pa.array(start, pa.int64()), pa.array(end, pa.int64()),
             pa.array(digest, pa.binary()), pa.array(alone, pa.bool_())],
            names=["doc_id", "key", "start", "end", "digest", "alone"])

    for batch in batches:
        # whole routes up to the last one in the batch, which may go on
        route = batch.column(0).to_numpy()
        lengths = np.array([len(x) for x in batch.column("bytes").to_pylist()], np.int64)
        a = 0
        while a < len(route):
            b = a + int(np.searchsorted(np.cumsum(lengths[a:]), BLOCK - size)) + 1
            border = np.flatnonzero(route[b:] != route[b - 1:-1]) if b < len(route) else []
            if not len(border):
                break
            b += int(border[0])
            yield results(pa.Table.from_batches([*held, batch.slice(a, b - a)]))
            held, size, a = [], 0, b
        if a < len(route):
            held.append(batch.slice(a))
            size += int(lengths[a:].sum())
    if held:
        yield results(pa.Table.from_batches(held))


# ------------------------------------------------------------------ removal

def _merge(spans: np.ndarray) -> np.ndarray:
    """Overlapping or touching (start, end) rows merged."""
    spans = spans[np.argsort(spans[:, 0])]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate(([True], spans[1:, 0] > reach[:-1]))
    head = np.flatnonzero(new)
    return np.stack([spans[head, 0], reach[np.append(head[1:], len(spans)) - 1]], axis=1)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = binary_column(batch, "text")
        found = batch.column(batch.schema.get_field_index("spans")).to_pylist()
        kept, spans = [], []
        for text, s in zip(texts, found):
            if not s:
                kept.append(text)
                spans.append([])
                continue
            m = _merge(np.array([(x["start"], x["end"]) for x in s], np.int64)).tolist()
            ends = [0, *(b for _, b in m)]
            starts = [*(a for a, _ in m), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(ends, starts)))
            spans.append([{"start": a, "end": b} for a, b in m])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(spans, _SPANS), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "spans", "kept"])


def dedup(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, spans array<struct<start, end>>, kept binary)`` for
    every row of ``docs``: the maximal removed runs (byte offsets, end
    exclusive) and the bytes that remain.

    NULL and empty texts and those shorter than the length keep everything;
    rows that repeat a text (of at least the length) lose all of it, each; a
    NULL doc_id is kept; an empty table gives an empty result; other columns
    are not looked at.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(docs["doc_id"].alias("doc_id"), row_key(docs).alias("key"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    rows = stage(_repeated(d))
    whole = F.struct(F.col("first").alias("start"), (F.col("first") + F.col("windows") + (LENGTH - 1)).alias("end"))
    span = lambda x: x.select("doc_id", "key", whole.alias("s")).select("doc_id", "key", "s.*")
    mixed = rows.filter(~F.col("alike"))
    # one of each kind of segment; all of a kind with several repeat
    place = F.struct("key", "doc_id", "first")
    kinds = stage(mixed.groupBy("gram", "content", "windows")
                  .agg(F.count(F.lit(1)).alias("m"), F.min(place).alias("p"), F.max("n").alias("n")))
    again = kinds.filter("m > 1").select("gram", "content")
    sure = span(rows.filter("alike")).union(span(mixed.join(again, ["gram", "content"], "left_semi")))
    part = F.when(F.col("n") > HOT, F.pmod(F.xxhash64("p.key", "p.first"), F.ceil(F.col("n") / HOT))).otherwise(0)
    wanted = (kinds.select("p.key", "p.doc_id", F.struct(
        F.xxhash64("gram", part).alias("route"), (F.col("n") > HOT).alias("hot"), F.col("p.first").alias("first"), "windows").alias("w"))
        .groupBy("key", "doc_id").agg(F.collect_list("w").alias("wanted")))

    def with_texts(x: DataFrame, how: str) -> DataFrame:
        x = x.withColumnsRenamed({"key": "__key", "doc_id": "__id"})
        return d.join(x, (d["key"] == x["__key"]) & d["doc_id"].eqNullSafe(x["__id"]), how)

    fetched = map_batches(
        with_texts(wanted, "inner").select("doc_id", "key", "text", "wanted"), _fetch_batches, f"route long, hot boolean, doc_id {kind}, key long, first long, bytes binary")
    found = stage(map_batches(
        fetched.repartition(n, "route").sortWithinPartitions("route"), _index_batches, f"doc_id {kind}, key long, start long, end long, digest binary, alone boolean"))
    indexed = found.filter("digest is null").select("doc_id", "key", "start", "end")
    twice = (found.filter("digest is not null").groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select("digest"))
    across = found.filter("alone").join(twice, "digest", "left_semi").select("doc_id", "key", "start", "end")
    spans = (sure.union(indexed).union(across).groupBy("key", "doc_id")
             .agg(F.collect_set(F.struct("start", "end")).alias("spans")))
    return map_batches(
        with_texts(spans, "left").select("doc_id", "text", "spans"), _cut_batches, f"doc_id {kind}, n_bytes long, spans array<struct<start long, end long>>, kept binary")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return dedup(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
