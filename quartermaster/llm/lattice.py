"""Near-duplicate embeddings by lattice hashing.

For each of ``TABLES`` tables two random projections take a unit vector to
8 dimensions each, where it is decoded to the nearest point of the E8
lattice; the two lattice points together are its cell. A vector also enters
the cells made with the ``PROBES`` next nearest lattice points of each
projection. Vectors that meet in a cell are compared by cosine in double
precision.

*No pair is emitted.* Equal vectors are one class with a count. A pair that
meets in several cells is counted in the first cell that both enter (every
row carries the numbers of all its lattice points, so a task can tell), so
per-cell sums of linked copies add up to each vector's links; the links for
the components are a spanning set per cell. A hot cell is cut into parts and
every two parts meet in a task of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermaster.llm.common import map_batches, materialize, read, stage
from quartermaster.llm.components import connected_components

TABLES, BLOCKS, PROBES, SCALE = 3, 2, 2, 0.7
COSINE = 0.95
SEED = 20240
#: a cell with more classes than this is compared in parts of this size
PART = 1024
_SHIFTS = 6
_BROADCAST_ROWS = 1 << 16


# ------------------------------------------------------------------ lattice

def _d8(y: np.ndarray) -> np.ndarray:
    """Nearest points of D8 (integers with an even sum)."""
    r = np.rint(y)
    odd = r.sum(axis=1) % 2 != 0
    off = y - r
    worst = np.abs(off).argmax(axis=1)
    rows = np.flatnonzero(odd)
    r[rows, worst[rows]] += np.where(off[rows, worst[rows]] >= 0, 1, -1)
    return r


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """Nearest points of E8, which is D8 and D8 moved by one half."""
    a, b = _d8(y), _d8(y - 0.5) + 0.5
    closer = ((y - a) ** 2).sum(axis=1) <= ((y - b) ** 2).sum(axis=1)
    return np.where(closer[:, None], a, b)


@lru_cache(maxsize=1)
def _minimal() -> np.ndarray:
    """The 240 shortest vectors of E8: two coordinates of +-1, or all of
    +-1/2 with an even number of minuses."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (1, -1):
                for b in (1, -1):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    out.append(v)
    for m in range(256):
        if m.bit_count() % 2 == 0:
            out.append(np.array([-0.5 if m >> i & 1 else 0.5 for i in range(8)]))
    return np.array(out)


@lru_cache(maxsize=64)
def _projection(dims: int, table: int, block: int) -> np.ndarray:
    return np.random.default_rng((SEED, dims, table, block)).normal(size=(dims, 8)) * SCALE


def _number(points: np.ndarray, salt: int) -> np.ndarray:
    """Lattice points as 32-bit numbers."""
    h = np.full(points.shape[:-1], np.uint64(salt + 1))
    whole = np.rint(2 * points).astype(np.int64).astype(np.uint64)
    for i in range(8):
        h = (h ^ whole[..., i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    return (h >> np.uint64(32)).astype(np.uint32)


def cells(unit: np.ndarray, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """``[row, table, block, 1 + probes]``: numbers of the lattice points that
    each unit vector enters, the nearest first."""
    n, dims = unit.shape
    out = np.empty((n, tables, BLOCKS, 1 + probes), np.uint32)
    short = _minimal()
    for t in range(tables):
        for b in range(BLOCKS):
            y = unit @ _projection(dims, t, b)
            home = nearest_e8(y)
            dots = (y - home) @ short.T  # the nearer a neighbour, the larger
            best = np.argpartition(-dots, probes, axis=1)[:, :probes] if probes else np.empty((n, 0), int)
            points = np.concatenate([home[:, None], home[:, None] + short[best]], axis=1)
            out[:, t, b] = _number(points, dims * 1009 + t * 31 + b)
    return out


def _cell_key(table, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    h = (first.astype(np.uint64) << np.uint64(32) | second.astype(np.uint64)) ^ (np.uint64(0xD6E8FEB86659FD93) * (np.asarray(table).astype(np.uint64) + np.uint64(1)))
    h = (h ^ h >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ h >> np.uint64(29)).view(np.int64)


def _unit(blobs: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)
    # by the largest component first: squares of very large or small ones would leave the range of doubles
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def _cell_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, copies, vector) -> (cell, id, copies, vector, points), a row for
    each cell entered."""
    for batch in batches:
        ids, copies = (batch.column(i).to_numpy() for i in (0, 1))
        vectors = batch.column(2).to_pylist()
        lengths = np.array([len(v) for v in vectors])
        for size in np.unique(lengths):
            own = np.flatnonzero(lengths == size)
            for a in range(0, len(own), 512):
                rows = own[a:a + 512]
                points = cells(_unit([np.asarray(vectors[r], np.float64).tobytes() for r in rows]))
                k = points.shape[-1]
                keys = _cell_key(np.arange(points.shape[1])[None, :, None, None],
                                 points[:, :, 0, :, None], points[:, :, 1, None, :]).reshape(len(rows), -1)
                rep = np.repeat(np.arange(len(rows)), keys.shape[1])
                blob = [np.asarray(vectors[r], np.float64).tobytes() for r in rows]
                own_points = [p.tobytes() for p in points]
                assert keys.shape[1] == points.shape[1] * k * k
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(ids[rows][rep]), pa.array(copies[rows][rep]),
                     pa.array([blob[i] for i in rep], pa.binary()), pa.array([own_points[i] for i in rep], pa.binary())],
                    names=["cell", "id", "copies", "vector", "points"])


# --------------------------------------------------------------- comparison

def _first_cell(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The first cell that both rows of each pair enter, as its key: the
    first table in which both blocks share a lattice point, and in it the
    smallest shared number of each block."""
    same = p[:, :, :, :, None] == q[:, :, :, None, :]
    low = np.where(same.any(axis=4), p, np.uint32(0xFFFFFFFF)).min(axis=3)
    table = same.any(axis=(3, 4)).all(axis=2).argmax(axis=1)
    low = low[np.arange(len(p)), table]
    return _cell_key(table, low[:, 0], low[:, 1])


def _pairs_of(start: int, unit: np.ndarray, part: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the pairs within one group, in blocks."""
    for a in range(0, len(unit), part):
        for b in range(a, len(unit), part):
            hit = unit[a:a + part] @ unit[b:b + part].T >= COSINE
            if a == b:
                hit = np.triu(hit, 1)
            i, j = np.nonzero(hit)
            for k in range(0, len(i), 1 << 16):  # the point sets of a block of pairs stay small
                yield start + a + i[k:k + (1 << 16)], start + b + j[k:k + (1 << 16)]


class _Group:
    """Rows of whole cells: sums and spanning links."""

    def __init__(self, cell, part, own, ids, copies, vectors, points):
        self.cell, self.part, self.own, self.ids, self.copies = cell, part, own, ids, copies
        self.vectors, self.points = vectors, points

    def results(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(id, links, root)`` of the rows that link with anything."""
        n = len(self.ids)
        links = np.zeros(n, np.int64)
        root = np.arange(n)
        start = np.flatnonzero(np.concatenate(([True], (self.cell[1:] != self.cell[:-1]) | (self.part[1:] != self.part[:-1]))))
        size = np.diff(np.append(start, n))
        width = np.fromiter(map(len, self.vectors), np.int64, n)

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        def count(i, j):
            keep = self.ids[i] != self.ids[j]
            i, j = i[keep], j[keep]
            if not len(i):
                return
            shape = (-1, TABLES, BLOCKS, 1 + PROBES)
            p = np.frombuffer(b"".join(self.points[k] for k in i), np.uint32).reshape(shape)
            q = np.frombuffer(b"".join(self.points[k] for k in j), np.uint32).reshape(shape)
            first = _first_cell(p, q) == self.cell[i]
            # a hot cell's rows are in many parts: a pair inside one part counts in part (x, x) only
            x, y = self.part[i] >> 32, self.part[i] & 0xFFFFFFFF
            if (x != y).any():
                first &= (x == y) | (self.own[i] != self.own[j])
            np.add.at(links, i[first], self.copies[j[first]])
            np.add.at(links, j[first], self.copies[i[first]])
            for a, b in zip(i.tolist(), j.tolist()):
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)

        few = np.flatnonzero((size > 1) & (size <= _SHIFTS + 1))
        rows = np.concatenate([np.arange(start[g], start[g] + size[g]) for g in few]) if len(few) else np.empty(0, int)
        if len(rows):
            group = np.repeat(np.arange(len(few)), size[few])
            for w in np.unique(width[rows]):
                own = width[rows] == w
                r, g = rows[own], group[own]
                unit = _unit([self.vectors[k] for k in r])
                for d in range(1, _SHIFTS + 1):
                    if len(r) > d:
                        hit = (g[d:] == g[:-d]) & ((unit[d:] * unit[:-d]).sum(axis=1) >= COSINE)
                        count(r[:-d][hit], r[d:][hit])
        for g in np.flatnonzero(size > _SHIFTS + 1):
            a, b = start[g], start[g] + size[g]
            if len(set(width[a:b])) == 1:
                for i, j in _pairs_of(a, _unit(self.vectors[a:b])):
                    count(i, j)
        roots = np.array([find(i) for i in range(n)], np.int64) if n else root
        out = np.flatnonzero((links > 0) | (roots != np.arange(n)))
        return self.ids[out], links[out], self.ids[roots[out]]


def _compare_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by cell and part; a group may run over several."""
    rest: list | None = None

    def emit(cols: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in _Group(*cols).results()], names=["id", "links", "root"])

    for batch in batches:
        cols = [batch.column(i).to_numpy() for i in range(5)] + [batch.column(i).to_pylist() for i in (5, 6)]
        if rest is not None:
            cols = [np.concatenate((a, b)) if isinstance(a, np.ndarray) else a + b for a, b in zip(rest, cols)]
        n = len(cols[0])
        if not n:
            continue
        last = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])
        whole = int(n - last[::-1].argmin()) if not last.all() else 0
        rest = [c[whole:] for c in cols]
        if whole:
            yield emit([c[:whole] for c in cols])
    if rest is not None and len(rest[0]):
        yield emit(rest)


def _links(classes: DataFrame) -> DataFrame:
    """``(id, links, root)`` parts: for classes ``(id, copies, vector)``,
    copies of other classes linked with, and a class of the same component."""
    schema = "cell long, id long, copies long, vector binary, points binary"
    at = stage(map_batches(classes.select("id", "copies", "vector"), _cell_batches, schema))
    hot = materialize(at.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > PART)
                      .select("cell", F.ceil(F.col("n") / PART).cast("long").alias("parts")))
    if hot.count() <= _BROADCAST_ROWS:  # measured; two longs a row
        hot = F.broadcast(hot)
    zero = F.lit(0).cast("long")
    own = F.pmod(F.xxhash64("id"), F.col("parts"))
    tasks = F.transform(F.sequence(zero, F.col("parts") - 1), lambda j: F.shiftleft(F.least(j, F.col("own")), 32)
                        .bitwiseOR(F.greatest(j, F.col("own"))))
    cut = (at.join(hot, "cell").withColumn("own", own)
           .select("cell", F.explode(tasks).alias("part"), "own", "id", "copies", "vector", "points"))
    rest = (at.join(hot, "cell", "left_anti")
            .select("cell", zero.alias("part"), zero.alias("own"), "id", "copies", "vector", "points"))
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = rest.union(cut).repartition(n, "cell", "part").sortWithinPartitions("cell", "part")
    return map_batches(groups, _compare_batches, "id long, links long, root long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors``.

    ``n_links`` counts the other rows found with a cosine of at least 0.95
    (equal vectors always), ``component_id`` is the smallest id that links
    reach, ``kept`` whether that is the row's own.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components
    link with nothing (0 links, their own component, kept), as do vectors of
    different lengths with each other; rows that repeat are vectors of their
    own with equal values; rows that share an id but differ each have their own
    links; a NULL id counts as a link of others, and its row is kept only in a
    component without ids (whose id is NULL); an empty table gives an empty result;
    other columns are not looked at. Ids are whole numbers.
    """
    x = F.col("x")
    v = vectors.select(vectors[id_col].alias("vec_id"), vectors[vector_col].cast("array<double>").alias("x"))
    good = (F.size(x) > 0) & ~F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))) \
        & F.exists(x, lambda e: e != 0)
    # two hashes name a class of equal vectors; 0.0 turns -0.0 into 0.0
    same = F.transform(x, lambda e: e + F.lit(0.0))
    v = v.withColumn("ok", F.coalesce(good, F.lit(False))).withColumn("x", F.when(F.col("ok"), same))
    v = v.withColumn("h", F.when(F.col("ok"), F.xxhash64(x))).withColumn("g", F.when(F.col("ok"), F.xxhash64(F.lit(SEED), x)))
    # a class is known by its hash, not by an id that other vectors may have too
    classes = materialize(v.filter("ok").groupBy("h", "g", F.col("x").alias("vector"))
                          .agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"))
                          .withColumn("id", F.xxhash64("h", "g")))
    found = stage(_links(classes))
    comp = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), "a", "b")
    sums = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = materialize(classes.select("h", "g", "id", "low", "copies").join(sums, "id", "left")
                        .join(comp.withColumnRenamed("node", "id"), "id", "left")
                        .select("h", "g", "low", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                                F.coalesce("component", "id").alias("c")))
    # written before it is joined back, so that Spark can split a large component
    least = materialize(named.groupBy("c").agg(F.min("low").alias("component")))
    of_class = materialize(named.join(least, "c").select("h", "g", "n_links", "component"))
    out = v.select("vec_id", "h", "g").join(of_class, ["h", "g"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.cast(T.LongType()).alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))
