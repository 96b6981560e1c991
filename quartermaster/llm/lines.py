"""Line dedup over overlapping windows of three lines.

Every three consecutive lines of a document are a window. Of all equal
windows in the table the first occurrence (smallest doc_id, then smallest
position) stays; every line that a later occurrence covers is removed.

Only built-in functions run on the rows: windows are hashed where the text
is, 64 bits of the hash are counted with map-side combining, and only windows
whose hash occurs again go on to the comparison of 96 bits (64 + 32) and the
choice of the first one. Windows are equal when these hashes are; their texts
are not compared. Covered positions return to their document as one
list, bounded by the document itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.llm.common import free_name, read, row_key

WINDOW = 3

ORACLE = r"""
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
w AS (SELECT doc_id, i, a[i] || chr(10) || a[i + 1] || chr(10) || a[i + 2] AS win
      FROM (SELECT doc_id, a, unnest(range(1, len(a) - 1)) AS i FROM l)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS n FROM w)
          WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM later, (VALUES (0), (1), (2)) AS t(k)),
kept AS (SELECT e.doc_id, count(*) FILTER (WHERE g.i IS NOT NULL) AS n_removed, count(*) AS n_lines,
                coalesce(string_agg(e.line, chr(10) ORDER BY e.i) FILTER (WHERE g.i IS NULL), '') AS text
         FROM (SELECT doc_id, unnest(a) AS line, unnest(range(1, len(a) + 1)) AS i FROM l) e
         LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i GROUP BY e.doc_id)
SELECT doc_id, n_lines, n_removed, sha256(text) AS kept_sha256 FROM kept
"""


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def later_windows(docs: DataFrame) -> DataFrame:
    """``(key, doc_id, positions)``: per row key of ``docs`` the positions (from 0) of
    its windows that are not the first of their kind. Rows that share doc_id
    and text count as one."""
    d = docs.select(docs["doc_id"].alias("doc_id"), row_key(docs).alias("key"), _lines(docs["text"]).alias("lines"))
    hashes = F.transform(F.sequence(F.lit(0), F.size("lines") - WINDOW), lambda i: F.struct(
        F.xxhash64(*(F.get("lines", i + k) for k in range(WINDOW))).alias("h"),
        F.hash(*(F.get("lines", i + k) for k in reversed(range(WINDOW)))).alias("g")))
    rows = (d.filter(F.size("lines") >= WINDOW)
            .select("doc_id", "key", F.posexplode(hashes).alias("pos", "w"))
            .select("doc_id", "key", "pos", "w.h", "w.g"))
    again = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    rows = rows.join(again, "h", "left_semi")
    first = (rows.groupBy("h", "g").agg(F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "pos")).alias("first")))
    later = (rows.join(first, ["h", "g"])
             .filter(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("pos") == F.col("first.pos"))))
             .select("key", "doc_id", "pos"))
    return later.groupBy("key", "doc_id").agg(F.collect_set("pos").alias("positions"))


def dedup_lines(docs: DataFrame, counts: bool = False) -> DataFrame:
    """``docs`` (all its columns, every row) with the lines removed that a
    later occurrence of a repeated window covers; with ``counts`` also
    ``__n_lines`` and ``__n_removed``.

    Lines end at line feeds; windows are compared by 96-bit hashes. Texts of fewer than
    three lines, NULL and empty ones stay as they are; a text of which every
    line goes becomes empty. Occurrences inside one document count (of five
    equal lines the first stays). Rows that repeat a document are treated
    alike; a NULL doc_id comes after all others. Extra columns are kept,
    whatever their names (but with ``counts`` none may be called like the two).
    """
    if counts and {"__n_lines", "__n_removed"} & {c.lower() for c in docs.columns}:
        raise ValueError("docs has columns called like the counts")
    key, ident, positions, lines, kept = (free_name(docs, n) for n in ("__key", "__id", "__positions", "__lines", "__kept"))
    found = later_windows(docs).withColumnsRenamed({"key": key, "doc_id": ident, "positions": positions})
    d = docs.join(found, (row_key(docs) == found[key]) & docs["doc_id"].eqNullSafe(found[ident]), "left")
    covered = F.flatten(F.transform(positions, lambda p: F.array(*(p + k for k in range(WINDOW)))))
    d = d.withColumn(lines, F.when(F.col(positions).isNotNull(), _lines(F.col("text"))))
    d = d.withColumn(kept, F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered))
    text = (F.when(F.col(positions).isNull(), F.col("text"))
            .otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")))
    out = [text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    if counts:
        out += [F.size(_lines(F.col("text"))).cast("long").alias("__n_lines"),
                F.when(F.col(positions).isNull(), 0).otherwise(F.size(lines) - F.size(kept))
                .cast("long").alias("__n_removed")]
    return d.select(*out)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, counts=True).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
