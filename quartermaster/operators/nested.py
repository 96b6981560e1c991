"""Nested collections.

Unnesting is a ``Generate`` node inside the scan's stage: no shuffle. Child
lists are read inside their own document row, so every array function here
works on a bounded, row-local collection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _explode_inner(path, pos_alias: str, alias: str):
    """Inner explode written as an outer ``posexplode`` plus a filter on the
    position. Same rows; but Spark does not add its inferred
    ``size(arr) > 0`` pre-filter, which would evaluate an expensive array
    expression (a JSON decode, say) once more per row."""
    return F.posexplode_outer(path).alias(pos_alias, alias)


def unnest(df: DataFrame, path: str, keep: Sequence[str | Column] = (),
           alias: str = "child", with_pos: bool = False, outer: bool = False) -> DataFrame:
    """One row per element of the array at ``path`` (empty or NULL lists
    yield no row unless ``outer``), carrying the ``keep`` columns of the
    parent. ``with_pos`` adds the element position (``<alias>_pos``)."""
    keep = [F.col(k) if isinstance(k, str) else k for k in keep]
    names = [c for c in df.select(*keep).columns] if keep else []
    pos = f"{alias}_pos"
    ex = df.select(*keep, _explode_inner(path, pos, alias))
    if not outer:
        ex = ex.filter(F.col(pos).isNotNull())
    return ex if with_pos else ex.select(*names, alias)


def unnest2(df: DataFrame, outer_path: str, inner_field: str,
            parent_key: str = "id", parent_key_alias: str = "level_id",
            keep: Sequence[str | Column] = ()) -> DataFrame:
    """Two levels (station -> level -> requirement); each requirement row
    carries its level's key as ``parent_key_alias``; the requirement's fields
    are flattened into columns."""
    names = df.select(*keep).columns if keep else []
    lv = (df.select(*keep, _explode_inner(outer_path, "__p1", "__lv"))
          .filter(F.col("__p1").isNotNull()))
    ch = (lv.select(*names, F.col(f"__lv.{parent_key}").alias(parent_key_alias),
                    _explode_inner(f"__lv.{inner_field}", "__p2", "__ch"))
          .filter(F.col("__p2").isNotNull()))
    return ch.select(*names, parent_key_alias, "__ch.*")


def ordered_unnest2(df: DataFrame, outer_path: str, inner_path: str,
                    keep: Sequence[str] = ()) -> DataFrame:
    """Map -> lock -> key with both positions (``outer_pos``,
    ``inner_pos``) for document-order rules such as last-wins."""
    doc_pos = F.col("pos") if "pos" in df.columns else F.lit(0)
    a = (df.select(*keep, doc_pos.alias("doc_pos"), _explode_inner(outer_path, "outer_pos", "__o"))
         .filter(F.col("outer_pos").isNotNull()))
    return (a.select(*keep, "doc_pos", "outer_pos", "__o",
                     _explode_inner(f"__o.{inner_path}", "inner_pos", "inner"))
            .filter(F.col("inner_pos").isNotNull()))


def last_value_per_key(df: DataFrame, key: str | Column, value: str | Column,
                       order: Sequence[str | Column], key_alias: str = "key",
                       value_alias: str = "value") -> DataFrame:
    """E4 (T17): the value of the last row per key in document order - a
    dictionary built by successive assignments, not a collected set.
    ``max_by`` is partially aggregated before the shuffle."""
    k = F.col(key) if isinstance(key, str) else key
    v = F.col(value) if isinstance(value, str) else value
    o = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    return (df.groupBy(k.alias(key_alias))
            .agg(F.max_by(v, o).alias(value_alias)))


def child_ids(levels, field: str = "id") -> Column:
    """The ids of a document's children, in document order; NULL
    list gives NULL."""
    arr = F.col(levels) if isinstance(levels, str) else levels
    return F.transform(arr, lambda x: x[field])


def first_child(arr, path: Sequence[str] = ("item", "name")) -> Column:
    """A field of the first element; NULL for an empty or NULL list
    (``get`` is the null-safe index - ``[0]`` fails under ANSI)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    e = F.get(a, 0)
    for p in path:
        e = e[p]
    return e


def first_per_key(df: DataFrame, key: str, value: str | Column, order: Sequence[str | Column],
                  value_alias: str = "value") -> DataFrame:
    """G2 across rows: the value of the first row per key by ``order``."""
    v = F.col(value) if isinstance(value, str) else value
    o = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    return df.groupBy(key).agg(F.min_by(v, o).alias(value_alias))
