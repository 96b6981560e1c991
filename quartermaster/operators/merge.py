"""Keyed merges (upserts) expressed as one shuffle on the key.

Semantics (B1-B6, B12, B15):

* ``duplicates="last"`` – a key repeated in the source is legal; the row that
  is last by ``order_cols`` (document position) wins, as when rows are
  upserted one at a time in list order.
* ``duplicates="error"`` – a repeated key fails the job, as a set-based
  ``INSERT ... SELECT ... ON CONFLICT`` does.
* ``update_cols`` overwrite the target with the source value, NULL included
  (a presence marker decides, never ``coalesce``).
* ``insert_cols`` minus ``update_cols`` are written for new keys only.
* every other target column is carried over (NULL for new keys).
* keys that exist only in the target are kept unchanged; a merge never
  deletes.

Plan shape: one pass over either side. The source is reduced to one row per
key with a partial + final aggregate (map-side combine absorbs a hot key);
its shuffle serves the full outer join with the target as well, so that each
side is read once and shuffled once. Both sides hold a key once, so no
partition of the join is skewed by a key; target rows whose key is NULL match
nothing and are dealt out by their content.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermaster.functions.scalars import as_of_lit

_S = "__src_"
_S_PRESENT, _T_PRESENT, _HASH = "__src_present", "__tgt_present", "__key_hash"


def _as_list(x: str | Sequence[str] | None) -> list[str]:
    if x is None:
        return []
    if isinstance(x, str):
        return [x]
    return list(x)


def last_per_key(df: DataFrame, key: str | Sequence[str],
                 order_cols: str | Sequence[str | Column],
                 cols: Sequence[str] | None = None) -> DataFrame:
    """E5: the last row per key by ``order_cols`` (ties: arbitrary but stable
    only if ``order_cols`` is a total order).

    ``max_by(struct(payload), struct(order))`` is an ordinary aggregate, so
    Spark adds a map-side partial aggregate before the shuffle: a key that
    holds a third of all rows leaves every map task as a single row.
    """
    keys = _as_list(key)
    payload = [c for c in (cols or df.columns) if c not in keys]
    order = [F.col(c) if isinstance(c, str) else c for c in _as_list(order_cols)]
    if not payload:
        return df.select(*keys).distinct()
    agg = (df.groupBy(*keys)
           .agg(F.max_by(F.struct(*payload), F.struct(*order)).alias("__last")))
    return agg.select(*keys, *[F.col("__last")[c].alias(c) for c in payload])


def _bad(keys: list[str], bad: Column, message: str) -> tuple[Column, Column]:
    """Whether a row of an aggregate with the row count ``__n`` breaks a rule
    or has a NULL key, and the text to fail with. It reads the count, so that
    a condition on the keys that Spark infers from a later join cannot be
    moved below the aggregate, where it might see rows that a filter is about
    to drop."""
    text = F.concat(F.lit(f"{message}: "), F.to_json(F.struct(*keys)))
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]) & (F.col("__n") > 0)
    return bad | null, text


def assert_unique_keys(df: DataFrame, key: str | Sequence[str],
                       what: str = "source") -> DataFrame:
    """Fail the job when a key repeats or is NULL.

    The check rides along the aggregation that de-duplicates anyway, so it
    costs no extra pass: the projection of the keys raises while the rows
    stream through.
    """
    keys = _as_list(key)
    others = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"),
        *([F.first(F.struct(*others)).alias("__row")] if others else []))
    bad, text = _bad(keys, F.col("__n") > 1, f"duplicate or NULL key in {what}")
    return agg.select(*[F.when(bad, F.raise_error(text)).otherwise(F.col(k)).alias(k) for k in keys],
                      *[F.col("__row")[c].alias(c) for c in others])


def _merge_source(source: DataFrame, keys: list[str], cols: list[str], order_cols, duplicates: str) -> DataFrame:
    """The source as one row per key: the key's hash, the key and ``cols``
    under prefixed names, and a marker that is true, or fails the job where
    the row must not be merged. The keys leave the aggregate as they are, so
    its shuffle is the join's as well."""
    row = F.struct(*cols) if cols else None
    if duplicates == "last":
        if order_cols is None:
            raise ValueError("duplicates='last' needs order_cols")
        order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in _as_list(order_cols)])
        picked = row is not None and F.max_by(row, order)
        bad, message = F.lit(False), "NULL key in merge source"
    elif duplicates == "error":
        picked = row is not None and F.first(row)
        bad, message = F.col("__n") > 1, "duplicate or NULL key in source"
    else:
        raise ValueError("duplicates must be 'last' or 'error'")
    agg = (source.withColumn(_HASH, F.xxhash64(*keys)).groupBy(_HASH, *keys)
           .agg(F.count(F.lit(1)).alias("__n"), *([picked.alias("__row")] if cols else [])))
    bad, text = _bad(keys, bad, message)
    return agg.select(F.col(_HASH).alias(_S + _HASH), *[F.col(k).alias(_S + k) for k in keys],
                      *[F.col("__row")[c].alias(_S + c) for c in cols],
                      F.when(bad, F.raise_error(text).cast("boolean")).otherwise(True).alias(_S_PRESENT))


def merge(target: DataFrame, source: DataFrame, key: str | Sequence[str],
          insert_cols: Sequence[str] | None = None,
          update_cols: Sequence[str] | None = None,
          order_cols: str | Sequence[str | Column] | None = None,
          duplicates: str = "last") -> DataFrame:
    """Upsert ``source`` into ``target`` and return the new table.

    ``insert_cols`` default to the source columns present in the target,
    ``update_cols`` default to ``insert_cols`` minus the key.
    """
    keys = _as_list(key)
    tcols = target.columns
    if insert_cols is None:
        insert_cols = [c for c in source.columns if c in tcols]
    insert_cols = [c for c in insert_cols if c not in keys]
    if update_cols is None:
        update_cols = list(insert_cols)
    update_cols = [c for c in update_cols if c not in keys]
    missing = [c for c in insert_cols + keys if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks columns {missing}")
    extra = [c for c in insert_cols if c not in tcols]
    if extra:
        raise ValueError(f"target lacks columns {extra}")
    if not set(update_cols) <= set(insert_cols):
        raise ValueError("update_cols must be a subset of insert_cols")

    for k in keys:  # equal keys must have equal hashes
        kind, own = target.schema[k].dataType, source.schema[k].dataType
        if own != kind:
            if not (isinstance(own, T.NumericType) and isinstance(kind, T.NumericType)):
                raise ValueError(f"key {k} is {kind.simpleString()} in the target, {own.simpleString()} in the source")
            source = source.withColumn(k, F.col(k).cast(kind))
    s = _merge_source(source, keys, insert_cols, order_cols, duplicates)
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    spread = F.xxhash64(F.spark_partition_id(), *[F.col(f.name) for f in target.schema.fields if _hashable(f.dataType)])
    t = (target.withColumn(_HASH, F.when(has_key, F.xxhash64(*keys)).otherwise(spread))
         .withColumn(_T_PRESENT, F.lit(True)))
    matching = reduce(lambda a, b: a & b, [F.col(_HASH) == F.col(_S + _HASH), *[F.col(k) == F.col(_S + k) for k in keys]])
    both = t.join(s, matching, "full")

    def value(c: str) -> Column:
        kind, new, old = target.schema[c].dataType, F.col(_S + c), F.col(c)
        if c in keys:  # reads the marker in every row, so that a bad source row always fails the job
            return F.when(F.coalesce(F.col(_S_PRESENT), F.lit(True)), F.when(F.col(_T_PRESENT), old).otherwise(new))
        if c in update_cols:
            return F.when(F.col(_S_PRESENT), new.cast(kind)).otherwise(old)
        if c in insert_cols:
            return F.when(F.col(_T_PRESENT), old).otherwise(new.cast(kind))
        return old

    return both.select(*[value(c).alias(c) for c in tcols])


def _hashable(kind: T.DataType) -> bool:
    """Whether Spark hashes values of a type (maps and variants it does not)."""
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def update_from(target: DataFrame, source: DataFrame, key: str | Sequence[str],
                set_cols: dict[str, str] | Sequence[str]) -> DataFrame:
    """B12 (``UPDATE t SET c = s.x FROM s WHERE t.k = s.k``): rows of the
    target without a source row are left unchanged. ``set_cols`` maps target
    column -> source column (or lists names present in both).

    The source must be unique on the key (it is an aggregate in every use).
    """
    keys = _as_list(key)
    mapping = dict(set_cols) if isinstance(set_cols, dict) else {c: c for c in set_cols}
    s = source.select(*keys, *[F.col(v).alias(_S + k) for k, v in mapping.items()],
                      F.lit(True).alias(_S_PRESENT))
    j = target.join(s, on=keys, how="left")
    return j.select(*[
        (F.when(F.col(_S_PRESENT), F.col(_S + c)).otherwise(F.col(c)).alias(c)
         if c in mapping else F.col(c))
        for c in target.columns])


def with_load_time(df: DataFrame, as_of, col: str = "update_time") -> DataFrame:
    """One load instant per run, passed in (reproducible)."""
    return df.withColumn(col, as_of_lit(as_of))


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """B3 diagnostics: every key that occurs more than once, with its count
    (partial + final aggregate; a hot key is pre-counted map-side)."""
    keys = _as_list(key)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))
