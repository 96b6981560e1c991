"""Prioritised fallback lookup (D9) and override chains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermaster.functions.labels import lookup as dict_lookup
from quartermaster.functions.scalars import drop_last_chars


def lookup_first(df: DataFrame, key: str | Column, candidates: DataFrame, cand_key: str,
                 cand_value: str, strips: Sequence[int], out: str,
                 order: str | None = None, override: Column | None = None,
                 own: str | Column | None = None) -> DataFrame:
    """Attach ``out`` = ``override``, else the value of the first strip
    length (in the given priority order) whose suffix-stripped candidate key
    equals ``key`` - that value as it is, NULL included -, else ``own``.

    Within one strip length, duplicate stripped keys are last-wins by
    ``order`` (dictionary comprehension semantics). The candidates are read
    once: each row gives one (stripped key, priority) per strip length, and
    an aggregate keeps one row per stripped key - ``min_by(value, (priority,
    -pos))`` -, which joins once; AQE broadcasts it when it is small.
    """
    pos = F.col(order).cast("bigint") if order else F.lit(0).cast("bigint")
    forms = F.array(*[F.struct(drop_last_chars(cand_key, n).alias("k"), F.lit(prio).alias("prio"))
                      for prio, n in enumerate(strips)])
    best = (candidates.select(F.explode(forms).alias("f"), pos.alias("__pos"), F.col(cand_value).alias("__v"))
            .filter(F.col("f.k").isNotNull())
            .groupBy(F.col("f.k").alias("__k"))
            # wrapped in a struct: min_by passes over NULL values, and a match without a value is a match
            .agg(F.min_by(F.struct("__v"), F.struct(F.col("f.prio"), -F.col("__pos"))).alias("__hit")))
    k = F.col(key) if isinstance(key, str) else key
    j = df.join(best, k == F.col("__k"), "left")
    own_c = F.col(own) if isinstance(own, str) else (own if own is not None else F.lit(None))
    found = F.when(F.col("__hit").isNotNull(), F.col("__hit")["__v"]).otherwise(own_c)
    value = found if override is None else F.coalesce(override, found)
    return j.select(*[c for c in df.columns if c != out], value.alias(out))


def override_chain(name, fixed: dict, contains: Sequence[tuple[str, object]],
                   joined: Column | None, default) -> Column:
    """Fixed dictionary by exact name > first name-contains rule >
    joined value > default."""
    n = F.col(name) if isinstance(name, str) else name

    def lit(v):
        return F.array(*[F.lit(x) for x in v]) if isinstance(v, list) else F.lit(v)
    expr = None
    for sub, v in contains:
        cond = n.contains(sub)
        expr = F.when(cond, lit(v)) if expr is None else expr.when(cond, lit(v))
    rest = F.coalesce(*[c for c in (joined, lit(default)) if c is not None])
    chained = rest if expr is None else expr.otherwise(rest)
    return F.coalesce(dict_lookup(n, fixed), chained)
