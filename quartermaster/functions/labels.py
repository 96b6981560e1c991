"""Dictionary labelling (L1-L13, D11), array relabelling (I1-I5) and ordered
rule chains (X6-X8), all as built-in column expressions.

Small fixed dictionaries become ``map`` literals (one hash lookup per value,
inside code generation). Dictionaries kept as data (parameter tables) are
joined: :func:`label` for scalars, :func:`relabel_array_table` for arrays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

_PASS = object()


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def map_lit(mapping: dict) -> Column:
    """A ``map`` literal from a small fixed dictionary."""
    kv = []
    for k, v in mapping.items():
        kv.append(F.lit(k))
        kv.append(F.array(*[F.lit(x) for x in v]) if isinstance(v, list) else F.lit(v))
    return F.create_map(*kv)


def lookup(c, mapping: dict | Column) -> Column:
    """Value of ``c`` in the dictionary, NULL when absent (or ``c`` NULL)."""
    m = map_lit(mapping) if isinstance(mapping, dict) else mapping
    return F.try_element_at(m, _c(c))


def label_value(c, mapping: dict | Column, default=_PASS) -> Column:
    """L*: dictionary label of a scalar. ``default`` is a literal, ``None``
    (NULL), or omitted to pass the input through unchanged."""
    found = lookup(c, mapping)
    if default is _PASS:
        return F.coalesce(found, _c(c))
    if default is None:
        return found
    dflt = F.array(*[F.lit(x) for x in default]) if isinstance(default, list) else F.lit(default)
    return F.coalesce(found, dflt)


def override_when_present(c, key, mapping: dict) -> Column:
    """Replace ``c`` by the dictionary value of ``key`` - only when
    ``c`` itself is not NULL."""
    return F.when(_c(c).isNotNull(), F.coalesce(lookup(key, mapping), _c(c)))


def _dictionary(table: DataFrame, key: str, value: str, order: str | None) -> DataFrame:
    """``(__lk, __lv)`` with one row per key: of repeated keys the last one by
    ``order`` (a dictionary built in that order); without an order a repeated
    key fails the job. NULL keys match nothing and are left out."""
    g = table.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__lk"))
    if order is not None:
        return g.agg(F.max_by(F.struct(F.col(value).alias("v")), F.col(order)).alias("__e")) \
            .select("__lk", F.col("__e.v").alias("__lv"))
    repeated = F.raise_error(F.concat(F.lit("repeated dictionary key: "), F.col("__lk").cast("string")))
    return g.agg(F.count(F.lit(1)).alias("__n"), F.max(value).alias("__lv")) \
        .select(F.when(F.col("__n") > 1, repeated).otherwise(F.col("__lk")).alias("__lk"), "__lv")


def label(df: DataFrame, col: str, table: DataFrame, key: str, value: str,
          out: str, default=_PASS, order: str | None = None,
          observation: Observation | None = None) -> DataFrame:
    """Label ``col`` from a parameter table ``(key, value)``, which
    may have an ``order`` column in which later rows replace earlier ones of
    the same key. A plain left join with one row per key: every input row
    stays exactly one row, and Spark broadcasts the table when it is small.
    ``default`` is a literal, a list (an array), ``None`` (NULL), or omitted
    to pass the input through."""
    j = df.join(_dictionary(table, key, value, order), df[col] == F.col("__lk"), "left")
    if observation is not None:
        # unmatched labels counted in the same pass (no extra job)
        j = j.observe(observation, F.count(F.lit(1)).alias("rows"),
                      F.count_if(F.col("__lk").isNull() & F.col(col).isNotNull()).alias("unmatched"))
    if default is _PASS:
        v = F.coalesce("__lv", F.col(col))
    elif default is None:
        v = F.col("__lv")
    else:
        d = F.array(*[F.lit(x) for x in default]) if isinstance(default, list) else F.lit(default)
        v = F.coalesce("__lv", d.cast(table.schema[value].dataType))
    return j.select(*[c for c in df.columns if c != out], v.alias(out))


def relabel_array(c, mapping: dict | Column, policy: str = "drop", default=None) -> Column:
    """Relabel every element of an array, keeping element order.

    * ``drop``: unknown (and NULL) elements are removed (I1);
    * ``default``: unknown elements become ``default`` (I2);
    * ``passthrough``: unknown elements are kept as they are (I3).

    A NULL array stays NULL (T22) instead of failing.
    """
    m = map_lit(mapping) if isinstance(mapping, dict) else mapping
    arr = _c(c)
    if policy == "drop":
        return F.filter(F.transform(arr, lambda x: F.try_element_at(m, x)),
                        lambda y: y.isNotNull())
    if policy == "default":
        return F.transform(arr, lambda x: F.coalesce(F.try_element_at(m, x), F.lit(default)))
    if policy == "passthrough":
        return F.transform(arr, lambda x: F.coalesce(F.try_element_at(m, x), x))
    raise ValueError("policy must be drop, default or passthrough")


def relabel_array_table(df: DataFrame, col: str, table: DataFrame,
                        tkey: str, tvalue: str, out: str, policy: str = "drop",
                        default=None, order: str | None = None) -> DataFrame:
    """I1-I3 with a dictionary kept as a (possibly large) table; the same
    results as :func:`relabel_array`, element for element.

    The new array depends on the old one alone, so each *distinct* array is
    exploded, joined to the dictionary and put together again in position
    order, and the rows take theirs by an equi-join: rows need no key, and a
    group is never more than one array. A NULL array stays NULL, an empty one
    empty; the element type is the dictionary's."""
    t = _dictionary(table, tkey, tvalue, order)
    label_type = table.schema[tvalue].dataType
    arrays = df.select(F.col(col).alias("__a")).filter(F.col("__a").isNotNull()).distinct()
    j = (arrays.select("__a", F.posexplode_outer("__a").alias("__pos", "__x"))
         .join(t, F.col("__x") == F.col("__lk"), "left"))
    if policy == "drop":
        v, keep = F.col("__lv"), F.col("__lv").isNotNull()
    elif policy == "default":
        v, keep = F.coalesce("__lv", F.lit(default).cast(label_type)), F.col("__pos").isNotNull()
    elif policy == "passthrough":
        v, keep = F.coalesce("__lv", F.col("__x").cast(label_type)), F.col("__pos").isNotNull()
    else:
        raise ValueError("policy must be drop, default or passthrough")
    items = F.array_sort(F.collect_list(F.when(keep, F.struct(F.col("__pos"), v.alias("v")))))
    made = j.groupBy("__a").agg(items.alias("__items")) \
        .select("__a", F.transform("__items", lambda s: s["v"]).alias("__new"))
    return (df.join(made, df[col] == F.col("__a"), "left")
            .select(*[c for c in df.columns if c != out], F.col("__new").alias(out)))


def normalise_element(c, old: str, new: str) -> Column:
    """I4: rename one element value inside an array (NULL array stays NULL)."""
    return F.transform(_c(c), lambda x: F.when(x == F.lit(old), F.lit(new)).otherwise(x))


def substring_rules(c, rules: Sequence[tuple[str, str]]) -> Column:
    """Every element emits, in rule order, the label of every rule whose
    substring it contains (0..n labels per element); results are
    concatenated in element order."""
    def emit(x):
        return F.filter(F.array(*[F.when(x.contains(s), F.lit(lbl)) for s, lbl in rules]),
                        lambda y: y.isNotNull())
    return F.flatten(F.transform(_c(c), emit))


def first_match(rules: Sequence[tuple[Column, object]], otherwise) -> Column:
    """Ordered rule chain; the first true condition decides."""
    expr = None
    for cond, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    other = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return other if expr is None else expr.otherwise(other)


def bucket(c, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """X8 (T3): half-open threshold buckets ``< b0 -> l0, < b1 -> l1, ... else
    l_last``; a NULL input gives NULL (an unguarded chain would say the last
    label)."""
    x = _c(c)
    expr = F.when(x.isNull(), F.lit(None).cast("string"))
    for b, lbl in zip(bounds, labels):
        expr = expr.when(x < F.lit(b), F.lit(lbl))
    return expr.otherwise(F.lit(labels[len(bounds)]))
