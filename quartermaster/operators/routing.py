"""Category routing (C1, C2, C5 a-i, C9).

The catalogue is classified in one pass: every rule is a ``Column``
predicate over (category name, parent name, item name, raw ``properties``
JSON); :func:`route` tags each row with the names of the rules it matches,
and :func:`route_split` gives one DataFrame per target over a single staged
copy of the tagged rows (written partitioned by route, so that each target
reads only its own partition).

Rules are built from *shapes* (the nine forms C5a-C5i) and constants;
:func:`catalogue_rules` instantiates them with the catalogue's fixed values.
A row whose category or parent is NULL matches no rule that tests it (T2).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quartermaster.functions import vocab as V
from quartermaster.functions.predicates import bag_empty, bag_nonempty
from quartermaster.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class Fields:
    """Column names the rules read."""
    category: str = "category.name"
    parent: str = "category.parent.name"
    name: str = "name"
    bag: str = "properties"


def _t(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


# ------------------------------------------------------------------ shapes

def parent_nonempty(f: Fields, parent: str) -> Column:
    """C5a / C5f: parent equality and a non-empty bag."""
    return _t((F.col(f.parent) == parent) & bag_nonempty(f.bag))


def parent_empty_name_has(f: Fields, parent: str, parts: Sequence[str]) -> Column:
    """Parent equality, empty bag, name contains any of ``parts``."""
    has = F.lit(False)
    for p in parts:
        has = has | F.col(f.name).contains(p)
    return _t((F.col(f.parent) == parent) & bag_empty(f.bag) & has)


def category_is(f: Fields, category: str) -> Column:
    """C5c / C5h: category equality only (the bag may be empty)."""
    return _t(F.col(f.category) == category)


def category_except_names(f: Fields, category: str, names: Sequence[str]) -> Column:
    """C5d: category equality, name not in a list."""
    return _t((F.col(f.category) == category) & ~_t(F.col(f.name).isin(*names)))


def categories_nonempty(f: Fields, categories: Sequence[str]) -> Column:
    """C5e: category in a list, non-empty bag."""
    return _t(F.col(f.category).isin(*categories) & bag_nonempty(f.bag))


def parents_or_category_except(f: Fields, parents: Sequence[str], category: str,
                               names: Sequence[str], name_part: str) -> Column:
    """C5g: (parent in list or category equal), name not in a list, name
    does not contain ``name_part``; no bag test."""
    return _t((F.col(f.parent).isin(*parents) | (F.col(f.category) == category))
              & ~_t(F.col(f.name).isin(*names)) & ~_t(F.col(f.name).contains(name_part)))


def category_nonempty(f: Fields, category: str) -> Column:
    """C5i (default): category equality and a non-empty bag."""
    return _t((F.col(f.category) == category) & bag_nonempty(f.bag))


#: The item catalogue's routing, target name -> rule (built on demand).
CATALOGUE_RULES = {
    "Gun": lambda f: parent_nonempty(f, "Weapon"),
    "Gun image": lambda f: parent_empty_name_has(f, "Weapon", V.GUN_IMAGE_NAME_PARTS),
    "Headphones": lambda f: category_is(f, "Headphones"),
    "Headwear": lambda f: category_except_names(f, "Headwear", V.HEADWEAR_EXCLUDED),
    "Provisions": lambda f: categories_nonempty(f, ["Food", "Drink"]),
    "Key": lambda f: parent_nonempty(f, "Key"),
    "Meds": lambda f: parent_nonempty(f, "Meds"),
    "Loot": lambda f: parents_or_category_except(f, V.LOOT_PARENTS, V.LOOT_CATEGORY,
                                                 V.LOOT_EXCLUDED, V.LOOT_EXCLUDED_PART),
    "Face Cover": lambda f: category_is(f, "Face Cover"),
    "Arm Band": lambda f: category_is(f, "Arm Band"),
    "Vis. observ. device": lambda f: category_is(f, "Vis. observ. device"),
    "Knife": lambda f: category_nonempty(f, "Knife"),
    "Throwable weapon": lambda f: category_nonempty(f, "Throwable weapon"),
    "Armor": lambda f: category_nonempty(f, "Armor"),
    "Backpack": lambda f: category_nonempty(f, "Backpack"),
    "Common container": lambda f: category_nonempty(f, "Common container"),
    "Chest rig": lambda f: category_nonempty(f, "Chest rig"),
    "Ammo": lambda f: category_nonempty(f, "Ammo"),
}


def catalogue_rules(f: Fields = Fields(), only=None) -> dict[str, Column]:
    """The item catalogue's routing as predicates (all, or the ``only``
    targets)."""
    return {n: r(f) for n, r in CATALOGUE_RULES.items() if only is None or n in only}


# ------------------------------------------------------------------ routing

def route(df: DataFrame, rules: dict[str, Column], out: str = "route",
          observation: Observation | None = None, fields: Fields = Fields()) -> DataFrame:
    """One row per (input row, matching rule), tagged with the rule name,
    in a single pass (a ``Generate`` node; no shuffle). Rows matching no rule
    disappear.

    With an ``Observation`` the same pass also counts the input rows, the
    rows that matched nothing and the rows whose category or parent is NULL
    (T2: dropped where the catalogue's own code would have failed) - read
    them from ``observation.get`` after the first action."""
    tags = F.filter(F.array(*[F.when(p, F.lit(n)) for n, p in rules.items()]),
                    lambda x: x.isNotNull())
    tagged = df.withColumn("__tags", tags)
    if observation is not None:
        tagged = tagged.observe(
            observation,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.size("__tags") == 0).alias("unrouted"),
            F.count_if(F.col(fields.category).isNull() | F.col(fields.parent).isNull())
            .alias("null_category"))
    # outer explode + a filter on the generated column: an inner explode makes
    # Spark infer ``size(tags) > 0`` and push it down to the scan, where it
    # would evaluate every rule (and any decoding under them) a second time
    return (tagged.withColumn(out, F.explode_outer("__tags")).drop("__tags")
            .filter(F.col(out).isNotNull()))


def route_split(df: DataFrame, rules: dict[str, Column], stage_dir: str | None = None) -> dict[str, DataFrame]:
    """One DataFrame per target over one shared classification, so N
    targets do not mean N parses of the landed documents: the tagged rows are
    written once as Parquet partitioned by ``route`` (in ``stage_dir``, by
    default a fresh folder under the shared checkpoint folder). Each target
    reads only its own partition, and a lost executor re-reads files instead
    of recomputing the parse. A single target needs no copy (unless
    ``stage_dir`` asks for one)."""
    if len(rules) == 1 and stage_dir is None:
        return {n: route(df, rules).drop("route") for n in rules}
    spark = df.sparkSession
    if stage_dir is None:
        stage_dir = f"{ensure_checkpoint_dir(spark).rstrip('/')}/routed-{uuid.uuid4().hex}"
    tagged = route(df, rules)
    tagged.write.mode("overwrite").partitionBy("route").parquet(stage_dir)
    staged = spark.read.schema(tagged.schema).parquet(stage_dir)
    return {n: staged.filter(F.col("route") == n).drop("route") for n in rules}


def route_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows per target (C5 diagnostics), one pass."""
    return route(df, rules).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


def when_present(cond: Column, cols: dict[str, Column]) -> list[Column]:
    """A group of columns filled only when ``cond`` holds, else NULL."""
    return [F.when(cond, c).alias(n) for n, c in cols.items()]
