"""Station ("hideout") jobs (P18-P25): station documents -> 8 tables.

Each target is an expression on a document: the array of the rows that the
document gives it, walked level by level (N1) and requirement by requirement
(N2). One target is one ``Generate`` over its array, inside the scan stage.
Several targets are one ``Generate`` over all their arrays: every row is
tagged with its target and the documents are read and parsed once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermaster.functions.scalars import composite_text, falsy_to_null
from quartermaster.operators.merge import merge, with_load_time
from quartermaster.operators.nested import child_ids, first_child
from quartermaster.session import ensure_checkpoint_dir


def _struct(pos: Sequence[Column], cols: dict[str, Column]) -> Column:
    """A row of a target: where it stands in its documents (for the
    last-wins order) and its columns."""
    at = F.struct(*[c.alias(f"p{i}") for i, c in enumerate(pos)])
    return F.struct(at.alias("pos"), *[c.alias(n) for n, c in cols.items()])


def _levels(build: Callable[[Column], dict[str, Column]]) -> Column:
    """A row per level."""
    return F.transform("levels", lambda lv, i: _struct([F.col("pos"), i], build(lv)))


def _children(field: str, build: Callable[[Column], dict[str, Column]]) -> Column:
    """A row per element of a level's list, with the level's id."""
    def rows(lv: Column, i: Column) -> Column:
        own = F.transform(lv[field], lambda c, j: _struct([F.col("pos"), i, j], {"level_id": lv["id"], **build(c)}))
        return F.coalesce(own, F.array())
    return F.flatten(F.transform("levels", rows))


def _master() -> Column:
    """Station with the ids of its levels in order."""
    return F.array(_struct([F.col("pos")], {"id": F.col("id"), "name_en": F.col("name"), "image": F.col("imageLink"),
                                            "level_ids": child_ids("levels")}))


def _level() -> Column:
    """P19 (N1)."""
    return _levels(lambda lv: {"id": lv["id"], "level": lv["level"], "construction_time": lv["constructionTime"]})


def _item_require() -> Column:
    """P20 (N2)."""
    return _children("itemRequirements", lambda c: {
        "id": c["id"], "name_en": c["item"]["name"], "quantity": c["quantity"], "count": c["count"],
        "image": c["item"]["image512pxLink"]})


def _trader_require() -> Column:
    """P21 (N2, C2: NULL trader gives NULL name / image)."""
    return _children("traderRequirements", lambda c: {
        "id": c["id"], "name_en": c["trader"]["name"], "value": c["value"], "require_type": c["requirementType"],
        "compare": c["compareMethod"], "image": c["trader"]["imageLink"]})


def _station_require() -> Column:
    """P22 (N2)."""
    return _children("stationLevelRequirements", lambda c: {
        "id": c["id"], "level": c["level"], "name_en": c["station"]["name"], "image": c["station"]["imageLink"]})


def _skill_require() -> Column:
    """P23 (N2)."""
    return _children("skillRequirements", lambda c: {"id": c["id"], "level": c["level"], "name_en": c["skill"]["name"]})


def _bonus() -> Column:
    """P24 (N2, X10/T15): key (level_id, type); an empty skill name is
    NULL; a type repeated within a level is last-wins (merge order)."""
    return _children("bonuses", lambda c: {"type": c["type"], "name_en": c["name"], "value": c["value"],
                                           "skill_name_en": falsy_to_null(c["skillName"])})


def _crafts(missing_station: str | None = None) -> Column:
    """P25 (N1, X2/T14, I12/G2): level key ``station-level`` (NULL when the
    station is missing, or the text given in ``missing_station``), name of
    the first reward (NULL when there is none)."""
    return F.transform("crafts", lambda c, i: _struct([F.col("pos"), i], {
        "id": c["id"], "level_id": composite_text(c["station"]["id"], c["level"], null_text=missing_station),
        "level": c["level"], "name_en": first_child(c["rewardItems"])}))


#: target -> (array of its rows in a document, key, insert columns)
TARGETS = {
    "hideout_master": (_master, ["id"], ["name_en", "image", "level_ids"]),
    "hideout_level": (_level, ["id"], ["level", "construction_time"]),
    "hideout_item_require": (_item_require, ["id"], ["level_id", "name_en", "quantity", "count", "image"]),
    "hideout_trader_require": (_trader_require, ["id"],
                                   ["level_id", "name_en", "value", "require_type", "compare", "image"]),
    "hideout_station_require": (_station_require, ["id"], ["level_id", "level", "name_en", "image"]),
    "hideout_skill_require": (_skill_require, ["id"], ["level_id", "level", "name_en"]),
    "hideout_bonus": (_bonus, ["level_id", "type"], ["name_en", "value", "skill_name_en"]),
    "hideout_crafts": (_crafts, ["id"], ["level_id", "level", "name_en"]),
}


def _generate(stations: DataFrame, rows: Column, always: str) -> DataFrame:
    """One row per element of ``rows``. Written as an outer ``inline`` and a
    filter: an inner one makes Spark infer ``size(rows) > 0`` and evaluate
    the whole array twice."""
    return stations.select(F.inline_outer(rows)).filter(F.col(always).isNotNull())


def target_rows(stations: DataFrame, target: str, **options) -> DataFrame:
    """The source rows of one target (with ``pos``)."""
    return _generate(stations, TARGETS[target][0](**options), "pos")


def tagged_rows(stations: DataFrame, targets: Sequence[str] = tuple(TARGETS)) -> DataFrame:
    """``(target, <one struct column per target>)``: the rows of several
    targets from one pass over the documents; the struct of the row's own
    target is filled."""
    arrays = {t: TARGETS[t][0]() for t in targets}
    kinds = stations.select(*[a.alias(t) for t, a in arrays.items()]).schema
    none = {t: F.lit(None).cast(kinds[t].dataType.elementType).alias(t) for t in targets}

    def tagged(t: str) -> Column:
        own = F.transform(arrays[t], lambda r: F.struct(F.lit(t).alias("target"), *[r.alias(x) if x == t else none[x] for x in targets]))
        return F.coalesce(own, F.array())  # a document without the list

    return _generate(stations, F.concat(*[tagged(t) for t in targets]), "target")


def station_sources(stations: DataFrame, as_of, only: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The source rows of every target (or of the ``only`` targets), stamped
    with the load time (B15). Several targets are written once, by target,
    under the shared checkpoint folder, and each reads its own part; a single
    one needs no copy."""
    targets = [t for t in TARGETS if only is None or t in only]
    if len(targets) == 1:
        rows = {targets[0]: target_rows(stations, targets[0])}
    else:
        spark = stations.sparkSession
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stations-{uuid.uuid4().hex}"
        tagged = tagged_rows(stations, targets)
        tagged.write.partitionBy("target").parquet(path)
        staged = spark.read.schema(tagged.schema).parquet(path)
        rows = {t: staged.filter(F.col("target") == t).select(f"{t}.*") for t in targets}
    return {t: with_load_time(r, as_of) for t, r in rows.items()}


def upsert_stations(targets: dict[str, DataFrame], stations: DataFrame, as_of) -> dict[str, DataFrame]:
    """The new state of each station table (B1, B2 for bonuses)."""
    out = {}
    for t, src in station_sources(stations, as_of).items():
        _, key, cols = TARGETS[t]
        out[t] = merge(targets[t], src, key, insert_cols=cols + ["update_time"], order_cols="pos")
    return out
