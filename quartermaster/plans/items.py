"""Item catalogue jobs (P1-P17): landed item documents -> 17 tables.

Shape of the job: one scan of the documents, one routing pass (C5), one
``select`` per target built from column expressions, one keyed merge per
target (B1, last-wins by document position). No Python per row.

Each ``*_rows`` function takes the routed rows of its target (columns of
``ITEM_SCHEMA``: pos, id, name, weight, shortName, image512pxLink, category,
properties as raw JSON) and returns the target's source rows, keyed by
``id`` and carrying ``pos`` for the merge order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermaster.functions import vocab as V
from quartermaster.functions.effects import (annotate, append_by_name, drink_painkillers, effects_json,
                                             injector_painkillers, normalise_effects,
                                             reclassified_effects, split_effects)
from quartermaster.functions.labels import (bucket, first_match, label_value, lookup,
                                            normalise_element, override_when_present,
                                            relabel_array, substring_rules)
from quartermaster.functions.predicates import bag_nonempty
from quartermaster.functions.scalars import json_text
from quartermaster.operators.lookup import lookup_first, override_chain
from quartermaster.operators.merge import merge, with_load_time
from quartermaster.operators.nested import last_value_per_key
from quartermaster.operators.routing import catalogue_rules, route_split
from quartermaster.sources.documents import MEDICAL_SCHEMA, PROPERTY_SCHEMAS, decode_variant


def _decoded(df: DataFrame, member: str) -> tuple[DataFrame, Column]:
    """``df`` with the ``properties`` bag decoded once into a column, and
    that column. Decoding in its own projection matters: a ``from_json``
    written into several ``when`` branches would be parsed once per branch
    (common-subexpression elimination skips conditional branches), while
    Spark does not collapse a projection that would duplicate it."""
    schema = MEDICAL_SCHEMA if member == "Medical" else PROPERTY_SCHEMAS[member]
    return df.withColumn("__p", decode_variant("properties", schema)), F.col("__p")


def _base(name_col: str = "name") -> list[Column]:
    return [F.col("pos"), F.col("id"), F.col("name").alias(name_col),
            F.col("shortName").alias("short_name")]


def _image() -> Column:
    return F.col("image512pxLink").alias("image")


def _ricochet_labels(r: Column) -> dict[str, Column]:
    return {"ricochet_str_en": bucket(r, V.RICOCHET_BOUNDS, V.RICOCHET_EN),
            "ricochet_str_kr": bucket(r, V.RICOCHET_BOUNDS, V.RICOCHET_KR)}


# --------------------------------------------------------------- P1 weapon

def weapon_rows(guns: DataFrame, gun_images: DataFrame) -> DataFrame:
    """D9 image (constant override, then the image item whose short
    name minus 8 / 7 / 6 characters equals this short name - looked up on
    the *original* short name -, else own image), L12 short name, X6
    category on the renamed short name, I5 Korean fire modes."""
    with_img = lookup_first(
        guns, "shortName", gun_images, "shortName", "image512pxLink", V.WEAPON_IMAGE_STRIP,
        out="image", order="pos", override=lookup("name", V.WEAPON_IMAGE_OVERRIDE),
        own="image512pxLink")
    short = F.coalesce(lookup("name", V.WEAPON_SHORT_NAME), F.col("shortName"))
    with_img, p = _decoded(with_img, "Weapon")
    cat = first_match([
        (short.isin(*V.WEAPON_SPECIAL), "Special weapons"),
        (short.isin(*V.WEAPON_GRENADE), "Grenade launcher"),
        (short == V.WEAPON_SHOTGUN, "Shotgun"),
        (F.col("category.name") == V.WEAPON_REVOLVER_CATEGORY, "Handgun"),
        (short.isin(*V.WEAPON_CARBINE), "Assault carbine"),
        (short.isin(*V.WEAPON_RIFLE), "Assault rifle"),
    ], F.col("category.name"))
    return with_img.select(
        "pos", "id", "name", short.alias("short_name"), "image", cat.alias("category"),
        p["caliber"].alias("carliber"), p["defaultAmmo"]["name"].alias("default_ammo"),
        p["fireModes"].alias("modes_en"),
        substring_rules(p["fireModes"], V.FIRE_MODES_KR).alias("modes_kr"),
        p["fireRate"].alias("fire_rate"), p["defaultErgonomics"].alias("ergonomics"),
        p["defaultRecoilVertical"].alias("recoil_vertical"),
        p["defaultRecoilHorizontal"].alias("recoil_horizontal"))


# ------------------------------------------------------- P2-P4, P7, P8, P16

def knife_rows(df: DataFrame) -> DataFrame:
    df, p = _decoded(df, "Melee")
    return df.select(*_base(), _image(), F.col("category.name").alias("category"),
                     p["slashDamage"].alias("slash_damage"), p["stabDamage"].alias("stab_damage"),
                     p["hitRadius"].alias("hit_radius"))


def throwable_rows(df: DataFrame) -> DataFrame:
    df, p = _decoded(df, "Grenade")
    return df.select(*_base(), _image(), F.col("category.name").alias("category"),
                     p["fuse"].alias("fuse"),
                     p["minExplosionDistance"].alias("min_explosion_distance"),
                     p["maxExplosionDistance"].alias("max_explosion_distance"),
                     p["fragments"].alias("fragments"))


def headset_rows(df: DataFrame) -> DataFrame:
    return df.select(*_base(), _image())


def backpack_rows(df: DataFrame) -> DataFrame:
    df, p = _decoded(df, "Backpack")
    return df.select(*_base(), "weight", _image(), json_text(p["grids"]).alias("grids"),
                     p["capacity"].alias("capacity"))


def container_rows(df: DataFrame) -> DataFrame:
    df, p = _decoded(df, "Container")
    return df.select(*_base("name_en"), _image(), json_text(p["grids"]).alias("grids"),
                     p["capacity"].alias("capacity"))


def arm_band_rows(df: DataFrame) -> DataFrame:
    return df.select(*_base(), "weight", _image())


# ------------------------------------------------------- P5, P15 head gear

def headwear_rows(df: DataFrame) -> DataFrame:
    """P5: filled only for a non-empty bag (C3); zones renamed (I4) then
    labelled with a default (I2); ricochet override (L13) then buckets (X8)."""
    df, p = _decoded(df, "Helmet")
    filled = bag_nonempty("properties")
    zones = normalise_element(p["headZones"], *V.HEAD_ZONE_RENAME)
    ric = F.coalesce(lookup("name", V.RICOCHET_OVERRIDE), p["ricochetY"])
    cols = {
        "class_value": p["class"],
        "areas_en": zones,
        "areas_kr": relabel_array(zones, V.HEAD_ZONES_KR, "default", V.HEAD_ZONE_UNKNOWN_KR),
        "ricochet_chance": ric,
    }
    return df.select(*_base(), *[F.when(filled, c).alias(n) for n, c in cols.items()],
                     "weight", _image(),
                     *[F.when(filled, c).alias(n) for n, c in _ricochet_labels(ric).items()])


def face_cover_rows(df: DataFrame) -> DataFrame:
    """Like P5 without the ricochet override; everything NULL for a
    NULL bag (and, unlike the catalogue, no failure for ``{}``)."""
    df, p = _decoded(df, "Helmet")
    zones = normalise_element(p["headZones"], *V.HEAD_ZONE_RENAME)
    ric = p["ricochetY"]
    return df.select(*_base(), p["class"].alias("class_value"), zones.alias("areas_en"),
                     relabel_array(zones, V.HEAD_ZONES_KR, "default",
                                   V.HEAD_ZONE_UNKNOWN_KR).alias("areas_kr"),
                     ric.alias("ricochet_chance"), "weight", _image(),
                     *[c.alias(n) for n, c in _ricochet_labels(ric).items()])


# ------------------------------------------------------------- P6, P10, P17

def armor_vest_rows(df: DataFrame) -> DataFrame:
    df, p = _decoded(df, "Armor")
    return df.select(*_base(), "weight", _image(), p["class"].alias("class_value"),
                     p["zones"].alias("areas_en"),
                     relabel_array(p["zones"], V.ARMOR_ZONES_KR, "drop").alias("areas_kr"))


def rig_rows(df: DataFrame) -> DataFrame:
    """P10: class, zones and labels only when the class is present."""
    df, p = _decoded(df, "ChestRig")
    has = p["class"].isNotNull()
    return df.select(*_base(), "weight", _image(),
                     F.when(has, p["class"]).alias("class_value"),
                     F.when(has, p["zones"]).alias("areas_en"),
                     F.when(has, relabel_array(p["zones"], V.ARMOR_ZONES_KR, "drop")).alias("areas_kr"),
                     p["capacity"].alias("capacity"))


def glasses_rows(df: DataFrame) -> DataFrame:
    df, p = _decoded(df, "Glasses")
    has = p["class"].isNotNull()
    return df.select(*_base(), F.when(has, p["class"]).alias("class_value"),
                     F.when(has, p["durability"]).alias("durability"),
                     F.when(has, p["blindnessProtection"]).alias("blindness_protection"),
                     _image())


# ------------------------------------------------------------------ P9 key

def key_map(maps: DataFrame) -> DataFrame:
    """A2 + N3 + E4 + L10 (T17): key name -> map codes of the *last* map
    (then lock) that lists it."""
    # outer, with a filter: see operators.nested (an inner explode would decode the maps twice)
    locks = maps.select(F.col("pos").alias("map_pos"), "name",
                        F.posexplode_outer("locks").alias("lock_pos", "lock")).filter(F.col("lock_pos").isNotNull())
    codes = label_value("name", V.MAP_CODES, default=V.MAP_CODES_DEFAULT)
    return last_value_per_key(locks, F.col("lock.key.name"), codes, ["map_pos", "lock_pos"],
                              key_alias="__key", value_alias="__codes")


def key_rows(keys: DataFrame, maps: DataFrame) -> DataFrame:
    """D10 override chain for the map codes, then I3 (pass unknown
    codes through) to English and Korean."""
    km = key_map(maps)
    j = keys.join(km, keys["name"] == km["__key"], "left")
    codes = override_chain("name", V.KEY_MAP_OVERRIDE, V.KEY_MAP_CONTAINS, F.col("__codes"),
                           V.MAP_CODES_DEFAULT)
    j, p = _decoded(j, "Key")
    return j.select(*_base(), _image(), p["uses"].alias("uses"),
                    relabel_array(codes, V.MAP_CODE_EN, "passthrough").alias("use_map_en"),
                    relabel_array(codes, V.MAP_CODE_KR, "passthrough").alias("use_map_kr"),
                    codes.alias("map_value"))


# ------------------------------------------------------- P11, P12 effects

def provisions_rows(df: DataFrame) -> DataFrame:
    """Effects labelled (I6, provisions vocabulary), then the drink
    painkiller appended with its own label (I7), then JSON (X11)."""
    df, p = _decoded(df, "FoodDrink")
    df = df.withColumn("__e0", annotate(normalise_effects(p["stimEffects"]),
                                        V.FOOD_SKILL_KR, V.FOOD_TYPE_KR))
    eff = append_by_name("__e0", "name", drink_painkillers())
    return df.select(*_base("name_en"), F.col("category.name").alias("category"),
                     p["energy"].alias("energy"), p["hydration"].alias("hydration"),
                     effects_json(eff, chance=False).alias("stim_effects"), _image())


def medical_rows(df: DataFrame) -> DataFrame:
    """I8 reclassification first, then the injector painkiller (I7),
    then labels (I6, medical vocabulary), then buffs / debuffs (I9, I10) as
    JSON. An empty effect list gives ``[]``, an absent one NULL. Cures are
    labelled (I1); the painkiller duration is overridden by name when
    present (L11)."""
    df, p = _decoded(df, "Medical")
    morph = F.col("name") == V.RECLASSIFIED_NAME

    def dropped(field: str) -> Column:
        return F.when(~morph, p[field]) if field in V.RECLASSIFIED_DROPPED else p[field]

    # one projection per step: each step's array is computed once per row
    # and referenced by the next (nesting them would repeat the work in
    # every branch that mentions the array)
    df = df.withColumn("__e0", F.when(morph, reclassified_effects())
                       .otherwise(normalise_effects(p["stimEffects"])))
    df = df.withColumn("__e1", append_by_name("__e0", "name", injector_painkillers()))
    df = df.withColumn("__eff", annotate("__e1", V.MED_SKILL_KR, V.MED_TYPE_KR))
    cures = dropped("cures")
    return df.select(
        *_base("name_en"), cures.alias("cures_en"),
        relabel_array(cures, V.CURES_KR, "drop").alias("cures_kr"),
        F.when(morph, F.lit(V.RECLASSIFIED_CATEGORY)).otherwise(F.col("category.name")).alias("category"),
        effects_json(split_effects("__eff", "buff")).alias("buff"),
        effects_json(split_effects("__eff", "debuff")).alias("debuff"),
        dropped("useTime").alias("use_time"), dropped("uses").alias("uses"),
        dropped("energyImpact").alias("energy_impact"),
        dropped("hydrationImpact").alias("hydration_impact"),
        override_when_present(dropped("painkillerDuration"), "name",
                              V.PAINKILLER_DURATION).alias("painkiller_duration"),
        p["hitpoints"].alias("hitpoints"), _image())


# --------------------------------------------------------- P13, P14 misc

def ammo_rows(df: DataFrame) -> DataFrame:
    df, p = _decoded(df, "Ammo")
    return df.select(*_base(), p["damage"].alias("damage"),
                     p["penetrationPower"].alias("penetration_power"),
                     p["armorDamage"].alias("armor_damage"),
                     p["accuracyModifier"].alias("accuracy_modifier"),
                     p["recoilModifier"].alias("recoil_modifier"),
                     p["lightBleedModifier"].alias("light_bleed_modifier"),
                     p["heavyBleedModifier"].alias("heavy_bleed_modifier"), _image())


def loot_rows(df: DataFrame) -> DataFrame:
    """X7 recategorisation (category list, then two name lists)."""
    cat = first_match([
        (F.col("category.name").isin(*V.LOOT_SPECIAL_CATEGORIES), "Special equipment"),
        (F.col("name").isin(*V.LOOT_JEWELRY), "Jewelry"),
        (F.col("name").isin(*V.LOOT_LUBRICANT), "Lubricant"),
    ], F.col("category.name"))
    return df.select(*_base("name_en"), _image(), cat.alias("category"))


# ----------------------------------------------------------- the whole job

@dataclass(frozen=True)
class Target:
    """How one table is fed: the route(s), the row builder, the merge's
    insert and update columns (T6 / T7)."""
    route: str
    build: object
    insert_cols: tuple
    update_cols: tuple | None = None


def _cols(*names):
    return tuple(names) + ("update_time",)


TARGETS = {
    "weapon": Target("Gun", None, _cols("name", "short_name", "image", "category", "carliber",
                                            "default_ammo", "modes_en", "modes_kr", "fire_rate",
                                            "ergonomics", "recoil_vertical", "recoil_horizontal")),
    "knife": Target("Knife", knife_rows, _cols("name", "short_name", "image", "category",
                                                   "slash_damage", "stab_damage", "hit_radius")),
    "throwable": Target("Throwable weapon", throwable_rows,
                            _cols("name", "short_name", "image", "category", "fuse",
                                  "min_explosion_distance", "max_explosion_distance", "fragments")),
    "headset": Target("Headphones", headset_rows, _cols("name", "short_name", "image")),
    "headwear": Target("Headwear", headwear_rows,
                           _cols("name", "short_name", "class_value", "areas_en", "areas_kr",
                                 "ricochet_chance", "weight", "image", "ricochet_str_en",
                                 "ricochet_str_kr")),
    "armor_vest": Target("Armor", armor_vest_rows,
                             _cols("name", "short_name", "weight", "image", "class_value",
                                   "areas_en", "areas_kr")),
    "backpack": Target("Backpack", backpack_rows,
                           _cols("name", "short_name", "weight", "image", "grids", "capacity")),
    "container": Target("Common container", container_rows,
                            _cols("name_en", "short_name", "image", "grids", "capacity")),
    "key": Target("Key", None, _cols("name", "short_name", "image", "uses", "use_map_en",
                                         "use_map_kr", "map_value")),
    "rig": Target("Chest rig", rig_rows,
                      _cols("name", "short_name", "weight", "image", "class_value", "areas_en",
                            "areas_kr", "capacity")),
    "provisions": Target("Provisions", provisions_rows,
                             _cols("name_en", "short_name", "category", "energy", "hydration",
                                   "stim_effects", "image")),
    "medical": Target("Meds", medical_rows,
                          _cols("name_en", "short_name", "cures_en", "cures_kr", "category", "buff",
                                "debuff", "use_time", "uses", "energy_impact", "hydration_impact",
                                "painkiller_duration", "hitpoints", "image")),
    "ammo": Target("Ammo", ammo_rows,
                       _cols("name", "short_name", "damage", "penetration_power", "armor_damage",
                             "accuracy_modifier", "recoil_modifier", "light_bleed_modifier",
                             "heavy_bleed_modifier", "image"),
                       # short_name is written for new rows only
                       _cols("name", "damage", "penetration_power", "armor_damage",
                             "accuracy_modifier", "recoil_modifier", "light_bleed_modifier",
                             "heavy_bleed_modifier", "image")),
    "loot": Target("Loot", loot_rows, _cols("name_en", "short_name", "image", "category")),
    "face_cover": Target("Face Cover", face_cover_rows,
                             _cols("name", "short_name", "class_value", "areas_en", "areas_kr",
                                   "ricochet_chance", "weight", "image", "ricochet_str_en",
                                   "ricochet_str_kr")),
    "arm_band": Target("Arm Band", arm_band_rows,
                           _cols("name", "short_name", "weight", "image")),
    "glasses": Target("Vis. observ. device", glasses_rows,
                          _cols("name", "short_name", "class_value", "durability",
                                "blindness_protection", "image")),
}


def item_sources(items: DataFrame, maps: DataFrame, as_of,
                 only: list[str] | None = None, stage_dir: str | None = None) -> dict[str, DataFrame]:
    """Route the catalogue once and build the source rows of every target
    (or of the ``only`` targets), each stamped with the run's load time
    (B15). The routed rows are staged once as Parquet partitioned by target
    (in ``stage_dir``, by default a fresh folder under the shared checkpoint
    folder), so the documents are parsed and classified once per run however
    many targets are built, and each target reads only its own partition."""
    tables = [t for t in TARGETS if only is None or t in only]
    needed = {TARGETS[t].route for t in tables}
    if "weapon" in tables:
        needed.add("Gun image")
    routed = route_split(items, catalogue_rules(only=needed), stage_dir=stage_dir)
    out = {}
    for table in tables:
        t = TARGETS[table]
        if table == "weapon":
            rows = weapon_rows(routed["Gun"], routed["Gun image"])
        elif table == "key":
            rows = key_rows(routed["Key"], maps)
        else:
            rows = t.build(routed[t.route])
        out[table] = with_load_time(rows, as_of)
    return out


def upsert_items(targets: dict[str, DataFrame], items: DataFrame, maps: DataFrame,
                 as_of, stage_dir: str | None = None) -> dict[str, DataFrame]:
    """The new state of each item table (last-wins by document
    position, column subsets per table)."""
    sources = item_sources(items, maps, as_of, stage_dir=stage_dir)
    out = {}
    for table, src in sources.items():
        t = TARGETS[table]
        out[table] = merge(targets[table], src, "id", insert_cols=list(t.insert_cols),
                           update_cols=list(t.update_cols) if t.update_cols else None,
                           order_cols="pos")
    return out
