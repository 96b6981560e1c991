"""Nested, polymorphic documents.

Documents are landed as JSON lines, one entity per line with an integer
``pos`` for document order, or as enveloped files, whose one large list is
read by many tasks (:func:`read_enveloped`). Schemas are explicit and
malformed input stops the run (``FAILFAST``) unless the caller asks for the
malformed lines (:func:`scan_documents`). The
polymorphic ``properties`` bag is kept as raw JSON text so that ``{}``,
``{"class": null}`` and ``null`` stay distinguishable (T1), and decoded
per category with :func:`decode_variant`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.session import ensure_checkpoint_dir
from quartermaster.sources.enveloped import enveloped_texts

#: Effect struct as read: the fields of both effect selections (``chance``
#: only exists for stimulants) plus the label field added by I6 - fields
#: missing from a document read as NULL.
EFFECT = ("struct<delay:int,value:double,type:string,skillName:string,duration:int,"
          "chance:double,krSkill:string>")

ITEM_SCHEMA = ("pos bigint, id string, name string, weight double, shortName string, "
               "image512pxLink string, "
               "category struct<name:string,parent:struct<name:string>>, properties string")

#: Member schemas of the ``properties`` union, by member name.
PROPERTY_SCHEMAS = {
    "Weapon": ("caliber string, defaultAmmo struct<name:string>, fireModes array<string>, "
               "fireRate int, defaultErgonomics int, defaultRecoilVertical int, "
               "defaultRecoilHorizontal int"),
    "Melee": "slashDamage int, stabDamage int, hitRadius double",
    "Grenade": ("type string, fuse double, minExplosionDistance double, "
                "maxExplosionDistance double, fragments int, contusionRadius double"),
    "Helmet": "durability int, class int, headZones array<string>, ricochetY double",
    "Armor": "durability int, class int, zones array<string>",
    "ChestRig": "class int, zones array<string>, capacity int",
    "Backpack": "grids array<struct<width:int,height:int>>, capacity int",
    "Container": "grids array<struct<width:int,height:int>>, capacity int",
    "Key": "uses int",
    "FoodDrink": f"energy int, hydration int, stimEffects array<{EFFECT}>",
    "MedKit": "cures array<string>, useTime int, hitpoints int",
    "MedicalItem": "cures array<string>, useTime int, uses int",
    "Painkiller": ("cures array<string>, uses int, useTime int, energyImpact int, "
                   "hydrationImpact int, painkillerDuration int"),
    "Stim": f"stimEffects array<{EFFECT}>",
    "Ammo": ("damage int, penetrationPower int, armorDamage int, accuracyModifier double, "
             "recoilModifier double, lightBleedModifier double, heavyBleedModifier double"),
    "Glasses": "class int, durability int, blindnessProtection double",
}

#: Union of all members (field types agree across members), used when one
#: routed subset mixes members (medical: MedKit / MedicalItem / Painkiller / Stim).
MEDICAL_SCHEMA = ("cures array<string>, useTime int, uses int, hitpoints int, energyImpact int, "
                  f"hydrationImpact int, painkillerDuration int, stimEffects array<{EFFECT}>")

MAP_SCHEMA = "pos bigint, name string, locks array<struct<key:struct<name:string>>>"

STATION_SCHEMA = (
    "pos bigint, id string, name string, imageLink string, "
    "levels array<struct<id:string, level:int, constructionTime:int, "
    "itemRequirements:array<struct<id:string, item:struct<name:string, image512pxLink:string>, "
    "quantity:int, count:int>>, "
    "skillRequirements:array<struct<id:string, name:string, level:int, "
    "skill:struct<id:string, name:string>>>, "
    "traderRequirements:array<struct<id:string, requirementType:string, value:int, "
    "trader:struct<name:string, imageLink:string>, compareMethod:string>>, "
    "stationLevelRequirements:array<struct<id:string, level:int, "
    "station:struct<name:string, imageLink:string>>>, "
    "bonuses:array<struct<type:string, name:string, value:double, skillName:string>>>>, "
    "crafts array<struct<id:string, station:struct<id:string>, level:int, "
    "rewardItems:array<struct<item:struct<name:string>>>>>")

QUEST_SCHEMA = (
    "pos bigint, id string, name string, trader struct<name:string>, "
    "taskRequirements array<struct<task:struct<id:string, name:string>>>, "
    "objectives array<struct<id:string, type:string, "
    "questItem:struct<id:string, name:string, shortName:string, description:string>, count:int>>")

QUEST_ITEM_SCHEMA = "pos bigint, id string, name string, image512pxLink string"


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A1-A5: one row per entity from JSON lines (splittable: many tasks per
    file). Nothing is inferred; a malformed line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def scan_documents(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """A1-A5 for files that may hold broken lines: ``(documents, malformed)``,
    the latter as ``(file, line)`` with the line's text. The lines are read
    once, into a copy under the shared checkpoint folder that both results
    come from, so that they always add up; count ``malformed`` before the
    documents are used, or keep it for repair. Blank lines are neither."""
    bad = "__malformed"
    rows = (spark.read.schema(f"{schema}, {bad} string").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", bad).json(path).withColumn("__file", F.col("_metadata.file_path")))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scanned-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    staged = spark.read.schema(rows.schema).parquet(folder)
    return (staged.filter(F.col(bad).isNull()).drop(bad, "__file"),
            staged.filter(F.col(bad).isNotNull()).select(F.col("__file").alias("file"), F.col(bad).alias("line")))


def read_enveloped(spark: SparkSession, path: str, root: str, entity_schema: str) -> DataFrame:
    """A1 / A2 for the enveloped form ``{"data": {root: [...]}}``: the list's
    elements with their positions as ``pos``. A file of any size is read in
    byte ranges (:mod:`quartermaster.sources.enveloped`)."""
    fields = ", ".join(f.strip() for f in _split_top(entity_schema) if not f.strip().startswith("pos "))
    rows = enveloped_texts(spark, path, ("data", root))
    return rows.select(F.col("pos").cast("bigint").alias("pos"), F.from_json("text", fields, {"mode": "FAILFAST"}).alias("e")).select("pos", "e.*")


def _split_top(schema: str) -> list[str]:
    out, depth, cur = [], 0, ""
    for ch in schema:
        if ch == "<":
            depth += 1
        elif ch == ">":
            depth -= 1
        if ch == "," and depth == 0:
            out.append(cur)
            cur = ""
        else:
            cur += ch
    if cur.strip():
        out.append(cur)
    return out


def decode_variant(raw: str | Column, member_schema: str) -> Column:
    """Decode the raw ``properties`` JSON with one member's schema.
    ``null`` / NULL decode to NULL; ``{}`` decodes to a struct of NULLs. A bag
    that is no JSON, or holds a value of another type than the schema's,
    fails the job (FAILFAST): its attributes must not vanish silently."""
    c = F.col(raw) if isinstance(raw, str) else raw
    return F.from_json(F.nullif(F.trim(c), F.lit("null")), member_schema, {"mode": "FAILFAST"})


def narrow(df: DataFrame, fields: list[str]) -> DataFrame:
    """The same documents with a subset of the fields (the reader's
    schema prunes the rest at parse time when given the narrow schema)."""
    return df.select(*fields)
