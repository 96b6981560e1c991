"""Quest jobs: the loaded quest table (P26) and quest items as a second feed
of the loot table (P27, B6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermaster.functions import vocab as V
from quartermaster.functions.scalars import falsy_to_null, json_text
from quartermaster.operators.merge import merge, with_load_time


def quest_rows(quests: DataFrame) -> DataFrame:
    """Trader name (empty text is NULL), requirement and objective
    lists as JSON text (null fields kept)."""
    return quests.select("pos", "id", "name", falsy_to_null("trader.name").alias("npc_name"),
                         json_text("taskRequirements").alias("task_requirements"),
                         json_text("objectives").alias("objectives"))


def upsert_quests(target: DataFrame, quests: DataFrame, as_of) -> DataFrame:
    src = with_load_time(quest_rows(quests), as_of)
    return merge(target, src, "id", insert_cols=["name", "npc_name", "task_requirements",
                                                 "objectives", "update_time"], order_cols="pos")


def quest_item_rows(quest_items: DataFrame) -> DataFrame:
    """Quest items as loot rows with a constant category."""
    return quest_items.select("pos", "id", F.col("name").alias("name_en"),
                              F.col("image512pxLink").alias("image"),
                              F.lit(V.QUEST_ITEM_CATEGORY).alias("category"))


def upsert_quest_items(loot: DataFrame, quest_items: DataFrame, as_of) -> DataFrame:
    """Second feeder of the loot table - its own column subset (no
    short name), so the first feed's short name and the curated local name
    survive."""
    src = with_load_time(quest_item_rows(quest_items), as_of)
    return merge(loot, src, "id", insert_cols=["name_en", "image", "category", "update_time"],
                 order_cols="pos")
