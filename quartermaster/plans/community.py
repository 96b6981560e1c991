"""Community jobs (P28-P33) as complete runs over versioned tables.

Each job reads the latest published version of its inputs
(:func:`read_published`), computes the new state lazily, and publishes its
outputs with one commit (:func:`publish_all`), so readers never see a
half-applied run; only :func:`statistics_and_grades_job` commits twice.
``as_of`` is the run clock (one instant per run).
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession

from quartermaster.functions import vocab as V
from quartermaster.operators import activity
from quartermaster.operators.deletes import cascade_delete, delete_where, expired, issue_board
from quartermaster.operators.index import IndexBranch, IndexEmit, publish_all, read_published, search_index
from quartermaster.operators.merge import merge
from quartermaster.operators.snapshot import apply_retention, snapshot, verify_snapshot


def _t(spark, root, name):
    return read_published(spark, root, name)


def issue_job(spark: SparkSession, root: str) -> dict[str, str]:
    """Demote (B9), drop orphans (B10), promote (B3), in that order."""
    out = issue_board(_t(spark, root, "board_issue"), _t(spark, root, "board_union"),
                      like_bound=V.LIKE_BOUND)
    return publish_all({"board_issue": out}, root)


def statistics_and_grades_job(spark: SparkSession, root: str) -> dict[str, str]:
    """P29 then P30: statistics upserted (duplicates are an error) and
    published; then the users are graded from the published statistics, so
    they are computed once. Two commits: a failure in between leaves the new
    statistics with the old grades until the job runs again."""
    users = _t(spark, root, "user")
    src = activity.user_post_statistics(users, _t(spark, root, "board_union"), _t(spark, root, "comments"))
    stats = merge(_t(spark, root, "user_post_statistics"), src, "user_email",
                  insert_cols=["post_count", "comment_count"], duplicates="error")
    done = publish_all({"user_post_statistics": stats}, root)
    graded = activity.update_user_grade(users, _t(spark, root, "user_post_statistics"), _t(spark, root, "user_grade"))
    return done | publish_all({"user": graded}, root)


def expire(frames: dict[str, DataFrame], as_of) -> dict[str, DataFrame]:
    """P31 on frames: expired bans (B8), then expired accounts with their
    icons and quests (B11), all at one instant."""
    cas = cascade_delete(frames["user_delete"], "email", "delete_end_time", as_of,
                         {"user_icon": (frames["user_icon"], "user_email"),
                          "user_quest": (frames["user_quest"], "user_email")})
    return {"user_ban": delete_where(frames["user_ban"], expired("ban_end_time", as_of)),
            "user_delete": cas["parent"], "user_icon": cas["user_icon"], "user_quest": cas["user_quest"]}


def expiry_job(spark: SparkSession, root: str, as_of) -> dict[str, str]:
    """:func:`expire` on the published tables, one commit."""
    frames = {t: _t(spark, root, t) for t in ("user_ban", "user_delete", "user_icon", "user_quest")}
    return publish_all(expire(frames, as_of), root)


#: FIXED VALUES: the search index's branches in union order:
#: (table, [(label prefix, name column)], link path, type, link carries the id)
INDEX_SPEC = [
    ("map_parent", [("타르코프 지도 : ", "name_kr")], "/map-of-tarkov/", "MAP_OF_TARKOV", True),
    ("map_parent", [("대화형 지도 : ", "name_kr")], "/map/", "MAP", True),
    ("boss", [("보스 : ", "name_kr")], "/boss/", "BOSS", True),
    ("hideout_master", [("하이드아웃 : ", "name_en"), ("하이드아웃 : ", "name_kr")], "/hideout", "HIDEOUT", False),
    ("quest", [("퀘스트 : ", "name_kr"), ("퀘스트 : ", "name_en")], "/quest/detail/", "QUEST", True),
    ("npc", [("상인 : ", "name_kr")], "/quest", "TRADER", False),
    ("weapon", [("무기 : ", "name")], "/weapon?id=", "WEAPON", True),
    ("throwable", [("무기 : ", "name")], "/weapon?id=", "WEAPON", True),
    ("knife", [("무기 : ", "name")], "/weapon?id=", "WEAPON", True),
    ("ammo", [("탄약 : ", "name")], "/ammo?id=", "AMMO", True),
    ("headwear", [("방탄모 : ", "name")], "/head-wear?id=", "HEADWEAR", True),
    ("rig", [("전술 조끼 : ", "name")], "/rig?id=", "RIG", True),
    ("armor_vest", [("방탄 조끼 : ", "name")], "/armor-vest?id=", "ARMOR_VEST", True),
    ("headset", [("헤드셋 : ", "name")], "/headset?id=", "HEADSET", True),
    ("backpack", [("가방 : ", "name")], "/backpack?id=", "BACKPACK", True),
    ("medical", [("의료품 : ", "name_kr")], "/medical?id=", "MEDICAL", True),
    ("container", [("컨테이너 : ", "name_kr")], "/container?id=", "CONTAINER", True),
    ("key", [("키 : ", "name")], "/key?id=", "KEY", True),
    ("provisions", [("식량 : ", "name_kr")], "/provisions?id=", "PROVISIONS", True),
    ("loot", [("전리품 : ", "name_kr")], "/loot?id=", "LOOT", True),
    ("face_cover", [("얼굴 커버 : ", "name")], "/face-cover?id=", "FACE_COVER", True),
    ("arm_band", [("완장 : ", "name")], "/arm-band?id=", "ARM_BAND", True),
    ("glasses", [("안경 : ", "name")], "/glasses?id=", "GLASSES", True),
]


def index_branches(table: Callable[[str], DataFrame]) -> list[IndexBranch]:
    """U1-U5 over the tables that ``table`` returns by name. Neighbouring
    spec rows of one table (U3: the map list under two paths) are one branch
    with several emits, so the table is read once."""
    out = []
    for name, rows in groupby(INDEX_SPEC, key=lambda r: r[0]):
        out.append(IndexBranch(table(name), [IndexEmit(prefix, col, path, typ, with_id)
                                             for _, variants, path, typ, with_id in rows for prefix, col in variants]))
    return out


def search_index_job(spark: SparkSession, root: str) -> dict[str, str]:
    """Rebuild the index (U1, W2) and switch versions."""
    return publish_all({"search": search_index(index_branches(lambda name: _t(spark, root, name)))}, root)


#: Days for which dated snapshots are kept
KEEP_DAYS = 3


def snapshot_job(spark: SparkSession, root: str, snap_root: str, tables: list[str], as_of,
                 keep_days: int = KEEP_DAYS) -> bool:
    """Dated snapshot of every table (B13); when all of them hold the
    rows of their sources, older ones beyond ``keep_days`` go (B14).
    False (and nothing removed) when the gate fails."""
    frames = {t: _t(spark, root, t) for t in tables}
    snapshot(frames, snap_root, as_of)
    if not all(verify_snapshot(spark, snap_root, t, frames[t], as_of) for t in tables):
        return False
    for t in tables:
        apply_retention(spark, snap_root, t, keep_days, as_of)
    return True
