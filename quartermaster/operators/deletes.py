"""Deletes as filters and anti/semi joins (B8-B11), NULL-exact.

SQL ``DELETE`` keeps every row for which the predicate is not TRUE - NULL
included. The functions return the table *after* the delete (the kept
rows); ``deleted_*`` variants return the removed rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermaster.functions.predicates import at_least, below
from quartermaster.functions.scalars import as_of_lit
from quartermaster.session import materialize


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """B8 (T4): ``DELETE ... WHERE cond`` keeps rows whose ``cond`` is FALSE
    *or NULL* - never ``filter(~cond)``, which drops the NULL rows too."""
    return df.filter(~F.coalesce(cond, F.lit(False)))


def deleted_where(df: DataFrame, cond: Column) -> DataFrame:
    return df.filter(F.coalesce(cond, F.lit(False)))


def expired(ts_col: str, as_of) -> Column:
    """``ts < as_of`` against the run clock (one instant per run, T9)."""
    return F.col(ts_col) < as_of_lit(as_of)


def _on(df: DataFrame, keys: DataFrame, on, key_on):
    left = _keys(on)
    right = _keys(key_on) if key_on is not None else left
    k = keys.select(*[F.col(r).alias(f"__k{i}") for i, r in enumerate(right)])
    cond = None
    for i, l in enumerate(left):
        c = df[l] == k[f"__k{i}"]
        cond = c if cond is None else cond & c
    return k, cond


def delete_in(df: DataFrame, keys: DataFrame, on: str | Sequence[str],
              key_on: str | Sequence[str] | None = None) -> DataFrame:
    """B9 / D6 (T5): ``DELETE ... WHERE k IN (SELECT ...)``. A row whose key
    is NULL is never IN anything, so it is kept: a plain ``left_anti`` join
    (not ``NOT IN``, whose null-aware plan is a broadcast nested loop)."""
    k, cond = _on(df, keys, on, key_on)
    return df.join(k, cond, "left_anti")


def delete_not_exists(df: DataFrame, parent: DataFrame, on: str | Sequence[str],
                      key_on: str | Sequence[str] | None = None) -> DataFrame:
    """B10 / D7 (T5): ``DELETE ... WHERE NOT EXISTS (parent row)``. Kept rows
    are those *with* a parent: a ``left_semi`` join, which also removes rows
    whose key is NULL (they have no parent)."""
    k, cond = _on(df, parent, on, key_on)
    return df.join(k, cond, "left_semi")


def cascade_delete(parent: DataFrame, key: str, expiry_col: str, as_of,
                   children: dict[str, tuple[DataFrame, str]]) -> dict[str, DataFrame]:
    """Expired parents remove their children, then themselves.

    ``children`` maps a name to ``(child_df, child_key_col)``. The expired
    key set is computed once from one ``as_of`` (the reference's single
    transaction instant) and shared by every child; the caller publishes the
    returned tables together (:func:`quartermaster.operators.index.publish_all`).
    Returns ``{"parent": kept_parents, name: kept_children, ...}``.
    """
    cond = expired(expiry_col, as_of)
    # written once: every child reads the same set, whatever happens to the parents meanwhile
    gone = materialize(deleted_where(parent, cond).select(F.col(key).alias("__gone")).distinct())
    out = {"parent": delete_where(parent, cond)}
    for name, (child, ck) in children.items():
        out[name] = delete_in(child, gone, ck, "__gone")
    return out


def issue_board(issues: DataFrame, boards: DataFrame, like_bound: int = 10,
                board_key: str = "board_id", board_id: str = "id",
                likes: str = "like_count", insert_map: dict[str, str] | None = None) -> DataFrame:
    """The issue table after, in order, (B9) removing issues whose post
    fell below ``like_bound`` likes, (B10) removing issues whose post is gone,
    and (B3) upserting posts with at least ``like_bound`` likes.

    A NULL like count satisfies neither threshold (C6): such a post is
    neither demoted nor promoted. A post that is to be promoted twice, or
    without id, fails the job.

    One pass: posts are reduced to one row per id (a partial + final
    aggregate), and one left join with the issues classifies everything.
    Issues without a post, NULL ids among them, match no post and are gone;
    the rest of an id's fate hangs on its post alone.
    """
    insert_map = insert_map or {"board_type": "type", "create_time": "create_time"}
    promoted = F.coalesce(at_least(likes, like_bound), F.lit(False))
    row = F.struct(*[F.col(src).alias(f"__new_{dst}") for dst, src in insert_map.items()])
    posts = (boards.filter(F.col(board_id).isNotNull() | promoted)
             .groupBy(F.col(board_id).alias("__post"))
             .agg(F.count_if(promoted).alias("__promoted"), F.count_if(below(likes, like_bound)).alias("__demoted"),
                  F.first(F.when(promoted, row), ignorenulls=True).alias("__row")))
    wrong = (F.col("__promoted") > 1) | F.col("__post").isNull()
    text = F.concat(F.lit("duplicate or NULL key in source: "), F.to_json(F.struct("__post")))
    posts = posts.select("__post", F.col("__demoted") > 0, "__row",
                         F.when(wrong, F.raise_error(text).cast("boolean")).otherwise(F.col("__promoted") > 0).alias("__up")
                         ).toDF("__post", "__down", "__row", "__up")
    old = issues.withColumn("__there", F.lit(True))
    both = posts.join(old, F.col("__post") == F.col(board_key), "left")
    stays = F.col("__there") & ~F.col("__down")  # NULL where there is no issue
    out = []
    for c in issues.columns:
        kind = issues.schema[c].dataType
        if c == board_key:
            value = F.col("__post").cast(kind)
        elif c in insert_map:
            value = F.when(F.col("__up"), F.col("__row")[f"__new_{c}"].cast(kind)).otherwise(F.col(c))
        else:
            value = F.when(stays, F.col(c))
        out.append(value.alias(c))
    return both.filter(F.col("__up") | F.coalesce(stays, F.lit(False))).select(*out)
