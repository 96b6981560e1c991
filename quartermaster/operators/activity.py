"""Community activity: statistics per user (P29) and threshold grading.

Inputs are ordinary tables; column names are parameters whose defaults are
the community schema (users.email, boards.id/writer, comments.board_id/
user_email/is_delete_by_user/is_delete_by_admin, user.attendance_count,
grades.id/score).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermaster.functions.predicates import is_false
from quartermaster.functions.scalars import weighted_sum
from quartermaster.operators.joins import threshold_lookup

#: Score weights of the grading rule: attendance, posts, boards commented on.
SCORE_WEIGHTS = (5, 10, 5)


def post_counts(boards: DataFrame, writer: str = "writer") -> DataFrame:
    """Posts per writer. Counted before anything is joined: each map task
    sends one row per writer, so a prolific writer never meets in one task.
    Writers that are no users drop out of the left join that starts from the
    users (D5)."""
    return (boards.select(F.col(writer).alias("__e")).filter(F.col("__e").isNotNull())
            .groupBy("__e").agg(F.count(F.lit(1)).alias("total_posts")))


def comment_counts(boards: DataFrame, comments: DataFrame,
                   board_id: str = "id", c_board: str = "board_id", c_user: str = "user_email",
                   deleted_flags=("is_delete_by_user", "is_delete_by_admin")) -> DataFrame:
    """D3 + C8 + E2 (T19): number of *distinct existing boards* each user
    commented on, counting only comments whose delete flags are FALSE
    (NULL flags are excluded, as ``flag = FALSE`` does).

    Flags are filtered before anything else; comments are reduced to
    distinct (user, board) pairs - on the map side first, and dealt out by
    both columns - before they meet the boards, so neither a popular board
    nor a busy user is one group. The join to boards only tests existence
    (semi join): ``COUNT(DISTINCT board.id)`` over an inner join equals the
    count of distinct pairs that have a board. The final count is again
    combined on the map side.
    """
    c = comments
    for flag in deleted_flags:
        c = c.filter(is_false(flag))
    pairs = c.select(F.col(c_user).alias("__e"), F.col(c_board).alias("__b")).dropna().distinct()
    existing = pairs.join(boards.select(F.col(board_id).alias("__b")), "__b", "left_semi")
    return existing.groupBy("__e").agg(F.count(F.lit(1)).alias("total_comments"))


def user_post_statistics(users: DataFrame, boards: DataFrame, comments: DataFrame,
                         email: str = "email", **names) -> DataFrame:
    """P29 source rows: ``(user_email, post_count, comment_count)`` for every
    user, zero-filled (D2 + E3). Users repeated in ``users`` repeat here,
    which the set-based upsert then rejects (B3)."""
    p = post_counts(boards, writer=names.get("writer", "writer"))
    c = comment_counts(boards, comments,
                       board_id=names.get("board_id", "id"),
                       c_board=names.get("c_board", "board_id"),
                       c_user=names.get("c_user", "user_email"),
                       deleted_flags=names.get("deleted_flags",
                                               ("is_delete_by_user", "is_delete_by_admin")))
    e = users.select(F.col(email).alias("__e"))
    return (e.join(p, "__e", "left").join(c, "__e", "left")
            .select(F.col("__e").alias("user_email"),
                    F.coalesce("total_posts", F.lit(0)).cast("bigint").alias("post_count"),
                    F.coalesce("total_comments", F.lit(0)).cast("bigint").alias("comment_count")))


def total_scores(users: DataFrame, stats: DataFrame, email: str = "email",
                 attendance: str = "attendance_count",
                 weights=SCORE_WEIGHTS, keep_all: bool = False) -> DataFrame:
    """D1 + X9: ``attendance*5 + coalesce(posts,0)*10 + coalesce(boards,0)*5``.
    A NULL attendance gives a NULL score (T20). ``keep_all`` carries every
    user column (for updating the users table in the same pass)."""
    s = stats.select(F.col("user_email").alias("__e"), "post_count", "comment_count")
    cols = users.columns if keep_all else [email]
    j = users.select(*cols, F.col(email).alias("__e"), F.col(attendance).alias("__a")) \
        .join(s, "__e", "left")
    score = weighted_sum([("__a", weights[0]), ("post_count", weights[1]),
                          ("comment_count", weights[2])], [False, True, True])
    return j.select(*cols, score.cast("bigint").alias("total_score"))


def best_grades(scores: DataFrame, grades: DataFrame, grade_id: str = "id",
                grade_score: str = "score", strategy: str = "broadcast") -> DataFrame:
    """D4 + W1 / E6: the grade with the highest threshold not above the
    score (ties on the threshold: highest grade id). Users with a NULL score
    or a score below every threshold get a NULL grade."""
    return threshold_lookup(scores, "total_score", grades, grade_score,
                            payload=[grade_id], tie_cols=[grade_id], prefix="grade_", strategy=strategy) \
        .withColumnRenamed(f"grade_{grade_id}", "grade_id")


def update_user_grade(users: DataFrame, stats: DataFrame, grades: DataFrame,
                      email: str = "email", attendance: str = "attendance_count",
                      grade_col: str = "grade", **kw) -> DataFrame:
    """The users table with ``grade`` set from the best grade; users
    without a grade (NULL score, or below every threshold) keep their old
    value (B12 semantics, T20).

    The update source is derived from the users rows themselves (one score
    per row, a threshold join that keeps every row), so the new grade is set
    in the same pass - no join back to the users table."""
    scores = total_scores(users, stats, email=email, attendance=attendance, keep_all=True)
    graded = best_grades(scores, grades, **kw)
    return graded.select(*[
        F.coalesce(F.col("grade_id").cast(users.schema[grade_col].dataType), F.col(grade_col))
        .alias(grade_col) if c == grade_col else F.col(c) for c in users.columns])


def grades_max_by(scores: DataFrame, grades: DataFrame, email: str = "email",
                  grade_id: str = "id", grade_score: str = "score", strategy: str = "broadcast") -> DataFrame:
    """``max_by(grade id, (threshold, id))`` over the grades a score
    reaches - graded users only. Same route as :func:`best_grades`: at most
    one grade per user is ever produced."""
    return (best_grades(scores, grades, grade_id=grade_id, grade_score=grade_score, strategy=strategy)
            .filter(F.col("grade_id").isNotNull()).select(email, "grade_id"))
