"""Plan shape at sf0.1: what each job should (not) contain."""

import contextlib
import io
import os

import pytest

from quartermaster.plans import catalog as E, catalog_files, catalog_jobs  # noqa: F401

SF = "/root/testdata/sf0.1"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="provided tables missing")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_theta_join_is_broadcast(spark):
    p = plan(E.QUERIES["user_grade"](spark, SF))
    assert "BroadcastNestedLoopJoin" in p


def test_statistics_partial_aggregation_and_pruning(spark):
    p = plan(E.QUERIES["user_post_statistics"](spark, SF))
    assert "partial_count" in p
    # lineitem is read with only the columns the job needs
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_returnflag:string,l_linestatus:string>" in p


def test_windows_push_filters(spark):
    p = plan(E.QUERIES["interval_window"](spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p


def test_index_numbering_has_no_single_partition_data_exchange(spark):
    df = E.QUERIES["search_index"](spark, SF)
    p = plan(df)
    # the only single-partition exchange allowed is over the per-partition counts
    assert p.count("SinglePartition") <= 1
    assert "rangepartitioning" in p.lower() or "Scan ExistingRDD" in p or "LogicalRDD" in p


#: checks whose plan may hold a single-partition exchange, and over what
SINGLE_PARTITION_OK = {
    "search_index": "prefix sums over one row per range partition (W2)",
    "search_index_job": "prefix sums over one row per range partition (W2)",
    "user_grade": "interval bounds over the bounded threshold table",
    "grade_max_by": "interval bounds over the bounded threshold table",
    "threshold_times": "interval bounds over the bounded threshold table",
    "user_grade_sweep": "carry over one row per range partition",
    "threshold_times_sweep": "carry over one row per range partition",
}


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_no_cartesian_no_python_no_single_partition_over_data(spark, name):
    p = plan(E.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    if name not in SINGLE_PARTITION_OK:
        assert "SinglePartition" not in p, name


def test_merge_dedups_map_side(spark):
    p = plan(E.QUERIES["merge_last_wins"](spark, SF))
    assert "partial_max_by" in p


def test_zoned_window_pushes_both_bounds(spark):
    p = plan(E.QUERIES["zoned_window"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-04T15:00" in p and "LessThan(ts,2024-01-11T15:00" in p


def test_composite_merge_joins_on_all_key_columns(spark):
    text = E.QUERIES["merge_composite"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in text.splitlines() if "Join [" in x]
    # the key's hash and both columns
    assert joins and all(x.split("Join ", 1)[1].split("]")[0].count("#") == 3 for x in joins)


@pytest.mark.parametrize("name,sides", [("merge_last_wins", 2), ("merge_composite", 2), ("merge_partial_columns", 2),
                                        ("merge_insert_only", 2), ("issue_upsert", 4), ("issue_board", 3), ("two_feeders", 2)])
def test_merges_read_and_shuffle_each_side_once(spark, name, sides):
    """One scan per input (the issues of the checks are a union of three, of
    which the board's left join needs two) and one exchange per side of a join."""
    p = plan(E.QUERIES[name](spark, SF)).split("\n\n(1) ")[0]
    assert p.count("Scan parquet") == sides, p
    joins = p.count("Join")
    assert p.count("Exchange") <= 2 * joins, p


def test_all_station_targets_come_from_one_parse(spark):
    from quartermaster.plans import stations as S
    p = plan(S.tagged_rows(E.station_docs(spark, SF)))
    assert p.count("- Generate (") == 1 and p.count("- Scan parquet") == 1, p
    assert p.split("(1) ")[1].count("from_json") == 1, p


def test_a_single_target_is_not_staged(spark):
    for name in ("stations_master", "catalogue_knife"):
        assert "/part.parquet" in plan(E.QUERIES[name](spark, SF)) or "/orders.parquet" in plan(E.QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", [n for n in sorted(E.QUERIES) if n.startswith("catalogue_") and n != "catalogue_narrow"])
def test_a_bag_is_parsed_once(spark, name):
    """Rules read the bag's text; only the one target that takes a row decodes
    it. (Documents are decoded too: their schemas begin with ``pos``, but for
    the maps of the keys, of which only the locks are read.)"""
    import re
    p = plan(E.QUERIES[name](spark, SF))
    assert "json_object_keys" not in p
    assert len(re.findall(r"from_json\(StructField\((?!pos,)", p)) <= 1 + (name == "catalogue_keys"), p
