"""Connected components of a link table, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermaster.llm.common import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, a: str, b: str, most_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node that has a link to another one;
    ``component`` is the smallest node reachable.

    Alternating large-star and small-star steps: every step replaces the
    links of a node by links to the smallest neighbour, found by a map-side
    combined ``min``, so a node with millions of links never meets in one
    group; the minima are written before the join that hands them back, so that
    it reads two plain shuffles and Spark can split a skewed partition. The links after a round are at most as
    many as before it. Rounds end when nothing changes (about the logarithm
    of the longest path); each one is checkpointed. Self links and NULL ends
    are ignored, repeated links count once, an empty table gives an empty one.
    """
    u, v = F.col(a), F.col(b)
    edges = materialize(links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
                        .filter(u.isNotNull() & v.isNotNull() & (u != v)).distinct())
    state = _state(edges)
    for _ in range(most_rounds):
        if not state[0]:
            break
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = materialize(both.filter("v > u").join(low, "u")
                            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (large.join(low, "u").filter("v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low).distinct())
        edges = materialize(small)
        last, state = state, _state(edges)
        if state == last:
            break
    else:
        raise RuntimeError(f"links did not settle in {most_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
