"""Connected components of an edge table, as repeated joins.

Alternating large-star and small-star rounds: every round replaces the edges
by edges to the smallest neighbour, until each node points at the smallest id
of its component. Only counts and one checksum reach the driver. Each round is
written to the shared folder, so the plan does not grow. The minima are
rebalanced after their aggregate: both sides of a join are then bare shuffles,
and adaptive execution can split the partition of a hub node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save


def _minima(edges: DataFrame) -> DataFrame:
    """Smallest neighbour (or the node itself) of every left end."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m")).hint("rebalance")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_minima(both), F.col("u") == F.col("n")).where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    joined = edges.join(_minima(edges), F.col("u") == F.col("n"))
    ends = joined.select(
        F.explode(
            F.array(
                F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            )
        ).alias("e")
    ).select("e.u", "e.v")
    return ends.where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))
    ).first()
    return tuple(r)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``node``, ``component``) for every node of ``edges`` (two long columns);
    ``component`` is the smallest node reachable. Loops and repeated edges are
    ignored; nodes without an edge do not appear; nulls are dropped."""
    cur = save(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
        .distinct(),
        "cc",
    )
    state = _state(cur)
    while state[0]:
        nxt = save(_small_star(_large_star(cur)), "cc")
        new = _state(nxt)
        cur, done, state = nxt, new == state, new
        if done:
            break
    nodes = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(cur.select("v", "v").distinct())
