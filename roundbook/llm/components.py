"""Connected components of an edge table (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v: long) to (u, v): every node that is not the smallest of
    its component, with that smallest node.

    A round is two joins against a per-node minimum (pre-aggregated before its
    shuffle), so a node with very many neighbours is split like any skewed join
    side. The number of rounds grows with the logarithm of the number of nodes;
    each is written in the shared folder. Repeated edges and loops are fine; no
    edges give no rows.
    """
    now = written(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = written(_small_star(written(_large_star(now), "stars")), "edges")
        state, before = _state(now), state
        if state == before:
            break
    return now
