"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import Scratch


def _state(edges: DataFrame) -> tuple:
    """Rows and a hash of a set of edges: equal when nothing changed."""
    row = edges.agg(
        F.count("*"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the smallest one."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, point to the smallest."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = (edges.join(least, "u")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return (moved.union(least.select("u", F.col("m").alias("v")))
            .where("u != v").distinct())


def connected_components(edges: DataFrame, scratch: Scratch, label: str,
                         most_rounds: int = 100) -> DataFrame:
    """(node, component) of every node that has an edge to another.

    ``edges`` has two columns of ids of one ordered type. A component is named
    by its smallest node. Loops and NULL ends are ignored, repeated edges and
    either direction count once; no edges give no rows.

    Each round is two joins of edges with one minimum a node. Neighbour lists
    are never gathered, so a node may have any number of them. Rounds are
    staged in the shared folder; the result stays there under ``label``.
    """
    a, b = (F.col(f"`{c}`") for c in edges.columns)
    pairs = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"),
                          a.isNotNull().alias("_a"), b.isNotNull().alias("_b"))
             .where("_a and _b and u != v").select("u", "v").distinct())
    current = scratch.stage(pairs, f"{label}-0")
    before, name = _state(current), f"{label}-0"
    for turn in range(1, most_rounds + 1):
        if before[0] == 0:
            break
        large = scratch.stage(_large_star(current), f"{label}-large")
        current = scratch.stage(_small_star(large), f"{label}-{turn}")
        scratch.release(name, f"{label}-large")
        name, after = f"{label}-{turn}", _state(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components unsettled after {most_rounds} rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
