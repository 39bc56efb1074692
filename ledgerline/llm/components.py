"""Connected components of a graph that is only ever held in Spark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges``; component is the least node reachable.

    Alternates "large star" and "small star" steps: each node's larger, then
    smaller, neighbours are linked to the least node of its neighbourhood,
    until nothing changes. That takes a number of rounds logarithmic in the
    diameter, and never builds a neighbourhood: minima are partial aggregates,
    and the join that hands them out can be split by key (adaptive skew join),
    so a node with a third of all links is not one task's work. Each round's
    edges are written to the shared folder, which cuts the lineage.

    Null ends, loops and repeated links are ignored; a node that occurs only in
    loops is returned as its own component.
    """
    # Read three times below, so whatever makes the links is run once.
    pairs = stored(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).dropna(), "pairs")
    loops = pairs.where("u = v").select("u").distinct()
    now = stored(_star(_both(pairs.where("u <> v")), large=True), "links")
    last = _state(now)
    for _ in range(max_rounds):
        now = stored(_star(now.select("u", "v"), large=False), "links")
        now = stored(_star(_both(now), large=True), "links")
        state = _state(now)
        if state == last:
            break
        last = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = members.select(F.col("component").alias("node"), "component").distinct()
    alone = loops.select(F.col("u").alias("node"), F.col("u").alias("component"))
    return members.unionByName(roots).unionByName(alone).groupBy("node").agg(F.min("component").alias("component"))


def _both(pairs: DataFrame) -> DataFrame:
    return pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Link each u's neighbours v to the least of u and its neighbours: for large, those with v > u, else those with v < u and u itself.

    Links are kept as (u, v) with u > v.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = pairs.join(least, "u")
    if large:
        out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").distinct()


def _state(pairs: DataFrame) -> tuple:
    """A digest of the links: equal digests mean that a round changed nothing."""
    row = pairs.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]
