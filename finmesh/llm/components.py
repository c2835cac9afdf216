"""Connected components of a table of links, by alternating large-star and small-star steps."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmesh.llm.common import stored


def connected(links: DataFrame) -> DataFrame:
    """(v, c) for every end of ``links`` (a, b): c is the least vertex reachable from v.

    Every step only redirects links to lesser vertices, so a hub's links are joined to one
    minimum each; steps repeat until every component is a star (about the logarithm of its longest path)."""
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("x"), "u", "m")
        edges = stored(small.where("x <> m").select(F.col("x").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))).distinct(), "links")
    return edges.select(F.col("u").alias("v"), F.col("v").alias("c")).unionByName(
        edges.select("v", F.col("v").alias("c")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Every vertex points to one other, and that one to none."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("points"), F.lit(0).alias("target")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("points"), F.lit(1).alias("target")))
    return ends.groupBy("x").agg(F.sum("points").alias("points"), F.max("target").alias("target")).where(
        "points > 1 or points > 0 and target > 0").isEmpty()


def component_of(rows: DataFrame, comp: DataFrame, vertex: str, name: str) -> DataFrame:
    """``rows`` with the component of the column ``vertex`` (itself if it has no links)."""
    return rows.join(comp.select(F.col("v").alias(vertex), F.col("c").alias(name)), vertex, "left").withColumn(name, F.coalesce(name, vertex))


def joined(comp: DataFrame, links: DataFrame) -> DataFrame:
    """The components when ``links`` come in addition: only the components they touch are worked on."""
    between = component_of(component_of(links, comp, "a", "ca"), comp, "b", "cb")
    moved = stored(connected(between.select(F.col("ca").alias("a"), F.col("cb").alias("b"))).select(
        F.col("v").alias("c"), F.col("c").alias("to")), "moved-components")
    old = comp.join(moved, "c", "left").select("v", F.coalesce("to", "c").alias("c"))
    alone = moved.select(F.col("c").alias("v"), F.col("to").alias("c")).join(comp.select("v"), "v", "left_anti")
    return old.unionByName(alone)
