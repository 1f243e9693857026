"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum and a join, so no neighbourhood is gathered in a
task; edges are written to the shared folder after each round, and a round's table
is deleted when the next one is written.  The rounds end when every node has one
parent and no parent has one.  The result is a table of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import Tables


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether each node below another has that one parent only, and no parent is below a node: then a parent is its component's smallest node."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionAll(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    per = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per.agg(F.max(F.col("up") + F.least("up", "down"))).first()[0] in (None, 1)


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for the nodes of ``links``; a component is its smallest node.

    Links of a node to itself and repeated links change nothing; without links the
    result is empty.
    """
    tables, k = Tables(links.sparkSession, "components"), 0
    edges = tables.save(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges0")
    while not _stars(edges):
        k += 1
        edges = tables.save(_small(_large(edges)), f"edges{k}")
        tables.drop(f"edges{k - 1}")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    out = tables.save(edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots), "components")
    tables.drop(f"edges{k}")
    return out


def joined_components(components: DataFrame, links: DataFrame) -> DataFrame:
    """``components`` after further ``links`` (a, b), some of whose nodes may be new.

    Only the links between components are resolved; a component that none of them
    touches keeps its rows as they are.
    """
    heads = links.select("a", "b")
    for end in ("a", "b"):
        heads = heads.join(components.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}")), end, "left")
    moved = connected_components(heads.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")))
    to = moved.select(F.col("node").alias("component"), F.col("component").alias("moved"))
    old = components.join(to, "component", "left").select("node", F.coalesce("moved", "component").alias("component"))
    return old.unionAll(moved.join(components, "node", "left_anti"))
