"""Connected components of an edge table, by large-star and small-star rounds; of a forest, by pointer doubling.

Plans are kept small, as each exchange of each round costs the driver memory: no union, and one distinct a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import told


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round: the neighbours of each node are linked to the smallest among them and itself.

    The minimum is a partial aggregate; the join back has one row a node on one
    side, so a node with very many neighbours is split by the skew join.
    """
    one, two = F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    both = edges.select(F.inline(F.array(one, two))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    out = both.join(least, "a")
    if large:
        # Each edge gives one row, so rows that repeat can wait for the small star.
        return out.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return out.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for each node of ``edges (a, b)``; component is the smallest node reachable.

    Self links and repeated edges are allowed; nodes must not be null.  Each
    round is written to shared scratch; the driver sees one row of totals.
    The first round reads ``edges`` more than once, so they should be stored.
    """
    edges = edges.select("a", "b").where("a <> b")
    before = None
    while True:
        edges, total = told(_star(_star(edges, True), False), "components", n=F.count("*"), s=F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
        now = total["n"], total["s"]
        if now == before or not now[0]:
            break
        before = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def roots(links: DataFrame) -> DataFrame:
    """``(node, component)`` for each ``b`` of ``links (a, b)``, a forest: each ``b`` has one ``a``, and it is smaller.

    The component is the root of the node's tree, its smallest node.  Links may be repeated.
    Each round doubles how far a node sees, so a tree of depth d takes about log2(d) + 1 rounds.
    """
    tree = links.select(F.col("b").alias("node"), F.col("a").alias("component")).distinct()
    while True:
        above = tree.select(F.col("node").alias("component"), F.col("component").alias("above"))
        step = tree.join(above, "component", "left").select("node", F.coalesce("above", "component").alias("component"), F.col("above").isNotNull().alias("moved"))
        step, total = told(step, "components", n=F.count_if("moved"))
        tree = step.select("node", "component")
        if not total["n"]:
            return tree
