"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetide.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``a, b`` (longs).

    Large and small stars in turn: each node's neighbours move to the smallest of them. A
    node's smallest neighbour comes from a partial aggregate and is joined back, so a node
    that most others link to is not gathered. Each turn is written to the shared folder. The turns
    end once all links are stars, which one aggregate over the nodes shows.
    """
    edges = written(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    while not _are_stars(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = _star(both, larger=True)
        edges = written(_star(edges, larger=False), "links")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node links to one smaller node at most, and to none if another links to it."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.filter("up + down > 1").count() == 0


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Links ``a > b`` from the neighbours of each node to the smallest of them and itself."""
    smallest = edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = edges.join(smallest, "a")
    if larger:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            smallest.select("a", F.col("m").alias("b"))
        )
    return moved.filter("a <> b").distinct()
