"""Connected components of a graph given as an edge table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendrisk.llm.scratch import discard, written

#: Rows of a stored table's part, on average, so that a few links don't lie in as many parts as Spark shuffles them to.
PART_ROWS = 1 << 14


def _toward_least(edges: DataFrame, up: bool, parts: int) -> tuple[DataFrame, DataFrame]:
    """Link each node's neighbours (the larger ones if ``up``, else the smaller ones and itself) to the least of them.

    A hub's neighbours are met by a combined minimum and a join, never gathered in one task. Returns the links and the stored
    minima (in ``parts`` parts at most) that they are read from.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if up:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = written(both.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts))  # stored, so that the join can split a hub
    joined = both.join(least, "u")
    if up:
        linked = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.least("u", "m").alias("b"))
    else:
        linked = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return linked.where(F.col("a") != F.col("b")).distinct(), least


def _open(links: DataFrame) -> tuple[int, int]:
    """The number of ``links`` (a, b), and of nodes that keep them from being stars: linked twice down, or both down and from above."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("down")).unionByName(links.select(F.col("b").alias("node"), F.lit(0).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("n"), F.min("down").alias("below"))
    found = nodes.agg(F.sum("n").alias("n"), F.count_if((F.col("n") > 1) | ((F.col("n") > 0) & (F.col("below") == 0))).alias("open")).first()
    return found.n or 0, found.open


def components(edges: DataFrame, *, most_rounds: int = 60) -> DataFrame:
    """The components of undirected ``edges`` (a, b): one row (node, component) per node, component being its least node.

    Nodes may be of any orderable type. Edges with a null end or equal ends are left out. Each round stores its edges in the
    shared folder and removes those of the round before, until every component is a star around its least node. Raises if
    ``most_rounds`` don't settle the graph; they are logarithmic in its size.
    """
    links = edges.select("a", "b").where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = written(links)
    for k in range(most_rounds + 1):
        n, unsettled = _open(links)
        if not unsettled:
            break
        if k == most_rounds:
            raise RuntimeError(f"components not settled after {most_rounds} rounds")
        parts = -(-n // PART_ROWS)
        up, least_up = _toward_least(links, True, parts)
        down, least_down = _toward_least(up, False, parts)
        settled = written(down.coalesce(parts))
        discard(links, least_up, least_down)
        links = settled
    roots = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
