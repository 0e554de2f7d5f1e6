"""Connected components of a link table, in rounds of joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import JOIN, written


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component) for every node of an undirected link table, component being the smallest node reached.

    Alternates two star operations until every node hangs on the smallest of its component: each node hooks its
    larger neighbours, then its smaller ones, to the smallest of them. The
    number of rounds grows with the logarithm of a component's diameter. A node
    with very many links is grouped with partial minima, and its join is one
    that adaptive execution can split. Every round is a table in the shared
    folder. Self-links, repeated links and nulls are allowed; nulls and
    self-links add nothing.
    """
    edges = (
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    edges = written(edges, "links")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    while not _all_stars(edges):
        edges = written(_hooked(_hooked(edges, larger=True), larger=False), "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node has edges to larger nodes only, or one edge, to a smaller node. Edges have u > v and come once."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.filter("up > 1 or up = 1 and down = 1").isEmpty()


def _hooked(edges: DataFrame, larger: bool) -> DataFrame:
    """Hook every node's larger (or smaller) neighbours to the smallest node of its neighbourhood. Edges have u > v."""
    if larger:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).select(F.col("u").alias("w"), "m")
        hooked = edges.join(least.hint(JOIN), edges["v"] == least["w"]).select(F.col("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least.withColumnRenamed("u", "w").hint(JOIN), edges["u"] == F.col("w"))
        hooked = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return hooked.filter("u <> v").distinct()
