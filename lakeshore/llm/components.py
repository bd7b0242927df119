"""Connected components of a link table, as joins and minimum aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, dealt_anew, released


def _are_stars(edges: DataFrame) -> bool:
    """Whether each larger end has one link and is no other's smaller end: then the smaller ends are the components' smallest nodes."""
    end = lambda node, upper: F.struct(F.col(node).alias("node"), F.lit(upper).alias("upper"))
    ends = edges.select(F.explode(F.array(end("u", 1), end("v", 0))).alias("e")).select("e.*")
    open_ = ends.groupBy("node").agg(F.sum("upper").alias("n"), F.min("upper").alias("least")).where("n > 1 or n = 1 and least = 0")
    return not open_.agg(F.count("*")).first()[0]


def connected(links: DataFrame) -> DataFrame:
    """links(u, v) -> (u, v): every node u of a component that isn't its smallest node, with that smallest node v.

    Alternates two rewrites of the links until they are stars: each node hands its larger neighbours to its smallest
    neighbour, then its smaller ones. The rounds grow with the logarithm of the longest path. A node with many
    links is a minimum aggregate (combined before the shuffle) and a join that adaptive execution can split.
    Loops and repeated links do no harm; an empty table gives an empty table.
    """
    edges = checkpointed(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    while not _are_stars(edges):
        # Sorted merges: the driver then holds no broadcast of each round.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = dealt_anew(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "u").hint("merge")
        handed = both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        smallest = handed.groupBy("u").agg(F.min("v").alias("m"))
        on = handed.join(dealt_anew(smallest, "u").hint("merge"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = checkpointed(on.unionByName(smallest.withColumnRenamed("m", "v")).distinct())
        released(edges.sparkSession)
    return edges
