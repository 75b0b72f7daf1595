"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.session import written


def components(links: DataFrame) -> DataFrame:
    """``v, label`` for each vertex of ``links`` (``a, b``): the least vertex of its component.

    Edges lead from the larger to the smaller end. A round moves the smaller end of each edge to that one's least neighbour, then ties all
    smaller neighbours of a vertex to the least; rounds grow with the logarithm of the longest way, and a round that moves nothing is
    the last. Minima are taken before joins, so a vertex with very many links is one row per task there. Edges are written between rounds.
    """
    moved = F.lit(False).alias("moved")
    edges = written(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().select("a", "b", moved), "edges")
    while True:
        least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), "m")
        large = edges.select("a", "b").join(least, "b", "left")
        large = written(large.select("a", F.coalesce("m", "b").alias("b"), F.col("m").isNotNull().alias("moved")), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.select("a", "b").join(least, "a")
        apart = F.col("b") != F.col("m")
        ends = F.array(F.struct("a", F.col("m").alias("b"), apart.alias("moved")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"), apart.alias("moved")))
        small = tied.select(F.explode(ends).alias("e")).select("e.*").where("a != b")
        edges = written(small.groupBy("a", "b").agg(F.max("moved").alias("moved")), "edges")
        if not large.where("moved").select("a").unionAll(edges.where("moved").select("a")).take(1):
            break
    roots = edges.select(F.col("b").alias("v")).distinct()
    return edges.select(F.col("a").alias("v"), F.col("b").alias("label")).unionAll(roots.select("v", F.col("v").alias("label")))
