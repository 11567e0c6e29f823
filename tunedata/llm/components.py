"""Connected components of a graph given by its edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunedata.llm.common import discard, materialize


def _largest_first(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    larger = both.filter(F.col("b") > F.col("a")).join(least, F.col("a") == F.col("n"))
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
    smaller = edges.join(least, F.col("a") == F.col("n")).filter(F.col("b") != F.col("m"))
    return smaller.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select(F.col("n").alias("a"), F.col("m").alias("b"))
    )


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: numbers): root is the smallest one reachable.

    Each round reduces by partial aggregates and joins, writes its edges, which only become fewer
    or smaller, and stops when nothing changes. Rounds grow with the logarithm of the longest path.
    """
    spark = edges.sparkSession
    own = _largest_first(edges.filter(F.col("a") != F.col("b")))
    current, path = materialize(own, name)
    mark = None
    while True:
        seen = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == seen or not seen[0]:
            break
        mark = seen
        following, other = materialize(
            _largest_first(_small_star(_largest_first(_large_star(current)))), name
        )
        discard(spark, path)
        current, path = following, other
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
