"""Connected components by alternating large and small stars, each round a join and an aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.session import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the ends of the links (a, b): the smallest node that can be reached.

    Each round hangs the larger neighbours of every node on its smallest one, then the smaller ones, until the
    links are stars. Rounds grow with the logarithm of a component's length. A node with very many links is an
    aggregated minimum and a join, which Spark can split; every round is written to the shared folder.
    """
    spark = links.sparkSession
    edges = stage(spark, links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        # the larger neighbours of every node go to the smallest of all
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = stage(spark, large.distinct(), "large-star")
        smallest = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(smallest, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
        small = small.unionByName(smallest.select("a", F.col("least").alias("b"))).distinct()
        small = stage(spark, small, "small-star")
        # done when every node hangs on one that hangs on nothing
        middle = small.select("a").join(small.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
        again = small.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        edges = small
        if middle.unionByName(again.select("a")).isEmpty():
            break
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
