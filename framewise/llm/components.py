"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.settings import write_through


def _least(pairs: DataFrame) -> DataFrame:
    """For each ``a`` the smallest ``b``; partial minima go ahead of the shuffle."""
    return pairs.groupBy("a").agg(F.min("b").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the smallest node in its neighbourhood."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = _least(both).select("a", F.least("a", "m").alias("m"))
    return both.join(near, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b"))
    least = _least(down)
    moved = down.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` has columns a, b. One row per node that has a link to another: node, component.

    The component is named by its smallest node. Rounds go on until the table of links no longer
    changes, which takes about as many as the logarithm of the longest path. Each round is written
    to the shared folder. A node with very many links is no burden: minima are combined ahead of
    the shuffle, and the joins are plain equi joins that Spark can split where keys are skewed.
    """
    now = write_through(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b")).distinct(), "links"
    )
    mark = None
    while True:
        found = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == mark:
            break
        mark = tuple(found)
        if not mark[0]:
            break
        now = write_through(_small_star(_large_star(now)), "links")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
