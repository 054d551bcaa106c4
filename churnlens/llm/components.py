"""Connected components of a table of links, by alternating large and small stars.

Both steps hang a node's neighbours onto its smallest one; links get fewer or
shorter until every component is a star around its smallest node, in a number
of rounds that grows with the logarithm of the longest chain. Each round is two
aggregates with partial sums and two joins on the node, which Spark splits
where a star's centre is hot, and is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.session import drop_path, scratch_path


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionByName(hung).distinct()


def _signature(links: DataFrame):
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(a, b) for every node ``a`` that is not the smallest of its component, ``b``
    being the smallest. ``links`` has two long columns a and b, in any order."""
    spark = links.sparkSession

    def written(stars: DataFrame) -> tuple[str, DataFrame]:
        path = scratch_path(spark, "stars")
        stars.write.parquet(path)
        return path, spark.read.parquet(path)
    path, now = written(_small_star(links))
    seen = _signature(now)
    while seen[0]:
        old, (path, now) = path, written(_small_star(_large_star(now)))
        drop_path(spark, old)
        last, seen = seen, _signature(now)
        if last == seen:
            break
    return now
