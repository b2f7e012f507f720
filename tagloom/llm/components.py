"""Connected components by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.shared import release, stored_in_few


def _towards_least(edges: DataFrame) -> DataFrame:
    """For edges (u, v): u, v and the least of u and all its v. Edges are dealt once, for the aggregate and the join."""
    edges = edges.repartition("u")
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_towards_least(both).where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"))


def _small_star(edges: DataFrame) -> DataFrame:
    starred = _towards_least(edges)  # here u > v in every edge
    return (starred.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(starred.select("u", F.col("m").alias("v"))).where("u <> v").distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """Least vertex of the component of each linked vertex that is not itself the least: u, v.

    ``links`` has the columns ``u`` and ``v`` in any order, with repeats and loops. Each round shrinks
    the distance to the least vertex by a constant factor, so the number of rounds is logarithmic.
    """
    edges = stored_in_few(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .where("u <> v").distinct(), "links")
    seen = _fingerprint(edges)
    while True:
        before, edges = edges, stored_in_few(_small_star(_large_star(edges)), "stars")
        release(before)
        now = _fingerprint(edges)
        if now == seen:
            return edges
        seen = now
