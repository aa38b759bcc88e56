"""Connected components by alternating large-star and small-star steps.

Every step is a Spark aggregation and join over the links, written to the
shared folder in between; nothing is collected but one number a step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketide.llm.common import shuffles_go, written


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links (a > b). A point's own new link comes from
    the link to its least neighbour, so that each step is one join; copies go at the end."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = (both.join(least.hint("merge"), "a").where("b > a or b = m")
             .select(F.greatest("a", "b").alias("a"), F.col("m").alias("b")))
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    return (large.join(least.hint("merge"), "a")
            .select(F.when(F.col("b") > F.col("m"), F.col("b")).otherwise(F.col("a")).alias("a"), F.col("m").alias("b"))).distinct()


def _moving(now: DataFrame) -> int:
    """Documents that are not yet the centre or a point of one star only."""
    ends = now.select(F.col("a").alias("d"), F.lit(1).alias("n")).unionByName(now.select(F.col("b").alias("d"), F.lit(0).alias("n")))
    # Partial sums before the shuffle: a centre of many points costs its task little.
    told = ends.groupBy("d").agg(F.sum("n").alias("n"), F.min("n").alias("least"))
    with shuffles_go(now.sparkSession):
        return told.where("n > 1 or n = 1 and least = 0").count()


def points(links: DataFrame) -> DataFrame:
    """``doc_id, component_id`` for every document with a link (``a``, ``b``) to a smaller one it can
    reach; ``component_id`` is the smallest."""
    now = written(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                  "components")
    while _moving(now):
        now = written(_stars(now), "components")
    return now.select(F.col("a").alias("doc_id"), F.col("b").alias("component_id"))


def components(links: DataFrame) -> DataFrame:
    """``points`` and the smallest documents themselves. Documents without links are not listed."""
    now = points(links)
    return now.unionByName(now.select(F.col("component_id").alias("doc_id"), "component_id").distinct())
