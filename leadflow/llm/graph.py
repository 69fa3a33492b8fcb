"""Connected components of an edge list, by alternating stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``a, b`` edges; the label is the smallest node reachable.

    Self-links, repeated and reversed edges are fine; an empty list gives no rows.  Every round is a few joins and
    sums by node, so a node with very many neighbours is one sum; its result is written to the shared folder.
    """
    stars = saved(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges")
    seen = None
    while True:
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        near = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(near, "a")
        stars = saved(
            near.select("a", F.col("m").alias("b"))
            .union(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct(),
            "stars")
        row = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if row == seen:
            break
        seen = row
    return stars.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        stars.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
