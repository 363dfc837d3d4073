"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftloom.session import Scratch, materialize


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", scratch: Scratch | None = None) -> DataFrame:
    """(id, component) for every node of an edge; component is the smallest id that can be reached.

    Alternating large-star and small-star steps: each keeps connectivity and at most the number of
    edges, and ends in stars after about log(n) rounds. Neighbourhood minima are partial aggregates
    and rows come back by a join, so a node with very many neighbours never meets in one task.
    Tables of the steps are among those of ``scratch``, if there is one.
    """
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v")
    pairs = materialize(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges", scratch)
    before = None
    while True:
        both = pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        stars = (
            large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct()
        )
        pairs = materialize(stars, "stars", scratch)
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        pairs.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
