"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.llm.common import shared_dir

#: Edges of a checkpoint's file.
FILE_EDGES = 100_000


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges: (a long, b long), any direction, repeats and loops allowed. Returns (node, root), root the least node
    reachable, for each node that has an edge to another one. Each round ends in a checkpoint in the shared folder, of a file for
    FILE_EDGES edges instead of one for each shuffle partition; the driver sees two numbers a round. Nulls are left out. An empty edge table gives an empty result."""
    shared_dir(edges.sparkSession)
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    was = None
    for _ in range(most_rounds):
        sign = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == was or not sign[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        was = sign
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        now = small.where("a <> b").distinct().coalesce(1 + sign[0] // FILE_EDGES).checkpoint()
    raise RuntimeError(f"components not settled after {most_rounds} rounds")
