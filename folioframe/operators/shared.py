"""The folder that all executors share, and what needs it."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shared_folder(spark) -> str:
    """spark.checkpoint.dir of the session. Where none is set a folder of this machine will do for a local master, and for no other."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="folioframe-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def ensure_checkpoint_dir(spark) -> None:
    shared_folder(spark)


def components(links: DataFrame, most: int = 60) -> DataFrame:
    """(node, root): each node of links (a, b) with the least node that it reaches. Large-star and small-star steps take turns until nothing
    moves; every round ends in a checkpoint, and the driver sees one row a round."""
    ensure_checkpoint_dir(links.sparkSession)
    hang = lambda e: e.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = hang(links).checkpoint(), None
    for _ in range(most):
        state = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        around = now.union(now.select("b", "a"))
        star = around.join(around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "a")
        large = star.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        now = hang(small.select("a", F.col("m").alias("b")).union(small.select("b", "m"))).checkpoint()
    raise RuntimeError(f"components not settled after {most} rounds")
