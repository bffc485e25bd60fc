"""Incremental runs: file streams, sessions over event time, keyed upserts by micro-batch, and rule files that reload."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Events of a user that lie no further apart than gap, as one row; for streams and tables alike."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if e.isStreaming:
        e = e.withWatermark("ts", late)
    g = e.groupBy("user_id", F.session_window("ts", gap).alias("s")).agg(F.count("*").alias("events"), F.sum("value").alias("value"))
    return g.select("user_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "events", "value")


def hopping(events: DataFrame, size: str = "1 hour", hop: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if e.isStreaming:
        e = e.withWatermark("ts", late)
    g = e.groupBy("event_type", F.window("ts", size, hop).alias("w")).agg(F.count("*").alias("events"))
    return g.select("event_type", F.col("w.start").alias("start"), "events")


def intake(spark: SparkSession, folder: str, schema, table: str, checkpoint: str, keys: list[str], order: str):
    """Files that arrive in a folder, merged into a keyed table batch by batch: each batch rewrites the table's next version from the last
    one, so a batch that is run again after a failure gives the same version. Returns the ended query."""

    def merge(batch: DataFrame, n: int) -> None:
        from folioframe.operators.merge import last_wins

        new = last_wins(batch, [F.col(k) for k in keys], [F.col(order)])
        if n > 0:
            old = spark.read.parquet(f"{table}/v={n - 1}")
            new = old.join(new, keys, "left_anti").unionByName(new)
        new.write.mode("overwrite").parquet(f"{table}/v={n}")

    stream = spark.readStream.schema(schema).parquet(folder)
    q = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def leases(asks: DataFrame, hold: int = 600_000_000) -> DataFrame:
    """(job, ask, worker, outcome, until, remaining): workers that ask for a job, in the order of at (microseconds) and ask. A job that is free or whose lease has run
    out is claimed for hold microseconds; its holder's next ask is a heartbeat that renews the lease; others are refused. One running pass a job.
    asks: (job long, ask long, worker string, at long)."""
    from folioframe.operators.folds import running

    def step(state, row):
        holder, until = state
        job, at, ask, worker = row
        if holder is None or at >= until:
            holder, until, outcome = worker, at + hold, "claimed"
        elif worker == holder:
            until, outcome = at + hold, "renewed"
        else:
            outcome = "refused"
        return (holder, until), (job, ask, worker, outcome, until, until - at)

    a = asks.where("job is not null and ask is not null and worker is not null and at is not null").withColumnRenamed("job", "chart")
    return running(a, ["at", "ask", "worker"], ["at", "ask"], "job long, ask long, worker string, outcome string, until long, remaining long", lambda: (None, 0), step)


def to_memory(stream: DataFrame, name: str, mode: str = "append"):
    """Runs a stream over all that is there into an in-memory table; for tests."""
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)


class RuleFile:
    """A JSON rule file that is read again when it changes; a broken version leaves the last good one."""

    def __init__(self, path: str):
        self.path, self.stamp, self.value = path, None, None

    def get(self):
        try:
            stamp = os.stat(self.path).st_mtime_ns
            if stamp != self.stamp:
                with open(self.path) as f:
                    self.value, self.stamp = json.load(f), stamp
        except (OSError, ValueError):
            if self.value is None:
                raise
        return self.value


class ReportCache:
    """A result kept as long as its version stays: the version is a small query, the result a costly one."""

    def __init__(self):
        self.kept: dict[str, tuple] = {}

    def get(self, name: str, version: DataFrame, build):
        v = tuple(map(tuple, version.collect()))
        if name not in self.kept or self.kept[name][0] != v:
            self.kept[name] = (v, build())
        return self.kept[name][1]
