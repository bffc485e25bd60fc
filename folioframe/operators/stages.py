"""Stage status of pages: progress, gates, seeding, resets, latest passes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DONE = ("completed", "skipped")


def init_page_stages(pages: DataFrame, stages: DataFrame, existing: DataFrame) -> DataFrame:
    """Every page with every stage, pending where no row is there yet. stages is the fixed chain, a handful of rows."""
    want = pages.select("chart", "page_id").crossJoin(stages.select("seq"))
    new = want.join(existing.select("chart", "page_id", "seq"), ["chart", "page_id", "seq"], "left_anti").withColumn("status", F.lit("pending"))
    return existing.select("chart", "page_id", "seq", "status").unionByName(new)


def latest(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in an order."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rn", rn).where("_rn = 1").drop("_rn")


def pages_needing_stage(pages: DataFrame, status: DataFrame, seq: int, force: bool = False) -> DataFrame:
    if force:
        return pages
    done = status.where((F.col("seq") == seq) & F.col("status").isin(*DONE)).select("chart", "page_id")
    return pages.join(done, ["chart", "page_id"], "left_anti")


def stage_progress(status: DataFrame, stages: DataFrame, keys: list[str] = ["chart"]) -> DataFrame:  # noqa: B006
    """One row a chart and stage with counts of each status, stages without rows included."""
    charts = status.select(*keys).distinct()
    j = charts.crossJoin(stages).join(status.select(*keys, "seq", "status", "page_id"), [*keys, "seq"], "left")
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    return j.groupBy(*keys, "seq", "stage").agg(*(n(s) for s in ("pending", "processing", "completed", "failed", "skipped")))


def chart_progress(progress: DataFrame) -> DataFrame:
    """The earliest stage that is not complete, and whether any incomplete stage has failures."""
    open_ = (F.col("pending") + F.col("processing") + F.col("failed")) > 0
    g = progress.groupBy("chart").agg(
        F.min(F.when(open_, F.struct("seq", "stage"))).alias("current"),
        F.coalesce(F.bool_or(open_ & (F.col("failed") > 0)), F.lit(False)).alias("failed"),
        F.coalesce(F.bool_or(F.col("processing") > 0), F.lit(False)).alias("running"),
    )
    state = F.when(F.col("current").isNull(), "completed").when(F.col("failed"), "failed").when(F.col("running"), "processing").otherwise("queued")
    return g.select("chart", F.coalesce("current.stage", F.lit("done")).alias("current_stage"), state.alias("status"))


def performance(rows: DataFrame, stage, duration) -> DataFrame:
    """Jobs by stage: total, completed, mean duration of completed ones, and success in per cent."""
    done = F.col("status") == "completed"
    g = rows.groupBy(stage.alias("stage")).agg(F.count("*").alias("jobs"), F.count_if(done).alias("completed"), F.round(F.avg(F.when(done, duration)), 2).alias("mean_duration"))
    return g.withColumn("success", F.round(100.0 * F.col("completed") / F.nullif(F.col("jobs"), F.lit(0)), 2))


def clear_stuck(status: DataFrame) -> DataFrame:
    return status.withColumn("status", F.when(F.col("status") == "processing", "pending").otherwise(F.col("status")))


def skip_reasons(pages: DataFrame, gates: list[tuple]) -> DataFrame:
    """The reason of the first gate that holds; null where none does. gates: (condition, reason)."""
    out = F.lit(None).cast("string")
    for condition, reason in reversed(gates):
        out = F.when(condition, reason).otherwise(out)
    return pages.withColumn("skip_reason", out)


def gate_delta(old: DataFrame, new: DataFrame, rules: dict[str, list[str]]) -> DataFrame:
    """Stages to run again for each page whose gate columns changed: (page_id, stage, reason). rules: column to stages."""
    j = old.select("page_id", *(F.col(c).alias(f"_{c}") for c in rules)).join(new.select("page_id", *rules), "page_id")
    parts = [F.when(~F.col(f"_{c}").eqNullSafe(F.col(c)), F.array(*(F.struct(F.lit(s).alias("stage"), F.lit(c).alias("reason")) for s in stages))).otherwise(F.array().cast("array<struct<stage:string,reason:string>>")) for c, stages in rules.items()]
    return j.select("page_id", F.explode(F.concat(*parts)).alias("d")).select("page_id", "d.stage", "d.reason")
