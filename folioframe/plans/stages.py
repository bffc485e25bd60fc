"""Queries of stage status and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioframe.operators import stages as G
from folioframe.plans.base import ORDER_PAGES, STAGE_STATUS, STAGES, order_pages, query, stage_status, table

_NAMES = "stages AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{s}')" for i, s in enumerate(STAGES)) + ") v(seq, stage))"
_LATEST = f"{STAGE_STATUS}, latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chart, page_id, seq ORDER BY pass_no DESC, ts DESC NULLS LAST, event_id DESC) AS rn FROM stage_e) WHERE rn = 1)"
_COUNTS = ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in ("pending", "processing", "completed", "failed", "skipped"))


def _stages(spark):
    return spark.createDataFrame(list(enumerate(STAGES)), "seq int, stage string")


def _latest(spark, sf):
    return G.latest(stage_status(spark, sf), ["chart", "page_id", "seq"], [F.col("pass_no").desc(), F.col("ts").desc_nulls_last(), F.col("event_id").desc()])


@query("win_latest_pass", f"WITH {_LATEST} SELECT chart, page_id, seq, pass_no, event_id, status FROM latest")
def win_latest_pass(spark, sf):
    return _latest(spark, sf).select("chart", "page_id", "seq", "pass_no", "event_id", "status")


_PROGRESS = f"{_LATEST}, {_NAMES}, g AS (SELECT c.chart, s.seq, s.stage, l.status FROM (SELECT DISTINCT chart FROM latest) c CROSS JOIN stages s LEFT JOIN latest l ON l.chart = c.chart AND l.seq = s.seq), p AS (SELECT chart, seq, stage, {_COUNTS} FROM g GROUP BY ALL)"


@query("join_stage_progress", f"WITH {_PROGRESS} SELECT * FROM p")
def join_stage_progress(spark, sf):
    return G.stage_progress(_latest(spark, sf), _stages(spark))


@query("agg_stage_counts", f"WITH {_LATEST} SELECT seq, count(*) AS pages_total, {_COUNTS} FROM latest GROUP BY seq")
def agg_stage_counts(spark, sf):
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    return _latest(spark, sf).groupBy("seq").agg(F.count("*").alias("pages_total"), *(n(s) for s in ("pending", "processing", "completed", "failed", "skipped")))


_CHART = f"{_PROGRESS}, o AS (SELECT *, pending + processing + failed > 0 AS open FROM p)"


@query("agg_chart_progress", f"WITH {_CHART} SELECT chart, coalesce(arg_min(stage, seq) FILTER (WHERE open), 'done') AS current_stage, CASE WHEN count(*) FILTER (WHERE open) = 0 THEN 'completed' WHEN bool_or(open AND failed > 0) THEN 'failed' WHEN bool_or(processing > 0) THEN 'processing' ELSE 'queued' END AS status FROM o GROUP BY chart")
def agg_chart_progress(spark, sf):
    return G.chart_progress(G.stage_progress(_latest(spark, sf), _stages(spark)))


query("maint_refresh_status", f"WITH {_CHART} SELECT chart, coalesce(arg_min(stage, seq) FILTER (WHERE open), 'done') AS current_stage, CASE WHEN count(*) FILTER (WHERE open) = 0 THEN 'completed' WHEN bool_or(open AND failed > 0) THEN 'failed' WHEN bool_or(processing > 0) THEN 'processing' ELSE 'queued' END AS status FROM o GROUP BY chart")(agg_chart_progress)


@query("agg_stage_performance", f"WITH {STAGE_STATUS} SELECT event_type AS stage, count(*) AS jobs, count(*) FILTER (WHERE status = 'completed') AS completed, round(avg(value) FILTER (WHERE status = 'completed'), 2) AS mean_duration, round(100.0 * count(*) FILTER (WHERE status = 'completed') / nullif(count(*), 0), 2)::DOUBLE AS success FROM stage_e GROUP BY event_type")
def agg_stage_performance(spark, sf):
    return G.performance(stage_status(spark, sf), F.col("event_type"), F.col("value"))


@query("agg_batch_summary", f"WITH {STAGE_STATUS} SELECT status, count(*) AS jobs, round(sum(value), 2) AS seconds FROM stage_e GROUP BY status")
def agg_batch_summary(spark, sf):
    return stage_status(spark, sf).groupBy("status").agg(F.count("*").alias("jobs"), F.round(F.sum("value"), 2).alias("seconds"))


@query("filter_pages_needing_stage", f"WITH {_LATEST}, pg AS (SELECT DISTINCT chart, page_id FROM stage_e) SELECT chart, page_id FROM pg WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.chart = pg.chart AND l.page_id = pg.page_id AND l.seq = 1 AND l.status IN ('completed', 'skipped'))")
def filter_pages_needing_stage(spark, sf):
    s = stage_status(spark, sf)
    return G.pages_needing_stage(s.select("chart", "page_id").distinct(), _latest(spark, sf), 1)


query("inc_resume", f"WITH {_LATEST}, pg AS (SELECT DISTINCT chart, page_id FROM stage_e) SELECT chart, page_id FROM pg WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.chart = pg.chart AND l.page_id = pg.page_id AND l.seq = 1 AND l.status IN ('completed', 'skipped'))")(filter_pages_needing_stage)


@query("merge_init_page_stages", f"WITH {_LATEST}, {_NAMES}, pg AS (SELECT DISTINCT chart, page_id FROM stage_e) SELECT pg.chart, pg.page_id, s.seq, coalesce(l.status, 'pending') AS status FROM pg CROSS JOIN stages s LEFT JOIN latest l ON l.chart = pg.chart AND l.page_id = pg.page_id AND l.seq = s.seq")
def merge_init_page_stages(spark, sf):
    s = stage_status(spark, sf)
    return G.init_page_stages(s.select("chart", "page_id").distinct(), _stages(spark), _latest(spark, sf))


@query("merge_clear_reset", f"WITH {_LATEST} SELECT chart, page_id, seq, CASE WHEN status = 'processing' THEN 'pending' ELSE status END AS status FROM latest")
def merge_clear_reset(spark, sf):
    return G.clear_stuck(_latest(spark, sf)).select("chart", "page_id", "seq", "status")


@query("filter_skip_reasons", f"WITH {ORDER_PAGES} SELECT chart, page_no, CASE WHEN kind = 'blank' THEN 'blank' WHEN print = 'handwritten' THEN 'handwritten' WHEN confidence < 0.2 THEN 'low quality' END AS skip_reason FROM pages_o")
def filter_skip_reasons(spark, sf):
    return G.skip_reasons(order_pages(spark, sf), [(F.col("kind") == "blank", "blank"), (F.col("print") == "handwritten", "handwritten"), (F.col("confidence") < 0.2, "low quality")]).select("chart", "page_no", "skip_reason")


@query("filter_final2_skip", f"WITH {ORDER_PAGES} SELECT chart, page_no, CASE WHEN kind = 'blank' THEN 'settled' WHEN print = 'printed' AND confidence >= 0.7 THEN 'high quality printed' END AS skip_reason FROM pages_o")
def filter_final2_skip(spark, sf):
    return G.skip_reasons(order_pages(spark, sf), [(F.col("kind") == "blank", "settled"), ((F.col("print") == "printed") & (F.col("confidence") >= 0.7), "high quality printed")]).select("chart", "page_no", "skip_reason")


@query("filter_bj_pass2_gate", f"WITH {ORDER_PAGES} SELECT chart, page_no, CASE WHEN kind = 'junk' THEN 'ruled out' WHEN confidence > 0.9 THEN 'sure keep' WHEN tax = 0 THEN 'no final text' END AS skip_reason FROM pages_o")
def filter_bj_pass2_gate(spark, sf):
    return G.skip_reasons(order_pages(spark, sf), [(F.col("kind") == "junk", "ruled out"), (F.col("confidence") > 0.9, "sure keep"), (F.col("tax") == 0, "no final text")]).select("chart", "page_no", "skip_reason")


@query("filter_blank_junk_exclude", f"WITH {ORDER_PAGES} SELECT chart, page_no FROM pages_o WHERE kind = 'main' OR print = 'handwritten' AND kind = 'junk'")
def filter_blank_junk_exclude(spark, sf):
    """Main pages, with those that a later pass judges still in."""
    p = order_pages(spark, sf)
    out = p.where("kind <> 'main' AND NOT (print = 'handwritten' AND kind = 'junk')").select("chart", "page_no")
    return p.select("chart", "page_no").join(out, ["chart", "page_no"], "left_anti")


@query("filter_quality_gates", f"WITH {ORDER_PAGES}, q AS (SELECT *, CASE WHEN tax = 0 THEN NULL WHEN confidence >= 0.7 THEN 'high' WHEN confidence >= 0.4 THEN 'medium' ELSE 'low' END AS tag FROM pages_o) SELECT chart, page_no, print IS DISTINCT FROM 'printed' AS non_printed, coalesce(tag = 'low', false) AS low, coalesce(tag = 'high' AND print = 'printed', false) AS high_printed FROM q")
def filter_quality_gates(spark, sf):
    """Three-valued tags: a page without a tag is neither low nor high."""
    q = order_pages(spark, sf).withColumn("tag", F.when(F.col("tax") == 0, None).when(F.col("confidence") >= 0.7, "high").when(F.col("confidence") >= 0.4, "medium").otherwise("low"))
    return q.select("chart", "page_no", (~F.col("print").eqNullSafe(F.lit("printed"))).alias("non_printed"), F.coalesce(F.col("tag") == "low", F.lit(False)).alias("low"), F.coalesce((F.col("tag") == "high") & (F.col("print") == "printed"), F.lit(False)).alias("high_printed"))


@query("set_gate_delta", f"WITH {ORDER_PAGES}, o AS (SELECT chart * 1000 + page_no AS page_id, kind AS k1, CASE WHEN tax > 0.04 THEN 'main' ELSE kind END AS k2, print AS p1, CASE WHEN tax > 0.06 THEN 'printed' ELSE print END AS p2 FROM pages_o), d AS (SELECT page_id, unnest(CASE WHEN k1 <> k2 THEN ['classify', 'final'] ELSE []::VARCHAR[] END) AS stage, 'kind' AS reason FROM o UNION ALL SELECT page_id, unnest(CASE WHEN p1 <> p2 THEN ['ocr'] ELSE []::VARCHAR[] END), 'print' FROM o) SELECT * FROM d")
def set_gate_delta(spark, sf):
    p = order_pages(spark, sf).withColumn("page_id", F.col("chart") * 1000 + F.col("page_no"))
    new = p.withColumn("kind", F.when(F.col("tax") > 0.04, "main").otherwise(F.col("kind"))).withColumn("print", F.when(F.col("tax") > 0.06, "printed").otherwise(F.col("print")))
    return G.gate_delta(p, new, {"kind": ["classify", "final"], "print": ["ocr"]})


@query("merge_prune_orphans", f"WITH {_LATEST}, keep AS (SELECT DISTINCT chart, page_id FROM stage_e WHERE page_id % 2 = 0) SELECT l.chart, l.page_id, l.seq, l.status FROM latest l JOIN keep USING (chart, page_id)")
def merge_prune_orphans(spark, sf):
    keep = stage_status(spark, sf).where("page_id % 2 = 0").select("chart", "page_id").distinct()
    return _latest(spark, sf).join(keep, ["chart", "page_id"], "left_semi").select("chart", "page_id", "seq", "status")


@query("inc_cache_by_version", "SELECT user_id AS chart, count(*) AS n, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS newest FROM events GROUP BY user_id")
def inc_cache_by_version(spark, sf):
    """What a cached text is rebuilt on: number of rows and the newest change."""
    return table(spark, sf, "events").groupBy(F.col("user_id").alias("chart")).agg(F.count("*").alias("n"), F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("newest"))
