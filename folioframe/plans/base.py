"""Registration of queries with their SQL twins, and the adapters that map the driver's tables onto charts and pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Ids of a stretch, see pages().
STRETCH = 4096

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of (spark, sf_dir) under name; sql: the same for DuckDB, where SQL can say it."""

    def keep(f):
        assert name not in QUERIES, name
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark, sf_dir) -> DataFrame:
    """Documents as pages: a source is a chart, doc_id orders its pages. Sources are few and large, so a page's number is the count of
    the chart's pages in earlier stretches of ids, one row a stretch, and its place in its own stretch: no window holds more than STRETCH
    pages."""
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("chart"), F.col("doc_id").alias("page_id"), F.floor(F.col("doc_id") / STRETCH).alias("stretch"), "text", "lang", "n_chars")
    before = Window.partitionBy("chart").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = d.groupBy("chart", "stretch").count().select(F.col("chart").alias("c"), F.col("stretch").alias("s"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier"))
    own = F.row_number().over(Window.partitionBy("chart", "stretch").orderBy("page_id"))
    placed = d.withColumn("place", own).join(counts, F.col("chart").eqNullSafe(F.col("c")) & (F.col("stretch") == F.col("s")))
    return placed.select("chart", "page_id", (F.col("place") + F.col("earlier")).cast("long").alias("page_no"), "text", "lang", "n_chars")


def with_previous(p: DataFrame) -> DataFrame:
    """pages() with the text of the page before (prev), without each chart's first: by a join on the page's number, which deals a chart out."""
    before = p.select(F.col("chart").alias("_c"), (F.col("page_no") + 1).alias("_n"), F.col("text").alias("prev"))
    return p.join(before, F.col("chart").eqNullSafe(F.col("_c")) & (F.col("page_no") == F.col("_n"))).drop("_c", "_n").where("prev is not null")


PAGES = """pages_a AS (SELECT source AS chart, doc_id AS page_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS page_no,
  text, lang, n_chars FROM documents)"""

_LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")


def order_pages(spark, sf_dir) -> DataFrame:
    """Order lines as pages: an order is a chart, the ship date the date of service, the return flag the page's kind."""
    d = table(spark, sf_dir, "lineitem")
    return d.select(
        F.col("l_orderkey").alias("chart"),
        F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*_LINE_ORDER)).cast("long").alias("page_no"),
        F.col("l_shipdate").cast("date").alias("dos"),
        F.when(F.col("l_returnflag") == "R", "junk").when(F.col("l_returnflag") == "N", "blank").otherwise("main").alias("kind"),
        F.when(F.col("l_linestatus") == "O", "printed").otherwise("handwritten").alias("print"),
        (F.col("l_discount") * 10).alias("confidence"),
        F.col("l_suppkey").alias("doc_hint"),
        F.col("l_partkey").alias("part"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_tax").alias("tax"),
    )


ORDER_PAGES = f"""pages_o AS (SELECT l_orderkey AS chart, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(_LINE_ORDER)}) AS page_no,
  l_shipdate::DATE AS dos, CASE l_returnflag WHEN 'R' THEN 'junk' WHEN 'N' THEN 'blank' ELSE 'main' END AS kind,
  CASE l_linestatus WHEN 'O' THEN 'printed' ELSE 'handwritten' END AS print, l_discount * 10 AS confidence, l_suppkey AS doc_hint,
  l_partkey AS part, l_quantity AS quantity, l_tax AS tax FROM lineitem)"""

#: A stage chain of five stages stands in for the reference chain; an event type is a stage, the value's whole part its outcome.
STAGES = ("ingest", "ocr", "classify", "sequence", "final")


def stage_status(spark, sf_dir) -> DataFrame:
    """Events as page-stage rows: user = chart, stage and pass from the event's number, status from its value."""
    e = table(spark, sf_dir, "events")
    v = F.pmod(F.floor(F.abs(F.col("value")) * 10), F.lit(10))
    return e.select(
        F.col("user_id").alias("chart"),
        F.col("event_id"),
        F.pmod(F.col("event_id"), F.lit(7)).alias("page_id"),
        F.pmod(F.col("event_id"), F.lit(5)).cast("int").alias("seq"),
        (F.pmod(F.floor(F.col("event_id") / 5), F.lit(2)) + 1).cast("int").alias("pass_no"),
        F.when(v < 6, "completed").when(v < 7, "failed").when(v < 8, "skipped").when(v < 9, "pending").otherwise("processing").alias("status"),
        F.col("ts"),
        F.col("event_type"),
        F.col("value"),
        F.col("props"),
    )


STAGE_STATUS = """stage_e AS (SELECT user_id AS chart, event_id, event_id % 7 AS page_id, (event_id % 5)::INT AS seq, ((event_id // 5) % 2 + 1)::INT AS pass_no,
  CASE WHEN v < 6 THEN 'completed' WHEN v < 7 THEN 'failed' WHEN v < 8 THEN 'skipped' WHEN v < 9 THEN 'pending' ELSE 'processing' END AS status,
  ts, event_type, value, props FROM (SELECT *, floor(abs(value) * 10)::BIGINT % 10 AS v FROM events))"""
