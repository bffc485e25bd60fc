"""Queries of ordered sequences of pages."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from folioframe.operators import sequence as Q
from folioframe.plans.base import ORDER_PAGES, PAGES, order_pages, pages, query, table

_O = f"WITH {ORDER_PAGES}"
#: Pages with a date where they are main.
_D = f"{_O}, d AS (SELECT *, CASE WHEN kind <> 'blank' THEN date_trunc('month', dos)::DATE END AS k FROM pages_o), g AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR NOT (k IS NOT DISTINCT FROM lag(k) OVER w AND k IS NOT NULL) THEN 1 ELSE 0 END AS new FROM d WINDOW w AS (PARTITION BY chart ORDER BY page_no)), v AS (SELECT *, sum(new) OVER (PARTITION BY chart ORDER BY page_no)::BIGINT AS visit FROM g)"


def _visits(spark, sf):
    p = order_pages(spark, sf)
    return Q.runs(p, F.when(F.col("kind") != "blank", F.trunc("dos", "month")))


@query("win_visit_sessions", f"{_D} SELECT chart, page_no, visit FROM v")
def win_visit_sessions(spark, sf):
    return _visits(spark, sf).select("chart", "page_no", "visit")


@query("win_junk_runs", f"{_O}, i AS (SELECT *, sum(CASE WHEN kind = 'main' THEN 1 ELSE 0 END) OVER (PARTITION BY chart ORDER BY page_no)::BIGINT AS island FROM pages_o) SELECT chart, island, count(*) AS pages, round(avg(confidence), 4) AS confidence, min(page_no) AS first, max(page_no) AS last FROM i WHERE kind = 'junk' GROUP BY chart, island")
def win_junk_runs(spark, sf):
    return Q.junk_runs(order_pages(spark, sf))


@query("win_blanks_between", f"{_O}, b AS (SELECT *, sum(CASE WHEN kind = 'blank' THEN 1 ELSE 0 END) OVER (PARTITION BY chart ORDER BY page_no) AS n FROM pages_o) SELECT chart, page_no, lag(page_no) OVER w AS prev, (n - lag(n) OVER w)::BIGINT AS blanks FROM b WHERE kind <> 'blank' WINDOW w AS (PARTITION BY chart ORDER BY page_no)")
def win_blanks_between(spark, sf):
    return Q.blanks_between(order_pages(spark, sf))


_POS = f"{_D}, p AS (SELECT *, row_number() OVER (PARTITION BY chart, visit ORDER BY page_no) AS seq, count(*) OVER (PARTITION BY chart, visit) AS n FROM v)"


@query("win_document_position", f"{_POS} SELECT chart, page_no, seq, CASE WHEN n = 1 THEN 'standalone' WHEN seq = 1 THEN 'first' WHEN seq = n THEN 'last' ELSE 'continue' END AS position FROM p")
def win_document_position(spark, sf):
    return Q.document_position(_visits(spark, sf), "visit").select("chart", "page_no", "seq", "position")


@query("win_transparent_attach", f"{_D}, o AS (SELECT *, CASE WHEN kind = 'main' THEN visit END AS own FROM v), a AS (SELECT *, last_value(own IGNORE NULLS) OVER (PARTITION BY chart ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bef, first_value(own IGNORE NULLS) OVER (PARTITION BY chart ORDER BY page_no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS aft FROM o) SELECT chart, page_no, coalesce(own, bef, aft) AS attached FROM a")
def win_transparent_attach(spark, sf):
    return Q.transparent_attach(_visits(spark, sf), "visit").select("chart", "page_no", "attached")


@query("win_document_carry", f"{_D}, c AS (SELECT *, CASE WHEN kind = 'main' THEN dos END AS own FROM v) SELECT chart, page_no, (first_value(own IGNORE NULLS) OVER w)::VARCHAR AS doc_dos, first_value(kind) OVER w AS doc_kind FROM c WINDOW w AS (PARTITION BY chart, visit ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)")
def win_document_carry(spark, sf):
    v = _visits(spark, sf).withColumn("dos", F.when(F.col("kind") == "main", F.col("dos")))
    return Q.document_carry(v, "visit", {"dos": True, "kind": False}).select("chart", "page_no", F.col("doc_dos").cast("string").alias("doc_dos"), "doc_kind")


@query("win_encounter_specialty", f"{_D} SELECT chart, page_no, first_value(print) OVER (PARTITION BY chart, visit ORDER BY page_no) AS specialty FROM v")
def win_encounter_specialty(spark, sf):
    return Q.document_carry(_visits(spark, sf), "visit", {"print": False}).select("chart", "page_no", F.col("doc_print").alias("specialty"))


@query("win_visual_neighbor_keep", f"{_O}, f AS (SELECT *, CASE kind WHEN 'main' THEN 'keep' ELSE kind END AS flag, print = 'handwritten' AS visual FROM pages_o) SELECT chart, page_no, CASE WHEN visual AND flag = 'junk' AND coalesce(lag(flag) OVER w = 'keep' OR lead(flag) OVER w = 'keep', false) THEN 'keep' ELSE flag END AS final_flag FROM f WINDOW w AS (PARTITION BY chart ORDER BY page_no)")
def win_visual_neighbor_keep(spark, sf):
    p = order_pages(spark, sf).withColumns({"flag": F.when(F.col("kind") == "main", "keep").otherwise(F.col("kind")), "visual": F.col("print") == "handwritten"})
    return Q.neighbor_keep(p).select("chart", "page_no", "final_flag")


@query("win_edge_words", "SELECT doc_id, array_to_string(w[1:5], ' ') AS head, array_to_string(w[greatest(len(w) - 4, 1):], ' ') AS tail FROM (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda x: x <> '') AS w FROM documents)")
def win_edge_words(spark, sf):
    h, t = Q.edge_words(F.coalesce("text", F.lit("")), 5)
    return table(spark, sf, "documents").select("doc_id", h.alias("head"), t.alias("tail"))


@query("win_tail_head_blocks", "SELECT doc_id, md5(array_to_string(w[greatest(len(w) - 1, 1):], ' ')) AS tail, md5(array_to_string(w[1:2], ' ')) AS head FROM (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS w FROM documents)")
def win_tail_head_blocks(spark, sf):
    t, h = Q.tail_head(F.coalesce("text", F.lit("")))
    return table(spark, sf, "documents").select("doc_id", F.md5(t.cast("binary")).alias("tail"), F.md5(h.cast("binary")).alias("head"))


@query("win_running_headers", f"WITH {PAGES}, l AS (SELECT chart, page_no, regexp_replace(lower(trim(split_part(text, chr(10), 1))), '\\d', '#', 'g') AS line FROM pages_a) SELECT chart, md5(line) AS line, count(DISTINCT page_no) AS pages FROM l WHERE line <> '' GROUP BY chart, l.line HAVING count(DISTINCT page_no) > 1")
def win_running_headers(spark, sf):
    p = pages(spark, sf).select("chart", "page_no", F.regexp_replace(F.lower(F.trim(F.split_part(F.col("text"), F.lit("\n"), F.lit(1)))), r"\d", "#").alias("line")).where("line <> ''")
    return Q.running_headers(p).select("chart", F.md5(F.col("line").cast("binary")).alias("line"), "pages")


@query("win_propagate_names", f"{_O}, n AS (SELECT *, CASE WHEN kind = 'main' THEN doc_hint::VARCHAR END AS name FROM pages_o) SELECT chart, page_no, coalesce(name, CASE WHEN print = 'printed' THEN last_value(name IGNORE NULLS) OVER (PARTITION BY chart ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END) AS name_final FROM n")
def win_propagate_names(spark, sf):
    p = order_pages(spark, sf).withColumn("name", F.when(F.col("kind") == "main", F.col("doc_hint").cast("string")))
    return Q.propagate(p, "name", F.col("print") == "printed").select("chart", "page_no", "name_final")


@query("win_gap_pairs", f"{_O}, g AS (SELECT *, lag(dos) OVER w AS pd, lag(doc_hint) OVER w AS ph, lag(print) OVER w AS pp, lag(page_no) OVER w AS prev FROM pages_o WHERE kind <> 'blank' WINDOW w AS (PARTITION BY chart ORDER BY page_no)) SELECT chart, prev, page_no, (CASE WHEN pd = dos THEN -5 ELSE 3 END + CASE WHEN ph = doc_hint THEN -2 ELSE 1 END + CASE WHEN pp <> print THEN 1 ELSE 0 END)::BIGINT AS score FROM g WHERE prev IS NOT NULL")
def win_gap_pairs(spark, sf):
    """Stateless points of each gap between neighbouring scored pages: above 0 breaks, below joins."""
    w = Q.by_page()
    p = order_pages(spark, sf).where("kind <> 'blank'")
    p = p.withColumns({f"p_{c}": F.lag(c).over(w) for c in ("dos", "doc_hint", "print", "page_no")}).where("p_page_no is not null")
    points = F.when(F.col("p_dos") == F.col("dos"), -5).otherwise(3) + F.when(F.col("p_doc_hint") == F.col("doc_hint"), -2).otherwise(1) + F.when(F.col("p_print") != F.col("print"), 1).otherwise(0)
    return p.select("chart", F.col("p_page_no").alias("prev"), "page_no", points.cast("long").alias("score"))


#: Markers: a part number's last digits make "n of m" families.
_M = f"{_O}, m AS (SELECT chart, page_no, CASE WHEN part % 4 <> 0 THEN part % 7 END AS num, CASE WHEN part % 4 <> 0 THEN part % 2 END AS total FROM pages_o), s AS (SELECT *, row_number() OVER (PARTITION BY chart, total ORDER BY page_no) AS slot, row_number() OVER (PARTITION BY chart, total ORDER BY num, page_no) AS rk FROM m WHERE num IS NOT NULL), z AS (SELECT a.chart, a.page_no, a.num, a.total, b.page_no AS new_no FROM s a JOIN s b ON a.chart = b.chart AND a.total = b.total AND a.rk = b.slot), r AS (SELECT m.*, coalesce(z.new_no, m.page_no) AS new_no FROM m LEFT JOIN z ON z.chart = m.chart AND z.page_no = m.page_no)"


def _marked(spark, sf):
    odd = F.col("part") % 4 != 0
    return order_pages(spark, sf).select("chart", "page_no", F.when(odd, F.col("part") % 7).alias("num"), F.when(odd, F.col("part") % 2).alias("total"))


@query("win_slot_reorder", f"{_M} SELECT chart, page_no, new_no FROM r")
def win_slot_reorder(spark, sf):
    return Q.slot_reorder(_marked(spark, sf), "num", ["total"]).select("chart", "page_no", "new_no")


@query("win_fenced_order", f"{_M}, c AS (SELECT chart, total, max(k) AS k FROM (SELECT chart, total, num, count(*) AS k FROM m WHERE num IS NOT NULL GROUP BY ALL) GROUP BY ALL), h AS (SELECT r.*, r.num IS NOT NULL AND (c.k > 1 OR max(abs(new_no - page_no)) OVER (PARTITION BY r.chart, r.total) > 3) AS held FROM r LEFT JOIN c ON c.chart = r.chart AND c.total = r.total) SELECT chart, page_no, CASE WHEN held THEN page_no ELSE new_no END AS new_no, coalesce(held, false) AS held FROM h")
def win_fenced_order(spark, sf):
    return Q.fenced_order(_marked(spark, sf), "num", "total", 3).select("chart", "page_no", "new_no", "held")


query("seq_fenced_order", f"{_M}, c AS (SELECT chart, total, max(k) AS k FROM (SELECT chart, total, num, count(*) AS k FROM m WHERE num IS NOT NULL GROUP BY ALL) GROUP BY ALL), h AS (SELECT r.*, r.num IS NOT NULL AND (c.k > 1 OR max(abs(new_no - page_no)) OVER (PARTITION BY r.chart, r.total) > 3) AS held FROM r LEFT JOIN c ON c.chart = r.chart AND c.total = r.total) SELECT chart, page_no, CASE WHEN held THEN page_no ELSE new_no END AS new_no, coalesce(held, false) AS held FROM h")(win_fenced_order)


@query("win_order_confidence", f"{_M} SELECT chart, CASE WHEN count(*) >= 3 THEN round(avg((new_no = page_no)::INT), 4) END AS confidence FROM r WHERE num IS NOT NULL GROUP BY chart")
def win_order_confidence(spark, sf):
    return Q.order_confidence(Q.slot_reorder(_marked(spark, sf), "num", ["total"]).where("num is not null"))


@query("win_cover_last", f"{_O} SELECT chart, page_no, row_number() OVER (PARTITION BY chart ORDER BY (quantity < 5)::INT, page_no) AS new_no FROM pages_o")
def win_cover_last(spark, sf):
    return Q.cover_last(order_pages(spark, sf), F.col("quantity") < 5).select("chart", "page_no", "new_no")


@query("agg_page_ranges", f"{_O}, i AS (SELECT chart, kind, page_no, page_no - row_number() OVER (PARTITION BY chart, kind ORDER BY page_no) AS g FROM pages_o), x AS (SELECT chart, kind, min(page_no) AS a, max(page_no) AS b FROM i GROUP BY chart, kind, g) SELECT chart, kind, string_agg(CASE WHEN a = b THEN a::VARCHAR ELSE a || '-' || b END, ', ' ORDER BY a) AS ranges FROM x GROUP BY chart, kind")
def agg_page_ranges(spark, sf):
    return Q.page_ranges(order_pages(spark, sf), ["chart", "kind"])


@query("win_pick_manifest", "SELECT c_nationkey, arg_max(c_custkey, ((c_acctbal > 0)::INT, (c_mktsegment <> 'BUILDING')::INT, -c_custkey)) AS c_custkey FROM customer GROUP BY c_nationkey")
def win_pick_manifest(spark, sf):
    """The most complete roster row: flags first, then the lowest id."""
    full = F.struct((F.col("c_acctbal") > 0).cast("int"), (F.col("c_mktsegment") != "BUILDING").cast("int"), -F.col("c_custkey"))
    return table(spark, sf, "customer").groupBy("c_nationkey").agg(F.max_by("c_custkey", full).alias("c_custkey"))


@query("win_latest_bulk_label", "SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY o_custkey")
def win_latest_bulk_label(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("o_orderkey"))


@query("win_ocr_overlap_regrade", f"{_O} SELECT chart, page_no, CASE WHEN tax < 0.01 THEN 'low' WHEN tax < 0.05 THEN CASE tag WHEN 'high' THEN 'medium' ELSE 'low' END ELSE tag END AS tag FROM (SELECT *, CASE WHEN confidence >= 0.7 THEN 'high' WHEN confidence >= 0.4 THEN 'medium' ELSE 'low' END AS tag FROM pages_o)")
def win_ocr_overlap_regrade(spark, sf):
    """A tag falls a level where two engines agree little, and to low where they hardly do."""
    tag = F.when(F.col("confidence") >= 0.7, "high").when(F.col("confidence") >= 0.4, "medium").otherwise("low")
    return order_pages(spark, sf).withColumn("t", tag).select("chart", "page_no", F.when(F.col("tax") < 0.01, "low").when(F.col("tax") < 0.05, F.when(F.col("t") == "high", "medium").otherwise("low")).otherwise(F.col("t")).alias("tag"))


@query("win_submission_order", "SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY (c_acctbal > 0) DESC, lower(c_name), c_name, c_custkey) AS position FROM customer")
def win_submission_order(spark, sf):
    w = Window.partitionBy("c_nationkey").orderBy((F.col("c_acctbal") > 0).desc(), F.lower("c_name"), "c_name", "c_custkey")
    return table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.row_number().over(w).cast("long").alias("position"))
