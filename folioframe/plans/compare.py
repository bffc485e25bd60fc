"""Queries of merges, comparison and accuracy."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioframe.operators import compare as C
from folioframe.operators import merge as M
from folioframe.plans.base import ORDER_PAGES, order_pages, query, table

#: Ground truth and system sheets: orders by even and by multiple-of-three keys, whose status the system misreads at times.
_SHEETS = """g AS (SELECT o_orderkey AS id, o_orderstatus AS status, o_orderpriority AS priority, o_orderdate::DATE::VARCHAR AS day FROM orders WHERE o_orderkey % 2 = 0),
s AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE lower(o_orderstatus) || ' ' END AS status, o_orderpriority AS priority, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE strftime(o_orderdate, '%m/%d/%Y') END AS day FROM orders WHERE o_orderkey % 3 <> 1),
j AS (SELECT coalesce(g.id, s.id) AS id, g.id AS gid, s.id AS sid, g.status AS gs, s.status AS ss, g.priority AS gp, s.priority AS sp, g.day AS gd, s.day AS sd FROM g FULL JOIN s ON g.id = s.id),
r AS (SELECT *, CASE WHEN sid IS NULL THEN 'missing' WHEN gid IS NULL THEN 'extra' ELSE 'matched' END AS match, lower(trim(gs)) IS NOT DISTINCT FROM lower(trim(ss)) AS ok_status, gp IS NOT DISTINCT FROM sp AS ok_priority, coalesce(gd = CASE WHEN sd = '' THEN '' ELSE strftime(strptime(nullif(sd, ''), '%m/%d/%Y'), '%Y-%m-%d') END, false) AS ok_day FROM j),
t AS (SELECT *, CASE match WHEN 'missing' THEN 'MISSING' WHEN 'extra' THEN 'EXTRA' ELSE CASE WHEN ok_status AND ok_priority AND ok_day THEN 'CORRECT' ELSE 'ERROR' END END AS status_out FROM r)"""


def _sheets(spark, sf):
    o = table(spark, sf, "orders")
    day = F.col("o_orderdate").cast("date")
    ground = o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), day.cast("string").alias("day"))
    status = F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.concat(F.lower("o_orderstatus"), F.lit(" ")))
    system = o.where("o_orderkey % 3 <> 1").select(F.col("o_orderkey").alias("id"), status.alias("status"), F.col("o_orderpriority").alias("priority"), F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(F.date_format(day, "MM/dd/yyyy")).alias("day"))
    return ground, system


def _compared(spark, sf):
    m = M.match_records(*_sheets(spark, sf), ["id"]).withColumnRenamed("status", "match")
    both = F.col("match") == "matched"
    kinds = {"status": "text", "priority": "text", "day": "date"}
    m = m.withColumns({f"r_{c}": F.when(both, C.field_result(F.col(f"ground.{c}"), F.col(f"system.{c}"), k)) for c, k in kinds.items()})
    return m.withColumn("status", C.record_status({c: F.col(f"r_{c}") for c in kinds}, F.col("match")))


@query("join_match_records", f"WITH {_SHEETS} SELECT id, match AS status FROM r")
def join_match_records(spark, sf):
    return M.match_records(*_sheets(spark, sf), ["id"]).select("id", "status")


@query("cmp_fields", f"WITH {_SHEETS} SELECT id, CASE WHEN ok_status THEN 'match' ELSE 'mismatch' END AS status, CASE WHEN ok_priority THEN 'match' ELSE 'mismatch' END AS priority, CASE WHEN ok_day THEN 'match' ELSE 'mismatch' END AS day FROM r WHERE match = 'matched'")
def cmp_fields(spark, sf):
    return _compared(spark, sf).where("match = 'matched'").select("id", F.col("r_status").alias("status"), F.col("r_priority").alias("priority"), F.col("r_day").alias("day"))


@query("cmp_status", f"WITH {_SHEETS} SELECT id, status_out AS status FROM t")
def cmp_status(spark, sf):
    return _compared(spark, sf).select("id", "status")


@query("cmp_resolve_fields", "SELECT * FROM (VALUES ('id', true), ('status', true), ('priority', true), ('day', true), ('clerk', false)) v(field, compared)")
def cmp_resolve_fields(spark, sf):
    """Fields that both sheets have are compared; the rest is exempt. Schemas are metadata, so the driver does it."""
    g, s = _sheets(spark, sf)
    g = g.withColumn("clerk", F.lit(None).cast("string"))
    return spark.createDataFrame([(c, c in s.columns) for c in g.columns], "field string, compared boolean")


_RATE = lambda n, d: f"round(100.0 * ({n}) / nullif(({d})::DOUBLE, 0), 2)"


@query("agg_compare_summary", f"WITH {_SHEETS}, c AS (SELECT count(*) FILTER (WHERE status_out = 'CORRECT') AS correct, count(*) FILTER (WHERE status_out = 'ERROR') AS error, count(*) FILTER (WHERE status_out = 'MISSING') AS missing, count(*) FILTER (WHERE status_out = 'EXTRA') AS extra FROM t) SELECT *, {_RATE('correct', 'correct + error + missing')} AS exact_match, {_RATE('correct', 'correct + error')} AS evaluated, {_RATE('extra', 'correct + error + extra')} AS extra_rate FROM c")
def agg_compare_summary(spark, sf):
    return C.summary(_compared(spark, sf))


_WRONG = f"{_SHEETS}, w AS (SELECT id, 'status' AS field, gs AS gt, ss AS algo FROM r WHERE match = 'matched' AND NOT ok_status UNION ALL SELECT id, 'day', gd, sd FROM r WHERE match = 'matched' AND NOT ok_day UNION ALL SELECT id, 'priority', gp, sp FROM r WHERE match = 'matched' AND NOT ok_priority)"


def _wrong(spark, sf):
    m = _compared(spark, sf).where("match = 'matched'")
    each = F.array(*(F.when(F.col(f"r_{c}") == "mismatch", F.struct(F.lit(c).alias("field"), F.col(f"ground.{c}").alias("gt"), F.col(f"system.{c}").alias("algo"))) for c in ("status", "priority", "day")))
    return m.select("id", F.explode(F.array_compact(each)).alias("e")).select("id", "e.*")


@query("agg_field_errors", f"WITH {_WRONG} SELECT field, count(*) AS errors FROM w GROUP BY field")
def agg_field_errors(spark, sf):
    return _wrong(spark, sf).groupBy("field").agg(F.count("*").alias("errors"))


@query("agg_mismatch_patterns", f"WITH {_WRONG} SELECT field, gt, algo, count(*) AS n, min(id) AS first_id FROM w GROUP BY field, gt, algo")
def agg_mismatch_patterns(spark, sf):
    return _wrong(spark, sf).groupBy("field", "gt", "algo").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


@query("agg_chart_rows", f"WITH {_SHEETS} SELECT id % 10 AS chart, count(*) FILTER (WHERE status_out = 'CORRECT') AS correct, count(*) FILTER (WHERE status_out = 'ERROR') AS error, count(*) FILTER (WHERE status_out = 'MISSING') AS missing, count(*) FILTER (WHERE status_out = 'EXTRA') AS extra, {_RATE("count(*) FILTER (WHERE status_out = 'CORRECT')", "count(*) FILTER (WHERE status_out IN ('CORRECT', 'ERROR'))")} AS rate FROM t GROUP BY 1")
def agg_chart_rows(spark, sf):
    n = lambda *s: F.count_if(F.col("status").isin(*s))
    g = _compared(spark, sf).groupBy((F.col("id") % 10).alias("chart"))
    return g.agg(n("CORRECT").alias("correct"), n("ERROR").alias("error"), n("MISSING").alias("missing"), n("EXTRA").alias("extra"), C.rate(n("CORRECT"), n("CORRECT", "ERROR")).alias("rate"))


_PRED = "p AS (SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN 'junk' WHEN l.quality = 0 THEN 'blank' ELSE 'main' END AS truth, CASE WHEN d.n_chars < 400 THEN 'blank' WHEN d.doc_id % 11 = 0 THEN 'junk' ELSE 'main' END AS pred FROM documents d JOIN labels l USING (doc_id)), cl AS (SELECT * FROM (VALUES ('main'), ('blank'), ('junk'), ('none')) v(label))"


def _pred(spark, sf):
    j = table(spark, sf, "documents").select("doc_id", "n_chars").join(table(spark, sf, "labels"), "doc_id")
    truth = F.when(F.col("toxic") == 1, "junk").when(F.col("quality") == 0, "blank").otherwise("main")
    return j.select("doc_id", truth.alias("truth"), F.when(F.col("n_chars") < 400, "blank").when(F.col("doc_id") % 11 == 0, "junk").otherwise("main").alias("pred"))


_CLASS = f"WITH {_PRED}, k AS (SELECT label, count(*) FILTER (WHERE truth = label AND pred = label) AS tp, count(*) FILTER (WHERE truth <> label AND pred = label) AS fp, count(*) FILTER (WHERE truth = label AND pred <> label) AS fn FROM cl CROSS JOIN p GROUP BY label) SELECT *, round(tp / nullif((tp + fp)::DOUBLE, 0), 4) AS precision, round(tp / nullif((tp + fn)::DOUBLE, 0), 4) AS recall, round(2 * tp / nullif((2 * tp + fp + fn)::DOUBLE, 0), 4) AS f1 FROM k"


def _classes(spark):
    return spark.createDataFrame([(x,) for x in ("main", "blank", "junk", "none")], "label string")


@query("agg_class_rates", _CLASS)
def agg_class_rates(spark, sf):
    return C.class_rates(_pred(spark, sf), _classes(spark))


@query("agg_stream_vote_train", f"WITH {_PRED} SELECT truth, pred, count(*) AS n, sum(count(*)) OVER (PARTITION BY truth)::BIGINT AS support FROM p GROUP BY truth, pred")
def agg_stream_vote_train(spark, sf):
    """The confusion matrix with each class's support."""
    from pyspark.sql import Window

    g = _pred(spark, sf).groupBy("truth", "pred").agg(F.count("*").alias("n"))
    return g.withColumn("support", F.sum("n").over(Window.partitionBy("truth")))


_SCORED = f"WITH {ORDER_PAGES}, v AS (SELECT kind AS stream, CASE WHEN tax = 0 THEN 'na' WHEN confidence >= 0.7 THEN 'yes' WHEN confidence >= 0.4 THEN 'maybe' ELSE 'no' END AS verdict FROM pages_o)"


@query("agg_accuracy_tally", _SCORED + " SELECT stream, count(*) FILTER (WHERE verdict = 'yes') AS yes, count(*) FILTER (WHERE verdict = 'maybe') AS maybe, count(*) FILTER (WHERE verdict = 'no') AS no, count(*) FILTER (WHERE verdict <> 'na') AS scored, round(sum(CASE verdict WHEN 'yes' THEN 1 WHEN 'maybe' THEN 0.5 ELSE 0 END) / nullif(count(*) FILTER (WHERE verdict <> 'na'), 0), 4)::DOUBLE AS score FROM v GROUP BY stream")
def agg_accuracy_tally(spark, sf):
    v = F.when(F.col("tax") == 0, "na").when(F.col("confidence") >= 0.7, "yes").when(F.col("confidence") >= 0.4, "maybe").otherwise("no")
    return C.tally(order_pages(spark, sf).select(F.col("kind").alias("stream"), v.alias("verdict")), "stream", "verdict")


_SEVEN = "(confidence > 0.1)::INT + (confidence > 0.3)::INT + (confidence > 0.5)::INT + (tax > 0.02)::INT + (tax > 0.05)::INT + (quantity > 10)::INT + (quantity > 30)::INT"


@query("agg_match_bands", f"WITH {ORDER_PAGES}, k AS (SELECT ({_SEVEN})::BIGINT AS matched FROM pages_o) SELECT matched, count(*) AS pages, CASE WHEN matched >= 5 THEN 'good' WHEN matched >= 3 THEN 'fair' ELSE 'bad' END AS band FROM k GROUP BY matched")
def agg_match_bands(spark, sf):
    p = order_pages(spark, sf)
    tests = [F.col("confidence") > x for x in (0.1, 0.3, 0.5)] + [F.col("tax") > 0.02, F.col("tax") > 0.05, F.col("quantity") > 10, F.col("quantity") > 30]
    return C.match_bands(p.select(*(t.alias(f"v{i}") for i, t in enumerate(tests))), [f"v{i}" for i in range(7)])


@query("acc_page_scores", f"WITH {ORDER_PAGES} SELECT chart, page_no, ({_SEVEN})::BIGINT AS matched, kind <> 'blank' AS type_ok, print = 'printed' AS print_ok FROM pages_o")
def acc_page_scores(spark, sf):
    p = order_pages(spark, sf)
    tests = [F.col("confidence") > x for x in (0.1, 0.3, 0.5)] + [F.col("tax") > 0.02, F.col("tax") > 0.05, F.col("quantity") > 10, F.col("quantity") > 30]
    return p.select("chart", "page_no", sum((t.cast("long") for t in tests), F.lit(0)).cast("long").alias("matched"), (F.col("kind") != "blank").alias("type_ok"), (F.col("print") == "printed").alias("print_ok"))


@query("agg_hierarchical_pr", f"WITH {ORDER_PAGES}, a AS (SELECT list_distinct([kind, kind || '>' || print]) AS g, list_distinct([kind, CASE WHEN tax > 0.04 THEN kind || '>printed' ELSE 'other' END]) AS p FROM pages_o), s AS (SELECT sum(len(list_intersect(g, p)))::DOUBLE AS s, sum(len(g))::DOUBLE AS g, sum(len(p))::DOUBLE AS p FROM a) SELECT round(s / p, 4) AS precision, round(s / g, 4) AS recall, round(2 * s / (g + p), 4) AS f1 FROM s")
def agg_hierarchical_pr(spark, sf):
    path = lambda k, x: F.array(k, F.concat(k, F.lit(">"), x))
    k = F.col("kind")
    rows = order_pages(spark, sf).select(path(k, F.col("print")).alias("g"), F.array(k, F.when(F.col("tax") > 0.04, F.concat(k, F.lit(">printed"))).otherwise("other")).alias("p"))
    return C.hierarchical(rows, "g", "p")


_TS = (0.0, 0.2, 0.4, 0.6, 0.8, 0.95)


@query("agg_threshold_sweep", f"WITH {ORDER_PAGES}, t AS (SELECT unnest([{', '.join(map(str, _TS))}])::DOUBLE AS threshold) SELECT threshold, round(count(*) FILTER (WHERE confidence >= threshold) / count(*)::DOUBLE, 4) AS coverage, round(count(*) FILTER (WHERE confidence >= threshold AND print = 'printed') / nullif(count(*) FILTER (WHERE confidence >= threshold)::DOUBLE, 0), 4) AS precision FROM t CROSS JOIN pages_o GROUP BY threshold")
def agg_threshold_sweep(spark, sf):
    return C.threshold_sweep(order_pages(spark, sf).select("confidence", (F.col("print") == "printed").alias("ok")), "confidence", "ok", list(_TS))


#: Merges of the roster with an update that misses a third of the rows, blanks some values and brings new ones.
_UPDATE = "o AS (SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_acctbal AS bal FROM customer WHERE c_custkey % 4 <> 0), n AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END AS name, CASE WHEN c_custkey % 3 = 0 THEN 'NEW' ELSE c_mktsegment END AS segment, c_acctbal AS bal FROM customer WHERE c_custkey % 3 <> 1)"


def _update(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("bal"))
    new = c.where("id % 3 <> 1").withColumns({"name": F.when(F.col("id") % 5 != 0, F.col("name")), "segment": F.when(F.col("id") % 3 == 0, "NEW").otherwise(F.col("segment"))})
    return c.where("id % 4 <> 0"), new


_J = "FROM o FULL JOIN n ON o.id = n.id"
_CHANGED = "(o.id IS NULL OR {}) AS changed"


@query("merge_upsert_chart", f"WITH {_UPDATE} SELECT coalesce(o.id, n.id) AS id, coalesce(n.name, o.name) AS name, coalesce(n.segment, o.segment) AS segment, coalesce(n.bal, o.bal) AS bal, " + _CHANGED.format("coalesce(n.segment, o.segment) IS DISTINCT FROM o.segment") + f" {_J}")
def merge_upsert_chart(spark, sf):
    return M.upsert(*_update(spark, sf), ["id"])


@query("merge_upsert_pages", f"WITH {_UPDATE} SELECT coalesce(o.id, n.id) AS id, coalesce(n.name, o.name) AS name, coalesce(o.segment, n.segment) AS segment, coalesce(n.bal, o.bal) AS bal, (o.id IS NULL) AS changed {_J}")
def merge_upsert_pages(spark, sf):
    return M.upsert(*_update(spark, sf), ["id"], keep_old=("segment",))


@query("merge_upsert_ground_truth", f"WITH {_UPDATE} SELECT coalesce(o.id, n.id) AS id, o.name, coalesce(n.segment, o.segment) AS segment, o.bal, " + _CHANGED.format("coalesce(n.segment, o.segment) IS DISTINCT FROM o.segment") + f" {_J}")
def merge_upsert_ground_truth(spark, sf):
    return M.upsert(*_update(spark, sf), ["id"], only=["segment"])


query("maint_load_sequence", f"WITH {_UPDATE} SELECT coalesce(o.id, n.id) AS id, o.name, coalesce(n.segment, o.segment) AS segment, o.bal, " + _CHANGED.format("coalesce(n.segment, o.segment) IS DISTINCT FROM o.segment") + f" {_J}")(merge_upsert_ground_truth)


@query("merge_upsert_results", f"WITH {_UPDATE} SELECT coalesce(n.id, o.id) AS id, CASE WHEN n.id IS NULL THEN o.segment ELSE n.segment END AS segment {_J}")
def merge_upsert_results(spark, sf):
    """One row a key: the new run's row replaces the old one whole."""
    old, new = _update(spark, sf)
    return old.join(new, "id", "left_anti").select("id", "segment").unionByName(new.select("id", "segment"))


@query("merge_upsert_manifest", "WITH m AS (SELECT c_custkey AS id, c_nationkey || '|' || CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'id' || (c_custkey % 5) END AS conflict_key, c_acctbal AS bal FROM customer) SELECT conflict_key, arg_max(id, id) AS id, arg_max(bal, id) AS bal FROM m GROUP BY conflict_key")
def merge_upsert_manifest(spark, sf):
    """Two alternative keys as one derived key; of a batch's rows with one key the last stays."""
    c = table(spark, sf, "customer")
    key = F.concat_ws("|", F.col("c_nationkey").cast("string"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise(F.concat(F.lit("id"), (F.col("c_custkey") % 5).cast("string"))))
    rows = c.select(F.col("c_custkey").alias("id"), key.alias("conflict_key"), F.col("c_acctbal").alias("bal"))
    return M.last_wins(rows, [F.col("conflict_key")], [F.col("id")]).select("conflict_key", "id", "bal")


@query("merge_jsonl_last_wins", "SELECT source, md5(text) AS key, max(doc_id) AS doc_id FROM documents GROUP BY source, md5(text)")
def merge_jsonl_last_wins(spark, sf):
    """Records of one key in several files: the later file's stays. The greatest place by aggregation; no window over a hot key."""
    d = table(spark, sf, "documents").select("source", F.md5(F.col("text").cast("binary")).alias("key"), "doc_id")
    return d.groupBy("source", "key").agg(F.max("doc_id").alias("doc_id"))


@query("agg_jsonl_merge_report", "WITH k AS (SELECT md5(text) AS key, count(*) AS n, count(DISTINCT lang) AS langs FROM documents GROUP BY 1) SELECT count(*) AS kept, sum(n - 1)::BIGINT AS replaced, count(*) FILTER (WHERE langs > 1) AS label_changed FROM k")
def agg_jsonl_merge_report(spark, sf):
    k = table(spark, sf, "documents").groupBy(F.md5(F.col("text").cast("binary")).alias("key")).agg(F.count("*").alias("n"), F.countDistinct("lang").alias("langs"))
    return k.agg(F.count("*").alias("kept"), F.sum(F.col("n") - 1).alias("replaced"), F.count_if(F.col("langs") > 1).alias("label_changed"))


@query("merge_encounter_review_replace", "SELECT o_orderkey AS id, CASE WHEN o_custkey % 3 = 0 THEN 'reviewed' ELSE o_orderstatus END AS status FROM orders")
def merge_encounter_review_replace(spark, sf):
    """All rows of the reviewed charts are replaced, others stay."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("chart"), F.col("o_orderstatus").alias("status"))
    new = o.where("chart % 3 = 0").withColumn("status", F.lit("reviewed"))
    return o.join(new.select("chart").distinct(), "chart", "left_anti").select("id", "status").unionByName(new.select("id", "status"))


@query("merge_delete_chart", "SELECT o_orderkey AS id, 'kept' AS what FROM orders WHERE o_custkey % 5 <> 0 UNION ALL SELECT DISTINCT o_custkey, 'audit' FROM orders WHERE o_custkey % 5 = 0")
def merge_delete_chart(spark, sf):
    """Rows without those of deleted charts, and an audit row for each of these."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("chart"))
    gone = o.where("chart % 5 = 0").select("chart").distinct()
    return o.join(gone, "chart", "left_anti").select("id", F.lit("kept").alias("what")).union(gone.select("chart", F.lit("audit")))


@query("set_diff_runs", f"WITH {_UPDATE} SELECT coalesce(o.id, n.id) AS id, CASE WHEN n.segment IS NULL THEN 'only_a' WHEN o.segment IS NULL THEN 'only_b' WHEN o.segment = n.segment THEN 'same' ELSE 'changed' END AS status {_J}")
def set_diff_runs(spark, sf):
    return M.diff_runs(*_update(spark, sf), ["id"], "segment").select("id", "status")


@query("filter_restrict_to_ground", f"WITH {_SHEETS} SELECT id FROM s WHERE id IN (SELECT id FROM g)")
def filter_restrict_to_ground(spark, sf):
    g, s = _sheets(spark, sf)
    return s.join(g, "id", "left_semi").select("id")


@query("inc_ndjson_compare", f"WITH {_SHEETS} SELECT id % 10 AS chart, count(*) AS records, count(*) FILTER (WHERE status_out = 'CORRECT') AS correct FROM t GROUP BY 1")
def inc_ndjson_compare(spark, sf):
    """One result line a chart, for toLocalIterator() or foreachBatch()."""
    return _compared(spark, sf).groupBy((F.col("id") % 10).alias("chart")).agg(F.count("*").alias("records"), F.count_if(F.col("status") == "CORRECT").alias("correct"))
