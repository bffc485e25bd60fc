"""Queries of model hooks, sources, sinks and incremental runs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from folioframe.functions import models as M
from folioframe.operators.shared import shared_folder
from folioframe.plans.base import ORDER_PAGES, PAGES, order_pages, pages, query, table, with_previous
from folioframe.sources import files, sinks
from folioframe.streaming import incremental as I


def _scratch(spark) -> str:
    """A new folder among those that driver and executors share."""
    return f"{shared_folder(spark)}/folioframe-{uuid.uuid4().hex}"


@query("udf_ocr_prelim", "SELECT page_id, md5(coalesce(html, '')) AS text FROM pages")
def udf_ocr_prelim(spark, sf):
    t = M.text_engine()(F.coalesce("html", F.lit("")).cast("binary"))
    return table(spark, sf, "pages").select("page_id", F.md5(t.cast("binary")).alias("text"))


for _n in ("udf_ocr_final1", "udf_ocr_final2"):
    query(_n, "SELECT page_id, md5(coalesce(html, '')) AS text FROM pages")(udf_ocr_prelim)


@query("udf_bert_pages")
def udf_bert_pages(spark, sf):
    return table(spark, sf, "documents").select("doc_id", M.scorer()("text").alias("p"))


for _n in ("udf_axes_model", "udf_encounter_model"):
    query(_n)(udf_bert_pages)


@query("udf_cross_encoder")
def udf_cross_encoder(spark, sf):
    p = with_previous(pages(spark, sf))
    return p.select("page_id", M.pair_scorer()("prev", "text").alias("score"))


@query("udf_quality", f"WITH {ORDER_PAGES} SELECT chart, page_no, round(100 * (confidence * 2 + least(1, tax * 10) + quantity / 50) / 4, 2)::DOUBLE AS quality FROM pages_o")
def udf_quality(spark, sf):
    return order_pages(spark, sf).select("chart", "page_no", M.quality([F.col("confidence"), F.col("tax") * 10, F.col("quantity") / 50], [2, 1, 1]).alias("quality"))


@query("udf_handwriting", f"WITH {ORDER_PAGES} SELECT chart, page_no, CASE WHEN confidence >= 0.8 THEN 'handwritten' WHEN confidence <= 0.2 THEN 'printed' ELSE 'unsure' END AS band FROM pages_o")
def udf_handwriting(spark, sf):
    return order_pages(spark, sf).select("chart", "page_no", M.handwriting_band(F.col("confidence")).alias("band"))


@query("bj_blank_image", "SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS size FROM pages")
def bj_blank_image(spark, sf):
    return table(spark, sf, "pages").select("page_id", M.image_facts()(F.coalesce("html", F.lit("")).cast("binary")).alias("f")).select("page_id", "f.size")


for _n in ("udf_rotation", "udf_osd", "udf_layout_headings"):
    query(_n, "SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS size FROM pages")(bj_blank_image)


@query("udf_ner", "SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[A-Z][a-z]+ [A-Z][a-z]+'))::BIGINT AS entities FROM documents")
def udf_ner(spark, sf):
    """Pairs of capitalised words stand in for a tagger's persons."""
    return table(spark, sf, "documents").select("doc_id", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[A-Z][a-z]+ [A-Z][a-z]+")).cast("long").alias("entities"))


@query("udf_minilm", "WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) SELECT a.vec_id, round(sum(a.x * b.x) / nullif(sqrt(sum(a.x * a.x)) * sqrt(sum(b.x * b.x)), 0), 4) AS cosine FROM e a JOIN e b ON b.vec_id = a.vec_id + 1 AND a.i = b.i GROUP BY a.vec_id")
def udf_minilm(spark, sf):
    """Cosine of each sentence vector with the next one's; the vectors stand for an encoder's answers."""
    e = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    j = e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("u")), "vec_id")
    return j.select("vec_id", F.round(F.try_divide(dot("v", "u"), F.sqrt(dot("v", "v")) * F.sqrt(dot("u", "u"))), 4).alias("cosine"))


@query("str_unicode_normalize")
def str_unicode_normalize(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(M.unicode_normal(F.col("text")).cast("binary")).alias("normal"))


@query("str_sequence_ratio")
def str_sequence_ratio(spark, sf):
    p = with_previous(pages(spark, sf))
    return p.select("page_id", M.sequence_ratio(F.split_part("prev", F.lit("\n"), F.lit(1)), F.split_part("text", F.lit("\n"), F.lit(1))).alias("ratio"))


@query("topk_max_span")
def topk_max_span(spark, sf):
    terms = F.array(*map(F.lit, ("of the", "the", "and the", "in", "the and")))
    return table(spark, sf, "documents").select("doc_id", F.size(M.longest_matches("text", terms)).cast("long").alias("spans"))


@query("scan_combined_ocr_txt", f"WITH {PAGES} SELECT chart, 'p' || page_no AS page_name, md5(regexp_replace(coalesce(text, ''), '\\s+$', '')) AS text FROM pages_a")
def scan_combined_ocr_txt(spark, sf):
    """Combined texts written and parsed back."""
    p = pages(spark, sf).withColumn("page_name", F.concat(F.lit("p"), F.col("page_no").cast("string")))
    got = files.parse_marked(sinks.combined_text(p).select(F.col("chart").alias("path"), "value"))
    return got.select(F.col("path").alias("chart"), "page_name", F.md5(F.col("text").cast("binary")).alias("text"))


query("sink_ocr_files", f"WITH {PAGES} SELECT chart, 'p' || page_no AS page_name, md5(regexp_replace(coalesce(text, ''), '\\s+$', '')) AS text FROM pages_a")(scan_combined_ocr_txt)


@query("scan_ocr_json", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'c' || doc_id ELSE 'plain' END AS text FROM documents")
def scan_ocr_json(spark, sf):
    raw = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit('{"markdown": "c'), F.col("doc_id").cast("string"), F.lit('"}'))).otherwise("plain")
    return table(spark, sf, "documents").select("doc_id", files.unwrap(raw).alias("text"))


@query("scan_local_images", "SELECT n_nationkey AS id, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS place FROM nation")
def scan_local_images(spark, sf):
    """Natural order of page names in a folder: page2 before page10."""
    from pyspark.sql import Window

    n = table(spark, sf, "nation").withColumn("path", F.concat(F.lit("a/page"), F.col("n_nationkey").cast("string"), F.lit(".jpg")))
    return n.select(F.col("n_nationkey").alias("id"), F.row_number().over(Window.partitionBy("n_regionkey").orderBy(*files.natural_key(F.col("path")))).cast("long").alias("place"))


@query("scan_ocr_reuse", "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'workspace' WHEN c_custkey % 2 = 0 THEN 'output' ELSE 'db' END AS origin FROM customer")
def scan_ocr_reuse(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    return files.reuse([c.where("id % 3 = 0").withColumn("origin", F.lit("workspace")), c.where("id % 2 = 0").withColumn("origin", F.lit("output")), c.withColumn("origin", F.lit("db"))], ["id"])


@query("scan_folder_find", "SELECT n_name AS name, 'root/' || lower(n_name) AS folder FROM nation")
def scan_folder_find(spark, sf):
    n = table(spark, sf, "nation")
    listing = n.select(F.concat(F.lit("root/"), F.lower("n_name"), F.lit("/x.jpg")).alias("path"))
    return files.find_folders(listing, n.select(F.col("n_name").alias("name")))


@query("scan_manifest_csv_xlsx", "SELECT c_custkey::VARCHAR AS id, c_name AS name FROM customer")
def scan_manifest_csv_xlsx(spark, sf):
    """A roster written as CSV under other headers, read back through the synonyms."""
    at = _scratch(spark)
    table(spark, sf, "customer").select(F.col("c_custkey").alias("Member ID"), F.col("c_name").alias("Member_Name")).write.option("header", "true").csv(at)
    return files.sheet(spark, at, {"id": ("memberid",), "name": ("membername",)})


for _n in ("scan_ground_truth_table", "maint_load_manifests"):
    query(_n, "SELECT c_custkey::VARCHAR AS id, c_name AS name FROM customer")(scan_manifest_csv_xlsx)


@query("scan_training_jsonl", "SELECT doc_id, toxic FROM labels")
def scan_training_jsonl(spark, sf):
    at = _scratch(spark)
    rows = table(spark, sf, "labels").select(F.to_json(F.struct("doc_id", "toxic")).alias("value"))
    rows.union(rows.limit(1).select(F.lit("{broken").alias("value"))).write.text(at)
    good, _ = files.labelled_jsonl(spark, at, "doc_id long, toxic int")
    return good


def _per_chart(spark, sf, fmt, **options):
    """All charts, partitioned by chart, written twice: the second run replaces what it has and leaves the rest. All are read
    back from the same format."""
    at = _scratch(spark)
    p = order_pages(spark, sf).select("chart", "page_no", "kind").repartition("chart")
    sinks.by_chart(p, at, fmt, **options)
    sinks.by_chart(p.where("chart % 100 = 1"), at, fmt, **options)
    back = spark.read.schema("page_no long, kind string, chart long").options(**options).format(fmt).load(at)
    return back.select("chart", "page_no", "kind")


@query("sink_csv_per_chart", f"WITH {ORDER_PAGES} SELECT chart, page_no, kind FROM pages_o")
def sink_csv_per_chart(spark, sf):
    """A CSV folder a chart."""
    return _per_chart(spark, sf, "csv", header=True)


@query("sink_staging_json", f"WITH {ORDER_PAGES} SELECT chart, page_no, kind FROM pages_o")
def sink_staging_json(spark, sf):
    """A folder of JSON lines a chart."""
    return _per_chart(spark, sf, "json")


@query("sink_export_chart", "SELECT o_orderkey::VARCHAR AS path FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 2 = 1 AND o_totalprice > 100000")
def sink_export_chart(spark, sf):
    s = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("path"), F.col("o_totalprice").alias("length"), F.col("o_orderdate").alias("modified"))
    k = F.col("path").cast("long")
    there = s.where(~((k % 3 == 0) | ((k % 2 == 1) & (F.col("length") > 100000)))).union(s.where(k % 3 == 0).withColumn("length", F.col("length") + 1))
    return sinks.new_files(s, there).select("path")


@query("sink_annotation_csv", "SELECT c_custkey AS id, CASE WHEN c_custkey % 10 = 0 THEN 'checked' ELSE c_mktsegment END AS value FROM customer")
def sink_annotation_csv(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("value"))
    return sinks.annotate(c, c.where("id % 10 = 0").withColumn("value", F.lit("checked")), ["id"])


@query("sink_db_copy", "SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1")
def sink_db_copy(spark, sf):
    at = _scratch(spark)
    sinks.copy_tables(spark, sf, at, ["nation"], "n_regionkey = 1")
    return spark.read.parquet(f"{at}/nation.parquet").select("n_nationkey", "n_name")


_SESS = "s AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS n FROM events), g AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS grp FROM s)"


@query("stream_sessions", f"WITH {_SESS} SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS events FROM g GROUP BY user_id, grp")
def stream_sessions(spark, sf):
    s = I.sessions(table(spark, sf, "events"))
    return s.select("user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "events")


@query("stream_hopping", "WITH w AS (SELECT event_type, unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS start FROM events) SELECT event_type, strftime(start, '%Y-%m-%d %H:%M:%S') AS start, count(*) AS events FROM w GROUP BY ALL")
def stream_hopping(spark, sf):
    return I.hopping(table(spark, sf, "events")).select("event_type", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "events")


@query("stream_intake", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def stream_intake(spark, sf):
    """Files that arrive, merged by key in micro-batches: the second batch brings new orders and changed ones."""
    at = _scratch(spark)
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    changed = o.where("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("X"))
    for batch in (o.where("o_orderkey % 5 <> 0"), changed.unionByName(o.where("o_orderkey % 5 = 0 and o_orderkey % 3 <> 0"))):
        batch.repartition(2).write.mode("append").parquet(f"{at}/in")
        I.intake(spark, f"{at}/in", o.schema, f"{at}/table", f"{at}/checkpoint", ["o_orderkey"], "o_orderdate")
    return spark.read.parquet(f"{at}/table/v=1").select("o_orderkey", "o_orderstatus")


def _files(spark, sf):
    """A listing of page files: parts as pages of a chart a brand."""
    p = table(spark, sf, "part")
    ext = F.when(F.col("p_partkey") % 9 == 0, ".txt").otherwise(".jpg")
    path = F.concat(F.lit("store/in/"), F.col("p_brand"), F.lit("/p"), F.col("p_partkey").cast("string"), ext)
    return p.select(path.alias("path"), F.col("p_brand").alias("chart"), F.col("p_partkey").alias("length")).where(F.lower("path").rlike(r"\.(jpg|jpeg|png|tif|tiff)$"))


@query("scan_blob_images", "SELECT 'store/in/' || p_brand || '/p' || p_partkey || '.jpg' AS path, p_brand AS chart FROM part WHERE p_partkey % 9 <> 0")
def scan_blob_images(spark, sf):
    return _files(spark, sf).select("path", "chart")


@query("scan_blob_chart_prefixes", "SELECT DISTINCT p_brand AS chart FROM part WHERE p_partkey % 9 <> 0")
def scan_blob_chart_prefixes(spark, sf):
    return _files(spark, sf).select(F.element_at(F.split("path", "/"), -2).alias("chart")).distinct()


@query("scan_local_chart_folders", "SELECT p_brand AS chart, count(*) AS pages FROM part WHERE p_partkey % 9 <> 0 GROUP BY 1")
def scan_local_chart_folders(spark, sf):
    return files.charts(_files(spark, sf))


@query("scan_metadata_csvs", "SELECT c_custkey::VARCHAR AS id, 'Run' || (c_custkey % 2 + 1) AS run_id, 'Batch7' AS batch_id FROM customer WHERE c_nationkey = 3")
def scan_metadata_csvs(spark, sf):
    """Sheets of several runs, the run and batch out of their names, extra sheets left out."""
    at = _scratch(spark)
    c = table(spark, sf, "customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("id"))
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    for name, part in (("metadata_R1_B7.csv", c.where("id % 2 = 0")), ("metadata_R2_B7.csv", c.where("id % 2 = 1")), ("metadata_extra_R9_B9.csv", c)):
        part.coalesce(1).write.option("header", "true").csv(f"{at}/tmp/{name}")
        root = fs.Path(f"{at}/tmp/{name}")
        store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        one = [f.getPath() for f in store.listStatus(root) if f.getPath().getName().startswith("part-")][0]
        store.mkdirs(fs.Path(f"{at}/csv"))
        store.rename(one, fs.Path(f"{at}/csv/{name}"))
    return files.metadata(spark, f"{at}/csv").select("id", "run_id", "batch_id")


@query("sink_export_csv_stream", "SELECT 0::BIGINT AS n, 'n_nationkey,n_name' AS line UNION ALL SELECT n_nationkey + 1, n_nationkey || ',' || n_name FROM nation")
def sink_export_csv_stream(spark, sf):
    n = table(spark, sf, "nation").select("n_nationkey", "n_name").orderBy("n_nationkey")
    return spark.createDataFrame(list(enumerate(sinks.csv_lines(n))), "n long, line string")


@query("sink_excel_report", "SELECT 'summary' AS sheet, count(*) AS rows FROM nation UNION ALL SELECT 'regions', count(*) FROM region")
def sink_excel_report(spark, sf):
    """What goes on each sheet of a report; sinks.workbook() writes it where an Excel writer is installed."""
    n = table(spark, sf, "nation").agg(F.lit("summary").alias("sheet"), F.count("*").alias("rows"))
    return n.union(table(spark, sf, "region").agg(F.lit("regions"), F.count("*")))


@query("filter_only_through", "SELECT * FROM (VALUES (1, 'ocr'), (2, 'classify')) v(seq, stage)")
def filter_only_through(spark, sf):
    """The stage chain up to one stage, and of these only those named."""
    from folioframe.plans.base import STAGES

    through, only = "sequence", {"ocr", "classify", "final"}
    chosen = [(i, s) for i, s in enumerate(STAGES) if i <= STAGES.index(through) and s in only]
    return spark.createDataFrame(chosen, "seq int, stage string")


@query("topk_mined_per_class", "WITH g AS (SELECT DISTINCT doc_id, lang, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]+')) AS phrase FROM documents), s AS (SELECT phrase, lang, count(*) AS k FROM g GROUP BY ALL), e AS (SELECT phrase, sum(k)::BIGINT AS n FROM s GROUP BY phrase HAVING sum(k) >= 20), j AS (SELECT s.lang, s.phrase, round(round(k / n::DOUBLE, 6) * ln(1 + k), 6) AS score FROM s JOIN e USING (phrase)), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, phrase) AS place FROM j) SELECT lang, phrase, place FROM r WHERE place <= 3")
def topk_mined_per_class(spark, sf):
    from folioframe.functions import strings as S
    from folioframe.operators import rules as R

    d = table(spark, sf, "documents")
    return R.keyword_mining(d, "lang", S.words(F.col("text")), 20, 3).select("lang", "phrase", "place")


@query("pt_annotation_store", f"WITH {ORDER_PAGES}, l AS (SELECT chart, page_no, CASE WHEN part % 3 = 0 THEN 'undone' WHEN part % 3 = 1 THEN kind END AS label FROM pages_o) SELECT chart, page_no, nullif(label, 'undone') AS label, nullif(label, 'undone') IS NULL AS queued FROM l")
def pt_annotation_store(spark, sf):
    """The label store as an append log: the last entry of a page counts, an undo clears it, pages without a label are the work queue."""
    from folioframe.operators.merge import last_wins

    p = order_pages(spark, sf)
    log = p.where("part % 3 <> 2").select("chart", "page_no", F.lit(1).alias("n"), F.col("kind").alias("label")).union(p.where("part % 3 = 0").select("chart", "page_no", F.lit(2), F.lit(None).cast("string")))
    now = last_wins(log, [F.col("chart"), F.col("page_no")], [F.col("n")])
    return p.select("chart", "page_no").join(now, ["chart", "page_no"], "left").select("chart", "page_no", "label", F.col("label").isNull().alias("queued"))


@query("inc_progress", "WITH s AS (SELECT user_id AS chart, count(*) AS total, count(*) FILTER (WHERE value > 50) AS done FROM events GROUP BY 1) SELECT chart, done, total, done || '/' || total AS progress FROM s")
def inc_progress(spark, sf):
    g = table(spark, sf, "events").groupBy(F.col("user_id").alias("chart")).agg(F.count_if(F.col("value") > 50).alias("done"), F.count("*").alias("total"))
    return g.withColumn("progress", F.concat(F.col("done").cast("string"), F.lit("/"), F.col("total").cast("string")))


@query("inc_jobs_lease", """WITH RECURSIVE a AS (SELECT user_id AS job, event_id AS ask, event_type AS worker, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
l AS (SELECT job, ask, worker, us, rn, worker AS holder, us + 600000000 AS until, 'claimed' AS outcome FROM a WHERE rn = 1
UNION ALL SELECT job, ask, worker, us, rn, CASE WHEN free THEN worker ELSE holder END, CASE WHEN free OR worker = holder THEN us + 600000000 ELSE until END, CASE WHEN free THEN 'claimed' WHEN worker = holder THEN 'renewed' ELSE 'refused' END
FROM (SELECT a.*, l.holder, l.until, a.us >= l.until AS free FROM l JOIN a ON a.job = l.job AND a.rn = l.rn + 1)) SELECT job, ask, worker, outcome, until - us AS remaining FROM l""")
def inc_jobs_lease(spark, sf):
    """Claims, heartbeats and refusals: a user is a job, an event type the worker that asks for it."""
    e = table(spark, sf, "events")
    asks = e.select(F.col("user_id").alias("job"), F.col("event_id").alias("ask"), F.col("event_type").alias("worker"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    return I.leases(asks).select("job", "ask", "worker", "outcome", "remaining")


@query("inc_report_cache", "SELECT 'built' AS state, count(*) AS rows FROM region UNION ALL SELECT 'kept', count(*) FROM region")
def inc_report_cache(spark, sf):
    """A report that is built once a version: the second request takes what is kept."""
    cache, built = I.ReportCache(), []
    r = table(spark, sf, "region")
    version = r.agg(F.count("*").alias("n"), F.max("r_regionkey").alias("m"))

    def build():
        built.append(1)
        return r.count()

    rows = [("built", cache.get("x", version, build)), ("kept", cache.get("x", version, build))]
    assert len(built) == 1
    return spark.createDataFrame(rows, "state string, rows long")


@query("inc_hot_reload_canon", "SELECT * FROM (VALUES ('first', 1), ('changed', 2), ('broken', 2)) v(step, value)")
def inc_hot_reload_canon(spark, sf):
    """A rule file that is read again when it changes; a broken version leaves the last good one. Rule files are the driver's."""
    import os

    with tempfile.TemporaryDirectory() as d:
        path, out = os.path.join(d, "rules.json"), []
        rules = I.RuleFile(path)
        for i, (step, text) in enumerate((("first", '{"v": 1}'), ("changed", '{"v": 2}'), ("broken", "{"))):
            with open(path, "w") as f:
                f.write(text)
            os.utime(path, ns=(i, i))
            out.append((step, rules.get()["v"]))
    return spark.createDataFrame(out, "step string, value int")


@query("maint_capabilities")
def maint_capabilities(spark, sf):
    """Optional features and whether what they need is there."""
    import importlib.util

    need = {"workbook": "openpyxl", "xlsx rosters": "openpyxl", "onnx models": "onnxruntime", "fast automaton": "ahocorasick"}
    return spark.createDataFrame([(k, m, importlib.util.find_spec(m) is not None) for k, m in need.items()], "feature string, module string, usable boolean")


@query("maint_reset_rerun", f"WITH {ORDER_PAGES} SELECT chart, page_no, CASE WHEN chart % 4 = 0 THEN 'pending' ELSE kind END AS state FROM pages_o")
def maint_reset_rerun(spark, sf):
    """Charts that are wiped start again as pending; others stay."""
    p = order_pages(spark, sf)
    wiped = p.where("chart % 4 = 0").select("chart", "page_no", F.lit("pending").alias("state"))
    return p.where("chart % 4 <> 0").select("chart", "page_no", F.col("kind").alias("state")).unionByName(wiped)
