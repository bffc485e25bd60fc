"""Queries of the date, number, JSON, array and map functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from folioframe.functions import dates as D
from folioframe.functions import numbers as N
from folioframe.plans.base import ORDER_PAGES, order_pages, query, table

_O = f"WITH {ORDER_PAGES} SELECT chart, page_no, "


def _o(name, sql, build, where=None):
    @query(name, _O + sql + " FROM pages_o" + (f" WHERE {where}" if where else ""))
    def run(spark, sf):
        p = order_pages(spark, sf)
        return (p.where(where) if where else p).select("chart", "page_no", *build(_Values()))


class _Values:
    """Columns of an order page, made once a session is there."""

    @property
    def dos(self):
        return F.col("dos")

    @property
    def conf(self):
        return F.col("confidence")

    @property
    def tax(self):
        return F.col("tax")

    @property
    def iso(self):
        return self.dos.cast("string")

    @property
    def words(self):
        return F.concat(F.date_format("dos", "MMMM"), F.lit(" "), F.day("dos").cast("string"), F.lit(", "), F.year("dos").cast("string"))

    @property
    def any(self):
        mdy = F.concat(F.month("dos").cast("string"), F.lit("/"), F.day("dos").cast("string"), F.lit("/"), F.substring(self.iso, 3, 2))
        kind = F.col("page_no") % 4
        return F.when(kind == 0, self.iso).when(kind == 1, mdy).when(kind == 2, self.words).otherwise("13/45/2020")


_ANY = "CASE page_no % 4 WHEN 3 THEN NULL ELSE dos::VARCHAR END"

_o("date_parse_any", f"{_ANY} AS parsed", lambda v: [D.parse_any(F.concat(F.lit("seen "), v.any, F.lit(" there"))).cast("string").alias("parsed")])
_o("date_canonical", "CASE page_no % 4 WHEN 3 THEN '13/45/2020' ELSE dos::VARCHAR END AS canonical", lambda v: [D.canonical(v.any).alias("canonical")])
_o("date_find", "2::BIGINT AS n, dos::VARCHAR AS first", lambda v: [F.size(f := D.find(F.concat(F.lit("a "), v.iso, F.lit(", b 1/2/03 c 4.5")))).cast("long").alias("n"), F.get(f, F.lit(0)).alias("first")])
_o("date_range_end", "CASE WHEN page_no % 2 = 0 THEN (dos + 3)::VARCHAR END AS ends", lambda v: [D.range_end(F.concat(F.lit("stay "), v.iso, F.lit(" thru "), F.when(F.col("page_no") % 2 == 0, F.date_add("dos", 3)).otherwise(F.date_add("dos", -3)).cast("string"))).cast("string").alias("ends")])
_o("date_edge_label", "CASE WHEN page_no % 3 = 0 THEN dos::VARCHAR END AS dos", lambda v: [D.edge_labelled(F.when(F.col("page_no") % 3 == 0, F.concat(F.lit("Header line Date of Service: "), v.iso, F.lit(" and more"))).otherwise(F.concat(F.lit("seen on "), v.iso))).cast("string").alias("dos")])
_o("date_print_stamps", "dos::VARCHAR AS printed, CASE WHEN page_no % 2 = 0 THEN 0 ELSE 1 END::BIGINT AS others", lambda v: [F.array_join(s := D.print_stamps(F.concat(F.lit("Printed on: "), v.iso, F.lit(" seen "), _other())), ",").alias("printed"), F.size(F.array_except(F.transform(D.find(F.concat(v.iso, F.lit(" "), _other())), lambda z: D.parse_any(z).cast("string")), s)).cast("long").alias("others")])
_o("date_dob_match", "page_no % 3 <> 2 AS found", lambda v: [D.dob_match(F.when(F.col("page_no") % 3 == 0, F.concat(F.lit("born "), v.words, F.lit(" in"))).when(F.col("page_no") % 3 == 1, F.concat(F.lit("dob "), F.date_format("dos", "d.M.yyyy"))).otherwise("no date 1 2 3 here"), v.dos).alias("found")])
_o("date_show_iso", "CASE page_no % 4 WHEN 3 THEN '13/45/2020' ELSE dos::VARCHAR END AS shown, strftime(dos, '%m/%d/%Y') AS display", lambda v: [D.show_iso(v.any).alias("shown"), F.date_format("dos", "MM/dd/yyyy").alias("display")])
_o("date_default_sentinel", "CASE WHEN page_no % 5 = 0 THEN NULL ELSE dos::VARCHAR END AS known, coalesce(CASE WHEN page_no % 5 = 0 THEN NULL ELSE dos END, DATE '2222-02-02')::VARCHAR AS stored", lambda v: [D.known(s := F.coalesce(F.when(F.col("page_no") % 5 != 0, v.dos), F.lit(D.NO_DATE).cast("date"))).cast("string").alias("known"), s.cast("string").alias("stored")])


def _other():
    return F.when(F.col("page_no") % 2 == 0, F.col("dos")).otherwise(F.date_add("dos", 1)).cast("string")


@query("date_stay", f"WITH {ORDER_PAGES} SELECT chart, coalesce(min(dos) FILTER (WHERE kind = 'main'), min(dos))::VARCHAR AS admitted, coalesce(max(dos) FILTER (WHERE kind = 'junk'), max(dos))::VARCHAR AS discharged FROM pages_o GROUP BY chart")
def date_stay(spark, sf):
    """Admission from admit labels and discharge from discharge labels; any label fills a missing side."""
    g = order_pages(spark, sf).groupBy("chart")
    first = F.coalesce(F.min(F.when(F.col("kind") == "main", F.col("dos"))), F.min("dos"))
    last = F.coalesce(F.max(F.when(F.col("kind") == "junk", F.col("dos"))), F.max("dos"))
    return g.agg(first.cast("string").alias("admitted"), last.cast("string").alias("discharged"))


@query("date_dictation", _O + "CASE WHEN page_no % 3 = 0 THEN dos WHEN page_no % 3 = 1 THEN dos + 1 END::VARCHAR AS dos FROM pages_o")
def date_dictation(spark, sf):
    """The dictation date, else the transcription date."""
    v = _Values()
    text = F.when(F.col("page_no") % 3 == 0, F.concat(F.lit("Transcribed: "), F.date_add("dos", 1).cast("string"), F.lit(" Dictated: "), v.iso)).when(F.col("page_no") % 3 == 1, F.concat(F.lit("transcribed on "), F.date_add("dos", 1).cast("string"))).otherwise(v.iso)
    said = lambda word: D.parse_any(F.regexp_extract(text, rf"(?i)\b{word}\b[^\d\n]{{0,20}}({D.ANY})", 1))
    return order_pages(spark, sf).select("chart", "page_no", F.coalesce(said("dictated"), said("transcribed")).cast("string").alias("dos"))


_o("num_orientation_bucket", "((floor((quantity * 8 + 45) / 90) * 90)::INT % 360)::INT AS bucket", lambda v: [N.orientation_bucket(F.col("quantity") * 8).alias("bucket")])
_o("num_quality_label", "CASE WHEN print = 'handwritten' AND confidence >= 0.70 THEN 'medium' WHEN confidence >= 0.70 THEN 'high' WHEN confidence >= 0.40 THEN 'medium' ELSE 'low' END AS label", lambda v: [N.quality_label(v.conf, F.col("print") == "handwritten").alias("label")])
_o("num_conf_backed", "round(confidence + (1 - confidence) * 0.5 * tax * 10, 6) AS backed", lambda v: [F.round(N.backed(v.conf, v.tax * 10), 6).alias("backed")])
_o("num_conf_score", "round(greatest(0, least(1, confidence * CASE kind WHEN 'junk' THEN 0.8 WHEN 'blank' THEN 0.9 * 0.75 ELSE 1 END)), 4)::DOUBLE AS score", lambda v: [N.score(v.conf, F.when(F.col("kind") == "junk", F.array(F.lit("conflict"), F.lit("conflict"))).when(F.col("kind") == "blank", F.array(F.lit("weak_text"), F.lit("fallback"))).otherwise(F.array(F.lit("unknown")))).alias("score")])
_o("num_conf_under_bar", "round(confidence / 0.7 * 0.49, 4)::DOUBLE AS score", lambda v: [N.under_bar(v.conf, 0.7).alias("score")])
_o("num_conf_absent", "CASE WHEN page_no % 2 = 0 THEN round(1 - greatest(confidence, tax), 6) ELSE 0.85 END::DOUBLE AS score", lambda v: [F.round(N.absent(F.when(F.col("page_no") % 2 == 0, F.array("confidence", "tax"))), 6).alias("score")])
_o("num_conf_band", "CASE WHEN confidence >= 0.8 THEN 'good' WHEN confidence >= 0.5 THEN 'passable' ELSE 'review' END AS band", lambda v: [N.band(v.conf).alias("band")])
_o("num_similarity_confidence", "round(CASE WHEN confidence >= 0.95 THEN pow(0.5, (confidence - 0.95) / 0.05 + 1) WHEN confidence <= 0.8 THEN 1 ELSE 1 - (confidence - 0.8) / 0.15 * 0.5 END, 6)::DOUBLE AS score", lambda v: [F.round(N.similarity_confidence(v.conf), 6).alias("score")])
_o("num_ramp", "round(CASE WHEN quantity <= 10 THEN 0.2 WHEN quantity >= 40 THEN 0.9 ELSE 0.2 + (quantity - 10) * (0.9 - 0.2) / (40.0 - 10.0) END, 6)::DOUBLE AS y", lambda v: [F.round(N.ramp(F.col("quantity"), 10.0, 0.2, 40.0, 0.9), 6).alias("y")])
_o("num_sigmoid_confidence", "round(abs(2 / (1 + exp(-(quantity - 25) / 6)) - 1), 6)::DOUBLE AS c", lambda v: [F.round(N.sigmoid_confidence(F.col("quantity"), 25, 6), 6).alias("c")])
_o("num_vote_blend", "round((1 - k) * confidence + k * CASE WHEN quantity > 0 THEN 0.25 ELSE 0 END, 6)::DOUBLE AS p FROM (SELECT *, 0.6 * least(1.0, quantity / 30.0) AS k FROM pages_o) pages_o", lambda v: [F.round(N.vote_blend(v.conf, F.col("quantity") / 4, F.col("quantity"), 0.6, 30.0), 6).alias("p")])
from folioframe.plans.base import SQL  # noqa: E402

SQL["num_vote_blend"] = SQL["num_vote_blend"].rsplit(" FROM pages_o", 1)[0]


@query("num_repeat_factor", "SELECT lang, count(*) AS n, round(greatest(1.0, least(4.0, sqrt(60.0 / count(*)))), 6)::DOUBLE AS factor FROM documents GROUP BY lang")
def num_repeat_factor(spark, sf):
    return table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.round(N.repeat_factor(F.count("*"), 60.0, 4.0), 6).alias("factor"))


@query("num_class_weight", "SELECT lang, round(t / (k * n), 6)::DOUBLE AS weight, round(sqrt(t / (k * n)), 6)::DOUBLE AS root FROM (SELECT lang, count(*)::DOUBLE AS n, sum(count(*)) OVER () AS t, count(*) OVER () AS k FROM documents GROUP BY lang)")
def num_class_weight(spark, sf):
    every = Window.partitionBy(F.lit(0))  # over one row a class
    g = table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    g = g.select("lang", "n", F.sum("n").over(every).alias("t"), F.count("*").over(every).alias("k"))
    return g.select("lang", F.round(N.class_weight(F.col("n"), F.col("t"), F.col("k")), 6).alias("weight"), F.round(N.class_weight(F.col("n"), F.col("t"), F.col("k"), True), 6).alias("root"))


@query("json_raw_unwrap", "SELECT event_id, coalesce(json_extract_string(CASE WHEN starts_with(trim(props), '{') THEN props END, '$.k'), 'none') AS content, 'plain' AS bare FROM events")
def json_raw_unwrap(spark, sf):
    """The content of a column that holds JSON or bare text."""
    raw = lambda c, path: F.when(F.trim(c).startswith("{"), F.get_json_object(c, path)).otherwise(c)
    return table(spark, sf, "events").select("event_id", F.coalesce(raw(F.col("props"), "$.k"), F.lit("none")).alias("content"), raw(F.lit("plain"), "$.k").alias("bare"))


@query("json_to_jsonb_project", "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.missing') AS missing FROM events")
def json_to_jsonb_project(spark, sf):
    """Columns that may not be there, read by name from a row's JSON."""
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.get_json_object("props", "$.missing").alias("missing"))


@query("json_axes_read", "SELECT event_id, event_type AS l1, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS l2 FROM events")
def json_axes_read(spark, sf):
    """A fixed structure out of a JSON column, one parse a row."""
    e = table(spark, sf, "events").withColumn("axes", F.from_json("props", "k long, title string"))
    return e.select("event_id", F.col("event_type").alias("l1"), F.col("axes.k").alias("l2"))


@query("json_headers_explode", "SELECT doc_id, trim(h) AS header FROM (SELECT doc_id, unnest(list_slice(string_split(coalesce(text, ''), chr(10)), 1, 2)) AS h FROM documents) WHERE trim(h) <> ''")
def json_headers_explode(spark, sf):
    """One row a header of an array kept as JSON."""
    d = table(spark, sf, "documents").select("doc_id", F.to_json(F.transform(F.slice(F.split(F.coalesce("text", F.lit("")), "\n"), 1, 2), lambda x: F.struct(x.alias("text")))).alias("j"))
    h = d.select("doc_id", F.explode(F.from_json("j", "array<struct<text:string>>")).alias("h"))
    return h.select("doc_id", F.trim("h.text").alias("header")).where("header <> ''")


@query("json_dates_array", f"WITH {ORDER_PAGES} SELECT chart, count(*) AS date_count, min(dos)::VARCHAR AS first_date, string_agg(DISTINCT kind, ',' ORDER BY kind) AS kinds FROM pages_o GROUP BY chart")
def json_dates_array(spark, sf):
    """A chart's dates as an array of structures, with its length as a generated column."""
    g = order_pages(spark, sf).groupBy("chart").agg(F.array_sort(F.collect_list(F.struct("dos", "kind", "page_no"))).alias("dates"))
    return g.select("chart", F.size("dates").cast("long").alias("date_count"), F.get("dates", F.lit(0))["dos"].cast("string").alias("first_date"), F.array_join(F.array_sort(F.array_distinct("dates.kind")), ",").alias("kinds"))


@query("json_labels_concat", "SELECT doc_id, CASE WHEN toxic = 1 THEN 'toxic' ELSE 'old' END AS page_type, quality::VARCHAR AS quality FROM labels")
def json_labels_concat(spark, sf):
    """Old labels with new ones on top; a new value wins."""
    old = F.create_map(F.lit("page_type"), F.lit("old"), F.lit("quality"), F.col("quality").cast("string"))
    new = F.when(F.col("toxic") == 1, F.create_map(F.lit("page_type"), F.lit("toxic"))).otherwise(F.create_map().cast("map<string,string>"))
    both = F.map_from_entries(F.concat(F.map_entries(F.map_filter(old, lambda k, v: ~F.array_contains(F.map_keys(new), k))), F.map_entries(new)))
    return table(spark, sf, "labels").select("doc_id", both["page_type"].alias("page_type"), both["quality"].alias("quality"))


@query("map_confidences", _O + "array_to_string(list_sort(list_filter(['print', 'type'], lambda x: CASE x WHEN 'type' THEN confidence < 0.5 ELSE tax * 10 < 0.5 END)), ',') AS review FROM pages_o")
def map_confidences(spark, sf):
    """Fields whose confidence is below the review bar."""
    m = F.create_map(F.lit("type"), F.col("confidence"), F.lit("print"), F.col("tax") * 10)
    return order_pages(spark, sf).select("chart", "page_no", F.array_join(F.array_sort(F.map_keys(F.map_filter(m, lambda k, v: v < 0.5))), ",").alias("review"))


@query("array_signers", "SELECT n_nationkey, n_name AS name, 'MD PHD' AS credentials FROM nation")
def array_signers(spark, sf):
    """Signers of a page as structures with their credentials."""
    from folioframe.functions.strings import credential_tokens

    s = table(spark, sf, "nation").select("n_nationkey", F.array(F.struct(F.col("n_name").alias("name"), credential_tokens(F.lit("M.D., Ph.D.")).alias("credentials"))).alias("signers"))
    return s.select("n_nationkey", F.explode("signers").alias("s")).select("n_nationkey", "s.name", F.array_join("s.credentials", " ").alias("credentials"))


@query("array_word_boxes", _O + "quantity AS left, quantity + 10 AS right, tax AS top, tax + 1 AS bottom FROM pages_o")
def array_word_boxes(spark, sf):
    """Corners of a polygon to a box: even places are x, odd ones y."""
    p = F.array(F.col("quantity"), F.col("tax"), F.col("quantity") + 10, F.col("tax"), F.col("quantity") + 10, F.col("tax") + 1, F.col("quantity"), F.col("tax") + 1)
    xs, ys = F.filter(p, lambda v, i: i % 2 == 0), F.filter(p, lambda v, i: i % 2 == 1)
    return order_pages(spark, sf).select("chart", "page_no", F.array_min(xs).alias("left"), F.array_max(xs).alias("right"), F.array_min(ys).alias("top"), F.array_max(ys).alias("bottom"))


@query("agg_weakest_confidence", _O + "least(confidence, tax * 10, CASE WHEN kind = 'main' THEN 0.3 END)::DOUBLE AS weakest FROM pages_o")
def agg_weakest_confidence(spark, sf):
    """The least of the confidences that are known."""
    return order_pages(spark, sf).select("chart", "page_no", F.least(F.col("confidence"), F.col("tax") * 10, F.when(F.col("kind") == "main", 0.3)).alias("weakest"))
