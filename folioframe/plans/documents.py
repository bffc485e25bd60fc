"""Queries of key/value extraction, continuity, sequencing, clusters and splits."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from folioframe.functions import strings as S
from folioframe.operators import folds
from folioframe.operators import keyvalues as K
from folioframe.operators import sequence as Q
from folioframe.operators.shared import components
from folioframe.plans.base import ORDER_PAGES, PAGES, order_pages, pages, query, table
from folioframe.plans.continuity import SEGMENTS, scores

_O = f"WITH {ORDER_PAGES}"
_KEYS = [("name", "name"), ("dob", "dob"), ("id", "id"), ("provider", "provider"), ("dos", "dos"), ("signed", "signed")]


def _sheets(spark, sf):
    """A page of text for each order line, with keys and values in known places."""
    p = order_pages(spark, sf)
    t = F.concat(F.lit("Page "), F.col("page_no").cast("string"), F.lit(" of 99\nName: Ana"), F.col("doc_hint").cast("string"), F.lit(" DOB: "), F.date_format("dos", "MM/dd/yyyy"), F.lit("\nID: A"), F.col("part").cast("string"), F.lit(" or B1\nProvider: Costa, MD\nDOS "), F.col("dos").cast("string"), F.lit("\nmid line\nSigned: "), F.date_format("dos", "MM/dd/yyyy"))
    return p.select((F.col("chart") * 1000 + F.col("page_no")).alias("page_id"), "chart", "page_no", "dos", "doc_hint", "part", t.alias("text"))


_SHEET = f"{_O}, s AS (SELECT chart * 1000 + page_no AS page_id, * FROM pages_o)"


def _words(spark, sf):
    return K.word_boxes(_sheets(spark, sf))


def _hits(spark, sf, *fields):
    keys = spark.createDataFrame([k for k in _KEYS if not fields or k[1] in fields], "term string, field string")
    return K.key_hits(_words(spark, sf), keys)


def _value(name, field, pattern, sql, clean=None):
    @query(name, f"{_SHEET} SELECT page_id, {sql} AS value FROM s")
    def run(spark, sf):
        got = K.page_values(_sheets(spark, sf), [(t, f, pattern) for t, f in _KEYS if f == field])
        return got.select("page_id", (clean(F.col("value")) if clean else F.col("value")).alias("value"))


_value("kv_name", "name", r"^[A-Z][a-z]+\d*$", "'Ana' || doc_hint")
_value("kv_dob", "dob", r"^\d+/\d+/\d{4}$", "strftime(dos, '%m/%d/%Y')")
_value("kv_member_id", "id", r"^[A-Z]\d+$", "'A' || part")
_value("kv_dos", "dos", r"^\d{4}-\d\d-\d\d$", "dos::VARCHAR")
_value("kv_provider", "provider", r"^[A-Z][a-z]+,?$", "'Costa'", lambda v: F.regexp_replace(v, ",$", ""))
_value("kv_credentials", "provider", r"^(MD|DO|RN|PHD)$", "'MD'")
_value("kv_esignature", "signed", r"^\d+/\d+/\d{4}$", "strftime(dos, '%m/%d/%Y')")


@query("join_key_catalog", f"{_SHEET} SELECT page_id, f AS field, 1::BIGINT AS hits FROM s, (SELECT unnest(['name', 'dob', 'id', 'provider', 'dos', 'signed']) AS f)")
def join_key_catalog(spark, sf):
    return K.page_key_counts(_sheets(spark, sf), _KEYS)


_PHRASES = [("and the of", "three"), ("of the", "pair"), ("and the", "pair"), ("that", "one"), ("there", "one"), ("the", "one")]


@query("kv_key_phrases", "WITH k AS (SELECT unnest(" + str([k for k, _ in _PHRASES]) + ") AS term, unnest(" + str([f for _, f in _PHRASES]) + """) AS field),
c AS (SELECT conv_id, turn, unnest(range(1, len(l) + 1)) AS line, unnest(l) AS t FROM (SELECT conv_id, turn, string_split(coalesce(text, ''), chr(10)) AS l FROM conversations)),
w AS (SELECT conv_id, turn, line, list_filter(list_transform(string_split(t, ' '), lambda x: lower(regexp_replace(x, '[^\\p{L}\\p{N}]+', '', 'g'))), lambda x: x <> '') AS w FROM c),
g AS (SELECT conv_id, turn, line, w, unnest(range(1, len(w) + 1)) AS pos FROM w), p AS (SELECT conv_id, turn, line, pos, n, array_to_string(w[pos:pos + n - 1], ' ') AS phrase FROM g, (SELECT unnest([1, 2, 3]) AS n) WHERE pos + n - 1 <= len(w)),
d AS (SELECT phrase, term, field FROM (SELECT DISTINCT phrase FROM p) JOIN k ON phrase = term OR length(term) >= 5 AND abs(length(phrase) - length(term)) <= 1 AND levenshtein(phrase, term) <= 1),
h AS (SELECT conv_id, turn, line, pos, n, field FROM p JOIN d USING (phrase)), o AS (SELECT a.* FROM h a WHERE NOT EXISTS (SELECT 1 FROM h b WHERE b.conv_id = a.conv_id AND b.turn = a.turn AND b.line = a.line AND b.n > a.n AND b.pos < a.pos + a.n AND a.pos < b.pos + b.n))
SELECT conv_id, turn, field, count(DISTINCT (line, pos)) AS hits FROM o GROUP BY ALL""")
def kv_key_phrases(spark, sf):
    """Keys of one to three words in texts as they come, with one letter wrong at most; a longer key takes the words of shorter ones."""
    c = table(spark, sf, "conversations").select(F.struct("conv_id", "turn").alias("page_id"), F.coalesce("text", F.lit("")).alias("text"))
    got = K.phrase_hits(K.word_boxes(c), spark.createDataFrame(_PHRASES, "term string, field string"), most=3)
    return got.groupBy("page_id", "field").agg(F.count_distinct("line", "place").alias("hits")).select("page_id.conv_id", "page_id.turn", "field", "hits")


@query("kv_trust", f"{_SHEET} SELECT page_id, count(*) * 6 AS hits, count(*) * 6 AS trusted FROM s GROUP BY page_id")
def kv_trust(spark, sf):
    return K.page_trust(_sheets(spark, sf), _KEYS)


@query("kv_window", f"{_SHEET} SELECT page_id, 0.0::DOUBLE AS w_left, 300.0::DOUBLE AS w_right, 12.0::DOUBLE AS w_top, 36.0::DOUBLE AS w_bottom FROM s")
def kv_window(spark, sf):
    return K.window(_hits(spark, sf, "name")).select("page_id", "w_left", "w_right", "w_top", "w_bottom")


@query("kv_region", f"{_SHEET} SELECT page_id, f AS field, r AS region FROM s, (SELECT unnest(['name', 'signed', 'provider']) AS f, unnest(['header', 'footer', 'mid']) AS r)")
def kv_region(spark, sf):
    return _hits(spark, sf, "name", "signed", "provider").select("page_id", "field", K.region(F.col("top") - 1, F.lit(82.0)).alias("region"))


@query("kv_tokens", f"{_SHEET} SELECT page_id, 21 AS tokens, 6 AS lines FROM s")
def kv_tokens(spark, sf):
    g = _words(spark, sf).groupBy("page_id").agg(F.count("*").alias("tokens"), F.max("line").alias("lines"))
    return g.select("page_id", F.col("tokens").cast("int").alias("tokens"), F.col("lines").cast("int").alias("lines"))


@query("kv_mentions", f"{_SHEET} SELECT page_id, strftime(dos, '%m/%d/%Y') AS value, 2::BIGINT AS places FROM s")
def kv_mentions(spark, sf):
    s = _sheets(spark, sf)
    return K.mentions(K.word_boxes(s), s.select("page_id", F.date_format("dos", "MM/dd/yyyy").alias("value")))


@query("join_find_words_box", f"{_SHEET} SELECT page_id, 8::BIGINT AS words FROM s")
def join_find_words_box(spark, sf):
    s = _sheets(spark, sf)
    boxes = s.select("page_id", F.lit(0.0).alias("w_left"), F.lit(100000.0).alias("w_right"), F.lit(0.0).alias("w_top"), F.lit(20.0).alias("w_bottom"))
    got = K.words_in_boxes(K.word_boxes(s), boxes)
    return got.groupBy("page_id").agg(F.count("*").alias("words"))


@query("kv_page_no", f"{_SHEET} SELECT page_id, page_no::INT AS num, 99 AS total FROM s")
def kv_page_no(spark, sf):
    n, m = S.marker(F.split_part("text", F.lit("\n"), F.lit(1)))
    return _sheets(spark, sf).select("page_id", n.alias("num"), m.alias("total"))


@query("kv_heading", f"{_SHEET} SELECT page_id, 4::BIGINT AS headings FROM s")
def kv_heading(spark, sf):
    """Lines that begin with a word and a colon."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"^[A-Z][A-Za-z]*:"))
    return _sheets(spark, sf).select("page_id", F.size(lines).cast("long").alias("headings"))


_PATTERNS = {"name": r"^[A-Z][a-z]+\d*$", "dob": r"^\d+/\d+/\d{4}$", "id": r"^[A-Z]\d+$"}


def _all(spark, sf):
    """All fields in one search: a key of the catalogue has the pattern of its value."""
    return K.page_values(_sheets(spark, sf), [(t, f, _PATTERNS[f]) for t, f in _KEYS if f in _PATTERNS])


_ALL = f"{_SHEET}, a AS (SELECT page_id, 'name' AS field, 'Ana' || doc_hint AS value FROM s UNION ALL SELECT page_id, 'dob', strftime(dos, '%m/%d/%Y') FROM s UNION ALL SELECT page_id, 'id', 'A' || part FROM s)"


@query("kv_page_all", f"{_ALL} SELECT * FROM a")
def kv_page_all(spark, sf):
    return _all(spark, sf).select("page_id", "field", "value")


@query("kv_results", f"{_ALL} SELECT page_id, max(value) FILTER (WHERE field = 'name') AS name, max(value) FILTER (WHERE field = 'dob') AS dob, max(value) FILTER (WHERE field = 'id') AS id FROM a GROUP BY page_id")
def kv_results(spark, sf):
    return _all(spark, sf).groupBy("page_id").pivot("field", ["name", "dob", "id"]).agg(F.first("value"))


@query("kv_review_view", f"{_ALL} SELECT page_id, field, value, field <> 'name' AS checked FROM a")
def kv_review_view(spark, sf):
    return _all(spark, sf).select("page_id", "field", "value", (F.col("field") != "name").alias("checked"))


@query("kv_staging_access", f"{_O} SELECT chart, count(*) FILTER (WHERE confidence >= 0.5) AS accepted, arg_max(page_no, (confidence, -page_no)) AS best FROM pages_o GROUP BY chart")
def kv_staging_access(spark, sf):
    """Accepted candidates of a chart and the best one."""
    return order_pages(spark, sf).groupBy("chart").agg(F.count_if(F.col("confidence") >= 0.5).alias("accepted"), F.max_by("page_no", F.struct("confidence", -F.col("page_no"))).alias("best"))


@query("kv_candidate_features", f"{_O} SELECT chart, page_no, rank() OVER (PARTITION BY chart ORDER BY confidence DESC) AS place, round(confidence - max(confidence) OVER (PARTITION BY chart), 6) AS gap, count(*) OVER (PARTITION BY chart, dos) AS rivals FROM pages_o")
def kv_candidate_features(spark, sf):
    w = Window.partitionBy("chart")
    return order_pages(spark, sf).select("chart", "page_no", F.rank().over(w.orderBy(F.col("confidence").desc())).cast("long").alias("place"), F.round(F.col("confidence") - F.max("confidence").over(w), 6).alias("gap"), F.count("*").over(Window.partitionBy("chart", "dos")).alias("rivals"))


@query("kv_ranker", f"{_O} SELECT chart, arg_max(page_no, (round(confidence * 0.7 + tax * 2, 6), -page_no)) AS chosen FROM pages_o WHERE round(confidence * 0.7 + tax * 2, 6) >= 0.3 GROUP BY chart")
def kv_ranker(spark, sf):
    """The candidate of the best score at or above a threshold; any scoring column will do."""
    s = order_pages(spark, sf).withColumn("score", F.round(F.col("confidence") * 0.7 + F.col("tax") * 2, 6)).where("score >= 0.3")
    return s.groupBy("chart").agg(F.max_by("page_no", F.struct("score", -F.col("page_no"))).alias("chosen"))


@query("kv_metrics", f"{_O}, m AS (SELECT count(*) FILTER (WHERE kind = 'main' AND tax > 0.02) AS r, count(*) FILTER (WHERE kind = 'main' AND tax <= 0.02) AS w, count(*) FILTER (WHERE kind = 'junk') AS missed FROM pages_o) SELECT r AS right, w AS wrong, missed, round(r / (r + w)::DOUBLE, 4) AS precision, round(r / (r + missed)::DOUBLE, 4) AS recall FROM m")
def kv_metrics(spark, sf):
    k = F.col("kind")
    g = order_pages(spark, sf).agg(F.count_if((k == "main") & (F.col("tax") > 0.02)).alias("right"), F.count_if((k == "main") & (F.col("tax") <= 0.02)).alias("wrong"), F.count_if(k == "junk").alias("missed"))
    d = lambda a, b: F.round(F.try_divide(F.col("right").cast("double"), (F.col(a) + F.col(b)).cast("double")), 4)
    return g.select("*", d("right", "wrong").alias("precision"), d("right", "missed").alias("recall"))


#: Continuity: segments of the pages of plans.continuity.
@query("con_segments", SEGMENTS)
def con_segments(spark, sf):
    return folds.continuity(scores(spark, sf))


def _docs(spark, sf):
    seg = folds.continuity(scores(spark, sf))
    p = scores(spark, sf).join(seg, ["chart", "page_no"])
    return p.groupBy("chart", "document").agg(F.min_by("kind", "page_no").alias("kind"), F.min("dos").alias("dos"), F.count("*").alias("pages"), (F.max_by("kind", "page_no") == "main").alias("by_last_page"))


@query("con_final_pass")
def con_final_pass(spark, sf):
    return folds.final_pass(_docs(spark, sf))


@query("pt_packets")
def pt_packets(spark, sf):
    return folds.packets(_docs(spark, sf))


@query("con_finish")
def con_finish(spark, sf):
    return Q.document_position(scores(spark, sf).join(folds.continuity(scores(spark, sf)), ["chart", "page_no"]), "document").select("chart", "page_no", "document", "seq", "position")


@query("con_staged_inputs", f"{_O} SELECT chart, max(CASE WHEN kind = 'main' THEN confidence END) AS trust, bool_or(tax > 0.06) AS signed FROM pages_o GROUP BY chart")
def con_staged_inputs(spark, sf):
    return order_pages(spark, sf).groupBy("chart").agg(F.max(F.when(F.col("kind") == "main", F.col("confidence"))).alias("trust"), F.max(F.col("tax") > 0.06).alias("signed"))


#: Sequencing.
_MK = f"{_O}, m AS (SELECT chart, page_no, part % 7 AS num, part % 3 AS total FROM pages_o WHERE part % 4 <> 0)"


def _markers(spark, sf):
    return order_pages(spark, sf).where("part % 4 <> 0").select("chart", "page_no", (F.col("part") % 7).alias("num"), (F.col("part") % 3).alias("total"))


@query("seq_detect_markers", f"{_MK}, f AS (SELECT chart, total, count(*) AS n FROM m GROUP BY ALL), b AS (SELECT chart, arg_max(total, (n, total)) AS total FROM f GROUP BY chart) SELECT m.chart, m.page_no, m.num FROM m JOIN b USING (chart, total)")
def seq_detect_markers(spark, sf):
    """Markers of a chart's dominant family."""
    m = _markers(spark, sf)
    best = m.groupBy("chart", "total").agg(F.count("*").alias("n")).groupBy("chart").agg(F.max_by("total", F.struct("n", "total")).alias("total"))
    return m.join(best, ["chart", "total"]).select("chart", "page_no", "num")


@query("seq_conflicts", f"{_MK} SELECT chart, total, num, count(*) AS pages FROM m GROUP BY ALL HAVING count(*) > 1")
def seq_conflicts(spark, sf):
    return _markers(spark, sf).groupBy("chart", "total", "num").agg(F.count("*").alias("pages")).where("pages > 1")


@query("seq_streams")
def seq_streams(spark, sf):
    return folds.streams(_markers(spark, sf))


def _follow(spark, sf):
    p = order_pages(spark, sf)
    place = F.floor(F.col("page_no") / 12)
    a = p.select("chart", F.explode(F.array(place - 1, place, place + 1)).alias("stretch"), F.col("page_no").alias("a"), F.col("part").alias("pa"))
    b = p.select("chart", place.alias("stretch"), F.col("page_no").alias("b"), F.col("part").alias("pb"))
    j = a.join(b, ["chart", "stretch"]).where("a <> b and abs(a - b) <= 12")
    return j.select("chart", "a", "b", (F.pmod(F.col("pa") * 31 + F.col("pb"), F.lit(100)) / 100.0 - 0.5).alias("score"))


@query("seq_build")
def seq_build(spark, sf):
    """Marker, then chain of likely followers, then the order as it was."""
    return folds.chain_order(_follow(spark, sf), order_pages(spark, sf).select("chart", "page_no"))


@query("seq_assign")
def seq_assign(spark, sf):
    chained = folds.chain_order(_follow(spark, sf), order_pages(spark, sf).select("chart", "page_no"))
    fenced = Q.fenced_order(order_pages(spark, sf).select("chart", "page_no", F.when(F.col("part") % 4 != 0, F.col("part") % 7).alias("num"), F.when(F.col("part") % 4 != 0, F.col("part") % 2).alias("total")), "num", "total")
    f = fenced.select("chart", "page_no", F.col("new_no").alias("marker_no"), F.col("num").isNotNull().alias("marked"))
    j = chained.join(f, ["chart", "page_no"])
    return j.select("chart", "page_no", F.when(F.col("marked"), F.col("marker_no")).otherwise(F.col("new_no")).alias("position"), F.when(F.col("marked"), "marker").otherwise("chain").alias("method"))


@query("seq_features", f"WITH {PAGES} SELECT page_id, md5(coalesce(string_split(text, chr(10))[1], '')) AS header, md5(coalesce(string_split(text, chr(10))[-1], '')) AS footer FROM pages_a")
def seq_features(spark, sf):
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    return pages(spark, sf).select("page_id", F.md5(F.get(lines, F.lit(0)).cast("binary")).alias("header"), F.md5(F.element_at(lines, -1).cast("binary")).alias("footer"))


@query("seq_cover_blank", f"WITH {PAGES} SELECT page_id, page_no <= 3 AND n_chars < 400 AS cover, length(trim(coalesce(text, ''))) < 20 AS near_blank FROM pages_a")
def seq_cover_blank(spark, sf):
    return pages(spark, sf).select("page_id", ((F.col("page_no") <= 3) & (F.col("n_chars") < 400)).alias("cover"), (F.length(F.trim(F.coalesce("text", F.lit("")))) < 20).alias("near_blank"))


@query("join_union_find_headers", f"""WITH RECURSIVE {PAGES}, l AS (SELECT chart, page_id, unnest([{{'side': 'h', 'line': split_part(coalesce(text, ''), chr(10), 1)}}, {{'side': 'f', 'line': string_split(coalesce(text, ''), chr(10))[-1]}}]) AS x FROM pages_a),
h AS (SELECT chart, page_id, x.side AS side, list_distinct(regexp_extract_all(lower(x.line), '{S.WORD}')) AS w FROM l), k AS (SELECT chart, page_id, side, w, unnest(w) AS t FROM h),
p AS (SELECT a.page_id AS a, b.page_id AS b, a.side, count(*) AS sh, any_value(len(a.w) + len(b.w)) AS n FROM k a JOIN k b ON a.chart = b.chart AND a.side = b.side AND a.t = b.t AND a.page_id <> b.page_id GROUP BY a.page_id, b.page_id, a.side),
e AS (SELECT DISTINCT a, b FROM p WHERE 10 * sh > 7 * (n - sh)), r AS (SELECT DISTINCT page_id AS node, page_id AS seen FROM k UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a) SELECT node AS page_id, min(seen) AS cluster FROM r GROUP BY node""")
def join_union_find_headers(spark, sf):
    """Pages of a chart whose first or last lines' words have a Jaccard similarity over 0.7, through any chain of such pages, in one cluster named
    by its least page. Equal lines are one set, and candidates come from an index of words: of a set's words (in the order of their
    hashes) only so many need be looked up that two similar sets must share one."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    sides = F.array(*(F.struct(F.lit(n).alias("side"), F.array_sort(F.transform(S.unique_words(x), lambda z: F.xxhash64(z))).alias("w")) for n, x in (("h", F.get(lines, F.lit(0))), ("f", F.element_at(lines, -1)))))
    h = pages(spark, sf).select("chart", "page_id", F.explode(sides).alias("x")).select("chart", "page_id", "x.side", "x.w").where(F.size("w") > 0)
    sets = h.groupBy("chart", "side", "w").agg(F.min("page_id").alias("a"))
    n, m, both = F.size("w"), F.size("v"), F.size(F.array_intersect("w", "v"))
    index = sets.withColumn("t", F.explode(F.slice("w", F.lit(1), n - F.ceil(n * 7 / 10).cast("int") + 1)))
    near = index.join(index.select("chart", "side", "t", F.col("a").alias("b"), F.col("w").alias("v")), ["chart", "side", "t"]).where((F.col("a") < F.col("b")) & (10 * F.least(n, m) > 7 * F.greatest(n, m)))
    links = near.where(10 * both > 7 * (n + m - both)).select("a", "b")
    alike = h.join(sets, ["chart", "side", "w"]).where(F.col("page_id") != F.col("a")).select("a", F.col("page_id").alias("b"))
    root = components(links.union(alike).distinct())
    return h.select("page_id").distinct().join(root.withColumnRenamed("node", "page_id"), "page_id", "left").select("page_id", F.coalesce("root", "page_id").alias("cluster"))


#: Splits and learning.
@query("ml_group_split", "SELECT doc_id, CASE WHEN ('0x' || md5(source)[1:8])::BIGINT % 100 < 25 THEN 'test' ELSE 'train' END AS split FROM documents")
def ml_group_split(spark, sf):
    """Whole groups to one side, by a hash of the group."""
    h = F.conv(F.substring(F.md5(F.col("source").cast("binary")), 1, 8), 16, 10).cast("long")
    return table(spark, sf, "documents").select("doc_id", F.when(h % 100 < 25, "test").otherwise("train").alias("split"))


@query("ml_record_test_split", "SELECT doc_id, ('0x' || md5(doc_id::VARCHAR)[1:8])::BIGINT % 5 = 0 AS is_test FROM documents")
def ml_record_test_split(spark, sf):
    h = F.conv(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
    return table(spark, sf, "documents").select("doc_id", (h % 5 == 0).alias("is_test"))


@query("ml_stratified_group_split")
def ml_stratified_group_split(spark, sf):
    """Groups dealt greedily so that each side's class shares come near the whole's; the driver sees one row a group."""
    d = table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id")
    g = d.groupBy("source").agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).toPandas().sort_values(["n", "source"], ascending=[False, True])
    want = {"train": 0.6, "val": 0.2, "test": 0.2}
    n, t = float(g.n.sum()) or 1.0, float(g.t.sum()) or 1.0
    have = {k: [0.0, 0.0] for k in want}
    side = {}
    for r in g.itertuples():
        side[r.source] = min(want, key=lambda k: sum(abs((have[x][0] + r.n * (x == k)) / n - want[x]) + abs((have[x][1] + r.t * (x == k)) / t - want[x]) for x in want))  # noqa: B023
        have[side[r.source]][0] += r.n
        have[side[r.source]][1] += r.t
    return d.join(spark.createDataFrame(pd.DataFrame(sorted(side.items()), columns=["source", "split"])), "source").groupBy("source", "split").agg(F.count("*").alias("n"))


@query("ml_crossval", "WITH d AS (SELECT source, lang, toxic FROM documents JOIN labels USING (doc_id)), s AS (SELECT source, lang, count(*) AS n, sum(toxic) AS t FROM d GROUP BY ALL), o AS (SELECT *, sum(n) OVER (PARTITION BY lang) - n AS n_, sum(t) OVER (PARTITION BY lang) - t AS t_ FROM s) SELECT source, sum(n)::BIGINT AS n, round(sum(t * pow(1 - (t_ + 1) / (n_ + 2)::DOUBLE, 2) + (n - t) * pow((t_ + 1) / (n_ + 2)::DOUBLE, 2)) / sum(n), 6) AS brier FROM o GROUP BY source")
def ml_crossval(spark, sf):
    """Leave one source out: a toxic rate a language, smoothed, is fitted to the other sources and its squared error measured on the one
    left out. What all have less what the source has is the fit without it, so that there is no loop over sources."""
    d = table(spark, sf, "documents").select("doc_id", "source", "lang").join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id")
    s = d.groupBy("source", "lang").agg(F.count("*").alias("n"), F.sum("toxic").alias("t"))
    every = s.groupBy(F.col("lang").alias("l")).agg(F.sum("n").alias("all_n"), F.sum("t").alias("all_t"))
    o = s.join(every, F.col("lang").eqNullSafe(F.col("l"))).withColumn("p", (F.col("all_t") - F.col("t") + 1) / (F.col("all_n") - F.col("n") + 2).cast("double"))
    error = F.col("t") * F.pow(1 - F.col("p"), 2) + (F.col("n") - F.col("t")) * F.pow("p", F.lit(2))
    return o.groupBy("source").agg(F.sum("n").alias("n"), F.round(F.sum(error) / F.sum("n"), 6).alias("brier"))


@query("ml_tfidf_lr")
def ml_tfidf_lr(spark, sf):
    """Hashed term frequencies with inverse document frequency, and a class-weighted logistic regression, as a Spark ML pipeline: fitted to
    four documents of five by a hash of their ids, asked for the fifth."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
    from pyspark.ml.functions import vector_to_array

    d = table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(table(spark, sf, "labels").select("doc_id", F.col("toxic").cast("double").alias("label")), "doc_id")
    d = d.withColumn("w", F.when(F.col("label") == 1, 5.0).otherwise(1.0))
    steps = [RegexTokenizer(inputCol="text", outputCol="t", pattern=r"[^\p{L}\p{N}_]+"), HashingTF(inputCol="t", outputCol="tf", numFeatures=1 << 14), IDF(inputCol="tf", outputCol="x"), LogisticRegression(featuresCol="x", weightCol="w", regParam=0.05, maxIter=15)]
    held = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    out = Pipeline(stages=steps).fit(d.where(~held)).transform(d.where(held))
    return out.select("doc_id", "label", F.round(vector_to_array("probability")[1], 6).alias("score"))
