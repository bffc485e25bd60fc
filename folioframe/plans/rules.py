"""Queries of rule ladders, votes and keyword statistics. The word lists are small invented ones that fit the driver's texts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from folioframe.functions import strings as S
from folioframe.operators import rules as R
from folioframe.plans.base import ORDER_PAGES, PAGES, order_pages, pages, query, table

PATTERNS = {"cover": "that|des", "letter": "disgusting|trash", "invoice": "token = ", "request": "licensed under"}
GUARD = r"\bpour\b"
_TERMS = [("and", "g1", "en", 1.0), ("the", "g1", "en", 2.0), ("of", "g2", "en", 1.0), ("der", "g3", "de", 2.0), ("und", "g3", "de", 1.5), ("die", "g4", "de", 1.0), ("les", "g5", "fr", 2.0), ("des", "g5", "fr", 1.0), ("que", "g6", "es", 1.0), ("los", "g6", "es", 2.0)]
_T = "t AS (SELECT * FROM (VALUES " + ", ".join(map(str, _TERMS)) + ") v(term, grp, label, weight))"
_W = f"{PAGES}, w AS (SELECT page_id, unnest(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '{S.WORD}'))) AS term FROM pages_a), {_T}, h AS (SELECT w.page_id, t.* FROM w JOIN t USING (term))"


def _hits(spark, sf):
    terms = spark.createDataFrame(_TERMS, "term string, group string, label string, weight double")
    return R.term_hits(pages(spark, sf), terms)


@query("bj_blank_text", "SELECT doc_id, length(regexp_replace(coalesce(text, ''), '[^a-zA-Z0-9]', '', 'g')) < 5 AS blank FROM documents")
def bj_blank_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", R.blank_text(F.col("text")).alias("blank"))


_CASC = f"CASE WHEN length(regexp_replace(coalesce(text, ''), '[^a-zA-Z0-9]', '', 'g')) < 5 THEN 'blank' WHEN len(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '')) < 20 AND regexp_matches(lower(text), '{PATTERNS['cover']}') THEN 'cover' WHEN regexp_matches(lower(text), '\\bpour\\b') THEN 'main' WHEN regexp_matches(lower(text), '{PATTERNS['letter']}') THEN 'letter' WHEN regexp_matches(lower(text), '{PATTERNS['invoice']}') THEN 'invoice' WHEN regexp_matches(lower(text), '{PATTERNS['request']}') THEN 'request' ELSE 'main' END"


@query("bj_rule_cascade", f"SELECT doc_id, {_CASC} AS kind FROM documents")
def bj_rule_cascade(spark, sf):
    return table(spark, sf, "documents").select("doc_id", R.cascade(F.col("text"), PATTERNS, GUARD).alias("kind"))


@query("bj_flag_taxonomy", f"SELECT doc_id, CASE {_CASC} WHEN 'main' THEN 'KEEP' WHEN 'blank' THEN 'BLANK' ELSE 'JUNK' END AS flag FROM documents")
def bj_flag_taxonomy(spark, sf):
    k = R.cascade(F.col("text"), PATTERNS, GUARD)
    return table(spark, sf, "documents").select("doc_id", S.page_kind_map(k, {"main": "KEEP", "blank": "BLANK"}, "JUNK").alias("flag"))


@query("bj_context_score", f"WITH {_W}, n AS (SELECT page_id, grp, count(DISTINCT term) AS n FROM h GROUP BY ALL), g AS (SELECT * FROM (VALUES ('g1', 'body', 1.5, 2.0), ('g2', 'body', 1.0, 1.0), ('g3', 'edge', 0.5, 0.8)) v(grp, context, weight, cap)) SELECT page_id, context, round(sum(least(n * g.weight, cap)), 4)::DOUBLE AS score FROM n JOIN g USING (grp) GROUP BY ALL")
def bj_context_score(spark, sf):
    groups = spark.createDataFrame([("g1", "body", 1.5, 2.0), ("g2", "body", 1.0, 1.0), ("g3", "edge", 0.5, 0.8)], "group string, context string, weight double, cap double")
    return R.context_scores(_hits(spark, sf).select("page_id", "group", "term"), groups)


_PR = f"WITH {ORDER_PAGES}"
_PROBA = "CASE WHEN print = 'handwritten' AND quantity > 45 THEN 'KEEP' WHEN confidence > 0.95 THEN 'KEEP' WHEN tax * 12 >= 0.85 AND tax * 12 >= discount2 THEN 'JUNK' WHEN discount2 >= 0.85 THEN 'BLANK' WHEN greatest(confidence, discount2, tax * 12) < 0.5 THEN 'REVIEW' WHEN confidence >= greatest(discount2, tax * 12) THEN 'KEEP' ELSE 'REVIEW' END"
_PFROM = "(SELECT *, quantity / 50.0 AS discount2 FROM pages_o)"


@query("bj_decision_proba", f"{_PR} SELECT chart, page_no, {_PROBA} AS decision FROM {_PFROM}")
def bj_decision_proba(spark, sf):
    p = order_pages(spark, sf)
    return p.select("chart", "page_no", R.decide_proba(F.col("confidence"), F.col("quantity") / 50.0, F.col("tax") * 12, (F.col("print") == "handwritten") & (F.col("quantity") > 45)).alias("decision"))


@query("bj_decide", f"{_PR} SELECT chart, page_no, CASE WHEN kind = 'blank' AND quantity < 10 THEN 'R1' WHEN kind = 'blank' THEN 'R2' WHEN print = 'handwritten' AND tax > 0.06 THEN 'R3' WHEN confidence > 0.95 THEN 'sure keep' WHEN kind = 'junk' AND confidence < 0.05 THEN 'sure junk' WHEN tax = 0 THEN 'R4' WHEN quantity < 5 THEN 'R6' ELSE 'R5' END AS rule FROM pages_o")
def bj_decide(spark, sf):
    k = F.col("kind")
    rules = [((k == "blank") & (F.col("quantity") < 10), "R1"), (k == "blank", "R2"), ((F.col("print") == "handwritten") & (F.col("tax") > 0.06), "R3"), (F.col("confidence") > 0.95, "sure keep"), ((k == "junk") & (F.col("confidence") < 0.05), "sure junk"), (F.col("tax") == 0, "R4"), (F.col("quantity") < 5, "R6")]
    return order_pages(spark, sf).select("chart", "page_no", R.ladder(rules, "R5").alias("rule"))


@query("bj_post_process", f"{_PR} SELECT chart, page_no, CASE WHEN kind = 'junk' AND tax > 0.05 THEN 'main' ELSE kind END AS kind FROM pages_o")
def bj_post_process(spark, sf):
    """A signed page is never junk."""
    return order_pages(spark, sf).select("chart", "page_no", F.when((F.col("kind") == "junk") & (F.col("tax") > 0.05), "main").otherwise(F.col("kind")).alias("kind"))


@query("bj_legacy_post", "SELECT doc_id, CASE WHEN len(list_filter(regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]+'), lambda w: w IN ('and', 'und', 'les'))) >= 3 THEN 'keep' WHEN length(trim(coalesce(text, ''))) = 0 THEN 'blank' WHEN n_chars < 200 THEN 'short' ELSE 'model' END AS code FROM documents")
def bj_legacy_post(spark, sf):
    t = F.coalesce("text", F.lit(""))
    return table(spark, sf, "documents").select("doc_id", R.ladder([(F.size(F.filter(S.words(t), lambda w: w.isin("and", "und", "les"))) >= 3, "keep"), (F.length(F.trim(t)) == 0, "blank"), (F.col("n_chars") < 200, "short")], "model").alias("code"))


@query("bj_protocol", "SELECT doc_id, regexp_matches(lower(coalesce(text, '')), 'license') AS demographic, regexp_matches(lower(coalesce(text, '')), '\\+[0-9] \\(') AS fax, length(trim(coalesce(text, ''))) < 3 AS system_blank FROM documents")
def bj_protocol(spark, sf):
    t = F.lower(F.coalesce("text", F.lit("")))
    return table(spark, sf, "documents").select("doc_id", t.rlike("license").alias("demographic"), t.rlike(r"\+[0-9] \(").alias("fax"), (F.length(F.trim(F.coalesce("text", F.lit("")))) < 3).alias("system_blank"))


@query("bj_routing", f"SELECT doc_id, CASE WHEN n = 0 THEN 'empty' WHEN n < 5 THEN 'image only' WHEN known < 3 THEN 'unreadable' ELSE 'model' END AS route FROM (SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '{S.WORD}')) AS n, len(list_filter(['and', 'the', 'of', 'der', 'die', 'les', 'la', 'de', 'que', 'und', 'le', 'des'], lambda x: list_contains(regexp_extract_all(lower(coalesce(text, '')), '{S.WORD}'), x))) AS known FROM documents)")
def bj_routing(spark, sf):
    w = S.words(F.col("text"))
    known = F.size(F.array_intersect(F.array_distinct(w), F.array(*map(F.lit, ("and", "the", "of", "der", "die", "les", "la", "de", "que", "und", "le", "des")))))
    return table(spark, sf, "documents").select("doc_id", R.ladder([(F.size(w) == 0, "empty"), (F.size(w) < 5, "image only"), (known < 3, "unreadable")], "model").alias("route"))


@query("bj_subclass", "SELECT doc_id, CASE WHEN a > 0 AND (b = 0 OR a < b) THEN 'license' WHEN b > 0 THEN 'token' ELSE 'none' END AS subtype FROM (SELECT doc_id, strpos(lower(coalesce(text, '')), 'licensed') AS a, strpos(lower(coalesce(text, '')), 'token') AS b FROM documents)")
def bj_subclass(spark, sf):
    """The subtype whose trigger comes first."""
    t = F.lower(F.coalesce("text", F.lit("")))
    at = F.array(*(F.struct(F.nullif(F.instr(t, w), F.lit(0)).alias("at"), F.lit(k).alias("k")) for w, k in (("licensed", "license"), ("token", "token"))))
    return table(spark, sf, "documents").select("doc_id", F.coalesce(F.array_min(F.filter(at, lambda x: x["at"].isNotNull()))["k"], F.lit("none")).alias("subtype"))


@query("bj_docling_meta", "SELECT page_id, regexp_matches(coalesce(html, ''), '<title>') AS has_title, len(regexp_extract_all(coalesce(html, ''), '<p[ >]'))::BIGINT AS paragraphs, length(coalesce(html, ''))::BIGINT AS size FROM pages")
def bj_docling_meta(spark, sf):
    """Structural facts of a page's markup."""
    h = F.coalesce("html", F.lit(""))
    return table(spark, sf, "pages").select("page_id", h.rlike("<title>").alias("has_title"), F.regexp_count(h, F.lit("<p[ >]")).cast("long").alias("paragraphs"), F.length(h).cast("long").alias("size"))


@query("bj_votes_view", f"{_PR} SELECT chart, page_no, kind AS pass_1, CASE WHEN tax > 0.05 THEN 'main' ELSE kind END AS pass_2, kind <> CASE WHEN tax > 0.05 THEN 'main' ELSE kind END AS differs FROM pages_o")
def bj_votes_view(spark, sf):
    v = F.struct(F.col("kind").alias("pass_1"), F.when(F.col("tax") > 0.05, "main").otherwise(F.col("kind")).alias("pass_2"))
    return order_pages(spark, sf).select("chart", "page_no", v.alias("v")).select("chart", "page_no", "v.*", (F.col("v.pass_1") != F.col("v.pass_2")).alias("differs"))


_NAMES = "n AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN ['ana', 'costa'] WHEN 1 THEN ['a', 'costa'] WHEN 2 THEN ['bruno', 'costa'] ELSE ['x', 'y'] END AS span FROM documents)"


def _span():
    opts = [F.array(*map(F.lit, x)) for x in (("ana", "costa"), ("a", "costa"), ("bruno", "costa"), ("x", "y"))]
    return F.element_at(F.array(*opts), (F.col("doc_id") % 4 + 1).cast("int"))


@query("mem_name_classify", "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'BOTH_FULL' WHEN 1 THEN 'INITIAL' WHEN 2 THEN 'ONE_FULL_WRONG' ELSE 'MISMATCH' END AS class FROM documents")
def mem_name_classify(spark, sf):
    return table(spark, sf, "documents").select("doc_id", R.name_class(_span(), F.lit("ana"), F.lit("costa")).alias("class"))


@query("mem_name_find", f"SELECT doc_id, list_contains(regexp_extract_all(lower(coalesce(text, '')), '{S.WORD}'), 'the') AND list_contains(regexp_extract_all(lower(coalesce(text, '')), '{S.WORD}'), 'and') AS found, list_position(regexp_extract_all(lower(coalesce(text, '')), '{S.WORD}'), 'the')::BIGINT AS at FROM documents")
def mem_name_find(spark, sf):
    w = S.words(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", (F.array_contains(w, "the") & F.array_contains(w, "and")).alias("found"), F.nullif(F.array_position(w, "the"), F.lit(0)).alias("at"))


@query("mem_id_find", "SELECT doc_id, coalesce(list_contains(regexp_split_to_array(lower(text), '[^a-z0-9]+'), 'the'), false) AS found FROM documents")
def mem_id_find(spark, sf):
    return table(spark, sf, "documents").select("doc_id", R.id_found(F.col("text"), F.lit("THE")).alias("found"))


@query("mem_combine", f"{_PR} SELECT chart, page_no, CASE WHEN tax > 0.06 THEN kind = 'main' AND print = 'printed' AND confidence > 0.3 ELSE kind = 'main' AND (print = 'printed' OR confidence > 0.3) END AS verified FROM pages_o")
def mem_combine(spark, sf):
    return order_pages(spark, sf).select("chart", "page_no", R.combine_evidence(F.col("kind") == "main", F.col("print") == "printed", F.col("confidence") > 0.3, F.col("tax") > 0.06).alias("verified"))


_WRONG = f"{_PR}, d AS (SELECT chart, count(*) AS pages, count(*) FILTER (WHERE kind = 'junk' AND confidence > 0.6) AS wrong FROM pages_o GROUP BY chart), b AS (SELECT *, greatest(1, least(5, ceil(pages * 0.1)))::BIGINT AS bar FROM d) SELECT *, CASE WHEN wrong >= bar THEN 'reject' ELSE 'accept' END AS decision FROM b"


@query("agg_member_document", _WRONG)
def agg_member_document(spark, sf):
    return R.member_document(order_pages(spark, sf), (F.col("kind") == "junk") & (F.col("confidence") > 0.6))


query("mem_verify_record", _WRONG)(agg_member_document)


@query("mem_wrong_member", "SELECT doc_id, doc_id % 4 = 3 AS wrong FROM documents")
def mem_wrong_member(spark, sf):
    """A page names someone else: none of the names in its sentence is the member's."""
    return table(spark, sf, "documents").select("doc_id", (~F.exists(_span(), lambda n: n.isin("ana", "costa"))).alias("wrong"))


@query("mem_key_sentences", "SELECT doc_id, len(list_filter(string_split(coalesce(text, ''), '.'), lambda s: regexp_matches(lower(s), '\\bof the\\b')))::BIGINT AS sentences FROM documents")
def mem_key_sentences(spark, sf):
    s = F.filter(F.split(F.coalesce("text", F.lit("")), r"\."), lambda x: F.lower(x).rlike(S.ascii_marks(r"\bof the\b")))
    return table(spark, sf, "documents").select("doc_id", F.size(s).cast("long").alias("sentences"))


@query("mem_confidence", f"{_PR} SELECT chart, round(round(avg(CASE WHEN kind = 'main' THEN confidence ELSE 0.85 END), 8), 4) AS confidence FROM pages_o GROUP BY chart")
def mem_confidence(spark, sf):
    return order_pages(spark, sf).groupBy("chart").agg(F.round(F.round(F.avg(F.when(F.col("kind") == "main", F.col("confidence")).otherwise(0.85)), 8), 4).alias("confidence"))


_VOTE = f"{_PR}, s AS (SELECT chart, kind, sum(confidence * CASE WHEN page_no = 1 THEN 2 ELSE 1 END) AS w, max((page_no = 1)::INT) AS o, min(CASE kind WHEN 'main' THEN 1 WHEN 'junk' THEN 2 ELSE 3 END) AS p FROM pages_o GROUP BY chart, kind) SELECT chart, arg_max(kind, ((kind <> 'blank')::INT, round(w, 6), o, -p)) AS kind FROM s GROUP BY chart"


@query("agg_weighted_vote", _VOTE)
def agg_weighted_vote(spark, sf):
    first = F.col("page_no") == 1
    pr = F.when(F.col("kind") == "main", 1).when(F.col("kind") == "junk", 2).otherwise(3)
    return R.weighted_vote(order_pages(spark, sf), ["chart"], "kind", F.col("confidence") * F.when(first, 2).otherwise(1), first, pr, "blank")


query("enc_tally", _VOTE)(agg_weighted_vote)
query("enc_visit_scores", _VOTE)(agg_weighted_vote)

_AGREE = f"{_PR}, s AS (SELECT *, round(sum(confidence) OVER (PARTITION BY chart, kind) / nullif(sum(confidence) OVER (PARTITION BY chart), 0), 6) AS s FROM pages_o) SELECT chart, CASE WHEN arg_max(s, page_no) >= 0.5 THEN arg_max(kind, page_no) WHEN arg_min(s, page_no) >= 0.4 + 0.1 THEN arg_min(kind, page_no) ELSE arg_max(kind, (s, -page_no)) END AS kind FROM (SELECT * REPLACE (coalesce(s, -1) AS s) FROM s) GROUP BY chart"


@query("agg_document_agree", _AGREE)
def agg_document_agree(spark, sf):
    p = R.document_agree(order_pages(spark, sf), ["chart"], "kind", 0.5)
    return p


@query("agg_record_summary", f"{_PR}, n AS (SELECT chart, kind, count(*) AS n, min(page_no) AS first FROM pages_o GROUP BY ALL) SELECT chart, arg_max(kind, (n, -first)) AS modal, string_agg(kind, ',' ORDER BY first) AS all_values FROM n GROUP BY chart")
def agg_record_summary(spark, sf):
    return R.modal(order_pages(spark, sf), ["chart"], "kind", "page_no").withColumn("all_values", F.array_join("all_values", ","))


@query("agg_encounter_pages", f"{_PR} SELECT chart, doc_hint AS encounter, string_agg(page_no::VARCHAR, ',' ORDER BY page_no) AS pages, arg_min(kind, page_no) AS decision FROM pages_o GROUP BY chart, doc_hint")
def agg_encounter_pages(spark, sf):
    g = order_pages(spark, sf).groupBy("chart", F.col("doc_hint").alias("encounter")).agg(F.array_sort(F.collect_list("page_no")).alias("p"), F.min_by("kind", "page_no").alias("decision"))
    return g.select("chart", "encounter", F.array_join(F.transform("p", lambda x: x.cast("string")), ",").alias("pages"), "decision")


_CONV = "c AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n FROM conversations)"


def _conv(spark, sf):
    c = table(spark, sf, "conversations")
    return c.withColumn("n", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")))


@query("enc_first_page", f"WITH {_CONV} SELECT conv_id, n, coalesce(CASE WHEN role = 'system' THEN 'rule' END, first_value(role) OVER (PARTITION BY conv_id ORDER BY n)) AS decision FROM c")
def enc_first_page(spark, sf):
    """A family rule, else the first page decides for all."""
    first = F.first("role").over(Window.partitionBy("conv_id").orderBy("n"))
    return _conv(spark, sf).select("conv_id", F.col("n").cast("long").alias("n"), F.coalesce(F.when(F.col("role") == "system", "rule"), first).alias("decision"))


@query("enc_page_vote", f"{_PR} SELECT chart, page_no, CASE WHEN kind = 'blank' THEN 'NA' WHEN tax > 0.06 THEN 'evidence' WHEN confidence >= 0.5 THEN 'model' ELSE 'default' END AS vote FROM pages_o")
def enc_page_vote(spark, sf):
    return order_pages(spark, sf).select("chart", "page_no", R.ladder([(F.col("kind") == "blank", "NA"), (F.col("tax") > 0.06, "evidence"), (F.col("confidence") >= 0.5, "model")], "default").alias("vote"))


@query("enc_gather", f"WITH {_W}, neg AS (SELECT DISTINCT page_id FROM h WHERE term = 'der') SELECT page_id, label, count(*) AS findings FROM h WHERE NOT (label = 'en' AND page_id IN (SELECT page_id FROM neg)) GROUP BY ALL")
def enc_gather(spark, sf):
    """Phrase findings; a negative term on the page cancels a label's findings."""
    h = _hits(spark, sf)
    neg = h.where("term = 'der'").select("page_id").distinct().withColumn("label", F.lit("en"))
    return h.join(neg, ["page_id", "label"], "left_anti").groupBy("page_id", "label").agg(F.count("*").alias("findings"))


@query("enc_decide", f"WITH {_W} SELECT page_id, arg_min(label, (CASE WHEN weight >= 2 THEN 1 ELSE 2 END, -n, label)) AS label FROM (SELECT page_id, label, max(weight) AS weight, count(*) AS n FROM h GROUP BY ALL) GROUP BY page_id")
def enc_decide(spark, sf):
    """The label of the best tier, then of most findings."""
    s = _hits(spark, sf).groupBy("page_id", "label").agg(F.max("weight").alias("w"), F.count("*").alias("n"))
    return s.groupBy("page_id").agg(F.min(F.struct(F.when(F.col("w") >= 2, 1).otherwise(2).alias("t"), (-F.col("n")).alias("n"), "label")).alias("b")).select("page_id", "b.label")


@query("enc_rules_bootstrap", f"WITH {_W} SELECT page_id, round(sum(weight), 4)::DOUBLE AS score FROM h GROUP BY page_id")
def enc_rules_bootstrap(spark, sf):
    return _hits(spark, sf).groupBy("page_id").agg(F.round(F.sum("weight"), 4).alias("score"))


_KC = f"WITH {_W}, s AS (SELECT page_id, label, round(sum(weight), 6)::DOUBLE AS score FROM h GROUP BY ALL), r AS (SELECT *, row_number() OVER w AS rn, lead(score) OVER w AS nxt FROM s WINDOW w AS (PARTITION BY page_id ORDER BY score DESC, label)) SELECT page_id, label, score, round(score - coalesce(nxt, 0), 6)::DOUBLE AS margin FROM r WHERE rn = 1"


@query("pt_keyword_classify", _KC)
def pt_keyword_classify(spark, sf):
    return R.keyword_classify(_hits(spark, sf), "page_id")


query("pt_canon_score", _KC)(pt_keyword_classify)


@query("join_canon_terms", f"WITH {_W} SELECT page_id, term, label FROM h")
def join_canon_terms(spark, sf):
    return _hits(spark, sf).select("page_id", "term", "label")


@query("pt_specialty_scores", f"WITH {_W} SELECT page_id, label AS specialty, round(sum(weight), 6)::DOUBLE AS score FROM h GROUP BY ALL")
def pt_specialty_scores(spark, sf):
    return _hits(spark, sf).groupBy("page_id", F.col("label").alias("specialty")).agg(F.round(F.sum("weight"), 6).alias("score"))


_VP = f"WITH {_W}, s AS (SELECT page_id, label, sum(weight) AS w FROM h GROUP BY ALL), v AS (SELECT page_id, label, w / sum(w) OVER (PARTITION BY page_id) AS share FROM s) SELECT page_id, CASE WHEN max(share) >= 0.6 THEN arg_max(label, (round(share, 6), label)) ELSE 'Others' END AS label FROM v GROUP BY page_id"


@query("pt_vote_pick", _VP)
def pt_vote_pick(spark, sf):
    s = _hits(spark, sf).groupBy("page_id", "label").agg(F.sum("weight").alias("w"))
    v = s.withColumn("share", F.col("w") / F.sum("w").over(Window.partitionBy("page_id")))
    g = v.groupBy("page_id").agg(F.max(F.struct(F.round("share", 6).alias("r"), "label", "share")).alias("b"))
    return g.select("page_id", F.when(F.col("b.share") >= 0.6, F.col("b.label")).otherwise("Others").alias("label"))


@query("pt_rules", "SELECT doc_id, CASE WHEN len(regexp_extract_all(text, '(?i)\\bthe\\b')) >= 5 THEN 'summary' WHEN len(regexp_extract_all(text, '(?i)\\bder\\b')) >= 2 THEN 'stay' ELSE 'none' END AS rule FROM documents")
def pt_rules(spark, sf):
    n = lambda w: F.regexp_count("text", F.lit(S.ascii_marks(rf"(?i)\b{w}\b")))
    return table(spark, sf, "documents").select("doc_id", R.ladder([(n("the") >= 5, "summary"), (n("der") >= 2, "stay")], "none").alias("rule"))


@query("pt_route", f"{_PR} SELECT chart, page_no, CASE WHEN confidence >= 0.7 AND confidence - tax >= 0.3 THEN 'model' WHEN kind = 'main' THEN 'canon' ELSE 'review' END AS route FROM pages_o")
def pt_route(spark, sf):
    c = F.col("confidence")
    return order_pages(spark, sf).select("chart", "page_no", R.ladder([((c >= 0.7) & (c - F.col("tax") >= 0.3), "model"), (F.col("kind") == "main", "canon")], "review").alias("route"))


@query("pt_codeability", f"{_PR} SELECT chart, page_no, CASE WHEN kind = 'main' AND print = 'printed' THEN 'yes' WHEN kind = 'main' THEN 'maybe' WHEN kind = 'junk' THEN 'no' ELSE 'family' END AS tag FROM pages_o")
def pt_codeability(spark, sf):
    """A path's tag at its deepest level that has one; a mapping of fixed size, so as expressions."""
    deep = S.page_kind_map(F.concat_ws(">", "kind", "print"), {"main>printed": "yes"})
    flat = S.page_kind_map(F.col("kind"), {"main": "maybe", "junk": "no"})
    return order_pages(spark, sf).select("chart", "page_no", F.coalesce(deep, flat, F.lit("family")).alias("tag"))


@query("pt_confidence", f"{_PR} SELECT chart, page_no, round(confidence * CASE WHEN kind = 'main' THEN 1 - tax ELSE 1 END, 6)::DOUBLE AS confidence FROM pages_o")
def pt_confidence(spark, sf):
    levels = F.when(F.col("kind") == "main", F.array(F.col("confidence"), 1 - F.col("tax"))).otherwise(F.array("confidence"))
    return order_pages(spark, sf).select("chart", "page_no", F.round(F.aggregate(levels, F.lit(1.0), lambda a, x: a * x), 6).alias("confidence"))


@query("pt_mask_decode", f"{_PR}, m AS (SELECT * FROM (VALUES ('main', 'printed'), ('main', 'handwritten'), ('junk', 'printed')) v(kind, print)), j AS (SELECT p.chart, p.page_no, p.kind, m.print, p.confidence * CASE m.print WHEN 'printed' THEN 0.6 ELSE 0.4 END AS prob FROM pages_o p JOIN m ON m.kind = p.kind) SELECT chart, page_no, arg_max(print, (round(prob, 6), print)) AS l2, round(max(prob), 6) AS prob FROM j GROUP BY chart, page_no")
def pt_mask_decode(spark, sf):
    """Children allowed under a page's family, and the best path by the product of probabilities. The rule table goes to the pages: families
    are few, so by a shuffle all pages of one would be one task's."""
    allowed = spark.createDataFrame([("main", "printed"), ("main", "handwritten"), ("junk", "printed")], "kind string, l2 string")
    j = order_pages(spark, sf).select("chart", "page_no", "kind", "confidence").join(F.broadcast(allowed), "kind").withColumn("prob", F.col("confidence") * F.when(F.col("l2") == "printed", 0.6).otherwise(0.4))
    return j.groupBy("chart", "page_no").agg(F.max(F.struct(F.round("prob", 6).alias("p"), "l2")).alias("b")).select("chart", "page_no", "b.l2", F.col("b.p").alias("prob"))


@query("pt_canon_convert", f"{_PR}, m AS (SELECT * FROM (VALUES ('main', 'note'), ('junk', 'other')) v(kind, new)) SELECT coalesce(new, 'unresolved') AS new, count(*) AS n FROM pages_o LEFT JOIN m USING (kind) GROUP BY 1")
def pt_canon_convert(spark, sf):
    m = spark.createDataFrame([("main", "note"), ("junk", "other")], "kind string, new string")
    return order_pages(spark, sf).join(F.broadcast(m), "kind", "left").groupBy(F.coalesce("new", F.lit("unresolved")).alias("new")).agg(F.count("*").alias("n"))


@query("pt_final", f"{_PR}, a AS (SELECT chart, arg_max(kind, (confidence, -page_no)) AS fam FROM pages_o GROUP BY chart) SELECT p.chart, p.page_no, CASE WHEN p.kind = a.fam THEN p.kind WHEN p.confidence >= 0.8 THEN p.kind ELSE a.fam END AS final FROM pages_o p JOIN a USING (chart)")
def pt_final(spark, sf):
    """Pages take their document's family unless they are sure of their own."""
    p = order_pages(spark, sf)
    a = p.groupBy("chart").agg(F.max_by("kind", F.struct("confidence", -F.col("page_no"))).alias("fam"))
    return p.join(a, "chart").select("chart", "page_no", F.when((F.col("kind") == F.col("fam")) | (F.col("confidence") >= 0.8), F.col("kind")).otherwise(F.col("fam")).alias("final"))


@query("pt_gate", f"{_PR} SELECT chart, page_no, CASE WHEN kind = 'blank' THEN 'none' WHEN confidence >= 0.5 THEN kind ELSE 'review' END AS l1, CASE WHEN kind = 'main' AND confidence >= 0.5 THEN print END AS l2, CASE WHEN tax > 0.04 THEN 'specialty' END AS specialty FROM pages_o")
def pt_gate(spark, sf):
    k, sure = F.col("kind"), F.col("confidence") >= 0.5
    return order_pages(spark, sf).select("chart", "page_no", F.when(k == "blank", "none").when(sure, k).otherwise("review").alias("l1"), F.when((k == "main") & sure, F.col("print")).alias("l2"), F.when(F.col("tax") > 0.04, "specialty").alias("specialty"))


@query("pt_vote_eval", f"{_PR}, g AS (SELECT unnest([0.2, 0.5, 0.8])::DOUBLE AS bar) SELECT bar, round(avg((CASE WHEN confidence >= bar THEN kind ELSE 'main' END = CASE WHEN tax > 0.04 THEN kind ELSE 'main' END)::INT), 6) AS accuracy FROM g CROSS JOIN pages_o GROUP BY bar")
def pt_vote_eval(spark, sf):
    """Accuracy at each point of a grid, in one pass: a column for each point."""
    truth = F.when(F.col("tax") > 0.04, F.col("kind")).otherwise("main")
    grid = (0.2, 0.5, 0.8)
    one = order_pages(spark, sf).agg(*(F.avg((F.when(F.col("confidence") >= b, F.col("kind")).otherwise("main") == truth).cast("int")).alias(f"b{i}") for i, b in enumerate(grid)))
    return one.select(F.explode(F.array(*(F.struct(F.lit(b).alias("bar"), F.round(f"b{i}", 6).alias("accuracy")) for i, b in enumerate(grid)))).alias("x")).select("x.*")


_TF = f"WITH t AS (SELECT doc_id, w AS term, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '{S.WORD}')) AS w FROM documents) GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM t GROUP BY term), w AS (SELECT doc_id, term, (1 + ln(tf)) * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)::DOUBLE) + 1) AS w FROM t JOIN df USING (term)), l AS (SELECT doc_id, sqrt(sum(w * w)) AS l2 FROM w GROUP BY doc_id), x AS (SELECT doc_id, term, w / l2 AS weight FROM w JOIN l USING (doc_id))"


@query("agg_tfidf_corpus", _TF + " SELECT doc_id, count(*) AS terms, round(max(weight), 5) AS top FROM x GROUP BY doc_id")
def agg_tfidf_corpus(spark, sf):
    d = table(spark, sf, "documents")
    return R.tfidf(d, "doc_id", S.words(F.col("text"))).groupBy("doc_id").agg(F.count("*").alias("terms"), F.round(F.max("weight"), 5).alias("top"))


@query("str_tfidf_cosine", _TF + ", n AS (SELECT doc_id, lead(doc_id) OVER (ORDER BY doc_id) AS other FROM (SELECT DISTINCT doc_id FROM documents) WHERE doc_id % 2 = 0 OR true) SELECT n.doc_id, n.other, round(coalesce(sum(a.weight * b.weight), 0), 4) AS cosine FROM n LEFT JOIN x a ON a.doc_id = n.doc_id LEFT JOIN x b ON b.doc_id = n.other AND b.term = a.term WHERE other = n.doc_id + 1 GROUP BY ALL")
def str_tfidf_cosine(spark, sf):
    """Cosine of each document with that of the next id: both sides of a pair meet by pair and term, and one sum makes the product."""
    d = table(spark, sf, "documents")
    x = R.tfidf(d, "doc_id", S.words(F.col("text")))
    ids = d.select("doc_id").distinct()
    pairs = ids.join(ids.select((F.col("doc_id") - 1).alias("doc_id")), "doc_id", "left_semi").select("doc_id", (F.col("doc_id") + 1).alias("other"))
    both = x.select("doc_id", "term", "weight").join(x.select((F.col("doc_id") - 1).alias("doc_id"), "term", F.col("weight").alias("v")), ["doc_id", "term"])
    dot = both.groupBy("doc_id").agg(F.sum(F.col("weight") * F.col("v")).alias("dot"))
    return pairs.join(dot, "doc_id", "left").select("doc_id", "other", F.round(F.coalesce("dot", F.lit(0.0)), 4).alias("cosine"))


@query("agg_keyword_weights", f"WITH {_W}, s AS (SELECT h.term, p.lang, count(*) AS k FROM h JOIN pages_a p USING (page_id) GROUP BY ALL), n AS (SELECT lang, count(*) AS n FROM pages_a GROUP BY lang), tt AS (SELECT term, sum(k) AS tk FROM s GROUP BY term) SELECT s.term, s.lang, round(least(4, ln((k + 1) / (n + 2)::DOUBLE) - ln((tk - k + 1) / ((SELECT count(*) FROM pages_a) - n + 2)::DOUBLE)), 5)::DOUBLE AS weight FROM s JOIN n USING (lang) JOIN tt USING (term)")
def agg_keyword_weights(spark, sf):
    """Laplace-smoothed log odds of a term in a class against the other classes, capped."""
    p = pages(spark, sf).select("page_id", "lang")
    s = _hits(spark, sf).join(p, "page_id").groupBy("term", "lang").agg(F.count("*").alias("k"))
    n = p.groupBy("lang").agg(F.count("*").alias("n"))
    t = s.groupBy("term").agg(F.sum("k").alias("tk"))
    total = p.agg(F.count("*").alias("t"))
    j = s.join(n, "lang").join(t, "term").crossJoin(total)
    odds = F.log((F.col("k") + 1) / (F.col("n") + 2)) - F.log((F.col("tk") - F.col("k") + 1) / (F.col("t") - F.col("n") + 2))
    return j.select("term", "lang", F.round(F.least(F.lit(4.0), odds), 5).alias("weight"))


@query("agg_keyword_mining", f"WITH g AS (SELECT DISTINCT doc_id, lang, unnest(regexp_extract_all(lower(coalesce(text, '')), '{S.WORD}')) AS phrase FROM documents), s AS (SELECT phrase, lang, count(*) AS k FROM g GROUP BY ALL), e AS (SELECT phrase, sum(k)::BIGINT AS n FROM s GROUP BY phrase HAVING sum(k) >= 20), c AS (SELECT lang, count(*) AS c FROM documents GROUP BY lang), j AS (SELECT s.lang, s.phrase, k, n, round(k / n::DOUBLE, 6) AS precision, round((k / n::DOUBLE) / (c / (SELECT count(*) FROM documents)::DOUBLE), 6) AS lift FROM s JOIN e USING (phrase) JOIN c USING (lang)), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY round(precision * ln(1 + k), 6) DESC, phrase) AS place FROM j) SELECT * FROM r WHERE place <= 5")
def agg_keyword_mining(spark, sf):
    d = table(spark, sf, "documents")
    return R.keyword_mining(d, "lang", S.words(F.col("text")), 20, 5)


@query("agg_key_harvest", f"WITH {_W} SELECT label, term, count(*) AS n, min(page_id) AS example FROM h GROUP BY label, term")
def agg_key_harvest(spark, sf):
    return _hits(spark, sf).groupBy("label", "term").agg(F.count("*").alias("n"), F.min("page_id").alias("example"))


@query("join_header_candidates", f"WITH {PAGES}, {_T}, c AS (SELECT DISTINCT label FROM t), k AS (SELECT label, list(term) AS terms FROM t GROUP BY label), p AS (SELECT page_id, list_distinct(regexp_extract_all(lower(split_part(coalesce(text, ''), chr(10), 1)), '{S.WORD}')) AS w FROM pages_a), s AS (SELECT page_id, label, len(list_intersect(w, terms)) / nullif(len(w) + len(terms) - len(list_intersect(w, terms)), 0)::DOUBLE AS score FROM p CROSS JOIN k) SELECT page_id, arg_max(label, (round(score, 6), label)) AS label, round(max(score), 6) AS score FROM s WHERE score > 0 GROUP BY page_id")
def join_header_candidates(spark, sf):
    """A header against a catalogue: only entries that share a word are scored, so the join has a key."""
    cat = spark.createDataFrame(_TERMS, "term string, g string, label string, weight double")
    size = cat.groupBy("label").agg(F.count("*").alias("n_t"))
    head = pages(spark, sf).select("page_id", S.unique_words(F.split_part(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(1))).alias("w"))
    hit = head.select("page_id", F.size("w").alias("n_w"), F.explode("w").alias("term")).join(cat, "term").groupBy("page_id", "n_w", "label").agg(F.count("*").alias("sh")).join(size, "label")
    s = hit.withColumn("score", F.col("sh") / (F.col("n_w") + F.col("n_t") - F.col("sh")))
    return s.groupBy("page_id").agg(F.max(F.struct(F.round("score", 6).alias("r"), "label")).alias("b")).select("page_id", "b.label", F.col("b.r").alias("score"))


@query("dos_per_page", f"{_PR} SELECT chart, page_no, coalesce(CASE WHEN kind = 'main' THEN dos END, CASE WHEN tax > 0.04 THEN dos + 1 END, CASE WHEN print = 'printed' THEN dos + 2 END)::VARCHAR AS dos, CASE WHEN kind = 'main' THEN 'stay' WHEN tax > 0.04 THEN 'key' WHEN print = 'printed' THEN 'edge' ELSE 'none' END AS source FROM pages_o")
def dos_per_page(spark, sf):
    """The first of five kinds of date that a page has, with where it came from."""
    c = lambda ok, d, s: F.when(ok, F.struct(d.alias("dos"), F.lit(s).alias("source")))
    best = F.coalesce(c(F.col("kind") == "main", F.col("dos"), "stay"), c(F.col("tax") > 0.04, F.date_add("dos", 1), "key"), c(F.col("print") == "printed", F.date_add("dos", 2), "edge"))
    return order_pages(spark, sf).withColumn("b", best).select("chart", "page_no", F.col("b.dos").cast("string").alias("dos"), F.coalesce("b.source", F.lit("none")).alias("source"))


@query("dos_confidence", f"{_PR} SELECT chart, page_no, round(confidence * CASE WHEN tax * 10 >= 0.8 * confidence THEN 0.8 ELSE 1 END, 6)::DOUBLE AS confidence FROM pages_o")
def dos_confidence(spark, sf):
    rivals = F.filter(F.array(F.col("tax") * 10), lambda r: r >= 0.8 * F.col("confidence"))
    return order_pages(spark, sf).select("chart", "page_no", F.round(F.col("confidence") * F.when(F.size(rivals) > 0, 0.8).otherwise(1.0), 6).alias("confidence"))


@query("dos_combined_text", f"WITH {PAGES} SELECT chart, md5(string_agg('===== ' || page_no || ' =====' || chr(10) || coalesce(text, ''), chr(10) ORDER BY page_no)) AS text FROM pages_a GROUP BY chart")
def dos_combined_text(spark, sf):
    """A chart's marked text, its pages in order."""
    piece = F.concat(F.lit("===== "), F.col("page_no").cast("string"), F.lit(" =====\n"), F.coalesce("text", F.lit("")))
    g = pages(spark, sf).groupBy("chart").agg(F.array_sort(F.collect_list(F.struct("page_no", piece.alias("t")))).alias("p"))
    return g.select("chart", F.md5(F.array_join(F.transform("p", lambda x: x["t"]), "\n").cast("binary")).alias("text"))


def _mark(name, sql, build):
    query(name, f"{_PR} SELECT chart, page_no, {sql} AS mark FROM pages_o")(lambda spark, sf: order_pages(spark, sf).select("chart", "page_no", build().alias("mark")))


_mark("mark_presence", "CASE WHEN tax = 0 THEN 'unknown' WHEN (kind = 'main') = (confidence > 0.5) THEN 'match' ELSE 'mismatch' END", lambda: R.ladder([(F.col("tax") == 0, "unknown"), ((F.col("kind") == "main") == (F.col("confidence") > 0.5), "match")], "mismatch"))
_mark("mark_date", "CASE WHEN page_no % 4 = 3 THEN 'unknown' WHEN part % 3 = 0 THEN 'match' WHEN year(dos) = year(dos + 40) OR month(dos) = month(dos + 40) OR day(dos) = day(dos + 40) THEN 'partial' ELSE 'mismatch' END", lambda: _mark_date(F.when(F.col("page_no") % 4 != 3, F.col("dos")), F.when(F.col("part") % 3 == 0, F.col("dos")).otherwise(F.date_add("dos", 40))))
_mark("mark_blank_junk", "CASE WHEN (kind <> 'main') = (tax > 0.04) THEN 'match' ELSE 'mismatch' END", lambda: F.when(F.when(F.col("kind") == "main", "No").otherwise("Yes (x)").startswith("Yes") == (F.col("tax") > 0.04), "match").otherwise("mismatch"))
_mark("mark_codeable", "CASE WHEN (kind = 'main') = (tax > 0.04) THEN 'match' ELSE 'mismatch' END", lambda: F.when(F.when(F.col("kind") == "main", "codeable").otherwise("Non-codeable").rlike("(?i)^non") == F.when(F.col("tax") > 0.04, "x").otherwise("NON").rlike("(?i)^non"), "match").otherwise("mismatch"))
_mark("mark_rotation", "CASE WHEN (quantity * 10)::BIGINT % 90 <> 0 THEN 'not scored' WHEN (quantity * 10)::BIGINT % 360 = 0 THEN 'match' ELSE 'mismatch' END", lambda: R.ladder([(F.pmod(F.round(F.col("quantity") * 10).cast("long"), F.lit(90)) != 0, "not scored"), (F.pmod(F.round(F.col("quantity") * 10).cast("long"), F.lit(360)) == 0, "match")], "mismatch"))
_mark("mark_sequence", "CASE WHEN page_no = quantity::BIGINT THEN 'match' ELSE 'mismatch' END", lambda: F.when(F.col("page_no").cast("string").try_cast("double") == F.col("quantity"), "match").otherwise("mismatch"))
_mark("mark_has_label", "CASE WHEN kind <> 'blank' OR tax > 0.04 THEN 'yes' ELSE 'no' END", lambda: F.when(F.coalesce(F.when(F.col("kind") != "blank", F.col("kind")), F.when(F.col("tax") > 0.04, F.lit("x"))).isNotNull(), "yes").otherwise("no"))
_mark("mark_credentials_legacy", "coalesce(CASE WHEN tax > 0.05 THEN 'MD' END, CASE WHEN kind = 'main' THEN 'legacy' END, 'none')", lambda: F.coalesce(F.nullif(F.trim(F.when(F.col("tax") > 0.05, "MD").otherwise(" ")), F.lit("")), F.when(F.col("kind") == "main", "legacy"), F.lit("none")))
_mark("mark_page_type", "CASE WHEN kind = print THEN 'match' WHEN kind = 'main' THEN 'match' WHEN kind = 'junk' AND print = 'printed' THEN 'partial' ELSE 'mismatch' END", lambda: S.page_kind_map(F.concat_ws(">", "kind", "print"), {"main>printed": "match", "main>handwritten": "match", "junk>printed": "partial"}, "mismatch"))
_mark("mark_vocab_view", "CASE kind WHEN 'main' THEN 'handwritten,printed' WHEN 'junk' THEN 'printed' ELSE '' END", lambda: S.page_kind_map(F.lower("kind"), {"main": "handwritten,printed", "junk": "printed"}, ""))


def _mark_date(a, b):
    near = (F.year(a) == F.year(b)) | (F.month(a) == F.month(b)) | (F.day(a) == F.day(b))
    return R.ladder([(a.isNull() | b.isNull(), "unknown"), (a == b, "match"), (near, "partial")], "mismatch")


@query("acc_bulk_labels", "SELECT d.doc_id, l.quality FROM documents d JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l USING (doc_id)")
def acc_bulk_labels(spark, sf):
    latest = table(spark, sf, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return table(spark, sf, "documents").select("doc_id").join(latest, "doc_id")


@query("acc_semantic", "WITH e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings), c AS (SELECT label, i, avg(x) AS m FROM e GROUP BY ALL), p AS (SELECT e.vec_id, c.label, sum(e.x * c.m) / nullif(sqrt(sum(c.m * c.m)) * sqrt(sum(e.x * e.x)), 0) AS s FROM e JOIN c ON e.i = c.i GROUP BY ALL) SELECT vec_id, round(max(s), 4) AS best FROM p GROUP BY vec_id")
def acc_semantic(spark, sf):
    """The best cosine between a vector and the labels' mean vectors. Labels are a fixed set; their means are one row each, of the vector's
    whole length, summed by place before they meet."""
    e = table(spark, sf, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    places = e.select("label", F.posexplode("v").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("m"))
    means = places.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda z: z["m"]).alias("m")).agg(F.collect_list("m").alias("ms"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    best = F.array_max(F.transform("ms", lambda m: dot(F.col("v"), m) / (F.sqrt(dot(m, m)) * F.sqrt(dot(F.col("v"), F.col("v"))))))
    return e.crossJoin(means).select("vec_id", F.round(best, 4).alias("best"))


@query("maint_label_new_pages", f"{_PR} SELECT chart, page_no, CASE kind WHEN 'main' THEN 'Note' WHEN 'junk' THEN 'Other' ELSE 'None' END AS l1, CASE WHEN kind = 'main' THEN print END AS l2 FROM pages_o")
def maint_label_new_pages(spark, sf):
    return order_pages(spark, sf).select("chart", "page_no", S.page_kind_map(F.col("kind"), {"main": "Note", "junk": "Other"}, "None").alias("l1"), F.when(F.col("kind") == "main", F.col("print")).alias("l2"))


@query("local_status", "SELECT o_orderkey AS chart, CASE WHEN n IS NULL THEN 'empty' WHEN done = n THEN 'complete' WHEN done > 0 THEN 'partial' ELSE 'queued' END AS status FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_linestatus = 'O') AS done FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")
def local_status(spark, sf):
    n = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.count_if(F.col("l_linestatus") == "O").alias("done"))
    j = table(spark, sf, "orders").join(n, "o_orderkey", "left")
    return j.select(F.col("o_orderkey").alias("chart"), R.ladder([(F.col("n").isNull(), "empty"), (F.col("done") == F.col("n"), "complete"), (F.col("done") > 0, "partial")], "queued").alias("status"))


@query("local_coverage_index", f"{_PR} SELECT chart, string_agg(DISTINCT kind, ',' ORDER BY kind) AS streams, count(DISTINCT page_no) AS pages FROM pages_o GROUP BY chart")
def local_coverage_index(spark, sf):
    return order_pages(spark, sf).groupBy("chart").agg(F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("streams"), F.countDistinct("page_no").alias("pages"))


@query("local_ocr_display", "SELECT page_id, md5(regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM pages")
def local_ocr_display(spark, sf):
    h = F.regexp_replace(F.regexp_replace(F.coalesce("html", F.lit("")), "<[^>]*>", " "), r"\s+", " ")
    return table(spark, sf, "pages").select("page_id", F.md5(h.cast("binary")).alias("text"))
