"""Queries of the string functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioframe.functions import strings as S
from folioframe.plans.base import PAGES, pages, query, table, with_previous

_W = S.WS
_WORDS = f"regexp_extract_all(lower(coalesce(text, '')), '{S.WORD}')"


def _each(name, sql, build):
    query(name, f"SELECT doc_id, {sql} FROM documents")(lambda spark, sf: table(spark, sf, "documents").select("doc_id", *build(F.col("text"))))


_each("str_normalize_duplicate", f"md5(lower(regexp_replace(coalesce(text, ''), '{_W}', '', 'g'))) AS normal", lambda t: [F.md5(S.normalize_duplicate(t).cast("binary")).alias("normal")])
_each("str_fingerprint", f"CASE WHEN length(regexp_replace(text, '{_W}', '', 'g')) >= 50 THEN sha256(lower(regexp_replace(text, '{_W}', '', 'g'))) END AS fingerprint", lambda t: [S.fingerprint(t).alias("fingerprint")])
_each("str_unique_words", f"len(list_distinct({_WORDS}))::BIGINT AS n, md5(array_to_string(list_sort(list_distinct({_WORDS})), ' ')) AS words", lambda t: [F.size(S.unique_words(t)).cast("long").alias("n"), F.md5(F.array_join(F.array_sort(S.unique_words(t)), " ").cast("binary")).alias("words")])
_each("str_clean_text", f"md5(lower(trim(regexp_replace(coalesce(text, ''), '{_W}', ' ', 'g')))) AS clean", lambda t: [F.md5(S.clean_text(t).cast("binary")).alias("clean")])
_each("str_word_counts", f"len({_WORDS})::BIGINT AS n_words", lambda t: [S.word_count(t).alias("n_words")])
_each("str_header_key", "lower(regexp_replace(source || ' _ ' || lang, '[\\s_]+', '', 'g')) AS key", lambda t: [S.header_key(F.concat("source", F.lit(" _ "), "lang")).alias("key")])
_each("str_name_key", "array_to_string(list_sort(regexp_extract_all(lower(split_part(coalesce(text, ''), chr(10), 1)), '[\\p{L}\\p{N}_]+')), ' ') AS key", lambda t: [S.name_key(F.split_part(F.coalesce(t, F.lit("")), F.lit("\n"), F.lit(1))).alias("key")])
_each("str_identifier", "regexp_replace(trim(doc_id::VARCHAR || CASE WHEN doc_id % 3 = 0 THEN '.0' WHEN doc_id % 3 = 1 THEN '.50' ELSE '' END), '^([+-]?\\d+)\\.0+$', '\\1') AS id", lambda t: [S.identifier(F.concat(F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 3 == 0, ".0").when(F.col("doc_id") % 3 == 1, ".50").otherwise(""))).alias("id")])
_each("str_page_id_stem", "try_cast(nullif(regexp_extract(doc_id::VARCHAR || CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN '.jpg' WHEN 2 THEN '.0' ELSE 'x' END, '^(\\d{1,9})(\\.[^.]*)?$', 1), '') AS INT) AS page_no", lambda t: [S.page_id_stem(F.concat(F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 4 == 0, "").when(F.col("doc_id") % 4 == 1, ".jpg").when(F.col("doc_id") % 4 == 2, ".0").otherwise("x"))).alias("page_no")])
_each("str_masked_line", "regexp_replace(regexp_replace(regexp_replace(lower(trim(split_part(text, chr(10), 1) || ' 2024-01-02 n 17')), '\\d{1,4}[/.-]\\d{1,2}[/.-]\\d{1,4}', '<date>', 'g'), '\\d', '#', 'g'), '" + _W + "', ' ', 'g') AS line", lambda t: [S.masked_line(F.concat(F.split_part(t, F.lit("\n"), F.lit(1)), F.lit(" 2024-01-02 n 17"))).alias("line")])
_each("str_continued_cues", "coalesce(regexp_matches(lower(text), '\\bcont(inued|d|''d)?\\b\\.?'), false) AS continued, rtrim(coalesce(text, '')) <> '' AND NOT regexp_matches(rtrim(coalesce(text, '')), '[.!?:;)\\]\"'']$') AS open_end, coalesce(regexp_matches(ltrim(text), '^\\p{Ll}'), false) AS lower_start", lambda t: [S.says_continued(t).alias("continued"), S.mid_sentence_end(t).alias("open_end"), S.lower_start(t).alias("lower_start")])
_each("str_whole_word_regex", "len(regexp_extract_all(coalesce(text, ''), '(?i)\\bof\\s+the\\b'))::BIGINT AS hits", lambda t: [S.whole_word(t, "of the").alias("hits")])
_each("str_docling_clean", "md5(trim(regexp_replace(regexp_replace(regexp_replace('<!-- image -->' || coalesce(text, '') || chr(10) || '| | |' || chr(10) || chr(10) || chr(10) || 'x', '<!--[^>]*-->|!\\[[^\\]]*\\]\\([^)]*\\)', '', 'g'), '(?m)^[\\s|:-]*\\|[\\s|:-]*$', '', 'g'), '\\n{3,}', chr(10) || chr(10), 'g'))) AS clean", lambda t: [F.md5(S.clean_markup(F.concat(F.lit("<!-- image -->"), F.coalesce(t, F.lit("")), F.lit("\n| | |\n\n\nx"))).cast("binary")).alias("clean")])
_each("str_heading_shape", "coalesce(regexp_replace(lower(trim(regexp_replace(split_part(text, chr(10), 1), '" + _W + "', ' ', 'g'))), '[:.]+$', '') = 'that it' OR (starts_with(lower(trim(regexp_replace(split_part(text, chr(10), 1), '" + _W + "', ' ', 'g'))), 'the') AND length(regexp_replace(lower(trim(regexp_replace(split_part(text, chr(10), 1), '" + _W + "', ' ', 'g'))), '[:.]+$', '')) <= 15), false) AS heading", lambda t: [F.coalesce(S.heading_shape(F.split_part(t, F.lit("\n"), F.lit(1)), "that it", -99) | S.heading_shape(F.split_part(t, F.lit("\n"), F.lit(1)), "the"), F.lit(False)).alias("heading")])
_each("str_yes_no", "CASE doc_id % 7 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' WHEN 2 THEN '' WHEN 3 THEN 'yes' WHEN 4 THEN 'yes' WHEN 5 THEN 'maybe' ELSE 'no' END AS value", lambda t: [S.yes_no(F.element_at(F.array(*map(F.lit, (" Yes ", "N", "n/a", "Duplicate (to page 3)", "TRUE (seen)", "Maybe", "No (x)"))), (F.col("doc_id") % 7 + 1).cast("int"))).alias("value")])
_each("str_codable", "CASE doc_id % 5 WHEN 0 THEN 'codable' WHEN 1 THEN 'non codable' WHEN 2 THEN 'non codable' WHEN 3 THEN 'other' ELSE 'codable' END AS value", lambda t: [S.codable(F.element_at(F.array(*map(F.lit, ("Codeable", "Non-Codable", "not codeable", "Other", " codable "))), (F.col("doc_id") % 5 + 1).cast("int"))).alias("value")])
_each("str_print_type", "CASE doc_id % 4 WHEN 0 THEN 'printed' WHEN 1 THEN 'handwritten' WHEN 2 THEN 'printed' ELSE 'mixed' END AS value", lambda t: [S.print_type(F.element_at(F.array(*map(F.lit, ("Print", "HW", " typed ", "Mixed"))), (F.col("doc_id") % 4 + 1).cast("int"))).alias("value")])
_each("str_credentials", "CASE doc_id % 3 WHEN 0 THEN 'MD PHD' WHEN 1 THEN 'RN' ELSE '' END AS tokens, doc_id % 3 = 0 AS has_md", lambda t: [F.array_join(S.credential_tokens(v := F.element_at(F.array(F.lit("M.D., Ph.D., M.D."), F.lit("R.N."), F.lit(" ,; ")), (F.col("doc_id") % 3 + 1).cast("int"))), " ").alias("tokens"), F.arrays_overlap(S.credential_tokens(v), F.array(F.lit("MD"))).alias("has_md")])
_each("str_markers", "CASE WHEN doc_id % 9 = 0 THEN NULL ELSE (doc_id % 9)::INT END AS num, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE 9 END AS total", lambda t: [c.alias(n) for n, c in zip(("num", "total"), S.marker(F.concat(F.lit("Header\nPage "), (F.col("doc_id") % 9).cast("string"), F.lit(" of 9"))))])
_each("str_ngrams", f"len(w)::BIGINT AS n_words, greatest(len(w) - 1, 0)::BIGINT AS n_pairs, md5(array_to_string(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), '|')) AS pairs FROM (SELECT doc_id, {_WORDS} AS w FROM documents) documents", lambda t: [S.word_count(t).alias("n_words"), F.size(S.word_grams(t)).cast("long").alias("n_pairs"), F.md5(F.array_join(S.word_grams(t), "|").cast("binary")).alias("pairs")])
from folioframe.plans.base import SQL  # noqa: E402

SQL["str_ngrams"] = SQL["str_ngrams"].rsplit(" FROM documents", 1)[0]
_each("str_char_ngrams", "n_grams FROM (SELECT doc_id, list_sum(list_transform(regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]+'), lambda w: greatest(length(w), 0) + greatest(length(w) - 1, 0) + greatest(length(w) - 2, 0)))::BIGINT AS n_grams FROM documents) documents", lambda t: [F.nullif(F.size(S.char_grams(t)), F.lit(0)).cast("long").alias("n_grams")])
SQL["str_char_ngrams"] = SQL["str_char_ngrams"].rsplit(" FROM documents", 1)[0]
_each("str_ocr_features", f"length(coalesce(text, ''))::BIGINT AS n_chars, len({_WORDS})::BIGINT AS n_words, len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x) <> ''))::BIGINT AS n_lines, round(coalesce(len(list_distinct({_WORDS}))::DOUBLE / nullif(len({_WORDS}), 0), 0), 6) AS distinct_share, round(coalesce(len(regexp_extract_all(text, '[0-9]'))::DOUBLE / nullif(length(text), 0), 0), 6) AS digit_share, round(coalesce(len(regexp_extract_all(text, '\\p{{Lu}}'))::DOUBLE / nullif(length(text), 0), 0), 6) AS upper_share, round(coalesce(len(regexp_extract_all(text, '[^\\p{{L}}\\p{{N}}\\s]'))::DOUBLE / nullif(length(text), 0), 0), 6) AS mark_share, len(regexp_extract_all(text, ':'))::BIGINT AS n_colons", lambda t: [(F.round(c, 6) if n.endswith("share") else c).alias(n) for n, c in S.ocr_features(t).items()])
_each("str_one_edit_tokens", "doc_id % 4 <> 3 AS alike", lambda t: [S.one_edit_tokens(F.lit("progress note"), F.element_at(F.array(*map(F.lit, ("Progress Notes", "progres note", "Progress note", "process not"))), (F.col("doc_id") % 4 + 1).cast("int"))).alias("alike")])
_each("str_trim_name", "CASE doc_id % 2 WHEN 0 THEN 'Ana B. Costa' ELSE 'Someone Else' END AS name", lambda t: [S.trim_name(F.when(F.col("doc_id") % 2 == 0, "Patient Ana B. Costa DOB").otherwise("Someone Else"), F.lit("Costa, Ana")).alias("name")])
_each("str_same_type_map", "CASE lang WHEN 'en' THEN 'note' WHEN 'de' THEN 'lab' ELSE 'other' END AS kind", lambda t: [S.page_kind_map(F.col("lang"), {"en": "note", "de": "lab"}, "other").alias("kind")])


def _neighbors(spark, sf):
    """Each page beside the one before it in its chart."""
    return with_previous(pages(spark, sf))


_PAIR = f"WITH {PAGES}, n AS (SELECT *, lag(text) OVER (PARTITION BY chart ORDER BY page_no) AS prev FROM pages_a), p AS (SELECT *, list_distinct(regexp_extract_all(lower(text), '{S.WORD}')) AS a, list_distinct(regexp_extract_all(lower(prev), '{S.WORD}')) AS b FROM n WHERE prev IS NOT NULL), s AS (SELECT *, len(list_intersect(a, b)) AS sh FROM p) "


@query("str_word_overlap", _PAIR + "SELECT page_id, sh::BIGINT AS shared, round(coalesce(sh / nullif(len(a) + len(b) - sh, 0)::DOUBLE, 0), 6) AS overlap, round(coalesce(sh / nullif(least(len(a), len(b)), 0)::DOUBLE, 0), 6) AS contained, (len(a) + len(b) - 2 * sh)::BIGINT AS different FROM s")
def str_word_overlap(spark, sf):
    got = S.word_overlap(S.unique_words(F.col("text")), S.unique_words(F.col("prev")))
    return _neighbors(spark, sf).select("page_id", *((F.round(c, 6) if n in ("overlap", "contained") else c).alias(n) for n, c in got.items()))


@query("str_jaccard_tokens", _PAIR + "SELECT page_id, round(coalesce(sh / nullif(len(a) + len(b) - sh, 0)::DOUBLE, 0), 6) AS jaccard FROM s")
def str_jaccard_tokens(spark, sf):
    return _neighbors(spark, sf).select("page_id", F.round(S.jaccard(S.unique_words(F.col("text")), S.unique_words(F.col("prev"))), 6).alias("jaccard"))


@query("str_bag_dice", f"WITH {PAGES}, n AS (SELECT *, lag(text) OVER (PARTITION BY chart ORDER BY page_no) AS prev FROM pages_a), a AS (SELECT page_id, w, count(*) AS k FROM (SELECT page_id, unnest(regexp_extract_all(lower(text), '{S.WORD}')) AS w FROM n WHERE prev IS NOT NULL) GROUP BY ALL), b AS (SELECT page_id, w, count(*) AS k FROM (SELECT page_id, unnest(regexp_extract_all(lower(prev), '{S.WORD}')) AS w FROM n WHERE prev IS NOT NULL) GROUP BY ALL), j AS (SELECT coalesce(a.page_id, b.page_id) AS page_id, coalesce(a.k, 0) AS ka, coalesce(b.k, 0) AS kb FROM a FULL JOIN b ON a.page_id = b.page_id AND a.w = b.w) SELECT page_id, round(2.0 * sum(least(ka, kb)) / (sum(ka) + sum(kb)), 4)::DOUBLE AS dice FROM j GROUP BY page_id")
def str_bag_dice(spark, sf):
    """Dice over word counts: both bags become signed rows, so one aggregation does for join and sums."""
    n = _neighbors(spark, sf)
    bag = lambda c, side: n.select("page_id", F.explode(S.words(F.col(c))).alias("w"), F.lit(side).alias("side"))
    per = bag("text", 0).union(bag("prev", 1)).groupBy("page_id", "w").agg(F.count_if(F.col("side") == 0).alias("ka"), F.count_if(F.col("side") == 1).alias("kb"))
    return per.groupBy("page_id").agg(F.round(2.0 * F.sum(F.least("ka", "kb")) / F.sum(F.col("ka") + F.col("kb")), 4).alias("dice"))


@query("str_edit_distance", f"WITH {PAGES}, n AS (SELECT *, lag(text) OVER (PARTITION BY chart ORDER BY page_no) AS prev FROM pages_a) SELECT page_id, least(levenshtein(regexp_replace(split_part(text, chr(10), 1), '[^ -~]', '?', 'g'), regexp_replace(split_part(prev, chr(10), 1), '[^ -~]', '?', 'g')), 16)::BIGINT AS distance FROM n WHERE prev IS NOT NULL")
def str_edit_distance(spark, sf):
    return _neighbors(spark, sf).select("page_id", S.edit_distance(*(F.regexp_replace(F.split_part(c, F.lit("\n"), F.lit(1)), "[^ -~]", "?") for c in ("text", "prev")), 15).cast("long").alias("distance"))


@query("str_furniture", f"WITH {PAGES}, n AS (SELECT *, lag(text) OVER (PARTITION BY chart ORDER BY page_no) AS prev FROM pages_a), l AS (SELECT page_id, list_distinct(list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(lower(trim(x)), '\\d', '#', 'g')), lambda x: length(x) >= 5)) AS a, list_distinct(list_filter(list_transform(string_split(prev, chr(10)), lambda x: regexp_replace(lower(trim(x)), '\\d', '#', 'g')), lambda x: length(x) >= 5)) AS b FROM n WHERE prev IS NOT NULL) SELECT page_id, len(list_intersect(a, b))::BIGINT AS lines FROM l")
def str_furniture(spark, sf):
    """Lines that two neighbours share once digits are masked."""
    lines = lambda c: F.array_distinct(F.filter(F.transform(F.split(F.col(c), "\n"), lambda x: F.regexp_replace(F.lower(F.trim(x)), r"\d", "#")), lambda x: F.length(x) >= 5))
    return _neighbors(spark, sf).select("page_id", F.size(F.array_intersect(lines("text"), lines("prev"))).cast("long").alias("lines"))
