"""Queries of the signals between pages: conversations are charts, turns are pages, with their own texts. What other stages would have staged comes
from the ids, once for both engines; the SQL twins read the texts and add the signals on their own."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioframe.functions import strings as S
from folioframe.operators import continuity as C
from folioframe.plans.base import query, table

_STAGED = {
    "kind": "CASE WHEN x % 11 = 0 THEN 'blank' WHEN (chart + page_no // 3) % 4 = 1 OR x % 13 = 5 THEN 'junk' ELSE 'main' END",
    "dos": "CASE WHEN x % 3 <> 0 THEN '2024-01-0' || cast(1 + (chart + page_no // 3) % 4 AS string) END",
    "dos_trust": "cast(2 + x % 4 AS int)",
    "page_type": "'T' || cast((chart + page_no // 2) % 3 AS string)",
    "page_confidence": "cast((x % 10) / 10.0 AS double)",
    "page_name": "CASE WHEN x % 17 = 3 THEN 'Demographics' ELSE 'N' || cast((page_no // 2) % 2 AS string) END",
    "title": "x % 6 = 0",
    "signed": "x % 5 = 0",
    "signed_tail": "x % 10 = 0",
    "visual": "x % 19 = 7",
    "headings": "CASE page_no % 5 WHEN 0 THEN list_value('Chief Complaint:') WHEN 1 THEN list_value('Medications', 'Allergies') WHEN 2 THEN list_value('Plan') END",
    "junk_kind": "CASE WHEN page_no % 5 < 3 THEN 'fax' ELSE 'cover' END",
    "junk_confidence": "cast((80 + 4 * (x % 5)) / 100.0 AS double)",
    "number": "CASE WHEN chart % 4 = 1 THEN cast(page_no + 1 AS int) END",
    "total": "CASE WHEN chart % 4 = 1 THEN 8 END",
    "body_end": "CASE WHEN chart % 2 = 0 THEN cast((x % 21) / 20.0 AS double) END",
    "text": "CASE WHEN chart % 3 = 0 THEN 'Record of the clinic, printed 01/0' || cast(1 + page_no % 9 AS string) || '/2024' || chr(10) ELSE '' END || coalesce(text, '') || CASE WHEN chart % 2 = 0 THEN chr(10) || 'Visit # V' || cast(10000 + chart * 10 + page_no // 3 AS string) ELSE '' END || CASE WHEN chart % 5 = 2 THEN chr(10) || 'Page ' || cast(page_no + 1 AS string) || ' of 8' ELSE '' END || CASE WHEN x % 9 = 0 THEN chr(10) || 'Continued' ELSE '' END",
}


def talks(spark, sf):
    c = table(spark, sf, "conversations").where("conv_id is not null and turn is not null").select(F.col("conv_id").alias("chart"), F.col("turn").alias("page_no"), "text", (F.col("conv_id") * 7 + F.col("turn") * 3).alias("x"))
    return c.select("chart", "page_no", *(F.expr(e.replace("//", "div").replace("list_value", "array")).alias(n) for n, e in _STAGED.items()))


def _plain(x):
    return f"regexp_replace(regexp_replace(lower({x}), '{C.DATE}', '<date>', 'g'), '[0-9]+', '#', 'g')"


def _running(x):
    return f"list_distinct(list_transform(list_filter({x}, lambda v: length(v) >= {C.FURNITURE_CHARS}), lambda v: {_plain('v')}))"


_FITS = [(f"try_cast(regexp_extract(edges, '{p}', 1) AS INT)", f"try_cast(regexp_extract(edges, '{p}', 2) AS INT)") for p in S.MARKERS]
_NUM, _OF = ("CASE " + " ".join(f"WHEN {a} >= 1 AND {a} <= {b} THEN {v}" for (a, b), v in zip(_FITS, [f[i] for f in _FITS])) + " END" for i in (0, 1))
_C = "lower(regexp_replace(v, '[:. ]+$', ''))"
_OPENS = " OR ".join(f"{_C} = '{t}' OR starts_with({_C}, '{t}:') OR starts_with({_C}, '{t} ') AND length({_C}) <= {len(t) + 12}" for t in C.VISIT_OPENERS)
_RANK = "map {" + ", ".join(f"'{t}': {i}" for i, names in enumerate(C.SECTIONS) for t in names) + "}"
_CLOSING = C.CLOSING.replace("'", "''")
_DEMO = "(" + ", ".join(f"'{x}'" for x in C.DEMOGRAPHICS) + ")"
_FILL = "CASE WHEN body_end >= 0.92 THEN -1 WHEN body_end >= 0.8 THEN -(body_end - 0.8) / 0.12 WHEN body_end >= 0.65 THEN 1 - (body_end - 0.65) / 0.15 WHEN body_end >= 0.5 THEN 1 WHEN body_end >= 0.35 THEN (body_end - 0.35) / 0.15 WHEN body_end IS NOT NULL THEN 0 END"


def _signal(name, when, points=None, decisive="false"):
    side = "ending" if name in C.ENDING else "opening" if name in C.OPENING else "pair"
    value = f"CASE WHEN {when} THEN {C.POINTS[name] if points is None else points} END"
    return f"{{'name': '{name}', 'side': '{side}', 'points': ({value})::DOUBLE, 'decisive': coalesce({decisive}, false)}}"


_RUN = f"round(CASE WHEN run >= 3 THEN {C.JUNK_RUN_OF_THREE} ELSE {C.JUNK_RUN} END * run_conf, 2)"
_CHANGE = "(1 - CASE WHEN a.page_type = b.page_type THEN b.page_confidence ELSE 1 - b.page_confidence END) * b.page_confidence"
_AHEAD = f"((b.rank_from - a.rank_to) / {len(C.SECTIONS)}.0 * 4)"
_FORWARD = f"CASE WHEN {_AHEAD} > 1 THEN 1 ELSE {_AHEAD} END"
_DATED = "b.kind = 'main' AND b.dos IS NOT NULL AND open_dos IS NOT NULL"
_EACH = [
    _signal("signed_in_tail", "a.signed_tail"), _signal("signed_anywhere", "a.signed"), _signal("last_numbered_page", "a.num = a.of_"), _signal("says_continued", "a.carries_on"),
    _signal("page_fill", "a.fill IS NOT NULL", "a.fill"), _signal("cut_mid_sentence", "chars >= 0.05 AND len(a_rest) > 0 AND NOT regexp_matches(rtrim(a_rest[-1]), '[.!?:;)\\]\"'']$')"),
    _signal("has_title", "b.title"), _signal("visit_heading", "b.opens"), _signal("starts_mid_thought", "chars >= 0.05 AND regexp_matches(b_rest[1], '^\\p{Ll}')"),
    _signal("pagination_follows", "a.of_ = b.of_ AND b.num = a.num + 1", decisive="true"), _signal("page_type_change", f"{_CHANGE} >= 0.05", f"round(3 * ({_CHANGE}), 2)"),
    _signal("same_page_type", "a.page_name = b.page_name"), _signal("sections_forward", f"{_FORWARD} > 0", f"round(-3 * ({_FORWARD}), 2)"),
    _signal("same_visit_number", "list_has_any(a.visits, b.visits)"), _signal("same_header_line", "list_has_any(a.head, b.head)"), _signal("same_footer_line", "list_has_any(a.foot, b.foot)"),
    _signal("wording_char", "chars >= 0.05", "round(-2 * chars, 2)"), _signal("wording_word", "wordy >= 0.05", "round(-1 * wordy, 2)"),
    _signal("same_junk_kind", "a.kind = 'junk' AND b.kind = 'junk' AND a.junk_kind = b.junk_kind"), _signal("blank_between", "blanks > 0"),
    _signal("same_dos", f"{_DATED} AND b.dos = open_dos", "-trust", "trust >= 5"), _signal("different_dos", f"{_DATED} AND b.dos <> open_dos", "trust", "trust >= 5"),
    _signal("junk_run", "(a.kind = 'junk') <> (b.kind = 'junk')", _RUN, f"run >= 3 AND {_RUN} >= {C.JUNK_DECISIVE}"),
]

_SIG = f"""WITH t AS (SELECT chart, page_no, {', '.join(f'{e} AS {n}' for n, e in _STAGED.items())} FROM (SELECT conv_id AS chart, turn AS page_no, text, conv_id * 7 + turn * 3 AS x FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL)),
l AS (SELECT *, list_filter(list_transform(string_split(text, chr(10)), lambda v: trim(v)), lambda v: v <> '') AS lines FROM t),
m AS (SELECT *, len(lines) AS n, CASE WHEN len(lines) > {C.HEAD_LINES + C.FOOT_LINES} THEN lines[{C.HEAD_LINES + 1}:len(lines) - {C.FOOT_LINES}] ELSE [] END AS body, greatest(len(lines) // 4, 1) AS band FROM l),
e AS (SELECT *, array_to_string(list_concat(lines[1:band], lines[greatest(n - band + 1, 1):n]), chr(10)) AS edges, CASE WHEN len(body) > 0 THEN body ELSE lines END AS closing,
  list_filter(list_transform(coalesce(headings, []), lambda h: {_RANK}[lower(regexp_replace(trim(h), '[: ]+$', ''))]), lambda r: r IS NOT NULL) AS ranks FROM m),
f AS (SELECT chart, page_no, kind, dos, dos_trust, page_type, page_confidence, page_name, title, signed, signed_tail, visual, junk_kind, body,
  coalesce(number, CASE WHEN {_OF} <= {C.MOST_PAGES} THEN {_NUM} END) AS num, coalesce(total, CASE WHEN {_OF} <= {C.MOST_PAGES} THEN {_OF} END) AS of_,
  coalesce(round(2 * ({_FILL}), 2), CASE WHEN n >= {C.FULL_LINES} OR length(text) >= {C.FULL_CHARS} THEN -2 END) AS fill,
  len(list_filter(list_reverse(closing)[1:2], lambda v: regexp_matches(lower(v), '{_CLOSING}'))) > 0 AS carries_on,
  len(list_filter(list_concat(lines[1:{C.TOP_LINES}], coalesce(headings, [])), lambda v: {_OPENS})) > 0 AS opens,
  list_min(ranks) AS rank_from, list_max(ranks) AS rank_to, list_filter(regexp_extract_all(lower(text), '{C.VISIT}', 1), lambda v: length(v) >= 5) AS visits,
  {_running(f'lines[1:{C.HEAD_LINES}]')} AS head, {_running(f'lines[greatest(n - {C.FOOT_LINES} + 1, 1):n]')} AS foot, {_running('lines')} AS running,
  lower(page_name) IN {_DEMO} OR lower(page_type) IN {_DEMO} AS demo FROM e),
i AS (SELECT chart, page_no, kind, dos, dos_trust, junk_confidence, count(*) FILTER (WHERE kind = 'main') OVER w AS island, count(*) FILTER (WHERE kind = 'blank') OVER w AS blank FROM t WINDOW w AS (PARTITION BY chart ORDER BY page_no)),
r AS (SELECT *, count(*) FILTER (WHERE kind = 'junk') OVER (PARTITION BY chart, island) AS run, coalesce(avg(junk_confidence) FILTER (WHERE kind = 'junk') OVER (PARTITION BY chart, island), 1) AS run_conf FROM i),
s AS (SELECT * FROM r WHERE kind <> 'blank' AND NOT (kind = 'junk' AND run = 1)),
g AS (SELECT chart, page_no, lag(page_no) OVER w AS prev, blank - lag(blank) OVER w AS blanks, CASE WHEN kind = 'junk' THEN run ELSE lag(CASE WHEN kind = 'junk' THEN run END) OVER w END AS run, CASE WHEN kind = 'junk' THEN run_conf ELSE lag(CASE WHEN kind = 'junk' THEN run_conf END) OVER w END AS run_conf,
  last_value(CASE WHEN kind = 'main' AND dos IS NOT NULL THEN {{'d': dos, 't': dos_trust}} END IGNORE NULLS) OVER (PARTITION BY chart ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS o FROM s WINDOW w AS (PARTITION BY chart ORDER BY page_no)),
p AS (SELECT g.* EXCLUDE (o), g.o.d AS open_dos, least(coalesce(b.dos_trust, 3), coalesce(g.o.t, 3))::DOUBLE AS trust, a, b, list_filter(a.body, lambda v: NOT list_contains(list_intersect(a.running, b.running), {_plain('v')})) AS a_rest, list_filter(b.body, lambda v: NOT list_contains(list_intersect(a.running, b.running), {_plain('v')})) AS b_rest
  FROM g JOIN f b ON b.chart = g.chart AND b.page_no = g.page_no JOIN f a ON a.chart = g.chart AND a.page_no = g.prev),
k AS (SELECT chart, page_no, unnest([0, 1, 2, 3]) AS w, unnest([list_reverse(a.body), b.body, list_reverse(a_rest), b_rest]) AS ls FROM p),
ku AS (SELECT chart, page_no, w, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS v FROM k),
kc AS (SELECT *, coalesce(sum(len(regexp_split_to_array(v, ' +'))) OVER (PARTITION BY chart, page_no, w ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM ku),
bl AS (SELECT chart, page_no, w, string_agg(v, ' ' ORDER BY CASE WHEN w IN (0, 2) THEN -i ELSE i END) AS t FROM kc WHERE i <= 2 OR before < {C.BLOCK_WORDS} GROUP BY ALL),
wd AS (SELECT chart, page_no, w, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS x FROM (SELECT *, regexp_extract_all(lower(t), '{S.WORD}') AS ws FROM bl)),
gr AS (SELECT chart, page_no, w, 'char' AS sort, substr(' ' || x || ' ', j, n) AS g FROM (SELECT *, unnest(range(1, length(x) + 4 - n)) AS j FROM wd, (SELECT unnest([3, 4, 5]) AS n)) UNION ALL SELECT chart, page_no, w, 'word', x FROM wd
  UNION ALL SELECT chart, page_no, w, 'word', y FROM (SELECT *, x || ' ' || lead(x) OVER (PARTITION BY chart, page_no, w ORDER BY i) AS y FROM wd) WHERE y IS NOT NULL),
nb AS (SELECT chart, count(*) AS n FROM bl WHERE w < 2 GROUP BY chart), df AS (SELECT chart, sort, g, count(DISTINCT (page_no, w)) AS d FROM gr WHERE w < 2 GROUP BY ALL HAVING count(DISTINCT (page_no, w)) >= 2),
wt AS (SELECT chart, page_no, sort, g, w, (1 + ln(count(*))) * (ln((1 + any_value(n)) / (1 + any_value(d))::DOUBLE) + 1) AS z FROM gr JOIN df USING (chart, sort, g) JOIN nb USING (chart) WHERE w >= 2 GROUP BY ALL),
dot AS (SELECT x.chart, x.page_no, x.sort, sum(x.z * y.z) AS v FROM wt x JOIN wt y ON x.chart = y.chart AND x.page_no = y.page_no AND x.sort = y.sort AND x.g = y.g AND x.w = 2 AND y.w = 3 GROUP BY ALL),
nm AS (SELECT chart, page_no, sort, sqrt(sum(z * z) FILTER (WHERE w = 2)) * sqrt(sum(z * z) FILTER (WHERE w = 3)) AS v FROM wt GROUP BY ALL),
cs AS (SELECT chart, page_no, least(coalesce(max(dot.v / nm.v) FILTER (WHERE sort = 'char'), 0) / 0.25, 1) AS chars, least(coalesce(max(dot.v / nm.v) FILTER (WHERE sort = 'word'), 0) / 0.15, 1) AS wordy FROM dot JOIN nm USING (chart, page_no, sort) GROUP BY ALL),
z AS (SELECT p.*, coalesce(chars, 0) AS chars, coalesce(wordy, 0) AS wordy FROM p LEFT JOIN cs USING (chart, page_no)),
q AS (SELECT chart, page_no, a.kind = 'main' AND b.kind = 'main' AS both_main, a.demo <> b.demo AS demographics, b.opens AS opens, b.visual AS visual, list_filter([{', '.join(_EACH)}], lambda y: y.points IS NOT NULL AND y.points <> 0) AS signals FROM z),
u AS (SELECT chart, page_no, unnest(signals) AS y FROM q),
d AS (SELECT q.*, coalesce(score, 0) AS score, coalesce(br, false) AS br, coalesce(jo, false) AS jo, coalesce(dd, false) AS dd, coalesce(follows, false) AS follows, coalesce(odd, false) AS odd FROM q LEFT JOIN (SELECT chart, page_no, round(sum(y.points), 2) AS score, bool_or(y.decisive AND y.points > 0) AS br, bool_or(y.decisive AND y.points < 0) AS jo, bool_or(y.decisive AND y.name = 'different_dos') AS dd, bool_or(y.name = 'pagination_follows') AS follows,
  (coalesce(round(sum(y.points) FILTER (WHERE y.side = 'ending'), 2), 0) >= 4 OR coalesce(round(sum(y.points) FILTER (WHERE y.side = 'opening'), 2), 0) >= 4) AND coalesce(round(sum(y.points) FILTER (WHERE y.side = 'pair'), 2), 0) <= -4 AS odd FROM u GROUP BY ALL) USING (chart, page_no)),
c AS (SELECT *, CASE WHEN br AND jo THEN 'decisive_conflict' WHEN br OR jo THEN 'decisive' WHEN score <> 0 THEN 'sum' ELSE 'tie' END AS decided_by, CASE WHEN br AND jo THEN dd WHEN br OR jo THEN br ELSE score > 0 END AS breaks,
  ['low', 'medium', 'high'][greatest(CASE WHEN br AND jo THEN 2 WHEN br OR jo OR abs(score) >= 5 THEN 3 WHEN abs(score) >= 2 THEN 2 ELSE 1 END - odd::INT, 1)] AS level FROM d)"""


#: The score without dates: the fold over segments holds the open document's own.
SEGMENTS = f"""{_SIG.replace('WITH t', 'WITH RECURSIVE t', 1)}, o AS (SELECT chart, page_no, round(sum(y.points) FILTER (WHERE NOT ends_with(y.name, '_dos')), 2) AS score FROM u GROUP BY ALL),
pg AS (SELECT t.chart, t.page_no, kind, dos, coalesce(score, 0) AS score, row_number() OVER (PARTITION BY t.chart ORDER BY t.page_no) AS rn FROM t LEFT JOIN o ON o.chart = t.chart AND o.page_no = t.page_no),
st AS (SELECT chart, page_no, rn, 1::BIGINT AS document, CASE WHEN kind = 'main' THEN dos END AS open, 'first' AS start_reason FROM pg WHERE rn = 1 UNION ALL
SELECT chart, page_no, rn, document + CASE WHEN start_reason = 'date' OR start_reason = 'score' AND score > 0 THEN 1 ELSE 0 END, CASE WHEN start_reason = 'date' OR start_reason = 'score' AND score > 0 THEN dos WHEN kind = 'main' THEN coalesce(open, dos) ELSE open END, start_reason
FROM (SELECT pg.*, document, open, CASE WHEN pg.kind <> 'main' THEN 'attached' WHEN pg.dos <> open THEN 'date' WHEN pg.dos = open THEN 'same date' ELSE 'score' END AS start_reason FROM st JOIN pg ON pg.chart = st.chart AND pg.rn = st.rn + 1))
SELECT chart, page_no, document, start_reason FROM st"""


def scores(spark, sf):
    """(chart, page_no, kind, dos, score): pages for operators.folds.continuity."""
    p = talks(spark, sf)
    points = F.aggregate(F.filter("signals", lambda x: ~x["name"].endswith("_dos")), F.lit(0.0), lambda s, x: s + x["points"])
    g = C.signals(p).select("chart", "page_no", F.round(points, 2).alias("score"))
    return p.select("chart", "page_no", "kind", "dos").join(g, ["chart", "page_no"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))


@query("con_signals", f"{_SIG} SELECT chart, page_no, y.name AS signal, y.side AS side, y.points AS points, y.decisive AS decisive FROM u")
def con_signals(spark, sf):
    return C.signals(talks(spark, sf)).select("chart", "page_no", F.explode("signals").alias("y")).select("chart", "page_no", F.col("y.name").alias("signal"), "y.side", "y.points", "y.decisive")


@query("con_decide", f"{_SIG} SELECT chart, page_no, score, breaks, decided_by, level FROM c")
def con_decide(spark, sf):
    return C.decide(C.signals(talks(spark, sf))).select("chart", "page_no", "score", "breaks", "decided_by", "level")


@query("con_overrides", f"{_SIG}, v AS (SELECT *, CASE WHEN NOT both_main THEN NULL WHEN visual THEN 'visual' WHEN opens AND NOT follows THEN 'visit heading' WHEN demographics THEN 'demographics' END AS rule FROM c) SELECT chart, page_no, rule, CASE WHEN rule IS NULL THEN breaks ELSE rule <> 'visual' END AS breaks FROM v")
def con_overrides(spark, sf):
    return C.override(C.decide(C.signals(talks(spark, sf)))).select("chart", "page_no", "rule", "breaks")


@query("con_evidence", f"{_SIG}, n AS (SELECT chart, page_no, y, row_number() OVER (PARTITION BY chart, page_no ORDER BY abs(y.points) DESC, y.name) AS rn FROM u) SELECT chart, page_no, coalesce(string_agg(n.y.name || ' ' || round(n.y.points * 100)::BIGINT, ', ' ORDER BY rn) FILTER (WHERE rn <= 4), '') AS because FROM q LEFT JOIN n USING (chart, page_no) GROUP BY ALL")
def con_evidence(spark, sf):
    """The strongest four reasons in words, points in hundredths."""
    return C.signals(talks(spark, sf)).select("chart", "page_no", C.because(F.col("signals")).alias("because"))
