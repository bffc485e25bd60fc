"""Where documents begin and end among a chart's pages: each gap between two scored pages is read by 24 signals; the points of all but text_start are added.

pages: (chart, page_no, kind main|junk|blank, text) and what earlier stages staged, each of which may be null: dos, dos_trust, page_type,
page_confidence, page_name, title, signed, signed_tail, headings array<string>, visual, junk_kind, junk_confidence, number and total as
printed, body_end (where the text stops, as a share of the height). Blank pages and lone junk pages are looked through.

A page finds the one before it by a window over narrow rows; texts are joined on afterwards, so no window holds them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioframe.functions import numbers as N
from folioframe.functions import strings as S

#: Points of the signals, above 0 for a break. Dates weigh by their trust, junk runs by length.
ENDING = {"signed_in_tail": 3.0, "signed_anywhere": 2.0, "last_numbered_page": 3.0, "says_continued": -3.0, "page_fill": 2.0, "cut_mid_sentence": -1.0}
OPENING = {"has_title": 3.0, "visit_heading": 3.0, "starts_mid_thought": -1.0}
PAIR = {"pagination_follows": -5.0, "page_type_change": 3.0, "same_page_type": -1.0, "sections_forward": -3.0, "same_visit_number": -3.0, "same_header_line": -2.0, "same_footer_line": -1.0, "wording_char": -2.0, "wording_word": -1.0, "same_junk_kind": -2.0, "blank_between": 1.0}
POINTS = ENDING | OPENING | PAIR
TEXT_START = 2.0
JUNK_RUN, JUNK_RUN_OF_THREE, JUNK_DECISIVE = 3.0, 5.0, 4.5
HEAD_LINES, FOOT_LINES, TOP_LINES, FURNITURE_CHARS, BLOCK_WORDS, MOST_PAGES = 4, 3, 8, 12, 20, 20
FULL_LINES, FULL_CHARS = 28, 1800
VISIT_OPENERS = ("reason for visit", "reason for appointment", "visit information", "visit info", "chief complaint", "cc", "hpi", "history of present illness")
VISIT_LABELS = ("visit", "encounter", "enc", "fin", "csn", "account", "acct")
CARRY_ON = ("continued", "cont'd", "contd", "see next page", r"\(over", "over >>")
DEMOGRAPHICS = ("demographics", "patient demographics", "patient information", "patient registration")
#: Sections in the order of a note.
SECTIONS = (("chief complaint", "cc", "reason for visit", "reason for consult", "reason for admission"), ("history of present illness", "hpi"), ("review of systems", "ros"), ("past medical history", "pmh", "past surgical history", "psh"), ("social history",), ("family history",), ("medications", "current medications", "medication list"), ("allergies", "allergy list"), ("vital signs", "vitals"), ("physical examination", "physical exam"), ("lab results", "laboratory"), ("imaging", "radiology"), ("problem list", "active problems"), ("assessment", "diagnosis", "diagnoses", "impression", "clinical diagnoses", "principal diagnosis"), ("plan", "assessment and plan", "a/p", "plan of care", "treatment plan"), ("discharge instructions", "after visit summary"), ("follow up",))

DATE = r"[0-9]{1,4}[-/.][0-9]{1,2}[-/.][0-9]{1,4}|(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*[.]? +[0-9]{1,2},? +[0-9]{2,4}"
CLOSING = r"(?:^|[^a-z0-9])(?:" + "|".join(CARRY_ON) + ")[^a-z0-9>]*$"
VISIT = r"(?:^|[^a-z0-9])(?:" + "|".join(VISIT_LABELS) + r")[ #:.]+(?:(?:no|number|num|id)[ #:.]+)?([a-z0-9-]*[0-9][a-z0-9-]*)"
STAGED = {"dos": "string", "dos_trust": "int", "page_type": "string", "page_confidence": "double", "page_name": "string", "title": "boolean", "signed": "boolean", "signed_tail": "boolean", "headings": "array<string>", "visual": "boolean", "junk_kind": "string", "junk_confidence": "double", "number": "int", "total": "int", "body_end": "double", "body_start": "double"}


def plain_line(x: Column) -> Column:
    """A running line with its dates and numbers replaced, so that a page number or a print time makes no difference."""
    return F.regexp_replace(F.regexp_replace(F.lower(x), DATE, "<date>"), "[0-9]+", "#")


def _running(lines: Column) -> Column:
    return F.array_distinct(F.transform(F.filter(lines, lambda x: F.length(x) >= FURNITURE_CHARS), plain_line))


def _block(lines: Column) -> Column:
    """Two lines, and more until there are BLOCK_WORDS words."""
    start = F.struct(F.lit(0).alias("k"), F.lit(0).alias("w"))
    more = lambda s, x: F.when((s["k"] >= 2) & (s["w"] >= BLOCK_WORDS), s).otherwise(F.struct((s["k"] + 1).alias("k"), (s["w"] + F.size(F.split(x, " +"))).alias("w")))
    return F.slice(lines, F.lit(1), F.aggregate(lines, start, more)["k"])


def _opens_visit(c: Column) -> Column:
    out = F.lit(False)
    for t in VISIT_OPENERS:
        out = out | (c == t) | c.startswith(t + ":") | (c.startswith(t + " ") & (F.length(c) <= len(t) + 12))
    return out


def fill(end: Column) -> Column:
    """-1 for a full page, 1 for one that stops about halfway, 0 for one nearly empty."""
    full = F.when(end >= 0.8, N.ramp(end, 0.8, 0.0, 0.92, -1.0)).when(end >= 0.65, N.ramp(end, 0.65, 1.0, 0.8, 0.0))
    return full.when(end >= 0.35, N.ramp(end, 0.35, 0.0, 0.5, 1.0)).when(end.isNotNull(), 0.0)


def text_start(air: Column) -> Column:
    """What the space above the first body line says: -0.5 for none, 1 for a title's. Measured, and kept out of the sum."""
    near = F.when(air <= 0.12, N.ramp(air, 0.03, -0.5, 0.12, 0.0))
    return F.round(TEXT_START * near.otherwise(N.ramp(air, 0.12, 0.0, 0.25, 1.0)), 2)


def staged(pages: DataFrame) -> DataFrame:
    """pages with every column that a stage may have left, null where it has not."""
    return pages.withColumns({c: F.lit(None).cast(t) for c, t in STAGED.items() if c not in pages.columns})


def page_facts(pages: DataFrame) -> DataFrame:
    """What each page alone has for the signals."""
    text = F.coalesce("text", F.lit(""))
    p = staged(pages).withColumn("lines", F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")).withColumn("n", F.size("lines"))
    foot_at = F.greatest(F.col("n") - FOOT_LINES + 1, F.lit(1))
    band = F.greatest(F.floor(F.col("n") / 4).cast("int"), F.lit(1))
    edges = F.array_join(F.concat(F.slice("lines", F.lit(1), band), F.slice("lines", F.greatest(F.col("n") - band + 1, F.lit(1)), band)), "\n")
    num, total = S.marker(F.col("edges"))
    rank = F.create_map(*(F.lit(x) for i, names in enumerate(SECTIONS) for t in names for x in (t, i)))
    ranks = F.array_compact(F.transform(F.coalesce("headings", F.array().cast("array<string>")), lambda h: F.try_element_at(rank, F.lower(F.regexp_replace(F.trim(h), "[: ]+$", "")))))
    body = F.slice("lines", HEAD_LINES + 1, F.greatest(F.col("n") - HEAD_LINES - FOOT_LINES, F.lit(0)))
    p = p.withColumn("edges", edges).withColumns({"body": body, "ranks": ranks, "num": F.coalesce("number", F.when(total <= MOST_PAGES, num)), "of": F.coalesce("total", F.when(total <= MOST_PAGES, total))})
    last = F.slice(F.reverse(F.when(F.size("body") > 0, F.col("body")).otherwise(F.col("lines"))), 1, 2)
    visits = F.filter(F.regexp_extract_all(F.lower(text), F.lit(VISIT), F.lit(1)), lambda v: F.length(v) >= 5)
    full = (F.col("n") >= FULL_LINES) | (F.length(text) >= FULL_CHARS)
    demo = F.lower(F.col("page_name")).isin(*DEMOGRAPHICS) | F.lower(F.col("page_type")).isin(*DEMOGRAPHICS)
    return p.select(
        "chart", "page_no", "kind", "dos", "dos_trust", "page_type", "page_confidence", "page_name", "title", "signed", "signed_tail", "visual", "junk_kind", "num", "of", "body",
        F.coalesce(F.round(POINTS["page_fill"] * fill(F.col("body_end")), 2), F.when(full, -POINTS["page_fill"])).alias("fill"),
        text_start(F.col("body_start")).alias("air"),
        F.exists(last, lambda x: F.lower(x).rlike(CLOSING)).alias("carries_on"),
        F.exists(F.transform(F.concat(F.slice("lines", 1, TOP_LINES), F.coalesce("headings", F.array().cast("array<string>"))), lambda x: F.regexp_replace(F.lower(x), "[:. ]+$", "")), _opens_visit).alias("opens"),
        F.array_min("ranks").alias("rank_from"), F.array_max("ranks").alias("rank_to"), F.array_distinct(visits).alias("visits"),
        _running(F.slice("lines", 1, HEAD_LINES)).alias("head"), _running(F.slice("lines", foot_at, F.lit(FOOT_LINES))).alias("foot"), _running(F.col("lines")).alias("running"),
        F.coalesce(demo, F.lit(False)).alias("demographics"),
    )


def gaps(pages: DataFrame) -> DataFrame:
    """(chart, page_no, prev, blanks, open_dos, open_trust, run, run_confidence): each scored page with the scored page before it, the blank
    pages between, the newest date before it and the junk run on either side."""
    p = staged(pages).select("chart", "page_no", "kind", "dos", "dos_trust", "junk_confidence")
    w = Window.partitionBy("chart").orderBy("page_no")
    p = p.withColumns({"island": F.sum(F.when(F.col("kind") == "main", 1).otherwise(0)).over(w), "blank": F.sum(F.when(F.col("kind") == "blank", 1).otherwise(0)).over(w)})
    island, junk = Window.partitionBy("chart", "island"), F.col("kind") == "junk"
    p = p.withColumns({"run": F.count_if(junk).over(island), "run_confidence": F.coalesce(F.avg(F.when(junk, F.col("junk_confidence"))).over(island), F.lit(1.0))})
    dated = F.when((F.col("kind") == "main") & F.col("dos").isNotNull(), F.struct("dos", "dos_trust"))
    s = p.where((F.col("kind") != "blank") & ~(junk & (F.col("run") == 1)))
    open_ = F.last(dated, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    both = lambda c: F.when(junk, F.col(c)).otherwise(F.lag(F.when(junk, F.col(c))).over(w))
    g = s.select("chart", "page_no", F.lag("page_no").over(w).alias("prev"), (F.col("blank") - F.lag("blank").over(w)).alias("blanks"), open_.alias("o"), both("run").alias("run"), both("run_confidence").alias("run_confidence"))
    return g.where("prev is not null").select("chart", "page_no", "prev", "blanks", F.col("o.dos").alias("open_dos"), F.col("o.dos_trust").alias("open_trust"), "run", "run_confidence")


def _pairs(pages: DataFrame) -> DataFrame:
    f = page_facts(pages)
    both = lambda n, page: f.select("chart", F.col("page_no").alias(page), F.struct(*(c for c in f.columns if c not in ("chart", "page_no"))).alias(n))
    j = gaps(pages).join(both("b", "page_no"), ["chart", "page_no"]).join(both("a", "prev"), ["chart", "prev"])
    shared = F.array_intersect("a.running", "b.running")
    rest = lambda lines: F.filter(lines, lambda x: ~F.array_contains(F.col("shared"), plain_line(x)))
    return j.withColumn("shared", shared).withColumns({"a_rest": rest(F.col("a.body")), "b_rest": rest(F.col("b.body"))})


def wording(pairs: DataFrame) -> DataFrame:
    """(chart, page_no, char, word): cosines of the earlier page's last body lines and the later one's first, without running lines. Terms are
    weighed by how many such blocks of the chart have them, and count from two blocks on. One aggregate by chart and term; no chart is gathered."""
    tail, head = (lambda c: F.array_join(F.reverse(_block(F.reverse(c))), " ")), (lambda c: F.array_join(_block(c), " "))
    grams = lambda t: F.array(F.struct(F.lit("char").alias("sort"), S.char_grams(t).alias("g")), F.struct(F.lit("word").alias("sort"), F.concat(S.words(t), S.word_grams(t)).alias("g")))
    every = pairs.select("chart", F.explode(F.array(tail(F.col("a.body")), head(F.col("b.body")))).alias("t")).where("trim(t) <> ''")
    n = every.groupBy("chart").agg(F.count("*").alias("n"))
    seen = every.select("chart", F.explode(grams(F.col("t"))).alias("x")).select("chart", "x.sort", F.explode(F.array_distinct("x.g")).alias("g"))
    idf = seen.groupBy("chart", "sort", "g").agg(F.count("*").alias("d")).where("d >= 2").join(n, "chart").select("chart", "sort", "g", (F.log((1 + F.col("n")) / (1 + F.col("d"))) + 1).alias("idf"))
    own = pairs.select("chart", "page_no", F.posexplode(F.array(tail(F.col("a_rest")), head(F.col("b_rest")))).alias("side", "t"))
    terms = own.select("chart", "page_no", "side", F.explode(grams(F.col("t"))).alias("x")).select("chart", "page_no", "side", "x.sort", F.explode("x.g").alias("g"))
    counts = terms.groupBy("chart", "page_no", "sort", "g").agg(F.count_if(F.col("side") == 0).alias("ca"), F.count_if(F.col("side") == 1).alias("cb"))
    weight = lambda c: F.when(F.col(c) > 0, (1 + F.log(F.col(c))) * F.col("idf")).otherwise(0.0)
    v = counts.join(idf, ["chart", "sort", "g"]).select("chart", "page_no", "sort", weight("ca").alias("x"), weight("cb").alias("y"))
    cos = v.groupBy("chart", "page_no", "sort").agg(F.try_divide(F.sum(F.col("x") * F.col("y")), F.sqrt(F.sum(F.col("x") * F.col("x"))) * F.sqrt(F.sum(F.col("y") * F.col("y")))).alias("c"))
    of = lambda s, by: F.least(F.coalesce(F.max(F.when(F.col("sort") == s, F.col("c"))), F.lit(0.0)) / by, F.lit(1.0))
    return cos.groupBy("chart", "page_no").agg(of("char", 0.25).alias("char"), of("word", 0.15).alias("word"))


def signals(pages: DataFrame) -> DataFrame:
    """(chart, page_no, prev, signals array<name, side, points, decisive>, text_start, both_main, demographics, opens, visual): a row a gap.
    Signals that say nothing are left out. The date is held against the newest date before the gap."""
    p = _pairs(pages)
    p = p.join(wording(p), ["chart", "page_no"], "left").withColumns({"char": F.coalesce("char", F.lit(0.0)), "word": F.coalesce("word", F.lit(0.0))})
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    trust = F.least(F.coalesce(b("dos_trust"), F.lit(3)), F.coalesce("open_trust", F.lit(3))).cast("double")
    dated = (b("kind") == "main") & b("dos").isNotNull() & F.col("open_dos").isNotNull()
    same = b("dos") == F.col("open_dos")
    alike = F.when(a("page_type") == b("page_type"), b("page_confidence")).otherwise(1 - b("page_confidence"))
    change = F.when(a("page_type").isNotNull() & b("page_type").isNotNull(), (1 - alike) * b("page_confidence"))
    ahead = (b("rank_from") - a("rank_to")) / len(SECTIONS) * 4
    forward = F.when(ahead > 1, 1.0).otherwise(ahead)
    run = F.round(F.when(F.col("run") >= 3, JUNK_RUN_OF_THREE).otherwise(JUNK_RUN) * F.col("run_confidence"), 2)
    beside = (a("kind") == "junk") != (b("kind") == "junk")
    meets = F.col("char") >= 0.05
    overlap = lambda x, y: F.arrays_overlap(x, y)
    when = {
        "signed_in_tail": a("signed_tail"), "signed_anywhere": a("signed"), "last_numbered_page": a("num") == a("of"), "says_continued": a("carries_on"),
        "has_title": b("title"), "visit_heading": b("opens"), "same_page_type": a("page_name") == b("page_name"), "pagination_follows": (a("of") == b("of")) & (b("num") == a("num") + 1),
        "same_visit_number": overlap(a("visits"), b("visits")), "same_header_line": overlap(a("head"), b("head")), "same_footer_line": overlap(a("foot"), b("foot")),
        "same_junk_kind": (a("kind") == "junk") & (b("kind") == "junk") & (a("junk_kind") == b("junk_kind")), "blank_between": F.col("blanks") > 0,
        "cut_mid_sentence": meets & S.mid_sentence_end(F.try_element_at("a_rest", F.lit(-1))), "starts_mid_thought": meets & S.lower_start(F.get("b_rest", F.lit(0))),
    }
    value = {k: F.when(v, POINTS[k]) for k, v in when.items()} | {
        "page_fill": a("fill"),
        "same_dos": F.when(dated & same, -trust),
        "different_dos": F.when(dated & ~same, trust),
        "page_type_change": F.when(change >= 0.05, F.round(POINTS["page_type_change"] * change, 2)),
        "sections_forward": F.when(forward > 0, F.round(POINTS["sections_forward"] * forward, 2)),
        "wording_char": F.when(meets, F.round(POINTS["wording_char"] * F.col("char"), 2)),
        "wording_word": F.when(F.col("word") >= 0.05, F.round(POINTS["wording_word"] * F.col("word"), 2)),
        "junk_run": F.when(beside, run),
    }
    decisive = {"same_dos": trust >= 5, "different_dos": trust >= 5, "pagination_follows": F.lit(True), "junk_run": (F.col("run") >= 3) & (run >= JUNK_DECISIVE)}
    side = {**dict.fromkeys(ENDING, "ending"), **dict.fromkeys(OPENING, "opening")}
    each = F.array(*(F.struct(F.lit(k).alias("name"), F.lit(side.get(k, "pair")).alias("side"), v.alias("points"), F.coalesce(decisive.get(k, F.lit(False)), F.lit(False)).alias("decisive")) for k, v in sorted(value.items())))
    return p.select("chart", "page_no", "prev", F.filter(each, lambda x: x["points"].isNotNull() & (x["points"] != 0)).alias("signals"), b("air").alias("text_start"), ((a("kind") == "main") & (b("kind") == "main")).alias("both_main"), (a("demographics") != b("demographics")).alias("demographics"), b("opens").alias("opens"), F.coalesce(b("visual"), F.lit(False)).alias("visual"))


def decide(gaps: DataFrame) -> DataFrame:
    """Adds score, breaks, decided_by and level to signals(): decisive signals first (a date over a page number), then the sign of the sum; 0 joins.
    An ending or opening of 4 or more against a pair of -4 or less lowers the level."""
    total = lambda keep: F.round(F.aggregate(F.filter("signals", keep), F.lit(0.0), lambda s, x: s + x["points"]), 2)
    of = lambda side: total(lambda x: x["side"] == side)
    has = lambda sign: F.exists("signals", lambda x: x["decisive"] & (x["points"] * sign > 0))
    g = gaps.withColumns({"score": total(lambda x: F.lit(True)), "_b": has(1), "_j": has(-1), "_odd": ((of("ending") >= 4) | (of("opening") >= 4)) & (of("pair") <= -4)})
    dates = F.exists("signals", lambda x: (x["name"] == "different_dos") & x["decisive"])
    by = F.when(F.col("_b") & F.col("_j"), "decisive_conflict").when(F.col("_b") | F.col("_j"), "decisive").when(F.col("score") != 0, "sum").otherwise("tie")
    g = g.withColumn("decided_by", by).withColumn("breaks", F.when(F.col("decided_by") == "decisive_conflict", dates).when(F.col("decided_by") == "decisive", F.col("_b")).otherwise(F.col("score") > 0))
    size = F.abs("score")
    level = F.when(F.col("decided_by") == "decisive_conflict", 2).when((F.col("decided_by") == "decisive") | (size >= 5), 3).when(size >= 2, 2).otherwise(1)
    rank = F.greatest(level - F.when(F.col("_odd"), 1).otherwise(0), F.lit(1))
    return g.withColumn("level", F.element_at(F.array(F.lit("low"), F.lit("medium"), F.lit("high")), rank)).drop("_b", "_j", "_odd")


def override(decided: DataFrame) -> DataFrame:
    """decide() with what overrules any score between two main pages: demographics stand alone, a visit heading opens a document unless the printed
    numbers run on, and a picture stays with the page before it (the last word)."""
    runs_on = F.exists("signals", lambda x: x["name"] == "pagination_follows")
    rule = F.when(~F.col("both_main"), None).when(F.col("visual"), "visual").when(F.col("opens") & ~runs_on, "visit heading").when(F.col("demographics"), "demographics")
    g = decided.withColumn("rule", rule)
    new = F.col("rule").isNotNull()
    return g.withColumns({"breaks": F.when(new, F.col("rule") != "visual").otherwise(F.col("breaks")), "decided_by": F.when(new, "decisive").otherwise(F.col("decided_by")), "level": F.when(new, "high").otherwise(F.col("level"))})


def because(signals: Column, most: int = 4) -> Column:
    """The strongest reasons in words."""
    ranked = F.array_sort(F.transform(signals, lambda x: F.struct((-F.abs(x["points"])).alias("a"), x["name"].alias("name"), x["points"].alias("points"))))
    return F.array_join(F.transform(F.slice(ranked, 1, most), lambda x: F.concat(x["name"], F.lit(" "), F.round(x["points"] * 100).cast("long").cast("string"))), ", ")
