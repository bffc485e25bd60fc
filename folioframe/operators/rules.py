"""Rule ladders and votes. Rule tables are inputs; what stands here is how they are applied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioframe.functions.strings import ascii_marks


def ladder(rules: list[tuple[Column, str]], default: str | None) -> Column:
    """The value of the first condition that holds."""
    out = F.lit(default).cast("string")
    for condition, value in reversed(rules):
        out = F.when(condition, value).otherwise(out)
    return out


def blank_text(text: Column, least: int = 5) -> Column:
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^a-zA-Z0-9]", "")) < least


def cascade(text: Column, patterns: dict[str, str], guard: str, cover_words: int = 20) -> Column:
    """Blank, cover (short), the guard's main, then the patterns in order, then main."""
    t = F.lower(F.coalesce(text, F.lit("")))
    has = lambda p: t.rlike(ascii_marks(p))
    n = F.size(F.filter(F.split(t, ascii_marks(r"\s+")), lambda x: x != ""))
    rules = [(blank_text(text), "blank"), ((n < cover_words) & has(patterns["cover"]), "cover"), (has(guard), "main")]
    return ladder(rules + [(has(p), k) for k, p in patterns.items() if k != "cover"], "main")


def context_scores(hits: DataFrame, groups: DataFrame) -> DataFrame:
    """(page_id, context, score): weight times distinct terms of each group, capped, summed by context. hits: (page_id, group, term)."""
    n = hits.groupBy("page_id", "group").agg(F.countDistinct("term").alias("n"))
    j = n.join(groups, "group")
    return j.groupBy("page_id", "context").agg(F.round(F.sum(F.least(F.col("n") * F.col("weight"), F.col("cap"))), 4).alias("score"))


def term_hits(pages: DataFrame, terms: DataFrame, key: str = "page_id") -> DataFrame:
    """Pages and the single-word terms on them, by equi-join on words: a page's words against the rule table. terms: (term, …)."""
    from folioframe.functions.strings import unique_words

    w = pages.select(key, F.explode(unique_words(F.col("text"))).alias("term"))
    return w.join(terms, "term")


def decide_proba(keep: Column, blank: Column, junk: Column, retention: Column, keep_final: float = 0.95, junk_at: float = 0.85, review: float = 0.5) -> Column:
    """KEEP, BLANK, JUNK or REVIEW from probabilities: retention and near-certain keeps win, junk must be sure."""
    return ladder([(retention, "KEEP"), (keep > keep_final, "KEEP"), ((junk >= junk_at) & (junk >= blank), "JUNK"), (blank >= junk_at, "BLANK"), (F.greatest(keep, blank, junk) < review, "REVIEW"), (keep >= F.greatest(blank, junk), "KEEP")], "REVIEW")


def name_class(words: Column, first: Column, last: Column) -> Column:
    """How a two-word name stands among a span's words."""
    f, l = F.array_contains(words, first), F.array_contains(words, last)  # noqa: E741
    initial = F.array_contains(words, F.substring(first, 1, 1)) & l
    return ladder([(f & l, "BOTH_FULL"), (initial, "INITIAL"), (f | l, "ONE_FULL_WRONG")], "MISMATCH")


def id_found(text: Column, ident: Column) -> Column:
    """An id bounded by what is neither letter nor digit: texts are cut at those, so no pattern is built per row."""
    return F.coalesce(F.array_contains(F.split(F.lower(text), r"[^a-z0-9]+"), F.lower(ident)), F.lit(False))


def combine_evidence(name_ok: Column, dob_ok: Column, id_ok: Column, initial_only: Column) -> Column:
    return F.when(initial_only, name_ok & dob_ok & id_ok).otherwise(name_ok & (dob_ok | id_ok))


def member_document(pages: DataFrame, wrong: Column) -> DataFrame:
    """accept or reject: pages of someone else against max(1, min(5, ten per cent of the pages))."""
    g = pages.groupBy("chart").agg(F.count("*").alias("pages"), F.count_if(wrong).alias("wrong"))
    bar = F.greatest(F.lit(1), F.least(F.lit(5), F.ceil(F.col("pages") * 0.1)))
    return g.withColumn("bar", bar.cast("long")).withColumn("decision", F.when(F.col("wrong") >= F.col("bar"), "reject").otherwise("accept"))


def weighted_vote(votes: DataFrame, unit: list[str], label: str, weight: Column, opener: Column, priority: Column, absent: str) -> DataFrame:
    """The label of most weight; absent wins only where nobody says else; ties go to the opener's label, then to priority."""
    s = votes.groupBy(*unit, label).agg(F.sum(weight).alias("w"), F.max(opener.cast("int")).alias("o"), F.min(priority).alias("p"))
    best = F.max(F.struct((F.col(label) != absent).cast("int"), F.round("w", 6), "o", -F.col("p"), F.col(label)))
    return s.groupBy(*unit).agg(best.alias("b")).select(*unit, F.col(f"b.{label}").alias(label))


def document_agree(pages: DataFrame, unit: list[str], label: str, share: float) -> DataFrame:
    """A document's label: that of its last page where it has the share of the confidence, else of its first page where it has, else the heaviest."""
    tot = Window.partitionBy(*unit)
    own = Window.partitionBy(*unit, label)
    p = pages.withColumn("_s", F.round(F.sum("confidence").over(own) / F.nullif(F.sum("confidence").over(tot), F.lit(0.0)), 6))
    g = p.groupBy(*unit).agg(F.max_by(F.struct(label, "_s"), "page_no").alias("z"), F.min_by(F.struct(label, "_s"), "page_no").alias("a"), F.max_by(label, F.struct("_s", -F.col("page_no"))).alias("h"))
    return g.select(*unit, F.when(F.col("z._s") >= share, F.col(f"z.{label}")).when(F.col("a._s") >= share, F.col(f"a.{label}")).otherwise(F.col("h")).alias(label))


def modal(rows: DataFrame, unit: list[str], value: str, order: str) -> DataFrame:
    """The most frequent value of each unit (the first of equals), and all of them in order of appearance."""
    n = rows.where(F.col(value).isNotNull()).groupBy(*unit, value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    g = n.groupBy(*unit).agg(F.max_by(value, F.struct("n", -F.col("first"))).alias("modal"), F.array_sort(F.collect_list(F.struct("first", value))).alias("v"))
    return g.select(*unit, "modal", F.transform("v", lambda x: x[value]).alias("all_values"))


def keyword_classify(hits: DataFrame, unit: str, margin: float = 0.0) -> DataFrame:
    """(unit, label, score, margin): weights of distinct terms by label, the best one and its lead."""
    s = hits.dropDuplicates([unit, "label", "term"]).groupBy(unit, "label").agg(F.round(F.sum("weight"), 6).alias("score"))
    w = Window.partitionBy(unit).orderBy(F.col("score").desc(), "label")
    r = s.withColumns({"rn": F.row_number().over(w), "next": F.lead("score").over(w)})
    return r.where("rn = 1").select(unit, "label", "score", F.round(F.col("score") - F.coalesce("next", F.lit(0.0)), 6).alias("margin")).where(F.col("margin") >= margin)


def tfidf(docs: DataFrame, unit: str, terms: Column) -> DataFrame:
    """(unit, term, weight): sublinear term frequency, smoothed inverse document frequency, unit length."""
    t = docs.select(unit, F.explode(terms).alias("term")).groupBy(unit, "term").agg(F.count("*").alias("tf"))
    df = t.groupBy("term").agg(F.count("*").alias("df"))
    n = docs.agg(F.count("*").alias("n"))
    w = t.join(df, "term").crossJoin(n).withColumn("w", (1 + F.log("tf")) * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1))
    norm = w.groupBy(unit).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("l2"))
    return w.join(norm, unit).select(unit, "term", (F.col("w") / F.col("l2")).alias("weight"))


def keyword_mining(docs: DataFrame, label: str, grams: Column, least: int, top: int) -> DataFrame:
    """Phrases by class with support, precision and lift; the top of each class by precision times log support."""
    g = docs.select(label, F.explode(F.array_distinct(grams)).alias("phrase"))
    s = g.groupBy("phrase", label).agg(F.count("*").alias("k"))
    every = s.groupBy("phrase").agg(F.sum("k").alias("n")).where(F.col("n") >= least)
    share = docs.groupBy(label).agg(F.count("*").alias("c"))
    total = docs.agg(F.count("*").alias("t"))
    j = s.join(every, "phrase").join(share, label).crossJoin(total)
    j = j.withColumns({"precision": F.round(F.col("k") / F.col("n"), 6), "lift": F.round((F.col("k") / F.col("n")) / (F.col("c") / F.col("t")), 6)})
    j = j.withColumn("score", F.round(F.col("precision") * F.log(1 + F.col("k")), 6))
    w = Window.partitionBy(label).orderBy(F.col("score").desc(), "phrase")
    return j.withColumn("place", F.row_number().over(w).cast("long")).where(F.col("place") <= top).select(label, "phrase", "k", "n", "precision", "lift", "place")
