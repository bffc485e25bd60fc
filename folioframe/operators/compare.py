"""Comparison of sheets with ground truth, tallies and rates. Rates that are undefined are null, not zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.functions import strings as S


def blank(x: Column) -> Column:
    """Not labelled at all; "-" and "N/A" are labels."""
    return F.trim(F.coalesce(x.cast("string"), F.lit(""))) == ""


def field_result(ground: Column, system: Column, kind: str = "text") -> Column:
    """match, mismatch or extra by the kind of field; a blank ground truth always matches."""
    norm = {"text": S.clean_text, "yes_no": S.yes_no, "codable": S.codable, "print": S.print_type, "name": S.name_key, "id": lambda x: S.identifier(F.trim(x)), "number": lambda x: x.cast("double").cast("string")}
    if kind == "presence":
        same = (S.yes_no(ground) == "yes") == ~blank(system)
    elif kind == "credentials":
        same = F.arrays_overlap(S.credential_tokens(ground), S.credential_tokens(system))
    elif kind == "date":
        from folioframe.functions.dates import canonical

        same = canonical(ground.cast("string")) == canonical(system.cast("string"))
    else:
        same = norm[kind](ground) == norm[kind](system)
    return F.when(blank(ground), "match").when(F.coalesce(same, F.lit(False)), "match").otherwise("mismatch")


def record_status(results: dict[str, Column], match: Column) -> Column:
    """CORRECT, ERROR, MISSING, EXTRA of a record from its fields' results and its match status."""
    wrong = F.lit(0)
    for r in results.values():
        wrong = wrong + (r == "mismatch").cast("int")
    return F.when(match == "missing", "MISSING").when(match == "extra", "EXTRA").when(wrong == 0, "CORRECT").otherwise("ERROR")


def rate(n: Column, d: Column, places: int = 2) -> Column:
    return F.round(F.try_divide(100.0 * n, d.cast("double")), places)


def summary(rows: DataFrame) -> DataFrame:
    """Status counts with exact-match, accuracy of what was compared, and extra rates."""
    n = lambda s: F.count_if(F.col("status") == s)
    g = rows.agg(n("CORRECT").alias("correct"), n("ERROR").alias("error"), n("MISSING").alias("missing"), n("EXTRA").alias("extra"))
    c = F.col("correct")
    return g.select("*", rate(c, c + F.col("error") + F.col("missing")).alias("exact_match"), rate(c, c + F.col("error")).alias("evaluated"), rate(F.col("extra"), c + F.col("error") + F.col("extra")).alias("extra_rate"))


def class_rates(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Of (truth, pred): tp, fp, fn, precision, recall and F1 for each class; a wrong value counts against both. Each row is counted under
    its truth and its prediction, so the classes need no join with the rows."""
    both = pairs.select(F.explode(F.array_distinct(F.array(F.struct(F.col("truth").alias("c")), F.struct(F.col("pred").alias("c"))))).alias("k"), "truth", "pred").select(F.col("k.c").alias("label"), "truth", "pred")
    t, p = F.col("truth").eqNullSafe(F.col("label")), F.col("pred").eqNullSafe(F.col("label"))
    g = both.groupBy("label").agg(F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"))
    g = classes.join(g, "label", "left").na.fill(0, ["tp", "fp", "fn"])
    div = lambda a, b: F.round(F.try_divide(a.cast("double"), b.cast("double")), 4)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return g.select("label", "tp", "fp", "fn", div(tp, tp + fp).alias("precision"), div(tp, tp + fn).alias("recall"), div(2 * tp, 2 * tp + fp + fn).alias("f1"))


def tally(rows: DataFrame, stream: str, verdict: str) -> DataFrame:
    """Yes, maybe, no and not scored of each stream; maybe counts half."""
    v = F.col(verdict)
    n = lambda s: F.count_if(v == s)
    scored = F.count(F.when(v.isin("yes", "maybe", "no"), 1))
    score = F.round(F.try_divide(F.sum(F.when(v == "yes", 1.0).when(v == "maybe", 0.5).otherwise(0.0)), scored.cast("double")), 4)
    return rows.groupBy(stream).agg(n("yes").alias("yes"), n("maybe").alias("maybe"), n("no").alias("no"), scored.alias("scored"), score.alias("score"))


def match_bands(pages: DataFrame, verdicts: list[str]) -> DataFrame:
    """Pages by number of streams that match, with the band of each."""
    k = F.lit(0)
    for c in verdicts:
        k = k + F.coalesce(F.col(c).cast("int"), F.lit(0))
    g = pages.groupBy(k.cast("long").alias("matched")).agg(F.count("*").alias("pages"))
    return g.withColumn("band", F.when(F.col("matched") >= 5, "good").when(F.col("matched") >= 3, "fair").otherwise("bad"))


def hierarchical(rows: DataFrame, gold: str, pred: str) -> DataFrame:
    """Set-based precision, recall and F1 over label paths (arrays)."""
    shared = F.sum(F.size(F.array_intersect(gold, pred))).cast("double")
    g = rows.agg(shared.alias("s"), F.sum(F.size(gold)).cast("double").alias("g"), F.sum(F.size(pred)).cast("double").alias("p"))
    r = lambda x: F.round(x, 4)
    return g.select(r(F.try_divide("s", "p")).alias("precision"), r(F.try_divide("s", "g")).alias("recall"), r(F.try_divide(2 * F.col("s"), F.col("g") + F.col("p"))).alias("f1"))


def threshold_sweep(rows: DataFrame, score: str, correct: str, thresholds: list[float]) -> DataFrame:
    """Coverage and precision at each threshold. Rows fall into the gap between thresholds once; running sums do the rest."""
    ts = sorted(thresholds)
    step = F.lit(-1)
    for i, t in enumerate(ts):
        step = F.when(F.col(score) >= t, i).otherwise(step)
    g = rows.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.sum(F.col(correct).cast("long")).alias("c"))
    spark = rows.sparkSession
    grid = spark.createDataFrame(list(enumerate(ts)), "i int, threshold double")
    total = g.agg(F.sum("n").alias("total"))
    j = grid.join(g, F.col("step") >= F.col("i"), "left").groupBy("i", "threshold").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("c"), F.lit(0)).alias("c"))
    return j.crossJoin(total).select("threshold", F.round(F.col("n") / F.col("total"), 4).alias("coverage"), F.round(F.try_divide(F.col("c").cast("double"), F.col("n").cast("double")), 4).alias("precision"))
