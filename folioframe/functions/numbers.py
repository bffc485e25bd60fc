"""Numbers and confidences as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Factors of a confidence's penalties.
PENALTIES = {"conflict": 0.8, "no_model": 0.85, "weak_text": 0.9, "low_quality": 0.85, "handwritten": 0.9, "fallback": 0.75, "inherited": 0.95, "single_source": 0.9}
GOOD, PASSABLE = 0.8, 0.5


def orientation_bucket(angle: Column) -> Column:
    return F.pmod((F.floor((angle + 45) / 90) * 90).cast("int"), F.lit(360))


def quality_label(score: Column, handwritten: Column) -> Column:
    label = F.when(score >= 0.70, "high").when(score >= 0.40, "medium").otherwise("low")
    return F.when(score.isNull(), None).when(handwritten & (label == "high"), "medium").otherwise(label)


def backed(p: Column, support: Column) -> Column:
    return p + (1 - p) * 0.5 * support


def score(base: Column, reasons: Column) -> Column:
    """base times the factor of each distinct reason, within 0 and 1, to four places."""
    table = F.create_map(*(F.lit(x) for kv in PENALTIES.items() for x in kv))
    total = F.aggregate(F.array_distinct(reasons), base.cast("double"), lambda a, r: a * F.coalesce(table[r], F.lit(1.0)))
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)), 4)


def under_bar(p: Column, bar: float, review: float = PASSABLE) -> Column:
    return F.round(p / bar * (review - 0.01), 4)


def absent(rejected: Column, no_model: float = 0.85) -> Column:
    """Confidence that a value is not there: one less the best rejected candidate."""
    return F.coalesce(1 - F.array_max(rejected), F.lit(no_model))


def band(value: Column) -> Column:
    return F.when(value >= GOOD, "good").when(value >= PASSABLE, "passable").when(value.isNotNull(), "review")


def similarity_confidence(s: Column) -> Column:
    """Confidence that a page is no copy: halves with each 5 % of likeness above 95 %, one below 80 %, falling between."""
    high = F.pow(F.lit(0.5), (s - 0.95) / 0.05 + 1)
    return F.when(s >= 0.95, high).when(s <= 0.80, 1.0).otherwise(1.0 - (s - 0.80) / 0.15 * 0.5)


def ramp(x: Column, x0: float, y0: float, x1: float, y1: float) -> Column:
    return F.when(x <= x0, y0).when(x >= x1, y1).otherwise(y0 + (x - x0) * (y1 - y0) / (x1 - x0))


def sigmoid_confidence(total: Column, centre: float, spread: float) -> Column:
    return F.abs(2 / (1 + F.exp(-(total - centre) / spread)) - 1)


def vote_share(keyword_total: Column, share: float, full: float) -> Column:
    """Weight of the keywords' say beside a model's."""
    return share * F.least(F.lit(1.0), keyword_total / full)


def vote_blend(model_p: Column, keyword: Column, keyword_total: Column, share: float, full: float) -> Column:
    k = vote_share(keyword_total, share, full)
    return (1 - k) * model_p + k * F.coalesce(F.try_divide(keyword, keyword_total), F.lit(0.0))


def repeat_factor(count: Column, threshold: float, most: float) -> Column:
    return F.greatest(F.lit(1.0), F.least(F.lit(most), F.sqrt(F.lit(threshold) / count)))


def class_weight(count: Column, total: Column, classes: Column, root: bool = False) -> Column:
    w = total / (classes * count)
    return F.sqrt(w) if root else w
