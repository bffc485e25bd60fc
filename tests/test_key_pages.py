"""The page-wise searches of keys find what the joins over word boxes find."""

import random

from pyspark.sql import functions as F

from folioframe.operators import keyvalues as K

KEYS = [("name", "name", r"^[A-Z][a-z]+\d*$"), ("member", "name", r"^[A-Z][a-z]+\d*$"), ("dob", "dob", r"^\d+/\d+/\d{4}$"), ("id", "id", r"^[A-Z]\d+$")]


def _pages(spark):
    r = random.Random(3)
    words = ["Name:", "NAME", "Na-me.", "member", "DOB:", "d.o.b", "ID", "id:", "", "Ana", "Costa7", "1/2/2024", "03/4/1999", "A12", "B1", "x", "some_longer_word", "Éid"]
    text = lambda: "\n".join(" ".join(r.choice(words) for _ in range(r.randint(0, 7))) for _ in range(r.randint(1, 6)))
    return spark.createDataFrame([(i, text()) for i in range(400)] + [(400, None), (401, "")], "page_id long, text string")


def _bag(df, *columns):
    return sorted(map(repr, map(tuple, df.select(*columns).collect())))


def test_same_as_joins(spark):
    p = _pages(spark)
    words, keys = K.word_boxes(p), spark.createDataFrame(KEYS, "term string, field string, pattern string")
    by_join = _bag(K.nearest_values(words, keys), "page_id", "field", "value")
    assert len(by_join) > 200 and _bag(K.page_values(p, KEYS), "page_id", "field", "value") == by_join
    hits = K.key_hits(words, keys)
    assert _bag(K.page_key_counts(p, KEYS), "page_id", "field", "hits") == _bag(hits.groupBy("page_id", "field").agg(F.count("*").alias("hits")), "page_id", "field", "hits")
    trust = K.trusted(hits, near=1).groupBy("page_id").agg(F.count("*").alias("hits"), F.count_if("trusted").alias("trusted"))
    assert _bag(K.page_trust(p, KEYS, near=1), "page_id", "hits", "trusted") == _bag(trust, "page_id", "hits", "trusted")
