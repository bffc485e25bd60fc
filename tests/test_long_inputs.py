"""Steps whose work has to grow no faster than the text. Each took minutes here, or never ended, when it grew with a power of it."""

import datetime
import time

from pyspark.sql import functions as F

from folioframe.functions import dates, strings


def _one(spark, *values):
    began = time.time()
    row = spark.range(1).select(*values).first()
    assert time.time() - began < 60
    return row


def test_dates_in_long_texts(spark):
    words = F.repeat(F.lit("seen 12 x "), 2000)
    found = F.concat(words, F.lit("on March 3rd, 2024 to 3/9/2024"))
    got = _one(spark, dates.parse_any(found).alias("a"), dates.range_end(found).alias("b"), dates.dob_match(found, F.lit("2024-03-03").cast("date")).alias("c"), dates.parse_any(words).alias("d"))
    assert (got.a, got.b, got.c, got.d) == (datetime.date(2024, 3, 3), datetime.date(2024, 3, 9), False, None)
    assert _one(spark, dates.dob_match(F.concat(words, F.lit(" born: Marchy 03 2024.")), F.lit("2024-03-03").cast("date")).alias("c")).c


def test_labels_at_the_edges_of_a_text_without_blanks(spark):
    long = F.concat(F.lit("x "), F.repeat(F.lit("abc"), 300), F.lit(" "), F.repeat(F.lit("word "), 40), F.lit("dos 2024-01-02"))
    assert _one(spark, dates.edge_labelled(long).alias("d")).d == datetime.date(2024, 1, 2)


def test_first_spelling_counts(spark):
    texts = {"x 2-1/2/2024": "None", "13/45/2020 1/2/2024": "None", "5 Sept. 1999": "1999-09-05", "0099-1-2": "1999-01-02", "1 / 2 / 49": "2049-01-02", "-\n1/2/2024": "None", "May 5, 99": "None"}
    for text, want in texts.items():
        assert str(_one(spark, dates.parse_any(F.lit(text)).alias("d")).d) == want, text


def test_pairs_of_words_of_a_long_text(spark):
    assert _one(spark, F.size(strings.word_grams(F.repeat(F.lit("some words "), 10_000))).alias("n")).n == 19_999
