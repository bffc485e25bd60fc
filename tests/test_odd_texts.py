"""Texts with accents beside a word, marks of their own and rare white space: the same as the SQL twin says."""

import duckdb
import pytest

from folioframe.functions import strings
from folioframe.plans import catalog

TEXTS = ["oie die\u00e9 x", "\u00e9die", "the\u00e9 of", "\u00e9pour licensed under", "pour_ licensed under it " * 9, "a\x0bb " * 15 + "that", " lead\n===== p9 =====\n\\===== x\ntail \x0b", "", None, "\n\nx\u2028===== q =====\u2028y \u0085 ", "ends.\n", "cont\u00e9 cont. ", "Of the\u00e9 of the", "\u00e9of the. of the"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("odd"))
    rows = [(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{at}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{at}/documents.parquet/*.parquet'")
    return at, con


@pytest.mark.parametrize("name", ["topk_evidence", "bj_rule_cascade", "bj_flag_taxonomy", "scan_combined_ocr_txt", "sink_ocr_files", "str_whole_word_regex", "str_continued_cues", "mem_key_sentences", "pt_rules", "str_ngrams"])
def test_same_as_sql(spark, tables, name):
    at, con = tables
    df = catalog.queries()[name](spark, at)
    got = con.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in got.description]
    assert sorted(map(repr, map(tuple, df.select(columns).collect()))) == sorted(map(repr, got.fetchall()))


def test_word_grams_of_any_length(spark):
    row = spark.sql("select 'a b c d' as x, 'a' as y").select(*(strings.word_grams(c, n).alias(f"{c}{n}") for c in "xy" for n in (1, 2, 3, 5))).first()
    assert (row.x1, row.x2, row.x3, row.x5) == (list("abcd"), ["a b", "b c", "c d"], ["a b c", "b c d"], []) and (row.y1, row.y2, row.y3) == (["a"], [], [])
