"""Queries without SQL that are to see whole texts."""

from folioframe.plans import catalog


def test_unicode_normalize_beyond_a_prefix(spark, tmp_path):
    start = "a " * 600
    rows = [(1, start + "\u00e9"), (2, start + "e\u0301"), (3, start + "x"), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.normal for r in catalog.queries()["str_unicode_normalize"](spark, str(tmp_path)).collect()}
    assert got[1] == got[2] != got[3]
