"""Operators on small frames made for them."""

import datetime
import os

from pyspark.sql import functions as F

from folioframe.functions import dates, models, numbers, strings
from folioframe.operators import duplicates as D
from folioframe.operators import folds, keyvalues, listing, merge, rules, sequence, shared, stages
from folioframe.plans import base
from folioframe.sources import files, sinks
from folioframe.streaming import incremental as I

W = [f"word{i:03d}" for i in range(400)]


def pages(spark, texts, chart="c"):
    return spark.createDataFrame([(chart, i + 1, i + 1, t) for i, t in enumerate(texts)], "chart string, page_id long, page_no long, text string")


def found(spark, texts):
    v = D.verdicts(D.pair_scores(pages(spark, texts)))
    return sorted((r.page_id, r.kind, r.of_page) for r in D.duplicates(v).collect())


def test_duplicate_rules(spark):
    a = " ".join(W[:60])
    assert found(spark, [a, a]) == [(2, "duplicate", 1)]
    assert found(spark, [a, " ".join(W[:30])]) == []  # 210 characters: too short to compare
    assert found(spark, [" ".join(W[:100]), " ".join(W[:50])]) == [(2, "partial", 1)]  # contained, but half as long
    assert found(spark, [" ".join(W[:110]), " ".join(W[:121])]) == [(1, "duplicate", 2)]  # the larger one adds 11 words and stays
    assert found(spark, [a, a, a]) == [(2, "duplicate", 1), (3, "duplicate", 1)]
    assert found(spark, [a, " ".join(W[200:260])]) == []


def test_duplicate_window(spark):
    a = " ".join(W[:60])
    other = [" ".join(W[100 + i % 200 : 160 + i % 200]) + f" x{i}" for i in range(60)]
    near, far = other[:], other[:]
    near[0] = near[25] = a
    far[0] = far[26] = a
    assert (26, "duplicate", 1) in found(spark, near) and not any(r[0] == 27 for r in found(spark, far) if r[2] == 1)


def test_original_chain(spark):
    links = spark.createDataFrame([(2, 1), (3, 2), (4, 3), (9, 8)], "page_id long, of_page long")
    assert sorted(map(tuple, D.original_chain(links).collect())) == [(2, 1), (3, 1), (4, 1), (9, 8)]


def test_member_bar(spark):
    for n, w, want in ((10, 1, "reject"), (50, 4, "accept"), (50, 5, "reject"), (100, 5, "reject"), (1, 0, "accept")):
        p = spark.createDataFrame([("c", i, i < w) for i in range(n)], "chart string, page_no long, wrong boolean")
        r = rules.member_document(p, F.col("wrong")).first()
        assert r.decision == want and r.bar == max(1, min(5, -(-n // 10)))


def test_marker_orders(spark):
    p = spark.createDataFrame([("c", i, n, 3) for i, n in ((1, 2), (2, 1), (3, 3))] + [("d", 1, 2, 4), ("d", 2, 2, 4)], "chart string, page_no long, num long, total long")
    got = {(r.chart, r.page_no): (r.new_no, r.held) for r in sequence.fenced_order(p, "num", "total").collect()}
    assert [got["c", i][0] for i in (1, 2, 3)] == [2, 1, 3]
    assert got["d", 1] == (1, True) and got["d", 2] == (2, True)


def test_visits_and_ranges(spark):
    p = spark.createDataFrame([("c", i + 1, d) for i, d in enumerate(["a", "a", None, "a", "b"])], "chart string, page_no long, d string")
    v = sequence.runs(p, F.col("d")).orderBy("page_no").collect()
    assert [r.visit for r in v] == [1, 1, 2, 3, 4]
    q = spark.createDataFrame([("c", i) for i in (1, 2, 3, 5, 9, 10, 10)], "chart string, page_no long")
    assert sequence.page_ranges(q, ["chart"]).first().ranges == "1-3, 5, 9-10"


def test_latest_pass(spark):
    s = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "page_id long, pass_no int")
    assert sorted(map(tuple, stages.latest(s, ["page_id"], [F.col("pass_no").desc()]).collect())) == [(1, 2), (2, 1)]


def test_dates_and_confidence(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    d = lambda t: one(dates.parse_any(F.lit(t)).cast("string"))
    assert d("02/30/2024") is None and d("3/5/49") == "2049-03-05" and d("3/5/50") == "1950-03-05"
    # the first date of a text counts, whatever its shape, and an impossible first one gives none
    assert d("seen 05/20/2025, printed 2024-01-02") == "2025-05-20" and d("printed 2024-01-02, seen 05/20/2025") == "2024-01-02"
    assert d("on 02/30/2024 and 03/01/2024") is None and d("May 5, 2021 then 1/2/2020") == "2021-05-05"
    assert d("05 / 20 / 2025") == "2025-05-20" and d("26.Nov.1953") == "1953-11-26" and d("28/Feb/2024") == "2024-02-28"
    assert d("2024-01/02") is None and d("05-20/2025") is None and d("marching 4, 2021") is None and d("12024-01-02") is None
    c = lambda t: one(dates.canonical(F.lit(t)))
    assert c("20240102") == c("2024-01-02T10:30:00") == c("1/2/24") == c("2-Jan-24") == c("Jan 2, 2024") == "2024-01-02" and c(" Soon ") == "soon"
    ends = lambda t: one(dates.range_end(F.lit(t)).cast("string"))
    assert ends("1/2/2024 - 1/5/2024") == ends("1/2/2024 to 1/5/2024") == ends("from Jan 2, 2024 through 2024-01-05") == "2024-01-05"
    assert ends("1/5/2024 - 1/2/2024") is None and ends("1/2/2024 and 1/5/2024") is None
    assert d("seen March 4th, 2021 here") == "2021-03-04" and d("4 Mar 2021") == "2021-03-04" and d("nothing") is None
    assert one(numbers.backed(F.lit(0.5), F.lit(1.0))) == 0.75
    assert one(numbers.score(F.lit(0.9), F.array(F.lit("conflict"), F.lit("conflict")))) == 0.72
    assert one(strings.page_id_stem(F.lit("17.jpg"))) == 17 and one(strings.page_id_stem(F.lit("x"))) is None


def test_phrase_hits(spark):
    pages = spark.createDataFrame([(1, "Date of  Birth: 1/2\nthe dote of birth, of Date"), (2, "datt of sun\n\nDOB dob: dab")], "page_id long, text string")
    keys = spark.createDataFrame([("date of birth", "dob"), ("dob", "dob"), ("date", "date"), ("birth", "b")], "term string, field string")
    got = keyvalues.phrase_hits(keyvalues.word_boxes(pages), keys)
    assert sorted((r.page_id, r.line, r.place, r.n, r.field) for r in got.collect()) == [(1, 0, 1, 3, "dob"), (1, 1, 2, 3, "dob"), (1, 1, 6, 1, "date"), (2, 2, 1, 1, "dob"), (2, 2, 2, 1, "dob")]


def test_components_and_pages(spark, tmp_path):
    links = [(1, 2), (3, 2), (9, 8), (8, 7), (7, 9), (20, 21), (4, 4)]
    got = {r.node: r.root for r in shared.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {k: v for k, v in got.items() if k != v} == {2: 1, 3: 1, 8: 7, 9: 7, 21: 20}
    docs = [(i * 1500, f"t{i}", "en", "s" if i % 3 else None, 2) for i in range(20)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    p = base.pages(spark, str(tmp_path))
    want = {d: sum(x[3] == s and x[0] <= d for x in docs) for d, _, _, s, _ in docs}
    assert {r.page_id: r.page_no for r in p.collect()} == want
    before = {r.page_id: r.prev for r in base.with_previous(p).collect()}
    assert before[3000] == "t1" and before[4500] == "t0" and len(before) == 18


def test_merge_never_writes_null(spark):
    a = spark.createDataFrame([(1, "x", 5), (2, "y", 6)], "k int, a string, b int")
    b = spark.createDataFrame([(1, None, 7), (2, "y", 6), (3, "z", 8)], "k int, a string, b int")
    got = {r.k: (r.a, r.b, r.changed) for r in merge.upsert(a, b, ["k"]).collect()}
    assert got == {1: ("x", 7, True), 2: ("y", 6, False), 3: ("z", 8, True)}


def test_folds(spark):
    g = spark.createDataFrame([(1, 1, "main", "d1", 0.0), (1, 2, "junk", None, 9.0), (1, 3, "main", "d1", 5.0), (1, 4, "main", "d2", -5.0), (1, 5, "main", None, 1.0)], "chart long, page_no long, kind string, dos string, score double")
    assert [r.document for r in folds.continuity(g).orderBy("page_no").collect()] == [1, 1, 1, 2, 3]
    p = spark.createDataFrame([(1, 1, 2, False), (1, 2, 2, False), (1, 3, 1, True), (1, 4, 9, False)], "chart long, document long, pages long, by_last_page boolean")
    assert [r.packet for r in folds.packets(p).orderBy("document").collect()] == [1, 1, 1, 2]
    m = spark.createDataFrame([(1, 1, 1, 3), (1, 2, 2, 3), (1, 3, 1, 3), (1, 4, 3, 3), (1, 9, 1, 8)], "chart long, page_no long, num long, total long")
    assert [(r.page_no, r.stream) for r in folds.streams(m).orderBy("page_no").collect()] == [(1, 1), (2, 1), (3, 2), (4, 2)]
    c = spark.createDataFrame([(1, 1, 3, 0.9), (1, 3, 2, 0.8), (1, 2, 1, 0.7)], "chart long, a long, b long, score double")
    q = spark.createDataFrame([(1, i) for i in (1, 2, 3, 4)], "chart long, page_no long")
    assert [r.page_no for r in folds.chain_order(c, q).orderBy("new_no").collect()] == [1, 3, 2, 4]


def test_sources_and_sinks(spark, tmp_path):
    d = tmp_path / "Run3" / "chart one"
    d.mkdir(parents=True)
    for n in ("page10.jpg", "page2.jpg", "notes.txt"):
        (d / n).write_bytes(b"x")
    im = files.images(spark, str(tmp_path))
    assert [r.page_name for r in im.orderBy(*files.natural_key(F.col("path"))).collect()] == ["page2.jpg", "page10.jpg"]
    assert files.charts(im).first().pages == 2
    t = tmp_path / "ocr"
    t.mkdir()
    (t / "a.txt").write_text("===== p1 =====\nfirst\nline\n===== p2 =====\nsecond\n")
    assert sorted((r.page_name, r.text) for r in files.marked_texts(spark, str(t)).collect()) == [("p1", "first\nline"), ("p2", "second")]
    (tmp_path / "s.csv").write_bytes("Member ID, Name ,membername\n1,,Zoë\n2,Ana,x\n".encode("cp1252"))
    got = files.sheet(spark, str(tmp_path / "s.csv"), {"id": ("memberid",), "name": ("name", "membername")}).collect()
    assert [tuple(r) for r in got] == [("1", "Zoë"), ("2", "Ana")]
    assert list(sinks.csv_lines(spark.createDataFrame([(1, 'a"b'), (2, None)], "x int, y string").coalesce(1)))[1] == '1,"a""b"'
    run, batch = listing.run_batch_from_path(F.lit("x/r_12/Batch3/y"))
    assert tuple(spark.range(1).select(run, batch).first()) == ("Run12", "Batch3")


def test_streams_match_batches(spark, tmp_path):
    base = datetime.datetime(2024, 1, 1)
    rows = [(1, base), (1, base + datetime.timedelta(minutes=10)), (1, base + datetime.timedelta(hours=2)), (2, base)]
    ev = spark.createDataFrame([(u, t, "a", 1.0) for u, t in rows], "user_id long, ts timestamp, event_type string, value double")
    ev.write.parquet(str(tmp_path / "ev"))
    batch = sorted((r.user_id, r.events) for r in I.sessions(ev).collect())
    assert batch == [(1, 1), (1, 2), (2, 1)]
    late = spark.createDataFrame([(9, base + datetime.timedelta(hours=9), "a", 1.0)], ev.schema)
    late.write.mode("append").parquet(str(tmp_path / "ev"))
    st = spark.readStream.schema(ev.schema).parquet(str(tmp_path / "ev"))
    name = "s_out"
    out = I.to_memory(I.sessions(st), name)
    assert set((r.user_id, r.events) for r in out.collect()) <= set(batch) | {(9, 1)}
    a = spark.createDataFrame([(1, "x", 1), (2, "y", 1)], "k int, v string, n int")
    a.coalesce(1).write.parquet(str(tmp_path / "in"))
    go = lambda: I.intake(spark, str(tmp_path / "in"), a.schema, str(tmp_path / "t"), str(tmp_path / "cp"), ["k"], "n")
    go()
    spark.createDataFrame([(2, "z", 2), (3, "w", 1)], a.schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    go()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "t/v=1")).collect())) == [(1, "x", 1), (2, "z", 2), (3, "w", 1)]


def test_rule_file(tmp_path):
    f = tmp_path / "r.json"
    f.write_text('{"a": 1}')
    r = I.RuleFile(str(f))
    assert r.get() == {"a": 1}
    f.write_text("{broken")
    os.utime(f, ns=(1, 1))
    assert r.get() == {"a": 1}


def test_key_values(spark):
    p = spark.createDataFrame([(1, "Name: Ana DOB: 01/02/1990\nID: A7")], "page_id long, text string")
    w = keyvalues.word_boxes(p)
    keys = spark.createDataFrame([("dob", "dob"), ("id", "id")], "term string, field string")
    got = keyvalues.nearest_value(w, keyvalues.key_hits(w, keys), r"\d").collect()
    assert {r.field: r.value for r in got} == {"dob": "01/02/1990", "id": "A7"}


def test_model_hooks(spark):
    d = spark.createDataFrame([(1, "Ⅳ  a1", "x a b"), (2, None, "")], "id int, a string, b string")
    rows = d.select("id", models.unicode_normal("a").alias("u"), models.sequence_ratio("a", "b").alias("r"), models.longest_matches("b", F.array(F.lit("a b"), F.lit("a"))).alias("m"), models.scorer()("a").alias("p")).orderBy("id").collect()
    assert rows[0].u == "IV a#" and rows[1].u is None and rows[0].m == ["a b"] and rows[1].p == 0.0


def test_empty_tables(spark):
    p = spark.createDataFrame([], "chart string, page_id long, page_no long, text string")
    assert D.duplicates(D.verdicts(D.pair_scores(p))).count() == 0
    assert D.best_neighbor(D.pair_scores(p)).count() == 0


def test_signals_between_pages(spark):
    from folioframe.operators import continuity as C

    tail = ["the patient was seen again for a cough that had lasted many days", "and the cough was worse at night so that sleep was poor and the"]
    first = ["\n".join(["Clinic of the North, 01/02/2024", "Page 1 of 2", "x", "y", "text of no weight here", *tail, "f", "g", "Printed by the front desk 7"])]
    second = ["\n".join(["Clinic of the North, 03/04/2024", "Page 2 of 2", "x", "y", "cough that had lasted many days was worse at night and the sleep was poor", "so the patient was seen for a cough again", "f", "g", "Printed by the front desk 8"])]
    rows = [(1, 1, "main", first[0]), (1, 2, "blank", None), (1, 3, "main", second[0]), (1, 4, "junk", ""), (1, 5, "main", "HPI: cough"), (2, 1, "main", None), (2, 2, "main", None)]
    g = C.override(C.decide(C.signals(spark.createDataFrame(rows, "chart long, page_no long, kind string, text string"))))
    got = {(r.chart, r.page_no): r for r in g.collect()}
    at = {x.name: x.points for x in got[1, 3].signals}
    assert at["pagination_follows"] == -5 and at["same_header_line"] == -2 and at["same_footer_line"] == -1 and at["blank_between"] == 1
    assert -2 <= at["wording_char"] < 0 and -1 <= at["wording_word"] < 0 and at["cut_mid_sentence"] == -1 and at["starts_mid_thought"] == -1
    assert not got[1, 3].breaks and got[1, 3].decided_by == "decisive" and got[1, 3].level == "high"
    assert got[1, 5].prev == 3 and got[1, 5].rule == "visit heading" and got[1, 5].breaks and {x.name for x in got[1, 5].signals} == {"visit_heading", "last_numbered_page"}
    assert got[2, 2].signals == [] and got[2, 2].decided_by == "tie" and not got[2, 2].breaks
    assert not C.signals(spark.createDataFrame([], "chart long, page_no long, kind string, text string")).collect()


def test_space_before_the_text_is_kept_out_of_the_sum(spark):
    from pyspark.sql import functions as F

    from folioframe.operators import continuity as C

    d = spark.createDataFrame([(0.0,), (0.12,), (0.25,), (0.5,), (None,)], "a double")
    assert [r.v for r in d.select(C.text_start(F.col("a")).alias("v")).collect()] == [-1.0, 0.0, 2.0, 2.0, None]
