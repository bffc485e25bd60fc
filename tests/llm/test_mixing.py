import random

import duckdb
import pandas as pd

from folioframe.llm import mixing as M


def highest_quotients(w, total, caps):
    every = sorted((-x / (2 * k + 1), i) for i, (x, c) in enumerate(zip(w, caps)) for k in range(c))[:total]
    return [sum(i == j for _, j in every) for i in range(len(w))]


def test_sainte_lague():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randrange(1, 7)
        w = [rng.choice([0, 1, 2, 5, 10, rng.random() * 50]) for _ in range(n)]
        caps = [rng.randrange(0, 40) for _ in range(n)]
        total = rng.randrange(0, 90)
        if not any(x == 0 and c for x, c in zip(w, caps)):
            assert M.sainte_lague(w, total, caps) == highest_quotients(w, total, caps), (w, total, caps)
    got = M.sainte_lague([3e12, 1e12, 1.0], 10**12, [10**13] * 3)
    assert sum(got) == 10**12 and abs(got[0] - 75 * 10**10) < 3


def test_targets():
    assert M.targets([100, 100, 100], [5, 2, 1]) == [200.0, 450 * 0 + 250 * 2 / 3, 250 / 3]
    assert M.targets([0, 10], [5, 2]) == [0.0, 15.0] and M.targets([0], [5]) == [0.0]


def rows():
    rng = random.Random(2)
    out = [(i, " ".join(["w"] * rng.choice([1, 3, 40, 300])), rng.choice(["a", "b", "b", "b", "Z", "é", None, "big", "big", "big"])) for i in range(700)]
    return out + [(900, None, "a"), (901, "", "void"), (902, "one", "tiny"), (5, "w w", "a"), (None, "w w w", "b"), (None, "w w", "b"), (7, out[7][1], out[7][2])]


def test_mixture_matches_sql_and_targets(spark):
    data = rows()
    docs = spark.createDataFrame([(*r, 1.5) for r in data], "doc_id long, text string, source string, taken double")
    old, M.SHARD_WORDS = M.SHARD_WORDS, 5000
    try:
        got = M.mixture(docs).toPandas()
        again = M.mixture(docs.repartition(3)).toPandas()
    finally:
        M.SHARD_WORDS = old
    key = ["doc_id", "size", "target", "taken"]
    assert got.sort_values(key).reset_index(drop=True).equals(again.sort_values(key).reset_index(drop=True))
    assert len(got) == len(data) and (got.taken <= 2 * got["size"]).all()
    for (_, t), g in got.groupby(["source_size", "target"]):
        assert abs(g.taken.sum() - t) <= 2 * M.BLOCK + 0.01 * t
    assert abs(got.taken.sum() - 1.5 * got["size"].sum()) < 0.005 * got["size"].sum()
    con = duckdb.connect()
    con.register("documents", pd.DataFrame([(d, t, s) for d, t, s in data], columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"}))
    want = con.sql(M.SQL).df()
    mine = M.mixture(docs).toPandas()
    f = lambda x: sorted(map(tuple, x.astype({"doc_id": "Int64"}).fillna(-1)[["doc_id", "size", "source_size", "target", "taken"]].values.tolist()))
    assert f(mine) == f(want)


def test_mixed_rows(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, source string")
    out = M.mixed(docs)
    assert out.columns == docs.columns
    words = sum(len((r.text or "").split(" ")) if r.text else 0 for r in out.collect())
    taken = M.mixture(docs).toPandas().taken.sum()
    assert abs(words - taken) <= 2  # the text with a no-break space is one word here, two in str.split
    assert M.mixed(docs.limit(0)).count() == 0 and M.mixture(docs.limit(0)).count() == 0


def test_mixed_writes_no_table(spark, monkeypatch):
    """Sizes are only summed: no files for them, and nothing stays cached."""
    docs = spark.createDataFrame(rows(), "doc_id long, text string, source string")
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    monkeypatch.setattr(M, "write_table", None)
    monkeypatch.setattr(M, "SHARD_WORDS", 5000)
    got = M.mixed(docs).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached
    monkeypatch.undo()
    monkeypatch.setattr(M, "SHARD_WORDS", 5000)
    assert sum(len(r.text.split()) for r in got) == sum(r.taken for r in M.mixture(docs).collect()) > 0
