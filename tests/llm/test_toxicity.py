import random
import zlib

import numpy as np
import pytest

from folioframe.llm import toxicity as X

VOCAB = [f"word{i}" for i in range(900)]


def corpus(n=900):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        words = rng.choices(VOCAB, k=rng.randrange(10, 120))
        bad = i % 6 == 0
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["grubby", "Vilest.", "rotten!"]))
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_ftrl_matches_plain_form():
    """The vector code against one coordinate at a time."""
    rng = np.random.default_rng(1)
    rows = [(np.unique(rng.integers(0, 40, 6)).astype(np.int32), int(rng.random() < 0.3)) for _ in range(60)]
    old, X.L1, X.BALANCE = (X.L1, X.BALANCE), 0.3, 0.0
    try:
        got = X.train(rows, epochs=2, seed=5)
        z, n, zb, nb = {}, {}, 0.0, 0.0
        w_of = lambda i: 0.0 if abs(z.get(i, 0)) <= X.L1 else (np.sign(z[i]) * X.L1 - z[i]) / ((X.BETA + n[i] ** 0.5) / X.ALPHA + X.L2)
        order = np.random.default_rng(5)
        for _ in range(2):
            for i in order.permutation(len(rows)):
                at, y = rows[i]
                w = {int(j): w_of(int(j)) for j in at}
                wb = -zb / ((X.BETA + nb**0.5) / X.ALPHA)
                g = 1 / (1 + np.exp(-(sum(w.values()) + wb))) - y
                for j in w:
                    s = ((n.get(j, 0) + g * g) ** 0.5 - n.get(j, 0) ** 0.5) / X.ALPHA
                    z[j] = z.get(j, 0) + g - s * w[j]
                    n[j] = n.get(j, 0) + g * g
                zb += g - ((nb + g * g) ** 0.5 - nb**0.5) / X.ALPHA * wb
                nb += g * g
        want = {j: w_of(j) for j in z if w_of(j)}
        assert got["at"].tolist() == sorted(want)
        assert np.allclose(got["w"], [want[j] for j in sorted(want)])
    finally:
        X.L1, X.BALANCE = old


def plain_places(text):
    """Features one at a time, in Python's whole numbers."""
    marks = set("\t\n\x0b\x0c\r.,;:!?\"()[]{}<>|*#$%&/\\=+~` ")
    words, now = [], ""
    for c in "".join(c.lower() if "A" <= c <= "Z" else c for c in text) + " ":
        if c in marks:
            if now:
                words.append(now)
            now = ""
        else:
            now += c
    h = [zlib.crc32(w.encode()) for w in words]
    full = [x * 0xFF51AFD7ED558CCD for x in h]
    full += [(a * 0x9E3779B97F4A7C15 % 2**64) ^ (b * 0xC2B2AE3D27D4EB4F % 2**64) for a, b in zip(h, h[1:])]
    full += [(a * 0x165667B19E3779F9 % 2**64) ^ (b * 0x27D4EB2F165667C5 % 2**64) for a, b in zip(h, h[2:])]
    return [x % 2**64 >> (64 - X.BITS) for x in full]


def test_features_and_score_against_plain_form():
    rng = random.Random(6)
    pieces = ["One", "two,", "ÉTÉ", "a=b", "x", "(y)", "\n", " ", "  ", "don't", "😀"]
    texts = ["", " . ", "Word", "A b"] + [" ".join(rng.choices(pieces, k=rng.randrange(40))) for _ in range(60)]
    weights = {p: rng.uniform(-2, 2) for t in texts[:30] for p in plain_places(t)}
    at = np.array(sorted(weights), np.int32)
    one = X.scorer({"at": at, "w": np.array([weights[int(i)] for i in at]), "bias": -0.3})
    for t in texts:
        assert sorted(X.hashed(t).tolist()) == sorted(plain_places(t))
        want = 1 / (1 + np.exp(-(sum(weights.get(p, 0.0) for p in set(plain_places(t))) - 0.3)))
        assert one(t) == pytest.approx(want, abs=1e-5)


def test_places_have_a_bound(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"w{i} x{i} y{i}") for i in range(1, 40)] + [(1, "w1")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(X, "train", lambda rows, **k: seen.append(rows) or {"at": np.zeros(0, np.int32), "w": np.zeros(0), "bias": 0.0})
    X.fit(docs, labels)
    monkeypatch.setattr(X, "TRAIN_PLACES", 60)
    X.fit(docs, labels)
    assert len(seen[0]) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(1, 40))
    assert 54 <= sum(len(a) for a, _ in seen[1]) <= 60


def test_places_are_held_once(spark, monkeypatch):
    """All rows that are trained on are parts of one array, of their own size, in the order of their ids."""
    docs = spark.createDataFrame([(i, f"w{i} x{i} y{i % 7}") for i in range(40, 0, -1)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 41)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(X, "train", lambda rows, **k: seen.append(rows))
    X.fit(docs.repartition(5), labels)
    ids = [i for i in range(1, 41) if zlib.crc32(str(i).encode()) % 5]
    assert [(a.tolist(), y) for a, y in seen[0]] == [(sorted(set(plain_places(f"w{i} x{i} y{i % 7}"))), i % 2) for i in ids]
    assert len({id(a.base) for a, _ in seen[0]}) == 1 and seen[0][0][0].base.size == sum(len(a) for a, _ in seen[0])


def test_held_out_accuracy_and_edges(spark):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, 0.5) for d, t, _ in rows] + [(5000, None, 0.1), (5001, "", 0.1), (None, "grubby", 0.1), (0, rows[0][1], 0.1), (5002, "grubby vilest rotten " * 20000, 0.1)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(d, 1, y) for d, _, y in rows] + [(1, 1, None), (None, 1, 1), (2, 0, 7)], "doc_id long, quality int, toxic int")
    got = X.assess(docs, labels).collect()
    assert len(got) == len(rows) + 5
    by = {r.doc_id: r for r in got}
    held = [(d, y) for d, _, y in rows if zlib.crc32(str(d).encode()) % 5 == 0]
    assert all(by[d].held_out for d, _ in held) and not any(by[d].held_out for d, *_ in rows if (d, 0) not in held and (d, 1) not in held)
    assert np.mean([by[d].predicted == y for d, y in held]) > 0.95
    assert by[5000].score == by[5001].score and by[5002].predicted == 1 and by[None].held_out
    kept = X.keep_clean(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got)
    # held-out labels change nothing
    flipped = spark.createDataFrame([(d, 1, (1 - y) if (d, y) in held else y) for d, _, y in rows], "doc_id long, quality int, toxic int")
    assert sorted((r.doc_id or -1, r.score) for r in X.assess(docs, flipped).collect()) == sorted((r.doc_id or -1, r.score) for r in got)


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert X.assess(docs, none).first().score == pytest.approx(0, abs=1e-9)
    assert X.assess(docs.limit(0), none).count() == 0


def test_training_table_has_few_files(spark, monkeypatch):
    """Each file costs an executor two commands of the system, so files must follow the drawn rows and not the shuffle's partitions."""
    rows = corpus(600)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    want, files, write = X.fit(docs, labels, rows=300), {}, X.write_table

    def counted(df, name):
        out = write(df, name)
        files[name] = len(out.inputFiles())
        return out

    monkeypatch.setattr(X, "write_table", counted)
    monkeypatch.setattr(X, "FILE_ROWS", 100, raising=False)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "50")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = X.fit(docs, labels, rows=300)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert files["places"] <= 3
    assert got["bias"] == want["bias"] and (got["at"] == want["at"]).all() and (got["w"] == want["w"]).all()
