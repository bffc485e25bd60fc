import random
import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from folioframe.llm import components, simhash


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_fingerprint():
    for t in ["", "  \n", "One", "One two", "a b c", "É ÀB c d\x0be F g " * 7, "w " * 5000]:
        assert simhash.fingerprint(t) == brute(t)


def test_bk_tree_finds_all():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    v = np.unique(np.concatenate([base, *(base ^ np.uint64(1 << int(i)) for i in rng.integers(0, 63, 12))]))
    tree = simhash.BKTree(v)
    got = {(p, int(q)) for p, near in tree.within(v, 2) for q in near}
    want = {(i, j) for i in range(len(v)) for j in range(len(v)) if bin(int(v[i] ^ v[j])).count("1") <= 2}
    assert got == want


def rows():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(150):
        words = rng.choices(vocab, k=rng.choice([2, 30, 200]))
        docs.append((i, " ".join(words)))
        for j in range(rng.choice([0, 0, 1, 3])):
            w = words[:]
            w[rng.randrange(len(w))] = "x"
            docs.append((1000 + 10 * i + j, " ".join(w)))
    return docs + [(5000, None), (5001, ""), (5002, " "), (3, docs[3][1]), (None, "w1 w2"), (None, "lone text")]


def test_components_match_brute(spark):
    docs = rows()
    got = simhash.near_duplicates(spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, fp int")).collect()
    fps = [brute(t or "") for _, t in docs]
    up = list(range(len(docs)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    want = sorted(((d, f"{f:016x}", least.get(find(i))) for i, (d, f) in enumerate(zip((d for d, _ in docs), fps))), key=str)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == want


def brute_shingles(text, size=5):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(" ".join(words[i : i + size]) for i in range(len(words) - size + 1)) or frozenset([" ".join(words)] if words else [])


def brute_keep(docs, least=0.8):
    """Rows (doc_id, text, ...) that stay: all pairs compared, one row of each group."""
    sets = [brute_shingles(r[1] or "") for r in docs]
    up = list(range(len(docs)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= least * (len(sets[i]) + len(sets[j]) - both):
                up[find(i)] = find(j)
    best = {}
    for i, r in enumerate(docs):
        k, key = find(i), (r[0] is None, r[0] or 0, signed(r[1] or ""))
        if k not in best or key < best[k][0]:
            best[k] = key, r
    return [r for _, r in best.values()]


def signed(text):
    x = xxhash.xxh64_intdigest(text.encode(), 42)
    return x - 2**64 if x >= 2**63 else x


def edited():
    """Documents with copies at similarities on both sides of 0.8, chains of them, and a crowd of near copies."""
    rng = random.Random(9)
    vocab = [f"v{i}" for i in range(900)]
    out = []
    for i in range(60):
        words = rng.choices(vocab, k=rng.choice([3, 4, 6, 40, 150, 400]))
        out.append((i, " ".join(words)))
        for j in range(rng.choice([0, 1, 2, 4])):
            words = words[:]
            for _ in range(rng.choice([0, 1, 2, 4, 8])):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            out.append((100 + 10 * i + j, " ".join(words)))
    base = rng.choices(vocab, k=200)
    for i in range(80):
        words = base[:]
        words[rng.randrange(200)] = f"own{i}"
        out.append((1000 + i, "  ".join(words).upper()))
    return out + [(2000, None), (2001, ""), (2002, " \n"), (2003, "two words"), (None, "Two  WORDS"), (None, "no id"), (3, out[3][1]), (3, out[3][1])]


def test_keep_one_matches_brute(spark, monkeypatch):
    docs = edited()
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, _h int, `a.b` int")
    want = Counter(brute_keep(docs))
    assert Counter((r[0], r[1]) for r in simhash.keep_one(df).collect()) == want
    assert simhash.keep_one(df).columns == df.columns
    monkeypatch.setattr(simhash, "CROWDED", 7)  # salted groups
    monkeypatch.setattr(simhash, "CLOSE", 3)  # finer ones
    assert Counter((r[0], r[1]) for r in simhash.keep_one(df.repartition(5)).collect()) == want


def test_one_shared_band_is_enough_in_any_group(spark, monkeypatch):
    """Pairs that share a single band, in a group that is larger than a part: none is lost, whatever the size of the parts."""
    rng = random.Random(12)
    texts = []
    for _ in range(9):
        words = rng.choices([f"u{i}" for i in range(500)], k=100)
        texts += [" ".join(words), " ".join([*words[:-1], "x"]), " ".join(["y", *words[1:]])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marks = simhash.sketches(docs).drop("keys")
    own = F.concat(F.array(F.lit(7).cast("long")), F.array(*(F.xxhash64("sid", F.lit(i)) for i in range(simhash.BANDS - 1))))
    sets = marks.select("sid", "th", "doc_id", "fp", own.alias("keys")).cache()
    keyed = sets.select(F.explode("keys").alias("key"), "sid", "fp", F.col("sid").alias("comp"))
    of = {r.sid: r.doc_id for r in sets.collect()}
    for close in (500, 26, 8, 2, 1):
        monkeypatch.setattr(simhash, "CLOSE", close)
        links = {frozenset((of[a], of[b])) for a, b in simhash.close_links(keyed, sets, docs, 5, 0.8, 64).collect()}
        groups = [{x for p in links if p & set(range(i, i + 3)) for x in p} for i in range(0, 27, 3)]
        assert groups == [set(range(i, i + 3)) for i in range(0, 27, 3)], close


def test_tree_pairs():
    rng = np.random.default_rng(2)
    for _ in range(60):
        base = rng.integers(0, 2**63, 4, dtype=np.uint64)
        v = np.concatenate([base[rng.integers(0, 4, 30)] ^ (np.uint64(1) << rng.integers(0, 63, 30).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 63, 30).astype(np.uint64)), base])
        label = rng.integers(0, 5, len(v))
        near = [(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if int(v[i] ^ v[j]).bit_count() <= 3]
        got = simhash.tree_pairs(v, label, 3, False)
        assert sorted(tuple(sorted(p)) for p in got) == [p for p in near if label[p[0]] != label[p[1]]]

        def parts(pairs):
            up = list(range(len(v)))  # noqa: B023
            for i, j in pairs:
                a, b = up[i], up[j]
                up = [b if x == a else x for x in up]
            return Counter(tuple(i for i, x in enumerate(up) if x == y) for y in set(up))

        joined = simhash.tree_pairs(v, np.arange(len(v)), 3, True)
        assert parts(joined) == parts(near) and len(joined) == len(v) - len(parts(near))


def test_components_in_few_files(spark, monkeypatch):
    """A chain, a ring and loops; the result's files follow the number of edges."""
    edges = [(i, i + 1) for i in range(40)] + [(100 + i, 100 + (i + 1) % 9) for i in range(9)] + [(200, 200), (300, 301)]
    want = {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 109)} | {301: 300}
    for files, most in ((100_000, 1), (10, 6)):
        monkeypatch.setattr(components, "FILE_EDGES", files)
        got = components.connected_components(spark.createDataFrame(edges, "a long, b long").repartition(7))
        assert {r.node: r.root for r in got.collect()} == want and got.rdd.getNumPartitions() <= most


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0


def test_block_keys_cover_radius(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(-(2**63), 2**63, 60, dtype=np.int64)
    b = [int(x) ^ (1 << int(i)) ^ (1 << int(j)) for x, (i, j) in zip(a, rng.integers(0, 62, (60, 2)))]
    df = spark.createDataFrame([(int(x),) for x in {*a.tolist(), *b}], "fp long")
    found = {frozenset(r) for r in simhash.links(df).collect()}
    assert all(frozenset((int(x), y)) in found for x, y in zip(a, b) if int(x) != y)
    old, simhash.CROWDED = simhash.CROWDED, 1
    try:
        assert {frozenset(r) for r in simhash.links(df).collect()} == found
    finally:
        simhash.CROWDED = old
