import hashlib
import random

import numpy as np

from folioframe.llm import substrings as X
from folioframe.llm import suffixes as S


def test_suffix_array_and_prefixes():
    rng = random.Random(1)
    for _ in range(1500):
        k, n = rng.choice([2, 3, 5, 20]), rng.randrange(0, 60)
        t = [rng.randrange(1, k) for _ in range(n)]
        t = t * (5 if rng.random() < 0.3 else 1) + [0]
        a = np.array(t, np.uint8)
        sa = S.suffix_array(a, max(t) + 1)
        assert sa.tolist() == sorted(range(len(t)), key=lambda i: t[i:]) == S.reduced_array(t, max(t) + 1)  # noqa: B023
        phi, shared = S.permuted_prefixes(a, sa)
        for x, y in zip(sa[1:], sa[:-1]):
            n = next(i for i in range(len(t)) if t[x + i] != t[y + i])
            assert phi[x] == y and shared[x] == n


def test_recursion_is_taken(monkeypatch):
    """A Fibonacci word: every level's substrings repeat, so names stay few all the way down."""
    a, b = [1], [1, 2]
    while len(b) < 3000:
        a, b = b, b + a
    t, depth, inner = b + [0], [], S.reduced_array
    monkeypatch.setattr(S, "reduced_array", lambda x, k: depth.append(len(x)) or inner(x, k))
    assert S.suffix_array(np.array(t, np.uint8), 3).tolist() == sorted(range(len(t)), key=lambda i: t[i:])
    assert len(depth) > 3


def brute(texts):
    raws = [(t or "").encode() for t in texts]
    times = {}
    for r in raws:
        for i in range(len(r) - 199):
            times[r[i : i + 200]] = times.get(r[i : i + 200], 0) + 1
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - 199):
            if times[r[i : i + 200]] > 1:
                gone[i : i + 200] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1).sum())
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(r, np.uint8)[~gone])).hexdigest()))
    return out


def corpus():
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, edge = text(50), text(36)
    out = [text(rng.choice([5, 40, 200, 400])) for _ in range(40)]
    for i in range(60):
        t = text(rng.randrange(1, 120))
        at = rng.randrange(len(t))
        out.append(t[:at] + (passage if i % 2 else edge[: rng.randrange(180, 240)]) + t[at:])
    for _ in range(25):
        t = list(out[rng.randrange(40)])
        t[rng.randrange(len(t))] = "X"
        out.append("".join(t))
    out += [out[3]] * 5 + [None, "", "a" * 199, "b" * 200, "c" * 201, "ab" * 300, "a" * 5000, ("q" + text(60)) * 2, "x\x00y" * 100, "日本" * 90]
    return out


def run(spark, texts):
    docs = spark.createDataFrame([(i % 90 if i < 300 else None, t, i) for i, t in enumerate(texts)], "doc_id long, text string, h int")
    out = X.remove_repeats(docs).collect()
    return sorted((r.n_bytes, r.n_bytes - len(r.kept), len(r.removed) // 2, hashlib.sha256(r.kept).hexdigest()) for r in out)


def test_matches_brute(spark):
    texts = corpus()
    want = sorted(brute(texts))
    assert run(spark, texts) == want
    old = X.HOT, X.SALT, X.SHARD, X.PIECE
    try:
        X.HOT, X.SALT, X.SHARD, X.PIECE = 6, 5, 2000, 300  # hot anchors by window, salted shards, many sorts, texts in pieces
        assert run(spark, texts) == want
    finally:
        X.HOT, X.SALT, X.SHARD, X.PIECE = old


def test_what_only_came_whole_is_not_sorted(spark, monkeypatch):
    """Contexts go to the suffix arrays where one of their anchor came once; with nothing but copies none does."""
    texts, seen, inner = [t for t in corpus() if t and len(t) > 250], [], X.sorted_shards
    monkeypatch.setattr(X, "sorted_shards", lambda docs, reps: seen.append(reps.count()) or inner(docs, reps))
    assert run(spark, texts * 2) == sorted(brute(texts * 2))
    assert seen == [0]
    assert run(spark, texts + texts[:9]) == sorted(brute(texts + texts[:9]))
    assert seen[1] > 0


def test_query_columns(spark, tmp_path):
    spark.createDataFrame([(1, "z" * 500), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in X.query(spark, str(tmp_path)).collect()}
    assert (got[1].n_bytes, got[1].n_removed, got[1].n_spans) == (500, 500, 1) and got[2].kept_sha256 == hashlib.sha256(b"").hexdigest()
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert X.remove_repeats(empty).count() == 0


def test_workers_give_memory_back(monkeypatch):
    """All of the operator's tasks end with give_back(): a worker stays beside stages that need its executor's memory."""
    import pathlib
    import re

    import pyarrow as pa

    from folioframe.llm import common

    given, tasks = [], []

    class Frame:
        def __getattr__(self, name):
            return lambda *a, **k: self

        def mapInArrow(self, run, ddl):
            tasks.append(run)
            return self

    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    monkeypatch.setattr(X, "id_text", lambda docs: docs)
    text = "".join(random.Random(5).choices("abcdef", k=900))
    for part in (X.anchors, X.packed_texts):
        part(Frame())
        batch = pa.RecordBatch.from_arrays([pa.array([text, "b", text])], ["text"])
        assert sum(b.num_rows for b in tasks.pop()([batch])) and given.pop() and not given
    every = re.findall(r"mapInArrow\((tidy\()?", pathlib.Path(X.__file__).read_text())
    assert len(every) == 7 and all(every)


def test_give_back_lowers_resident_memory():
    import re

    from folioframe.llm.common import give_back

    def resident():
        return int(re.search(r"\nPss_Anon:\s+(\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

    held = [np.ones(8_000) for _ in range(2_000)]  # 64 KB each, from the heap and not mapped
    last = held.pop()
    held.clear()
    full = resident()
    give_back()
    assert last[0] == 1 and resident() < full - 50
