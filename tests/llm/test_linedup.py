import difflib
import random

from folioframe.llm import linedup as L


def test_patience():
    assert L.patience(list("abcde"), list("axcdye")) == [(0, 0), (2, 2), (3, 3), (4, 5)]
    assert L.patience([], list("a")) == [] and L.patience(list("xx"), list("xxx")) == [(0, 0), (1, 1)]
    rng = random.Random(1)
    for _ in range(500):
        a = [rng.randrange(30) for _ in range(rng.randrange(20))]
        b = [x for x in a if rng.random() < 0.7] + [rng.randrange(30) for _ in range(4)]
        m = L.patience(a, b)
        assert all(a[i] == b[j] for i, j in m)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(m, m[1:]))
    a = rng.sample(range(1000), 60)
    b = a[:20] + [2000] + a[25:]
    lcs = sum(x.size for x in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks())
    assert len(L.patience(a, b)) == lcs


def brute(rows, least, rare):
    """The definition, with plain loops."""
    docs = sorted({(d, t or "") for d, t in rows if d is not None}, key=lambda x: (x[0], L_th(x[1])))
    seq = [L.line_hashes(t) for _, t in docs]
    holders = {}
    for i, (h, w) in enumerate(seq):
        for x in {x for x, n in zip(h, w) if n}:
            holders.setdefault(x, []).append(i)
    todo = set()
    for own in holders.values():
        todo |= {(own[0], i) for i in own[1:]}
        if len(own) <= rare:
            todo |= set(zip(own, own[1:]))
    gone = {}
    for a, b in todo:
        gone.setdefault(docs[b], set()).update(L.repeated_lines(*seq[a], *seq[b], least))
    return [(d, t if d is None or t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone.get((d, t), ()))) for d, t in rows]


def L_th(t):
    import xxhash

    x = xxhash.xxh64_intdigest(t.encode(), 42)
    return x - 2**64 if x >= 2**63 else x


def rows():
    rng = random.Random(3)
    vocab = [f"v{i}" for i in range(3000)]
    line = lambda n: " ".join(rng.choices(vocab, k=n))
    hot, passage = line(25), [line(12), line(9), line(11)]
    out = []
    for i in range(120):
        lines = [line(rng.choice([2, 8, 30])) for _ in range(rng.randrange(1, 9))]
        if i % 3 == 0:
            lines.insert(rng.randrange(len(lines) + 1), hot)
        if i % 7 == 0:
            at = rng.randrange(len(lines) + 1)
            lines[at:at] = passage
        out.append((i, "\n".join(lines)))
    for i in range(40):
        src = out[rng.randrange(20)][1].split("\n")
        if i % 2:
            src[rng.randrange(len(src))] = "  " + line(5)
        out.append((500 + i, "\n".join(src)))
    return out + [(700, None), (701, ""), (702, "\n \n"), (703, out[4][1]), (703, out[4][1]), (703, out[5][1]), (None, out[4][1]), (704, "\n\n" + out[6][1] + "\n"), (705, "short")]


def test_dedup_matches_brute(spark):
    data = rows()
    docs = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(data)], "doc_id long, text string, _gone int")
    for rare in (16, 3):
        got = L.without_repeats(docs, 20, rare).select("_row._gone", "text").collect()
        want = {i: t for i, (_, t) in enumerate(brute(data, 20, rare))}
        assert {r[0]: r[1] for r in got} == want
    kept = L.dedup_lines(docs)
    assert kept.columns == docs.columns
    left = {r["_gone"] for r in kept.collect()}
    assert {i for i, t in want.items() if t is None or t.strip() or t == data[i][1]} == left
    assert L.dedup_lines(docs.limit(0)).count() == 0


def test_order_of_text_hash(spark):
    assert spark.range(1).selectExpr("xxhash64('añ b')").first()[0] == L_th("añ b")


def test_block_whose_lines_were_all_seen_elsewhere(spark):
    """Each line was first in another document, and many hold it; the block was first in document 50."""
    line = lambda k, n=10: " ".join(f"{k}x{i}" for i in range(n))
    l1, l2, l3 = line("p"), line("q"), line("r")
    data = [(i, line(f"own{i}") + "\n" + (l1, l2, l3)[i % 3]) for i in range(48)]
    data += [(50 + i, "\n".join([line(f"head{i}"), l1, l2, "", l3, line(f"tail{i}")])) for i in range(3)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = {r[0]: r[1] for r in L.without_repeats(docs).select("_row.doc_id", "text").collect()}
    left = {d: t if d < 51 else "\n".join([line(f"head{d - 50}"), "", line(f"tail{d - 50}")]) for d, t in data}
    assert got == left


def test_runs_cover_blocks():
    rng = random.Random(5)
    for _ in range(300):
        words = [rng.choice([0, 1, 3, 9, 15, 25]) for _ in range(rng.randrange(12))]
        own = [n for n in words if n]
        found = L.runs(list(range(len(words))), words)
        assert all(sum(own[i:k]) >= L.MIN_WORDS for i, k in found)
        for i in range(len(own)):
            for k in range(i + 1, len(own) + 1):
                if sum(own[i:k]) >= L.MIN_WORDS:
                    assert set(range(i, k)) == {x for a, b in found if i <= a and b <= k for x in range(a, b)}


def test_passage_twice_in_one_document():
    line = lambda k, n=18: " ".join(f"{k}x{i}" for i in range(n))
    x1, x2, z1, z2, z3, p1, p2, p3 = map(line, "x1 x2 z1 z2 z3 p1 p2 p3".split())
    once, twice = [x1, p1, p2, p3, x2], [z1, p1, p2, "", p3, z2, p1, p2, p3, z3]
    gone = lambda a, b: L.repeated_lines(*L.line_hashes("\n".join(a)), *L.line_hashes("\n".join(b)))
    assert gone(once, twice) == [1, 2, 4, 6, 7, 8]
    assert gone(twice, once) == [1, 2, 3]
    assert gone([p1, p2, x1, z1, z2], [z1, z2, x2, p1, p2]) == [0, 1, 3, 4]
    assert gone([x1, p1, x2], [z1, p1, z2, p1]) == []  # 18 words


def test_every_block_of_any_earlier_document_goes(spark):
    rng = random.Random(11)
    pool = [" ".join(f"{i}w{j}" for j in range(rng.choice([3, 8, 12, 22]))) for i in range(14)] + [""]
    data = [(i, "\n".join(rng.choices(pool, k=rng.randrange(1, 14)))) for i in range(90)]
    seq = [[(x, n) for n, x in enumerate(t.split("\n")) if x] for _, t in data]

    def blocks(own):
        for i in range(len(own)):
            for k in range(i + 1, len(own) + 1):
                if sum(len(x.split()) for x, _ in own[i:k]) >= L.MIN_WORDS:
                    yield tuple(x for x, _ in own[i:k]), {n for _, n in own[i:k]}

    seen, want, aligned = set(), {}, {}
    for d, own in enumerate(seq):
        want[d] = set().union(*(at for lines, at in blocks(own) if lines in seen))
        aligned[d] = set().union(*(L.repeated_lines(*L.line_hashes(data[e][1]), *L.line_hashes(data[d][1])) for e in range(d)))
        seen |= {lines for lines, _ in blocks(own)}
    got = {r[0]: set(r[2]) for r in L.removals(L.sequences(spark.createDataFrame(data, "doc_id long, text string"))).collect()}
    assert got == {d: x for d, x in want.items() if x} == {d: x for d, x in aligned.items() if x}
