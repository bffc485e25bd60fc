import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from folioframe.llm import pii as P


def brute_base(text):
    """The contract's patterns read literally."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((*m.span(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((*m.span(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        s = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and s % 10 == 0:
            out.append((*m.span(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((*m.span(), "phone"))
    return sorted(out)


def test_base_patterns():
    rng = random.Random(6)
    texts = ["", "a@b.c", "@a.b", "x@@y.z x@y", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.002.3.255", "4111 1111 1111 1111-4111111111111111", "+1 (017) 555-7713.", "é@b.c %a@b-.c-", "+12345678901234567890", "1" * 9000]
    texts += ["".join(rng.choices("a1.@ +-()9é", [2, 3, 3, 2, 1, 1, 1, 1, 1, 3, 1], k=rng.randrange(5, 60))) for _ in range(4000)]
    for t in texts:
        if t != "1" * 9000:
            assert sorted(P.base_spans(t)) == brute_base(t), t
    assert P.base_spans("1" * 9000) == []


@pytest.fixture(scope="module")
def field():
    return P.Field(P.train(P.labelled_table()))


def test_viterbi_is_the_best_path(field):
    rng = np.random.default_rng(2)
    lens = np.array([1, 4, 3, 5, 2])
    ids = rng.integers(0, len(field.emit[0]), lens.sum())
    got, at = field.viterbi(ids, lens), 0
    for n in lens:
        s = [0, *ids[at : at + n], 0]
        e = [field.emit[0][s[t]] + field.emit[1][s[t + 1]] + field.emit[2][s[t + 2]] for t in range(n)]
        value = lambda y: field.first[y[0]] + sum(e[t][y[t]] for t in range(n)) + sum(field.move[a, b] for a, b in zip(y, y[1:]))  # noqa: E731, B023
        best = max(itertools.product(range(5), repeat=int(n)), key=value)
        assert value(got[at : at + n]) == pytest.approx(value(best), abs=1e-4)
        at += n


def test_held_out_accuracy(field):
    rows = P.labelled_table(99, 4, given="Zelda Yannick Xavier Wanda Ursula".split(), family="Quist Voss Tamm Rask".split())
    right = total = 0
    for words, labels in rows:
        ids = np.array(field.classes([w.encode() for w in words]))
        right += (field.viterbi(ids, np.array([len(ids)])) == labels).sum()
        total += len(labels)
    assert right / total > 0.98


def test_query_rows(spark):
    texts = ["ask Dr. Wanda Voss at a.b@c.de now\n+1 (017) 555-7713, 10.0.0.1", "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" thhan", "", None, "word " * 50000, "And. Is that. Of er."]
    rows = list(enumerate(texts)) + [(0, texts[0]), (None, "x@y.z")]
    got = P.find(spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, spans int")).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[0].n_email == by[0].n_ip == by[0].n_phone == 1 and by[0].n_card == 0
    base = P.joined(P.base_spans(texts[0]))
    assert by[0].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert set(base.split(",")) < set(by[0].spans.split(",")) and "name:8:18" in by[0].spans
    assert "secret:9:49" in by[1].spans and by[2].spans == by[3].spans == by[4].spans == by[5].spans == ""
    assert P.find(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_line_is_one_sequence(field):
    rng = np.random.default_rng(4)
    lens = np.array([3, 1500, 256, 257, 700])
    ids = rng.integers(0, len(field.emit[0]), lens.sum())
    got, at = field.viterbi(ids, lens), 0
    for n in lens:
        s = [0, *ids[at : at + n], 0]
        e = [(field.emit[0][s[t]] + field.emit[1][s[t + 1]] + field.emit[2][s[t + 2]]).astype(float) for t in range(n)]
        v = [field.first + e[0]]
        for t in range(1, n):
            v.append((v[-1][:, None] + field.move).max(0) + e[t])
        y = got[at : at + n]
        value = field.first[y[0]] + sum(e[t][y[t]] for t in range(n)) + sum(float(field.move[a, b]) for a, b in zip(y, y[1:]))
        assert value == pytest.approx(v[-1].max(), abs=1e-3)
        at += n


def test_span_does_not_depend_on_its_place(field):
    for n in (10, 250, 251, 252, 253, 254, 255, 256, 510, 511, 20_000):
        text = "word " * n + "asked Dr. Wanda Voss Tamm about"
        at = 5 * n + len("asked Dr. ")
        assert field.spans([text]) == [[(at, at + len("Wanda Voss Tamm"), "name")]], n


def test_shape_of_the_whole_word():
    assert P.shape("x" * 400) == P.shape("x" * 500) == "LONG"
    assert P.shape("x" * 400 + "-9") == "x-9" and P.shape("x" * 400 + "9Xx9Xx") == "MIX"
