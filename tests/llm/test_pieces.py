import hashlib
import random

import pytest
import sentencepiece

from folioframe.llm import pieces


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())


TEXTS = ["", " ", "  ", "a", "  a  b ", "\n\na\tb", "▁x", "▁", "a\x00b", "é ﬁ Ａ́", "<s> </s> <unk> <0x41>", "a\r\n b \n c", " \n \n", "aaaaaaaaa aaaaaaaa", "x" * 3000, "    def f(x):\n        return   x\n", "日本語 текст 😀😀 ‍", "�﻿"]


def test_same_as_library(lib):
    c = pieces.PieceCodec(pieces.load_model(pieces.model_path()))
    rng = random.Random(2)
    alphabet = "aeinorstth  \n\t.,AÉéß▁1234567890-_()日𝛼"
    for t in TEXTS + ["".join(rng.choices(alphabet, k=rng.randrange(1, 80))) for _ in range(3000)]:
        ids = lib.encode(t)
        assert c.encode(t) == ids, t
        assert c.decode(ids) == lib.decode(ids), t


def test_decode_of_any_ids(lib):
    c = pieces.PieceCodec(pieces.load_model(pieces.model_path()))
    rng = random.Random(4)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(259, 32000)]) for _ in range(rng.randrange(0, 12))]
        assert c.decode(ids) == lib.decode(ids), ids


def test_query_rows(spark, lib):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(99, None), (1, " "), (None, "x y")]
    got = pieces.encode_documents(spark.createDataFrame([(d, t, 7) for d, t in rows], "doc_id long, text string, ids int")).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = r.ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert (r.doc_id, ids, r.decoded_sha256) in [(d, lib.encode(t or ""), hashlib.sha256(lib.decode(lib.encode(t or "")).encode()).hexdigest()) for d, t in rows]
    assert pieces.encode_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_seam_test_is_plain_merging():
    c = pieces.PieceCodec(pieces.load_model(pieces.model_path()))
    rng = random.Random(9)

    def merged(s):
        parts = list(s)
        while True:
            best = min(((c.rank[parts[i] + parts[i + 1]][0], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in c.rank), default=None)
            if best is None:
                return parts
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    for _ in range(4000):
        a, b = rng.randrange(259, 9000), rng.randrange(259, 9000)
        if c.alone(a) and c.alone(b):
            assert c.beside(a, b) == (merged(c.pieces[a] + c.pieces[b]) == [c.pieces[a], c.pieces[b]])
