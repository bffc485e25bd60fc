import gzip
import random
import zlib

import pytest

from folioframe.llm import warc as W


def test_normaliser():
    rng = random.Random(1)
    raw = [W.record(i, f"http://x/{i}\n", bytes(rng.choices(b"ab\r\n WARC/1.1", k=rng.choice([0, 5, 3000, 200000]))), "response") for i in range(40)] + [W.record(99, None, b"abc", "revisit", 3)]
    whole = b"".join(raw)
    for packed in (gzip.compress(whole), gzip.compress(whole[:777]) + gzip.compress(whole[777:]), b"".join(map(gzip.compress, raw))):
        data, index = W.normalise_bytes(packed)
        assert [zlib.decompress(data[x["offset"] :][: x["length"]], 31) for x in index] == raw
        assert sum(x["length"] for x in index) == len(data)
        head, block = W.read_member(data, index[-1]["offset"], index[-1]["length"])
        assert head["warc-refers-to"] == "<urn:page:3:0>" and b"Content-Length: 3" in block
    for bad in (gzip.compress(whole)[:-400], gzip.compress(whole[:-9]), gzip.compress(b"x" + whole)):
        with pytest.raises(W.BadArchive):
            W.normalise_bytes(bad)
    assert W.normalise_bytes(b"") == (b"", [])


def test_query_rows(spark):
    rows = [(1, "u1", "a"), (2, "u2", "a"), (3, None, "b"), (4, "u", None), (5, "u", ""), (5, "u", ""), (6, "é", "Ünïcode" * 9000), (None, "n", "a"), (None, "n", "lone"), (None, "n", "lone")]
    pages = spark.createDataFrame([(*r, 1, "h") for r in rows], "page_id long, url string, html string, kind int, h string")
    for least in (0, 2):
        tops = {}
        for d, _, t in rows:
            if d is not None:
                tops[t or ""] = max(tops.get(t or "", d), d)
        want = []
        for d, _, t in rows:
            b = (t or "").encode()
            top = tops.get(t or "")
            again = len(b) >= least and top is not None and d != top
            want.append((d, len(b), W.digest32(b), "revisit" if again else "response", top if again else None))
        typed = W.with_types(pages, least)
        got = W.read_records(W.normalise(W.write_archives(typed, 40))).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert W.read_records(W.normalise(W.write_archives(W.with_types(pages.limit(0))))).count() == 0
