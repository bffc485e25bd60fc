import hashlib
import random
import zlib

import pytest

from folioframe.llm import flac

TEXTS = ["", "a", "hello world " * 500, "aaaa" * 1000, "é日😀" * 333, "\x00" * 2000 + "z" * 30, "0123456789" * 4000]


def noise():
    rng = random.Random(1)
    return [bytes(rng.randrange(256) for _ in range(192 * k)) for k in (1, 2, 3, 5, 6, 7, 13)] + [bytes([65] * 191 + [255]) * 9]


def slow_decode(stream):
    """Plain bit-by-bit reading of one stream, apart from the vector code."""
    info = flac.layout(stream)
    bits = "".join(f"{b:08b}" for b in stream)
    at, out = info["frames_at"] * 8, []

    def take(n):
        nonlocal at
        at += n
        return int(bits[at - n : at], 2) if n else 0

    def signed(n):
        v = take(n)
        return v - (1 << n) if v >> n - 1 else v

    while at < len(bits):
        assert take(16) == 0xFFF8
        code = take(4)
        assert take(4) == 4 and take(8) == 2
        lead = take(8)
        while lead >= 0xC0:
            take(8)
            lead = lead << 1 & 0xFF
            if lead < 0x80:
                break
            if lead & 0xC0 == 0x80:
                break
        n = take(16) + 1 if code == 7 else {1: 192, 2: 576, 3: 1152}[code]
        take(8)
        kind = take(8) >> 1
        if kind == 0:
            s = [signed(8)] * n
        elif kind == 1:
            s = [signed(8) for _ in range(n)]
        else:
            p = kind - 31 if kind >= 32 else kind - 8
            s = [signed(8) for _ in range(p)]
            coef, shift = list(flac.FIXED[p]) if kind < 32 else [], 0
            if kind >= 32:
                w, shift = take(4) + 1, signed(5)
                coef = [signed(w) for _ in range(p)]
            assert take(2) == 0
            po = take(4)
            for part in range(1 << po):
                k = take(4)
                for _ in range((n >> po) - (p if part == 0 else 0)):
                    q = 0
                    while not take(1):
                        q += 1
                    u = q << k | take(k)
                    r = u >> 1 ^ -(u & 1)
                    s.append(r + (sum(c * s[-1 - j] for j, c in enumerate(coef)) >> shift))
        out += s
        at += -at % 8 + 16
    return bytes(x + 128 for x in out)


def test_round_trip_and_slow_reader():
    payloads = [flac.padded(t)[0] for t in TEXTS[:5]] + noise()
    streams = flac.encode(payloads)
    assert flac.decode(streams) == payloads
    for s, p in zip(streams, payloads):
        if len(p) < 8000:
            assert slow_decode(s) == p


def test_seek_and_damage():
    p = flac.padded(TEXTS[6])[0]
    (s,) = flac.encode([p])
    for a, n in ((0, 5), (1151, 2), (5000, 9000), (len(p) - 1, 9), (len(p), 5)):
        assert flac.decode_range(s, a, n) == p[a : a + n]
    for at in (flac.layout(s)["frames_at"] + 2, flac.layout(s)["frames_at"] + 400, len(s) - 1, 30):
        bad = bytearray(s)
        bad[at] ^= 4
        with pytest.raises(flac.BadStream):
            flac.decode([bytes(bad)])


def test_query_rows(spark):
    rows = list(enumerate(TEXTS)) + [(50, None), (1, "a"), (None, "q" * 1000)]
    df = spark.createDataFrame([(d, t, b"x") for d, t in rows], "doc_id long, text string, flac binary")
    got = flac.features(df).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        t = dict(rows)[r.doc_id] or ""
        p, n = flac.padded(t)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]))
        assert by.setdefault(t, (r.media_sha256, r.feature)) == (r.media_sha256, r.feature)
    blocks = flac.pcm_blocks(flac.media(df.where("doc_id = 6"))).orderBy("sample_offset").collect()
    assert b"".join(b.pcm for b in blocks) == flac.padded(TEXTS[6])[0] and blocks[3].sample_offset == 3 * 1152
    assert flac.features(df.limit(0)).count() == 0
