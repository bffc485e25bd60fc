"""FLAC media columns: 8-bit mono payloads stored losslessly and read back, many frames at a time.

A payload is a byte string; byte b is the sample b - 128. Streams have STREAMINFO with the MD5 of the
samples, a SEEKTABLE with a point for each frame, and frames of BLOCK samples (the last may be shorter) with
constant, verbatim, fixed or LPC subframes and partitioned Rice residuals. Reading checks the CRC-8 of
frame headers, the CRC-16 of frames and the MD5. All steps go over the frames of a batch side by side
in numpy: the sample index is the outer loop, the frames are the vector.

Nulls and empty texts become one block of PAD spaces; equal texts give equal bytes. Rows repeat as they came; further
columns are ignored. An empty table gives an empty result. A very long text is many frames, decoded in groups of
bounded size, so memory follows the longest single text and not the batch.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from folioframe.llm.common import per_text, table

BLOCK, PAD, RATE, ORDER, PRECISION = 1152, 192, 8000, 4, 10
#: Payload bytes that are worked on at a time.
GROUP = 2 << 20


def _crc_tables():
    t8, t16 = np.arange(256, dtype=np.uint16), np.arange(65536, dtype=np.uint32)
    for _ in range(8):
        t8 = np.where(t8 & 0x80, (t8 << 1) ^ 0x07, t8 << 1) & 0xFF
    for _ in range(16):
        t16 = np.where(t16 & 0x8000, (t16 << 1) ^ 0x8005, t16 << 1) & 0xFFFF
    return t8.astype(np.uint8), t16.astype(np.uint16)


CRC8, CRC16 = _crc_tables()


def crc8(head: bytes) -> int:
    c = 0
    for b in head:
        c = int(CRC8[c ^ b])
    return c


def crc16_spans(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-16 of each span of buf, two bytes a step; leading zero bytes leave it at zero, so spans are aligned at their ends."""
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    steps = (size + 1) // 2
    crc = np.zeros(len(size), np.uint16)
    most = int(steps[0]) if len(steps) else 0
    wide = np.concatenate([np.zeros(1, np.uint8), buf, np.zeros(2, np.uint8)])
    end = start + size
    active = np.searchsorted(-steps, -np.arange(most, 0, -1), side="right")
    for left, m in zip(range(most, 0, -1), active.tolist()):
        at = end[:m] - 2 * left
        hi, lo = wide[at + 1].astype(np.uint16), wide[at + 2]
        if left > 1:
            odd = at < start[:m]
            if odd.any():
                hi[odd] = 0
        else:
            hi[at < start[:m]] = 0
        crc[:m] = CRC16[crc[:m] ^ (hi << 8 | lo)]
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _utf8_number(n: int) -> bytes:
    """The coded frame number: UTF-8's scheme, up to 36 bits."""
    if n < 0x80:
        return bytes([n])
    tail = []
    width = 6
    while True:
        tail.append(0x80 | n & 0x3F)
        n >>= 6
        width -= 1
        if n < 1 << width:
            break
    return bytes([0xFF << width + 1 & 0xFF | n, *reversed(tail)])


def _frame_head(number: int, n: int) -> bytes:
    code, more = {192: (1, b""), 576: (2, b""), 1152: (3, b"")}.get(n, (7, (n - 1).to_bytes(2, "big")))
    head = bytes([0xFF, 0xF8, code << 4 | 4, 0x02]) + _utf8_number(number) + more
    return head + bytes([crc8(head)])


def _predictors(x: np.ndarray, n: np.ndarray):
    """x: frames x BLOCK int32, zeros after n. Quantised LPC coefficients (frames x ORDER) and shifts by Levinson's recursion."""
    f = x.astype(np.float32)
    auto = np.stack([(f[:, k:] * f[:, : f.shape[1] - k]).sum(1, dtype=np.float64) for k in range(ORDER + 1)], 1)
    err = auto[:, 0] * 1.0001 + 1e-9
    a = np.zeros((len(x), ORDER))
    for i in range(ORDER):
        k = (auto[:, i + 1] - (a[:, :i] * auto[:, i:0:-1]).sum(1)) / err
        new = a.copy()
        new[:, i] = k
        new[:, :i] = a[:, :i] - k[:, None] * a[:, :i][:, ::-1]
        a = new
        err = np.maximum(err * (1 - k * k), 1e-9)
    top = np.maximum(np.abs(a).max(1), 1e-6)
    shift = np.clip(PRECISION - 1 - np.ceil(np.log2(top)).astype(np.int64) - 1, 0, 15)
    q = np.clip(np.rint(a * (1 << shift)[:, None]), -(1 << PRECISION - 1), (1 << PRECISION - 1) - 1).astype(np.int32)
    return q, shift


def _residual(x: np.ndarray, coef: np.ndarray, shift: np.ndarray) -> np.ndarray:
    p = coef.shape[1]
    guess = np.zeros((x.shape[0], x.shape[1] - p), np.int32)
    for j in range(p):
        guess += coef[:, j, None] * x[:, p - 1 - j : x.shape[1] - 1 - j]
    out = np.zeros_like(x)
    out[:, p:] = x[:, p:] - (guess >> shift[:, None].astype(np.int32))
    return out


#: Fixed predictors as linear ones without shift.
FIXED = ([], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1])


def _encode_frames(x: np.ndarray, n: np.ndarray, numbers: list[int]) -> list[bytes]:
    frames = len(n)
    col = np.arange(BLOCK)
    live = col[None, :] < n[:, None]
    q, shift = _predictors(x, n)
    kinds = []  # (order, residuals)
    for order in (0, 1):
        c = np.tile(np.array(FIXED[order], np.int32), (frames, 1))
        kinds.append((order, _residual(x, c, np.zeros(frames, np.int32)) if order else x.copy()))
    kinds.append((ORDER, _residual(x, q, shift)))
    cost = np.stack([(np.abs(r) * (live & (col >= o))).sum(1) for o, r in kinds], 1)
    cost[:, 2] = cost[:, 2] + cost[:, 2] // 50 + 8  # coefficients take room
    pick = cost.argmin(1)
    order = np.array([o for o, _ in kinds])[pick]
    r = np.choose(pick[:, None], [k[1] for k in kinds])
    u = ((r << 1) ^ (r >> 31)).astype(np.int64)
    coded = live & (col[None, :] >= order[:, None])
    u[~coded] = 0
    # one, two or four partitions of 192 samples or more
    parts = np.where(n % 768 == 0, 2, np.where(n % 384 == 0, 1, 0))
    width = n >> parts
    part = np.minimum(col[None, :] // width[:, None], (1 << parts)[:, None] - 1)
    cell = part + 4 * np.arange(frames)[:, None]
    flat = cell[coded]
    total = np.bincount(flat, weights=u[coded], minlength=4 * frames)
    count = np.bincount(flat, minlength=4 * frames)
    mean = total / np.maximum(count, 1)
    k0 = np.clip(np.floor(np.log2(np.maximum(mean * 0.7, 1e-3))).astype(np.int64), 0, 12)
    peak = u.max(1).repeat(4)
    k0 = np.maximum(k0, np.ceil(np.log2(np.maximum(peak / 30, 1))).astype(np.int64))  # no quotient over 30
    uc = u[coded]
    best, bits = k0.copy(), None
    for k in (k0, k0 + 1):
        need = np.bincount(flat, weights=uc >> k[flat], minlength=4 * frames) + count * (1 + k)
        if bits is None:
            bits = need
        else:
            best = np.where(need < bits, k, best)
            bits = np.minimum(bits, need)
    k = best
    warm = order * 8
    extra = np.where(pick == 2, 4 + 5 + PRECISION * ORDER, 0)
    residual_bits = bits.reshape(frames, 4).sum(1).astype(np.int64) + 6 + 4 * (1 << parts)
    sub_bits = 8 + warm + extra + residual_bits
    constant = ((x == x[:, :1]) | ~live).all(1)
    verbatim = ~constant & (sub_bits >= 8 + 8 * n)
    sub_bits = np.where(constant, 16, np.where(verbatim, 8 + 8 * n, sub_bits)).astype(np.int64)
    heads = [_frame_head(i, m) for i, m in zip(numbers, n.tolist())]
    head_size = np.array([len(h) for h in heads])
    body = (sub_bits + 7) // 8
    size = head_size + body + 2
    begin = np.concatenate([[0], np.cumsum(size)])
    bit = np.zeros(int(begin[-1]) * 8, np.uint8)
    at = (begin[:-1] + head_size) * 8

    def put(where, value, width):
        for j in range(width):
            bit[where + j] = (value >> (width - 1 - j)) & 1

    rice = ~(constant | verbatim)
    kind = np.where(constant, 0, np.where(verbatim, 1, np.where(pick == 2, 32 + ORDER - 1, 8 + order)))
    put(at, kind << 1, 8)
    plain = constant | verbatim
    for j in np.flatnonzero(plain):
        m = 1 if constant[j] else int(n[j])
        bit[at[j] + 8 : at[j] + 8 + 8 * m] = np.unpackbits((x[j, :m] & 0xFF).astype(np.uint8))
    for j in range(ORDER):
        has = rice & (order > j)
        put(at[has] + 8 + 8 * j, x[has, j] & 0xFF, 8)
    lpc = rice & (pick == 2)
    where = at[lpc] + 8 + warm[lpc]
    put(where, np.full(len(where), PRECISION - 1), 4)
    put(where + 4, shift[lpc], 5)
    for j in range(ORDER):
        put(where + 9 + PRECISION * j, q[lpc, j] & ((1 << PRECISION) - 1), PRECISION)
    where = at + 8 + warm + extra
    put(where[rice], parts[rice], 6)  # coding method 0, then the partition order
    # lengths of all codes, with a parameter in front of each partition
    sel = coded & rice[:, None]
    kk = k.reshape(frames, 4)
    kx = np.take_along_axis(kk, part, 1)
    length = np.where(sel, (u >> kx) + 1 + kx, 0)
    first = sel & (col[None, :] == np.maximum(part * width[:, None], order[:, None]))
    length += 4 * first
    stop = np.cumsum(length, 1) + (where + 6)[:, None]
    begin_code = (stop - length)[sel]
    us, ks, fs = u[sel], kx[sel], first[sel]
    put(begin_code[fs], ks[fs], 4)
    begin_code = begin_code + 4 * fs
    one = begin_code + (us >> ks)
    bit[one] = 1
    for j in range(int(ks.max(initial=0))):
        has = np.flatnonzero(ks > j)
        bit[one[has] + 1 + j] = (us[has] >> (ks[has] - 1 - j)) & 1
    buf = np.packbits(bit)
    for b, h in zip(begin.tolist(), heads):
        buf[b : b + len(h)] = np.frombuffer(h, np.uint8)
    crc = crc16_spans(buf, begin[:-1], size - 2)
    buf[begin[1:] - 2], buf[begin[1:] - 1] = crc >> 8, crc & 0xFF
    raw = buf.tobytes()
    return [raw[a:b] for a, b in zip(begin.tolist(), begin[1:].tolist())]


def _groups(sizes: list[int], most: int):
    """Runs of items whose sizes add up to about most."""
    at, total = 0, 0
    for i, s in enumerate(sizes):
        total += s
        if total >= most:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(sizes):
        yield at, len(sizes)


def encode(payloads: list[bytes]) -> list[bytes]:
    """FLAC streams of payloads, each a positive multiple of PAD bytes long."""
    spans = [(i, j, k, min(BLOCK, len(p) - j)) for i, p in enumerate(payloads) for k, j in enumerate(range(0, len(p), BLOCK))]
    frames: list[list[bytes]] = [[] for _ in payloads]
    for a, b in _groups([BLOCK] * len(spans), GROUP):
        part = spans[a:b]
        x = np.zeros((len(part), BLOCK), np.int32)
        for row, (i, j, _, m) in enumerate(part):
            x[row, :m] = np.frombuffer(payloads[i], np.uint8, m, j)
        n = np.array([m for *_, m in part])
        x[np.arange(BLOCK)[None, :] < n[:, None]] -= 128
        for (i, *_), f in zip(part, _encode_frames(x, n, [k for _, _, k, _ in part])):
            frames[i].append(f)
    return [_stream(p, f) for p, f in zip(payloads, frames)]


def _stream(payload: bytes, frames: list[bytes]) -> bytes:
    sizes = [len(f) for f in frames]
    block = min(BLOCK, len(payload))
    md5 = hashlib.md5((np.frombuffer(payload, np.uint8) ^ 0x80).tobytes()).digest()
    info = block.to_bytes(2, "big") * 2 + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big") + (RATE << 44 | 0 << 41 | 7 << 36 | len(payload)).to_bytes(8, "big") + md5
    points, at = [], 0
    for j, s in enumerate(sizes):
        points.append((j * BLOCK).to_bytes(8, "big") + at.to_bytes(8, "big") + min(BLOCK, len(payload) - j * BLOCK).to_bytes(2, "big"))
        at += s
    seek = b"".join(points)
    return b"".join([b"fLaC", b"\x00", len(info).to_bytes(3, "big"), info, b"\x83", len(seek).to_bytes(3, "big"), seek, *frames])


class BadStream(ValueError):
    pass


def layout(stream: bytes) -> dict:
    """Metadata of a stream: number of samples, MD5, where frames begin, and the seek points (sample, offset, samples)."""
    if stream[:4] != b"fLaC":
        raise BadStream("no fLaC mark")
    at, last, out = 4, False, {"points": []}
    while not last:
        last, kind, size = bool(stream[at] & 0x80), stream[at] & 0x7F, int.from_bytes(stream[at + 1 : at + 4], "big")
        body = stream[at + 4 : at + 4 + size]
        if kind == 0:
            packed = int.from_bytes(body[10:18], "big")
            out |= {"samples": packed & (1 << 36) - 1, "md5": body[18:34]}
            if packed >> 36 & 31 != 7 or packed >> 41 & 7:
                raise BadStream("not 8-bit mono")
        elif kind == 3:
            out["points"] = [(int.from_bytes(body[i : i + 8], "big"), int.from_bytes(body[i + 8 : i + 16], "big"), int.from_bytes(body[i + 16 : i + 18], "big")) for i in range(0, size, 18)]
        at += 4 + size
    return out | {"frames_at": at}


def _signed(v: np.ndarray, bits: int) -> np.ndarray:
    return (v.astype(np.int64) ^ (1 << bits - 1)) - (1 << bits - 1)


def _decode_frames(buf: np.ndarray, begin: np.ndarray, size: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Samples (BLOCK-wide rows, int32) of frames that lie at begin..begin+size in buf and hold n samples each."""
    if (crc16_spans(buf, begin, size) != 0).any():  # a frame with its own CRC behind it comes to zero
        raise BadStream("CRC-16")
    order = np.argsort(-n, kind="stable")
    begin, n = begin[order], n[order]
    count, most = len(n), int(n.max(initial=0))
    wide = np.concatenate([buf, np.zeros(16, np.uint8)]).astype(np.uint64)
    word = np.zeros(len(buf) + 8, np.uint64)
    for j in range(8):
        word |= wide[j : j + len(word)] << np.uint64(56 - 8 * j)
    pos = np.zeros(count, np.int64)
    for i, b in enumerate(begin.tolist()):  # headers are a few bytes each
        h = buf[b : b + 16].tobytes()
        lead = h[4]
        more = 0 if lead < 0x80 else 7 - (~lead & 0xFF).bit_length()
        used = 5 + more
        code = h[2] >> 4
        used += {6: 1, 7: 2}.get(code, 0)
        if h[:2] != b"\xff\xf8" or crc8(h[:used]) != h[used]:
            raise BadStream("frame header")
        pos[i] = (b + used + 1) * 8

    def take(at, bits):
        """bits: 1 to 32, equal for all."""
        return (word[at >> 3] << (at & 7).astype(np.uint64)) >> np.uint64(64 - bits)

    kind = (take(pos, 8) >> np.uint64(1)).astype(np.int64)
    pos += 8
    lpc, fixed = kind >= 32, (kind >= 8) & (kind <= 12)
    p = np.where(lpc, kind - 31, np.where(fixed, kind - 8, 0))
    deep = int(p.max(initial=0))
    s = np.zeros((most + deep, count), np.int32)  # deep rows of zeros in front
    for j in range(deep):
        has = np.flatnonzero(p > j)
        s[deep + j, has] = _signed(take(pos[has], 8), 8)
        pos[has] += 8
    coef, shift = np.zeros((deep, count), np.int32), np.zeros(count, np.int32)  # row d: of the sample d + 1 back, reversed below
    for o in range(1, 5):
        has = np.flatnonzero(fixed & (p == o))
        for j, c in enumerate(FIXED[o] if len(has) else ()):
            coef[j, has] = c
    for i in np.unique(p[lpc]).tolist():
        has = np.flatnonzero(lpc & (p == i))
        precision = take(pos[has], 4).astype(np.int64) + 1
        shift[has] = _signed(take(pos[has] + 4, 5), 5)
        pos[has] += 9
        for w in np.unique(precision).tolist():
            own = has[precision == w]
            for j in range(i):
                coef[j, own] = _signed(take(pos[own], w), w)
                pos[own] += w
    coef = coef[::-1].copy()
    plain = np.flatnonzero(~(lpc | fixed))
    for i in plain.tolist():
        a = int(pos[i]) // 8
        if kind[i] == 0:
            s[deep : deep + n[i], i] = np.int32(np.int8(buf[a].astype(np.int8)))
        elif kind[i] == 1:
            s[deep : deep + n[i], i] = buf[a : a + n[i]].view(np.int8)
        else:
            raise BadStream("subframe kind")
    coded = lpc | fixed
    method = take(pos, 2)
    if (method[coded] != 0).any():
        raise BadStream("coding method")
    parts = take(pos + 2, 4).astype(np.int64)
    pos = pos + 6
    width = np.where(coded, n >> parts, 1 << 40)
    edge = np.where(coded, p, 1 << 40)  # the sample at which the next partition's parameter stands
    edge_next = width.copy()
    k = np.zeros(count, np.uint64)
    live = np.searchsorted(-n, -np.arange(1, most + 1), side="right")
    eleven, top = np.uint64(11), np.uint64(63)
    next_edge = int(edge.min(initial=1 << 40))
    for i, m in zip(range(most), live.tolist()):
        if i == next_edge:
            at = np.flatnonzero(edge == i)
            k[at] = take(pos[at], 4)
            pos[at] += 4
            edge[at] = edge_next[at]
            edge_next[at] += width[at]
            edge[at[edge[at] >= n[at]]] = 1 << 40
            next_edge = int(edge.min())
        now = pos[:m]
        w = word[now >> 3] << (now & 7).astype(np.uint64)
        high = w >> eleven
        zeros = 53 - np.frexp(high.astype(np.float64))[1].astype(np.int64)
        kk = k[:m]
        far = (w >> np.uint64(19)) == 0  # a quotient too long for one word
        zero64 = zeros.astype(np.uint64)
        rest = (w << zero64) << np.uint64(1)
        u = zero64 << kk | (rest >> np.uint64(1)) >> (top - kk)
        step = zeros + 1 + kk.astype(np.int64)
        on = coded[:m] & (p[:m] <= i)
        if far.any():
            for j in np.flatnonzero(far & on).tolist():
                b, run = int(now[j]), 0
                while not buf[b >> 3] >> (7 - (b & 7)) & 1:
                    b, run = b + 1, run + 1
                low = int(take(np.array([b + 1]), int(kk[j]))[0]) if kk[j] else 0
                u[j], step[j] = run << int(kk[j]) | low, run + 1 + int(kk[j])
        r = (u >> np.uint64(1)).astype(np.int32) ^ -(u & np.uint64(1)).astype(np.int32)
        if deep:
            r += (s[i : i + deep, :m] * coef[:, :m]).sum(0, dtype=np.int32) >> shift[:m]
        if on.all():
            s[deep + i, :m] = r
            pos[:m] += step
        else:
            s[deep + i, :m][on] = r[on]
            pos[:m][on] += step[on]
    out = np.zeros((count, most), np.int32)
    out[order] = s[deep:].T
    return out


def _frame_spans(stream: bytes, info: dict) -> list[tuple[int, int, int]]:
    at, points = info["frames_at"], info["points"]
    if not points:
        raise BadStream("no seek table")
    ends = [p[1] for p in points[1:]] + [len(stream) - at]
    return [(at + p[1], e - p[1], p[2]) for p, e in zip(points, ends)]


def decode(streams: list[bytes]) -> list[bytes]:
    """Payloads of FLAC streams that have a seek point for each frame, with all checksums verified."""
    infos = [layout(s) for s in streams]
    spans = [(i, *x) for i, (s, f) in enumerate(zip(streams, infos)) for x in _frame_spans(s, f)]
    parts: list[list[bytes]] = [[] for _ in streams]
    for a, b in _groups([x[3] for x in spans], GROUP):
        own = spans[a:b]
        buf = np.frombuffer(b"".join(streams[i][x : x + z] for i, x, z, _ in own), np.uint8)
        size = np.array([z for _, _, z, _ in own])
        n = np.array([m for *_, m in own])
        s = (_decode_frames(buf, np.cumsum(size) - size, size, n) + 128).astype(np.uint8)
        for row, (i, _, _, m) in enumerate(own):
            parts[i].append(s[row, :m].tobytes())
    out = [b"".join(x) for x in parts]
    for p, f in zip(out, infos):
        if len(p) != f["samples"] or hashlib.md5((np.frombuffer(p, np.uint8) ^ 0x80).tobytes()).digest() != f["md5"]:
            raise BadStream("MD5")
    return out


def decode_range(stream: bytes, start: int, count: int) -> bytes:
    """Samples start..start+count, decoding just the frames that hold them."""
    info = layout(stream)
    own = [(p, x) for p, x in zip(info["points"], _frame_spans(stream, info)) if p[0] < start + count and p[0] + p[2] > start]
    if not own or count <= 0:
        return b""
    buf = np.frombuffer(b"".join(stream[a : a + z] for _, (a, z, _) in own), np.uint8)
    size, n = np.array([z for _, (_, z, _) in own]), np.array([m for _, (_, _, m) in own])
    s = (_decode_frames(buf, np.cumsum(size) - size, size, n) + 128).astype(np.uint8)
    whole = b"".join(s[i, :m].tobytes() for i, m in enumerate(n.tolist()))
    return whole[start - own[0][0][0] :][:count]


def padded(text: str) -> tuple[bytes, int]:
    raw = text.encode("utf-8", "replace")
    return raw + b" " * (max(1, -(-len(raw) // PAD)) * PAD - len(raw)), len(raw)


def feature(payload: bytes) -> str:
    """Of the samples: number, least, most, sum, sum of squares and changes of sign, exactly."""
    s = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    return f"n={len(s)};min={s.min()};max={s.max()};sum={s.sum()};sq={(s * s).sum()};zc={int(((s[1:] < 0) != (s[:-1] < 0)).sum())}"


def _in_parts(texts: list[str]):
    for a, b in _groups([len(t) + PAD for t in texts], GROUP):
        yield texts[a:b]


def media(docs: DataFrame) -> DataFrame:
    """The media column: (doc_id, n_bytes, flac binary)."""

    def score(texts):
        out = {"n_bytes": [], "flac": []}
        for part in _in_parts(texts):
            raw = [padded(t) for t in part]
            out["flac"] += encode([p for p, _ in raw])
            out["n_bytes"] += [n for _, n in raw]
        return out

    return per_text(docs, score, "n_bytes long, flac binary")


def pcm_blocks(media_df: DataFrame) -> DataFrame:
    """(doc_id, sample_offset, n_samples, pcm binary) for each frame of a media column, ready to seek in."""
    import pyarrow as pa

    schema = pa.schema([("doc_id", pa.int64()), ("sample_offset", pa.int64()), ("n_samples", pa.int64()), ("pcm", pa.binary())])

    def run(batches):
        for b in batches:
            ids, streams = b.column(0).to_pylist(), b.column(1).to_pylist()
            for a, z in _groups([len(s) for s in streams], GROUP):
                rows = [(d, j, min(BLOCK, len(p) - j), p[j : j + BLOCK]) for d, p in zip(ids[a:z], decode(streams[a:z])) for j in range(0, len(p), BLOCK)]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

    return media_df.select("doc_id", "flac").mapInArrow(run, "doc_id long, sample_offset long, n_samples long, pcm binary")


def features(docs: DataFrame) -> DataFrame:
    """Stores each text as FLAC, reads the stored bytes back, and describes both; stored and read in bounded groups of one task."""

    def score(texts):
        out: dict[str, list] = {k: [] for k in ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")}
        for part in _in_parts(texts):
            raw = [padded(t) for t in part]
            stored = encode([p for p, _ in raw])
            for (_, n), m, p in zip(raw, stored, decode(stored)):
                for k, v in zip(out, (n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]), len(m), hashlib.sha256(m).hexdigest(), feature(p))):
                    out[k].append(v)
        return out

    return per_text(docs, score, "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(table(spark, sf_dir, "documents"))
