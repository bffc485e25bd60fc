"""Exact removal of repeated substrings with suffix arrays over shards.

A byte goes if a string of LENGTH bytes that covers it also starts anywhere else, in any text or the same one.

Which strings must meet: of every window of LENGTH bytes the least hash of its GRAM-byte strings is its anchor. Equal windows have equal
anchors, so windows are dealt by them, and an anchor that is found once settles its windows at once. Windows that follow each
other under one anchor make a context; equal contexts become one with a count. The contexts of an anchor go to one shard, where a
suffix array is induced over them and permuted common prefixes tell which windows share LENGTH bytes with another one; a
context that was counted twice or more repeats as it is. An anchor all of whose contexts were counted twice or more is settled by that
and goes to no shard, as its windows are in no context of another anchor.

A shard takes the anchors whose first text is the same, so contexts that lie beside each other in a text mostly become one
segment; where that is more than SALT contexts it is dealt once more by anchor. An anchor of more than HOT
different contexts is settled window by window through 128 bits of hash instead, so that no group must fit one task. Rows with
equal texts are worked on once, by 96 bits of hash.

Null texts are empty, texts shorter than LENGTH lose nothing, repeated rows repeat each other. Very long texts are hashed in
pieces that overlap. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm.common import id_text, table, tidy, worker_cache, write_table
from folioframe.llm.suffixes import permuted_prefixes, suffix_array

LENGTH, GRAM = 200, 64
#: Contexts of a shard, different contexts of an anchor, bytes that are sorted together, and bytes hashed at a time.
SALT, HOT, SHARD, PIECE = 8_000, 8_000, 3 << 20, 1 << 20

_BASE = 0xD6E8FEB86659FD93
_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""

    def build():
        up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)

    return worker_cache(("powers", n), build)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX1
    x = (x ^ (x >> np.uint64(29))) * _MIX2
    return x ^ (x >> np.uint64(32))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    m = len(x)
    z = np.concatenate([x, np.full(-m % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    before = np.minimum.accumulate(z, 1).ravel()
    after = np.minimum.accumulate(z[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(after[: m - width + 1], before[width - 1 : m])


def contexts(raw: bytes, length: int = LENGTH, gram: int = GRAM):
    """(anchor hash, context hash with the number of windows in its last byte, first window) of a text, as arrays. The bit above that
    byte tells that the context holds its anchor's string more than once, so that its windows may repeat each other."""
    out = []
    width = length - gram + 1
    for at in range(0, max(0, len(raw) - length + 1), PIECE):
        b = np.frombuffer(raw, np.uint8, min(PIECE + length - 1, len(raw) - at), at)
        n = len(b)
        up, down = _powers(PIECE + length)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:n])])
        grams = _mixed((total[gram:] - total[:-gram]) * down[: n - gram + 1])
        least = _sliding_min(grams, width)
        new = np.concatenate([[True], least[1:] != least[:-1]])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(least)))
        fresh = np.arange(len(first)) == 0
        if (size > width).any():  # one string over and over: cut its run
            fresh = True
            parts = -(-size // width)
            begin = np.repeat(first, parts) + width * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
            stop = np.repeat(first + size, parts)
            first, size = begin, np.minimum(width, stop - begin)
        # the anchor's first place in the first window; where a later window cannot hold it, the string is found again inside
        place = first + width - 1
        other = np.flatnonzero((grams[place] != least[first]) | fresh)
        for some in np.array_split(other, len(other) // 4096 + 1):
            place[some] = first[some] + (grams[first[some][:, None] + np.arange(width)] == least[first[some]][:, None]).argmax(1)
        inner = place < first + size - 1
        text = _mixed((total[first + size - 1 + length] - total[first]) * down[first])
        text = text & np.uint64(0xFFFFFFFFFFFFFE00) | inner.astype(np.uint64) << np.uint64(8) | size.astype(np.uint64)
        out.append((least[first], text, first + at))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def text_key(raw: bytes) -> tuple[int, int]:
    """96 bits of a text: a signed long, and 31 bits and a sign-free rest that fit beside a place."""
    d = xxhash.xxh3_128_digest(raw)
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:12], "big") & 0x7FFFFFFF


def _arrays(batch_texts):
    return [t.encode("utf-8", "surrogatepass") for t in batch_texts]


def anchors(docs: DataFrame) -> DataFrame:
    """(h, c, k1, pk, m): m rows of a batch have the text k1, k2 with a context c under anchor h; pk holds k2 and the place."""
    schema = pa.schema([(x, pa.int64()) for x in ("h", "c", "k1", "pk", "m")])

    def run(batches):
        for b in batches:
            count: dict[bytes, int] = {}
            for raw in _arrays(b.column(0).to_pylist()):
                if len(raw) >= LENGTH:
                    count[raw] = count.get(raw, 0) + 1
            parts, rows = [], 0

            def flush():
                cols = [np.concatenate(x) for x in zip(*parts)]
                parts.clear()
                return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], schema=schema)

            for raw, n in count.items():
                h, c, at = contexts(raw)
                k1, k2 = text_key(raw)
                parts.append((h.view(np.int64), c.view(np.int64), np.full(len(h), k1), at.astype(np.int64) | np.int64(k2 << 32), np.full(len(h), n)))
                rows += len(h)
                if rows > 500_000:
                    yield flush()
                    rows = 0
            if parts:
                yield flush()

    return id_text(docs).select("text").mapInArrow(tidy(run), "h long, c long, k1 long, pk long, m long")


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """(h, c, k1, k2, at, m) of anchors found twice or more, or again inside their context. Counts come first, pre-aggregated, and leave few
    anchors; the join that picks these can split an anchor that a third of all texts have, as nothing above it needs its rows together."""
    again = F.max(F.col("c").bitwiseAND(F.lit(256)))
    counted = anchors(docs).groupBy("h").agg(F.sum("m").alias("tot"), again.alias("again")).where("tot > 1 or again > 0").select("h")
    some = write_table(counted, "repeated")  # so that both sides of the join are dealt for it alone
    own = anchors(docs).join(some, "h").repartition("h", "c", "k1", "pk").groupBy("h", "c", "k1", "pk").agg(F.sum("m").alias("m"))
    return own.select("h", "c", "k1", F.shiftright("pk", 32).alias("k2"), F.col("pk").bitwiseAND(F.lit(0xFFFFFFFF)).alias("at"), "m")


def context_rows(found: DataFrame) -> DataFrame:
    """(h, c, cm: times of the context, k1, k2, at: where it stands first, nc: different contexts of the anchor, key: the anchor's first text,
    settled: whether all contexts of the anchor came twice or more)."""
    each = found.groupBy("h", "c").agg(F.sum("m").alias("cm"), F.min(F.struct("k1", "k2", "at")).alias("r"))
    per_anchor = write_table(each.groupBy("h").agg(F.count("*").alias("nc"), F.min("r.k1").alias("key"), (F.min("cm") > 1).alias("settled")), "per_anchor")
    return each.join(per_anchor, "h").select("h", "c", "cm", "r.k1", "r.k2", "r.at", "nc", "key", "settled")


def packed_texts(docs: DataFrame) -> DataFrame:
    """(k1, k2, z: the text, compressed) once a batch."""
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("z", pa.binary())])

    def run(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            raws = list({r for r in _arrays(b.column(0).to_pylist()) if len(r) >= LENGTH})
            if raws:
                keys = [text_key(r) for r in raws]
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]), pa.array(map(pack, raws), pa.binary())], schema=schema)

    return id_text(docs).select("text").mapInArrow(tidy(run), "k1 long, k2 long, z binary")


def _with_texts(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(k1, z, own: array of (key, salt, at, h, c, cm) in order): texts and the contexts that they stand for."""
    own = reps.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("key", "salt", "at", "h", "c", "cm"))).alias("own"))
    joined = packed_texts(docs).join(own, ["k1", "k2"])
    return joined.select("k1", "z", *(F.col(f"own.{x}").alias(x) for x in ("key", "salt", "at", "h", "c", "cm")))


def segments(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(key, salt, k1, at, text, h, c, cm, off): bytes of a text that one shard takes, and the contexts in them."""
    longs = pa.list_(pa.int64())
    schema = pa.schema([("key", pa.int64()), ("salt", pa.int64()), ("k1", pa.int64()), ("at", pa.int64()), ("text", pa.binary()), ("h", longs), ("c", longs), ("cm", longs), ("off", longs)])

    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            rows = []
            for k1, z, *cols in zip(*(x.to_pylist() for x in b.columns)):
                raw, now, stop = unpack(z), None, -1
                for key, salt, at, h, c, cm in zip(*cols):
                    end = at + (c & 0xFF) + LENGTH - 1
                    if now is None or (key, salt) != now[:2] or at > stop:
                        if now:
                            rows.append((*now[:4], raw[now[3] : stop], *now[4:]))
                        now, stop = (key, salt, k1, at, [], [], [], []), -1
                    for x, v in zip(now[4:], (h, c, cm, at - now[3])):
                        x.append(v)
                    stop = max(stop, end)
                if now:
                    rows.append((*now[:4], raw[now[3] : stop], *now[4:]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

    return _with_texts(docs, reps).mapInArrow(tidy(run), "key long, salt long, k1 long, at long, text binary, h array<long>, c array<long>, cm array<long>, off array<long>")


def repeated_starts(texts: list[bytes], own: list[np.ndarray] | None = None, length: int = LENGTH) -> list[np.ndarray]:
    """For each text, whether the window at each place is found at another place of any of the texts. own: for each text, which
    places count; bytes between contexts may hold a window that counts elsewhere, and must not meet it again here."""
    code = np.frombuffer(b"\xff".join(texts) + b"\xff\x00", np.uint8).copy()  # 0xff is in no UTF-8 text
    counts = np.zeros(len(code), bool)
    at = 0
    for i, t in enumerate(texts):
        n = max(0, len(t) - length + 1)
        counts[at : at + n] = True if own is None else own[i][:n]
        at += len(t) + 1
    present = np.unique(code[:-1])
    rank = np.zeros(256, np.uint8)
    rank[present] = np.arange(1, len(present) + 1)
    code = rank[code]
    code[-1] = 0
    sa = suffix_array(code, len(present) + 1)
    _, shared = permuted_prefixes(code, sa)
    group = np.cumsum(shared[sa] < length, dtype=np.int32)  # neighbours in the array that share a window
    counted = counts[sa]
    times = np.bincount(group[counted], minlength=int(group[-1]) + 1)
    hit = np.zeros(len(code), bool)
    hit[sa] = counted & (times[group] > 1)
    out, at = [], 0
    for t in texts:
        out.append(hit[at : at + max(0, len(t) - length + 1)])
        at += len(t) + 1
    return out


def _runs(hit: np.ndarray) -> list[int]:
    """Begin and end of each run of true values, one after another."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    return edge.tolist()


def _sort_shards(batches):
    """Rows sorted by (key, salt); shards are sorted together up to SHARD bytes, a shard never apart."""
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("runs", pa.list_(pa.int64()))])
    held, size, shard, seen = [], 0, None, set()

    def settle():
        out, own = [], []
        for text, _, cs, _, offs in held:
            own.append(np.zeros(len(text), bool))
            for c, off in zip(cs, offs):
                own[-1][off : off + (c & 0xFF)] = True
        for hit, (_, hs, cs, cms, offs) in zip(repeated_starts([x[0] for x in held], own), held):
            for h, c, cm, off in zip(hs, cs, cms, offs):
                n = c & 0xFF
                runs = [0, n] if cm > 1 else _runs(hit[off : off + n])
                if runs:
                    out.append((h, c, runs))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema) if out else None

    for b in batches:
        for key, salt, k1, at, text, h, c, cm, off in zip(*(x.to_pylist() for x in b.columns)):
            if (key, salt) != shard:
                if size >= SHARD:
                    if (got := settle()) is not None:
                        yield got
                    size = 0
                shard, seen = (key, salt), set()
            if (k1, at) in seen:  # a text that came from several batches
                continue
            seen.add((k1, at))
            held.append((text, h, c, cm, off))
            size += len(text) + 1
    if held and (got := settle()) is not None:
        yield got


def sorted_shards(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(h, c, runs): windows of each context that repeat, as begins and ends."""
    dealt = segments(docs, reps).repartition("key", "salt").sortWithinPartitions("key", "salt")
    return dealt.mapInArrow(tidy(_sort_shards), "h long, c long, runs array<long>")


def hashed_windows(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """The same for anchors with too many contexts for a shard: each window by itself, by 128 bits of hash."""
    schema = pa.schema([(x, pa.int64()) for x in ("h", "c", "w1", "w2", "off", "cm")])

    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            rows = []
            for _, z, *cols in zip(*(x.to_pylist() for x in b.columns)):
                raw = unpack(z)
                for _, _, at, h, c, cm in zip(*cols):
                    for off in range(c & 0xFF):
                        d = xxhash.xxh3_128_digest(raw[at + off : at + off + LENGTH])
                        rows.append((h, c, int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True), off, cm))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], schema=schema)

    each = _with_texts(docs, reps).mapInArrow(tidy(run), "h long, c long, w1 long, w2 long, off long, cm long").distinct()
    times = each.groupBy("h", "w1", "w2").agg(F.sum("cm").alias("times")).where("times > 1")
    own = each.join(times, ["h", "w1", "w2"]).groupBy("h", "c").agg(F.sort_array(F.collect_set("off")).alias("offs"))
    return own.select("h", "c", F.flatten(F.transform("offs", lambda x: F.array(x, x + 1))).alias("runs"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(k1, k2, starts: array of (a, b)): windows a to b (exclusive) of the text repeat."""
    found = write_table(repeated_anchors(docs), "anchors")
    every = write_table(context_rows(found), "contexts")
    reps = every.where("not settled")
    sizes = write_table(reps.where(F.col("nc") <= HOT).groupBy("key").agg(F.count("*").alias("n")), "sizes")
    normal = reps.where(F.col("nc") <= HOT).join(sizes, "key").withColumn("salt", F.pmod(F.col("h"), F.ceil(F.col("n") / SALT)))
    whole = every.where("settled").select("h", "c", F.array(F.lit(0).cast("long"), F.col("c").bitwiseAND(F.lit(255))).alias("runs"))
    runs = sorted_shards(docs, normal).union(whole)
    if reps.where(F.col("nc") > HOT).limit(1).count():
        runs = runs.union(hashed_windows(docs, reps.where(F.col("nc") > HOT).withColumn("salt", F.lit(0).cast("long"))))
    runs = write_table(runs, "runs")
    ends = F.transform(F.sequence(F.lit(0), F.size("runs") - 2, F.lit(2)), lambda i: F.struct((F.col("at") + F.element_at("runs", i + 1)).alias("a"), (F.col("at") + F.element_at("runs", i + 2)).alias("b")))
    return found.select("h", "c", "k1", "k2", "at").join(runs, ["h", "c"]).select("k1", "k2", F.explode(ends).alias("s")).groupBy("k1", "k2").agg(F.collect_list("s").alias("starts"))


def cut(raw: bytes, starts, length: int = LENGTH) -> tuple[list[int], bytes]:
    """(removed runs as begins and ends, what stays) of a text whose windows from a to b repeat."""
    runs: list[int] = []
    for a, b in sorted(starts):
        end = b - 1 + length
        if runs and a <= runs[-1]:
            runs[-1] = max(runs[-1], end)
        else:
            runs += [a, end]
    kept = [raw[a:b] for a, b in zip([0, *runs[1::2]], [*runs[::2], len(raw)])]
    return runs, b"".join(kept)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, removed: array of begins and ends, kept binary)."""
    whole = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("z", pa.binary())])

    def keyed(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            raws = _arrays(b.column(1).to_pylist())
            keys = [text_key(r) for r in raws]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array(map(pack, raws), pa.binary())], schema=whole)

    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("removed", pa.list_(pa.int64())), ("kept", pa.binary())])

    def out(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            raws = [unpack(z) for z in b.column(1).to_pylist()]
            got = [cut(r, zip(x, y) if x else ()) for r, x, y in zip(raws, b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(len, raws), pa.int64()), pa.array([g[0] for g in got], schema.field(2).type), pa.array([g[1] for g in got], pa.binary())], schema=schema)

    rows = id_text(docs).mapInArrow(tidy(keyed), "doc_id long, k1 long, k2 long, z binary")
    joined = rows.join(repeated_spans(docs), ["k1", "k2"], "left")
    return joined.select("doc_id", "z", F.col("starts.a").alias("a"), F.col("starts.b").alias("b")).mapInArrow(tidy(out), "doc_id long, n_bytes long, removed array<long>, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"), F.expr("cast(size(removed) / 2 as long)").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
