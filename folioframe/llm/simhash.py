"""SimHash near-duplicates through BK-trees.

Each text gets a 64-bit fingerprint of its word shingles. Distinct fingerprints are dealt to shards
that agree in two of four 16-bit blocks: two fingerprints that differ in at most two bits agree in two
blocks at least, so each link is inside some shard. A shard holds a BK-tree (children keyed by their
Hamming distance to the parent), and a query follows only edges within the radius. A shard returns
one edge a member, to the root of its local group, never pairs; components join them.

near_duplicates() links fingerprints of 3-word shingles at two bits. keep_one() is the near-duplicate stage: it links texts whose sets of
5-word shingles have a Jaccard similarity of 0.8 or more. There a fingerprint within WIDE bits is no more than a candidate (0.8 is about
10 bits of 64, give or take 3), shards share one of BANDS bands of ROWS min-hashes (a pair at 0.8 shares none with a chance of 3 in a
million), and each candidate's similarity is computed from the whole texts. Three rounds keep groups of copies from becoming pairs:
in the first two a shard's tree gives one edge for each group that it would join (over FIRST bands, then over all). The third takes what
shares a band and is still apart: there the sets go along to the shard, each pair within the radius is compared in the task, and
only links come out. A large group is many shards there, one for each two of its parts, so which pairs are compared depends on no size.

Nulls and texts without words get fingerprint zero and link like any other. Repeated rows and exact
copies share one fingerprint, so groups of copies collapse before anything is dealt. Rows with a
null doc_id keep their fingerprint; a group of such rows only has a null component_id. An empty table gives an empty
result. A very long text is hashed in pieces, so its shingles are never a matrix. Further columns of any name are ignored by near_duplicates()
and kept by keep_one().
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioframe.llm.common import per_text, sliced, table, worker_cache, write_table
from folioframe.llm.components import connected_components

SHINGLE, SEED, RADIUS = 3, 42, 2
#: Block pairs that make up the shard keys; a shard of more than CROWDED fingerprints is dealt once more by the other two blocks.
PAIRS, CROWDED = ((0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)), 50_000

#: The near-duplicate stage: words of a shingle, similarity, bits of a candidate, min-hashes.
WORDS, SIMILARITY, WIDE, ROWS, BANDS, FIRST = 5, 0.8, 20, 4, 24, 3
#: Rows of a part in the third round; a larger group is cut into parts, and pairs of parts are compared.
CLOSE = 500

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_OFFSETS = (np.arange(8) * 256).astype(np.int64)


def shingles(text: str, size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Hashes of a text's shingles, repeats included; of fewer words, one of all of them."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    line, hash64 = b" ".join(words), xxhash.xxh64_intdigest
    if n < size:
        return np.array([hash64(line, seed)], np.uint64)
    lens = list(map(len, words))
    starts = [0, *accumulate(x + 1 for x in lens[:-1])]
    return np.array([hash64(line[a : b + c], seed) for a, b, c in zip(starts, starts[size - 1 :], lens[size - 1 :])], np.uint64)


def simhash(h: np.ndarray) -> int:
    """A bit is one if over half of the hashes have it."""
    by_byte = np.bincount((h.view(np.uint8).reshape(-1, 8) + _OFFSETS).ravel(), minlength=2048).reshape(8, 256)
    ones = (by_byte @ _BITS).ravel() * 2 > len(h)
    return int(np.packbits(ones, bitorder="little").view(np.uint64)[0])


def fingerprint(text: str, size: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash."""
    return simhash(shingles(text, size, seed))


class BKTree:
    """Over distinct fingerprints (uint64 array): node = (pivot's index, {distance: child}); built and asked in numpy batches."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.root = None
        todo = [(np.arange(len(values)), None, 0)]
        while todo:
            at, parent, key = todo.pop()
            node = (int(at[0]), {})
            if parent is None:
                self.root = node
            else:
                parent[1][key] = node
            rest = at[1:]
            if len(rest):
                d = np.bitwise_count(values[rest] ^ values[at[0]])
                order = np.argsort(d, kind="stable")
                rest, d = rest[order], d[order]
                cuts = np.flatnonzero(np.diff(d)) + 1
                todo += [(part, node, int(d[c])) for part, c in zip(np.split(rest, cuts), [0, *cuts])]

    def within(self, queries: np.ndarray, radius: int):
        """Yields (pivot's index, indices of the queries within radius of it)."""
        todo = [(self.root, np.arange(len(queries)))] if len(self.values) and len(queries) else []
        while todo:
            (pivot, below), at = todo.pop()
            d = np.bitwise_count(queries[at] ^ self.values[pivot]).astype(np.int64)
            near = at[d <= radius]
            if len(near):
                yield pivot, near
            for c, child in below.items():
                go = at[np.abs(d - c) <= radius]
                if len(go):
                    todo.append((child, go))


def local_links(values: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Members of a shard that have a link, and the least index of their group inside the shard."""
    n = len(values)
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for pivot, near in BKTree(values).within(values, radius):
        for x in near.tolist():
            if x != pivot:
                a, b = find(x), find(pivot)
                if a != b:
                    up[max(a, b)] = min(a, b)
    root = np.array([find(x) for x in range(n)])
    moved = np.flatnonzero(root != np.arange(n))
    return moved, root[moved]


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp long: the unsigned value's bits)."""
    return per_text(docs, lambda texts: {"fp": np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)}, "fp long")


def _shard(batches):
    """Rows sorted by key; a group may run over several batches."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(values):
        values = np.unique(values)
        if len(values) < 2:
            return None
        member, root = local_links(values)
        return (values[member].view(np.int64), values[root].view(np.int64)) if len(member) else None

    key, held, out = None, [], []

    def flush():
        batch = pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[i] for x in out])) for i in (0, 1)], schema=schema)
        out.clear()
        return batch

    for b in batches:
        k, v = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        v = v.view(np.uint64)
        if not len(k):
            continue
        cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
        for at, part in zip([0, *cuts], np.split(v, cuts)):
            if k[at] != key:
                if held and (got := links(np.concatenate(held))):
                    out.append(got)
                key, held = k[at], []
            held.append(part)
        if len(out) > 5000:
            yield flush()
    if held and (got := links(np.concatenate(held))):
        out.append(got)
    if out:
        yield flush()


def _block(fp, i):
    return F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that join what lies within the radius."""
    fp = F.col("fp")
    keys = F.array(*(F.xxhash64(F.lit(i), _block(fp, x), _block(fp, y)) for i, (x, y) in enumerate(PAIRS)))
    keyed = distinct.select("fp", F.posexplode(keys).alias("p", "key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    dealt = keyed.join(sizes, "key")
    # what is left of a crowded shard's bits lies in two blocks of 16; cut in three, one part must agree
    rest = F.lit(0)
    for i, (x, y) in enumerate(PAIRS):
        u, v = (z for z in range(4) if z not in (x, y))
        rest = F.when(F.col("p") == i, _block(fp, u) * 65536 + _block(fp, v)).otherwise(rest)
    parts = F.array(*(F.xxhash64(F.col("key"), F.lit(j), F.shiftright(rest, s).bitwiseAND(F.lit(m))) for j, (s, m) in enumerate(((0, 0x7FF), (11, 0x7FF), (22, 0x3FF)))))
    sub = F.when(F.col("n") > CROWDED, parts).otherwise(F.array("key"))
    dealt = dealt.select(F.explode(sub).alias("key"), "fp").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_shard, "a long, b long")


def _roots(prints: DataFrame) -> DataFrame:
    """(fp, component_id: least doc_id of the whole group)."""
    distinct = write_table(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = connected_components(links(distinct.select("fp")))
    by_fp = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    tops = by_fp.groupBy("root").agg(F.min("first").alias("component_id"))
    return by_fp.select("fp", "root").join(tops, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint hex, component_id: least doc_id reachable by links)."""
    prints = write_table(fingerprints(docs), "prints")
    return prints.join(_roots(prints), "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def min_bands(distinct: np.ndarray, rows: int = ROWS, bands: int = BANDS) -> np.ndarray:
    """One key a band, of rows min-hashes each. Multiplying by an odd number permutes the hashes."""

    def odd():
        rng = np.random.default_rng(SEED)
        return [rng.integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1) for n in (rows * bands, rows)]

    by, mix = worker_cache(("odd", rows, bands), odd)
    least = np.full(rows * bands, np.iinfo(np.uint64).max, np.uint64)
    for part in np.array_split(distinct, len(distinct) // 4096 + 1):
        if len(part):
            least = np.minimum(least, (part[:, None] * by).min(0))
    keys = (least.reshape(bands, rows) * mix).sum(1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64) * mix[0]
    return keys ^ (keys >> np.uint64(29))


def sketches(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """(doc_id, th: hash of the text, sid: hash of its set of shingles, fp, keys: one a band; none without words)."""

    def score(texts):
        out: dict[str, list] = {k: [] for k in ("th", "sid", "fp", "keys")}
        for t in texts:
            h = shingles(t, size)
            distinct = np.unique(h)
            out["th"].append(xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), SEED))
            out["sid"].append(xxhash.xxh64_intdigest(distinct.tobytes(), SEED))
            out["fp"].append(simhash(h))
            out["keys"].append(min_bands(distinct).view(np.int64) if len(h) else np.zeros(0, np.int64))
        return {k: v if k == "keys" else np.array(v, np.uint64).view(np.int64) for k, v in out.items()}

    return per_text(docs, score, "th long, sid long, fp long, keys array<long>")


def tree_pairs(prints: np.ndarray, label: np.ndarray, radius: int, joining: bool, alike=None) -> list[tuple[int, int]]:
    """Pairs (i, j) of different labels whose fingerprints lie within the radius, through a BK-tree of the distinct fingerprints in the order
    given. A subtree of one label is not entered by queries of that label. joining: each pair makes two labels one, so that there are fewer pairs than
    labels; else each pair comes once. alike(i, js): which of the pairs are to come; the labels of one that does become one."""
    label = label.copy()
    _, first, back = np.unique(prints, return_index=True, return_inverse=True)
    place = np.empty(len(first), np.int64)
    order = np.argsort(first, kind="stable")
    place[order] = np.arange(len(order))
    back, first = place[back], first[order]  # distinct fingerprints, numbered as they first come
    by_print = np.argsort(back, kind="stable")
    members = np.split(by_print, np.flatnonzero(np.diff(back[by_print])) + 1)
    values = prints[first]
    out: list[tuple[int, int]] = []

    def pairs(left, right):
        for i in left:
            js = right[label[right] != label[i]]
            if alike and len(js):
                js = js[alike(i, js)]
                label[np.isin(label, label[js])] = label[i]
            out.extend((i, j) for j in js.tolist())

    if joining:
        kinds, whole = np.unique(label, return_inverse=True)
        up = np.arange(len(kinds))
        for m in members:
            for j in m[1:].tolist():
                a, b = up[whole[m[0]]], up[whole[j]]
                if a != b:
                    out.append((int(m[0]), j))
                    up[up == b] = a
        own = up[whole[first]]
    else:  # a fingerprint with several labels is like none
        mixed = np.array([(label[m] != label[m[0]]).any() for m in members])
        kinds, own = np.unique(label[first], return_inverse=True)
        own[mixed] = len(kinds) + np.arange(int(mixed.sum()))
        for v in np.flatnonzero(mixed).tolist():
            for n, i in enumerate(members[v].tolist()):
                pairs([i], members[v][n + 1 :])
    tree = BKTree(values)
    nodes, todo = [], [tree.root]
    while todo:  # a subtree is a slice of this order
        nodes.append(todo.pop())
        todo += nodes[-1][1].values()
    line = np.array([n[0] for n in nodes])
    at_of, end = {n[0]: i for i, n in enumerate(nodes)}, {}
    for node in reversed(nodes):
        end[node[0]] = max([at_of[node[0]] + 1, *(end[c[0]] for c in node[1].values())])

    todo = [(tree.root, np.arange(len(values)))]
    while todo:
        (pivot, below), at = todo.pop()
        d = np.bitwise_count(values[at] ^ values[pivot]).astype(np.int64)
        near = at[d <= radius]
        if joining:
            near = near[own[near] != own[pivot]]
            if len(near):
                labels, one = np.unique(own[near], return_index=True)
                out += [(int(first[pivot]), j) for j in first[near[one]].tolist()]
                own[np.isin(own, labels)] = own[pivot]
        else:
            later = near[near > pivot]
            if len(later):
                pairs(members[pivot].tolist(), np.concatenate([members[v] for v in later.tolist()]))
        for c, child in below.items():
            go = at[np.abs(d - c) <= radius]
            inner = own[line[at_of[child[0]] : end[child[0]]]]
            if (inner == inner[0]).all():
                go = go[own[go] != inner[0]]
            if len(go):
                todo.append((child, go))
    return out


def _candidates(radius: int):
    """Of rows (key, salt, sid, fp, comp, r_sid, r_fp, r_comp) sorted by key, salt and order: pairs (a, b) of sets. Each salt has the root."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def pairs(rows):
        sid, fp, comp, r_sid, r_fp, r_comp = (np.concatenate(x) for x in zip(*rows))
        if r_sid[0] not in sid:
            sid, fp, comp = np.append(r_sid[:1], sid), np.append(r_fp[:1], fp), np.append(r_comp[:1], comp)
        if len(sid) < 2:
            return None
        got = np.array(tree_pairs(fp.view(np.uint64), comp, radius, True), np.int64).reshape(-1, 2)
        return np.minimum(sid[got[:, 0]], sid[got[:, 1]]), np.maximum(sid[got[:, 0]], sid[got[:, 1]])

    def run(batches):
        now, held, out = None, [], []
        for b in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            if not b.num_rows:
                continue
            cuts = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])) + 1
            for i, j in zip([0, *cuts], [*cuts, b.num_rows]):
                if (cols[0][i], cols[1][i]) != now:
                    if held and (got := pairs(held)):
                        out.append(got)
                    now, held = (cols[0][i], cols[1][i]), []
                held.append([c[i:j] for c in cols[2:]])
            if len(out) > 2000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[k] for x in out])) for k in (0, 1)], schema=schema)
                out = []
        if held and (got := pairs(held)):
            out.append(got)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[k] for x in out])) for k in (0, 1)], schema=schema)

    return run


def _dealt(keyed: DataFrame, radius: int) -> DataFrame:
    """Candidates (a, b) of keyed (key, sid, fp, comp): groups of a key with one label only are left out before anything is dealt. A crowded
    group is salted, and its root (the first in a fixed order) goes along with each row."""
    rank = F.xxhash64("sid", F.lit(SEED))
    found = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.min(F.struct(rank.alias("rank"), "sid", "fp", "comp")).alias("r")).where("c0 <> c1")
    found = write_table(found.select("key", "n", F.col("r.sid").alias("r_sid"), F.col("r.fp").alias("r_fp"), F.col("r.comp").alias("r_comp")), "groups")
    salt = F.pmod("sid", F.ceil(F.col("n") / CROWDED))
    rows = keyed.join(found, "key").select("key", salt.alias("salt"), "sid", "fp", "comp", "r_sid", "r_fp", "r_comp", rank.alias("rank"))
    rows = rows.repartition("key", "salt").sortWithinPartitions("key", "salt", "rank").drop("rank")
    return rows.mapInArrow(_candidates(radius), "a long, b long").distinct()


def _apart(keyed: DataFrame) -> DataFrame:
    """(key, n: its rows) of the groups with two labels or more."""
    return keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1").select("key", "n")


def _in_parts(keyed: DataFrame) -> DataFrame:
    """(key, i, j, sid, fp, comp, part): rows of keyed whose group has two labels or more. A group is cut into parts of CLOSE rows, neighbours by
    label, and each pair of parts (i, j), a part with itself included, is a shard, so that any two rows of different labels meet however
    large their group is. Pairs of parts of one label only are left out."""
    groups = write_table(_apart(keyed), "groups")
    some = keyed.join(groups, "key")
    by_label = Window.partitionBy("key").orderBy("comp", F.xxhash64("sid", F.lit(SEED)), "sid")
    large = some.where(F.col("n") > CLOSE).withColumn("part", F.floor((F.row_number().over(by_label) - 1) / CLOSE).cast("int"))
    large = write_table(large.select("key", "sid", "fp", "comp", "part"), "parts")
    parts = large.groupBy("key", "part").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    left, right = (parts.select("key", F.col("part").alias(x), F.col("c0").alias(f"{x}0"), F.col("c1").alias(f"{x}1")) for x in "ij")
    pairs = left.join(right, "key").where("i <= j and (i0 <> i1 or j0 <> j1 or i0 <> j0)").select("key", "i", "j")
    own = pairs.select("key", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("part"))
    small = some.where(F.col("n") <= CLOSE).select("key", "sid", "fp", "comp", F.lit(0).alias("part")).withColumns({"i": F.lit(0), "j": F.lit(0)})
    return small.unionByName(large.join(own, ["key", "part"])).select("key", "i", "j", "sid", "fp", "comp", "part")


def _close_links(batches, radius: int, least: float):
    """Of rows (key, i, j, sid, fp, comp, part, own: the sorted set's bytes) sorted by key, i, j and order: links between different labels, of
    two parts only those from one to the other."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(rows):
        sid, fp, comp, part = (np.concatenate([r[i] for r in rows]) for i in range(4))
        own = [np.frombuffer(x, np.uint64) for r in rows for x in r[4]]
        size = np.array([len(x) for x in own])
        two = (part != part[0]).any()

        def alike(i, js):
            fit = np.minimum(size[js], size[i]) >= least * np.maximum(size[js], size[i])
            if two:
                fit &= part[js] != part[i]
            some = js[fit]
            if len(some):
                flat = np.concatenate([own[j] for j in some.tolist()])
                at = np.minimum(np.searchsorted(own[i], flat), size[i] - 1)
                both = np.add.reduceat((own[i][at] == flat).astype(np.int64), np.cumsum(size[some]) - size[some])
                fit[fit] = both >= least * (size[some] + size[i] - both)
            return fit

        got = np.array(tree_pairs(fp.view(np.uint64), comp, radius, False, alike), np.int64).reshape(-1, 2)
        return np.minimum(sid[got[:, 0]], sid[got[:, 1]]), np.maximum(sid[got[:, 0]], sid[got[:, 1]])

    now, held = None, []
    for b in batches:
        if not b.num_rows:
            continue
        key, i, j, *cols = (b.column(x).to_numpy(zero_copy_only=False) for x in range(7))
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
        for x, y in zip([0, *cuts], [*cuts, b.num_rows]):
            if (key[x], i[x], j[x]) != now:
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in links(held)], schema=schema)
                now, held = (key[x], i[x], j[x]), []
            held.append((*(c[x:y] for c in cols), b.column(7).slice(x, y - x).to_pylist()))
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in links(held)], schema=schema)


def close_links(keyed: DataFrame, sets: DataFrame, docs: DataFrame, size: int, least: float, radius: int) -> DataFrame:
    """Links (a, b) between what shares a band and has different labels, each pair within the radius compared by its whole sets."""
    rows = write_table(_in_parts(keyed), "apart")
    schema = pa.schema([("sid", pa.int64()), ("own", pa.binary())])

    def pack(batches):
        for b in sliced(batches, 256):
            own = [np.unique(shingles(t or "", size)).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own, pa.binary())], schema=schema)

    own = _texts(rows.select("sid").distinct(), sets, docs).select("sid", "text").mapInArrow(pack, "sid long, own binary")
    dealt = rows.join(own, "sid").select("key", "i", "j", "sid", "fp", "comp", "part", "own", F.xxhash64("sid", F.lit(SEED)).alias("rank")).repartition("key", "i", "j")
    dealt = dealt.sortWithinPartitions("key", "i", "j", "rank").drop("rank")
    return dealt.mapInArrow(lambda batches: _close_links(batches, radius, least), "a long, b long").distinct()


def _texts(nodes: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """(sid, text) of each set asked for, from the row that stands for it."""
    reps = nodes.join(sets, "sid").select("sid", F.coalesce("doc_id", F.lit(-1)).alias("_k"), F.col("doc_id").isNull().alias("_n"), F.col("th").alias("_h"))
    keyed = _keyed(docs).select("_k", "_n", "_h", F.col("_row.text").cast("string").alias("text"))
    return write_table(keyed.join(reps, ["_k", "_n", "_h"]).select("sid", "text").dropDuplicates(["sid"]), "texts")


def similar(pairs: DataFrame, sets: DataFrame, docs: DataFrame, size: int, least: float) -> DataFrame:
    """The pairs (a, b) whose sets have a Jaccard similarity of least or more, computed from their texts."""
    nodes = pairs.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid"))).distinct()
    texts = _texts(nodes, sets, docs)
    both = pairs.join(texts.select(F.col("sid").alias("a"), F.col("text").alias("t")), "a").join(texts.select(F.col("sid").alias("b"), F.col("text").alias("u")), "b")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        kept: dict[int, np.ndarray] = {}

        def of(sid, text):
            if sid not in kept:
                if len(kept) >= 64:
                    kept.clear()
                kept[sid] = np.unique(shingles(text or "", size))
            return kept[sid]

        for b in sliced(batches, 128):
            hit = []
            for x, y, t, u in zip(*(c.to_pylist() for c in b.columns)):
                p, q = of(x, t), of(y, u)
                both = len(np.intersect1d(p, q, assume_unique=True))
                hit.append(both >= least * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], schema=schema).filter(pa.array(hit, pa.bool_()))

    return both.select("a", "b", "t", "u").mapInArrow(run, "a long, b long")


def near_groups(docs: DataFrame, size: int = WORDS, least: float = SIMILARITY, radius: int = WIDE) -> DataFrame:
    """(doc_id, th, root): rows of one root are joined by links of that similarity; texts of equal sets are alike."""
    marks = write_table(sketches(docs, size), "sketches")
    firsts = marks.groupBy("sid").agg(F.min(F.struct("th", "doc_id", "fp")).alias("x"), F.any_value("keys").alias("keys"))
    sets = write_table(firsts.select("sid", "x.th", "x.doc_id", "x.fp", "keys"), "sets")

    def keyed(links, bands=BANDS):
        rows = sets.select(F.explode(F.slice("keys", 1, bands)).alias("key"), "sid", "fp")
        if links is None:
            return rows.withColumn("comp", F.col("sid"))
        comp = connected_components(links).select(F.col("node").alias("sid"), F.col("root").alias("comp"))
        return write_table(rows.join(comp, "sid", "left").withColumn("comp", F.coalesce("comp", "sid")), "keyed")

    def links(rows):
        return write_table(similar(write_table(_dealt(rows, radius), "pairs"), sets, docs, size, least), "links")

    found = links(keyed(None, FIRST))
    found = found.union(links(keyed(found)))
    found = found.union(write_table(close_links(keyed(found), sets, docs, size, least, radius), "links"))
    roots = connected_components(found)
    return marks.join(roots.withColumnRenamed("node", "sid"), "sid", "left").select("doc_id", "th", F.coalesce("root", "sid").alias("root"))


def keep_one(docs: DataFrame, size: int = WORDS, least: float = SIMILARITY) -> DataFrame:
    """The documents with one row left of each near-duplicate group: that of the least doc_id (of equal ones, the least text hash)."""
    groups = write_table(near_groups(docs, size, least), "near")
    kept = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("x"))
    return keep_rows(docs, kept.select("x.doc_id", "x.th"))


def _keyed(docs: DataFrame) -> DataFrame:
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    return docs.select(row, F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("_k"), F.col("doc_id").isNull().alias("_n"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_h"))


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of docs whose (doc_id, th) is in kept, one of each where rows repeat."""
    kept = kept.select(F.coalesce("doc_id", F.lit(-1)).alias("_k"), F.col("doc_id").isNull().alias("_n"), F.col("th").alias("_h"))
    return _keyed(docs).join(kept, ["_k", "_n", "_h"], "left_semi").dropDuplicates(["_k", "_n", "_h"]).select("_row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
