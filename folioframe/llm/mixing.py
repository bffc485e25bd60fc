"""Mixing sources to target weights by Sainte-Laguë apportionment.

Blocks of BLOCK words each are given to sources by highest quotients target / (2k + 1), then a source's blocks to its
shards by their sizes in the same way, so that every shard has an integer quota. In a shard the documents lie in
seeded order; whole passes over the shard are taken first, and the rest of the quota is a run of blocks from a seeded
place on, around the end. No source takes more than twice its words.

A shard is a seeded part of one source of about SHARD_WORDS words, as many as the source needs, so a source that
holds a third of all rows is many shards and no task grows with it. The driver holds three numbers a shard, which is
one part in 250,000 of the text, and one row a source (a source is a kind of origin; a column of ids would be none).

Null texts have no words and are never taken; a null source is a source, the last one. Repeated rows count and are taken each on its own;
rows without a doc_id are placed by their texts. A very long text is one row of its shard, and its words are cut only where a part of
it is taken. Equal places are settled by doc_id, size and text. An empty table gives an empty result.
Further columns are ignored by plan() and kept by mixed().
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioframe.llm.common import table, write_table

WEIGHTS, SHARE, MOST, SEED = (5, 2, 1), 1.5, 2, 17
BLOCK, SHARD_WORDS = 8, 1_000_000
WORDS = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: list[int], share: float = SHARE, most: int = MOST) -> list[float]:
    """Shares of share * sum(sizes) by weight; what goes over most times a source's size is shared again among the others."""
    order = sorted(range(len(sizes)), key=lambda i: (most * sizes[i] / weights[i], i))
    left, weight = share * sum(sizes), sum(weights)
    level = 0.0
    for i in order:
        level = left / weight
        if level <= most * sizes[i] / weights[i]:
            break
        left -= most * sizes[i]
        weight -= weights[i]
        level = float("inf")
    return [float(min(most * s, level * w)) for s, w in zip(sizes, weights)]


def sainte_lague(weights, total: int, caps) -> list[int]:
    """total seats by highest quotients w / (2k + 1), k < cap; equal quotients go to the earlier party. The bulk comes from the divisor, by
    bisection, and only the last seats from a heap."""
    w, cap = np.asarray(weights, float), np.asarray(caps, np.int64)
    total = min(int(total), int(cap.sum()))
    if total <= 0:
        return [0] * len(w)

    def seats(divisor):
        return np.minimum(cap, np.maximum(0, np.floor((w / divisor + 1) / 2 * (1 - 1e-12)).astype(np.int64)))

    low, high = 1e-300, float(w.max()) * 2 + 1e-300
    for _ in range(2200):
        mid = (low * high) ** 0.5 if low > 1e-200 else max(high * 1e-6, 1e-300)
        if seats(mid).sum() >= total:
            low = mid
        else:
            high = mid
        if high / low < 1 + 1e-10:
            break
    got = seats(high)
    heap = [(-w[i] / (2 * int(got[i]) + 1), i) for i in range(len(w)) if got[i] < cap[i]]
    heapq.heapify(heap)
    left = total - int(got.sum())
    while left > 0:
        _, i = heapq.heappop(heap)
        got[i] += 1
        left -= 1
        if got[i] < cap[i]:
            heapq.heappush(heap, (-w[i] / (2 * int(got[i]) + 1), i))
    return [int(x) for x in got]


def _seeded(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def sized(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """(doc_id, source, size, h, th) and, if asked for, the columns of carry in a struct _row."""
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        doc_id.alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.concat(F.lit("t:"), text))).cast("binary")).alias("h"),
        F.xxhash64(text).alias("th"),
        *([F.struct(*(F.col(f"`{c}`") for c in carry)).alias("_row")] if carry else []),
    )


def _start(h):
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long")


def plan(rows: DataFrame, whole: DataFrame | None = None) -> DataFrame:
    """Adds source_size, target, taken, and the parts: full (whole passes) and runs [a1, b1), [a2, b2) of a document's words.
    rows: sized() rows without texts, of which sizes are summed; whole: rows to decide on, by default the same."""
    spark = rows.sparkSession
    found = sorted(rows.groupBy("source").agg(F.sum("size").alias("n")).collect(), key=lambda r: (r.source is None, r.source or ""))
    sizes, weights = [int(r.n) for r in found], [WEIGHTS[i % len(WEIGHTS)] for i in range(len(found))]
    goal = targets(sizes, weights) if found else []
    parts = [max(1, -(-s // SHARD_WORDS)) for s in sizes]
    sources = spark.createDataFrame([(i, r.source, s, g, p) for i, (r, s, g, p) in enumerate(zip(found, sizes, goal, parts))], "rn int, _source string, source_size long, target double, parts long")

    def dealt(df):
        placed = df.join(sources, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        return placed.withColumn("shard", _start(F.col("h")) % F.col("parts"))

    per_shard = dealt(rows).groupBy("rn", "shard").agg(F.sum("size").alias("n")).toArrow().sort_by([("rn", "ascending"), ("shard", "ascending")])
    shards: list[list[tuple[int, int, int]]] = [[] for _ in found]
    for rn, shard, n in zip(*(per_shard.column(x).to_numpy().tolist() for x in ("rn", "shard", "n"))):
        shards[rn].append((shard, n, -(-n // BLOCK)))
    quotas = sainte_lague(goal, int(SHARE * sum(sizes) / BLOCK + 0.5), [MOST * sum(b for *_, b in x) for x in shards]) if found else []
    plans = []
    for rn, (own, quota) in enumerate(zip(shards, quotas)):
        for (shard, n, blocks), q in zip(own, sainte_lague([n for _, n, _ in own], quota, [MOST * b for *_, b in own])):
            full, rest = divmod(q, blocks) if blocks else (0, 0)
            first = _seeded(f"{SEED}:{rn}:{shard}") % blocks if blocks else 0
            a, b = first * BLOCK, (first + rest) * BLOCK
            around = max(0, first + rest - blocks) * BLOCK
            plans.append((rn, shard, full, a, min(b, n), min(around, n)))
    names = ("rn", "shard", "full", "a", "b", "around")
    chosen = spark.createDataFrame(pa.table([pa.array(x, pa.int64()) for x in zip(*plans)] if plans else [pa.array([], pa.int64()) for _ in names], names))
    order = Window.partitionBy("rn", "shard").orderBy("h", "doc_id", "size", "th")
    at = dealt(whole if whole is not None else rows).withColumn("stop", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))).join(chosen, ["rn", "shard"])
    begin = F.col("stop") - F.col("size")
    clip = lambda x: F.greatest(F.lit(0), F.least(F.col("size"), x - begin))
    at = at.withColumns({"a1": clip(F.col("a")), "b1": clip(F.col("b")), "a2": F.lit(0).cast("long"), "b2": clip(F.col("around"))})
    return at.withColumn("taken", F.col("full") * F.col("size") + F.col("b1") - F.col("a1") + F.col("b2")).drop("rn", "shard", "parts", "stop", "a", "b", "around", "h", "th")


def mixture(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken)."""
    return plan(write_table(sized(docs), "sizes")).select("doc_id", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself, in the columns of docs: a row for each whole pass over a document, and one for each part of it that is
    taken besides (its words joined by spaces)."""
    sizes = sized(docs).select("source", "size", "h").persist(StorageLevel.DISK_ONLY)  # just for sums: no table, whose files cost commands of the system
    try:
        rows = plan(sizes, sized(docs, docs.columns))
    finally:
        sizes.unpersist()
    part = lambda a, b: F.when(b > a, F.struct(a.alias("a"), b.alias("b")))
    copies = F.concat(
        F.array_repeat(F.struct(F.lit(0).cast("long").alias("a"), F.col("size").alias("b")), F.when(F.col("size") > 0, F.col("full")).otherwise(0).cast("int")),
        F.array_compact(F.array(part(F.col("a1"), F.col("b1")), part(F.col("a2"), F.col("b2")))),
    )
    out = rows.select("_row", "size", F.explode(copies).alias("_cut"))
    words = F.slice(F.regexp_extract_all(F.col("_row.text"), F.lit(WORDS), F.lit(0)), (F.col("_cut.a") + 1).cast("int"), (F.col("_cut.b") - F.col("_cut.a")).cast("int"))
    text = F.when((F.col("_cut.a") == 0) & (F.col("_cut.b") == F.col("size")), F.col("_row.text")).otherwise(F.array_join(words, " "))
    return out.select(*(text.alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORDS}'))::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, 't:' || coalesce(text, ''))) AS h
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rn FROM s0),
s2 AS (SELECT *, CASE rn % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s1),
s3 AS (SELECT *, {MOST} * source_size / w::DOUBLE AS ratio, {SHARE} * sum(source_size) OVER () AS total FROM s2),
s4 AS (SELECT *, (total - coalesce(sum({MOST} * source_size) OVER (ORDER BY ratio, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / sum(w) OVER (ORDER BY ratio, rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level FROM s3),
level AS (SELECT level AS lv FROM s4 WHERE level <= ratio ORDER BY ratio, rn LIMIT 1),
s AS (SELECT rn, source, source_size, total, least({MOST} * source_size::DOUBLE, lv * w)::DOUBLE AS target,
         greatest(1, (source_size + {SHARD_WORDS - 1}) // {SHARD_WORDS})::BIGINT AS parts FROM s4, level),
p AS (SELECT d.*, s.rn, s.source_size, s.target, s.total, ('0x' || h[1:8])::BIGINT % s.parts AS shard
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
b AS (SELECT rn, shard, any_value(target) AS target, any_value(total) AS total, sum(size)::BIGINT AS n,
         (sum(size)::BIGINT + {BLOCK - 1}) // {BLOCK} AS blocks FROM p GROUP BY rn, shard),
src AS (SELECT rn, any_value(target) AS target, any_value(total) AS total, sum(blocks)::BIGINT AS blocks FROM b GROUP BY rn),
quot AS (SELECT rn, target / (2 * k + 1) AS quotient, total FROM (SELECT *, unnest(range(0, {MOST} * blocks)) AS k FROM src)),
seat AS (SELECT rn, row_number() OVER (ORDER BY quotient DESC, rn) AS place, total FROM quot),
quota AS (SELECT rn, count(*) AS quota FROM seat WHERE place <= floor(total / {BLOCK} + 0.5) GROUP BY rn),
quot2 AS (SELECT rn, shard, n / (2 * k + 1)::DOUBLE AS quotient FROM (SELECT *, unnest(range(0, {MOST} * blocks)) AS k FROM b)),
seat2 AS (SELECT rn, shard, row_number() OVER (PARTITION BY rn ORDER BY quotient DESC, shard) AS place FROM quot2),
q AS (SELECT rn, shard, count(*) AS q FROM seat2 JOIN quota USING (rn) WHERE place <= quota GROUP BY rn, shard),
c AS (SELECT b.rn, b.shard, b.n, b.blocks, coalesce(q, 0) AS q,
        CASE WHEN blocks > 0 THEN ('0x' || md5('{SEED}:' || b.rn || ':' || b.shard)[1:8])::BIGINT % blocks ELSE 0 END AS first
      FROM b LEFT JOIN q ON b.rn = q.rn AND b.shard = q.shard),
e AS (SELECT *, CASE WHEN blocks > 0 THEN q // blocks ELSE 0 END AS passes, CASE WHEN blocks > 0 THEN q % blocks ELSE 0 END AS rest FROM c),
x AS (SELECT p.*, sum(size) OVER (PARTITION BY rn, shard ORDER BY h, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size AS begin FROM p)
SELECT doc_id, size, source_size, target,
  (passes * size
   + greatest(0, least(size, least((first + rest) * {BLOCK}, n) - begin)) - greatest(0, least(size, first * {BLOCK} - begin))
   + greatest(0, least(size, least(greatest(0, first + rest - blocks) * {BLOCK}, n) - begin)))::BIGINT AS taken
FROM x JOIN e USING (rn, shard)
"""
