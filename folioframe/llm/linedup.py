"""Line dedup by pairwise alignment.

Documents are paired through what is to be found: the hashes of runs of lines that just reach MIN_WORDS words. Of every run's
holders, each is paired with the first (a star, so a run that many documents share gives one pair a holder). A pair is aligned with
patience diff, and aligned blocks of MIN_WORDS words or more leave the later document, the one of the higher doc_id. So do further
copies of a block in the later document, blocks that lie in another order there, and passages without a line that is unique on
both sides: the pair's runs are compared as well, in linear time. Thus what leaves is each block that any earlier document
has. Alignments are made on the texts as they came, so a block's first holder always keeps it.

Lines are compared without blanks at their ends; lines without words are no part of an alignment and stay. Rows without a doc_id stay as they are.
Rows of one doc_id count as one document where their texts agree, and stay alike; where they differ, the text's hash orders
them. Null texts have no lines and stay null. A very long text is one sequence of lines; all steps but the patience diff's sort are
linear in it. An empty table gives an empty result. Further columns of any name stay as they are.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm.common import per_text, sliced, table, write_table

MIN_WORDS = 20
RARE = 16  # what callers may still pass as rare; runs need no further partners, so it changes nothing


def line_hashes(text: str) -> tuple[list[int], list[int]]:
    """Signed 64-bit hash and number of words of each line."""
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    words = [len(x.split()) for x in lines]
    return [xxhash.xxh64_intdigest(x.strip()) - 2**63 if n else 0 for x, n in zip(lines, words)], words


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Matched places of two sequences: equal ends first, then the longest rising run of items that are unique in both, then the gaps."""
    out = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        places: dict = {}
        for i in range(a0, a1):
            places[a[i]] = -1 if a[i] in places else i
        seen: dict = {}
        for j in range(b0, b1):
            seen[b[j]] = -1 if b[j] in seen else j
        both = sorted((places[x], j) for x, j in seen.items() if j >= 0 and places.get(x, -1) >= 0)
        # longest rising subsequence of the places in b
        ends: list[int] = []
        at: list[int] = []
        back: list[int] = []
        for n, (_, j) in enumerate(both):
            k = bisect_left(ends, j)
            back.append(at[k - 1] if k else -1)
            if k == len(ends):
                ends.append(j)
                at.append(n)
            else:
                ends[k], at[k] = j, n
        if not at:
            continue
        chain, n = [], at[-1]
        while n >= 0:
            chain.append(both[n])
            n = back[n]
        i0, j0 = a0, b0
        for i, j in reversed(chain):
            todo.append((i0, i, j0, j))
            out.append((i, j))
            i0, j0 = i + 1, j + 1
        todo.append((i0, a1, j0, b1))
    return sorted(out)


def repeated_lines(a_hash, a_words, b_hash, b_words, least: int = MIN_WORDS) -> list[int]:
    """Lines of the later document b that lie in a block of least words or more that a has too: blocks that patience diff aligns, and
    what it cannot see or set against a second time (passages without a line unique on both sides, further copies, moved blocks)."""
    ai = [i for i, n in enumerate(a_words) if n]
    bi = [j for j, n in enumerate(b_words) if n]
    out: set[int] = set()
    block: list[int] = []
    last = None
    for i, j in [*patience([a_hash[i] for i in ai], [b_hash[j] for j in bi]), (-9, -9)]:
        if last != (i - 1, j - 1):
            if sum(b_words[x] for x in block) >= least:
                out.update(block)
            block = []
        if j >= 0:
            block.append(bi[j])
        last = (i, j)
    if len(out) < len(bi):
        known = set(runs(a_hash, a_words, least).values())
        for (j, k), key in runs(b_hash, b_words, least).items():
            if key in known:
                out.update(bi[j:k])
    return sorted(out)


def runs(hashes, words, least: int = MIN_WORDS) -> dict[tuple[int, int], int]:
    """Keys of the shortest runs of least words or more, from each line with words onwards and from each back: {(first, end): key},
    places counted among the lines with words. Every line of a block of least words or more lies in such a run of that block."""
    at = [i for i, n in enumerate(words) if n]
    ends = np.cumsum([0, *(words[i] for i in at)])
    onwards = zip(range(len(at)), np.searchsorted(ends, ends[:-1] + least).tolist())
    back = zip((np.searchsorted(ends, ends[1:] - least, "right") - 1).tolist(), range(1, len(at) + 1))
    raw = np.array([hashes[i] for i in at], np.int64).tobytes()
    return {(i, k): xxhash.xxh64_intdigest(raw[8 * i : 8 * k]) - 2**63 for i, k in {*onwards, *back} if i >= 0 and k <= len(at)}


def sequences(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """(doc_id, th, hashes, words, runs) of each document that has an id."""

    def score(texts):
        got = [line_hashes(t) for t in texts]
        return {"th": np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), 42) for t in texts], np.uint64).view(np.int64), "hashes": [g[0] for g in got], "words": [g[1] for g in got], "runs": [list(set(runs(*g, least).values())) for g in got]}

    return per_text(docs.where("doc_id is not null"), score, "th long, hashes array<long>, words array<int>, runs array<long>")


def pairs(seqs: DataFrame) -> DataFrame:
    """(doc_id, th, p_id, p_th): each later document with an earlier one that shares a run of lines with it."""
    # a document's runs are distinct here, so no group of holders is gathered anywhere
    held = seqs.select("doc_id", "th", F.explode("runs").alias("run"))
    counted = held.groupBy("run").agg(F.min(F.struct("doc_id", "th")).alias("first"), F.count("*").alias("n")).where("n > 1")
    shared = write_table(counted, "shared")  # so that both sides of the join are dealt for it alone, and a hot run can be split
    star = held.join(shared, "run").where("struct(doc_id, th) > first")
    return star.select("doc_id", "th", F.col("first.doc_id").alias("p_id"), F.col("first.th").alias("p_th")).distinct()


def removals(seqs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """(doc_id, th, gone array<int>): the lines, from 0, that leave each document that loses any."""
    earlier = seqs.select(F.col("doc_id").alias("p_id"), F.col("th").alias("p_th"), F.col("hashes").alias("p_hashes"), F.col("words").alias("p_words"))
    both = pairs(seqs).join(earlier, ["p_id", "p_th"]).join(seqs, ["doc_id", "th"]).select("doc_id", "th", "p_hashes", "p_words", "hashes", "words")
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("gone", pa.list_(pa.int32()))])

    def align(batches):
        for b in sliced(batches, 128):  # few pairs at a time become Python lists
            gone = [repeated_lines(*x, least) for x in zip(*(b.column(i).to_pylist() for i in range(2, 6)))]
            some = pa.array([bool(g) for g in gone], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(gone, pa.list_(pa.int32()))], schema=schema).filter(some)

    found = both.mapInArrow(align, "doc_id long, th long, gone array<int>")
    return found.groupBy("doc_id", "th").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))


def without_repeats(docs: DataFrame, least: int = MIN_WORDS, rare: int = RARE) -> DataFrame:
    """(_row: the columns of docs, text: what stays, _lines, _gone: numbers of lines)."""
    seqs = write_table(sequences(docs, least).dropDuplicates(["doc_id", "th"]), "lines")
    gone = removals(seqs, least).select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), F.col("gone").alias("_gone"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64(text).alias("_th"))
    lines = F.split(F.col("_row.text"), "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))  # by hash, so linear in the lines
    kept = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    return keyed.join(gone, ["_id", "_th"], "left").select(
        "_row",
        F.when(F.col("_gone").isNull(), F.col("_row.text")).otherwise(kept).alias("text"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("_lines"),
        F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long").alias("_gone"),
    )


def dedup_lines(docs: DataFrame, least: int = MIN_WORDS, rare: int = RARE) -> DataFrame:
    """docs with the texts that stay. Documents of whose lines nothing but blanks stays go."""
    out = without_repeats(docs, least, rare).where((F.col("_gone") == 0) | (F.trim(F.regexp_replace("text", r"[\x09-\x0D]", " ")) != ""))
    return out.select(*(F.col("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_chars, kept_sha256)."""
    out = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return out.select(F.col("_row.doc_id").alias("doc_id"), F.col("_lines").alias("n_lines"), F.col("_gone").alias("n_removed"), F.length(text).cast("long").alias("kept_chars"), F.sha2(text.cast("binary"), 256).alias("kept_sha256"))
