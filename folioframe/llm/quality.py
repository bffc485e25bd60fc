"""Quality rules with an isolation forest on their statistics.

Each text gets rule statistics; two base rules fail it outright. The forest isolates rows by random
splits; short average path lengths are anomalous. Trees are grown on small subsamples of labelled rows, good
and bad alike, and each split is drawn from the range of the node's own rows. Subsamples are small so that junk, which makes up a
tenth of the rows, stays alone in them (with 256 rows a tree it is a crowd of its own and hides). They are drawn out of a pool of POOL rows, itself
drawn by hash from all, so that a tree's rows are a uniform draw of all labelled ones. The threshold counts every labelled row: the anomaly score that best parts good from bad ones while the share FALSE_ALARMS of good ones at most is lost.

The forest sees word length, symbols a word and variety of words. Repeats, copied lines and digits are left to the base rules and to
the statistics' readers: among good rows they vary more than junk does, so splits on them isolate the wrong rows.

Nulls and empty texts have no words and fail the base rule. Rows repeat as they came: statistics follow from the text alone, so equal texts
get equal verdicts. A very long text is one pass over its bytes and one sort of its words. Without labelled rows of both kinds the forest rejects nothing. An empty table gives an empty result. Further
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioframe.llm.common import pa_schema, per_text, table, write_table

#: Labelled rows that the trees' subsamples (TREES * SUBSAMPLE rows in all) are drawn from, by the hash of their id.
POOL = 32_768
TREES, SUBSAMPLE, SEED = 200, 32, 7
FALSE_ALARMS = 0.005
#: Ranges of scores that are summed before the scores inside one.
BINS = 4096

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_digits long, n_upper long, n_kinds long, n_marks long"
FEATURES = ("mean_word", "symbols", "kinds")

_SYMBOLS, _DIGITS, _MARKS = b"#*$%&|<>", b"0123456789", b".,;:!?"
_UPPER = bytes(range(65, 91))


def repeated_words(ids: np.ndarray, kinds: int) -> int:
    """Words that lie in a 3-word window found twice or more."""
    if len(ids) < 4:
        return 0
    pair = ids[:-2] * kinds + ids[1:-1]
    if kinds > 2_000_000:
        pair = np.unique(pair, return_inverse=True)[1]
    key = pair * kinds + ids[2:]
    order = np.argsort(key, kind="stable")
    same = np.diff(key[order]) == 0
    hit = np.zeros(len(key), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    cover = np.zeros(len(ids), bool)
    cover[:-2] |= hit
    cover[1:-1] |= hit
    cover[2:] |= hit
    return int(cover.sum())


def statistics(text: str) -> tuple[int, ...]:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    blanks = sum(map(raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    less = lambda chars: len(raw) - len(raw.translate(None, chars))
    return len(words), len(text) - blanks, less(_SYMBOLS), len(lines) - len(set(lines)), repeated_words(ids, len(seen)), len(lines), less(_DIGITS), less(_UPPER), len(seen), less(_MARKS)


def features(s: np.ndarray) -> np.ndarray:
    """Rows of STATS as the forest sees them."""
    words, chars, symbols, kinds = (s[:, i].astype(float) for i in (0, 1, 2, 8))
    w = np.maximum(words, 1)
    return np.stack([chars / w, symbols / (symbols + w / 10), np.log(np.maximum(kinds, 1)) / np.log(w + 1)], 1)


def _c(n):
    """Average depth at which a search in a tree of n rows ends."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def fit_forest(x: np.ndarray, trees: int = TREES, sub: int = SUBSAMPLE, seed: int = SEED) -> dict:
    """Trees as flat arrays: feature (-1 at a leaf), cut, left child (right is the next one), and path length at a leaf."""
    rng = np.random.default_rng(seed)
    sub = min(sub, len(x))
    limit = int(np.ceil(np.log2(max(sub, 2))))
    out = []
    for _ in range(trees if sub else 0):
        feature, cut, left, length = [], [], [], []

        def add():
            feature.append(-1), cut.append(0.0), left.append(0), length.append(0.0)

        add()
        todo = [(0, rng.choice(len(x), sub, replace=False), 0)]
        while todo:
            node, at, depth = todo.pop()
            low, high = x[at].min(0), x[at].max(0)
            free = np.flatnonzero(high > low)
            if depth >= limit or len(at) <= 1 or not len(free):
                length[node] = depth + float(_c(len(at)))
                continue
            f = int(rng.choice(free))
            feature[node], cut[node], left[node] = f, float(rng.uniform(low[f], high[f])), len(feature)
            add(), add()
            below = x[at, f] <= cut[node]
            todo += [(left[node], at[below], depth + 1), (left[node] + 1, at[~below], depth + 1)]
        out.append((np.array(feature), np.array(cut), np.array(left), np.array(length)))
    return {"trees": out, "norm": float(_c(sub)) or 1.0}


def anomaly(forest: dict, x: np.ndarray) -> np.ndarray:
    """0 to 1; the shorter the paths, the higher."""
    total = np.zeros(len(x))
    rows = np.arange(len(x))
    for feature, cut, left, length in forest["trees"]:
        node = np.zeros(len(x), np.int64)
        while True:
            f = feature[node]
            inner = f >= 0
            if not inner.any():
                break
            step = left[node] + (x[rows, np.maximum(f, 0)] > cut[node])
            node = np.where(inner, step, node)
        total += length[node]
    return 2.0 ** (-total / max(len(forest["trees"]), 1) / forest["norm"])


def threshold(score: np.ndarray, good: np.ndarray, false_alarms: float = FALSE_ALARMS) -> float:
    """Rows at or above it are rejected: of the cuts that lose that share of good rows at most, the one with the best balanced accuracy."""
    if not good.any() or good.all():
        return 2.0
    cuts = np.unique(np.append(score[~good], 2.0))
    g, b = np.sort(score[good]), np.sort(score[~good])
    lost = 1 - np.searchsorted(g, cuts) / len(g)
    caught = 1 - np.searchsorted(b, cuts) / len(b)
    value = np.where(lost <= false_alarms, caught - lost, -1)
    return float(cuts[int(np.argmax(value))])


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id and STATS)."""

    def score(texts):
        names = [x.split()[0] for x in STATS.split(", ")]
        rows = [statistics(t) for t in texts]
        return {n: [r[i] for r in rows] for i, n in enumerate(names)}

    return per_text(docs, score, STATS)


def base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _names() -> list[str]:
    return [x.split()[0] for x in STATS.split(", ")]


def _sample(df: DataFrame, rows: int) -> np.ndarray:
    """rows at most, drawn by a hash: each executor sends its smallest hashes only."""
    got = df.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id", *[c for c in df.columns if c != "doc_id"]).limit(rows).drop("doc_id").toArrow()
    return np.stack([got.column(i).to_numpy().astype(np.int64) for i in range(got.num_columns)], 1) if got.num_rows else np.zeros((0, got.num_columns), np.int64)


def exact_threshold(scored: DataFrame, false_alarms: float = FALSE_ALARMS) -> float:
    """threshold() of all rows of scored (anomaly, quality), in whole numbers: sums over BINS ranges first, then over the scores inside each range."""
    counts = [F.sum(F.col("quality").cast("long")).alias("g"), F.sum(F.lit(1).cast("long") - F.col("quality").cast("long")).alias("b")]
    each = write_table(scored.groupBy("anomaly").agg(*counts).withColumn("bin", F.floor(F.col("anomaly") * BINS)), "scores")
    above = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    bins = each.groupBy("bin").agg(F.sum("g").alias("bg"), F.sum("b").alias("bb"))
    bins = bins.select("bin", *(F.coalesce(F.sum(f"b{x}").over(above), F.lit(0)).alias(f"{x}0") for x in "gb"))
    good, bad = each.agg(F.sum("g"), F.sum("b")).first()
    if not good or not bad:
        return 2.0
    inside = Window.partitionBy("bin").orderBy(F.desc("anomaly")).rowsBetween(Window.unboundedPreceding, 0)
    cuts = each.join(F.broadcast(bins), "bin").select("anomaly", "b", *((F.col(f"{x}0") + F.sum(x).over(inside)).alias(f"n{x}") for x in "gb"))
    value = F.col("nb").cast("decimal(19,0)") * good - F.col("ng").cast("decimal(19,0)") * bad
    best = cuts.where((F.col("b") > 0) & (F.col("ng") <= false_alarms * good)).select("anomaly", value.alias("value")).orderBy(F.desc("value"), "anomaly").first()
    return best.anomaly if best and best.value >= 0 else 2.0


def fit(stats: DataFrame, labels: DataFrame) -> dict:
    """Forest and threshold from the labelled rows that pass the base rules; the driver gets the pool and one cut."""
    passed = stats.where(~base_failed())
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    marked = write_table(passed.select("doc_id", *_names()).join(known, "doc_id").select("doc_id", *_names(), "quality"), "marked")
    if marked.select("quality").distinct().count() < 2:
        return {"forest": {"trees": [], "norm": 1.0}, "cut": 2.0}
    forest = fit_forest(features(_sample(marked, POOL)))
    return {"forest": forest, "cut": exact_threshold(_scored(marked, forest, "quality"))}


def _scored(stats: DataFrame, forest: dict, *more: str) -> DataFrame:
    """(doc_id, STATS, anomaly, more: further columns of whole numbers)."""
    ddl = f"doc_id long, {STATS}, " + "".join(f"{x} long, " for x in more) + "anomaly double"
    schema = pa_schema(stats.sparkSession, ddl)
    shared = stats.sparkSession.sparkContext.broadcast(forest)

    def run(batches):
        for b in batches:
            if b.num_rows:
                x = np.stack([b.column(i).to_numpy() for i in range(1, 11)], 1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(anomaly(shared.value, features(x)))], schema=schema)

    return stats.select("doc_id", *_names(), *(F.col(x).cast("long").alias(x) for x in more)).mapInArrow(run, ddl)


def judge(stats: DataFrame, model: dict) -> DataFrame:
    scored = _scored(stats, model["forest"]).withColumn("base_failed", base_failed())
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < F.lit(model["cut"])))


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, STATS, anomaly, base_failed, kept) for each document."""
    stats = write_table(measure(docs), "stats")
    return judge(stats, fit(stats, labels))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
