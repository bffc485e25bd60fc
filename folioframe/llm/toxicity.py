"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text: its words, pairs of neighbours, and pairs with one word between, lower-cased and hashed into
2**BITS places, each counted once. FTRL-proximal keeps a learning rate for each coordinate; its L1 term leaves
most weights at zero, so the model is two short arrays, broadcast to score.

Training rows: TRAIN_ROWS labelled documents at most, drawn by the hash of their id, never one with
crc32(doc_id) mod FOLDS = 0, and fewer where they would hold more than TRAIN_PLACES places in all; of repeated rows of an id
the least text counts. So what reaches the driver has a bound in bytes too. Rates and penalties were chosen on a quarter
of the training rows that was set aside for it, never on held-out ones. Only texts and the toxic label are used. Nulls and empty texts score as
the bias alone. A very long text has 2**BITS places at most. Rows repeat as they came and equal texts score alike. Labels other than 0 and 1 are left out, of repeated ones the
higher counts. Without labels every score is 0. Rows without a doc_id count as held out. An empty table
gives an empty result. Further columns are ignored by score() and kept by keep_clean().
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioframe.llm.common import pa_schema, per_text, sliced, table, write_table

BITS, FOLDS, TRAIN_ROWS, TRAIN_PLACES, EPOCHS = 20, 5, 16_384, 24_000_000, 2
#: Training rows of a file of the table that the driver reads. Rows have a bound, so files have one too, whatever the shuffle's partitions.
FILE_ROWS = 1024
ALPHA, BETA, L1, L2 = 1.0, 1.0, 12.0, 0.1
#: Toxic rows weigh (clean rows / toxic rows) ** BALANCE.
BALANCE = 0.5
_MARKS = b"\t\n\x0b\x0c\r.,;:!?\"()[]{}<>|*#$%&/\\=+~`"
_PUNCT = bytes.maketrans(bytes(range(65, 91)) + _MARKS, bytes(range(97, 123)) + b" " * len(_MARKS))


def hashed(text: str) -> np.ndarray:
    """Places of all features of a text, with repeats."""
    words = text.encode("utf-8", "surrogatepass").translate(_PUNCT).split()
    h = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    near = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    skip = (h[:-2] * np.uint64(0x165667B19E3779F9)) ^ (h[2:] * np.uint64(0x27D4EB2F165667C5))
    every = np.concatenate([h * np.uint64(0xFF51AFD7ED558CCD), near, skip])
    return (every >> np.uint64(64 - BITS)).astype(np.int32)


def train(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS, seed: int = 11) -> dict:
    """Sparse weights {at, w, bias}; rows are (distinct places, label)."""
    n = np.zeros(1 << BITS)
    z = np.zeros(1 << BITS)
    zb = nb = 0.0
    rng = np.random.default_rng(seed)

    def weights(zz, nn):
        return np.where(np.abs(zz) > L1, (np.sign(zz) * L1 - zz) / ((BETA + np.sqrt(nn)) / ALPHA + L2), 0.0)

    toxic = sum(y for _, y in rows)
    weight = max(1.0, ((len(rows) - toxic) / toxic) ** BALANCE) if toxic else 1.0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)).tolist():
            at, y = rows[i]
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            wb = -zb / ((BETA + nb**0.5) / ALPHA)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + wb, -30, 30)))
            g = (p - y) * (weight if y else 1.0)
            step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[at] = zi + g - step * w
            n[at] = ni + g * g
            zb += g - ((nb + g * g) ** 0.5 - nb**0.5) / ALPHA * wb
            nb += g * g
    w = weights(z, n)
    at = np.flatnonzero(w)
    return {"at": at.astype(np.int32), "w": w[at], "bias": float(-zb / ((BETA + nb**0.5) / ALPHA)) if rows else -40.0}


def scorer(model: dict):
    dense = np.zeros(1 << BITS, np.float32)
    dense[model["at"]] = model["w"]

    def one(text: str) -> float:
        at = hashed(text)
        at = np.unique(at[dense[at] != 0])
        return float(1 / (1 + np.exp(-np.clip(dense[at].sum(dtype=np.float64) + model["bias"], -40, 40))))

    return one


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> dict:
    """Trains on the driver: rows labelled texts at most, as hashed features."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where("toxic in (0, 1) and doc_id is not null").where(~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # at most rows ids: small enough to broadcast at any input size
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).join(F.broadcast(drawn), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.min("toxic").alias("toxic"))
    ddl = "doc_id long, toxic long, n long, at binary"
    schema = pa_schema(docs.sparkSession, ddl)

    def places(batches):
        import pyarrow as pa

        for b in sliced(batches):
            at = [np.unique(hashed(t or "")) for t in b.column(1).to_pylist()]
            if at:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(list(map(len, at)), pa.int64()), pa.array([x.tobytes() for x in at], pa.binary())], schema=schema)

    found = write_table(texts.select("doc_id", "text", "toxic").coalesce(-(-rows // FILE_ROWS)).mapInArrow(places, ddl), "places")
    by_hash = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    within = found.select("doc_id", F.sum("n").over(by_hash).alias("sum")).where(F.col("sum") <= TRAIN_PLACES)  # rows ids at most
    within = write_table(within, "within")
    every, begin, got = np.empty(within.agg(F.max("sum")).first()[0] or 0, np.int32), 0, []
    # a partition at a time, into one array: neither the JVM nor Python ever holds the places twice
    for r in found.join(F.broadcast(within.select("doc_id")), "doc_id").select("doc_id", "toxic", "n", "at").toLocalIterator():
        every[begin : begin + r.n] = np.frombuffer(r.at, np.int32)
        got.append((r.doc_id, begin, begin + r.n, r.toxic))
        begin += r.n
    return train([(every[x:y], toxic) for _, x, y, toxic in sorted(got)])


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score double)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts):
        one = scorer(shared.value)
        return {"score": [one(t) for t in texts]}

    return per_text(docs, run, "score double")


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    out = score(docs, fit(docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of docs, all columns, that are not predicted toxic."""
    import pyarrow as pa

    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    at = docs.columns.index("text")

    def run(batches):
        one = scorer(model.value)
        for b in sliced(batches):
            yield b.filter(pa.array([one(t or "") < 0.5 for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
