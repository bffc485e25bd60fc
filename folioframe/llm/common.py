"""What the operators of this subpackage share: reading, shared storage, Arrow helpers."""

from __future__ import annotations

import atexit
import ctypes
import functools
import gc
import sys
import tempfile
import types
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only where the session names none (tests) is one made."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="folioframe-")
        spark.conf.set("spark.checkpoint.dir", found)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def _forget(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may be gone at exit
        pass


def drop_table(df: DataFrame) -> None:
    """Removes a table made by write_table() once nothing will read it again."""
    path = getattr(df, "_folio_path", None)
    if path:
        _forget(df.sparkSession, path)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends there, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/folioframe-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    atexit.register(_forget, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._folio_path = path
    return out


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (doc_id long, text string), null texts as empty ones; further columns of any name are left out."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def sliced(batches, rows: int = 1024):
    """Arrow batches in slices, so that few texts at a time become Python strings."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def per_text(docs: DataFrame, score, schema: str, rows: int = 1024, done=None) -> DataFrame:
    """Adds what score(list of texts) returns (a dict of equal-length lists) to each doc_id, rows texts at a time. schema: DDL of those columns.
    done() is called at the end of a task."""
    ddl = f"doc_id long, {schema}"
    target = pa_schema(docs.sparkSession, ddl)

    def run(batches):
        for b in sliced(batches, rows):
            if b.num_rows:
                got = score(b.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(got[f.name], f.type) for f in list(target)[1:])], schema=target)
        if done:
            done()

    return id_text(docs).mapInArrow(run, ddl)


def give_back() -> None:
    """Memory that this process has freed but still holds goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library than glibc
        pass


def tidy(run):
    """run (batches to batches) with give_back() at the end of a task: a Python worker stays for later tasks, and beside stages without Python."""

    @functools.wraps(run)
    def task(batches):
        yield from run(batches)
        give_back()

    return task


def worker_cache(key, build):
    """A value that a Python worker builds once and keeps over its tasks (functions come by value, so their globals don't stay)."""
    kept = sys.modules.setdefault("_folioframe_kept", types.ModuleType("_folioframe_kept")).__dict__
    if key not in kept:
        kept[key] = build()
    return kept[key]


_TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}


def pa_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    return pa.schema([(name, _TYPES[kind]) for name, kind in (x.strip().split(" ", 1) for x in ddl.split(","))])
