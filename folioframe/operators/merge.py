"""Keyed merges as full outer joins: no table format is needed, and a merge is a function from two tables to one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, keys: list[str], keep_old: tuple[str, ...] = (), only: list[str] | None = None) -> DataFrame:
    """New values over old ones, never null over a value. keep_old: columns whose old value stays; only: columns that the new side may
    write. Adds changed: whether a row is new or any of its values differ."""
    cols = [c for c in old.columns if c not in keys]
    write = [c for c in cols if (only is None or c in only) and c in new.columns]
    a = old.select(*keys, *(F.col(c).alias(f"_o_{c}") for c in cols), F.lit(True).alias("_old"))
    b = new.select(*keys, *(F.col(c).alias(f"_n_{c}") for c in write), F.lit(True).alias("_new"))
    j = a.join(b, keys, "full_outer")
    pick = {c: (F.coalesce(f"_o_{c}", f"_n_{c}") if c in keep_old else F.coalesce(f"_n_{c}", f"_o_{c}")) if c in write else F.col(f"_o_{c}") for c in cols}
    differs = F.lit(False)
    for c in cols:
        differs = differs | ~pick[c].eqNullSafe(F.col(f"_o_{c}"))
    return j.select(*keys, *(x.alias(c) for c, x in pick.items()), (F.col("_old").isNull() | differs).alias("changed"))


def last_wins(rows: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The last row of each key; order: the columns that later rows have greater."""
    w = Window.partitionBy(*keys).orderBy(*(c.desc() for c in order))
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def match_records(ground: DataFrame, system: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer 1:1 match with status matched, missing or extra, values of both sides as structures."""
    g = ground.select(*keys, F.struct(*[c for c in ground.columns if c not in keys]).alias("ground"))
    s = system.select(*keys, F.struct(*[c for c in system.columns if c not in keys]).alias("system"))
    status = F.when(F.col("system").isNull(), "missing").when(F.col("ground").isNull(), "extra").otherwise("matched")
    return g.join(s, keys, "full_outer").withColumn("status", status)


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def diff_runs(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Each key's value in two runs: same, changed, only in a, only in b."""
    j = a.select(*keys, F.col(value).alias("a")).join(b.select(*keys, F.col(value).alias("b")), keys, "full_outer")
    status = F.when(F.col("b").isNull(), "only_a").when(F.col("a").isNull(), "only_b").when(F.col("a") == F.col("b"), "same").otherwise("changed")
    return j.withColumn("status", status)
