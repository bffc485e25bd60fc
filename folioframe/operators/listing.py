"""Listing, facets, search over page texts, overlays and roster joins."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioframe.functions import strings as S

BLANK = "(Blank)"


def run_batch_default(*values: Column) -> Column:
    """The first value that is filled, else Test."""
    return F.coalesce(*(F.nullif(F.trim(v), F.lit("")) for v in values), F.lit("Test"))


def run_batch_from_path(path: Column) -> tuple[Column, Column]:
    """Run and batch ids out of a path's segments, the last of each that fits."""
    seg = F.split(path, r"[/\\]+")

    def last(word):
        p = rf"(?i)^{word[0]}(?:{word[1:]})?_?(\d+)$"
        hits = F.filter(seg, lambda s: s.rlike(p))
        return F.coalesce(F.when(F.size(hits) > 0, F.concat(F.lit(word.capitalize()), F.regexp_extract(F.element_at(hits, F.greatest(F.size(hits), F.lit(1))), p, 1))), F.lit("Test"))

    return last("run"), last("batch")


def output_path(read_path: Column, chart: Column, raw: str = "Raw_Input", done: str = "Processed") -> Column:
    return F.concat_ws("/", F.regexp_replace(F.regexp_replace(read_path, r"/+$", ""), raw, done), chart)


def select(rows: DataFrame, q: str | None = None, equals: dict[str, list[str]] | None = None, after: tuple[str, str] | None = None) -> DataFrame:
    """Rows whose name holds q, whose columns are among the values given (null as "(Blank)"), and that changed on or after a day."""
    if q:
        rows = rows.where(F.contains(F.lower("name"), F.lit(q.lower())))
    for c, values in (equals or {}).items():
        rows = rows.where(F.coalesce(F.col(c), F.lit(BLANK)).isin(values))
    if after:
        rows = rows.where(F.col(after[0]) >= F.lit(after[1]).cast("date"))
    return rows


def page(rows: DataFrame, order: list[Column], offset: int, limit: int) -> DataFrame:
    """A page of a listing; order must end in a unique column."""
    return rows.orderBy(*order).offset(offset).limit(limit)


def totals(rows: DataFrame, pages: str) -> DataFrame:
    return rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(pages), F.lit(0)).alias("pages"))


def facets(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(facet, value, n): the options of each column in one pass over the rows."""
    each = F.array(*(F.struct(F.lit(c).alias("facet"), F.coalesce(F.col(c).cast("string"), F.lit(BLANK)).alias("value")) for c in columns))
    return rows.select(F.explode(each).alias("f")).groupBy("f.facet", "f.value").agg(F.count("*").alias("n"))


def search(pages: DataFrame, phrase: str, whole: bool = True) -> DataFrame:
    """Pages that hold a phrase, with the number of hits. A plain contains() on the first word goes before the pattern."""
    first = phrase.split()[0].lower()
    hits = S.whole_word(F.col("text"), phrase) if whole else F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit("(?i)" + r"\s+".join(re.escape(w) for w in phrase.split()))).cast("long")
    return pages.where(F.contains(F.lower("text"), F.lit(first))).withColumn("hits", hits).where("hits > 0")


def snippets(pages: DataFrame, phrase: str, limit: int = 3, around: int = 60) -> DataFrame:
    """(page_id, nth, snippet): the first hits of each page with what stands around them."""
    body = r"\s+".join(re.escape(w) for w in phrase.split())
    hits = F.regexp_extract_all(F.col("text"), F.lit(rf"(?is).{{0,{around}}}\b{body}\b.{{0,{around}}}"), F.lit(0))
    return pages.select("page_id", F.posexplode(F.slice(hits, 1, limit)).alias("nth", "snippet")).withColumn("nth", F.col("nth").cast("long"))


def rollup(found: DataFrame, keys: list[str]) -> DataFrame:
    """Hits and pages of each key prefix, the grand total included."""
    return found.rollup(*keys).agg(F.sum("hits").alias("hits"), F.count("*").alias("pages"))


def overlay(skeleton: DataFrame, rows: DataFrame, values: list[str]) -> DataFrame:
    """Rows of a sheet onto pages: by file name, else by page number."""
    by_name = rows.where("page_name is not null").dropDuplicates(["chart", "page_name"]).select("chart", "page_name", *(F.col(v).alias(f"_n_{v}") for v in values))
    by_no = rows.where("page_no is not null").dropDuplicates(["chart", "page_no"]).select("chart", "page_no", *(F.col(v).alias(f"_p_{v}") for v in values))
    j = skeleton.join(by_name, ["chart", "page_name"], "left").join(by_no, ["chart", "page_no"], "left")
    return j.select("chart", "page_no", "page_name", *(F.coalesce(f"_n_{v}", f"_p_{v}").alias(v) for v in values))


def merge_sources(db: DataFrame, disk: DataFrame) -> DataFrame:
    """Charts of a database and of a disk: the database's values, the disk's where they are zero or null, and charts of the disk alone."""
    a = db.select("chart", F.col("pages").alias("_a"))
    b = disk.select("chart", F.col("pages").alias("_b"))
    return a.join(b, "chart", "full_outer").select("chart", F.when(F.col("_a") > 0, F.col("_a")).otherwise(F.col("_b")).alias("pages"))


def first_per_key(rows: DataFrame, keys: list[str], order: Column, values: list[str]) -> DataFrame:
    """The first row of each key, as aggregates."""
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*values), order).alias("_v")).select(*keys, "_v.*")


def top_paths(paths: DataFrame, keys: list[str], group: str, score: str, k: int, per_group: int, tie: str) -> DataFrame:
    """The k best rows of each key with at most per_group of one group."""
    a = F.row_number().over(Window.partitionBy(*keys, group).orderBy(F.col(score).desc(), tie))
    p = paths.withColumn("_g", a).where(F.col("_g") <= per_group)
    b = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(score).desc(), tie))
    return p.withColumn("place", b.cast("long")).where(F.col("place") <= k).drop("_g")


def lead_winner(scores: DataFrame, keys: list[str], label: str, score: str, least: float, margin: float) -> DataFrame:
    """The best label where its score is enough and its lead over the next one too."""
    top = F.reverse(F.array_sort(F.collect_list(F.struct(F.col(score).alias("s"), F.col(label).alias("l")))))
    g = scores.groupBy(*keys).agg(top.alias("t"))
    a, b = F.get("t", F.lit(0)), F.get("t", F.lit(1))
    ok = (a["s"] >= least) & (a["s"] - F.coalesce(b["s"], F.lit(0.0)) >= margin)
    return g.select(*keys, F.when(ok, a["l"]).alias(label))
