"""Ordered sequences of pages: runs, carries, attachments, markers and orders, all as windows inside a chart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_page(chart: str = "chart", page: str = "page_no"):
    return Window.partitionBy(chart).orderBy(page)


def runs(pages: DataFrame, key: Column, name: str = "visit", null_alone: bool = True) -> DataFrame:
    """Numbers runs of neighbouring pages with the same key; pages without one stand alone."""
    prev = F.lag(key).over(by_page())
    first = F.row_number().over(by_page()) == 1
    same = key.eqNullSafe(prev) & (key.isNotNull() if null_alone else F.lit(True))
    return pages.withColumn("_new", F.when(first | ~same, 1).otherwise(0)).withColumn(name, F.sum("_new").over(by_page()).cast("long")).drop("_new")


def junk_runs(pages: DataFrame) -> DataFrame:
    """Length and mean confidence of runs of junk pages; only main pages part runs, blank ones are looked through."""
    island = F.sum(F.when(F.col("kind") == "main", 1).otherwise(0)).over(by_page())
    p = pages.withColumn("island", island.cast("long")).where("kind = 'junk'")
    return p.groupBy("chart", "island").agg(F.count("*").alias("pages"), F.round(F.avg("confidence"), 4).alias("confidence"), F.min("page_no").alias("first"), F.max("page_no").alias("last"))


def blanks_between(pages: DataFrame) -> DataFrame:
    """Blank pages between each scored page and the scored page before it."""
    p = pages.withColumn("blanks", F.sum(F.when(F.col("kind") == "blank", 1).otherwise(0)).over(by_page()))
    s = p.where("kind <> 'blank'")
    return s.select("chart", "page_no", F.lag("page_no").over(by_page()).alias("prev"), (F.col("blanks") - F.lag("blanks").over(by_page())).cast("long").alias("blanks"))


def document_position(pages: DataFrame, doc: str) -> DataFrame:
    """Place in the document, and standalone, first, last or continue."""
    w = Window.partitionBy("chart", doc).orderBy("page_no")
    seq, n = F.row_number().over(w), F.count("*").over(Window.partitionBy("chart", doc))
    place = F.when(n == 1, "standalone").when(seq == 1, "first").when(seq == n, "last").otherwise("continue")
    return pages.withColumns({"seq": seq.cast("long"), "position": place})


def transparent_attach(pages: DataFrame, doc: str) -> DataFrame:
    """Pages that are not main join the document before them, or the one around them; before the first document they join the next."""
    own = F.when(F.col("kind") == "main", F.col(doc))
    before = F.last(own, ignorenulls=True).over(by_page().rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(own, ignorenulls=True).over(by_page().rowsBetween(1, Window.unboundedFollowing))
    return pages.withColumn("attached", F.coalesce(own, before, after)).withColumn("inside", own.isNull() & (before == after))


def document_carry(pages: DataFrame, doc: str, columns: dict[str, bool]) -> DataFrame:
    """Values of a document for all its pages: from its first page that has one (True), or from its first page (False)."""
    w = Window.partitionBy("chart", doc).orderBy("page_no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return pages.withColumns({f"doc_{c}": F.first(c, ignorenulls=skip).over(w) for c, skip in columns.items()})


def neighbor_keep(pages: DataFrame) -> DataFrame:
    """Visual pages ruled junk beside a kept page are kept."""
    flag = F.col("flag")
    near = (F.lag(flag).over(by_page()) == "keep") | (F.lead(flag).over(by_page()) == "keep")
    return pages.withColumn("final_flag", F.when(F.col("visual") & (flag == "junk") & F.coalesce(near, F.lit(False)), "keep").otherwise(flag))


def edge_words(text: Column, n: int) -> tuple[Column, Column]:
    w = F.filter(F.split(text, r"\s+"), lambda x: x != "")
    return F.array_join(F.slice(w, 1, n), " "), F.array_join(F.slice(w, F.greatest(F.size(w) - n + 1, F.lit(1)), F.lit(n)), " ")


def tail_head(text: Column) -> tuple[Column, Column]:
    """The last two and the first two lines with text."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_join(F.slice(lines, F.greatest(F.size(lines) - 1, F.lit(1)), F.lit(2)), " "), F.array_join(F.slice(lines, 1, 2), " ")


def running_headers(lines: DataFrame) -> DataFrame:
    """Header lines (chart, page_no, line) that stand on more than one page of the chart; counted by aggregation, so a line on every page is one group of partial sums."""
    n = lines.groupBy("chart", "line").agg(F.countDistinct("page_no").alias("pages"))
    return n.where("pages > 1")


def propagate(pages: DataFrame, value: str, printed: Column) -> DataFrame:
    """The last value established before a page, where the page prints it."""
    known = F.last(value, ignorenulls=True).over(by_page().rowsBetween(Window.unboundedPreceding, -1))
    p = pages.withColumn("_known", known)
    return p.withColumn(f"{value}_final", F.coalesce(F.col(value), F.when(printed, F.col("_known")))).drop("_known")


def slot_reorder(pages: DataFrame, marker: str, family: list[str]) -> DataFrame:
    """Pages with a marker are put in marker order within the places that their family takes; others stay."""
    has = pages.where(F.col(marker).isNotNull())
    slots = Window.partitionBy("chart", *family).orderBy("page_no")
    ranks = Window.partitionBy("chart", *family).orderBy(marker, "page_no")
    a = has.select("chart", *family, "page_no", F.row_number().over(slots).alias("_r")).withColumnRenamed("page_no", "new_no")
    b = has.select("chart", *family, "page_no", F.row_number().over(ranks).alias("_r"))
    placed = b.join(a, ["chart", *family, "_r"]).select("chart", "page_no", "new_no")
    return pages.join(placed, ["chart", "page_no"], "left").withColumn("new_no", F.coalesce("new_no", "page_no"))


def fenced_order(pages: DataFrame, num: str, total: str, most: int = 5) -> DataFrame:
    """As slot_reorder() by the "of total" family; a family in which two pages claim one number, or a page would move by more than most, is held."""
    out = slot_reorder(pages, num, [total])
    fam = Window.partitionBy("chart", total)
    out = out.withColumn("_same", F.count("*").over(Window.partitionBy("chart", total, num))).withColumn("_move", F.abs(F.col("new_no") - F.col("page_no")))
    held = F.col(num).isNotNull() & ((F.max("_same").over(fam) > 1) | (F.max("_move").over(fam) > most))
    return out.withColumn("held", held).withColumn("new_no", F.when(F.col("held"), F.col("page_no")).otherwise(F.col("new_no"))).drop("_same", "_move")


def cover_last(pages: DataFrame, is_cover: Column) -> DataFrame:
    w = Window.partitionBy("chart").orderBy(is_cover.cast("int"), "page_no")
    return pages.withColumn("new_no", F.row_number().over(w).cast("long"))


def order_confidence(placed: DataFrame, least: int = 3) -> DataFrame:
    """Share of marked pages that did not move, where there are enough of them."""
    g = placed.groupBy("chart").agg(F.count("*").alias("n"), F.avg((F.col("new_no") == F.col("page_no")).cast("double")).alias("share"))
    return g.select("chart", F.when(F.col("n") >= least, F.round("share", 4)).alias("confidence"))


def page_ranges(pages: DataFrame, keys: list[str]) -> DataFrame:
    """1, 2, 3, 5 as "1-3, 5": page number less its rank is the same inside a run."""
    p = pages.select(*keys, "page_no").distinct()
    p = p.withColumn("_i", F.col("page_no") - F.row_number().over(Window.partitionBy(*keys).orderBy("page_no")))
    g = p.groupBy(*keys, "_i").agg(F.min("page_no").alias("a"), F.max("page_no").alias("b"))
    text = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat(F.col("a").cast("string"), F.lit("-"), F.col("b").cast("string")))
    return g.select(*keys, "a", text.alias("t")).groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("a", "t"))), lambda x: x["t"]), ", ").alias("ranges"))
