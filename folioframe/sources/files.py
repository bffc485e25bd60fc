"""Sources: page images, marked text files, JSON and CSV with header synonyms. Listing and reading are Spark's own, so any store will do."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.functions.strings import ascii_marks

IMAGES = "*.{jpg,jpeg,png,tif,tiff,bmp,JPG,JPEG,PNG,TIF,TIFF,BMP}"
RUN_BATCH = r"(?i)metadata_r(\d+)_b(\d+)\.csv$"


def natural_key(path: Column) -> list[Column]:
    """Sort keys by which page2 comes before page10."""
    name = F.element_at(F.split(path, "/"), -1)
    return [F.regexp_replace(name, r"\d+", "#"), F.regexp_extract(name, r"(\d+)(?!.*\d)", 1).try_cast("long"), name]


def images(spark: SparkSession, folder: str) -> DataFrame:
    """(path, chart, page_name, length) of all images under a folder; the chart is the folder they lie in. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", IMAGES).load(folder)
    parts = F.split("path", "/")
    return files.select("path", F.element_at(parts, -2).alias("chart"), F.element_at(parts, -1).alias("page_name"), "length")


def charts(files: DataFrame) -> DataFrame:
    return files.groupBy("chart").agg(F.count("*").alias("pages"))


def parse_marked(texts: DataFrame, mark: str = r"=====\s*(.+?)\s*=====") -> DataFrame:
    """(path, page_name, text): the pages of files that hold many, each behind a mark line. Only \\n ends a line, and white space at the start
    of a text stays."""
    pieces = F.split("value", r"(?md)^" + mark.replace("(.+?)", ".+?") + r"(?:[ \t\r]*\n)?")
    names = F.regexp_extract_all("value", F.lit(r"(?md)^" + mark), F.lit(1))
    z = F.arrays_zip(names.alias("name"), F.slice(pieces, 2, F.size(pieces)).alias("text"))
    text = F.regexp_replace(F.regexp_replace("z.text", ascii_marks(r"\s+$"), ""), r"(?md)^\\(\\*=====)", "$1")
    return texts.select("path", F.explode(z).alias("z")).select("path", F.col("z.name").alias("page_name"), text.alias("text"))


def marked_texts(spark: SparkSession, folder: str) -> DataFrame:
    return parse_marked(spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value"))


def unwrap(raw: Column) -> Column:
    """Content of a column that holds page JSON or plain text."""
    return F.when(F.ltrim(raw).startswith("{"), F.coalesce(F.get_json_object(raw, "$.content"), F.get_json_object(raw, "$.markdown"))).otherwise(raw)


def page_json(spark: SparkSession, folder: str) -> DataFrame:
    t = spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("page_name"), "value")
    return t.select("page_name", unwrap(F.col("value")).alias("text"))


def rename(df: DataFrame, synonyms: dict[str, tuple[str, ...]]) -> DataFrame:
    """Canonical columns from headers in any spelling; columns that came twice are merged, the first that is filled."""
    found: dict[str, list[Column]] = {}
    for c in df.columns:
        key = re.sub(r"[\s_]+", "", c).lower()
        for name, spellings in synonyms.items():
            if key in spellings:
                found.setdefault(name, []).append(F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")))
    return df.select(*(F.coalesce(*cols).alias(n) for n, cols in found.items()))


#: What cp1252 has where latin-1 has control characters.
_C1 = "".join(chr(i) for i in range(0x80, 0xA0) if i not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))


def sheet(spark: SparkSession, path: str, synonyms: dict[str, tuple[str, ...]]) -> DataFrame:
    """A CSV sheet with header synonyms: UTF-8, or, where that leaves replacement marks, cp1252 (read as latin-1, which Spark knows, and
    put right)."""
    read = lambda e: rename(spark.read.option("header", "true").option("encoding", e).option("multiLine", "true").csv(path), synonyms)
    df = read("UTF-8")
    if not df.where(F.contains(F.concat_ws(" ", *df.columns), F.lit("\ufffd"))).limit(1).count():
        return df
    cp = _C1.encode("latin-1").decode("cp1252")
    return read("ISO-8859-1").select(*(F.translate(c, _C1, cp).alias(c) for c in synonyms))


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    """All metadata_Rn_Bn.csv files with the run and batch of their names; extra files stay out."""
    df = spark.read.option("header", "true").option("pathGlobFilter", "metadata_R*_B*.csv").csv(folder).withColumn("_f", F.col("_metadata.file_name"))
    return df.withColumns({"run_id": F.concat(F.lit("Run"), F.regexp_extract("_f", RUN_BATCH, 1)), "batch_id": F.concat(F.lit("Batch"), F.regexp_extract("_f", RUN_BATCH, 2))}).drop("_f")


def labelled_jsonl(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, lines that do not parse)."""
    df = spark.read.schema(schema + ", _corrupt_record string").option("mode", "PERMISSIVE").json(path)
    df = df.withColumn("_bad", F.col("_corrupt_record").isNotNull())
    return df.where("not _bad").drop("_bad", "_corrupt_record"), df.where("_bad").select("_corrupt_record")


def jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A database table, where a driver is on the class path."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def reuse(sources: list[DataFrame], key: list[str]) -> DataFrame:
    """Rows by priority of their source: the first source that has a key gives it."""
    from pyspark.sql import Window

    both = sources[0].withColumn("_p", F.lit(0))
    for i, s in enumerate(sources[1:], 1):
        both = both.unionByName(s.withColumn("_p", F.lit(i)))
    rn = F.row_number().over(Window.partitionBy(*key).orderBy("_p"))
    return both.withColumn("_rn", rn).where("_rn = 1").drop("_rn", "_p")


def find_folders(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """(name, folder): where each wanted folder name lies, whatever the case."""
    seg = F.split(F.regexp_replace("path", r"/[^/]*$", ""), "/")
    dirs = files.select(F.posexplode(seg).alias("i", "s"), seg.alias("seg")).select(F.lower("s").alias("k"), F.array_join(F.slice("seg", F.lit(1), F.col("i") + 1), "/").alias("folder")).distinct()
    return wanted.withColumn("k", F.lower("name")).join(dirs, "k", "left").select("name", "folder")
