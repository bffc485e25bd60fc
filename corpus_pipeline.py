"""A training corpus from raw documents, in five stages of the operators of folioframe.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.

Null, empty and very long texts pass through every stage whole, with what the operator's docstring says of them: a null text is not toxic by
itself, has no lines, is a near copy of other texts without words (so one of these stays), has nothing to mix and so leaves with the
mix. Repeated rows are one group of the near-duplicate stage; ties there go to the least doc_id, then the least text hash. Rows without a
doc_id stay where a group has no other. Further columns stay up to the mix, whatever their names. An empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioframe.llm import linedup, mixing, pieces, simhash, toxicity
from folioframe.llm.common import table, write_table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go. The model learns from the labelled rows among docs."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document has leave the later one; documents that nothing is left of go."""
    return linedup.dedup_lines(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: 5-word shingles, a Jaccard similarity of 0.8 or more."""
    return simhash.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares: documents repeat or go as their source's quota says."""
    return mixing.mixed(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of ids, digests of ids and of the decoded text, and the ids themselves, for each row of the mix."""
    return pieces.encode_documents(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_dedup_stage),
    ("SimHash near-dedup", simhash_stage),
    ("mixing sources", mixing_stage),
    ("SentencePiece encoding", encoding_stage),
]

#: Models and alignments are beyond SQL; tests/llm/test_pipeline.py holds the stages against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
