"""Corpus pipeline: quality rules, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; its result is written
as Parquet and read again. All stages but the last return the columns of documents.

Defined cases, of every stage: null and empty texts are texts without words; very long texts are worked on whole; rows
without doc_id and repeated rows take part as said below; columns beyond those of documents go along unchanged,
whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from upland.llm.common import materialize, table
from upland.llm.minhash import one_of_each
from upland.llm.packing import pack
from upland.llm.quality import accepted
from upland.llm.suffix_array import without_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that fail the base rules (null texts do), or whose host is rejected, go; each row is judged by itself."""
    return accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group of near-duplicates the row of the least doc_id stays; rows without doc_id, and texts without words, stay; of
    equal rows one stays."""
    return one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows of 50 that also start in a document with a smaller doc_id go; a document that has nothing left goes;
    rows without doc_id stay as they are."""
    return without_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row is packed, null texts as their end id."""
    return pack(docs)


STAGES = [("quality_rules", quality), ("minhash_near_dedup", near_dedup), ("suffix_array_dedup", substring_dedup), ("best_fit_packing", packing)]

#: Tokenising and packing can't be written in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
