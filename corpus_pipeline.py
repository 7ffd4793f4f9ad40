"""Corpus pipeline over ``documents``: each stage works on all that the stage before it kept.

1. language ID: documents without a letter, and those whose calibrated score is under the rejection threshold, go;
2. exact dedup: of texts equal up to white space, the document with the smallest doc_id stays;
3. n-gram Jaccard join: of documents linked by shingle similarity, the one with the smallest doc_id stays;
4. suffix-array dedup: later copies of byte strings are cut out of the texts, and ``n_chars`` follows; documents of
   which nothing is left go;
5. best-fit packing: every document's pieces with their bin and place, no two of a source or duplicate cluster in a bin.

All stages but the last return the columns of ``documents``; extra columns pass through them.  An empty table passes
through every stage as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trailcheck.llm.common import shared_dir
from trailcheck.llm.exact_dedup import kept_documents
from trailcheck.llm.language_id import accepted_documents, train
from trailcheck.llm.packing import pack_documents
from trailcheck.llm.shingle_join import first_of_each
from trailcheck.llm.suffix_dedup import without_repeats


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted_documents(docs, train(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kept_documents(docs)


def shingle_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return first_of_each(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeats(docs, size_col="n_chars")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("shingle_join", shingle_join),
    ("suffix_dedup", suffix_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Learned rejection and byte-level removal have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read back."""
    docs, at = spark.read.parquet(f"{sf_dir}/documents.parquet"), shared_dir(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{at}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
