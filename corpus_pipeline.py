"""From raw documents to packed sequences: five stages, each a written table.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of documents. ``run`` writes each stage's rows as Parquet into the shared
checkpoint folder and rereads them as the next one's documents.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lifecorpus.llm import exact_dedup, mixing, quality, queries, simhash
from lifecorpus.llm.common import prepare, read, stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more, by a classifier fitted on the labelled ones."""
    prepare(spark)
    return quality.keep_good(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id."""
    return exact_dedup.deduplicated(docs, keep="largest")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash, the one with the smallest id."""
    return simhash.one_of_each(docs, shingle=3, most=3)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return queries.packed(docs)


STAGES = [("quality classifier", quality_classifier), ("exact dedup", exact_duplicates),
          ("simhash near-dedup", near_duplicates), ("source mixing", source_mix), ("packing", sequence_packing)]

#: SQL can neither fit the classifier nor cut texts into tokens; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
