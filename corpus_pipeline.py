"""The corpus pipeline: documents go through the stages one after the other.

Each stage is a function of (spark, docs, sf_dir); its rows are written as Parquet and read again as the
next stage's `docs`. All stages but the last keep the columns of `documents`, and every stage works on all
rows that the one before it kept. Extra columns are carried along; nulls, empty texts and repeated rows have
the results that the operators' modules state; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from holdfast.llm import exact_dedup, packing, quality, simhash_dedup, toxicity
from holdfast.llm.common import discard, read_table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of poor quality, by their text and their site, go."""
    return quality.drop_poor(docs, quality.fit_evidence(docs, read_table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text the one with the smallest doc_id stays."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays."""
    return simhash_dedup.keep_one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The spans of the remaining documents, in buckets and batches."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("packing", pack),
]

# Trained classifiers decide in the first two stages, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to `documents`."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs, path = written(stage(spark, docs, sf_dir))
        if before:
            discard(spark, before)
        before = path
    return docs
