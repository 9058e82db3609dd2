"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet in the shared scratch folder and read again as the next
stage's documents. All but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curatio.llm import fertility, jaccard_join, langid, line_dedup, packing
from curatio.llm.registry import fertility_rules
from curatio.llm.scratch import Scratch

#: Documents whose language is undetermined, or told with less probability, go.
MIN_LANGUAGE_SCORE = 0.35


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte network, trained on the stage's own labelled documents."""
    return langid.keep(docs, langid.fit(docs), MIN_LANGUAGE_SCORE)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokeniser fertility within its bands."""
    return fertility.keep(docs, fertility_rules())


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines equal or near to an earlier line leave the texts."""
    return line_dedup.apply(docs, line_dedup.LineRules())


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.one_of_each(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the texts in bins of permitted lengths."""
    return packing.pack(docs)


STAGES = [
    ("language ID", language_id),
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", near_duplicates),
    ("best-fit packing", pack_sequences),
]

#: Networks, tokenisers and packing are beyond SQL; tested by parts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.put(stage(spark, docs, sf_dir), f"stage{k}")
        if k:
            scratch.drop(f"stage{k - 1}")
    return docs
