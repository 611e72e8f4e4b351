"""Corpus pipeline: quality, language, near-duplicates, packing. Each stage reads what its predecessor kept."""

from pyspark.sql import DataFrame, SparkSession

from newsflow.llm import langid, neardup, packing, quality
from newsflow.session import stage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine, fitted on the labelled ones among them, does not reject."""
    machine = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, machine)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return langid.keep_identified(docs, langid.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked at a similarity of 0.8 over shingles of five words."""
    return neardup.one_of_each(docs, shingle=5, threshold=80)


def pack_lengths(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A bucket, batch and place for every document that is left."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("language id", keep_language),
    ("near duplicates", drop_near_duplicates),
    ("packing", pack_lengths),
]
#: Models and batches are beyond SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, name.replace(" ", "-"))
    return docs
