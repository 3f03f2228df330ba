"""A corpus from documents: quality, exact and near copies, mixing and packing, in stages.

Each stage works on all rows its predecessor kept, is written as Parquet in the
shared folder and read again. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import exact_dedup, mixing, packing, quality, queries, simhash
from clickloom.session import shared_folder


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of documents it is given."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = queries.quality_model(docs, labels)
    scored = quality.score(docs, model, name="__quality")
    return scored.where(F.col("__quality") >= queries.QUALITY_AT).select(docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.keep_one(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their fingerprints the one with the smallest id."""
    return simhash.keep_one(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.apply_mix(docs, mixing.mix(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their token ids and places in the sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", good_quality),
    ("exact_dedup", without_copies),
    ("simhash_near_dedup", without_near_copies),
    ("source_mixing", mixed_sources),
    ("best_fit_packing", packed),
]

# A trained classifier, XXH64 and a tokenizer are beyond SQL; tests/llm checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/clickloom-pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
