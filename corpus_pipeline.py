"""From raw documents to packed training sequences, in five stages.

Each stage gets what its predecessor kept, with the columns of ``documents``; the last one returns
the pieces of the packed sequences. Between stages the rows are written as Parquet into the shared
folder and read again, so a lost executor never repeats a finished stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from kawara.llm import exact_dedup, mixing, near_dedup, packing, quality
from kawara.session import shared_folder

#: Shared share of five-word shingles, in percent, from which documents are near duplicates.
NEAR_PERCENT = 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicate(docs, percent=NEAR_PERCENT)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.sequences(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("mixing", source_mix),
    ("packing", packed),
]

#: Model fitting, hashing and tokenization are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents of a folder."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
