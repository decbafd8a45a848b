"""From raw documents to a training mix: five operators, each on all that the one before kept.

Every stage is written as Parquet to the shared folder and read again, so a lost executor costs at most
one stage's tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from estatelens.llm.contamination import decontaminate
from estatelens.llm.fingerprints import keep_one_of_each
from estatelens.llm.line_crf import keep_good
from estatelens.llm.mixing import mixed_documents
from estatelens.llm.personal import redact_personal
from estatelens.session import shared_folder


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model does not reject."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    shared_folder(spark)
    return keep_one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    shared_folder(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind in square brackets; other columns stay as they are."""
    shared_folder(spark)
    return redact_personal(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of training."""
    return mixed_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
]

#: The classifiers and fingerprints are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    folder = f"{shared_folder(spark)}/pipeline/{uuid.uuid4()}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = f"{folder}/{i}_{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
