"""The corpus pipeline: five stages from raw documents to a weighted mix.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs. All but the last return the
columns of documents.

Defined results: as of the operator that each stage calls. An empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import decontaminate, language_id, mixing, quality_rules, simhash
from sluice.session import shared_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go."""
    return language_id.keep_identified(docs)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose the lines that fail."""
    return quality_rules.filter_documents(docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.one_per_group(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item is found go."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the copies the mix takes of it, none for those it leaves out.

    An input column of the same name as one of the mix gives way to it.
    """
    added = ["size", "source_size", "target", "copies", "taken"]
    own = [f"doc.`{name}`" for name in docs.columns if name not in added]
    return mixing.mix(docs).select(*own, *added)


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("simhash_dedup", remove_near_duplicates),
    ("decontamination", remove_benchmark),
    ("mixing", mix_sources),
]

# Nearest centroids, fingerprints and the embedding are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    folder = f"{shared_dir(spark)}/sluice-pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        result.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(result.schema).parquet(f"{folder}/{name}")
    return docs
