"""Corpus pipeline: toxicity, near-duplicates, decontamination, mixing, sharding.

Every stage is one operator over all rows that the stage before it kept, written as Parquet and read
again. All stages but the last return the columns of documents. An empty table passes through every
stage as an empty one; further columns stay up to the last stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pagewright.llm import common, decontam, mixing, neardup, sharding, toxicity


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the threshold go.

    Null and empty texts hold nothing toxic and stay, rows with a null doc_id are judged like others,
    and repeated rows alike. Without usable labels all stay.
    """
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of the smallest doc_id.

    Null and empty texts and rows with a null doc_id stay. Rows that repeat a doc_id and its text become
    one; different texts under one kept doc_id stay.
    """
    return neardup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts and rows with a null doc_id stay. All rows of a contaminated doc_id go.
    """
    return decontam.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document comes as often as its source's target asks for: not at all, once, or repeated.

    Texts without words stay once. A null source is a source. Rows that repeat count each.
    """
    return mixing.apply_mix(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets a shard and a slot in it; rows with a null doc_id share a shard, repeats get a slot each."""
    return sharding.shard_documents(docs, 24)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]
#: A classifier is learnt and hashes are drawn that SQL does not have; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's table goes when the next one is written, the last when the driver ends."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    place, before = f"{common.home(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{name}")
        docs = spark.read.parquet(f"{place}/{name}")
        if before:
            common.delete(spark, f"{place}/{before}")
        before = name
    return docs
