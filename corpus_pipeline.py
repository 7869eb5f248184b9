"""The training-corpus pipeline: quality rules, near-dedup, decontamination, PII redaction, source mixing.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before
kept, and returns a DataFrame; ``run`` writes each result as Parquet in the
shared checkpoint folder and rereads it as the next stage's input. All stages
but the last return the columns of ``documents``; the last adds block, slot,
place and on_target (see ``tierlake.llm.mixing``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tierlake.llm import decontaminate, mixing, near_dedup, pii, quality_rules
from tierlake.session import checkpoint_dir
from tierlake.sources.tables import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", dedup),
    ("decontamination", decontamination),
    ("pii", redaction),
    ("mixing", mixture),
]

#: The outlier estimates, the sketches, the alignments and the boosted trees have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
