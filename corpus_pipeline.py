"""Corpus pipeline: documents in, a mix to train on out.

``STAGES`` run in order over ``documents``; each reads all that its predecessor kept, as
Parquet in the folder that the session names in ``spark.checkpoint.dir``. All stages but
the last return the columns of ``documents``. The last returns, per document that is
left, how many of its words the mix takes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerframe.llm import decontaminate, line_spread, mixing, simhash, toxicity
from ledgerframe.llm.common import checkpoint_folder, read_table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier predicts to be toxic."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that stand on many sites."""
    return line_spread.clean(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each SimHash group."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.remove_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes the sources of what is left to their target weights."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: SQL cannot express the classifier, the fingerprints or the pseudorandom draws.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
