"""The corpus pipeline: four stages over ``documents``.

Each stage is (name, function (spark, docs, sf_dir) -> DataFrame); its result
is written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from wavecohort.llm import importance, packing, quality_rules, simhash
from wavecohort.llm.common import shared_folder
from wavecohort.llm.queries import table, vocabulary


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or stand on a failed host."""
    return quality_rules.keep_good(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that importance resampling does not select."""
    return importance.keep_selected(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked fingerprints."""
    return simhash.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences; one row per piece."""
    return packing.pack_documents(docs, packing.PackSettings(tokenizer=vocabulary("byte_bpe_50k.json")))


STAGES = [
    ("quality rules", quality_rules_stage),
    ("quality classifier", quality_classifier_stage),
    ("simhash near-dedup", near_dedup_stage),
    ("best-fit packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the hand-offs are written
    to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}-{number}"
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs


# SQL has neither the tokenizer nor XXH64; tests compare with brute force.
ORACLE_SQL = None
