"""The pipeline over ``documents``: each stage calls one operator of ``docspark.llm``."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from docspark.llm import stages
from docspark.session import checkpoint_dir

#: ``(name, function)``; a function takes (spark, docs, sf_dir) and returns the next docs.
STAGES = [
    ("toxicity", stages.toxicity),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("secrets", stages.secrets),
    ("mixing", stages.mixing),
]

#: Trained scores, XXH64 fingerprints and components have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` through all stages; every stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = os.path.join(checkpoint_dir(spark), "pipeline", uuid.uuid4().hex)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
