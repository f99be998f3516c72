"""The stages of the pipeline: each applies one operator to what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination as tests
from . import mixing as mixer
from . import secrets as scanner
from . import simhash
from . import toxicity as judge

#: Documents with this score or more go.
TOXIC = 0.3


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the trained model finds toxic go; null and empty texts stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = judge.train(docs, labels.where(~judge.held_out(F.col("doc_id"))))
    text = F.col("text")
    return docs.where((model.score(text) < TOXIC) | text.isNull() | (text == ""))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked SimHash fingerprints stays: the one with the least id.

    A document is known by its id and text: different texts of one id are judged each by its own,
    and of repeated rows the least by all columns stays. Null and empty texts have the
    fingerprint zero and are one group. A row without an id comes behind all others of its
    group.
    """
    known = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", F.xxhash64("text").alias("text"))
    named = docs.withColumn("_document", known)
    groups = simhash.near_duplicates(named.select("_document", "text"), id="_document")
    first = groups.where(F.col("_document") == F.col("component_id")).select("_document").distinct()
    kept = named.join(first, "_document", "left_semi")
    return kept.groupBy("_document").agg(F.min(F.struct(*docs.columns)).alias("d")).select("d.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, question and answer, go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return docs.where(F.size(tests.leaks(items, F.col("text"))) == 0)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; every secret in a text is replaced by a mark."""
    found = scanner.scan(docs)
    clean = found.withColumn("text", scanner.redacted(F.col("text"), F.col("spans")))
    changed = F.size("spans") > 0
    return clean.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(
        F.col("n_chars"))).select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, all documents listed."""
    return mixer.mix(docs)
