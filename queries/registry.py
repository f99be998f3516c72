"""Where the query modules register: a Spark plan and, where SQL can say it, its oracle."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.functions import geo
from docspark.session import checkpoint_dir
from docspark.sources.textindex import TextIndex

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one scale factor as attributes: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def scratch(t: Tables, name: str) -> str:
    """A fresh place for what a query stores, in the folder every executor reaches."""
    return os.path.join(checkpoint_dir(t.spark), "queries", f"{name}-{uuid.uuid4().hex}")


_INDEXES: dict[tuple, TextIndex] = {}


def state(df: DataFrame) -> tuple:
    """The files of a table with their sizes and times, from the file system alone."""
    spark, out = df.sparkSession, []
    for name in sorted(df.inputFiles()):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        out.append((name, found.getLen(), found.getModificationTime()))
    return tuple(out)


def text_index(t: Tables) -> TextIndex:
    """The stored index of the texts: built by the first query of a session that needs it, and
    again if the files have changed."""
    key = (t.spark.sparkContext.applicationId, t.folder, state(t.documents))
    if key not in _INDEXES:
        _INDEXES[key] = TextIndex.build(t.documents, "doc_id", "text", scratch(t, "text-index"))
    return _INDEXES[key]


# --- the same definitions in SQL ---------------------------------------------------------------


def tok(column: str) -> str:
    """The standard analyzer."""
    return (f"list_filter(regexp_split_to_array(lower({column}), '[^\\p{{L}}\\p{{N}}]+'), "
            f"lambda t: t <> '')")


def padded(column: str) -> str:
    return f"(' ' || array_to_string({tok(column)}, ' ') || ' ')"


# Deterministic places for the geo queries, on a grid of thousandths of a degree.
LAT = "((({key} * 7919) % 170000) / 1000.0 - 85)"
LON = "((({key} * 104729) % 360000) / 1000.0 - 180)"


def lat_sql(key: str) -> str:
    return LAT.format(key=key)


def lon_sql(key: str) -> str:
    return LON.format(key=key)


def located(df: DataFrame, key: str, name: str = "location") -> DataFrame:
    lat = (F.col(key) * 7919) % 170000 / 1000.0 - 85
    lon = (F.col(key) * 104729) % 360000 / 1000.0 - 180
    return df.withColumn(name, geo.make_point(lat, lon))
