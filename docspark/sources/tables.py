"""Reading collections by name, several at once, filtered views, JSON documents."""

from __future__ import annotations

import fnmatch
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INDEX = "_index"


def read_index(spark: SparkSession, path: str, format: str = "parquet",
               schema: T.StructType | str | None = None, **options) -> DataFrame:
    """One collection of files: parquet, orc, json, csv, avro or any installed source."""
    reader = spark.read.format(format).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def multi_index(indices: Mapping[str, DataFrame]) -> DataFrame:
    """Several collections as one; missing columns are null, ``_index`` tells the origin."""
    out = None
    for name, df in indices.items():
        part = df.withColumn(INDEX, F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


class MissingIndex(ValueError):
    """A named collection does not exist."""


class Catalog:
    """Names to collections, with wildcards, aliases and a policy for missing names."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.indices: dict[str, DataFrame] = {}
        self.aliases: dict[str, list[tuple[str, Column | None]]] = {}

    def put(self, name: str, df: DataFrame) -> Catalog:
        self.indices[name] = df
        return self

    def resolve(self, names: Sequence[str], *, ignore_unavailable: bool = False,
                allow_no_indices: bool = True, expand_wildcards: bool = True,
                schema: T.StructType | None = None) -> DataFrame:
        """The union of the named collections. A missing plain name is an error unless
        ignored; wildcards that match nothing are fine unless ``allow_no_indices`` is off."""
        views: dict[str, list[Column | None]] = {}
        for name in names:
            if "*" in name and expand_wildcards:
                hits = [n for n in (*self.indices, *self.aliases) if fnmatch.fnmatchcase(n, name)]
            else:
                hits = [n for n in (name,) if n in self.indices or n in self.aliases]
                if not hits and not ignore_unavailable:
                    raise MissingIndex(name)
            for h in hits:
                for index, condition in self._views(h):
                    views.setdefault(index, []).append(condition)
        if views:
            return multi_index({index: self._seen(index, conditions) for index, conditions in views.items()})
        if not allow_no_indices:
            raise MissingIndex(", ".join(names))
        empty = schema or (next(iter(self.indices.values())).schema if self.indices else T.StructType())
        return self.spark.createDataFrame([], empty).withColumn(INDEX, F.lit(None).cast("string"))

    def _views(self, name: str) -> list[tuple[str, Column | None]]:
        """The collections behind a name, each with the condition of the way to it."""
        return [(name, None)] if name in self.indices else self.aliases[name]

    def _seen(self, index: str, conditions: Sequence[Column | None]) -> DataFrame:
        """Rows of a collection that any of several ways shows: all, if one has no condition."""
        rows = self.indices[index]
        if any(c is None for c in conditions):
            return rows
        return rows.where(reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions]))

    def _rows(self, name: str) -> dict[str, DataFrame]:
        views: dict[str, list[Column | None]] = {}
        for index, condition in self._views(name):
            views.setdefault(index, []).append(condition)
        return {index: self._seen(index, conditions) for index, conditions in views.items()}

    def add_alias(self, alias: str, index: str, filter: Column | None = None) -> DataFrame:
        """A named, perhaps filtered, view; also registered for SQL."""
        self.aliases.setdefault(alias, []).append((index, filter))
        view = multi_index(self._rows(alias))
        view.createOrReplaceTempView(alias)
        return view

    def remove_alias(self, alias: str, index: str | None = None) -> None:
        kept = [p for p in self.aliases.pop(alias, []) if index is not None and p[0] != index]
        self.spark.catalog.dropTempView(alias)
        if kept:
            self.aliases[alias] = kept
            multi_index(self._rows(alias)).createOrReplaceTempView(alias)


def multi_get(df: DataFrame, ids: Sequence, id: str) -> DataFrame:
    """One row per asked id, in the asked order (``_pos``), with ``_found``. The ids are
    literals of the request: a filter the scan can prune by, then a join of what is left."""
    dtype = df.schema[id].dataType
    asked = df.sparkSession.createDataFrame(
        [(i, v) for i, v in enumerate(ids)],
        T.StructType([T.StructField("_pos", T.IntegerType()), T.StructField(id, dtype)]))
    hits = df.where(F.col(id).isin(list(ids))).withColumn("_found", F.lit(True))
    return (asked.join(hits, id, "left")
            .withColumn("_found", F.coalesce("_found", F.lit(False))).orderBy("_pos"))


def parse_documents(df: DataFrame, json: str, schema: str | T.StructType) -> DataFrame:
    """JSON strings to columns; a broken document gives nulls and ``_malformed``."""
    parsed = F.from_json(json, schema, {"mode": "PERMISSIVE"})
    out = df.withColumn("_doc", parsed)
    names = (schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)).fieldNames()
    broken = F.col(json).isNotNull() & F.get_json_object(json, "$").isNull()
    return out.select(*df.columns, *[F.col(f"_doc.`{n}`").alias(n) for n in names],
                      broken.alias("_malformed"))


def to_documents(df: DataFrame, columns: Sequence[str] | None = None, json: str = "json") -> DataFrame:
    """Columns to one JSON string per row."""
    return df.withColumn(json, F.to_json(F.struct(*(columns or df.columns))))


def write_sorted(df: DataFrame, path: str, orders: Sequence[Column], *,
                 partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """Write with a stored sort order (per file), so that range filters skip row groups."""
    out = df.hint("rebalance", *partition_by) if partition_by else df
    out.sortWithinPartitions(*[F.col(p) for p in partition_by], *orders).write.mode(mode).partitionBy(
        *partition_by).parquet(path)
