"""Parents and children stored side by side: both bucketed by the parent's id, joined without an exchange."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .manifest import Manifests


@dataclass(frozen=True)
class RelatedTables:
    """``parents`` and ``children`` under ``path``, in as many buckets each by a hash of the parent's id, every
    bucket sorted by it. What is joined, grouped or looked up by that id needs no shuffle: bucket i
    of one side only meets bucket i of the other, as shards that are routed by the parent do.

    All children of a parent are in one bucket. So this is for parents with few children each; with a parent that holds
    a large share of all children, the operators on plain tables spread it better.
    """

    spark: SparkSession
    path: str
    parent_key: str
    child_key: str
    buckets: int
    schemas: tuple[str, str]

    @classmethod
    def build(cls, parents: DataFrame, children: DataFrame, path: str, *, parent_key: str, child_key: str,
              buckets: int) -> RelatedTables:
        """Each side is dealt by its key once, a task for each bucket, and written as one file a bucket."""
        spark, path = parents.sparkSession, path.rstrip("/")
        stored = Manifests(spark, path)
        if stored.latest() is not None:
            raise ValueError(f"related tables exist: {path}")
        # one type of key on both sides: the hashes have to agree
        children = children.withColumn(child_key, F.col(child_key).cast(parents.schema[parent_key].dataType))
        for name, rows, key in (("parents", parents, parent_key), ("children", children, child_key)):
            table = f"{name}_{uuid.uuid4().hex}"
            (rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
             .option("path", f"{path}/{name}").saveAsTable(table))
            spark.sql(f"DROP TABLE {table}")  # an external table: its files stay
        said = {"parent_key": parent_key, "child_key": child_key, "buckets": buckets,
                "schemas": [parents.schema.json(), children.schema.json()]}
        stored.write(1, said)
        return cls(spark, path, parent_key, child_key, buckets, tuple(said["schemas"]))

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> RelatedTables:
        stored = Manifests(spark, path.rstrip("/"))
        number = stored.latest()
        if number is None:
            raise ValueError(f"no related tables: {path}")
        said = stored.read(number)
        return cls(spark, path.rstrip("/"), said["parent_key"], said["child_key"], said["buckets"], tuple(said["schemas"]))

    def _table(self, name: str, schema: str, key: str) -> DataFrame:
        """The files as a table of the session's catalog, which knows the buckets; a new name each time, since
        the files of a name may be replaced."""
        fields = T.StructType.fromJson(json.loads(schema)).fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        table = f"{name}_{uuid.uuid4().hex}"
        self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{self.path}/{name}'")
        return self.spark.table(table)

    def parents(self) -> DataFrame:
        return self._table("parents", self.schemas[0], self.parent_key)

    def children(self) -> DataFrame:
        return self._table("children", self.schemas[1], self.child_key)
