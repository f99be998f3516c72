"""A stored collection: parquet snapshots, one directory per version.

A write goes to a new ``v=<n>`` directory and counts only once its manifest is there, so
a reader sees one consistent version and a failed job leaves the old one in place. Rows are
spread over routing buckets. A change rewrites the buckets it touches; the manifest points to
older directories for the rest.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.writes import WriteResult, routing_bucket

BUCKET = "_bucket"


class Collection:
    def __init__(self, spark: SparkSession, path: str, *, id: str, routing: str | None = None,
                 buckets: int | None = None, sort_by: Sequence[str] = ()):
        """Opens a collection, or names a new one. The number of ``buckets`` (16 if nothing is said)
        and the routing column are kept in the manifest: choose them by the size that a
        collection will have, since a change rewrites the buckets that it touches."""
        self.spark, self.path, self.id = spark, path.rstrip("/"), id
        self.sort_by = tuple(sort_by)
        self._jpath = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._jpath(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        numbers = self._versions()
        stored = self._manifest(numbers[-1]).get("layout") if numbers else None
        if stored and (buckets not in (None, stored["buckets"]) or routing not in (None, stored["routing"])):
            raise ValueError(f"{path} is laid out by {stored['routing']!r} in {stored['buckets']} buckets")
        self.buckets = stored["buckets"] if stored else buckets or 16
        self.routing = stored["routing"] if stored else routing or id

    # --- lifecycle -----------------------------------------------------------------------

    def exists(self) -> bool:
        return self.version() is not None

    def create(self, schema: T.StructType | str) -> None:
        if self.exists():
            raise ValueError(f"collection exists: {self.path}")
        self.commit(self.spark.createDataFrame([], schema))

    def delete(self) -> None:
        """Drop the collection by a last manifest that marks it dropped; files stay for
        readers that have pinned a version."""
        self._write_manifest(self._next(), {"dropped": True})

    def version(self) -> int | None:
        """The latest complete version, None if there is none or it was dropped."""
        numbers = self._versions()
        if not numbers or self._manifest(numbers[-1]).get("dropped"):
            return None
        return numbers[-1]

    # --- reading -------------------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of one version. Pass a version for a point-in-time view."""
        version = self.version() if version is None else version
        if version is None:
            raise ValueError(f"no such collection: {self.path}")
        return self._read(self._manifest(version))

    def read_route(self, value, version: int | None = None) -> DataFrame:
        """Rows of one routing value: its bucket is the only one that is listed and read."""
        manifest = self._manifest(self.version() if version is None else version)
        one = self.spark.range(1).select(routing_bucket(
            F.lit(value).cast(T.StructType.fromJson(manifest["schema"])[self.routing].dataType),
            self.buckets)).first()[0]
        return self._read(manifest, [one]).where(F.col(self.routing) == F.lit(value))

    def open_point_in_time(self) -> int:
        return self.version()

    # --- writing -------------------------------------------------------------------------

    def commit(self, rows: DataFrame, batch: int | None = None) -> int:
        """Replace the content."""
        return self._commit(rows, None, batch)

    def merge(self, changes: DataFrame, merge: Callable[[DataFrame, DataFrame], WriteResult],
              batch: int | None = None) -> int:
        """Apply ``merge(current, changes)`` to the buckets that ``changes`` touch.

        With ``batch`` a batch that is already in is skipped, so a repeated micro-batch
        changes nothing.
        """
        version = self.version()
        if version is None:
            raise ValueError(f"no such collection: {self.path}")
        manifest = self._manifest(version)
        if batch is not None and manifest.get("batch", -1) >= batch:
            return version
        bucket = routing_bucket(F.col(self.routing), self.buckets)
        # at most one small number per bucket reaches the driver
        touched = sorted(r[0] for r in changes.select(bucket.alias("b")).distinct().collect())
        if not touched:
            return version
        result = merge(self._read(manifest, touched), changes).result
        return self._commit(result, touched, batch)

    def _commit(self, rows: DataFrame, touched: Sequence[int] | None, batch: int | None) -> int:
        number = self._next()
        old = self._manifest(number - 1) if touched is not None else {"buckets": {}}
        out = rows.withColumn(BUCKET, routing_bucket(F.col(self.routing), self.buckets))
        # a crowded bucket is split over several tasks and files
        out = out.hint("rebalance", BUCKET)
        if self.sort_by:
            out = out.sortWithinPartitions(BUCKET, *self.sort_by)
        out.write.mode("errorifexists").partitionBy(BUCKET).parquet(self._dir(number))
        held = {b: v for b, v in old["buckets"].items()
                if touched is not None and int(b) not in set(touched)}
        held.update({b: number for b in self._buckets_in(number)})
        last = batch if batch is not None else old.get("batch", -1)
        self._write_manifest(number, {"buckets": held, "batch": last,
                                      "layout": {"buckets": self.buckets, "routing": self.routing},
                                      "schema": rows.schema.jsonValue()})
        return number

    # --- files ---------------------------------------------------------------------------

    def _dir(self, number: int) -> str:
        return f"{self.path}/v={number:08d}"

    def _list(self, path: str) -> list[str]:
        p = self._jpath(path)
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def _versions(self) -> list[int]:
        return sorted(int(n[len("manifest-"):-len(".json")]) for n in self._list(self.path)
                      if n.startswith("manifest-") and n.endswith(".json"))

    def _next(self) -> int:
        """Above every directory, finished or not: leftovers of a failed job are never read."""
        begun = [int(n[2:]) for n in self._list(self.path) if n.startswith("v=")]
        return max([*begun, *self._versions(), 0]) + 1

    def _buckets_in(self, number: int) -> list[str]:
        return [n.split("=")[1] for n in self._list(self._dir(number)) if n.startswith(BUCKET + "=")]

    def _manifest(self, number: int) -> dict:
        candidates = [v for v in self._versions() if v <= number]
        stream = self._fs.open(self._jpath(f"{self.path}/manifest-{candidates[-1]:08d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _write_manifest(self, number: int, content: dict) -> None:
        # create without overwrite: of two writers of one version the second fails
        out = self._fs.create(self._jpath(f"{self.path}/manifest-{number:08d}.json"), False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()

    def _read(self, manifest: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        wanted = {b: v for b, v in manifest["buckets"].items()
                  if buckets is None or int(b) in set(buckets)}
        if not wanted:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self._dir(v)}/{BUCKET}={b}" for b, v in sorted(wanted.items())]
        return self.spark.read.schema(schema).parquet(*paths)
