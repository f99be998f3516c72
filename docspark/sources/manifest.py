"""Numbered manifests of a stored table: a version counts once its manifest is there."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Manifests:
    """JSON files ``manifest-<n>.json`` under a folder of any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._jpath = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._jpath(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def latest(self) -> int | None:
        if not self._fs.exists(self._jpath(self.path)):
            return None
        names = [s.getPath().getName() for s in self._fs.listStatus(self._jpath(self.path))]
        return max((int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json")), default=None)

    def read(self, number: int) -> dict:
        stream = self._fs.open(self._jpath(f"{self.path}/manifest-{number:08d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, number: int, content: dict) -> None:
        """Of two writers of one version the second fails: the file is never overwritten."""
        out = self._fs.create(self._jpath(f"{self.path}/manifest-{number:08d}.json"), False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
