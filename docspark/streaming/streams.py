"""Streams of documents: filters, bulk saves, versioned upserts and running aggregates.

All sinks are ``foreachBatch`` writes into a :class:`Collection` that remembers the last
batch it holds, so a batch repeated after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.collapse import top_per_key
from ..operators.writes import RowHooks, bulk_index, version_upsert
from ..plans.criteria import Context, Node
from ..schema import DocSchema
from ..sources.collection import Collection


def read_stream(spark: SparkSession, path: str, schema: T.StructType, *, pattern: str | None = None,
                files_per_batch: int | None = None, format: str = "parquet") -> DataFrame:
    reader = spark.readStream.schema(schema).format(format)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_filter(stream: DataFrame, schema: DocSchema, node: Node) -> DataFrame:
    """The criteria of a batch search, on a stream."""
    return stream.where(node.match(Context(stream.schema, schema)))


def _start(stream: DataFrame, checkpoint: str, handle, available_now: bool,
           interval: str | None, mode: str = "append") -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.foreachBatch(handle).start()


def stream_bulk_save(stream: DataFrame, target: Collection, checkpoint: str, *,
                     hooks: RowHooks | None = None, order: str | None = None,
                     available_now: bool = True, interval: str | None = None) -> StreamingQuery:
    """Write micro-batches in bulk, one at a time; the first error stops the stream. The
    size of a batch is a setting of the source, its frequency that of the trigger."""

    def save(batch: DataFrame, batch_id: int) -> None:
        rows = hooks.run("before_save", batch) if hooks else batch
        rows.persist()
        target.merge(rows, lambda cur, inc: bulk_index(cur, inc, target.id, order), batch=batch_id)
        rows.unpersist()

    return _start(stream, checkpoint, save, available_now, interval)


def stream_version_upsert(stream: DataFrame, target: Collection, checkpoint: str, version: str, *,
                          order: str | None = None, or_equal: bool = False,
                          available_now: bool = True, interval: str | None = None) -> StreamingQuery:
    """A late or repeated document loses against a newer version that is stored. First the
    newest of a batch per id, then the merge, so the end is that of one batch upsert."""

    def upsert(batch: DataFrame, batch_id: int) -> None:
        rank = [F.desc(version)]
        if order:
            rank.append(F.desc(order) if or_equal else F.asc(order))
        newest = top_per_key(batch, target.id, rank, 1).drop("_rank").persist()
        target.merge(newest, lambda cur, inc: version_upsert(
            cur, inc, target.id, version, or_equal=or_equal, order=order), batch=batch_id)
        newest.unpersist()

    return _start(stream, checkpoint, upsert, available_now, interval)


def windowed(stream: DataFrame, time: str, window: str, keys: Sequence[str], metrics: Sequence[Column], *,
             late: str, slide: str | None = None) -> DataFrame:
    """Running aggregation by time window and keys. ``late`` says how long a window stays open
    behind the newest time seen; a row later than that is dropped, so it has to be chosen."""
    return (stream.withWatermark(time, late)
            .groupBy(F.window(time, window, slide), *keys).agg(*metrics)
            .withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")})
            .drop("window"))


def stream_aggregate(stream: DataFrame, target: Collection, checkpoint: str, time: str, window: str,
                     keys: Sequence[str], metrics: Sequence[Column], *, late: str,
                     slide: str | None = None, available_now: bool = True,
                     interval: str | None = None) -> StreamingQuery:
    """Windows that changed in a batch replace their older figures in the target, whose id is
    ``bucket_id`` (window start and keys)."""
    agg = windowed(stream, time, window, keys, metrics, slide=slide, late=late)
    agg = agg.withColumn("bucket_id", F.concat_ws("|", F.col("window_start").cast("string"),
                                                  *[F.col(k).cast("string") for k in keys]))

    def update(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        target.merge(batch, lambda cur, inc: bulk_index(cur, inc, target.id), batch=batch_id)
        batch.unpersist()

    return _start(agg, checkpoint, update, available_now, interval, mode="update")
