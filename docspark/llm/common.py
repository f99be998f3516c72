"""What several operators share: words, pinned intermediate tables, ranks without one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: A word, wherever the contracts say so.
WORD = r"[^\x20\x09-\x0D]+"


def pinned(df: DataFrame) -> DataFrame:
    """``df``, computed once and kept in the folder that all executors share.

    Later stages read the files, so a lost executor recomputes nothing above them. The folder is
    ``spark.checkpoint.dir``; one is set here only where that is unset, as in tests.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.checkpoint()


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """``df`` with the 0-based rank of each row in ``order``, by sampled ranges.

    The rows are dealt out by range once and pinned; each range numbers its own rows and adds
    the number of rows in the ranges before it, one row per range.
    """
    dealt = pinned(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    counts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(*order)
    return (dealt.withColumn("_inside", F.row_number().over(inside) - 1)
            .join(F.broadcast(starts), "_range")  # one row per range
            .withColumn(name, F.col("_start") + F.col("_inside"))
            .drop("_range", "_inside", "_start"))
