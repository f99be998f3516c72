"""Best hits per key. Ranks are cut inside every task before the shuffle, so a key that
holds a large share of the rows sends only its best few."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column], n: int,
                offset: int = 0, rank: str = "_rank") -> DataFrame:
    """The rows ranked ``offset + 1 .. offset + n`` of each key, with their rank.

    A comparison of ``row_number`` with a literal lets Catalyst put a group limit on both
    sides of the exchange.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= offset + n)
    return out.where(F.col(rank) > offset) if offset else out


def best_per_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    return top_per_key(df, key, order, 1).drop("_rank")


def collapse_inner_hits(df: DataFrame, key: str, order: Sequence[Column], n: int,
                        fields: Sequence[str], name: str = "inner_hits") -> DataFrame:
    """Per key its best ``n`` rows as an ordered array; ``n = 0`` gives empty arrays."""
    ranked = top_per_key(df, key, order, max(n, 1))
    listed = F.collect_list(F.when(F.col("_rank") <= n, F.struct("_rank", *fields)))
    return ranked.groupBy(key).agg(F.sort_array(listed).alias(name))
