"""Aggregations. All of them are one partial + final aggregate over the matching rows; what
follows (top buckets, gaps, running totals) works on buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import pinned
from .collapse import top_per_key

# empty buckets written at a time
FILL_PIECE = 10_000


def _exploded(df: DataFrame, field: str) -> DataFrame:
    if isinstance(df.schema[field].dataType, T.ArrayType):
        # a document counts once per distinct value
        return df.withColumn(field, F.explode(F.array_distinct(field)))
    return df


def terms_agg(df: DataFrame, field: str, size: int | None = None, *, order: Sequence[Column] | None = None,
              min_doc_count: int = 1, metrics: Sequence[Column] = ()) -> DataFrame:
    """``(key, doc_count, metrics..)`` of all buckets, or of the ``size`` biggest: count
    descending, then key."""
    buckets = (_exploded(df, field).where(F.col(field).isNotNull())
               .groupBy(F.col(field).alias("key"))
               .agg(F.count(F.lit(1)).alias("doc_count"), *metrics))
    if min_doc_count > 1:
        buckets = buckets.where(F.col("doc_count") >= min_doc_count)
    order = order or (F.desc("doc_count"), F.asc("key"))
    ranked = buckets.orderBy(*order)
    return ranked if size is None else ranked.limit(size)


def terms_other_count(df: DataFrame, field: str, size: int = 10) -> DataFrame:
    """``sum_other_doc_count``: rows in the buckets that did not make the list."""
    rows = _exploded(df, field).where(F.col(field).isNotNull())
    kept = terms_agg(df, field, size).agg(F.sum("doc_count").alias("k")).scalar()
    return (rows.agg(F.count(F.lit(1)).alias("n"))
            .select((F.col("n") - F.coalesce(kept, F.lit(0))).alias("sum_other_doc_count")))


def stats(column: Column | str) -> list[Column]:
    return [F.count(column).alias("count"), F.min(column).alias("min"), F.max(column).alias("max"),
            F.avg(column).alias("avg"), F.sum(column).alias("sum")]


def extended_stats(column: Column | str) -> list[Column]:
    c = F.col(column) if isinstance(column, str) else column
    return [*stats(c), F.sum(c * c).alias("sum_of_squares"), F.var_pop(c).alias("variance"),
            F.stddev_pop(c).alias("std_deviation")]


def stats_bucket(buckets: DataFrame, metric: str = "doc_count") -> DataFrame:
    """Statistics over the buckets of another aggregation."""
    return buckets.agg(*stats(metric))


def cardinality(df: DataFrame, field: str, exact: bool = True, rsd: float = 0.02) -> DataFrame:
    fn = F.countDistinct(field) if exact else F.approx_count_distinct(field, rsd)
    return df.agg(fn.alias("value"))


def percentiles(df: DataFrame, field: str, points: Sequence[float] = (1, 5, 25, 50, 75, 95, 99), *,
                exact: bool = False, accuracy: int = 10_000, by: Sequence[str] = ()) -> DataFrame:
    """One column ``p<point>`` each.

    The default is a mergeable sketch of fixed size. ``exact`` (linear between the two
    neighbours) counts equal values first, partially in every task, and turns the
    counts into ranks with :func:`running_total`, so that no task holds the values of a
    whole group.
    """
    names = [f"p{str(p).replace('.', '_')}" for p in points]
    if not exact:
        q = F.percentile_approx(field, F.array(*[F.lit(p / 100.0) for p in points]), accuracy)
        out = df.groupBy(*by).agg(q.alias("_q"))
        return out.select(*by, *[F.get("_q", i).alias(n) for i, n in enumerate(names)])
    counts = (df.where(F.col(field).isNotNull()).groupBy(*by, F.col(field).alias("_v"))
              .agg(F.count(F.lit(1)).alias("_c")))
    ranked = running_total(counts, "_v", "_c", by=by, name="_upto")
    totals = df.where(F.col(field).isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    if by:
        placed = _join_groups(ranked, totals, by)
    else:
        placed = ranked.withColumn("_n", totals.scalar())
    aggs = []
    for p, name in zip(points, names):
        at = (F.col("_n") - 1) * (p / 100.0)
        low, high = F.floor(at), F.ceil(at)
        before = F.col("_upto") - F.col("_c")
        v_low = F.max(F.when((low >= before) & (low < F.col("_upto")), F.col("_v")))
        v_high = F.max(F.when((high >= before) & (high < F.col("_upto")), F.col("_v")))
        part = F.max(at - low)
        # equal neighbours need no step between them, which infinite ones have not
        aggs.append(F.when(v_low == v_high, v_low).otherwise(v_low + (v_high - v_low) * part).alias(name))
    return placed.groupBy(*by).agg(*aggs)


def _join_groups(left: DataFrame, right: DataFrame, by: Sequence[str],
                 keys: Sequence[str] = ()) -> DataFrame:
    """Inner join on group columns, where null is a group like any other."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in [*by, *keys]})
    cond = F.lit(True)
    for c in by:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    for c in keys:
        cond = cond & (F.col(c) == F.col(f"_r_{c}"))
    return left.join(renamed, cond).drop(*[f"_r_{c}" for c in [*by, *keys]])


def running_total(df: DataFrame, order: str, value: str, *, by: Sequence[str] = (),
                  name: str = "total", parts: int | None = None) -> DataFrame:
    """Running sum in the order of unique keys of any orderable type, strings too, without one
    task that sees all rows.

    The rows are dealt out by sampled ranges of the keys, so that ranges hold about as many
    rows however the keys lie, and stored once in the shared folder: the ranges are the
    same for all that follows. A range sums on its own, and the sum of the ranges before it
    is added: one row per range and group.
    """
    keys = [*by, order]
    dealt = df.repartitionByRange(*([parts] if parts else []), *keys)
    dealt = pinned(dealt.withColumn("_range", F.spark_partition_id()))
    inside = Window.partitionBy("_range", *by).orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = dealt.withColumn("_inside", F.sum(value).over(inside))
    sums = dealt.groupBy(*by, "_range").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*by, "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    out = _join_groups(local, offsets, by, ["_range"])
    return (out.withColumn(name, F.col("_inside") + F.col("_before"))
            .select(*df.columns, name))


def histogram(df: DataFrame, field: str, interval: float, *, offset: float = 0.0,
              fill: bool = True, metrics: Sequence[Column] = ()) -> DataFrame:
    """Fixed-width buckets ``(key, doc_count, metrics..)``; ``fill`` adds the empty ones."""
    index = F.floor((F.col(field) - offset) / interval).cast("long")
    buckets = (df.where(F.col(field).isNotNull()).groupBy(index.alias("_i"))
               .agg(F.count(F.lit(1)).alias("doc_count"), *metrics))
    if fill:
        ends = buckets.agg(F.min("_i").alias("lo"), F.max("_i").alias("hi")).where("lo IS NOT NULL")
        # in pieces: an outlier may make the row of buckets very long
        piece = ends.select("hi", F.explode(F.sequence("lo", "hi", F.lit(FILL_PIECE).cast("long"))).alias("at"))
        upto = F.least(F.col("at") + (FILL_PIECE - 1), F.col("hi"))
        every = piece.select(F.explode(F.sequence("at", upto)).alias("_i"))
        buckets = every.join(buckets, "_i", "left").withColumn(
            "doc_count", F.coalesce("doc_count", F.lit(0).cast("long")))
    key = (F.col("_i") * float(interval) + float(offset)).alias("key")
    return buckets.select(key, *[c for c in buckets.columns if c != "_i"])


def date_histogram(df: DataFrame, field: str, unit: str, *, fill: bool = True,
                   metrics: Sequence[Column] = ()) -> DataFrame:
    """Calendar buckets: second, minute, hour, day, week, month, quarter or year."""
    # The step from one bucket to the next.
    step = {"second": "1 second", "minute": "1 minute", "hour": "1 hour", "day": "1 day",
            "week": "7 days", "month": "1 month", "quarter": "3 months", "year": "1 year"}[unit]
    dtype = df.schema[field].dataType
    start = F.date_trunc(unit, F.col(field)).cast(dtype)
    buckets = (df.where(F.col(field).isNotNull()).groupBy(start.alias("key"))
               .agg(F.count(F.lit(1)).alias("doc_count"), *metrics))
    if not fill:
        return buckets
    ends = buckets.agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo IS NOT NULL")
    # in pieces, each a row of its own that the tasks share: the calendar step is counted, not
    # listed in one array
    size, word = step.split()
    unit_of = {"days": "DAY", "months": "MONTH"}.get(word, word.upper())
    n = F.expr(f"timestampdiff({unit_of}, lo, hi) div {size}")
    piece = ends.select("lo", "hi", F.explode(F.sequence(F.lit(0).cast("long"), n, F.lit(FILL_PIECE).cast("long"))).alias("at"))
    begin = F.expr(f"timestampadd({unit_of}, cast(at * {size} as bigint), lo)")
    last = F.least(F.expr(f"timestampadd({unit_of}, cast((at + {FILL_PIECE - 1}) * {size} as bigint), lo)"), F.col("hi"))
    every = piece.repartition(F.col("at")).select(F.explode(F.sequence(begin, last, F.expr(f"interval {step}")).cast(T.ArrayType(dtype))).alias("key"))
    return every.join(buckets, "key", "left").withColumn(
        "doc_count", F.coalesce("doc_count", F.lit(0).cast("long")))


def range_agg(df: DataFrame, field: str, ranges: dict[str, tuple[float | None, float | None]],
              metrics: dict[str, Column] | None = None) -> DataFrame:
    """Named ranges (from inclusive, to exclusive; they may overlap) in one pass:
    ``(key, doc_count, metrics..)``."""
    conditions = {}
    for name, (low, high) in ranges.items():
        c = F.col(field).isNotNull()
        if low is not None:
            c &= F.col(field) >= low
        if high is not None:
            c &= F.col(field) < high
        conditions[name] = c
    return filter_aggs(df, conditions, metrics)


def filter_aggs(df: DataFrame, filters: dict[str, Column],
                metrics: dict[str, Column] | None = None) -> DataFrame:
    """One bucket per named filter, all in one pass; ``metrics`` are (summed) columns."""
    aggs = []
    for i, cond in enumerate(filters.values()):
        aggs.append(F.count_if(cond).alias(f"c{i}"))
        for j, m in enumerate((metrics or {}).values()):
            aggs.append(F.sum(F.when(cond, m)).alias(f"m{i}_{j}"))
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(n).alias("key"), F.col(f"c{i}").alias("doc_count"),
                     *[F.col(f"m{i}_{j}").alias(m) for j, m in enumerate(metrics or {})])
            for i, n in enumerate(filters)]
    return one.select(F.explode(F.array(*rows)).alias("b")).select("b.*")


def sub_aggs(df: DataFrame, keys: Sequence[str], metrics: Sequence[Column] = (), *,
             totals: bool = False) -> DataFrame:
    """Buckets within buckets as flat rows; ``totals`` adds the outer buckets (``rollup``)."""
    grouped = df.rollup(*keys) if totals else df.groupBy(*keys)
    level = [F.grouping_id().alias("_level")] if totals else []
    return grouped.agg(F.count(F.lit(1)).alias("doc_count"), *metrics, *level)


def nested_buckets(df: DataFrame, outer: str, inner: str, *, size: int | None = None,
                   inner_size: int = 10) -> DataFrame:
    """All outer buckets, or the ``size`` biggest, each with its top inner buckets as an array."""
    pairs = df.where(F.col(outer).isNotNull()).groupBy(outer, inner).agg(F.count(F.lit(1)).alias("n"))
    outers = (pairs.groupBy(F.col(outer).alias("key")).agg(F.sum("n").alias("doc_count"))
              .orderBy(F.desc("doc_count"), F.asc("key")))
    outers = outers if size is None else outers.limit(size)
    best = top_per_key(pairs, outer, (F.desc("n"), F.asc(inner)), inner_size)
    listed = best.groupBy(F.col(outer).alias("key")).agg(
        F.sort_array(F.collect_list(F.struct("_rank", F.col(inner).alias("key"),
                                             F.col("n").alias("doc_count")))).alias("buckets"))
    return outers.join(listed, "key")


def top_hits(df: DataFrame, key: str, order: Sequence[Column], n: int = 3) -> DataFrame:
    return top_per_key(df, key, order, n)


def missing_agg(df: DataFrame, field: str) -> DataFrame:
    return df.agg(F.count_if(F.col(field).isNull()).alias("doc_count"))


# --- over buckets ----------------------------------------------------------------------------------


def cumulative_sum(buckets: DataFrame, value: str = "doc_count", key: str = "key",
                   name: str = "cumulative") -> DataFrame:
    return running_total(buckets, key, value, name=name)


def _neighbours(buckets: DataFrame, key: str, unit: str | float, back: int, value: str) -> DataFrame:
    """Values of the ``back`` buckets before each one. Buckets have a fixed distance, so the
    earlier ones are found by equal keys instead of a window over all rows."""
    shifted = None
    for i in range(1, back + 1):
        if isinstance(unit, str):
            n, word = unit.split()
            move = F.expr(f"interval {int(n) * i} {word}")
        else:
            move = F.lit(unit * i)
        part = buckets.select((F.col(key) + move).alias(key), F.lit(i).alias("_lag"),
                              F.col(value).alias("_v"))
        shifted = part if shifted is None else shifted.unionByName(part)
    return shifted


def derivative(buckets: DataFrame, unit: str | float, value: str = "doc_count", key: str = "key",
               name: str = "derivative") -> DataFrame:
    """Change against the bucket before (null for the first); buckets must be gap-free."""
    prev = _neighbours(buckets, key, unit, 1, value).select(key, "_v")
    return (buckets.join(prev, key, "left").withColumn(name, F.col(value) - F.col("_v")).drop("_v"))


def moving_average(buckets: DataFrame, unit: str | float, window: int, value: str = "doc_count",
                   key: str = "key", name: str = "moving_avg") -> DataFrame:
    """Mean of the ``window`` buckets before each one, itself excluded."""
    prev = (_neighbours(buckets, key, unit, window, value).groupBy(key)
            .agg(F.avg("_v").alias(name)))
    return buckets.join(prev, key, "left")


def bucket_sort(buckets: DataFrame, order: Sequence[Column], size: int, start: int = 0) -> DataFrame:
    return buckets.orderBy(*order).offset(start).limit(size)


def geohash_grid(df: DataFrame, cell: str, size: int | None = None) -> DataFrame:
    """Rows per cell of an existing cell column."""
    return terms_agg(df, cell, size)


def geo_bounds(df: DataFrame, location: str) -> DataFrame:
    lat, lon = F.col(location)["lat"], F.col(location)["lon"]
    return df.agg(F.max(lat).alias("top"), F.min(lon).alias("left"),
                  F.min(lat).alias("bottom"), F.max(lon).alias("right"))
