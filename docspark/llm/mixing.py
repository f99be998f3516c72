"""Mixing sources to target weights: capped water-filling and seeded repetitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, pinned, ranked

#: Slots of the seeded order of a source; a target is met to half a slot, or half a document.
SLOTS = 4096


def slot(id: str, seed: int) -> Column:
    """The seeded place of a document, one of ``SLOTS``. Equal ids have equal places."""
    key = F.concat_ws(":", F.lit(str(seed)), F.col(id).cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 3), 16, 10).cast("int")


def water_level(sources: DataFrame, budget: float) -> tuple[float, float]:
    """The level L and budget left over for which the sum of ``least(cap, L * weight)`` is
    ``budget``.

    Every round clamps the sources that stand above their cap and shares what is left among
    the rest by weight. The level only rises, so no clamped source comes back; a round is one
    aggregate of the sources, of which one row reaches the driver. If all are clamped the level
    is infinite and the rest of the budget cannot be placed.
    """
    level, seen = 0.0, None
    while True:
        free = F.col("cap") >= F.lit(level) * F.col("weight")
        row = sources.agg(F.sum(F.when(free, F.col("weight"))).alias("w"),
                          F.coalesce(F.sum(F.when(~free, F.col("cap"))), F.lit(0)).alias("c"),
                          F.count(F.when(free, F.lit(1))).alias("n")).first()
        if not row["w"]:
            return float("inf"), budget - row["c"]
        if row["n"] == seen:
            return level, 0.0
        seen, level = row["n"], (budget - row["c"]) / row["w"]


def mix(docs: DataFrame, *, text: str = "text", source: str = "source", id: str = "doc_id",
        weights: Sequence[int] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2,
        seed: int = 20240601) -> DataFrame:
    """How many words of each document a mix takes: ``(id, size, source_size, target, taken)``.

    The size of a text is its number of words. The sources, in code point order and null last,
    weigh ``weights`` in turn and share ``share`` times all sizes. A target is clamped at
    ``max_epochs`` times the size of its source, what is clamped off is shared again by weight.
    A document is taken as often as its source repeats in whole; the fraction of a repetition
    takes documents in a seeded order until its share of the words is reached.

    The order is by ``SLOTS`` slots per source, so no source is sorted in one task: the words
    of a slot are summed first and the fraction ends with the slot that comes nearest.

    Null and empty texts have size 0 and take 0. A null source is a source. Rows with one id,
    also a null id, are taken or left together; repeated rows count as rows. An empty table gives
    none. Other columns are not looked at.
    """
    sized = docs.select(F.col(id).alias("id"), F.col(source).alias("source"),
                        n_words(F.col(text)).alias("size"), slot(id, seed).alias("slot"))
    slots = pinned(sized.groupBy("source", "slot").agg(F.sum("size").alias("mass")))
    totals = slots.groupBy("source").agg(F.sum("mass").alias("source_size"))
    in_turn = F.array(*[F.lit(int(w)) for w in weights])
    sources = ranked(totals, F.col("source").asc_nulls_last()).select(
        "source", "source_size", (F.col("source_size") * max_epochs).alias("cap"),
        F.element_at(in_turn, (F.col("rank") % len(weights) + 1).cast("int")).alias("weight"))
    sources = pinned(sources)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, _ = water_level(sources, share * total)
    target = F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    goals = (sources.withColumn("target", target).withColumn("whole", F.floor(rate))
             .withColumn("want", (rate - F.floor(rate)) * F.col("source_size"))
             .select(F.col("source").alias("of"), "source_size", "target", "whole", "want"))

    # at most SLOTS rows per source
    running = Window.partitionBy("source").orderBy("slot")
    reach = slots.withColumn("reach", F.sum("mass").over(running) - F.col("mass") / 2)
    same = F.col("source").eqNullSafe(F.col("of"))
    cuts = (goals.join(reach, same).groupBy("of", "source_size", "target", "whole")
            .agg(F.coalesce(F.max(F.when((F.col("reach") <= F.col("want")) & (F.col("want") > 0),
                                         F.col("slot"))), F.lit(-1)).alias("cut")))
    # sizes and keys only, no text; a hot source is split by the adaptive skew join
    joined = sized.join(cuts, same)
    times = F.col("whole") + (F.col("slot") <= F.col("cut")).cast("long")
    return joined.select(F.col("id").alias(id), "size", "source_size", "target",
                         (F.col("size") * times).alias("taken"))
