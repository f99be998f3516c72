"""Joins without an equal key: points near sites, ranges that overlap. Both get one."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from .aggs import running_total

#: Parts of the side of a cell into which points and boxes are dealt.
FINER = 4


def proximity_join(points: DataFrame, sites: DataFrame, metres: float, *, point_location: str,
                   site_location: str) -> DataFrame:
    """Pairs (point, site) at most ``metres`` apart (plane distance), with ``_distance``.

    A point lies in one cell of a grid as high and wide as the radius. A site is repeated
    for the few cells its circle can touch, and meets the points by cell; then the distance
    decides. A crowded cell is a skewed join key that AQE splits on the points' side.
    """
    step = math.degrees(metres / geo.EARTH_RADIUS) * (1 + 1e-9) + 1e-12
    lat, lon = F.col(point_location)["lat"], F.col(point_location)["lon"]
    keyed = points.withColumns({"_row": F.floor(lat / step), "_col": F.floor(lon / step)})
    s_lat, s_lon = F.col(site_location)["lat"], F.col(site_location)["lon"]
    cos = F.cos(F.radians(F.least(F.lit(89.9), F.abs(s_lat) + step / 2)))
    reach = F.lit(step) / cos
    covered = (sites
               .withColumn("_row", F.explode(F.sequence(F.floor((s_lat - step) / step),
                                                        F.floor((s_lat + step) / step))))
               .withColumn("_col", F.explode(F.sequence(F.floor((s_lon - reach) / step),
                                                        F.floor((s_lon + reach) / step)))))
    joined = keyed.join(covered, ["_row", "_col"])
    distance = geo.plane_distance(lat, lon, s_lat, s_lon)
    return joined.withColumn("_distance", distance).where(F.col("_distance") <= metres).drop("_row", "_col")


def count_near(points: DataFrame, sites: DataFrame, metres: float, *, point_location: str,
               site_location: str, site_id: str) -> DataFrame:
    """``(site_id, near)`` with zero rows included.

    Points at the same place are counted before the join, so a crowded address is one row.
    """
    places = points.groupBy(F.col(point_location).alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    pairs = proximity_join(places, sites.select(site_id, F.col(site_location).alias("_s")), metres,
                           point_location="_p", site_location="_s")
    near = pairs.groupBy(site_id).agg(F.sum("_c").alias("near"))
    return sites.select(site_id).join(near, site_id, "left").withColumn(
        "near", F.coalesce("near", F.lit(0)))


def points_in_areas(points: DataFrame, areas: DataFrame, cell_degrees: float, *, location: str,
                    box: str) -> DataFrame:
    """Pairs of points and the boxes (``struct<top,left,bottom,right>``) they lie in.

    Choose the cell near the boxes' size. Boxes are repeated for the grid cells they cover, a quarter as
    high and wide, so that fewer points beside a box are compared. Points are dealt evenly first: a small
    file of points that is read by one task may be in many boxes.
    """
    lat, lon = F.col(location)["lat"], F.col(location)["lon"]
    spark, step = points.sparkSession, cell_degrees / FINER
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = points.repartition(tasks).withColumns({"_row": F.floor(lat / step), "_col": F.floor(lon / step)})
    # a box over the antimeridian is two boxes for the grid
    whole = F.col(box)
    halves = F.when(whole["left"] <= whole["right"], F.array(F.struct(whole["left"].alias("l"), whole["right"].alias("r")))).otherwise(
        F.array(F.struct(whole["left"].alias("l"), F.lit(180.0).alias("r")),
                F.struct(F.lit(-180.0).alias("l"), whole["right"].alias("r"))))
    b, part = whole, F.col("_part")
    covered = (areas.withColumn("_part", F.explode(halves))
               .withColumn("_row", F.explode(F.sequence(F.floor(b["bottom"] / step),
                                                        F.floor(b["top"] / step))))
               .withColumn("_col", F.explode(F.sequence(F.floor(part["l"] / step),
                                                        F.floor(part["r"] / step)))))
    inside = lat.between(b["bottom"], b["top"]) & lon.between(part["l"], part["r"])
    return keyed.join(covered, ["_row", "_col"]).where(inside).drop("_row", "_col", "_part")


def count_overlaps(left: DataFrame, right: DataFrame, *, left_range: tuple[str, str],
                   right_range: tuple[str, str], left_id: str,
                   left_open: bool = False, right_open: bool = False) -> DataFrame:
    """``(left_id, overlaps)``: how many ranges of ``right`` touch each range of ``left``.

    Ranges of numbers or times; a null side is open to that side. Ranges include both ends, or
    with ``left_open`` / ``right_open`` only their beginnings. ``right`` ranges that start
    before the end, less those that end before the start: two rank lookups in sorted bounds and
    no pair is built. Of a range that ends before it begins nothing is defined.
    """
    lo, hi = left_range
    probes = left.select(F.col(left_id), F.col(lo).alias("_lo"), F.col(hi).alias("_hi"))
    n = right.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(right_range[0]).isNull()).alias("unstarted"))

    def rank(bounds: DataFrame, of: DataFrame, strict: bool) -> DataFrame:
        # bounds <= probe, or < probe if strict
        side = (bounds.where("x is not null").groupBy("x").agg(F.count(F.lit(1)).alias("_n"))
                .unionByName(of.select("x").where("x is not null").distinct().withColumn("_n", F.lit(0).cast("long"))))
        merged = side.groupBy("x").agg(F.sum("_n").alias("_n"))
        total = running_total(merged, "x", "_n", name="_upto")
        value = F.col("_upto") - F.col("_n") if strict else F.col("_upto")
        return total.select("x", value.alias("_r"))

    # started: begins at or before the end (before it, where the end does not belong to left);
    # ended: ends before the start (at it, where the end does not belong to right)
    started = rank(right.select(F.col(right_range[0]).alias("x")), probes.select(F.col("_hi").alias("x")), left_open)
    ended = rank(right.select(F.col(right_range[1]).alias("x")), probes.select(F.col("_lo").alias("x")), not right_open)
    out = probes.join(started.select(F.col("x").alias("_hi"), F.col("_r").alias("_s")), "_hi", "left")
    out = out.join(ended.select(F.col("x").alias("_lo"), F.col("_r").alias("_e")), "_lo", "left")
    every = n.select(F.struct("n", "unstarted").alias("s")).scalar()
    begun = F.when(F.col("_hi").isNull(), every["n"]).otherwise(F.coalesce("_s", F.lit(0)) + every["unstarted"])
    return out.select(left_id, (begun - F.coalesce("_e", F.lit(0))).alias("overlaps"))


RELATIONS = ("intersects", "contains", "within")


def range_pairs(left: DataFrame, right: DataFrame, *, left_range: tuple[str, str], right_range: tuple[str, str],
                width: float, relation: str = "intersects", half_open: bool = False) -> DataFrame:
    """Pairs of ranges of numbers: those that touch, or where left ``contains`` right or lies
    ``within`` it. A null side is open to that side; with ``half_open`` ends do not belong.

    The values are cut into blocks of ``width``, best about as wide as most ranges, and into blocks of
    twice, four times that width, and so on. A range has the level at which it is no longer than
    a block, so it lies in one or two blocks there, however long it is. Two ranges meet at
    the higher one of their levels, to which the other one goes up; only levels that occur are
    used, and one number for each reaches the driver. A pair that shares two blocks is made in the first of
    them only. Open sides end at the outermost bound of both tables.
    """
    if relation not in RELATIONS:
        raise ValueError(f"relation must be one of {RELATIONS}")

    def bounds(df: DataFrame, names: tuple[str, str]) -> Column:
        lo, hi = F.col(names[0]).cast("double"), F.col(names[1]).cast("double")
        return df.agg(F.struct(F.least(F.min(lo), F.min(hi)).alias("lo"), F.greatest(F.max(lo), F.max(hi)).alias("hi"))).scalar()

    l_bounds, r_bounds = bounds(left, left_range), bounds(right, right_range)
    lowest, highest = F.least(l_bounds["lo"], r_bounds["lo"]), F.greatest(l_bounds["hi"], r_bounds["hi"])

    def levelled(df: DataFrame, names: tuple[str, str], side: str) -> tuple[DataFrame, list[int]]:
        first = F.coalesce(F.col(names[0]).cast("double"), lowest)
        last = F.coalesce(F.col(names[1]).cast("double"), highest)
        level = F.greatest(F.ceil(F.log2(F.greatest(last - first, F.lit(0.0)) / width)), F.lit(0)).cast("int")
        out = df.withColumns({f"_{side}_lo": first, f"_{side}_hi": last}).where(first <= last)
        out = out.withColumn(f"_{side}_level", F.coalesce(level, F.lit(0)))
        return out, sorted(r[0] for r in out.select(f"_{side}_level").distinct().collect())

    def at(df: DataFrame, side: str, levels: Column) -> DataFrame:
        """The rows in the blocks that they have at each of the levels."""
        size = F.pow(F.lit(2.0), F.col("_level")) * width
        lo, hi = F.floor(F.col(f"_{side}_lo") / size), F.floor(F.col(f"_{side}_hi") / size)
        up = df.withColumn("_level", F.explode(levels)).withColumn(f"_{side}", lo)
        return up.withColumn("_block", F.explode(F.sequence(lo, hi)))

    def above(side: str, levels: list[int], strictly: bool) -> Column:
        own = F.col(f"_{side}_level")
        return F.filter(F.array(*[F.lit(n) for n in levels]).cast("array<int>"), lambda n: n > own if strictly else n >= own)

    a, b = (F.col(c).cast("double") for c in left_range)
    c, d = (F.col(x).cast("double") for x in right_range)
    before = (lambda x, y: x < y) if half_open else (lambda x, y: x <= y)
    open_or = lambda test, *sides: reduce(lambda x, s: x | s.isNull(), sides, test)
    if relation == "intersects":
        holds = open_or(before(a, d), a, d) & open_or(before(c, b), c, b)
    elif relation == "contains":
        holds = (a.isNull() | F.coalesce(a <= c, F.lit(False))) & (b.isNull() | F.coalesce(d <= b, F.lit(False)))
    else:
        holds = (c.isNull() | F.coalesce(c <= a, F.lit(False))) & (d.isNull() | F.coalesce(b <= d, F.lit(False)))
    lefts, left_levels = levelled(left, left_range, "left")
    rights, right_levels = levelled(right, right_range, "right")
    own = lambda side: F.array(f"_{side}_level")
    # left goes up to the level of right, or right to a higher one of left
    up = at(lefts, "left", above("left", right_levels, False)).join(at(rights, "right", own("right")), ["_level", "_block"])
    down = at(lefts, "left", own("left")).join(at(rights, "right", above("right", left_levels, True)), ["_level", "_block"])
    meet = up.unionByName(down).where((F.col("_block") == F.greatest("_left", "_right")) & holds)
    return meet.drop("_level", "_block", *[f"_{side}{x}" for side in ("left", "right") for x in ("", "_lo", "_hi", "_level")])
