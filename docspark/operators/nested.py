"""Nested objects: arrays of structs that belong to their row."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Predicate = Callable[[Column], Column]


def _two_valued(predicate: Predicate) -> Predicate:
    return lambda x: F.coalesce(predicate(x), F.lit(False))


def nested_match(array: Column | str, predicate: Predicate) -> Column:
    """One element satisfies the predicate. A conjunction in one predicate asks for one
    and the same element; two ``nested_match`` joined by ``&`` do not."""
    array = F.col(array) if isinstance(array, str) else array
    return F.coalesce(F.exists(array, _two_valued(predicate)), F.lit(False))


def nested_score(array: Column | str, predicate: Predicate, score: Predicate,
                 mode: str = "avg") -> Column:
    """Score of a row from its matching elements: avg, sum, max, min or none."""
    array = F.col(array) if isinstance(array, str) else array
    scores = F.transform(F.filter(array, _two_valued(predicate)), score)
    total = F.aggregate(scores, F.lit(0.0), lambda a, x: a + x)
    if mode == "none":
        return F.lit(0.0)
    if mode == "sum":
        return total
    if mode == "avg":
        return F.when(F.size(scores) > 0, total / F.size(scores))
    return {"max": F.array_max, "min": F.array_min}[mode](scores)


def include_in_parent(df: DataFrame, array: str, *fields: str) -> DataFrame:
    """Element values as flat arrays of the parent, named ``array_field``."""
    def values(field: str) -> Column:
        return F.transform(array, lambda x: x.getField(field))

    return df.withColumns({f"{array}_{f}": values(f) for f in fields})


def inner_hits(df: DataFrame, array: str, predicate: Predicate, *, order: Callable | None = None,
               start: int = 0, size: int = 3, name: str = "inner_hits",
               total: str | None = None) -> DataFrame:
    """The matching elements of each row with their offsets in the array.

    Works inside the row (an array belongs to one row anyway), so nothing is exploded or
    shuffled. ``order(element)`` gives an ascending key; the default keeps array order.
    """
    positioned = F.transform(array, lambda x, i: F.struct(i.alias("offset"), x.alias("hit")))
    found = F.filter(positioned, lambda p: _two_valued(predicate)(p["hit"]))
    if order is not None:
        keyed = F.transform(found, lambda p: F.struct(order(p["hit"]).alias("k"), p["offset"], p["hit"]))
        found = F.transform(F.sort_array(keyed), lambda p: F.struct(p["offset"], p["hit"]))
    out = df.withColumn("_found", found).where(F.size("_found") > 0)
    if total is not None:
        out = out.withColumn(total, F.size("_found"))
    return out.withColumn(name, F.slice("_found", start + 1, size)).drop("_found")


def inner_hits_rows(df: DataFrame, id: str, path: Sequence[str], predicate: Predicate) -> DataFrame:
    """Matching elements several levels down: one row each, with the offset at every level
    (``_offset_0``, ``_offset_1``, ...)."""
    out = df.select(id, F.col(path[0]).alias("_a0"))
    offsets = []
    for level, _ in enumerate(path):
        offsets.append(f"_offset_{level}")
        # an inner explode would evaluate the arrays twice, once to test their size
        out = out.select(id, *offsets[:-1], F.posexplode_outer(f"_a{level}").alias(offsets[-1], "hit"))
        if level + 1 < len(path):
            out = out.select(id, *offsets, F.col("hit").getField(path[level + 1]).alias(f"_a{level + 1}"))
    return out.where(F.col(offsets[-1]).isNotNull() & _two_valued(predicate)(F.col("hit")))


def nested_rows(df: DataFrame, array: str, *keep: str) -> DataFrame:
    """One row per element, parent columns kept, for nested aggregations."""
    rows = df.select(*keep, F.posexplode_outer(array).alias("_offset", "_element"))
    return rows.where(F.col("_offset").isNotNull())
