"""Parent/child relations between rows: joins on the parent key.

Children are always aggregated per parent before they meet it; the aggregation is
partial in every task, so a parent with very many children is no hot group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .collapse import top_per_key

SCORE_MODES = ("none", "avg", "max", "min", "sum")


def has_child(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str,
              predicate: Column | None = None, *, min_children: int = 1,
              max_children: int | None = None, score_mode: str = "none",
              child_score: Column | None = None, score: str = "_score") -> DataFrame:
    """Parents with ``min_children .. max_children`` matching children."""
    if score_mode not in SCORE_MODES:
        raise ValueError(f"score mode must be one of {SCORE_MODES}")
    found = children if predicate is None else children.where(predicate)
    if score_mode == "none" and min_children <= 1 and max_children is None:
        return parents.join(found.select(F.col(child_key).alias(parent_key)), parent_key, "left_semi")
    value = F.lit(1.0) if child_score is None else child_score
    aggs = [F.count(F.lit(1)).alias("_children")]
    if score_mode != "none":
        fn = {"avg": F.avg, "max": F.max, "min": F.min, "sum": F.sum}[score_mode]
        aggs.append(fn(value).alias(score))
    per_parent = found.groupBy(F.col(child_key).alias(parent_key)).agg(*aggs)
    keep = F.col("_children") >= max(min_children, 1)
    if max_children is not None:
        keep &= F.col("_children") <= max_children
    out = parents.join(per_parent.where(keep), parent_key)
    return out.drop("_children")


def not_has_child(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str,
                  predicate: Column | None = None) -> DataFrame:
    found = children if predicate is None else children.where(predicate)
    return parents.join(found.select(F.col(child_key).alias(parent_key)), parent_key, "left_anti")


def has_parent(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str,
               predicate: Column | None = None, *, parent_score: Column | None = None,
               score: str = "_score") -> DataFrame:
    """Children whose parent matches; with ``parent_score`` they take over its score."""
    found = parents if predicate is None else parents.where(predicate)
    if parent_score is None:
        return children.join(found.select(F.col(parent_key).alias(child_key)), child_key, "left_semi")
    scored = found.select(F.col(parent_key).alias(child_key), parent_score.alias(score))
    return children.join(scored, child_key)


def parent_id(children: DataFrame, child_key: str, value, type_column: str | None = None,
              child_type: str | None = None) -> DataFrame:
    """Children (of one type) of one parent."""
    found = F.col(child_key) == F.lit(value)
    if type_column is not None:
        found &= F.col(type_column) == child_type
    return children.where(found)


def relation_levels(levels: Sequence[tuple[DataFrame, str, str | None]], root: str) -> DataFrame:
    """Several levels, root first: ``(rows, id, parent id column)`` each. The last level's
    rows get the root id, which is their routing value."""
    (top, top_id, _), *rest = levels
    path = top.select(F.col(top_id).alias(root), F.col(top_id).alias("_up"))
    for i, (rows, id_, parent) in enumerate(rest):
        joined = rows.join(path, rows[parent] == path["_up"]).drop("_up")
        if i + 1 == len(rest):
            return joined
        path = joined.select(root, F.col(id_).alias("_up"))
    return path.drop("_up")


def join_inner_hits(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str,
                    order: Sequence[Column], fields: Sequence[str], *, size: int = 3,
                    predicate: Column | None = None, name: str = "inner_hits") -> DataFrame:
    """Matching parents with their best ``size`` children as an array. Children are cut to
    ``size`` per parent in every task, then once more after the shuffle."""
    found = children if predicate is None else children.where(predicate)
    best = top_per_key(found, child_key, order, size)
    listed = best.groupBy(F.col(child_key).alias(parent_key)).agg(
        F.sort_array(F.collect_list(F.struct("_rank", *fields))).alias(name))
    return parents.join(listed, parent_key)


def same_index_relation(df: DataFrame, relation: str, name: str) -> DataFrame:
    """Rows of one relation of a collection that keeps parents and children together."""
    return df.where(F.col(relation) == name)
