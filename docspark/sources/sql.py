"""SQL over collections, and saved searches with parameters."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Template = str | Callable[..., DataFrame]


def sql(spark: SparkSession, query: str, tables: Mapping[str, DataFrame], *,
        args: Mapping[str, Any] | Sequence[Any] | None = None,
        filters: Mapping[str, Column] | None = None, fetch_size: int | None = None,
        time_zone: str | None = None) -> DataFrame:
    """Run a statement on named tables.

    ``filters`` narrows a table before the statement sees it. ``args`` are bound as
    literals, never pasted into the text. ``time_zone`` shifts the UTC timestamps of the
    result.
    """
    for name, df in tables.items():
        cond = (filters or {}).get(name)
        (df if cond is None else df.where(cond)).createOrReplaceTempView(name)
    bound = check_params(args) if args is not None else None
    out = spark.sql(query, args=bound) if bound is not None else spark.sql(query)
    if time_zone is not None:
        times = [f.name for f in out.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
        out = out.withColumns({c: F.from_utc_timestamp(c, time_zone) for c in times})
    return out.limit(fetch_size) if fetch_size is not None else out


def sql_columns(result: DataFrame) -> DataFrame:
    """The columns of a result as data: name and type."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(result.schema)]
    return result.sparkSession.createDataFrame(rows, "position int, name string, type string")


def check_params(args: Mapping[str, Any] | Sequence[Any]) -> Any:
    """Values for a saved query. A missing value is an error; a collection becomes an array."""
    def one(name, v):
        if v is None:
            raise ValueError(f"parameter {name} is null")
        if isinstance(v, (list, tuple, set, frozenset)):
            if any(x is None for x in v):
                raise ValueError(f"parameter {name} holds a null")
            return F.array(*[F.lit(x) for x in v])
        return v
    if isinstance(args, Mapping):
        return {k: one(k, v) for k, v in args.items()}
    return [one(i, v) for i, v in enumerate(args)]


class TemplateRegistry:
    """Saved searches by id: an SQL text with ``:name`` markers, or a function."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._saved: dict[str, Template] = {}

    def put(self, id: str, template: Template) -> None:
        self._saved[id] = template

    def get(self, id: str) -> Template | None:
        return self._saved.get(id)

    def delete(self, id: str) -> bool:
        return self._saved.pop(id, None) is not None

    def search(self, id: str, tables: Mapping[str, DataFrame], params: Mapping[str, Any]) -> DataFrame:
        template = self._saved.get(id)
        if template is None:
            raise KeyError(f"no saved search {id!r}")
        if callable(template):
            check_params(params)
            return template(tables, **params)
        return sql(self.spark, template, tables, args=params)

    def multi_search(self, requests: Sequence[tuple[str, Mapping[str, Any]]],
                     tables: Mapping[str, DataFrame]) -> list[DataFrame]:
        return [self.search(i, tables, p) for i, p in requests]
