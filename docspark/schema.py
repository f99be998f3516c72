"""What the columns of a collection mean: roles, stored names, analyzers, converters."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.analysis import STANDARD, Analyzer

ROLES = ("text", "keyword", "numeric", "date", "boolean", "geo", "vector", "nested", "range", "object")


@dataclass(frozen=True)
class FieldSpec:
    """One field. ``column`` is the stored name where it differs from ``name``."""

    name: str
    role: str = "keyword"
    column: str | None = None
    analyzer: Analyzer = STANDARD
    # query values are passed through ``convert`` before they meet the stored values
    convert: Callable[[Any], Any] | None = None
    null_value: Any = None
    ignore_above: int | None = None

    def __post_init__(self):
        if self.role not in ROLES:
            raise ValueError(f"unknown role {self.role!r} of field {self.name!r}")

    @property
    def stored(self) -> str:
        return self.column or self.name

    def value(self, value: Any) -> Any:
        if self.convert is None or value is None:
            return value
        if isinstance(value, (list, tuple, set)):
            return [self.convert(v) for v in value]
        return self.convert(value)


def _role_of(data_type: T.DataType) -> str:
    if isinstance(data_type, T.ArrayType):
        inner = data_type.elementType
        if isinstance(inner, T.StructType):
            return "nested"
        if isinstance(inner, T.FloatType):
            return "vector"
        return _role_of(inner)
    if isinstance(data_type, T.StructType):
        names = set(data_type.fieldNames())
        if names == {"lat", "lon"}:
            return "geo"
        if {"lo", "hi", "lo_incl", "hi_incl"} <= names:
            return "range"
        return "object"
    if isinstance(data_type, T.NumericType):
        return "numeric"
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "date"
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    return "keyword" if isinstance(data_type, T.StringType) else "object"


class DocSchema:
    """Fields by property name, with the id, version and routing columns of a collection."""

    def __init__(self, fields: Iterable[FieldSpec], id: str | None = None,
                 version: str | None = None, routing: str | None = None):
        self.fields = {f.name: f for f in fields}
        self.id, self.version, self.routing = id, version, routing

    @classmethod
    def of(cls, source: DataFrame | T.StructType, text: Iterable[str] = (), id: str | None = None,
           version: str | None = None, routing: str | None = None,
           overrides: Iterable[FieldSpec] = ()) -> DocSchema:
        """Roles from the types; strings are exact unless named in ``text``."""
        struct = source.schema if isinstance(source, DataFrame) else source
        text = set(text)
        specs: list[FieldSpec] = []

        def walk(st: T.StructType, prefix: str):
            for f in st.fields:
                path = prefix + f.name
                role = "text" if path in text else _role_of(f.dataType)
                specs.append(FieldSpec(path, role))
                inner = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
                if isinstance(inner, T.StructType) and role in ("nested", "object"):
                    walk(inner, path + ".")

        walk(struct, "")
        schema = cls(specs, id=id, version=version, routing=routing)
        for spec in overrides:
            schema.fields[spec.name] = spec
        return schema

    def field(self, name: str) -> FieldSpec:
        if name in self.fields:
            return self.fields[name]
        head, _, rest = name.partition(".")
        while rest:
            if head in self.fields:
                parent = self.fields[head]
                return FieldSpec(name, "keyword", f"{parent.stored}.{rest}")
            part, _, rest = rest.partition(".")
            head = f"{head}.{part}"
        return FieldSpec(name)

    def nested_path(self, name: str) -> str | None:
        """The shallowest nested ancestor of a path, if any."""
        parts = name.split(".")
        for i in range(1, len(parts)):
            prefix = ".".join(parts[:i])
            if prefix in self.fields and self.fields[prefix].role == "nested":
                return prefix
        return None

    def with_fields(self, *specs: FieldSpec) -> DocSchema:
        other = DocSchema(self.fields.values(), self.id, self.version, self.routing)
        other.fields.update({s.name: s for s in specs})
        return other

    def renamed(self, mapping: dict[str, str]) -> DocSchema:
        """Property names to stored column names."""
        specs = [replace(f, column=mapping.get(f.name, f.column)) for f in self.fields.values()]
        return DocSchema(specs, self.id, self.version, self.routing)

    def describe(self, docs: DataFrame) -> DataFrame:
        """The mapping as data: path, stored column, role, analyzer, and how many documents
        have a value. One pass over the data, one row per field."""
        specs = [f for f in self.fields.values() if self.nested_path(f.name) is None]
        counts = docs.agg(*[F.count(F.col(f.stored)).alias(f"c{i}") for i, f in enumerate(specs)])
        rows = [F.struct(F.lit(f.name).alias("field"), F.lit(f.stored).alias("stored"),
                         F.lit(f.role).alias("role"),
                         F.lit(f.analyzer.name if f.role == "text" else None).cast("string").alias("analyzer"),
                         F.col(f"c{i}").alias("documents")) for i, f in enumerate(specs)]
        return counts.select(F.explode(F.array(*rows)).alias("f")).select("f.*")


def stored_value(spec: FieldSpec, column: Column) -> Column:
    """A column as it is searched: null replacement, over-long values left out."""
    if spec.null_value is not None:
        column = F.coalesce(column, F.lit(spec.null_value))
    if spec.ignore_above is not None:
        column = F.when(F.length(column) <= spec.ignore_above, column)
    return column
