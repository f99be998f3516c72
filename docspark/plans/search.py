"""The search request: predicate, score, sort, page, projection, as one lazy plan."""

from __future__ import annotations

import fnmatch
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo
from ..operators import scoring
from ..operators.aggs import running_total
from ..operators.collapse import best_per_key
from ..schema import DocSchema
from ..sources.textindex import TextIndex
from .criteria import Bool, Context, Criteria, MatchAll, Node, literal

# Fixed value: rows of a page.
DEFAULT_PAGE = 10


@dataclass(frozen=True)
class Order:
    """One sort key.

    ``missing`` is ``"last"`` (the default for both directions), ``"first"`` or a value.
    ``mode`` reduces several values of a field. ``nested_filter`` gets one element of the
    nested array and says whether it takes part; ``max_children`` bounds how many do.
    """

    field: str
    descending: bool = False
    missing: Any = "last"
    mode: str | None = None
    unmapped: str | None = None
    nested_filter: Callable[[Column], Column] | None = None
    max_children: int | None = None
    # for arrays inside the nested one, by path: their own filter and number of children
    levels: Mapping[str, tuple[Callable[[Column], Column] | None, int | None]] = field(default_factory=dict)
    origin: geo.Point | None = None
    unit: str = "m"
    distance: str = "arc"

    def desc(self) -> Order:
        return replace(self, descending=True)


def reduce_values(values: Column, mode: str) -> Column:
    """min / max / sum / avg / median of an array column, nulls ignored."""
    if mode == "min":
        return F.array_min(values)
    if mode == "max":
        return F.array_max(values)
    present = F.array_compact(values)
    total = F.aggregate(present, F.lit(0.0), lambda a, x: a + x)
    if mode == "sum":
        return F.when(F.size(present) > 0, total)
    if mode == "avg":
        return F.when(F.size(present) > 0, total / F.size(present))
    if mode == "median":
        ordered, n = F.sort_array(present), F.size(present)
        low, high = F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")
        return F.when(n > 0, (F.get(ordered, low) + F.get(ordered, high)) / 2.0)
    raise ValueError(f"unknown sort mode {mode!r}")


def sort_key(order: Order, ctx: Context) -> Column:
    """The value a row is sorted by."""
    if order.field == "_score":
        return F.col("_score")
    spec = ctx.schema.field(order.field)
    nested = ctx.schema.nested_path(order.field)
    if nested is not None:
        elements = F.col(ctx.schema.field(nested).stored)
        if order.nested_filter is not None:
            elements = F.filter(elements, order.nested_filter)
        if order.max_children is not None:
            elements = F.slice(elements, 1, order.max_children)
        inner = order.field[len(nested) + 1:].split(".")

        def values(arr: Column, path: list[str]) -> Column:
            at = ".".join([nested, *inner[:len(inner) - len(path) + 1]])
            keep, most = order.levels.get(at, (None, None))

            def child(e: Column) -> Column:
                below = e.getField(path[0])
                below = below if keep is None else F.filter(below, keep)
                return below if most is None else F.slice(below, 1, most)

            out = F.transform(arr, child)
            dtype = ctx.type_of(at)
            if isinstance(dtype, T.ArrayType):
                out = F.flatten(out)
            return values(out, path[1:]) if len(path) > 1 else out

        key = reduce_values(values(elements, inner),
                            order.mode or ("max" if order.descending else "min"))
    else:
        dtype = ctx.type_of(spec.stored)
        if dtype is None:
            if order.unmapped is None:
                raise ValueError(f"no such field to sort by: {order.field}")
            return F.lit(None).cast(order.unmapped)
        key = F.col(spec.stored)
        if order.origin is not None:
            key = geo.distance_to(key, order.origin, order.distance, order.unit)
        elif isinstance(dtype, T.ArrayType):
            key = reduce_values(key, order.mode or ("max" if order.descending else "min"))
    if order.missing not in ("first", "last"):
        key = F.coalesce(key, F.lit(order.missing))
    return key


def sort_columns(orders: Sequence[Order], ctx: Context) -> list[Column]:
    out = []
    for o in orders:
        key = sort_key(o, ctx)
        first = o.missing == "first"
        if o.descending:
            out.append(key.desc_nulls_first() if first else key.desc_nulls_last())
        else:
            out.append(key.asc_nulls_first() if first else key.asc_nulls_last())
    return out


def after_predicate(orders: Sequence[Order], values: Sequence[Any], ctx: Context) -> Column:
    """Rows that sort strictly after ``values`` (keyset paging). A None value is a null key."""
    if len(orders) != len(values):
        raise ValueError("search_after needs one value per sort key")
    out, equal = F.lit(False), F.lit(True)
    for o, v in zip(orders, values):
        key = sort_key(o, ctx)
        first = o.missing == "first"
        if v is None:
            beyond, same = (key.isNotNull() if first else F.lit(False)), key.isNull()
        else:
            value = literal(v, ctx.type_of(ctx.schema.field(o.field).stored)
                            if o.mode is None and o.origin is None else None)
            beyond = F.coalesce(key < value if o.descending else key > value, F.lit(False))
            if not first:
                beyond = beyond | key.isNull()
            same = F.coalesce(key == value, F.lit(False))
        out = out | (equal & beyond)
        equal = equal & same
    return out


def source_filter(df: DataFrame, includes: Sequence[str] = (), excludes: Sequence[str] = (),
                  fetch: bool = True) -> DataFrame:
    """Leaf columns by path pattern; a named object stands for all of its leaves."""
    if not fetch:
        return df.select()

    def keep(path: str) -> bool:
        def hit(patterns):
            return any(fnmatch.fnmatchcase(path, p) or fnmatch.fnmatchcase(path, p + ".*")
                       for p in patterns)
        return (not includes or hit(includes)) and not hit(excludes)

    def build(struct: T.StructType, prefix: str, base: Callable[[str], Column]) -> list[Column]:
        out = []
        for f in struct.fields:
            path = prefix + f.name
            if isinstance(f.dataType, T.StructType):
                parent = base(f.name)
                inner = build(f.dataType, path + ".", lambda n, p=parent: p.getField(n))
                if inner:
                    out.append(F.when(parent.isNotNull(), F.struct(*inner)).alias(f.name))
            elif keep(path):
                out.append(base(f.name).alias(f.name))
        return out

    return df.select(*build(df.schema, "", F.col))


@dataclass(frozen=True)
class Search:
    """An immutable search over one DataFrame; every method returns a new one.

    ``hits()`` is the page, ``matches()`` everything that matches, ``count()`` the exact
    total. Nothing runs before an action.
    """

    docs: DataFrame
    schema: DocSchema
    node: Node = field(default_factory=MatchAll)
    filters: tuple[Node, ...] = ()
    post: tuple[Node, ...] = ()
    orders: tuple[Order, ...] = ()
    offset: int = 0
    size: int | None = DEFAULT_PAGE
    after: tuple[Any, ...] | None = None
    minimum: float | None = None
    scored: bool = False
    index: TextIndex | None = None
    collapse_on: str | None = None
    source: tuple[tuple[str, ...], tuple[str, ...]] | None = None
    scripts: tuple[tuple[str, Column], ...] = ()
    boosts: tuple[tuple[str, float], ...] = ()
    similarity: str = "bm25"
    explained: bool = False

    def query(self, node: Node | Criteria) -> Search:
        return replace(self, node=node.build() if isinstance(node, Criteria) else node)

    def filter(self, node: Node) -> Search:
        return replace(self, filters=(*self.filters, node))

    def post_filter(self, node: Node) -> Search:
        return replace(self, post=(*self.post, node))

    def sort(self, *orders: Order | str) -> Search:
        return replace(self, orders=tuple(Order(o) if isinstance(o, str) else o for o in orders))

    def page(self, number: int, size: int = DEFAULT_PAGE) -> Search:
        return replace(self, offset=number * size, size=size)

    def limit(self, size: int) -> Search:
        return replace(self, size=size if self.size is None else min(self.size, size)
                       if self.offset else size)

    def unpaged(self, window: int | None = None) -> Search:
        """All hits, or those up to a result window."""
        return replace(self, offset=0, size=window)

    def search_after(self, *values: Any) -> Search:
        if self.collapse_on and len(values) != 1:
            raise ValueError("with collapse exactly one value is allowed")
        return replace(self, after=values)

    def min_score(self, value: float) -> Search:
        return replace(self, minimum=value if value > 0 else None)

    def with_scores(self, similarity: str = "bm25", explain: bool = False, index: TextIndex | None = None) -> Search:
        return replace(self, scored=True, similarity=similarity, explained=explain, index=index)

    def using(self, index: TextIndex) -> Search:
        """Conditions on the indexed text are answered by the index, also without scores."""
        return replace(self, index=index)

    def collapse(self, key: str) -> Search:
        return replace(self, collapse_on=key)

    def fields(self, *includes: str, excludes: Sequence[str] = ()) -> Search:
        return replace(self, source=(includes, tuple(excludes)))

    def runtime_field(self, name: str, expression: Column | str, data_type: str | None = None) -> Search:
        """A computed column that the predicate, the sort and the output can use."""
        e = F.expr(expression) if isinstance(expression, str) else expression
        docs = self.docs.withColumn(name, e.cast(data_type) if data_type else e)
        extra = DocSchema.of(T.StructType([docs.schema[name]]))
        return replace(self, docs=docs, schema=self.schema.with_fields(*extra.fields.values()))

    def script_field(self, name: str, expression: Column | str) -> Search:
        """A column computed for the hits only."""
        e = F.expr(expression) if isinstance(expression, str) else expression
        return replace(self, scripts=(*self.scripts, (name, e)))

    def indices_boost(self, **factors: float) -> Search:
        return replace(self, boosts=tuple(factors.items()))

    # --- results -------------------------------------------------------------------------

    def _context(self, df: DataFrame) -> Context:
        return Context(df.schema, self.schema)

    def matches(self) -> DataFrame:
        """Everything that matches, unsorted. Aggregations start here."""
        node = self.node
        if self.filters:
            node = (replace(node, filter=(*node.filter, *self.filters))
                    if isinstance(node, Bool) and (node.must or not node.should)
                    else Bool(must=(node,), filter=self.filters))
        needs_score = (self.scored or self.minimum is not None
                       or any(o.field == "_score" for o in self.orders) and "_score" not in self.docs.columns)
        if not needs_score and self.index is not None:
            return scoring.matching(self.docs, self.schema, node, self.index)
        if not needs_score:
            return self.docs.where(node.match(self._context(self.docs)))
        out = scoring.with_score(self.docs, self.schema, node, similarity=self.similarity,
                                 explain=self.explained, index=self.index)
        if self.boosts:
            out = scoring.index_boost(out, dict(self.boosts))
        if self.minimum is not None:
            out = scoring.settled(out, "_score").where(F.col("_score") >= self.minimum)
        return out

    def _filtered(self) -> DataFrame:
        out = self.matches()
        for node in self.post:
            out = out.where(node.match(self._context(out)))
        return out

    def _orders(self, df: DataFrame) -> tuple[Order, ...]:
        orders = self.orders or ((Order("_score", descending=True),) if "_score" in df.columns else ())
        if not orders and self.size is None and not self.offset and not self.collapse_on:
            # everything, in no asked order: nothing to sort for
            return ()
        tie = self.schema.id
        if tie and all(o.field != tie for o in orders) and self.after is None:
            orders = (*orders, Order(tie))
        return orders

    def hits(self) -> DataFrame:
        out = self._filtered()
        ctx = self._context(out)
        orders = self._orders(out)
        if self.collapse_on:
            out = best_per_key(out, self.collapse_on, sort_columns(orders, ctx))
        if self.after is not None:
            out = out.where(after_predicate(orders[:len(self.after)], self.after, ctx))
        if orders:
            out = out.orderBy(*sort_columns(orders, ctx))
        if self.offset:
            out = out.offset(self.offset)
        if self.size is not None:
            out = out.limit(self.size)
        if self.scripts:
            out = out.withColumns(dict(self.scripts))
        if self.source is not None:
            always = [c for c in ("_score", *[n for n, _ in self.scripts]) if c in out.columns]
            includes, excludes = self.source
            out = source_filter(out, (*includes, *always) if includes else (), excludes)
        return out

    def best(self) -> DataFrame:
        """The page of ``hits()`` by score.

        With an index and a query for any of some terms only the blocks of postings are read
        that can hold a hit of the page, and jobs run when this is called. Any other search
        is that of ``hits()``.
        """
        plain = (self.index is not None and self.size is not None and self.scored and self.similarity in ("bm25", "default")
                 and not (self.filters or self.post or self.boosts or self.after or self.collapse_on or self.explained)
                 and self.minimum is None and self.schema.id == self.index.id
                 and (not self.orders or self.orders == (Order("_score", descending=True),)))
        terms = scoring.any_terms(self.node, self.schema, self.index.field) if plain else None
        if terms is None:
            return self.hits()
        top = scoring.best_hits(self.index, terms, self.offset + self.size)
        found = replace(self, docs=self.docs.join(F.broadcast(top), self.schema.id), node=MatchAll(), index=None, scored=False)
        return found.sort(Order("_score", descending=True)).hits()  # a page at most is broadcast

    def sort_values(self) -> DataFrame:
        """Hits with their sort keys, as ``_sort_0``, ``_sort_1``, ..."""
        out = self._filtered()
        ctx = self._context(out)
        orders = self._orders(out)
        keyed = out.withColumns({f"_sort_{i}": sort_key(o, ctx) for i, o in enumerate(orders)})
        keyed = keyed.orderBy(*sort_columns(orders, ctx)).offset(self.offset)
        return keyed.limit(self.size) if self.size is not None else keyed

    def count(self) -> DataFrame:
        """The exact total as one row; only the columns of the predicate are read."""
        return self._filtered().agg(F.count(F.lit(1)).alias("total"))

    def total(self, up_to: int | None = None) -> DataFrame:
        """``total`` and ``relation``: exact, or counted up to a bound."""
        if up_to is None:
            return self.count().withColumn("relation", F.lit("EQUAL_TO"))
        n = self._filtered().limit(up_to + 1).agg(F.count(F.lit(1)).alias("n"))
        return n.select(F.least("n", F.lit(up_to).cast("long")).alias("total"),
                        F.when(F.col("n") > up_to, "GREATER_THAN_OR_EQUAL_TO")
                        .otherwise("EQUAL_TO").alias("relation"))

    def exists(self) -> DataFrame:
        return (self._filtered().limit(1).agg((F.count(F.lit(1)) > 0).alias("exists")))

    def one(self) -> DataFrame:
        return self.limit(1).hits()

    def page_of(self) -> DataFrame:
        """The page with ``_total`` and ``_pages`` beside each hit."""
        n = self.count().scalar()
        size = max(self.size or 1, 1)
        return self.hits().withColumn("_total", n).withColumn(
            "_pages", F.ceil(F.col("_total") / size).cast("long"))

    def batches(self, size: int = 500, max_results: int | None = None) -> DataFrame:
        """All hits with the number of the batch they fall in when read in the order of the
        id, of any type: the distributed form of reading page after page."""
        key = self.schema.id
        hits = self._filtered()
        one = hits.select(key, F.lit(1).alias("_one"))
        ranked = running_total(one, key, "_one", name="_nr").select(key, "_nr")
        if max_results is not None:
            ranked = ranked.where(F.col("_nr") <= max_results)
        batch = F.floor((F.col("_nr") - 1) / size).cast("long")
        return hits.join(ranked.select(key, batch.alias("_batch")), key)

    def stream_results(self, max_results: int | None = None):
        """Iterate over everything, one partition at a time ahead of the reader."""
        out = self._filtered()
        orders = self._orders(out)
        if self.orders:
            out = out.orderBy(*sort_columns(orders, self._context(out)))
        if max_results is not None:
            out = out.limit(max_results)
        return out.toLocalIterator(prefetchPartitions=True)


def multi_search(searches: dict[str, Search]) -> DataFrame:
    """Hits of several searches in one result, tagged by ``_query``; columns may differ."""
    out = None
    for name, s in searches.items():
        part = s.hits().withColumn("_query", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
