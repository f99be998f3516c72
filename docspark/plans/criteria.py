"""Composable criteria that compile to Columns.

A node gives two things: ``match`` (a boolean Column that holds where the row matches) and
``score`` (a double Column, meaningful where ``match`` holds). Both are ordinary
expressions on the row, so a whole boolean query is one filter plus one projection over
one scan.

Logic is two-valued: what is unknown does not match. Asserted conditions stay as they are,
because a filter drops unknown rows anyway and a bare comparison is what Catalyst can push to
the scan. Only under a negation is an unknown condition turned into false.

Two ways to compose:

* ``is_("status", "O") & gt("price", 10) | ~exists("note")``: real boolean algebra,
* ``Criteria.where("a").is_(1).and_("b").gt(2).or_("c").is_(3)``: a fluent chain that is
  sorted into must / should / must_not groups (see :meth:`Criteria.build`).
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field as dc_field, replace
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import analysis as A
from ..functions import geo
from ..schema import DocSchema, FieldSpec, stored_value


class Context:
    """Resolves property names on one DataFrame. ``scoring`` is set by the scorer."""

    def __init__(self, struct: T.StructType, schema: DocSchema, scoring=None):
        self.struct, self.schema, self.scoring = struct, schema, scoring

    def type_of(self, path: str) -> T.DataType | None:
        current: T.DataType = self.struct
        for part in path.split("."):
            if isinstance(current, T.ArrayType):
                current = current.elementType
            if isinstance(current, T.MapType):
                current = current.valueType
                continue
            if not isinstance(current, T.StructType) or part not in current.fieldNames():
                return None
            current = current[part].dataType
        return current

    def column(self, name: str) -> Column:
        return F.col(self.schema.field(name).stored)


def _false_if_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(False))


def literal(value: Any, data_type: T.DataType | None) -> Column:
    """A query value in the column's own type, so that the column itself is never cast."""
    if isinstance(value, Column):
        return value
    if isinstance(data_type, T.ArrayType):
        data_type = data_type.elementType
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        if isinstance(value, (dt.datetime, dt.date)):
            value = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
        return F.lit(value).cast(data_type)
    return F.lit(value)


class Node:
    boost_: float = 1.0

    def match(self, ctx: Context) -> Column:
        raise NotImplementedError

    def score(self, ctx: Context) -> Column:
        return F.when(self.match(ctx), F.lit(float(self.boost_))).otherwise(F.lit(0.0))

    def leaves(self) -> Iterable[Leaf]:
        return ()

    def boost(self, factor: float) -> Node:
        if factor < 0:
            raise ValueError("boost must not be negative")
        return replace(self, boost_=float(factor))

    def __and__(self, other: Node) -> Bool:
        return Bool(must=(self, other))

    def __or__(self, other: Node) -> Bool:
        return Bool(should=(self, other))

    def __invert__(self) -> Bool:
        return Bool(must_not=(self,))


@dataclass(frozen=True)
class MatchAll(Node):
    boost_: float = 1.0

    def match(self, ctx: Context) -> Column:
        return F.lit(True)


@dataclass(frozen=True)
class Raw(Node):
    """Any boolean Column, or SQL expression, as a clause (score = boost)."""

    expression: Any = None
    boost_: float = 1.0

    def match(self, ctx: Context) -> Column:
        return F.expr(self.expression) if isinstance(self.expression, str) else self.expression


@dataclass(frozen=True)
class ConstantScore(Node):
    """The inner clause as a filter: it scores ``boost`` whatever its terms weigh."""

    inner: Node = None
    boost_: float = 1.0

    def match(self, ctx: Context) -> Column:
        return self.inner.match(ctx)


@dataclass(frozen=True)
class Bool(Node):
    """All of ``must`` and ``filter``, none of ``must_not``; one of ``should`` is required
    only where there is neither ``must`` nor ``filter`` (or ``min_should`` says so)."""

    must: tuple[Node, ...] = ()
    should: tuple[Node, ...] = ()
    must_not: tuple[Node, ...] = ()
    filter: tuple[Node, ...] = ()
    min_should: int | None = None
    boost_: float = 1.0

    def match(self, ctx: Context) -> Column:
        parts = [n.match(ctx) for n in (*self.filter, *self.must)]
        parts += [~_false_if_null(n.match(ctx)) for n in self.must_not]
        need = self.min_should
        if need is None:
            need = 1 if self.should and not self.must and not self.filter else 0
        if need == 1:
            parts.append(_any(n.match(ctx) for n in self.should))
        elif need > 1:
            hits = [_false_if_null(n.match(ctx)).cast("int") for n in self.should]
            parts.append(sum(hits, F.lit(0)) >= need)
        return _all(parts)

    def score(self, ctx: Context) -> Column:
        total = sum((_gated_score(n, ctx) for n in (*self.must, *self.should)), F.lit(0.0))
        return total * F.lit(float(self.boost_)) if self.boost_ != 1.0 else total

    def leaves(self):
        for n in (*self.must, *self.should):
            yield from n.leaves()


def _gated_score(node: Node, ctx: Context) -> Column:
    """A group inside a group counts only where it matches as a whole."""
    if isinstance(node, Bool):
        return F.when(node.match(ctx), node.score(ctx)).otherwise(F.lit(0.0))
    return node.score(ctx)


def _all(columns: Iterable[Column]) -> Column:
    out = None
    for c in columns:
        out = c if out is None else out & c
    return F.lit(True) if out is None else out


def _any(columns: Iterable[Column]) -> Column:
    out = None
    for c in columns:
        out = c if out is None else out | c
    return F.lit(False) if out is None else out


@dataclass(frozen=True)
class Leaf(Node):
    """One condition on one field. Arrays match if any element does."""

    field: str = ""
    op: str = ""
    value: Any = None
    boost_: float = 1.0

    def match(self, ctx: Context) -> Column:
        if ctx.scoring is not None and ctx.scoring.answers(self):
            return ctx.scoring.match(self)
        spec = ctx.schema.field(self.field)
        nested = ctx.schema.nested_path(self.field)
        if nested is not None:
            return self._inside(F.col(ctx.schema.field(nested).stored), ctx.type_of(nested),
                                self.field[len(nested) + 1:].split("."), spec)
        dtype = ctx.type_of(spec.stored)
        return self.on(ctx.column(self.field), spec, dtype)

    def _inside(self, column: Column, dtype: T.DataType, path: Sequence[str], spec: FieldSpec) -> Column:
        """The condition below an array of objects, which may hold arrays of objects in turn."""
        if not path:
            return self.on(column, spec, dtype)
        if isinstance(dtype, T.ArrayType):
            return F.exists(column, lambda x: self._inside(x, dtype.elementType, path, spec))
        inner = dtype[path[0]].dataType if isinstance(dtype, T.StructType) else None
        return self._inside(column.getField(path[0]), inner, path[1:], spec)

    def on(self, column: Column, spec: FieldSpec, dtype: T.DataType | None) -> Column:
        """The condition on a given column, which may be an element of a nested array."""
        column = stored_value(spec, column)
        value = spec.value(self.value)
        is_array = isinstance(dtype, T.ArrayType) and spec.role not in ("vector", "nested")
        if self.op in _WHOLE:
            if spec.role == "text" and self.op in ("empty", "not_empty"):
                return _termless(column, spec, is_array, self.op == "empty")
            return _WHOLE[self.op](column, is_array)
        fn = _TEXT.get(self.op) if spec.role == "text" else None
        fn = fn or _EXACT.get(self.op)
        if fn is None:
            raise ValueError(f"operator {self.op!r} does not apply to a {spec.role} field")
        if is_array:
            return F.exists(column, lambda e: fn(e, value, spec, dtype))
        return fn(column, value, spec, dtype)

    def terms(self, schema: DocSchema) -> list[str]:
        """Terms that weigh in the score; empty where the clause scores a constant."""
        spec = schema.field(self.field)
        if spec.role != "text" or self.op not in _SCORED or schema.nested_path(self.field):
            return []
        if self.op == "term":
            return [self.value]
        if self.op == "in":
            return [t for v in self.value if v is not None for t in spec.analyzer.literal(str(v))]
        return spec.analyzer.literal(str(spec.value(self.value)))

    def phrases(self, schema: DocSchema) -> list[tuple[str, ...]]:
        spec = schema.field(self.field)
        values = self.value if self.op == "in" else [self.value]
        return [tuple(spec.analyzer.literal(str(v))) for v in values if v is not None]

    def score(self, ctx: Context) -> Column:
        terms = self.terms(ctx.schema)
        if not terms or ctx.scoring is None:
            return super().score(ctx)
        if self.op in ("phrase", "in"):
            weight = sum((ctx.scoring.phrase(self.field, p) for p in self.phrases(ctx.schema)), F.lit(0.0))
        else:
            weight = sum((ctx.scoring.term(self.field, t) for t in terms), F.lit(0.0))
        if self.op == "is" and len(terms) > 1 or self.op == "matches_all":
            weight = F.when(self.match(ctx), weight).otherwise(F.lit(0.0))
        return weight * F.lit(float(self.boost_)) if self.boost_ != 1.0 else weight

    def leaves(self):
        yield self


def _path(element: Column, path: str) -> Column:
    for part in path.split("."):
        element = element.getField(part)
    return element


# --- operators on an exact (keyword, number, date, boolean) value -------------------------


def _no_blanks(value: str) -> str:
    if re.search(r"\s", str(value)):
        raise ValueError(f"a prefix, suffix or substring must not contain blanks: {value!r}")
    return str(value)


def _between(c, v, spec, dtype):
    low, high = v
    if low is None and high is None:
        raise ValueError("a range needs at least one bound")
    parts = []
    if low is not None:
        parts.append(c >= literal(low, dtype))
    if high is not None:
        parts.append(c <= literal(high, dtype))
    return _all(parts)


def _isin(c, v, spec, dtype):
    values = [literal(x, dtype) for x in v if x is not None]
    return c.isin(values) if values else F.lit(False)


def _fuzzy_edits(value):
    term, edits = value if isinstance(value, tuple) else (value, None)
    return str(term).lower(), A.auto_fuzziness(str(term)) if edits is None else edits


def _expression_on(test):
    def build(c, v, spec, dtype):
        all_of, any_of, none_of = v
        parts = [test(c, x, spec) for x in all_of]
        if any_of:
            parts.append(_any(test(c, x, spec) for x in any_of))
        return _all(parts + [~_false_if_null(test(c, x, spec)) for x in none_of])
    return build


_EXACT = {
    "is": lambda c, v, s, t: c == literal(v, t),
    "term": lambda c, v, s, t: c == literal(v, t),
    "contains": lambda c, v, s, t: F.contains(c, F.lit(_no_blanks(v))),
    "starts_with": lambda c, v, s, t: F.startswith(c, F.lit(_no_blanks(v))),
    "ends_with": lambda c, v, s, t: F.endswith(c, F.lit(_no_blanks(v))),
    "wildcard": lambda c, v, s, t: c.rlike(A.wildcard_regex(v)),
    "regexp": lambda c, v, s, t: c.rlike(f"^(?:{v})$"),
    "lt": lambda c, v, s, t: c < literal(v, t),
    "lte": lambda c, v, s, t: c <= literal(v, t),
    "gt": lambda c, v, s, t: c > literal(v, t),
    "gte": lambda c, v, s, t: c >= literal(v, t),
    "between": _between,
    "in": _isin,
    "matches": lambda c, v, s, t: c == literal(v, t),
    "matches_all": lambda c, v, s, t: c == literal(v, t),
    "phrase": lambda c, v, s, t: c == literal(v, t),
    "fuzzy": lambda c, v, s, t: A.within_edits(c, *_fuzzy_edits(v)),
    "expression": _expression_on(lambda c, x, s: c == x),
    "geo_within": lambda c, v, s, t: geo.within_distance(c, *v),
    "geo_box": lambda c, v, s, t: geo.in_box(c, *v),
    "geo_shape": lambda c, v, s, t: geo.shape_relation(c, *v),
}

# --- operators on an analyzed text value ---------------------------------------------------


def _mentions(c: Column, terms: Sequence[str], an: A.Analyzer, combine) -> Column:
    """A cheap substring test in front of the pattern: it decides most rows."""
    return combine(an.mentioned(c, t) for t in terms)


def _text_all(c, terms, spec):
    terms, an = list(dict.fromkeys(terms)), spec.analyzer
    if not terms:
        return F.lit(False)
    if an.word is None:
        return A.contains_all(an.column(c), terms)
    if not all(map(an.is_term, terms)):
        return F.lit(False)
    return _mentions(c, terms, an, _all) & _all(F.lower(c).rlike(an.pattern(t)) for t in terms)


def _text_any(c, terms, spec):
    terms, an = list(dict.fromkeys(terms)), spec.analyzer
    if an.word is None:
        return A.contains_any(an.column(c), terms) if terms else F.lit(False)
    terms = [t for t in terms if an.is_term(t)]
    if not terms:
        return F.lit(False)
    return _mentions(c, terms, an, _any) & F.lower(c).rlike("|".join(an.pattern(t) for t in terms))


def _text_phrase(c, terms, spec):
    an = spec.analyzer
    if not terms:
        return F.lit(False)
    if an.word is None:
        return A.contains_phrase(an.column(c), terms)
    return _mentions(c, terms, an, _all) & F.lower(c).rlike(an.phrase_pattern(terms))


def _any_token(test):
    def build(c, v, spec, dtype):
        return F.exists(spec.analyzer.column(c), lambda t: test(t, F.lit(v) if test in _LITERAL_TESTS else v))
    return build


_LITERAL_TESTS = (F.contains, F.startswith, F.endswith)


def _piece(pattern, test):
    """A piece of a term: ``pattern`` says where it may lie in a run of term characters."""
    by_token = _any_token(test)

    def build(c, v, spec, dtype):
        an, v = spec.analyzer, _no_blanks(v).lower()
        if an.word is None:
            return by_token(c, v, spec, dtype)
        if not an.is_term(v):
            return F.lit(False)
        found = F.contains(F.lower(c), F.lit(v))
        regex = pattern(re.escape(v), an.word)
        return found & F.lower(c).rlike(regex) if regex else found
    return build


_TEXT = {
    "is": lambda c, v, s, t: _text_all(c, s.analyzer.literal(str(v)), s),
    "matches_all": lambda c, v, s, t: _text_all(c, s.analyzer.literal(str(v)), s),
    "matches": lambda c, v, s, t: _text_any(c, s.analyzer.literal(str(v)), s),
    "phrase": lambda c, v, s, t: _text_phrase(c, s.analyzer.literal(str(v)), s),
    "in": lambda c, v, s, t: _any(
        _text_phrase(c, s.analyzer.literal(str(x)), s) for x in v if x is not None),
    "term": lambda c, v, s, t: _text_all(c, [v], s),
    "contains": _piece(lambda v, w: None, F.contains),
    "starts_with": _piece(lambda v, w: f"{v}(?<!{w}{v})", F.startswith),
    "ends_with": _piece(lambda v, w: f"{v}(?!{w})", F.endswith),
    "wildcard": lambda c, v, s, t: _text_wildcard(c, v.lower(), s),
    "regexp": _any_token(lambda t, v: t.rlike(f"^(?:{v})$")),
    "fuzzy": _any_token(lambda t, v: A.within_edits(t, *_fuzzy_edits(v))),
    "expression": _expression_on(lambda c, x, s: _text_all(c, s.analyzer.literal(x), s)),
    "search_as_you_type": lambda c, v, s, t: _typed_so_far(c, v, s),
}


#: Conditions on a text that hold if they hold for one of its terms.
_ANY_TERM = {
    "contains": lambda v, an: (lambda t: F.contains(t, F.lit(v))) if an.word is None or an.is_term(v) else None,
    "starts_with": lambda v, an: (lambda t: F.startswith(t, F.lit(v))) if an.word is None or an.is_term(v) else None,
    "ends_with": lambda v, an: (lambda t: F.endswith(t, F.lit(v))) if an.word is None or an.is_term(v) else None,
    "wildcard": lambda v, an: lambda t: t.rlike(A.wildcard_regex(v.lower())),
    "regexp": lambda v, an: lambda t: t.rlike(f"^(?:{v})$"),
    "fuzzy": lambda v, an: lambda t: A.within_edits(t, *_fuzzy_edits(v)),
}


def term_test(leaf: Leaf, spec: FieldSpec):
    """The test of a single term that a condition on a text comes down to, None if it doesn't.

    With it the vocabulary is searched, each distinct term once, instead of the texts.
    """
    if spec.role != "text" or leaf.op not in _ANY_TERM:
        return None
    value = spec.value(leaf.value)
    if leaf.op in ("contains", "starts_with", "ends_with"):
        value = _no_blanks(value).lower()
    return _ANY_TERM[leaf.op](value, spec.analyzer) or (lambda t: F.lit(False))


def _text_wildcard(c, v, spec):
    an = spec.analyzer
    if an.word is None:
        return F.exists(an.column(c), lambda t: t.rlike(A.wildcard_regex(v)))
    pattern = an.wildcard_pattern(v)
    if pattern is None:
        return F.lit(False)
    longest = max(re.split(r"[*?]", v), key=len)
    found = F.lower(c).rlike(pattern)
    return F.contains(F.lower(c), F.lit(longest)) & found if longest else found


def _typed_so_far(c, v, spec):
    terms = spec.analyzer.literal(v)
    if not terms:
        return F.lit(False)
    last = _TEXT["starts_with"](c, terms[-1], spec, None)
    return _text_all(c, terms[:-1], spec) & last if terms[1:] else last


# --- operators on the presence of a value ---------------------------------------------------


def _exists(c: Column, is_array: bool) -> Column:
    return c.isNotNull() & (F.size(c) > 0) if is_array else c.isNotNull()


def _termless(c: Column, spec: FieldSpec, is_array: bool, empty: bool) -> Column:
    """A text is empty if it has no term, whatever characters it has."""
    an = spec.analyzer
    has = (lambda x: F.lower(x).rlike(an.word)) if an.word is not None else (lambda x: F.size(an.column(x)) > 0)
    some = F.exists(c, has) if is_array else has(c)
    return c.isNotNull() & ~_false_if_null(some) if empty else some


_WHOLE = {
    "exists": _exists,
    "is_null": lambda c, arr: ~_exists(c, arr),
    "empty": lambda c, arr: c.isNotNull() & (
        F.forall(c, lambda e: e == "") if arr else F.length(c) == 0),
    "not_empty": lambda c, arr: F.exists(c, lambda e: e != "") if arr else F.length(c) > 0,
}
_SCORED = {"is", "matches", "matches_all", "phrase", "in", "term"}


# --- constructors ----------------------------------------------------------------------------


def _leaf(op):
    def make(field: str, value: Any = None) -> Leaf:
        return Leaf(field, op, value)
    make.__name__ = op
    return make


is_, term, contains = _leaf("is"), _leaf("term"), _leaf("contains")
starts_with, ends_with = _leaf("starts_with"), _leaf("ends_with")
like = starts_with
wildcard, regexp = _leaf("wildcard"), _leaf("regexp")
lt, lte, gt, gte = _leaf("lt"), _leaf("lte"), _leaf("gt"), _leaf("gte")
before, after = lte, gte
matches, matches_all, phrase = _leaf("matches"), _leaf("matches_all"), _leaf("phrase")
exists, is_null, empty, not_empty = _leaf("exists"), _leaf("is_null"), _leaf("empty"), _leaf("not_empty")
search_as_you_type = _leaf("search_as_you_type")


def between(field: str, low: Any, high: Any) -> Leaf:
    return Leaf(field, "between", (low, high))


def in_(field: str, values: Iterable[Any]) -> Leaf:
    return Leaf(field, "in", list(values))


def not_in(field: str, values: Iterable[Any]) -> Bool:
    return Bool(must_not=(in_(field, values),))


def fuzzy(field: str, value: str, edits: int | None = None) -> Leaf:
    return Leaf(field, "fuzzy", (value, edits))


def expression(field: str, all_of: Sequence[str] = (), any_of: Sequence[str] = (),
               none_of: Sequence[str] = ()) -> Leaf:
    return Leaf(field, "expression", (tuple(all_of), tuple(any_of), tuple(none_of)))


def within(field: str, point: geo.Point | str, distance: geo.Distance | str) -> Leaf:
    return Leaf(field, "geo_within", (geo.point(point), geo.metres(distance)))


def point_equals(field: str, point: geo.Point | str) -> Leaf:
    return Leaf(field, "geo_within", (geo.point(point), 1.0))


def bounded_by(field: str, top_left: geo.Point | str, bottom_right: geo.Point | str) -> Leaf:
    return Leaf(field, "geo_box", (geo.point(top_left), geo.point(bottom_right)))


def shape(field: str, relation: str, shape: Any) -> Leaf:
    return Leaf(field, "geo_shape", (relation, shape))


def ids(field: str, values: Iterable[Any]) -> Leaf:
    return in_(field, values)


# --- the fluent chain --------------------------------------------------------------------------

_GEO_OPS = {"geo_within", "geo_box", "geo_shape"}


@dataclass
class _Link:
    field: str | None
    or_: bool = False
    negated: bool = False
    boost: float | None = None
    leaves: list[Leaf] = dc_field(default_factory=list)
    groups: list[Criteria] = dc_field(default_factory=list)


_REQUIRED, _ALTERNATIVE, _EXCLUDED = "required", "alternative", "excluded"


@dataclass
class _Clause:
    """One part of a chain and the role it plays in the whole."""

    node: Node
    role: str
    negated: bool = False
    filter: bool = False
    group: bool = False


class Criteria:
    """``Criteria.where(..).is_(..).and_(..).gt(..).or_(..).contains(..)``.

    Conditions set in a row on one field all have to hold. ``not_()`` negates the current
    field, ``sub()`` adds a bracketed group.
    """

    def __init__(self, field: str | None = None):
        self.links = [_Link(field)] if field is not None else []

    @staticmethod
    def where(field: str) -> Criteria:
        return Criteria(field)

    def and_(self, field: str) -> Criteria:
        self.links.append(_Link(field))
        return self

    def or_(self, field: str) -> Criteria:
        self.links.append(_Link(field, or_=True))
        return self

    def not_(self) -> Criteria:
        self.links[-1].negated = True
        return self

    def boost(self, factor: float) -> Criteria:
        if factor < 0:
            raise ValueError("boost must not be negative")
        self.links[-1].boost = float(factor)
        return self

    def sub(self, group: Criteria) -> Criteria:
        if not self.links:
            self.links.append(_Link(None))
        self.links[-1].groups.append(group)
        return self

    def _add(self, make, *args) -> Criteria:
        self.links[-1].leaves.append(make(self.links[-1].field, *args))
        return self

    def build(self, compat: bool = False) -> Node:
        """The chain as a :class:`Bool`: every clause goes where its role says.

        ``and_`` makes a required clause, ``or_`` an alternative, ``not_`` after ``and_`` an
        excluded one. The head of the chain has no word before it, so the others decide: it is one
        more alternative if there are alternatives and nothing else. So ``a AND b OR c``
        requires a and b, and c only adds to the score. Geo conditions become filters. With
        ``compat`` a negated head among alternatives loses its negation, as the chain rule
        strictly says; by default it stays negated.
        """
        clauses = [clause for link in self.links for clause in self._clauses(link, compat)]
        head = next((c for c in clauses if not c.group and not c.filter), None)
        others = {c.role for c in clauses if c is not head and not c.filter}
        if head is not None:
            head.role = _ALTERNATIVE if others == {_ALTERNATIVE} else _EXCLUDED if head.negated else _REQUIRED
            if head.role == _ALTERNATIVE and compat:
                head.negated = False

        def having(role: str) -> tuple[Node, ...]:
            return tuple(~c.node if c.negated and role == _ALTERNATIVE and not c.group else c.node
                         for c in clauses if c.role == role and not c.filter)

        filters = tuple(~c.node if c.negated else c.node for c in clauses if c.filter)
        required = having(_REQUIRED) if head is not None or others else (MatchAll(),)
        return Bool(required, having(_ALTERNATIVE), having(_EXCLUDED), filters)

    def _clauses(self, link: _Link, compat: bool) -> list[_Clause]:
        role = _ALTERNATIVE if link.or_ else _EXCLUDED if link.negated else _REQUIRED
        places = [_Clause(leaf, role, link.negated, filter=True) for leaf in link.leaves if leaf.op in _GEO_OPS]
        condition = self._fragment(link)
        own = [] if condition is None else [_Clause(condition, role, link.negated)]
        return places + own + [_Clause(g.build(compat), role, link.negated, group=True) for g in link.groups]

    @staticmethod
    def _fragment(link: _Link) -> Node | None:
        leaves = [x for x in link.leaves if x.op not in _GEO_OPS]
        if not leaves:
            return None
        node = leaves[0] if len(leaves) == 1 else Bool(must=tuple(leaves))
        return node.boost(link.boost) if link.boost is not None else node


def _chain_method(make):
    def method(self, *args, **kwargs):
        return self._add(lambda f, *a: make(f, *a, **kwargs), *args)
    return method


for _name, _make in {
    "is_": is_, "term": term, "contains": contains, "starts_with": starts_with,
    "ends_with": ends_with, "like": like, "wildcard": wildcard, "regexp": regexp, "lt": lt,
    "lte": lte, "gt": gt, "gte": gte, "before": before, "after": after, "matches": matches,
    "matches_all": matches_all, "phrase": phrase, "exists": exists, "empty": empty,
    "not_empty": not_empty, "between": between, "in_": in_, "fuzzy": fuzzy,
    "expression": expression, "within": within, "bounded_by": bounded_by, "shape": shape,
}.items():
    setattr(Criteria, _name, _chain_method(_make))


def compile_match(node: Node | Criteria, struct: T.StructType, schema: DocSchema) -> Column:
    if isinstance(node, Criteria):
        node = node.build()
    return node.match(Context(struct, schema))
