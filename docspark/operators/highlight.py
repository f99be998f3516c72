"""Highlighting: marked terms in the whole field or in its best fragments."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import analysis as A
from ..plans.criteria import Leaf, Node
from ..schema import DocSchema


@dataclass(frozen=True)
class HighlightField:
    """How one field is highlighted; ``fragment_size`` 0 marks the whole field."""

    name: str
    pre_tag: str = "<em>"
    post_tag: str = "</em>"
    fragment_size: int = 100
    number_of_fragments: int = 5
    no_match_size: int = 0
    order: str = "none"
    require_field_match: bool = True
    query: Node | None = None
    rename: str | None = None


WORD_CHAR, GAP = r"[\p{L}\p{N}]", r"[^\p{L}\p{N}]+"


def query_patterns(node: Node, schema: DocSchema, field: str, any_field: bool = False) -> list[str]:
    """Patterns of what a query marks in a field: terms with their synonyms, phrases as a whole,
    and the terms that a beginning, a piece or a wildcard stands for."""
    out: list[str] = []
    for leaf in node.leaves():
        if isinstance(leaf, Leaf) and (any_field or leaf.field == field):
            spec = schema.field(leaf.field)
            if spec.role == "text":
                out += [p for p in _leaf_patterns(leaf, schema, spec) if p not in out]
    return out


def _leaf_patterns(leaf: Leaf, schema: DocSchema, spec) -> list[str]:
    def either(term: str) -> str:
        words = [re.escape(w) for w in spec.analyzer.members(term)]
        return words[0] if len(words) == 1 else f"(?:{'|'.join(words)})"

    if leaf.op in ("phrase", "in"):
        return [GAP.join(map(either, p)) for p in leaf.phrases(schema) if p]
    value = str(leaf.value).lower()
    if leaf.op == "starts_with":
        return [re.escape(value) + WORD_CHAR + "*"]
    if leaf.op == "ends_with":
        return [WORD_CHAR + "*" + re.escape(value)]
    if leaf.op == "contains":
        return [WORD_CHAR + "*" + re.escape(value) + WORD_CHAR + "*"]
    if leaf.op == "wildcard":
        kinds = {"*": WORD_CHAR + "*", "?": WORD_CHAR}
        return ["".join(kinds.get(c) or re.escape(c) for c in value)]
    return [either(t) for t in leaf.terms(schema)]


def term_pattern(patterns: Sequence[str]) -> str:
    """Whole terms, any case."""
    # longest first, so that no alternative hides a longer one
    body = "|".join(sorted(patterns, key=lambda t: (-len(t), t)))
    return rf"(?iu)(?<![\p{{L}}\p{{N}}])({body})(?![\p{{L}}\p{{N}}])"


def mark(text: Column, terms: Sequence[str], pre: str, post: str) -> Column:
    def quoted(s: str) -> str:
        return s.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(text, term_pattern(terms), f"{quoted(pre)}$1{quoted(post)}")


def fragments(text: Column, size: int) -> Column:
    """The text cut at blanks into pieces of about ``size`` characters."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)(\S.{{0,{max(size - 1, 0)}}}\S*)"), F.lit(1))


def highlight_field(text: Column, terms: Sequence[str], spec: HighlightField) -> Column:
    """Array of marked fragments. Scored by the number of marked terms if so ordered."""
    if not terms:
        return F.array().cast("array<string>")
    pattern = term_pattern(terms)
    if spec.fragment_size == 0 or spec.number_of_fragments == 0:
        whole = mark(text, terms, spec.pre_tag, spec.post_tag)
        found = F.when(text.rlike(pattern), F.array(whole))
    else:
        hit = F.filter(fragments(text, spec.fragment_size), lambda f: f.rlike(pattern))
        if spec.order == "score":
            ranked = F.transform(hit, lambda f, i: F.struct(
                (-F.regexp_count(f, F.lit(pattern))).alias("s"), i.alias("i"), f.alias("f")))
            hit = F.transform(F.sort_array(ranked), lambda r: r["f"])
        hit = F.slice(hit, 1, spec.number_of_fragments)
        marked = F.transform(hit, lambda f: mark(f, terms, spec.pre_tag, spec.post_tag))
        found = F.when(F.size(marked) > 0, marked)
    if spec.no_match_size:
        found = F.coalesce(found, F.array(F.substring(text, 1, spec.no_match_size)))
    return F.coalesce(found, F.array().cast("array<string>"))


def highlight(hits: DataFrame, schema: DocSchema, node: Node, specs: Sequence[HighlightField],
              column: str = "highlight") -> DataFrame:
    """Adds ``highlight``: a map from (renamed) field to its fragments. Works on the page of
    hits, after the search has cut it."""
    entries = []
    for s in specs:
        terms = query_patterns(s.query or node, schema, s.name, any_field=not s.require_field_match)
        spec = schema.field(s.name)
        entries += [F.lit(s.rename or s.name),
                    highlight_field(F.col(spec.stored), terms, s)]
    return hits.withColumn(column, F.map_filter(F.create_map(*entries), lambda k, v: F.size(v) > 0))


def rename_keys(hits: DataFrame, names: Mapping[str, str], column: str = "highlight") -> DataFrame:
    """Stored names in the highlight map back to property names."""
    pairs = F.create_map(*[F.lit(x) for p in names.items() for x in p])
    return hits.withColumn(column, F.transform_keys(column, lambda k, v: F.coalesce(pairs[k], k)))
