"""Text analysis as Column expressions: a string column becomes an array of terms."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters terms are made of.
WORD = r"[\p{L}\p{N}]"
LETTER = r"\p{L}"
SEPARATORS = r"[^\p{L}\p{N}]+"
NON_LETTERS = r"[^\p{L}]+"


@dataclass(frozen=True)
class Analyzer:
    """``column`` splits stored text inside the JVM, ``literal`` splits a query value.

    Where terms are just the runs of a character class in the lower-cased text, ``word``
    names it. Then literal terms are found by scanning the text, which spares building
    an array of all its terms. ``joined`` spares it too: the same terms as ``column``,
    with one space between them, for analyzers whose terms have no space.
    """

    name: str
    column: Callable[[Column], Column]
    literal: Callable[[str], list[str]]
    word: str | None = None
    synonyms: Mapping[str, Sequence[str]] = field(default_factory=dict)
    joined: Callable[[Column], Column] | None = None

    def is_term(self, value: str) -> bool:
        """A value that the analyzer could have produced."""
        return self.literal(value) == [value]

    def members(self, term: str) -> list[str]:
        """What the text may say for a term: its synonyms, or just itself."""
        return list(self.synonyms.get(term, (term,)))

    def mentioned(self, text: Column, term: str) -> Column:
        """A cheap test without word boundaries that every occurrence passes."""
        out = None
        for m in self.members(term):
            hit = F.contains(F.lower(text), F.lit(m))
            out = hit if out is None else out | hit
        return out

    def pattern(self, term: str) -> str:
        """A whole term. The literal comes first, so that most positions fail at once."""
        parts = [re.escape(m) for m in self.members(term)]
        return "|".join(rf"{t}(?!{self.word})(?<!{self.word}{t})" for t in parts)

    def phrase_pattern(self, terms: Sequence[str]) -> str:
        """The first term where the others follow; only the first is consumed, so
        occurrences may overlap."""
        gap = f"(?:(?!{self.word})(?s:.))+"
        each = ["(?:" + "|".join(re.escape(m) for m in self.members(t)) + ")" for t in terms]
        rest = "".join(gap + t for t in each[1:])
        if not rest:
            return self.pattern(terms[0])
        return rf"(?<!{self.word}){each[0]}(?={rest}(?!{self.word}))"

    def wildcard_pattern(self, pattern: str) -> str | None:
        """``*`` and ``?`` within one term; None if no term can look like it."""
        literal = pattern.replace("*", "").replace("?", "")
        if literal and not self.is_term(literal):
            return None
        body = "".join(f"{self.word}*" if c == "*" else self.word if c == "?" else re.escape(c) for c in pattern)
        return rf"(?<!{self.word}){body}(?!{self.word})(?<={self.word})"

    def length(self, text: Column) -> Column:
        """Number of terms."""
        if self.word is None:
            return F.size(self.column(text))
        return F.regexp_count(F.lower(text), F.lit(f"{self.word}+"))

    def frequency(self, text: Column, term: str) -> Column:
        """Occurrences of a literal term."""
        if self.word is None:
            toks = self.column(text)
            return F.size(toks) - F.size(F.array_remove(toks, term))
        if not self.is_term(term):
            return F.when(text.isNotNull(), F.lit(0))
        found = F.regexp_count(F.lower(text), F.lit(self.pattern(term)))
        return F.when(self.mentioned(text, term), found).when(text.isNotNull(), F.lit(0))

    def phrase_frequency(self, text: Column, terms: Sequence[str]) -> Column:
        if self.word is None:
            return phrase_frequency(self.column(text), terms)
        mentioned = self.mentioned(text, terms[0])
        for t in terms[1:]:
            mentioned = mentioned & self.mentioned(text, t)
        found = F.regexp_count(F.lower(text), F.lit(self.phrase_pattern(terms)))
        return F.when(mentioned, found).when(text.isNotNull(), F.lit(0))


def _split(text: Column, separators: str) -> Column:
    # only the ends can be empty: the separator pattern is greedy
    return F.array_remove(F.split(F.lower(text), separators), "")


def _joined(text: Column, separators: str) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), F.lit(separators), F.lit(" ")))


def once(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


def term_counts(toks: Column) -> Column:
    """``array<struct<term, tf, doc_len>>`` of the distinct terms of one document, in order.

    Equal terms are neighbours in the sorted array; a run of them starts where the term differs
    from the one before.
    """
    def counted(t: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: (i == 0) | (
            t[i] != F.get(t, F.greatest(i - 1, F.lit(0)))))
        return once(starts, lambda s: F.transform(s, lambda i, n: F.struct(
            t[i].alias("term"), (F.coalesce(F.get(s, n + 1), F.size(t)) - i).cast("long").alias("tf"),
            F.size(t).alias("doc_len"))))

    kind = "array<struct<term: string, tf: bigint, doc_len: int>>"
    return once(F.sort_array(toks), lambda t: F.when(F.size(t) > 0, counted(t)).otherwise(F.array().cast(kind)))


STANDARD = Analyzer(
    "standard",
    lambda c: _split(c, SEPARATORS),
    lambda s: re.findall(r"[^\W_]+", s.lower()),
    word=WORD,
    joined=lambda c: _joined(c, SEPARATORS),
)
SIMPLE = Analyzer(
    "simple",
    lambda c: _split(c, NON_LETTERS),
    lambda s: re.findall(r"[^\W\d_]+", s.lower()),
    word=LETTER,
    joined=lambda c: _joined(c, NON_LETTERS),
)
WHITESPACE = Analyzer("whitespace", lambda c: F.array_remove(F.split(c, r"\s+"), ""), str.split)
KEYWORD = Analyzer("keyword", lambda c: F.array(c), lambda s: [s])

ANALYZERS = {a.name: a for a in (STANDARD, SIMPLE, WHITESPACE, KEYWORD)}


def synonym_analyzer(groups: Sequence[Sequence[str]], base: Analyzer = STANDARD) -> Analyzer:
    """Terms of one group match each other.

    A group goes by its first member: query values are folded onto it, and it is found in
    a text where any member stands. The groups are settings of the analyzer (a short
    literal map), never data.
    """
    head = {term: group[0] for group in groups for term in group}

    def column(text: Column) -> Column:
        folds = F.create_map(*[F.lit(x) for pair in head.items() for x in pair])
        return F.transform(base.column(text), lambda t: F.coalesce(folds[t], t))

    def literal(text: str) -> list[str]:
        return [head.get(t, t) for t in base.literal(text)]

    return Analyzer("synonym", column, literal, word=base.word,
                    synonyms={g[0]: tuple(g) for g in groups})


def tokens(text: Column | str, analyzer: Analyzer | str = STANDARD) -> Column:
    """Array of terms of a text column."""
    if isinstance(analyzer, str):
        analyzer = ANALYZERS[analyzer]
    return analyzer.column(F.col(text) if isinstance(text, str) else text)


def token_count(text: Column | str, analyzer: Analyzer | str = STANDARD) -> Column:
    if isinstance(analyzer, str):
        analyzer = ANALYZERS[analyzer]
    return analyzer.length(F.col(text) if isinstance(text, str) else text)


def term_array(terms: Sequence[str]) -> Column:
    return F.array(*[F.lit(t) for t in terms]) if terms else F.array().cast("array<string>")


def contains_all(toks: Column, terms: Sequence[str]) -> Column:
    return F.size(F.array_except(term_array(terms), toks)) == 0


def contains_any(toks: Column, terms: Sequence[str]) -> Column:
    return F.arrays_overlap(toks, term_array(terms))


def contains_phrase(toks: Column, terms: Sequence[str]) -> Column:
    joined = F.concat(F.lit(" "), F.array_join(toks, " "), F.lit(" "))
    return F.contains(joined, F.lit(f" {' '.join(terms)} "))


def phrase_frequency(toks: Column, terms: Sequence[str]) -> Column:
    """How often the terms follow each other; occurrences may overlap."""
    joined = F.concat(F.lit(" "), F.array_join(toks, " "), F.lit(" "))
    return F.regexp_count(joined, F.lit(f" (?={' '.join(re.escape(t) for t in terms)} )"))


def wildcard_regex(pattern: str) -> str:
    """``*`` and ``?`` as an anchored regular expression."""
    body = "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in pattern)
    return f"^(?s:{body})$"


def auto_fuzziness(term: str) -> int:
    """Edits allowed for a term: 0 up to length 2, 1 up to length 5, else 2."""
    return 0 if len(term) < 3 else 1 if len(term) < 6 else 2


def _swaps(term: str) -> set[str]:
    """The term with one pair of neighbours exchanged."""
    return {term[:i] + term[i + 1] + term[i] + term[i + 2:]
            for i in range(len(term) - 1) if term[i] != term[i + 1]}


def within_edits(candidate: Column, term: str, edits: int) -> Column:
    """``candidate`` is at most ``edits`` (0-2) edits away; a swapped pair is one edit.

    A swap always works on two neighbours of ``term``, so it can be made first: one swap
    plus ``edits - 1`` plain edits from each variant.
    """
    if edits == 0:
        return candidate == term
    plain = F.levenshtein(candidate, F.lit(term), edits) >= 0
    variants = sorted(_swaps(term) - {term})
    if not variants:
        return plain
    if edits == 1:
        return plain | candidate.isin(variants)
    near = F.exists(term_array(variants), lambda v: F.levenshtein(candidate, v, 1) >= 0)
    twice = sorted(set().union(*(_swaps(v) for v in variants)))
    length_ok = F.length(candidate).between(len(term) - 2, len(term) + 2)
    return length_ok & (plain | near | candidate.isin(twice))
