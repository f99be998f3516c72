"""Suggestions: similar terms, corrected phrases, completions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import analysis as A
from .collapse import top_per_key
from .scoring import vocabulary

# Fixed values of the term suggester: a term shorter than this, or with another first
# letter, is no suggestion.
MIN_WORD_LENGTH = 4
PREFIX_LENGTH = 1
MAX_EDITS = 2


def term_candidates(vocab: DataFrame, words: Sequence[str], *, max_edits: int = MAX_EDITS,
                    prefix_length: int = PREFIX_LENGTH,
                    min_word_length: int = MIN_WORD_LENGTH) -> DataFrame:
    """``(position, token, term, score, df)`` for every vocabulary term near a word.

    The words of a request are literals, so this is one pass over the vocabulary. Length and
    first letters are plain conditions on the term, which Catalyst pushes below the
    counting of the vocabulary: other terms are never shuffled.
    """
    near = [(F.length("term") >= min_word_length)
            & F.startswith("term", F.lit(w[:prefix_length]))
            & F.length("term").between(len(w) - max_edits, len(w) + max_edits)
            & (F.col("term") != w) for w in words]
    some = near[0]
    for cond in near[1:]:
        some = some | cond
    entries = []
    for i, (word, cond) in enumerate(zip(words, near)):
        dist = F.levenshtein("term", F.lit(word), max_edits)
        entries.append(F.when(cond & (dist >= 0), F.struct(
            F.lit(i).alias("position"), F.lit(word).alias("token"), dist.alias("d"))))
    found = vocab.where(some).select(
        "term", "df", F.explode_outer(F.array_compact(F.array(*entries))).alias("c"))
    score = 1.0 - F.col("c.d") / F.least(F.length("term"), F.length("c.token"))
    return found.where("c IS NOT NULL").select("c.position", "c.token", "term", score.alias("score"), "df")


def suggest_term(docs: DataFrame, id: str, text: str, request: str, *, size: int = 5, mode: str = "missing",
                 sort: str = "score", vocab: DataFrame | None = None,
                 analyzer: A.Analyzer = A.STANDARD, **limits) -> DataFrame:
    """Per word of the request the best similar terms: ``(position, token, term, score, df, rank)``.

    ``mode`` ``missing`` suggests only for unknown words, ``popular`` only terms in more
    documents than the word itself, ``always`` any.
    """
    if mode not in ("missing", "popular", "always"):
        raise ValueError(f"unknown suggest mode {mode!r}")
    vocab = vocab if vocab is not None else vocabulary(docs, id, text, analyzer)
    words = analyzer.literal(request)
    if not words:
        raise ValueError("nothing to suggest for: the request has no terms")
    found = term_candidates(vocab, words, **limits)
    if mode != "always":
        # how many documents have the words themselves: one row for the whole request
        own = vocab.where(F.col("term").isin(words)).agg(F.array(*[F.max(F.when(F.col("term") == w, F.col("df"))) for w in words]).alias("o"))
        mine = F.get(own.scalar(), F.col("position"))
        found = found.where(mine.isNull() if mode == "missing" else F.coalesce(mine, F.lit(0)) < F.col("df"))
    order = ((F.desc("score"), F.desc("df"), F.asc("term")) if sort == "score"
             else (F.desc("df"), F.desc("score"), F.asc("term")))
    return top_per_key(found, "position", order, size, rank="rank")


def bigrams(docs: DataFrame, text: str, analyzer: A.Analyzer = A.STANDARD,
            among: Sequence[str] | None = None) -> DataFrame:
    """``(w1, w2, n)``: how often two terms follow each other; with ``among`` only pairs of
    the given terms."""
    toks = docs.select(analyzer.column(F.col(text)).alias("t"))
    each = toks.select("t", F.posexplode_outer("t").alias("i", "w1"))
    if among is not None:
        each = each.where(F.col("w1").isin(list(among)))
    rows = each.select("w1", F.get("t", F.col("i") + 1).alias("w2"))
    rows = rows.where(F.col("w2").isNotNull() if among is None else F.col("w2").isin(list(among)))
    return rows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"))


def suggest_phrase(docs: DataFrame, id: str, text: str, request: str, *, candidates: int = 3,
                   size: int = 1, smoothing: float = 0.5, error_likelihood: float = 0.95,
                   vocab: DataFrame | None = None, analyzer: A.Analyzer = A.STANDARD) -> DataFrame:
    """Corrected whole phrases ``(phrase, score)`` by a smoothed bigram model.

    Every word competes with its nearest terms, at most ``candidates`` with itself. Spark
    counts the vocabulary and, in a second pass, only the neighbours that both are
    candidates. What comes back is bounded by the request (``candidates`` rows per word, and
    their pairs), so the best paths through it are put together on the driver.
    """
    words = analyzer.literal(request)
    spark = docs.sparkSession
    result = "phrase string, score double"
    if not words:
        return spark.createDataFrame([], result)
    vocab = (vocab if vocab is not None else vocabulary(docs, id, text, analyzer)).persist()
    near = term_candidates(vocab, words).select("position", "term", "df", "score")
    places = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(w).alias("w")) for i, w in enumerate(words)])
    own = (vocab.where(F.col("term").isin(words)).withColumn("c", F.explode(places))
           .where("c.w = term").select("c.position", "term", "df", F.lit(1.0).alias("score")))
    options = top_per_key(near.unionByName(own), "position",
                          (F.desc("score"), F.desc("df"), F.asc("term")), candidates)
    found: list[dict[str, tuple[int, float]]] = [{} for _ in words]
    for r in options.collect():
        found[r["position"]][r["term"]] = (r["df"], r["score"])
    sums = vocab.agg(F.count(F.lit(1)).alias("v"), F.sum("freq").alias("f")).first()
    vocab.unpersist()
    # a known word is right with that likelihood, an unknown one (it stays a candidate) wrong
    right, wrong = math.log(error_likelihood), math.log(1.0 - error_likelihood)
    by_place = []
    for word, place in zip(words, found):
        known = word in place
        itself = {word: (place[word][0] if known else 0, right if known else wrong)}
        by_place.append({**{t: (df, math.log(s) + (wrong if known else right))
                            for t, (df, s) in place.items()}, **itself})
    terms = sorted({t for place in by_place for t in place})
    pairs = bigrams(docs, text, analyzer, among=terms).collect() if len(words) > 1 else []
    return spark.createDataFrame(_best_paths(
        by_place, {(r["w1"], r["w2"]): r["n"] for r in pairs}, sums["v"], sums["f"] or 0,
        smoothing, size), result)


def _best_paths(places, pairs, distinct, total, smoothing, size) -> list[tuple[str, float]]:
    """The ``size`` best ways through the candidates, keeping ``size`` per last word."""
    beam = [(w + math.log((df + smoothing) / (total + smoothing * distinct)), (t,), df)
            for t, (df, w) in places[0].items()]
    for place in places[1:]:
        nxt = []
        for t, (df, w) in place.items():
            ways = [(s + w + math.log((pairs.get((path[-1], t), 0) + smoothing)
                                      / (last + smoothing * distinct)), (*path, t), df)
                    for s, path, last in beam]
            nxt += sorted(ways, key=lambda x: (-x[0], x[1]))[:size]
        beam = nxt
    return [(" ".join(p), s) for s, p, _ in sorted(beam, key=lambda x: (-x[0], x[1]))[:size]]


# --- completion ----------------------------------------------------------------------------------


def normalize_input(text: Column) -> Column:
    """Completion inputs and prefixes compare letter by letter, without case or digits."""
    return F.trim(F.regexp_replace(F.lower(text), A.NON_LETTERS, " "))


def completion_rows(docs: DataFrame, id: str, inputs: Column, weight: Column | None = None,
                    contexts: Sequence[str] = ()) -> DataFrame:
    """One row per input of a document: ``(id, input, key, weight, contexts..)``."""
    rows = docs.select(id, *contexts, F.explode(inputs).alias("input"),
                       (F.lit(1) if weight is None else weight).alias("weight"))
    return rows.withColumn("key", normalize_input(F.col("input")))


def suggest_completion(rows: DataFrame, prefix: str, id: str, *, size: int = 5,
                       fuzzy_edits: int = 0, skip_duplicates: bool = False,
                       context: Column | None = None) -> DataFrame:
    """Inputs that start with the prefix, the heaviest first, with their document id."""
    wanted = " ".join(A.SIMPLE.literal(prefix))
    hit = F.startswith("key", F.lit(wanted))
    if fuzzy_edits:
        hit = hit | (F.levenshtein(F.substring("key", 1, len(wanted)), F.lit(wanted), fuzzy_edits) >= 0)
    found = rows.where(hit if context is None else hit & context)
    order = (F.desc("weight"), F.asc("input"), F.asc(id))
    # a document shows once, with its best input
    best = top_per_key(found, "input" if skip_duplicates else id, order, 1).drop("_rank")
    return best.orderBy(*order).limit(size)


def suggest_completion_batch(rows: DataFrame, prefixes: DataFrame, prefix: str, id: str, *,
                             size: int = 5) -> DataFrame:
    """Many prefixes at once: an input is keyed by its beginnings of the lengths that are asked
    for, at most one number per length on the driver, and meets the prefixes in an equi-join.

    A beginning keeps its ``size`` best inputs, the least text and id first, before the join,
    inside every task before the shuffle. So a short prefix that very many inputs share is one
    row per task and rank.
    """
    asked = prefixes.select(F.col(prefix).alias("prefix"),
                            normalize_input(F.col(prefix)).alias("_p")).distinct()
    lengths = sorted(r[0] for r in asked.select(F.length("_p").alias("n")).distinct().collect())
    if not lengths:
        lengths = [0]
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("key"))
    keyed = rows.withColumn("_p", F.explode(F.transform(fitting, lambda n: F.substring(F.col("key"), F.lit(1), n))))
    best = top_per_key(keyed, "_p", (F.desc("weight"), F.asc("input"), F.asc(id)), size, rank="rank")
    return asked.join(best, "_p").select(*rows.columns, "prefix", "rank")


def suggest_hits(suggestions: DataFrame, docs: DataFrame, id: str) -> DataFrame:
    """Suggestions with the document they come from."""
    fresh = [c for c in docs.columns if c == id or c not in suggestions.columns]
    return suggestions.join(docs.select(*fresh), id)
