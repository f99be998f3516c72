"""Relevance: BM25 in one scan, re-ranking, decay functions, similar documents.

A literal query names few terms, so nothing has to be exploded or shuffled to score it:
the frequency of each query term is counted inside the row, and the three corpus numbers a
score needs (documents, mean length, document frequency per term) come from one global
aggregate that every task pre-aggregates. That aggregate is a one-row scalar subquery.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import analysis as A
from ..plans.criteria import Bool, ConstantScore, Context, Criteria, Leaf, Node, term_test
from ..schema import DocSchema
from ..session import pinned
from ..sources.textindex import TextIndex
from . import similar

# Fixed values of the ranking function.
K1, B = 1.2, 0.75
#: Ids of sources that are sent to every task, at most.
SENT = 1 << 20


def idf(n_docs: Column, doc_freq: Column) -> Column:
    return F.log(1.0 + (n_docs - doc_freq + 0.5) / (doc_freq + 0.5))


def tf_norm(tf: Column, length: Column, avg_length: Column, k1: float = K1, b: float = B) -> Column:
    return tf / (tf + k1 * (1.0 - b + b * length / avg_length))


class _Scoring:
    """The scoring side of a Context: per text field a length, per term a frequency column."""

    def __init__(self, schema: DocSchema, wanted: dict[str, list[str]], similarity: str, struct: T.StructType):
        self.schema, self.wanted, self.similarity, self.struct = schema, wanted, similarity, struct
        self.number = {f: i for i, f in enumerate(wanted)}

    def _name(self, kind: str, field: str, term: str | None = None) -> str:
        base = f"__{kind}{self.number[field]}"
        return base if term is None else f"{base}_{self.wanted[field].index(term)}"

    def answers(self, leaf) -> bool:
        """Whether a condition is known without looking at the row's text."""
        return False

    def _text(self, field: str) -> Column:
        """The text of a field; several values are read one after the other."""
        name = self.schema.field(field).stored
        kind = self.struct[name].dataType if name in self.struct.fieldNames() else None
        return F.array_join(name, " \n ") if isinstance(kind, T.ArrayType) else F.col(name)

    def statistics(self, docs: DataFrame) -> Column:
        """One struct of corpus numbers as a scalar subquery."""
        counts, aggs = [], []
        for f, terms in self.wanted.items():
            spec = self.schema.field(f)
            length, text = F.col(self._name("len", f)), self._text(f)
            counts.append(F.coalesce(spec.analyzer.length(text), F.lit(0)).alias(self._name("len", f)))
            n = F.count_if(length > 0)
            aggs.append(n.cast("double").alias(self._name("n", f)))
            aggs.append((F.sum(length) / F.nullif(n, F.lit(0))).cast("double").alias(self._name("avg", f)))
            for t in terms:
                counts.append((spec.analyzer.frequency(text, t) > 0).alias(self._name("has", f, t)))
                aggs.append(F.count_if(self._name("has", f, t)).cast("double").alias(self._name("df", f, t)))
        one = docs.select(*counts).agg(F.struct(*aggs).alias("__stats"))
        return one.scalar()

    def prepare(self, hits: DataFrame, docs: DataFrame, only: Column | None = None) -> DataFrame:
        """Lengths and frequencies of the matching rows (of those where ``only`` holds)."""
        if not self.wanted:
            return hits
        counts = {}
        for f, terms in self.wanted.items():
            spec = self.schema.field(f)
            text = self._text(f) if only is None else F.when(only, self._text(f))
            counts[self._name("len", f)] = F.coalesce(spec.analyzer.length(text), F.lit(0)).cast("double")
            for t in terms:
                counts[self._name("tf", f, t)] = F.coalesce(
                    spec.analyzer.frequency(text, t), F.lit(0)).cast("double")
        return hits.withColumns(counts).withColumn("__stats", self.statistics(docs))

    def _weight(self, field: str, freq: Column, idf_: Column) -> Column:
        if self.similarity == "boolean":
            return (freq > 0).cast("double")
        length, avg = F.col(self._name("len", field)), F.col("__stats")[self._name("avg", field)]
        if self.similarity == "classic":
            return F.sqrt(freq) * idf_ * idf_ / F.sqrt(length)
        return F.coalesce(idf_ * tf_norm(freq, length, avg), F.lit(0.0))

    def _idf(self, field: str, term: str) -> Column:
        n, df = (F.col("__stats")[self._name("n", field)],
                 F.col("__stats")[self._name("df", field, term)])
        if self.similarity == "classic":
            return 1.0 + F.log((n + 1.0) / (df + 1.0))
        return idf(n, df)

    def term(self, field: str, term: str) -> Column:
        freq = F.col(self._name("tf", field, term))
        return F.when(freq > 0, self._weight(field, freq, self._idf(field, term))).otherwise(F.lit(0.0))

    def phrase(self, field: str, terms: Sequence[str]) -> Column:
        if not terms:
            return F.lit(0.0)
        spec = self.schema.field(field)
        freq = spec.analyzer.phrase_frequency(self._text(field), terms).cast("double")
        total = sum((self._idf(field, t) for t in terms), F.lit(0.0))
        return F.when(freq > 0, self._weight(field, freq, total)).otherwise(F.lit(0.0))

    def explanation(self) -> Column:
        """Array of what each term adds."""
        parts = []
        for f, terms in self.wanted.items():
            for t in terms:
                parts.append(F.struct(
                    F.lit(f).alias("field"), F.lit(t).alias("term"),
                    F.col(self._name("tf", f, t)).alias("tf"),
                    F.col("__stats")[self._name("df", f, t)].alias("df"),
                    self._idf(f, t).alias("idf"), self.term(f, t).alias("value")))
        return F.filter(F.array(*parts), lambda p: p["tf"] > 0)


def _wanted(nodes: Iterable[Node], schema: DocSchema) -> dict[str, list[str]]:
    """The terms of each text field that weigh in the score of any node."""
    wanted: dict[str, list[str]] = {}
    for leaf in (leaf for node in nodes for leaf in node.leaves()):
        for t in leaf.terms(schema):
            terms = wanted.setdefault(leaf.field, [])
            if t not in terms:
                terms.append(t)
    return wanted


class _IndexScoring(_Scoring):
    """Lengths, frequencies, phrases and corpus numbers from a stored index: no text is read for them.

    Conditions on terms and phrases are answered by the frequencies; pieces, patterns and
    fuzzy terms by the documents of the terms of the vocabulary that they stand for.
    """

    def __init__(self, schema, nodes: Sequence[Node], similarity, struct, index: TextIndex):
        leaves = [leaf for node in nodes for leaf in node.leaves() if leaf.field == index.field]
        wanted = {f: t for f, t in _wanted(nodes, schema).items() if f == index.field}
        super().__init__(schema, wanted, similarity, struct)
        self.index, spec = index, schema.field(index.field)
        spoken = [p for leaf in leaves if leaf.op in ("phrase", "in") for p in leaf.phrases(schema)] if spec.role == "text" else []
        self.phrases = list(dict.fromkeys(p for p in spoken if len(p) > 1))
        # conditions as keys: a leaf may hold a value that has no hash
        self.tests = {id(leaf): (leaf, test) for leaf in leaves if (test := term_test(leaf, spec)) is not None}

    def answers(self, leaf) -> bool:
        if id(leaf) in self.tests:
            return True
        return (leaf.field == self.index.field and leaf.op in ("is", "matches", "matches_all", "term", "phrase", "in")
                and set(leaf.terms(self.schema)) <= set(self.wanted.get(leaf.field, ()))
                and (leaf.op not in ("phrase", "in") or all(len(p) < 2 or p in self.phrases for p in leaf.phrases(self.schema))))

    def _times(self, field: str, phrase: Sequence[str]) -> Column:
        """How often a phrase stands in a document."""
        if len(phrase) == 1:
            return F.col(self._name("tf", field, phrase[0]))
        return F.col(f"__pf{self.phrases.index(tuple(phrase))}")

    def match(self, leaf) -> Column:
        if id(leaf) in self.tests:
            return F.coalesce(F.col(self._test_name(leaf)), F.lit(False))
        if leaf.op in ("phrase", "in"):
            found = [self._times(leaf.field, p) > 0 for p in leaf.phrases(self.schema) if p]
            return reduce(lambda a, b: a | b, found) if found else F.lit(False)
        terms = list(dict.fromkeys(leaf.terms(self.schema)))
        found = [F.col(self._name("tf", leaf.field, t)) > 0 for t in terms]
        if not found:
            return F.lit(False)
        return reduce(lambda a, b: a | b if leaf.op == "matches" else a & b, found)

    def phrase(self, field: str, terms: Sequence[str]) -> Column:
        if not terms:
            return F.lit(0.0)
        freq = self._times(field, terms).cast("double")
        total = sum((self._idf(field, t) for t in terms), F.lit(0.0))
        return F.when(freq > 0, self._weight(field, freq, total)).otherwise(F.lit(0.0))

    def _test_name(self, leaf) -> str:
        return f"__test{list(self.tests).index(id(leaf))}"

    def attach(self, docs: DataFrame) -> DataFrame:
        """``docs`` with the numbers of the terms; no frequency where a document has none."""
        out, key = docs, F.col(self.index.id)
        for leaf, test in self.tests.values():
            hits = self.index.with_terms(self.index.terms().where(test(F.col("term"))))
            out = out.join(hits.select(F.col(self.index.id).alias("__hit"), F.lit(True).alias(self._test_name(leaf))),
                           key == F.col("__hit"), "left").drop("__hit")
        if not self.wanted:
            return out
        (field, terms), = self.wanted.items()
        found = self.index.frequencies(terms, self.phrases).select(
            F.col("id").alias("__id"), F.col("doc_len").cast("double").alias(self._name("len", field)),
            *[F.col(f"tf{i}").cast("double").alias(self._name("tf", field, t)) for i, t in enumerate(terms)],
            *[F.col(f"pf{j}").alias(f"__pf{j}") for j in range(len(self.phrases))])
        return out.join(found, key == F.col("__id"), "left")

    def with_statistics(self, hits: DataFrame) -> DataFrame:
        """``hits`` with the corpus numbers that scores need."""
        if not self.wanted:
            return hits
        (field, terms), = self.wanted.items()
        numbers = self.index.numbers()
        dfs = self.index.terms(*terms).agg(F.struct(*[
            F.coalesce(F.max(F.when(F.col("term") == t, F.col("df"))), F.lit(0)).cast("double").alias(self._name("df", field, t))
            for t in terms])).scalar()
        return hits.withColumn("__stats", F.struct(
            numbers["n"].cast("double").alias(self._name("n", field)),
            F.try_divide(numbers["total"], numbers["n"]).cast("double").alias(self._name("avg", field)),
            *[dfs[self._name("df", field, t)].alias(self._name("df", field, t)) for t in terms]))


def _deciding(node: Node) -> Iterable[Node]:
    """Clauses that are required or excluded without a score."""
    if isinstance(node, ConstantScore):
        yield node.inner
        yield from _deciding(node.inner)
    if isinstance(node, Bool):
        for inner in (*node.must_not, *node.filter):
            yield inner
            yield from _deciding(inner)
        for inner in (*node.must, *node.should):
            yield from _deciding(inner)


def matching(docs: DataFrame, schema: DocSchema, node: Node | Criteria, index: TextIndex) -> DataFrame:
    """Rows that match ``node``; the conditions on the indexed text are answered by the index.

    Terms, phrases, pieces, patterns and fuzzy terms read postings; the text is only read for
    what they can't answer, or if it is asked for.
    """
    node = node.build() if isinstance(node, Criteria) else node
    scoring = _IndexScoring(schema, [node, *_deciding(node)], "bm25", docs.schema, index)
    return scoring.attach(docs).where(node.match(Context(docs.schema, schema, scoring))).select(*docs.columns)


def with_score(docs: DataFrame, schema: DocSchema, node: Node | Criteria, *,
               corpus: DataFrame | None = None, similarity: str = "bm25",
               explain: bool = False, column: str = "_score", index: TextIndex | None = None) -> DataFrame:
    """Rows that match ``node`` with their score.

    With a stored ``index`` of the text field, frequencies, lengths and corpus numbers come from the
    postings of the query's terms; the texts are read only if they are asked for. An index of
    more than ``docs`` gives the numbers of all that it holds.

    Statistics are global: they describe ``corpus`` (default: all of ``docs``), never the
    part that one task or partition happens to see.
    """
    if similarity not in ("bm25", "default", "classic", "boolean"):
        raise ValueError(f"unknown similarity {similarity!r}")
    if isinstance(node, Criteria):
        node = node.build()
    wanted = _wanted([node], schema)
    if index is not None and list(wanted) == [index.field]:
        # terms that only decide are looked up as well
        scoring = _IndexScoring(schema, [node, *_deciding(node)], similarity, docs.schema, index)
        wanted, ctx = scoring.wanted, Context(docs.schema, schema, scoring)
        hits = scoring.with_statistics(scoring.attach(docs).where(node.match(ctx)))
    else:
        scoring = _Scoring(schema, wanted, similarity, docs.schema)
        ctx = Context(docs.schema, schema, scoring)
        hits = docs.where(node.match(ctx))
        hits = scoring.prepare(hits, corpus if corpus is not None else docs)
    hits = hits.withColumn(column, node.score(ctx))
    keep = [*docs.columns, column]
    if explain:
        hits = hits.withColumn("_explanation", scoring.explanation() if wanted
                               else F.array().cast("array<string>"))
        keep.append("_explanation")
    return hits.select(*[c for c in dict.fromkeys(keep)])


# --- the best hits ------------------------------------------------------------------------------

#: Blocks of the first wave, how much larger each wave is, and the longest list of blocks in a filter.
FIRST_BLOCKS, GROWTH, LISTED = 256, 16, 4096


def any_terms(node: Node | Criteria, schema: DocSchema, field: str) -> dict[str, float] | None:
    """The terms and weights of a query that wants any of some terms of a text; None for others."""
    node = node.build() if isinstance(node, Criteria) else node
    clauses = [node]
    if isinstance(node, Bool):
        if node.must or node.must_not or node.filter or (node.min_should or 1) != 1 or node.boost_ != 1.0:
            return None
        clauses = list(node.should)
    out: dict[str, float] = {}
    for leaf in clauses:
        if not isinstance(leaf, Leaf) or leaf.field != field or leaf.boost_ <= 0:
            return None
        terms = leaf.terms(schema)
        if not (leaf.op == "matches" or leaf.op in ("is", "term", "matches_all") and len(terms) == 1):
            return None
        if len(set(terms)) != len(terms) or set(terms) & set(out):
            return None
        out.update((t, leaf.boost_) for t in terms)
    return out or None


def best_hits(index: TextIndex, query: dict[str, float], k: int) -> DataFrame:
    """The ``k`` documents with the highest scores for any of the query's terms: ``(id, _score)``.

    A block of documents has a bound for each term, so a sum of bounds says what its best document
    can score at most. Blocks are read in waves, the highest bounds first: ``FIRST_BLOCKS``, then ``GROWTH`` times as
    many, and so on. After each wave the score of the k-th hit so far is the threshold, and when no block
    is left that reaches it, the hits are final; ties are broken by the id. Beyond ``LISTED`` blocks
    the rest is read in one wave, by a semi-join with those that still reach the threshold.

    Runs a job for each wave when it is called; what reaches the driver is ``k`` rows and a wave's numbers of
    blocks. The scores are those of ``with_score``.
    """
    terms, spark = list(query), index.spark
    frequencies = [F.max(F.when(F.col("term") == t, F.col("df"))) for t in terms]
    stats = spark.range(1).select(index.numbers().alias("s"), index.terms(*terms).agg(F.array(*[
        F.coalesce(f, F.lit(0)) for f in frequencies])).scalar().alias("df")).first()
    numbers, dfs = stats["s"], stats["df"]
    kind = index.blocks()[0].schema["entries"].dataType.elementType["id"].dataType
    found = spark.createDataFrame([], T.StructType([T.StructField(index.id, kind), T.StructField("_score", T.DoubleType())]))
    if not numbers["n"] or k < 1:
        return found
    n, avg = F.lit(float(numbers["n"])), F.lit(numbers["total"] / numbers["n"])

    def worth(term: str, df: int):
        weight = idf(n, F.lit(float(df)))
        return lambda tf, length: weight * tf_norm(tf.cast("double"), length.cast("double"), avg) * F.lit(query[term])

    worths = {t: worth(t, d) for t, d in zip(terms, dfs) if d}
    if not worths:
        return found
    # a sum in another order may differ in its last digits
    bounds = index.bounds(worths).withColumn("bound", F.col("bound") * (1 + 1e-9))
    order = (F.desc("bound"), F.asc("segment"), F.asc("block"))
    best: list = []
    beyond, least, wave = F.lit(True), float("-inf"), FIRST_BLOCKS

    def scored(tables: list[DataFrame]) -> DataFrame:
        rows = index.frequencies(terms, tables=tables)
        value = sum((F.when(F.col(f"tf{i}") > 0, worths[t](F.col(f"tf{i}"), F.col("doc_len"))).otherwise(0.0)
                     for i, t in enumerate(terms) if t in worths), F.lit(0.0))
        return rows.select("id", value.alias("_score")).orderBy(F.desc("_score"), F.asc("id")).limit(k)

    while True:
        rest = bounds.where(beyond & (F.col("bound") >= least))
        if wave > LISTED:
            best = best + scored(index.blocks_of(terms, rest)).collect()
            break
        chosen = rest.orderBy(*order).limit(wave).collect()
        if chosen:
            best += scored(index.some_blocks(terms, [(r["segment"], r["block"]) for r in chosen])).collect()
            best = sorted(sorted(best, key=lambda r: r["id"]), key=lambda r: -r["_score"])[:k]
        if len(chosen) < wave:
            break
        last = chosen[-1]
        beyond = F.struct((-F.col("bound")).alias("b"), "segment", "block") > F.struct(
            F.lit(-last["bound"]).alias("b"), F.lit(last["segment"]).alias("segment"), F.lit(last["block"]).cast("long").alias("block"))
        least, wave = best[k - 1]["_score"] if len(best) == k else float("-inf"), wave * GROWTH
        if least > last["bound"]:
            break
    best = sorted(sorted(best, key=lambda r: r["id"]), key=lambda r: -r["_score"])[:k]
    return spark.createDataFrame([tuple(r) for r in best], found.schema)


def settled(df: DataFrame, column: str) -> DataFrame:
    """The frame with a dear column that later filters use as a value.

    Catalyst pushes a filter on a computed column below its computation and so evaluates
    it twice; it does not push it through a generator.
    """
    others = [F.col(c) for c in df.columns if c != column]
    return df.select(*others, F.explode_outer(F.array(column)).alias(column))


def max_score(hits: DataFrame) -> DataFrame:
    return hits.agg(F.max("_score").alias("max_score"))


def index_boost(hits: DataFrame, factors: dict[str, float], index_column: str = "_index") -> DataFrame:
    """Multiply scores by the factor of the index a hit came from."""
    factor = F.lit(1.0)
    for name, value in factors.items():
        factor = F.when(F.col(index_column) == name, F.lit(float(value))).otherwise(factor)
    return hits.withColumn("_score", F.col("_score") * factor)


def matched_queries(docs: DataFrame, schema: DocSchema, clauses: dict[str, Node],
                    corpus: DataFrame | None = None) -> DataFrame:
    """``matched_queries``: the named clauses that hold for a row, with their scores. Text clauses
    score their relevance in ``corpus`` (default: ``docs``)."""
    scoring = _Scoring(schema, _wanted(clauses.values(), schema), "bm25", docs.schema)
    ctx = Context(docs.schema, schema, scoring)
    prepared = scoring.prepare(docs, corpus if corpus is not None else docs)
    entries = F.array(*[F.struct(F.lit(n).alias("key"), c.score(ctx).alias("value"),
                                 c.match(ctx).alias("hit")) for n, c in clauses.items()])
    kept = F.transform(F.filter(entries, lambda e: e["hit"]),
                       lambda e: F.struct(e["key"], e["value"]))
    return prepared.withColumn("matched_queries", F.map_from_entries(kept)).select(*docs.columns, "matched_queries")


# --- re-ranking ---------------------------------------------------------------------------------

RESCORE_MODES = ("total", "multiply", "avg", "max", "min")


def combine_scores(first: Column, second: Column, mode: str, query_weight: float,
                   rescore_weight: float) -> Column:
    if mode not in RESCORE_MODES:
        raise ValueError(f"rescore mode must be one of {RESCORE_MODES}")
    q, r = first * float(query_weight), second * float(rescore_weight)
    return {"total": q + r, "multiply": q * r, "avg": (q + r) / 2.0,
            "max": F.greatest(q, r), "min": F.least(q, r)}[mode]


def rescore(hits: DataFrame, schema: DocSchema, node: Node, *, tie_break: str, window: int = 10,
            mode: str = "total", query_weight: float = 1.0, rescore_weight: float = 1.0,
            corpus: DataFrame | None = None, matching_only: bool = True, index: TextIndex | None = None) -> DataFrame:
    """Re-rank the best ``window`` hits by a second query; the others keep their places below.

    With an ``index`` of the text that the second query asks for, its terms are read from postings.

    The top of the list is a bounded ``orderBy.limit``. A hit is in it if it ranks at
    or above the last one, which is one scalar comparison for the rest: no rank over all hits.
    Adds ``_rescored`` (0 = in the window) to sort by before ``_score``.
    """
    node = node.build() if isinstance(node, Criteria) else node
    last = (hits.orderBy(F.desc("_score"), F.asc(tie_break)).limit(window)
            .agg(F.max(F.struct(-F.col("_score"), F.col(tie_break))).alias("k")).scalar())
    key = F.struct(-F.col("_score"), F.col(tie_break))
    base = hits.withColumn("_rescored", (key > last).cast("int"))
    wanted = _wanted([node], schema)
    if index is not None and list(wanted) == [index.field]:
        scoring = _IndexScoring(schema, [node, *_deciding(node)], "bm25", hits.schema, index)
        prepared = scoring.with_statistics(scoring.attach(base))
    else:
        scoring = _Scoring(schema, wanted, "bm25", hits.schema)
        prepared = scoring.prepare(base, corpus if corpus is not None else hits, only=F.col("_rescored") == 0)
    ctx = Context(hits.schema, schema, scoring)
    second = node.score(ctx)
    combined = combine_scores(F.col("_score"), second, mode, query_weight, rescore_weight)
    weighted = F.col("_score") * float(query_weight)
    applies = node.match(ctx) if matching_only else F.lit(True)
    score = (F.when(F.col("_rescored") == 1, F.col("_score"))
             .when(applies, combined).otherwise(weighted))
    return prepared.withColumn("_score", score).select(*hits.columns, "_rescored")


def gauss_decay(value: Column, origin: float, scale: float, decay: float = 0.5,
                offset: float = 0.0) -> Column:
    variance = -(scale ** 2) / (2.0 * math.log(decay))
    distance = F.greatest(F.lit(0.0), F.abs(value - origin) - offset)
    return F.exp(-(distance * distance) / (2.0 * variance))


def exp_decay(value: Column, origin: float, scale: float, decay: float = 0.5,
              offset: float = 0.0) -> Column:
    distance = F.greatest(F.lit(0.0), F.abs(value - origin) - offset)
    return F.exp(distance * (math.log(decay) / scale))


def linear_decay(value: Column, origin: float, scale: float, decay: float = 0.5,
                 offset: float = 0.0) -> Column:
    reach = scale / (1.0 - decay)
    distance = F.greatest(F.lit(0.0), F.abs(value - origin) - offset)
    return F.greatest(F.lit(0.0), (reach - distance) / reach)


def function_score(base: Column, functions: Sequence[tuple[Column | None, Column]], *,
                   score_mode: str = "multiply", boost_mode: str = "multiply",
                   max_boost: float | None = None) -> Column:
    """Combine (condition, value) functions with each other and then with the base score."""
    values = [F.when(F.coalesce(cond, F.lit(False)), v) if cond is not None else v
              for cond, v in functions]
    present = F.array_compact(F.array(*values))
    n = F.size(present)
    total = F.aggregate(present, F.lit(0.0), lambda a, x: a + x)
    if score_mode == "sum":
        combined = total
    elif score_mode == "avg":
        combined = total / n
    elif score_mode == "max":
        combined = F.array_max(present)
    elif score_mode == "min":
        combined = F.array_min(present)
    elif score_mode == "first":
        combined = F.coalesce(*values)
    elif score_mode == "multiply":
        combined = F.aggregate(present, F.lit(1.0), lambda a, x: a * x)
    else:
        raise ValueError(f"unknown score mode {score_mode!r}")
    combined = F.when(n == 0, F.lit(1.0)).otherwise(combined)
    if max_boost is not None:
        combined = F.least(combined, F.lit(float(max_boost)))
    return {"multiply": base * combined, "replace": combined, "sum": base + combined,
            "avg": (base + combined) / 2.0, "max": F.greatest(base, combined),
            "min": F.least(base, combined)}[boost_mode]


# --- postings -------------------------------------------------------------------------------------


def postings(docs: DataFrame, id: str, text: str, analyzer: A.Analyzer = A.STANDARD) -> DataFrame:
    """``(id, doc_len, term, tf)``: one row per distinct term of a document.

    Terms are counted inside the row of their document: nothing is shuffled.
    """
    each = docs.select(id, F.explode(A.term_counts(analyzer.column(F.col(text)))).alias("t"))
    return each.select(id, "t.doc_len", "t.term", "t.tf")


def stored_postings(docs: DataFrame, id: str, text: str, path: str,
                    analyzer: A.Analyzer = A.STANDARD) -> DataFrame:
    """Postings as a written table: the text is analyzed once, however often they are read.

    Files are sorted by term, so that reading a few terms skips most row groups.
    """
    rows = postings(docs, id, text, analyzer)
    rows.sortWithinPartitions("term").write.mode("errorifexists").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def positions(docs: DataFrame, id: str, text: str, analyzer: A.Analyzer = A.STANDARD) -> DataFrame:
    """``(id, term, pos)``: only where positions are asked for."""
    rows = docs.select(id, F.posexplode_outer(analyzer.column(F.col(text))).alias("pos", "term"))
    return rows.where(F.col("term").isNotNull())


def document_frequencies(post: DataFrame) -> DataFrame:
    """``(term, df)``; each task pre-aggregates, so a stop word is no hot group."""
    return post.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def vocabulary(docs: DataFrame, id: str, text: str, analyzer: A.Analyzer = A.STANDARD) -> DataFrame:
    """``(term, df, freq)`` of a text column, pre-aggregated in every task.

    Terms and distinct terms of a text are two streams into one sum, so that no terms are
    counted in the row and no (term, document) is shuffled.
    """
    toks = analyzer.column(F.col(text))
    each = docs.select(F.explode(toks).alias("term"), F.lit(0).alias("df"), F.lit(1).alias("freq"))
    distinct = docs.select(F.explode(F.array_distinct(toks)).alias("term"), F.lit(1).alias("df"), F.lit(0).alias("freq"))
    return each.union(distinct).groupBy("term").agg(F.sum("df").alias("df"), F.sum("freq").alias("freq"))


# --- more like this -----------------------------------------------------------------------------------


def more_like_this(docs: DataFrame, source: DataFrame, id: str, text: str, *,
                   analyzer: A.Analyzer = A.STANDARD, min_term_freq: int = 2,
                   max_query_terms: int = 25, min_doc_freq: int = 5, max_doc_share: float = 1.0,
                   min_word_len: int = 0, max_word_len: int = 0, stop_words: Sequence[str] = (),
                   min_should_match: float = 0.3, boost_terms: float | None = None,
                   size: int = 10, index: TextIndex | None = None) -> DataFrame:
    """For every row of ``source`` (an ``id`` column) the documents that share its
    characteristic terms: ``(source_id, id, _score, rank)``.

    Batch form: the characteristic terms of all sources (at most ``max_query_terms`` each) are sent to
    every shard of the documents, and a task sums up the scores of one source after the other. Each shard gives
    ``size`` documents of a source at most: pairs are neither shuffled nor stored, postings neither. Analyzed documents
    go to their shards in packs of a few bytes a term. A document has to share ``min_should_match`` of the terms. For anything big pass a stored ``index`` and bound the
    terms by ``max_doc_share``, the share of the documents that may hold them.
    """
    if index is not None:
        post = index.postings().withColumnRenamed("id", id)
        analyzed = index.documents().withColumnRenamed("id", id)
        numbers = index.numbers()
        n_stats = F.struct(numbers["n"].cast("double").alias("n"), F.try_divide(numbers["total"], numbers["n"]).alias("avg"))
        frequencies = index.terms()
    else:
        post = postings(docs, id, text, analyzer)
        analyzed = docs.select(id, (analyzer.joined or analyzer.column)(F.col(text)).alias("terms"),
                               F.monotonically_increasing_id().alias("block"))
        per_doc = post.groupBy(id).agg(F.first("doc_len").alias("l"))
        n_stats = per_doc.agg(F.struct(F.count(F.lit(1)).cast("double").alias("n"),
                                       F.avg("l").alias("avg")).alias("s")).scalar()
        frequencies = document_frequencies(post)
    ids = pinned(source.select(id).distinct())
    # told, as nothing is known of the size of a filtered table: else all postings are shuffled for the few of the sources
    own = post.join(F.broadcast(ids) if ids.count() <= SENT else ids, id, "left_semi")
    usable = F.col("tf") >= min_term_freq
    if min_word_len:
        usable &= F.length("term") >= min_word_len
    if max_word_len:
        usable &= F.length("term") <= max_word_len
    if stop_words:
        usable &= ~F.col("term").isin(list(stop_words))
    df_ok = F.col("df") >= min_doc_freq
    if max_doc_share < 1:
        df_ok &= F.col("df") <= n_stats["n"] * float(max_doc_share)
    weighted = (own.where(usable).join(frequencies.where(df_ok).select("term", "df"), "term")
                .withColumn("_n", n_stats["n"])
                .withColumn("_w", F.col("tf") * idf(F.col("_n"), F.col("df"))))
    best = Window.partitionBy(id).orderBy(F.desc("_w"), "term")
    picked = (weighted.withColumn("_r", F.row_number().over(best))
              .where(F.col("_r") <= max_query_terms))
    # the same partitioning once more, over at most ``max_query_terms`` rows
    whole = Window.partitionBy(id)
    terms = picked.select(
        F.col(id).alias("source_id"), "term", "df", "_n", "_w",
        F.count(F.lit(1)).over(whole).alias("_terms"), F.max("_w").over(whole).alias("_top"))
    boost = F.lit(1.0) if boost_terms is None else F.col("_w") / F.col("_top") * float(boost_terms)
    need = F.greatest(F.lit(1), F.floor(F.max("_terms") * float(min_should_match)).cast("int"))
    each = pinned(terms.select("source_id", "term", "_terms", (boost * idf(F.col("_n"), F.col("df"))).alias("weight")))
    asked = (each.groupBy("source_id").agg(F.collect_list(F.struct("term", "weight")).alias("t"), need.alias("need"))
             .select("source_id", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights"), "need"))
    n_sources = each.agg(F.count_distinct("source_id")).scalar()
    scored = similar.best_shared(analyzed, asked, id, n_stats["n"], n_sources, n_stats["avg"], tf_norm, size)
    # a distributed sum varies in its last digits; copies must still tie and fall back to the id
    rank = Window.partitionBy("source_id").orderBy(F.desc(F.round("_score", 9)), F.asc(id))
    return (scored.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= size)
            .select("source_id", id, "_score", "rank"))
