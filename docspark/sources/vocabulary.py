"""A stored vocabulary: terms found by the pieces they hold and by the words they are a few edits from."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import analysis as A
from .manifest import Manifests

#: Letters of a gram; a term begins and ends with a mark, so that grams say where a piece stands.
GRAM = 3
BEGIN, END = "\x02", "\x03"
#: Letters of the beginning from which keys leave out letters, and how many they leave out at most.
PREFIX, EDITS = 7, 2
#: Keys of a beginning at most, and rows of a table for which there is a file at least, so that a task sorts its share in memory.
KEYS, PART_ROWS = 29, 1 << 22


def grams_of(marked: Column) -> Column:
    """The distinct grams of a string."""
    n = F.length(marked)
    return F.when(n >= GRAM, F.array_distinct(F.transform(
        F.sequence(F.lit(1), n - (GRAM - 1)), lambda i: F.substr(marked, i, F.lit(GRAM))))).otherwise(F.array().cast("array<string>"))


def _shorter(word: Column) -> Column:
    """The string with each of its letters left out in turn."""
    return F.when(F.length(word) > 0, F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(
        F.substr(word, F.lit(1), i - 1), F.substr(word, i + 1)))).otherwise(F.array().cast("array<string>"))


def _start(word: Column) -> Column:
    return F.substr(word, F.lit(1), F.lit(PREFIX))


def keys_of(word: Column, edits: int = EDITS) -> Column:
    """The first ``PREFIX`` letters of a word, and what is left of them without up to ``edits`` letters.

    Words that are ``edits`` edits apart, swapped neighbours counting as one, share a key. For leave
    out, on both sides, the letters that an edit touches: what remains of the two beginnings
    is one string, or begins with the other, and the side with fewer edits has letters to spare.
    """
    out = level = F.array(_start(word))
    for _ in range(edits):
        level = F.array_distinct(F.flatten(F.transform(level, _shorter)))
        out = F.concat(out, level)
    return F.array_distinct(out)


def pieces_of(op: str, value: str) -> list[str] | None:
    """Strings that every marked term that fits has to hold; None for unknown operators.

    A pattern gives those letters that stand outside of groups, classes and choices and have no
    quantifier that lets them be absent.
    """
    if op == "contains":
        return [value]
    if op == "starts_with":
        return [BEGIN + value]
    if op == "ends_with":
        return [value + END]
    if op == "wildcard":
        return re.split(r"[*?]", BEGIN + value + END)
    if op != "regexp":
        return None
    if re.search(r"[|\\]|\(\?", value):
        return []
    flat = value
    while re.search(r"\([^()]*\)|\[[^\]]*\]", flat):
        flat = re.sub(r"\([^()]*\)|\[[^\]]*\]", "\0", flat)
    whole = re.sub(r".[*?{]", "\0", BEGIN + flat + END, flags=re.S)
    return re.split(r"[\0.+*?{}^$\[\]()]|\d*,?\d*}", re.sub(r"(.)\+", "\\1\0", whole, flags=re.S))


def required(pieces: list[str]) -> list[str]:
    """The grams of the pieces."""
    return sorted({p[i:i + GRAM] for p in pieces for i in range(len(p) - GRAM + 1)})


def swapped(word: Column) -> Column:
    """The words with one pair of neighbours exchanged."""
    n = F.length(word)
    return F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.concat(
        F.substr(word, F.lit(1), i - 1), F.substr(word, i + 1, F.lit(1)), F.substr(word, i, F.lit(1)), F.substr(word, i + 2)
    ))).otherwise(F.array().cast("array<string>"))


def apart(a: Column, b: Column, edits: Column, swaps: bool) -> Column:
    """``a`` is at most ``edits`` (0 to 2) edits from ``b``; a swapped pair may be one edit."""
    plain = F.levenshtein(a, b) <= edits
    if not swaps:
        return plain
    near = F.exists(swapped(b), lambda v: F.levenshtein(a, v) <= edits - 1)
    twice = F.exists(swapped(b), lambda v: F.array_contains(swapped(v), a))
    return plain | (edits >= 1) & near | (edits >= 2) & twice


@dataclass(frozen=True)
class Vocabulary:
    """Four tables under ``path``: ``terms`` as they came, ``grams`` with ``(gram, term)``, ``starts`` with the distinct
    beginnings of ``PREFIX`` letters and ``keys`` with ``(key, start)``. All but the third are dealt by sampled ranges and
    sorted, so that what is asked for is a few pages. Keys hang on the beginning alone, so terms that share one share its rows."""

    spark: SparkSession
    path: str
    opened: dict = field(default_factory=dict, compare=False, repr=False)

    @classmethod
    def build(cls, terms: DataFrame, path: str) -> Vocabulary:
        """``terms`` has ``term``, each once, and any other columns. A frequent gram is spread over
        the ranges that its share of the rows takes; there are as many ranges as the rows take."""
        spark, path = terms.sparkSession, path.rstrip("/")
        if Manifests(spark, path).latest() is not None:
            raise ValueError(f"vocabulary exists: {path}")
        new = cls(spark, path)
        terms.repartitionByRange("term").sortWithinPartitions("term").write.mode("errorifexists").parquet(f"{path}/terms")
        stored = new.terms().where(F.col("term").isNotNull())
        # equal beginnings are neighbours, so a task leaves most of them out before they move; keys take many tasks
        beginnings = stored.select(_start(F.col("term")).alias("start")).distinct()
        beginnings.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).write.mode("errorifexists").parquet(f"{path}/starts")
        starts = new._read("starts")
        marked = F.concat(F.lit(BEGIN), "term", F.lit(END))
        grams = stored.select(F.explode(grams_of(marked)).alias("gram"), "term")
        keys = starts.select(F.explode(keys_of(F.col("start"))).alias("key"), "start")
        new._deal(grams, "grams", stored.agg(F.coalesce(F.sum(F.length("term")), F.lit(0)).alias("n")).first()["n"])
        new._deal(keys, "keys", starts.count() * KEYS)
        Manifests(spark, path).write(1, {})
        return new

    def _deal(self, rows: DataFrame, name: str, most: int) -> None:
        """Writes at most so many rows, sorted in sampled ranges."""
        parts = -(-most // PART_ROWS)
        if parts > int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            dealt = rows.repartitionByRange(parts, *rows.columns)
        else:
            dealt = rows.repartitionByRange(*rows.columns)
        dealt.sortWithinPartitions(*rows.columns).write.mode("errorifexists").parquet(f"{self.path}/{name}")

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Vocabulary:
        if Manifests(spark, path.rstrip("/")).latest() is None:
            raise ValueError(f"no such vocabulary: {path}")
        return cls(spark, path.rstrip("/"))

    def _read(self, name: str) -> DataFrame:
        if name not in self.opened:
            self.opened[name] = self.spark.read.parquet(f"{self.path}/{name}")
        return self.opened[name]

    def terms(self) -> DataFrame:
        return self._read("terms")

    def candidates(self, op: str, value: str) -> DataFrame | None:
        """The ``term`` of all that hold the grams that a condition requires; None if it requires none.

        Grams that are required are a filter on the files; a term is counted once for each.
        """
        wanted = required(pieces_of(op, value) or [])
        if not wanted:
            return None
        held = self._read("grams").where(F.col("gram").isin(wanted))
        return held.groupBy("term").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(wanted)).select("term")

    def like(self, op: str, value: str) -> DataFrame:
        """The terms that a condition (``contains``, ``starts_with``, ``ends_with``, ``wildcard``, ``regexp``) fits.

        Only candidates are compared; a condition too short for a gram is compared with all.
        """
        value = value if op == "regexp" else value.lower()
        tests = {"contains": lambda t: F.contains(t, F.lit(value)), "starts_with": lambda t: F.startswith(t, F.lit(value)),
                 "ends_with": lambda t: F.endswith(t, F.lit(value)), "wildcard": lambda t: t.rlike(A.wildcard_regex(value)),
                 "regexp": lambda t: t.rlike(f"^(?:{value})$")}
        found = self.candidates(op, value)
        rows = self.terms() if found is None else self.terms().join(found, "term", "left_semi")
        return rows.where(tests[op](F.col("term")))

    def near(self, word: str, edits: int | None = None) -> DataFrame:
        """The terms within some edits of a word (by its length, if not given), swapped neighbours being one edit."""
        word = word.lower()
        edits = A.auto_fuzziness(word) if edits is None else edits
        if edits > EDITS:
            raise ValueError(f"at most {EDITS} edits")
        asked = self.spark.range(1).select(F.explode(keys_of(F.lit(word), edits))).collect()  # KEYS at most
        found = self._read("keys").where(F.col("key").isin([r[0] for r in asked])).select("start").distinct()
        return self.terms().join(found, _start(F.col("term")) == F.col("start"), "left_semi").where(A.within_edits(F.col("term"), word, edits))

    def near_all(self, words: DataFrame, word: str = "word", *, edits: int | Column | None = None, swaps: bool = True) -> DataFrame:
        """``(word, edits, term, ..)``: for every distinct word of a table the terms within some edits.

        Words and beginnings of terms meet in an equi-join on their keys, ``KEYS`` each at most; then each pair of them
        once meets the terms that begin so. The number of edits hangs on the length of the word, if nothing is said.
        """
        w, start = F.col("word"), F.col("start")
        by_length = F.when(F.length(w) < 3, 0).when(F.length(w) < 6, 1).otherwise(2)
        allowed = by_length if edits is None else edits if isinstance(edits, Column) else F.lit(edits)
        asked = words.select(F.lower(word).alias("word")).where("word IS NOT NULL").distinct().withColumn("edits", allowed)
        keyed = asked.select("word", "edits", F.explode(keys_of(w)).alias("key"))
        # a beginning with less than PREFIX letters is the whole term, others have terms of any length from there on
        longer = F.length(w) - F.length(start)
        fits = (longer >= -F.col("edits")) & ((longer <= F.col("edits")) | (F.length(start) == PREFIX))
        pairs = keyed.join(self._read("keys"), "key").where(fits).select("word", "edits", "start").distinct()
        found = (pairs.join(self.terms(), start == _start(F.col("term")))
                 .where((F.abs(F.length("word") - F.length("term")) <= F.col("edits")) & apart(F.col("term"), w, F.col("edits"), swaps)))
        return found.select("term", "word", "edits", *[c for c in self.terms().columns if c != "term"])
