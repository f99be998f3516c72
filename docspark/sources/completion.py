"""A stored completion index: the best inputs of every beginning, with or without a context."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import analysis as A
from ..operators.collapse import top_per_key
from ..operators.suggest import normalize_input, suggest_completion
from ..session import pinned
from .manifest import Manifests

#: Letters of the longest beginning that has a list, and how many inputs a list keeps.
DEPTH, KEPT = 8, 20


def scope_of(context: str, value) -> str:
    """The lists of one value of a context column."""
    return f"{context}\x1f{value}"


@dataclass(frozen=True)
class CompletionIndex:
    """Two tables under ``path``.

    ``rows``: the completion rows ``(id, input, key, weight, contexts..)``, dealt by ranges of the key and sorted;
    ``lists``: ``(scope, prefix, rank, id, input, weight)``, the best inputs of each beginning, of all
    rows (the empty scope) and of the rows with one value of a context, laid out likewise. A
    list is a few neighbouring rows of one file.
    """

    spark: SparkSession
    path: str
    id: str
    contexts: tuple[str, ...] = ()
    depth: int = DEPTH
    kept: int = KEPT
    opened: dict = field(default_factory=dict, compare=False, repr=False)

    @classmethod
    def build(cls, rows: DataFrame, id: str, path: str, *, contexts: Sequence[str] = (), depth: int = DEPTH,
              kept: int = KEPT) -> CompletionIndex:
        """``rows`` are those of ``completion_rows``. A document is listed once under a beginning, with its best input.

        Only the longest beginnings are listed from rows. A shorter one is merged from the lists
        of those that are a letter longer and the inputs that end there: whatever is among the
        best of a beginning is among the best of its next letter. So the empty beginning, of all
        rows, is merged from one list for each letter, and no group is larger than that.
        """
        new = cls(rows.sparkSession, path.rstrip("/"), id, tuple(contexts), depth, kept)
        stored = Manifests(new.spark, new.path)
        if stored.latest() is not None:
            raise ValueError(f"completion index exists: {path}")
        (rows.select(id, "input", "key", "weight", *contexts).repartitionByRange("key", "input", id)
         .sortWithinPartitions("key", "input", id).write.mode("errorifexists").parquet(f"{new.path}/rows"))
        named = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}\x1f"), F.col(c).cast("string"))) for c in contexts]
        scopes = F.array_compact(F.array(F.lit(""), *named))
        each = new.rows().where(F.col("key").isNotNull()).select(
            F.explode(scopes).alias("scope"), F.substr("key", F.lit(1), F.lit(depth)).alias("prefix"), F.col(id).alias("id"), "input", "weight")
        # inputs wait at the length where they end, or at the longest one
        waiting = pinned(new._best(each))
        lists, level = [], None
        for n in range(depth, -1, -1):
            here = waiting.where(F.length("prefix") == n)
            if level is not None:
                shorter = level.drop("rank").withColumn("prefix", F.substr("prefix", F.lit(1), F.lit(n)))
                here = here.drop("rank").unionByName(shorter)
                here = new._best(here)
            level = pinned(here)
            lists.append(level)
        out = lists[0]
        for part in lists[1:]:
            out = out.unionByName(part)
        (out.select("scope", "prefix", "rank", "id", "input", "weight").repartitionByRange("scope", "prefix")
         .sortWithinPartitions("scope", "prefix", "rank").write.mode("errorifexists").parquet(f"{new.path}/lists"))
        stored.write(1, {"id": id, "contexts": list(contexts), "depth": depth, "kept": kept})
        return new

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> CompletionIndex:
        stored = Manifests(spark, path.rstrip("/"))
        number = stored.latest()
        if number is None:
            raise ValueError(f"no such completion index: {path}")
        said = stored.read(number)
        return cls(spark, path.rstrip("/"), said["id"], tuple(said["contexts"]), said["depth"], said["kept"])

    def _best(self, rows: DataFrame) -> DataFrame:
        """The best inputs of each ``(scope, prefix)`` with their ``rank``, a document once.

        The rows of a document under a beginning are few; both steps cut inside every task before
        the shuffle.
        """
        order = (F.desc("weight"), F.asc("input"), F.asc("id"))
        keyed = rows.withColumn("_list", F.struct("scope", "prefix"))
        once = top_per_key(keyed.withColumn("_one", F.struct("scope", "prefix", "id")), "_one", order, 1).drop("_rank", "_one")
        return top_per_key(once, "_list", order, self.kept, rank="rank").drop("_list")

    def rows(self) -> DataFrame:
        return self._read("rows")

    def lists(self) -> DataFrame:
        return self._read("lists")

    def _read(self, name: str) -> DataFrame:
        if name not in self.opened:
            self.opened[name] = self.spark.read.parquet(f"{self.path}/{name}")
        return self.opened[name]

    def suggest(self, prefix: str, *, size: int = 5, context: tuple[str, object] | None = None) -> DataFrame:
        """``(id, input, weight)``: the best inputs that start with the prefix, of one value of a context if given.

        A beginning up to the longest listed one is one list. A longer one, or more inputs
        than a list keeps, filters the sorted rows by the beginning.
        """
        wanted = " ".join(A.SIMPLE.literal(prefix))
        if context is not None and context[0] not in self.contexts:
            raise ValueError(f"no lists for the context {context[0]!r}")
        if len(wanted) <= self.depth and size <= self.kept:
            scope = "" if context is None else scope_of(*context)
            mine = self.lists().where((F.col("scope") == scope) & (F.col("prefix") == wanted) & (F.col("rank") <= size))
            return mine.orderBy("rank").select(F.col("id").alias(self.id), "input", "weight")
        rows = self.rows().where(F.startswith("key", F.lit(wanted)))
        only = None if context is None else F.col(context[0]).cast("string") == F.lit(str(context[1]))
        return suggest_completion(rows, prefix, self.id, size=size, context=only).select(self.id, "input", "weight")

    def suggest_all(self, prefixes: DataFrame, prefix: str, *, size: int = 5) -> DataFrame:
        """``(prefix, id, input, weight, rank)`` of every distinct prefix of a table, at most as long as the
        longest listed beginning: one equi-join with the lists."""
        if size > self.kept:
            raise ValueError(f"lists keep {self.kept} inputs")
        asked = prefixes.select(F.col(prefix).alias("asked"), normalize_input(F.col(prefix)).alias("prefix")).distinct()
        asked = asked.where(F.assert_true(F.coalesce(F.length("prefix"), F.lit(0)) <= self.depth, F.lit("a prefix is longer than the lists")).isNull())
        mine = self.lists().where((F.col("scope") == "") & (F.col("rank") <= size)).drop("scope")
        return asked.join(mine, "prefix").select(F.col("asked").alias("prefix"), F.col("id").alias(self.id), "input", "weight", "rank")
