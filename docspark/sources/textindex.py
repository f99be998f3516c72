"""A stored index of one text column: blocks of positional postings in segments, laid out by term."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import analysis as A
from . import postings
from .manifest import Manifests

#: Documents of a block, the unit that a search for the best hits reads or leaves out.
BLOCK_BITS = 6
#: Rows of a Parquet page of the postings, the least that a filter can leave out.
PAGE_ROWS = 256
#: Postings are numbers near those before them: Parquet keeps the differences, and a dictionary of the terms alone.
ENCODING = {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "false", "parquet.enable.dictionary#term": "true"}
#: Terms of all texts for which there is a file of postings, so that a task sorts its share in memory, and how many
#: places are looked at for each, to find ranges of one size.
PART_TERMS, SAMPLED = 1 << 21, 200
#: Ranges of blocks that a filter on the files names at most.
RANGES = 16
#: Segments of about one size that are merged into one, and how a tier grows.
TIER = 4


@dataclass(frozen=True)
class TextIndex:
    """One version of an index; ``add``, ``delete``, ``upsert`` and ``merge`` give the next one.

    Its segments never change. One has, under ``path``:

    ``docs``: ``(id, doc_len, terms)``, the analyzed documents, which a merge starts from; terms are one string with
    spaces between them where the analyzer can tell it, else an array;
    ``blocks``: ``(term, block, n, freq, max_tf, min_len, entries, positions)``, a row for each term and
    block with the ``(id, tf, doc_len)`` of its documents and the positions of the term in each;
    ``terms``: ``(term, df, freq)``; ``numbers``: one row, documents and terms in all.

    A document that was deleted later stays in them. Its id is in a ``gone`` folder of the segment,
    whose terms and numbers are taken off by negative rows, so that all counts are those of the living.
    Documents of a block have about one length, so its bounds are near what its best one scores.
    """

    spark: SparkSession
    path: str
    field: str
    id: str
    analyzer: A.Analyzer = A.STANDARD
    version: int = 0
    #: ``(name, documents, folders of deleted ids)`` of each segment
    segments: tuple[tuple[str, int, tuple[str, ...]], ...] = ()
    #: tables that were opened; their files never change
    opened: dict = field(default_factory=dict, compare=False, repr=False)

    # --- versions --------------------------------------------------------------------------------

    @classmethod
    def build(cls, docs: DataFrame, id: str, text: str, path: str, analyzer: A.Analyzer = A.STANDARD) -> TextIndex:
        """Analyze all texts once into a new index of one segment. Ids have to be distinct."""
        empty = cls(docs.sparkSession, path.rstrip("/"), text, id, analyzer)
        if Manifests(empty.spark, empty.path).latest() is not None:
            raise ValueError(f"index exists: {path}")
        return empty.add(docs)

    @classmethod
    def open(cls, spark: SparkSession, path: str, analyzer: A.Analyzer = A.STANDARD) -> TextIndex:
        """The latest version."""
        stored = Manifests(spark, path.rstrip("/"))
        number = stored.latest()
        if number is None:
            raise ValueError(f"no such index: {path}")
        held = stored.read(number)
        return cls(spark, path.rstrip("/"), held["field"], held["id"], analyzer, number,
                   tuple((n, d, tuple(g)) for n, d, g in held["segments"]))

    def _commit(self, segments: Iterable[tuple[str, int, tuple[str, ...]]]) -> TextIndex:
        new = replace(self, version=self.version + 1, segments=tuple(segments))
        Manifests(self.spark, self.path).write(new.version, {"field": self.field, "id": self.id, "segments": new.segments})
        return new

    def add(self, docs: DataFrame) -> TextIndex:
        """New documents are a segment of their own; whoever has read an older version keeps it."""
        terms = self.analyzer.joined or self.analyzer.column
        analyzed = docs.select(F.col(self.id).alias("id"), terms(F.col(self.field)).alias("terms"))
        return self._commit([*self.segments, self._segment(analyzed)])

    def delete(self, ids: DataFrame) -> TextIndex:
        """Without the documents of a table's ``id`` column. Each segment gets a list of its own ids
        and what they counted for; no postings are written."""
        wanted, out = ids.select(F.col(self.id).alias("id")).distinct(), []
        for segment in self.segments:
            name, n, gone = segment
            dead = self._living_docs(segment).join(wanted, "id", "left_semi").select("id", "doc_len", "terms")
            folder = f"{name}/gone-{uuid.uuid4().hex}"
            self._write(f"{folder}/docs", dead)
            dead = self._read(f"{folder}/docs")
            numbers = dead.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("doc_len"), F.lit(0)).alias("total"))
            lost = numbers.first()["n"]
            if lost:
                each = dead.select("id", F.explode(postings.term_array(dead)).alias("term")).groupBy("term", "id").agg(F.count(F.lit(1)).alias("tf"))
                self._write(f"{folder}/terms", each.groupBy("term").agg((-F.count(F.lit(1))).alias("df"), (-F.sum("tf")).alias("freq"))
                            .sortWithinPartitions("term"))
                self._write(f"{folder}/numbers", numbers.select((-F.col("n")).alias("n"), (-F.col("total")).alias("total")))
                segment = (name, n - lost, (*gone, folder))
            out.append(segment)
        return self._commit([s for s in out if s[1]] or out[:1])

    def upsert(self, docs: DataFrame) -> TextIndex:
        """The documents with these ids are replaced, others added."""
        return self.delete(docs).add(docs)

    def merge(self) -> TextIndex:
        """Tiered merges: where ``TIER`` segments have about one size, one segment takes their place.

        It is written from their analyzed documents, without the deleted ones. A document is
        written again once for each tier that it rises.
        """
        by: dict[int, list] = {}
        for segment in self.segments:
            tier, size = 0, segment[1]
            while size >= TIER:
                tier, size = tier + 1, size // TIER
            by.setdefault(tier, []).append(segment)
        kept, merged = [], []
        for same in by.values():
            (merged if len(same) >= TIER else kept).append(same)
        if not merged:
            return self
        new = [self._segment(reduce(DataFrame.unionByName, [self._living_docs(s).select("id", "terms") for s in same]))
               for same in merged]
        return self._commit([*(s for same in kept for s in same), *new]).merge()

    def _segment(self, analyzed: DataFrame) -> tuple[str, int, tuple[str, ...]]:
        """Writes ``(id, terms)`` as a segment.

        Documents are sorted by length inside the tasks that read them and numbered as they are read
        back: a block is so many neighbours, and no text moves. A task gathers the places of a term in the
        documents of a batch, and all it has for one sampled range of (term, block) moves as one value. So a rare
        term is in one file, and one that is in a third of all blocks is in a third of the files. The ranges are
        known before, from a look at some places, so that documents are packed once.
        """
        name = f"segment-{uuid.uuid4().hex}"
        # the empty ones go by a condition on a number: else the optimizer analyzes texts again for their lengths
        rows = analyzed.select("id", "terms", postings.doc_len(analyzed).alias("doc_len"),
                               F.monotonically_increasing_id().alias("_nr")).where("doc_len > 0 AND _nr >= 0").drop("_nr")
        self._write(f"{name}/docs", rows.sortWithinPartitions("doc_len", "id"))
        docs = self._read(f"{name}/docs")
        numbers = docs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("doc_len"), F.lit(0)).alias("total"))
        self._write(f"{name}/numbers", numbers)
        held = self._read(f"{name}/numbers").first()
        parts = max(1, -(-held["total"] // PART_TERMS))
        packed = postings.packed(docs, BLOCK_BITS, postings.cuts(docs, BLOCK_BITS, held["total"], parts, SAMPLED))
        dealt = packed.repartitionById(parts, F.col("part")).select("pack")
        self._write(f"{name}/blocks", postings.unpacked(dealt, docs.schema["id"].dataType), **ENCODING, **{"parquet.page.row.count.limit": PAGE_ROWS})
        terms = self._read(f"{name}/blocks").groupBy("term").agg(F.sum("n").alias("df"), F.sum("freq").alias("freq"))
        self._write(f"{name}/terms", terms.repartitionByRange("term").sortWithinPartitions("term"))
        return name, held["n"], ()

    def _write(self, name: str, rows: DataFrame, **options) -> None:
        rows.write.mode("errorifexists").options(compression="zstd", **options).parquet(f"{self.path}/{name}")

    def _read(self, *names: str) -> DataFrame:
        if names not in self.opened:
            self.opened[names] = self.spark.read.parquet(*[f"{self.path}/{n}" for n in names])
        return self.opened[names]

    # --- reading ---------------------------------------------------------------------------------

    def _living(self, rows: DataFrame, gone: Sequence[str]) -> DataFrame:
        """Without the ids that were deleted from the rows' segment."""
        return rows.join(self._read(*[f"{g}/docs" for g in gone]).select("id"), "id", "left_anti") if gone else rows

    def _living_docs(self, segment: tuple[str, int, tuple[str, ...]]) -> DataFrame:
        return self._living(self._read(f"{segment[0]}/docs"), segment[2])

    def blocks(self, *terms: str) -> list[DataFrame]:
        """The blocks of some terms (or all), a table for each segment: a filter that reaches the files."""
        tables = [self._read(f"{name}/blocks") for name, _, _ in self.segments]
        return [b.where(F.col("term").isin(list(terms))) for b in tables] if terms else tables

    def _entries(self, tables: Sequence[DataFrame], positions: bool = False) -> DataFrame:
        """``(term, id, tf, doc_len)`` and the positions, if asked for, of blocks of each segment."""
        out = []
        for blocks, (_, _, gone) in zip(tables, self.segments):
            if positions:
                each = blocks.select("term", F.explode(F.arrays_zip("entries", "positions")).alias("z"))
                each = each.select("term", "z.entries.*", "z.positions")
            else:
                each = blocks.select("term", F.explode("entries").alias("e")).select("term", "e.*")
            out.append(self._living(each, gone))
        return reduce(DataFrame.unionByName, out)

    def postings(self, *terms: str) -> DataFrame:
        """``(term, id, tf, doc_len)`` of all postings or of those of some terms."""
        return self._entries(self.blocks(*terms))

    def documents(self) -> DataFrame:
        """``(id, terms, block)`` of the analyzed documents. As in the postings, rows of one block, id and number of terms
        are one document; ``block`` tells those of different segments apart."""
        out, n = [], len(self.segments)
        for i, (name, _, gone) in enumerate(self.segments):
            block = F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS) * n + i
            out.append(self._living(self._read(f"{name}/docs").select("id", "terms", block.alias("block")), gone))
        return reduce(DataFrame.unionByName, out)

    def positions(self, *terms: str) -> DataFrame:
        """``(term, id, tf, doc_len, positions)``, the places of a term counted from 0."""
        return self._entries(self.blocks(*terms), positions=True)

    def terms(self, *terms: str) -> DataFrame:
        """``(term, df, freq)`` of all terms that a document still holds, or of some."""
        rows = self._read(*[x for name, _, gone in self.segments for x in (f"{name}/terms", *[f"{g}/terms" for g in gone])])
        rows = rows.where(F.col("term").isin(list(terms))) if terms else rows
        if len(self.segments) == 1 and not self.segments[0][2]:
            return rows
        return rows.groupBy("term").agg(F.sum("df").alias("df"), F.sum("freq").alias("freq")).where("df > 0")

    def numbers(self) -> Column:
        """``n`` documents with a term and their ``total`` of terms, as a scalar."""
        rows = self._read(*[x for name, _, gone in self.segments for x in (f"{name}/numbers", *[f"{g}/numbers" for g in gone])])
        return rows.agg(F.struct(F.sum("n").alias("n"), F.sum("total").alias("total"))).scalar()

    def frequencies(self, terms: Sequence[str], phrases: Sequence[Sequence[str]] = (),
                    tables: Sequence[DataFrame] | None = None) -> DataFrame:
        """``(id, doc_len, tf0, tf1, .., pf0, ..)`` of the documents that hold any of the terms.

        ``pf0`` counts where the first phrase stands: the places of its terms, each moved back
        by the term's place in the phrase, are intersected. Its terms have to be among ``terms``.
        Positions are only read if there is a phrase. ``tables`` may have fewer blocks.
        """
        rows = self._entries(self.blocks(*terms) if tables is None else tables, positions=bool(phrases))
        spoken = list(dict.fromkeys(t for p in phrases for t in p))
        is_ = {t: F.col("term") == t for t in terms}
        out = rows.groupBy("id").agg(
            F.max("doc_len").alias("doc_len"), *[F.sum(F.when(is_[t], F.col("tf"))).alias(f"tf{i}") for i, t in enumerate(terms)],
            *[F.any_value(F.when(is_[t], F.col("positions")), F.lit(True)).alias(f"_at{i}") for i, t in enumerate(spoken)])

        def moved(back: int):
            return lambda p: p - back

        def stands(phrase: Sequence[str]) -> Column:
            starts = [F.transform(f"_at{spoken.index(t)}", moved(i)) for i, t in enumerate(phrase)]
            return F.size(reduce(F.array_intersect, starts)) if starts else F.lit(0)

        found = [F.greatest(stands(p), F.lit(0)).cast("long").alias(f"pf{j}") for j, p in enumerate(phrases)]
        return out.select("id", "doc_len", *[f"tf{i}" for i in range(len(terms))], *found)

    def near(self, term: str, edits: int | None = None) -> DataFrame:
        """Terms of the vocabulary within some edits (by length, if not given): each distinct term
        is compared once, however often it occurs."""
        term = term.lower()
        return self.terms().where(A.within_edits(F.col("term"), term, A.auto_fuzziness(term) if edits is None else edits))

    def with_terms(self, terms: DataFrame) -> DataFrame:
        """The ids of the documents that hold any term of a table."""
        tables = [b.join(terms.select("term"), "term", "left_semi") for b in self.blocks()]
        return self._entries(tables).select(F.col("id").alias(self.id)).distinct()

    # --- bounds ----------------------------------------------------------------------------------

    def bounds(self, worth: Mapping[str, object]) -> DataFrame:
        """``(segment, block, bound)``: what no document of a block can score more than.

        ``worth`` has for each term a function of its frequency and the document's length that
        rises with the first and falls with the second. No entries are read.
        """
        out = []
        for i, blocks in enumerate(self.blocks(*worth)):
            value = reduce(lambda c, t: c.when(F.col("term") == t, worth[t](F.col("max_tf"), F.col("min_len"))), worth, F)
            out.append(blocks.select(F.lit(i).alias("segment"), "block", value.alias("bound")))
        each = reduce(DataFrame.unionByName, out)
        return each.groupBy("segment", "block").agg(F.sum("bound").alias("bound"))

    def some_blocks(self, terms: Sequence[str], chosen: Sequence[tuple[int, int]]) -> list[DataFrame]:
        """The rows of ``terms`` in the chosen ``(segment, block)``.

        The filter also names a few ranges that hold the blocks, by which files and pages are left out.
        """
        tables = []
        for i, blocks in enumerate(self.blocks(*terms)):
            mine = sorted(b for s, b in chosen if s == i)
            near = reduce(lambda a, b: a | b, [F.col("block").between(lo, hi) for lo, hi in ranges(mine)], F.lit(False))
            tables.append(blocks.where(near & F.col("block").isin(mine)) if mine else blocks.where(F.lit(False)))
        return tables

    def blocks_of(self, terms: Sequence[str], chosen: DataFrame) -> list[DataFrame]:
        """The rows of ``terms`` in the blocks of a table ``(segment, block)``."""
        return [b.join(chosen.where(F.col("segment") == i).select("block"), "block", "left_semi")
                for i, b in enumerate(self.blocks(*terms))]


def ranges(numbers: Sequence[int], most: int = RANGES) -> list[tuple[int, int]]:
    """At most ``most`` ranges that hold the sorted numbers: the widest gaps are left out."""
    gaps = sorted(range(1, len(numbers)), key=lambda i: numbers[i - 1] - numbers[i])[:most - 1]
    cuts = [0, *sorted(gaps), len(numbers)]
    return [(numbers[a], numbers[b - 1]) for a, b in zip(cuts, cuts[1:]) if a < b]
