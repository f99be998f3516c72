"""A stored index of vectors: inverted lists by the nearest of some centres, packed for matrix products."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..operators.collapse import top_per_key
from ..operators.vectors import _scores
from .manifest import Manifests

#: Rows that the centres are fitted on at most, and the most centres.
SAMPLE, MOST_CELLS = 1 << 14, 4096
#: Vectors in one row of the index, and queries in one row of a search.
CHUNK, QUERIES = 1024, 256
#: Distances of a query from all centres are held for so many queries at a time.
STEP = 4096


def centres_of(sample: np.ndarray, cells: int, seed: int, rounds: int = 15) -> np.ndarray:
    """k-means of the sample: the first centres are drawn far from each other."""
    rng = np.random.default_rng(seed)
    cells = min(cells, len(sample))
    picked = [int(rng.integers(len(sample)))]
    far = ((sample - sample[picked[0]]) ** 2).sum(1)
    while len(picked) < cells and far.sum() > 0:
        picked.append(int(rng.choice(len(sample), p=far / far.sum())))
        far = np.minimum(far, ((sample - sample[picked[-1]]) ** 2).sum(1))
    centres = sample[picked].copy()
    for _ in range(rounds):
        cell = np.concatenate([nearest(sample[a:a + STEP], centres, 1)[:, 0] for a in range(0, len(sample), STEP)])
        counts = np.bincount(cell, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, sample)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def distances(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of every vector from every centre."""
    return np.maximum((vectors ** 2).sum(1)[:, None] + (centres ** 2).sum(1)[None] - 2 * vectors @ centres.T, 0)


def nearest(vectors: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The numbers of the ``n`` nearest centres of every vector, the nearest first."""
    return np.argsort(distances(vectors, centres), axis=1, kind="stable")[:, :n]


def probes_for(sample: np.ndarray, centres: np.ndarray, recall: float, k: int = 10, asked: int = 256) -> int:
    """How many cells a query has to probe so that it finds this share of its ``k`` nearest in the sample.

    Measured with ``asked`` points of the sample, which don't count as their own neighbours.
    """
    if len(sample) < 2 or not len(centres):
        return 1
    queries = np.arange(0, len(sample), max(1, len(sample) // asked))
    away = distances(sample[queries], sample)
    away[np.arange(len(queries)), queries] = np.inf
    near = np.argsort(away, axis=1)[:, :min(k, len(sample) - 1)]
    cell = np.concatenate([nearest(sample[a:a + STEP], centres, 1)[:, 0] for a in range(0, len(sample), STEP)])
    place = np.argsort(nearest(sample[queries], centres, len(centres)), axis=1)
    needed = np.sort(np.take_along_axis(place, cell[near], axis=1).ravel())
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1


def placed(vectors: np.ndarray, metric: str) -> np.ndarray:
    """Where vectors lie among the centres: for the cosine only the direction counts."""
    if metric != "cosine":
        return vectors
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, dims)


def packed(rows: Iterator[tuple[int, list, np.ndarray]], most: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """``(cell, ids, vectors)`` in rows of ``most`` vectors of one cell; the rows come sorted by cell."""
    now, ids, vectors = None, [], []

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([ids], pa.list_(kind)),
                                           pa.array([np.concatenate(vectors).tobytes()], pa.binary())], ["cell", "ids", "vectors"])

    for cell, keys, block in rows:
        while len(keys):
            if cell != now or len(ids) == most:
                if ids:
                    yield row()
                now, ids, vectors = cell, [], []
            n = most - len(ids)
            ids, vectors = ids + keys[:n], [*vectors, block[:n]]
            keys, block = keys[n:], block[n:]
    if ids:
        yield row()


def runs(cells: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``(cell, start, end)`` of the runs of equal numbers."""
    cuts = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield int(cells[a]), a, b


def reach(metric: str, score: float | None) -> float:
    """How far from its query a row with a score lies, in the space of the centres."""
    if score is None:
        return np.inf
    # for the cosine the score is (1 + cos) / 2 and the distance that of unit vectors
    return max(4.0 - 4.0 * score if metric == "cosine" else 1.0 / score - 1.0, 0.0) ** 0.5


@dataclass(frozen=True)
class VectorIndex:
    """``lists`` under ``path`` has a folder for each cell, with rows ``(ids, vectors)`` of up to ``CHUNK``
    vectors; ``cells`` has the centre and the radius of each cell: at most ``MOST_CELLS`` rows, which
    the driver and the tasks hold."""

    spark: SparkSession
    path: str
    id: str
    vector: str
    metric: str
    centres: np.ndarray = field(repr=False, compare=False)
    radii: np.ndarray = field(repr=False, compare=False)
    #: cells that a search probes if nothing is said
    probes: int = 8

    @classmethod
    def build(cls, docs: DataFrame, id: str, vector: str, path: str, *, metric: str = "cosine", cells: int | None = None,
              recall: float = 0.95, seed: int = 17) -> VectorIndex:
        """Every row is put into the cell of its nearest centre.

        The centres are fitted by k-means on ``SAMPLE`` rows at most, those with the least hashes of
        their ids; the number of ``cells`` is the root of the number of rows if nothing is said. The sample also
        tells how many cells a search has to probe for this ``recall`` of the ten nearest. Rows without
        a vector are no neighbours and left out; all vectors have to have one length. A crowded cell is split over
        several files.
        """
        if metric not in ("cosine", "l2_norm"):
            raise ValueError("cells are for the cosine and the euclidean distance")
        spark, path = docs.sparkSession, path.rstrip("/")
        if Manifests(spark, path).latest() is not None:
            raise ValueError(f"index exists: {path}")
        rows = docs.where(F.col(vector).isNotNull()).select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
        facts = rows.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("v")).alias("lo"), F.max(F.size("v")).alias("hi")).first()
        if facts["lo"] != facts["hi"]:
            raise ValueError("vectors of several lengths")
        dims = facts["lo"] or 0
        sample = rows.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(SAMPLE).select("v").toArrow()["v"].combine_chunks()
        points = placed(matrix(sample, dims), metric) if facts["n"] else np.zeros((0, dims))
        wanted = cells or min(MOST_CELLS, max(1, round(facts["n"] ** 0.5)))
        centres = centres_of(points, min(wanted, MOST_CELLS), seed) if len(points) else points
        kind = rows.schema["id"].dataType
        shared = spark.sparkContext.broadcast(centres)  # MOST_CELLS rows at most

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                where = placed(matrix(b["v"], dims), metric)
                for a in range(0, len(where), STEP):
                    part = where[a:a + STEP]
                    cell = nearest(part, shared.value, 1)[:, 0]
                    away = np.sqrt(((part - shared.value[cell]) ** 2).sum(1))
                    yield pa.RecordBatch.from_arrays([b["id"].slice(a, STEP), b["v"].slice(a, STEP), pa.array(cell.astype(np.int32)),
                                                      pa.array(away)], ["id", "v", "cell", "away"])

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def each():
                for b in batches:
                    vectors = matrix(b["v"], dims)
                    for cell, a, z in runs(np.asarray(b["cell"])):
                        yield cell, b["id"][a:z].to_pylist(), vectors[a:z]
            yield from packed(each(), CHUNK, to_arrow_type(kind))

        name = kind.simpleString()
        celled = rows.mapInArrow(assign, f"id {name}, v array<double>, cell int, away double")
        dealt = celled.select("id", "v", "cell").hint("rebalance", "cell").sortWithinPartitions("cell", "id")
        dealt.mapInArrow(pack, f"cell int, ids array<{name}>, vectors binary").write.mode("errorifexists").partitionBy(
            "cell").parquet(f"{path}/lists")
        far = dict(celled.groupBy("cell").agg(F.max("away")).collect())
        radii = np.array([far.get(i, 0.0) for i in range(len(centres))])
        stored = [(i, c.tolist(), float(r)) for i, (c, r) in enumerate(zip(centres, radii))]
        spark.createDataFrame(stored, "cell int, centre array<double>, radius double").coalesce(1).write.parquet(f"{path}/cells")
        Manifests(spark, path).write(1, {"id": id, "vector": vector, "metric": metric, "dims": dims, "kind": name,
                                          "probes": (probes := probes_for(points, centres, recall))})
        return cls(spark, path, id, vector, metric, centres, radii, probes)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> VectorIndex:
        path = path.rstrip("/")
        number = Manifests(spark, path).latest()
        if number is None:
            raise ValueError(f"no such index: {path}")
        said = Manifests(spark, path).read(number)
        rows = sorted(spark.read.parquet(f"{path}/cells").collect())
        centres = np.array([r["centre"] for r in rows]).reshape(len(rows), said["dims"])
        return cls(spark, path, said["id"], said["vector"], said["metric"], centres, np.array([r["radius"] for r in rows]), said["probes"])

    def lists(self, cells: Sequence[int] | None = None) -> DataFrame:
        """``(ids, vectors, cell)``; only the folders of ``cells``, if given, are listed and read."""
        kind = self.kind
        rows = self.spark.read.schema(f"ids array<{kind}>, vectors binary, cell int").parquet(f"{self.path}/lists")
        return rows if cells is None else rows.where(F.col("cell").isin([int(c) for c in cells]))

    @property
    def kind(self) -> str:
        stored = Manifests(self.spark, self.path)
        return stored.read(stored.latest())["kind"]

    def near(self, query: Sequence[float], k: int, *, probes: int | None = None) -> DataFrame:
        """The ``k`` nearest rows to one vector, ``(id, _score)``, among the ``probes`` nearest cells."""
        probes = probes or self.probes
        one = self.spark.createDataFrame([(0, [float(x) for x in query])], f"q int, {self.vector} array<double>")
        cells = nearest(placed(np.array([query], float), self.metric), self.centres, probes)[0] if len(self.centres) else []
        hits = self.search(one, k, query_id="q", probes=probes, _lists=self.lists(cells))
        return hits.select(self.id, "_score").orderBy(F.desc("_score"), F.asc(self.id))

    def search(self, queries: DataFrame, k: int, *, query_id: str, probes: int | None = None, exact: bool = False,
               exclude_self: bool = False, _lists: DataFrame | None = None) -> DataFrame:
        """``(query_id, id, _score, rank)``: the ``k`` nearest rows of every query row.

        A query is compared with the rows of its ``probes`` nearest cells (as many as the build found
        enough, if nothing is said). Queries are packed by
        cell in the tasks that read them and meet the cell's lists in one equi-join of rows of up to
        ``QUERIES`` and ``CHUNK`` vectors: each joined row is a matrix product that sends on
        ``k`` rows a query. A crowded cell is many such rows, which the adaptive skew join deals out.

        With ``exact`` a second pass reads, for each query, all cells whose centre and radius allow
        a row that is nearer than the k-th hit of the first pass: then no neighbour is missed.
        """
        dims, kind, probes = self.centres.shape[1], self.kind, probes or self.probes
        q = queries.where(F.col(self.vector).isNotNull() & (F.size(self.vector) == dims)).select(
            F.col(query_id).alias("q"), F.col(self.vector).cast("array<double>").alias("v"))
        lists = self.lists() if _lists is None else _lists
        if not len(self.centres):
            return self._ranked(q.select(F.col("q").alias("query_id"), F.lit(None).cast(kind).alias(self.id),
                                         F.lit(None).cast("double").alias("_score")).where("false"), k)
        first = self._compared(self._blocks(q, probes), lists, k, exclude_self)
        if not exact:
            return self._ranked(first, k)
        found = self._ranked(first, k)
        # fewer than k hits say nothing yet about the distance
        worst = found.groupBy("query_id").agg(F.min("_score").alias("s"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k)
        asked = q.join(worst.select(F.col("query_id").alias("q"), "s"), "q", "left")
        rest = self._compared(self._blocks(asked, probes, beyond=True), lists, k, exclude_self)
        return self._ranked(found.drop("rank").unionByName(rest), k)

    def _ranked(self, hits: DataFrame, k: int) -> DataFrame:
        return top_per_key(hits, "query_id", (F.desc("_score"), F.asc(self.id)), k, rank="rank")

    def _blocks(self, q: DataFrame, probes: int, beyond: bool = False) -> DataFrame:
        """``(cell, ids, vectors)``: queries packed by the cells they ask, the nearest ``probes`` or those beyond."""
        dims, metric, kind = self.centres.shape[1], self.metric, q.schema["q"].dataType
        shared = self.spark.sparkContext.broadcast((self.centres, self.radii))

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def asked():
                for b in batches:
                    for a in range(0, b.num_rows, STEP):
                        part = b.slice(a, STEP)
                        centres, radii = shared.value
                        vectors = matrix(part["v"], dims)
                        away = distances(placed(vectors, metric), centres)
                        order = np.argsort(away, axis=1, kind="stable")
                        wanted = np.zeros(away.shape, bool)
                        np.put_along_axis(wanted, order[:, :probes], True, axis=1)
                        if beyond:
                            limit = np.array([reach(metric, s) for s in part["s"].to_pylist()])
                            wanted = ~wanted & (np.sqrt(away) - radii <= limit[:, None] + 1e-6)
                        cell, at = np.nonzero(wanted.T)
                        for c, i, z in runs(cell):
                            yield c, part["q"].take(pa.array(at[i:z])).to_pylist(), vectors[at[i:z]]
            yield from packed(asked(), QUERIES, to_arrow_type(kind))

        return q.mapInArrow(each, f"cell int, ids array<{kind.simpleString()}>, vectors binary")

    def _compared(self, blocks: DataFrame, lists: DataFrame, k: int, exclude_self: bool) -> DataFrame:
        dims, metric = self.centres.shape[1], self.metric
        asked = blocks.select("cell", F.col("ids").alias("q"), F.col("vectors").alias("of_q"))
        pairs = asked.join(lists, "cell").select("q", "of_q", "ids", "vectors")
        q_kind, kind = asked.schema["q"].dataType.elementType, lists.schema["ids"].dataType.elementType
        q_type, id_type, id = to_arrow_type(q_kind), to_arrow_type(kind), self.id

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for q, of_q, ids, vectors in zip(*(b[c] for c in ("q", "of_q", "ids", "vectors"))):
                    keys, q_keys = ids.values, q.values
                    rows = np.frombuffer(vectors.as_py(), np.float64).reshape(-1, dims)
                    s = _scores(metric, rows, np.frombuffer(of_q.as_py(), np.float64).reshape(-1, dims)).T
                    s = np.where(np.isnan(s), -np.inf, s)
                    if exclude_self:
                        s[np.asarray(q_keys.to_pylist(), object)[:, None] == np.asarray(keys.to_pylist(), object)[None]] = -np.inf
                    # all that tie with the k-th go on: the id decides later
                    least = np.partition(s, max(s.shape[1] - k, 0), axis=1)[:, max(s.shape[1] - k, 0)][:, None]
                    i, j = np.nonzero((s >= least) & (s > -np.inf))
                    yield pa.RecordBatch.from_arrays([q_keys.take(pa.array(i)), keys.take(pa.array(j)), pa.array(s[i, j])],
                                                     ["query_id", id, "_score"])

        return pairs.mapInArrow(each, f"query_id {q_kind.simpleString()}, {id} {kind.simpleString()}, _score double")
