"""Nearest neighbours by exact comparison, and an approximate index by random planes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .collapse import top_per_key

SIMILARITIES = ("cosine", "dot_product", "l2_norm", "max_inner_product")
# query vectors sent to the tasks at a time (8 MB at 1024 dimensions)
QUERY_BLOCK = 1024


def _pairs(a: Column, b: Column | Sequence[float], combine) -> Column:
    """Sum over the places of two vectors; null if their lengths differ."""
    other = b if isinstance(b, Column) else F.array(*[F.lit(float(x)) for x in b]).cast("array<double>")
    total = F.aggregate(F.zip_with(a, other, lambda x, y: combine(x.cast("double"), y.cast("double"))),
                        F.lit(0.0), lambda s, x: s + x)
    return F.when(F.size(a) == F.size(other), total)


def dot(a: Column, b: Column | Sequence[float]) -> Column:
    """Inner product; null for vectors of different lengths, as in every measure here."""
    return _pairs(a, b, lambda x, y: x * y)


def _tree(parts: list[Column]) -> Column:
    """Balanced sum; a chain of hundreds of additions would nest too deep."""
    while len(parts) > 1:
        parts = [parts[i] + parts[i + 1] if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def squared_distance(a: Column, b: Column | Sequence[float]) -> Column:
    return _pairs(a, b, lambda x, y: (x - y) * (x - y))


def raw_similarity(a: Column, b: Column | Sequence[float], metric: str = "cosine") -> Column:
    """cosine, dot product or euclidean distance as it is."""
    if metric == "cosine":
        if isinstance(b, Column):
            scale = norm(a) * norm(b)
        else:
            scale = norm(a) * float(np.sqrt(np.dot(np.asarray(b, float), np.asarray(b, float))))
        return F.try_divide(dot(a, b), scale)
    if metric == "l2_norm":
        return F.sqrt(squared_distance(a, b))
    if metric in ("dot_product", "max_inner_product"):
        return dot(a, b)
    raise ValueError(f"unknown similarity {metric!r}")


def similarity_score(a: Column, b: Column | Sequence[float], metric: str = "cosine") -> Column:
    """The score of a hit: always positive, higher is nearer."""
    raw = raw_similarity(a, b, metric)
    if metric == "l2_norm":
        return 1.0 / (1.0 + raw * raw)
    if metric == "max_inner_product":
        return F.when(raw < 0, 1.0 / (1.0 - raw)).otherwise(raw + 1.0)
    return (1.0 + raw) / 2.0


def knn(docs: DataFrame, vector: str, query: Sequence[float], k: int, *, id: str,
        metric: str = "cosine", filter: Column | None = None,
        min_similarity: float | None = None) -> DataFrame:
    """The ``k`` nearest rows with ``_score``: one scan, a bounded heap per task."""
    rows = docs if filter is None else docs.where(filter)
    scored = rows.where(F.col(vector).isNotNull()).withColumn(
        "_score", similarity_score(F.col(vector), list(query), metric))
    if min_similarity is not None:
        raw = raw_similarity(F.col(vector), list(query), metric)
        scored = scored.where(raw <= min_similarity if metric == "l2_norm" else raw >= min_similarity)
    return scored.where(F.col("_score").isNotNull()).orderBy(F.desc("_score"), F.asc(id)).limit(k)


def _scores(metric: str, docs: np.ndarray, queries: np.ndarray) -> np.ndarray:
    inner = docs @ queries.T
    if metric == "cosine":
        scale = np.linalg.norm(docs, axis=1)[:, None] * np.linalg.norm(queries, axis=1)[None, :]
        with np.errstate(invalid="ignore", divide="ignore"):
            return (1.0 + inner / scale) / 2.0
    if metric == "l2_norm":
        d2 = ((docs ** 2).sum(1)[:, None] + (queries ** 2).sum(1)[None, :] - 2.0 * inner)
        return 1.0 / (1.0 + np.maximum(d2, 0.0))
    if metric == "max_inner_product":
        return np.where(inner < 0, 1.0 / (1.0 - np.minimum(inner, 0.0)), inner + 1.0)
    return (1.0 + inner) / 2.0


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1)


def _at_least_kth(s: np.ndarray, ids: np.ndarray, k: int):
    """(query, id, score) of one batch: all scores not below the k-th, ties included."""
    s = np.where(np.isnan(s), -np.inf, s)
    n = s.shape[1]
    mask = s > -np.inf
    if n > k:
        mask &= s >= np.partition(s, n - k, axis=1)[:, n - k][:, None]
    rows, cols = np.nonzero(mask)
    return rows, ids[cols], s[rows, cols]


def _best(old, new, k: int):
    """Merge two such triples and keep the first ``k`` of each query by score, then id."""
    if old is not None:
        new = tuple(np.concatenate(pair) for pair in zip(old, new))
    rows, ids, s = new
    order = np.lexsort((ids, -s, rows))
    rows, ids, s = rows[order], ids[order], s[order]
    first = np.concatenate([[0], np.flatnonzero(np.diff(rows)) + 1]) if len(rows) else rows
    start = np.repeat(first, np.diff(np.concatenate([first, [len(rows)]]))) if len(rows) else rows
    keep = np.arange(len(rows)) - start < k
    return rows[keep], ids[keep], s[keep]


def knn_batch(docs: DataFrame, queries: DataFrame, vector: str, k: int, *, id: str,
              query_id: str, metric: str = "cosine", exclude_self: bool = False) -> DataFrame:
    """``(query_id, id, _score, rank)``: the ``k`` nearest rows of every query row.

    Query vectors travel in blocks of at most ``QUERY_BLOCK``; more of them mean more
    passes, not a bigger broadcast. A block is one matrix product per Arrow batch. A
    task keeps ``k`` rows per query and never emits the pairs; the final rank sees ``k``
    rows per query and task.
    """
    spark = docs.sparkSession
    rows = docs.select(id, vector).where(F.col(vector).isNotNull())
    # only vectors of one length compare; others are no neighbours
    q_type, id_type = (to_arrow_type(d.schema[c].dataType) for d, c in ((queries, query_id), (docs, id)))
    schema = f"query_id {queries.schema[query_id].dataType.simpleString()}, " \
             f"{id} {docs.schema[id].dataType.simpleString()}, _score double"
    source = queries.select(F.col(query_id).alias("q"), F.col(vector).alias("v")).where("v IS NOT NULL")
    out = None
    for block in _blocks(source):
        shared = spark.sparkContext.broadcast(block)

        def nearest(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            q_ids, q = shared.value
            q_keys = np.asarray(q_ids)
            best = None
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                fits = pc.equal(pc.list_value_length(batch.column(1)), q.shape[1])
                batch = batch.filter(fits)
                if batch.num_rows == 0:
                    continue
                ids = np.asarray(batch.column(0).to_pylist())
                s = _scores(metric, _matrix(batch.column(1)), q).T
                if exclude_self:
                    s = np.where(q_keys[:, None] == ids[None, :], np.nan, s)
                best = _best(best, _at_least_kth(s, ids, k), k)
            if best is not None and len(best[0]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_keys[best[0]].tolist(), q_type), pa.array(best[1].tolist(), id_type),
                     pa.array(best[2], pa.float64())],
                    names=["query_id", id, "_score"])

        part = rows.mapInArrow(nearest, schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], schema + ", rank int")
    return top_per_key(out, "query_id", (F.desc("_score"), F.asc(id)), k, rank="rank")


def _blocks(source: DataFrame):
    """Query vectors of one length in bounded blocks, read one partition at a time."""
    held: dict[int, tuple[list, list]] = {}
    for row in source.toLocalIterator(prefetchPartitions=True):
        ids, vectors = held.setdefault(len(row["v"]), ([], []))
        ids.append(row["q"])
        vectors.append(row["v"])
        if len(ids) == QUERY_BLOCK:
            yield ids, np.asarray(vectors, dtype=np.float64)
            del held[len(row["v"])]
    for ids, vectors in held.values():
        yield ids, np.asarray(vectors, dtype=np.float64)


def plane_signature(vector: Column, dims: int, bits: int, seed: int = 17) -> Column:
    """Which side of ``bits`` random planes a vector lies on (sign hash for cosine)."""
    planes = np.random.default_rng(seed).standard_normal((bits, dims))
    sides = [F.when(dot(vector, list(p)) >= 0, F.lit(1 << i)).otherwise(F.lit(0))
             for i, p in enumerate(planes)]
    return _tree(sides).cast("int")


def knn_approximate(docs: DataFrame, vector: str, query: Sequence[float], k: int, *, id: str,
                    signature: str, bits: int, radius: int = 1, metric: str = "cosine",
                    seed: int = 17) -> DataFrame:
    """Nearest rows among those whose stored signature differs in at most ``radius`` bits.

    Approximate by definition: with the signature column stored (and the data laid out by
    it) the scan reads only the buckets near the query.
    """
    planes = np.random.default_rng(seed).standard_normal((bits, len(query)))
    mine = int(sum(1 << i for i, p in enumerate(planes) if float(np.dot(p, query)) >= 0))
    near = F.bit_count(F.col(signature).bitwiseXOR(F.lit(mine))) <= radius
    return knn(docs, vector, query, k, id=id, metric=metric, filter=near)


def hybrid(text_hits: DataFrame, vector_hits: DataFrame, id: str, *, text_weight: float = 1.0,
           vector_weight: float = 1.0, size: int = 10) -> DataFrame:
    """Scores of a text query and of a vector search added per row: ``(id, _score)``."""
    both = (text_hits.select(id, (F.col("_score") * float(text_weight)).alias("_score"))
            .unionByName(vector_hits.select(id, (F.col("_score") * float(vector_weight)).alias("_score"))))
    return (both.groupBy(id).agg(F.sum("_score").alias("_score"))
            .orderBy(F.desc("_score"), F.asc(id)).limit(size))
