"""The stored vector index: recall, exact search, files read, edge inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docspark.operators import vectors
from docspark.sources.vectorindex import VectorIndex, centres_of, packed

SF = "/root/testdata/sf0.1"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/embeddings.parquet")
    return docs, VectorIndex.build(docs, "vec_id", "embedding", str(tmp_path_factory.mktemp("vectors") / "ix"))


def test_recall_of_the_given_vectors(stored):
    docs, index = stored
    asked = docs.where("vec_id % 20 = 0").select(F.col("vec_id").alias("q"), "embedding")
    want = set(rows(vectors.knn_batch(docs, asked, "embedding", 10, id="vec_id", query_id="q"), "query_id", "vec_id"))
    got = set(rows(index.search(asked, 10, query_id="q"), "query_id", "vec_id"))
    recall = len(want & got) / len(want)
    print("recall at 10:", recall)
    assert recall >= 0.9 and len(index.centres) == 45
    # every row is in the index
    assert sorted(r[0] for r in index.lists().select(F.explode("ids")).collect()) == sorted(r[0] for r in rows(docs, "vec_id"))
    assert index.lists().select(F.sum(F.size("ids"))).first()[0] == docs.count()


def test_exact_search_misses_nothing(stored):
    docs, index = stored
    asked = docs.where("vec_id % 50 = 0").select(F.col("vec_id").alias("q"), "embedding")
    for exclude in (False, True):
        want = vectors.knn_batch(docs, asked, "embedding", 7, id="vec_id", query_id="q", exclude_self=exclude)
        got = index.search(asked, 7, query_id="q", probes=2, exact=True, exclude_self=exclude)
        assert rows(got, "query_id", "vec_id", "rank") == rows(want, "query_id", "vec_id", "rank")


def test_one_query_reads_its_cells(stored):
    docs, index = stored
    query = [((i * 37) % 64) / 64.0 - 0.5 for i in range(64)]
    hits = index.near(query, 5, probes=3)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan
    every = index.near(query, 5, probes=len(index.centres))
    assert [tuple(r) for r in every.select("vec_id", F.round("_score", 9)).collect()] == [
        tuple(r) for r in vectors.knn(docs, "embedding", query, 5, id="vec_id").select("vec_id", F.round("_score", 9)).collect()]
    read = index.lists([0, 1]).select(F.input_file_name().alias("f")).distinct().count()
    assert read == 2


def test_euclidean_ties_and_crowded_cells(spark, tmp_path):
    r = np.random.default_rng(1)
    data = [(f"k{i:05d}", r.normal(size=8).round(1).tolist()) for i in range(300)]
    data += [(f"same{i:05d}", [1.0] * 8) for i in range(2500)] + [("null", None), ("zero", [0.0] * 8)]
    docs = spark.createDataFrame(data, "id string, v array<double>").repartition(5)
    index = VectorIndex.build(docs, "id", "v", str(tmp_path / "ix"), metric="l2_norm", cells=12)
    asked = docs.where("id in ('k00001', 'same00007', 'zero', 'null')").select(F.col("id").alias("q"), "v")
    want = rows(vectors.knn_batch(docs, asked, "v", 9, id="id", query_id="q", metric="l2_norm"), "query_id", "id", "rank")
    assert rows(index.search(asked, 9, query_id="q", probes=1, exact=True), "query_id", "id", "rank") == want
    assert rows(VectorIndex.open(spark, str(tmp_path / "ix")).search(asked, 9, query_id="q", exact=True), "query_id", "id", "rank") == want
    assert index.lists().select(F.max(F.size("ids"))).first()[0] <= 1024
    few = index.search(asked, 5000, query_id="q", probes=1, exact=True)
    assert few.count() == 3 * 2801
    empty = VectorIndex.build(docs.limit(0), "id", "v", str(tmp_path / "none"))
    assert empty.search(asked, 3, query_id="q").count() == 0 and empty.near([1.0] * 8, 3).count() == 0
    with pytest.raises(ValueError, match="several lengths"):
        VectorIndex.build(spark.createDataFrame([("a", [1.0]), ("b", [1.0, 2.0])], "id string, v array<double>"), "id", "v", str(tmp_path / "x"))


def test_parts():
    points = np.array([[0.0, 0], [0, 1], [10, 10], [10, 11]])
    assert sorted(map(tuple, centres_of(points, 2, 3))) == [(0.0, 0.5), (10.0, 10.5)]
    assert len(centres_of(np.ones((5, 2)), 4, 3)) == 1
    import pyarrow as pa
    got = list(packed(iter([(1, list("abc"), np.ones((3, 1))), (1, list("d"), np.ones((1, 1))), (2, list("e"), np.ones((1, 1)))]), 2, pa.string()))
    assert [(b["cell"][0].as_py(), b["ids"][0].as_py()) for b in got] == [(1, ["a", "b"]), (1, ["c", "d"]), (2, ["e"])]
