"""Steps that have to grow no faster than their input: what they send, hold and compare, and that results stay."""

import math
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from docspark.functions import analysis as A
from docspark.operators import proximity, scoring, similar, writes
from docspark.sources import postings, textindex
from docspark.sources.textindex import TextIndex

WORDS = [f"w{i}" for i in range(40)]


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def texts(n, seed):
    r = random.Random(seed)
    out = [(i, " ".join(r.choices(WORDS, [1 / (k + 1) for k in range(40)], k=r.choice([0, 2, 9, 60])))) for i in range(n)]
    return out + [(n, None), (None, "w1 w2 w1"), (n + 1, "Été été")]


def test_points_of_one_file_are_compared_in_many_tasks(spark):
    r = random.Random(1)
    points = [(i, r.uniform(-80, 80), r.uniform(-179, 179)) for i in range(400)]
    boxes = [(i, t, left, t - r.uniform(0, 15), min(180.0, left + r.uniform(0, 25)))
             for i in range(40) for t, left in [(r.uniform(-60, 80), r.uniform(-179, 170))]] + [(40, 10.0, 170.0, -30.0, -150.0)]
    p = spark.createDataFrame(points, "id int, lat double, lon double").coalesce(1).select("id", F.struct("lat", "lon").alias("location"))
    b = spark.createDataFrame(boxes, "box_id int, top double, left double, bottom double, right double").select(
        "box_id", F.struct("top", "left", "bottom", "right").alias("box"))
    found = proximity.points_in_areas(p, b, 10.0, location="location", box="box").select("box_id", "id", F.spark_partition_id().alias("task")).collect()
    inside = [(bid, i) for bid, top, left, bottom, right in boxes for i, lat, lon in points
              if bottom <= lat <= top and (left <= lon <= right if left <= right else lon >= left or lon <= right)]
    assert sorted((x["box_id"], x["id"]) for x in found) == sorted(inside)
    assert len({x["task"] for x in found}) > 1


def test_bulk_create_needs_no_join_and_no_column_that_is_not_asked_for(spark):
    current = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "id int, t string")
    inc = spark.createDataFrame([(1, "x"), (3, "y"), (3, "z"), (None, "u"), (None, "v")], "id int, t string")
    made = writes.bulk_create(current, inc, "id")
    assert "Join" not in optimized(made.accepted) and "Join" not in optimized(made.rejected)
    assert sorted(str(x["id"]) for x in made.accepted.collect()) == ["3", "None"]
    assert sorted(str(x["id"]) for x in made.rejected.collect()) == ["1", "3", "None"]
    assert sorted(x["t"] for x in made.accepted.unionByName(made.rejected.drop("_reason")).collect()) == ["u", "v", "x", "y", "z"]
    assert made.result.count() == 6


@pytest.mark.parametrize("kind", ["long", "string"])
def test_postings_by_definition(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(textindex, "PART_TERMS", 500)
    monkeypatch.setattr(postings, "BATCH", 7)
    data = texts(700, 2)
    docs = spark.createDataFrame(data, "id long, t string").withColumn("id", F.col("id").cast(kind)).repartition(3)
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)  # blocks reach over batches
    try:
        index = TextIndex.build(docs, "id", "t", str(tmp_path / "ix"))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
    wanted = {}
    for i, text in data:
        words = (text or "").lower().split()
        for place, w in enumerate(words):
            wanted.setdefault((w, None if i is None else str(i)), (len(words), []))[1].append(place)
    got = {(x["term"], None if x["id"] is None else str(x["id"])): (x["doc_len"], x["positions"]) for x in index.positions().collect()}
    assert got == wanted
    assert all(x["tf"] == len(x["positions"]) for x in index.positions().collect())
    blocks = index.blocks()[0]
    assert blocks.groupBy("term", "block").count().where("count > 1").count() == 0
    sums = blocks.select("n", "freq", "max_tf", "min_len", F.size("entries").alias("n2"), F.expr("aggregate(entries, 0L, (a, x) -> a + x.tf)").alias("f2"),
                         F.expr("array_max(transform(entries, x -> x.tf))").alias("m2"), F.expr("array_min(transform(entries, x -> x.doc_len))").alias("l2"))
    assert sums.where("n <> n2 OR freq <> f2 OR max_tf <> m2 OR min_len <> l2").count() == 0
    # as many files as the texts take, whatever the number of shuffle partitions is
    assert len(blocks.inputFiles()) > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_documents_are_packed_once_and_dealt_evenly(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(textindex, "PART_TERMS", 2000)
    inner, log = postings.pack, str(tmp_path / "packed")

    def counted(docs, *rest):
        with open(log, "a") as f:
            f.write(f"{docs.num_rows}\n")
        return inner(docs, *rest)

    monkeypatch.setattr(postings, "pack", counted)
    text = F.concat_ws(" ", F.lit("same same"), F.concat(F.lit("x"), F.col("id") % 500), F.concat(F.lit("y"), F.col("id") % 3))
    index = TextIndex.build(spark.range(5000, numPartitions=4).select("id", text.alias("t")), "id", "t", str(tmp_path / "ix"))
    with open(log) as f:
        assert sum(map(int, f)) == 5000
    assert index.terms("same").first()["freq"] == 10_000 and index.postings("x7", "y1").count() == 10 + 1667
    # a word of half of all places takes many files, but for the part of a batch that moves as one row
    files = [r["n"] for r in index.blocks()[0].groupBy(F.input_file_name()).agg(F.sum("freq").alias("n")).collect()]
    assert len(files) > 4 and max(files) <= 6000


@pytest.mark.parametrize("analyzer", [A.STANDARD, A.SIMPLE])
def test_joined_terms_are_those_of_the_array(spark, analyzer):
    odd = ["", None, "  ", "a", " it's  x_y 1²\x00z, É\t", "İstanbul ΑΣ.Σ \U0001d400b ﬀ—ß\n\n7", "...", "٣ ⅷ中文 e\u0301"]
    rows = spark.createDataFrame([(t,) for t in odd], "t string").select(analyzer.column(F.col("t")).alias("a"), analyzer.joined(F.col("t")).alias("terms"))
    for r in rows.select("a", postings.term_array(rows).alias("b"), postings.doc_len(rows).alias("n")).collect():
        assert (r["a"], len(r["a"])) == (r["b"], r["n"]) if r["a"] else not r["n"]


def test_texts_are_analyzed_once_and_kept_as_one_value(spark, tmp_path, monkeypatch):
    plans, inner = [], TextIndex._write
    monkeypatch.setattr(TextIndex, "_write", lambda self, name, rows, **o: plans.append(optimized(rows)) or inner(self, name, rows, **o))
    spark.createDataFrame(texts(50, 5), "id long, t string").write.parquet(str(tmp_path / "docs"))
    index = TextIndex.build(spark.read.parquet(str(tmp_path / "docs")), "id", "t", str(tmp_path / "ix"))
    assert plans[0].count("lower(") == 1
    assert spark.read.parquet(f"{index.path}/{index.segments[0][0]}/docs").schema["terms"].dataType.simpleString() == "string"
    # postings are kept as differences
    file = pq.ParquetFile(index.blocks()[0].inputFiles()[0].removeprefix("file://"))
    kept = {c.path_in_schema: c.encodings for c in (file.metadata.row_group(0).column(i) for i in range(file.metadata.num_columns))}
    assert all("DELTA_BINARY_PACKED" in e for c, e in kept.items() if c.startswith(("entries", "positions"))) and "RLE_DICTIONARY" in kept["term"]
    # an analyzer whose terms may have spaces
    whole = TextIndex.build(spark.read.parquet(str(tmp_path / "docs")), "id", "t", str(tmp_path / "whole"), A.KEYWORD)
    assert whole.terms("w1 w2 w1").first()["freq"] == 1


@pytest.mark.parametrize("ids", [[7, 8, 9, 9, None], ["a", "b", "c", "c", None]])
def test_places_move_as_bytes(ids):
    terms = [["x", "y", "x"], ["é"], ["y", "x"], ["x", "y"], ["x"] * 5]
    for kept in (terms, [" ".join(t) for t in terms]):
        docs = pa.table({"block": pa.array([0, 0, 1, 1, 3]), "id": ids, "doc_len": pa.array([len(t) for t in terms]), "terms": kept})
        moved = postings.pack(docs)
        assert pa.types.is_binary(moved["rest"].type)
        rows = [r for b in moved.to_batches(2) for r in postings.unpack(b).to_pylist()]
        got = {(r["term"], r["block"]): [(e["id"], e["tf"], e["doc_len"], p) for e, p in zip(r["entries"], r["positions"])] for r in rows}
        assert got == {("x", 0): [(ids[0], 2, 3, [0, 2])], ("y", 0): [(ids[0], 1, 3, [1])], ("é", 0): [(ids[1], 1, 1, [0])],
                       ("y", 1): [(ids[2], 2, 2, [0, 1])], ("x", 1): [(ids[2], 2, 2, [0, 1])], ("x", 3): [(ids[4], 5, 5, [0, 1, 2, 3, 4])]}


def test_documents_of_a_pack_are_bounded_by_terms():
    docs = pa.table({"block": np.repeat(np.arange(50), 4), "doc_len": np.arange(200)})
    parts = list(postings.groups(docs, 1000))
    assert pa.concat_tables(parts).equals(docs) and len(parts) > 15
    assert all(sum(p["doc_len"].to_pylist()) <= 1000 + 4 * 199 for p in parts)
    blocks = [set(p["block"].to_pylist()) for p in parts]
    assert not any(a & b for a, b in zip(blocks, blocks[1:])) and list(postings.groups(docs.slice(0, 0), 10)) == []


def test_ranges_of_terms_and_blocks():
    cut = [("b", 3), ("b", 9), ("c", 0), ("é", 1)]
    terms, blocks = ["a", "b", "b", "b", "b", "bb", "c", "z", "é", "é"], np.array([7, 2, 3, 8, 9, 0, 0, 5, 0, 1])
    assert postings.range_of(terms, blocks, cut).tolist() == [0, 0, 1, 1, 2, 2, 3, 3, 3, 4]
    assert postings.range_of(terms, blocks, []).tolist() == [0] * 10


@pytest.mark.parametrize("indexed", [True, False])
def test_similar_documents_in_shards(spark, tmp_path, monkeypatch, indexed):
    monkeypatch.setattr(similar, "SHARD", 60)
    monkeypatch.setattr(similar, "GROUP", 10)
    data = [x for x in texts(400, 3) if x[0] is not None] + [(1000 + i, "w3 w4 w3 w9 w9") for i in range(30)]  # ties
    docs = spark.createDataFrame(data, "id long, t string")
    sources = docs.where("id % 9 = 0 OR id = 1003").select("id")
    index = TextIndex.build(docs, "id", "t", str(tmp_path / "ix")) if indexed else None
    found = scoring.more_like_this(docs, sources, "id", "t", max_doc_share=0.6, size=4, index=index)
    assert "FlatMapCoGroupsInArrow" in optimized(found)
    words = {i: t.lower().split() for i, t in data if t and t.split()}
    n, avg = len(words), sum(map(len, words.values())) / len(words)
    df = {w: sum(w in x for x in words.values()) for w in {w for x in words.values() for w in x}}
    idf = {w: math.log(1 + (n - d + 0.5) / (d + 0.5)) for w, d in df.items()}
    wanted = []
    for s in sorted(i for i in words if i % 9 == 0 or i == 1003):
        own = {w for w in words[s] if words[s].count(w) >= 2 and 5 <= df[w] <= n * 0.6}
        terms = sorted(own, key=lambda w: (-words[s].count(w) * idf[w], w))[:25]
        hits = []
        for i, held in words.items():
            shared = [w for w in terms if w in held]
            if i != s and shared and len(shared) >= max(1, math.floor(len(terms) * 0.3)):
                score = sum(idf[w] * (tf := held.count(w)) / (tf + 1.2 * (0.25 + 0.75 * len(held) / avg)) for w in shared)
                hits.append((-round(score, 9), i))
        wanted += [(s, i, r + 1, round(-x, 6)) for r, (x, i) in enumerate(sorted(hits)[:4])]
    got = sorted((x["source_id"], x["id"], x["rank"], round(x["_score"], 6)) for x in found.collect())
    assert [x[:3] for x in got] == [x[:3] for x in sorted(wanted, key=lambda x: (x[0], x[1]))]
    assert all(abs(a[3] - b[3]) < 2e-6 for a, b in zip(got, sorted(wanted, key=lambda x: (x[0], x[1]))))


@pytest.mark.parametrize("segments", [1, 2])
def test_similar_documents_move_in_packs_and_repeated_ids_count_as_in_the_postings(spark, tmp_path, monkeypatch, segments):
    monkeypatch.setattr(similar, "SHARD", 90)
    monkeypatch.setattr(similar, "DENSE", 3)
    data = [x for x in texts(300, 5) if x[0] is not None]
    docs = spark.createDataFrame(data + data[::4] + [(i, "w1 w5 w5 w7") for i in range(0, 300, 11)], "id long, t string")
    index = TextIndex.build(docs, "id", "t", str(tmp_path / "ix"))
    if segments == 2:
        index = index.add(docs.where("id % 3 = 1")).delete(spark.createDataFrame([(i,) for i in range(5, 300, 17)], "id long"))
    sources = docs.where("id % 10 = 0").select("id")
    found = scoring.more_like_this(docs, sources, "id", "t", max_doc_share=0.7, size=5, index=index)
    assert "entries" not in optimized(found)  # no postings are shuffled
    post = [tuple(x) for x in index.postings().select("id", "term", "tf", "doc_len").collect()]
    n, total = index._read(index.segments[0][0] + "/numbers").select(index.numbers()["n"], index.numbers()["total"]).first()
    df = {x["term"]: x["df"] for x in index.terms().collect()}
    idf = {w: math.log(1 + (n - d + 0.5) / (d + 0.5)) for w, d in df.items()}
    asked, of = {}, {}
    for i, w, tf, length in post:
        of.setdefault(w, []).append((i, tf / (tf + 1.2 * (0.25 + 0.75 * length / (total / n)))))
        if i is not None and i % 10 == 0 and tf >= 2 and 5 <= df[w] <= n * 0.7:
            asked.setdefault(i, []).append((-tf * idf[w], w))
    wanted = []
    for s, own in asked.items():
        own, hits = [w for _, w in sorted(own)[:25]], {}
        for w in own:
            for i, x in of[w]:
                if i != s:
                    hits.setdefault(i, []).append(idf[w] * x)
        enough = [(-round(math.fsum(x), 9), i) for i, x in hits.items() if len(x) >= max(1, math.floor(len(own) * 0.3))]
        wanted += [(s, i, r + 1) for r, (_, i) in enumerate(sorted(enough)[:5])]
    assert len(wanted) > 50 and sorted((x["source_id"], x["id"], x["rank"]) for x in found.collect()) == sorted(wanted)


@pytest.mark.parametrize("kind", [pa.string(), pa.list_(pa.string())])
def test_packs_of_documents_hold_every_term_in_a_few_bytes(kind):
    r = random.Random(8)
    words = [[f"w{int(r.expovariate(0.01))}" for _ in range(r.choice([0, 1, 30, 300]))] for _ in range(500)] + [["a"] * 300]
    docs = pa.table({"part": pa.array([r.randrange(3) for _ in words], pa.int32()), "id": pa.array(range(len(words)), pa.int64()),
                     "block": pa.array(range(len(words)), pa.int64()),
                     "terms": pa.array([" ".join(w) if pa.types.is_string(kind) else w for w in words], kind)})
    docs = pa.concat_tables([docs, pa.table({"part": [0], "id": [-1], "block": [-1], "terms": [None]}, docs.schema)])
    packs = list(similar.docs_packs(docs))
    got = {}
    for part, pack in packs:
        held = similar.opened(pa.scalar(pack))
        at = np.cumsum(held["step"].to_numpy(), dtype=int)
        which = np.repeat(np.arange(len(held["id"])), held["distinct"].to_numpy())
        for d, a, tf in zip(which, at, held["tf"].to_pylist()):
            got.setdefault((part, held["id"][d].as_py()), {})[held["terms"][a].as_py()] = tf
        assert held["length"].to_pylist() == [len(words[i]) for i in held["id"].to_pylist()]
    parts = docs["part"].to_pylist()
    assert got == {(parts[i], i): {w: x.count(w) for w in x} for i, x in enumerate(words) if x}
    assert sum(len(p) for _, p in packs) < 4 * sum(len(x) for x in got.values())


def test_places_of_a_range_move_as_one_compressed_value(spark, tmp_path, monkeypatch):
    r, moved, inner = random.Random(6), [], postings.unpacked
    data = [(i, " ".join(r.choices(WORDS, [1 / (k + 1) for k in range(40)], k=200))) for i in range(2000)]
    monkeypatch.setattr(textindex, "PART_TERMS", 100_000)
    monkeypatch.setattr(postings, "unpacked", lambda rows, *rest: moved.append(rows) or inner(rows, *rest))
    index = TextIndex.build(spark.createDataFrame(data, "id long, t string").coalesce(2), "id", "t", str(tmp_path / "ix"))
    # of two tasks, the last block of each apart, for four ranges
    packs = moved[0].select(F.length("pack").alias("n")).collect()
    assert len(packs) <= 2 * 2 * 4 and sum(x["n"] for x in packs) < 2.5 * 200 * 2000
    # files are in order and their postings whole
    assert index.terms().agg(F.sum("freq")).first()[0] == 200 * 2000
    for file in index.blocks()[0].inputFiles():
        table = pq.read_table(file.removeprefix("file://"), columns=["term", "block"])
        keys = list(zip(table["term"].to_pylist(), table["block"].to_pylist()))
        assert keys == sorted(keys)
    docs = index._read(index.segments[0][0] + "/docs").inputFiles()[0].removeprefix("file://")
    assert pq.ParquetFile(docs).metadata.row_group(0).column(0).compression == "ZSTD"
