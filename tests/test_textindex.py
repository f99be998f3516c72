"""The stored text index: best hits by block bounds, phrases by positions, versions by segments."""

import random

import pytest
from pyspark.sql import functions as F

from docspark.operators import scoring
from docspark.plans import criteria as C
from docspark.plans.search import Search
from docspark.schema import DocSchema
from docspark.sources import textindex
from docspark.sources.textindex import TextIndex

WORDS = [f"w{i}" for i in range(60)] + ["it's", "Été", "été"]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def texts_of(n, seed, ids=None):
    r = random.Random(seed)
    weights = [1 / (i + 1) for i in range(len(WORDS))]
    out = []
    for i in ids or range(n):
        k = r.choice([0, 1, 3, 10, 40, 200])
        out.append((i, None if k == 0 and r.random() < 0.5 else " ".join(r.choices(WORDS, weights, k=k)), r.choice(["a", "b"])))
    return out + [(10_000 + j, "w1 w2 w3", "a") for j in range(0 if ids else 90)]  # ties


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(texts_of(1500, 1), "id long, t string, g string").repartition(3).cache()


@pytest.fixture(scope="module")
def index(docs, tmp_path_factory):
    return TextIndex.build(docs, "id", "t", str(tmp_path_factory.mktemp("index") / "ix"))


def search(docs):
    return Search(docs, DocSchema.of(docs, id="id", text=["t"]))


def test_best_hits_are_those_of_all(docs, index):
    r = random.Random(3)
    s = search(docs)
    for k in (1, 7, 95, 4000):
        for _ in range(1 if k > 7 else 2):
            words = r.sample(WORDS[:60] + ["none"], r.randint(1, 4))
            node = C.Bool(should=tuple(C.term("t", w).boost(r.choice([1.0, 0.3, 5.0])) for w in words))
            q = s.query(node).with_scores(index=index).limit(k).fields("id")
            assert [tuple(x) for x in q.best().collect()] == [tuple(x) for x in q.hits().collect()], (words, k)
    q = s.query(C.matches("t", "w1 w2")).with_scores(index=index).page(3, 20).fields("id")
    assert [tuple(x) for x in q.best().collect()] == [tuple(x) for x in q.hits().collect()]


def test_best_hits_beyond_the_listed_blocks(docs, index, monkeypatch):
    monkeypatch.setattr(scoring, "FIRST_BLOCKS", 2)
    monkeypatch.setattr(scoring, "GROWTH", 2)
    monkeypatch.setattr(scoring, "LISTED", 3)
    q = search(docs).query(C.matches("t", "w1 w7 w20")).with_scores(index=index).limit(40).fields("id")
    assert [tuple(x) for x in q.best().collect()] == [tuple(x) for x in q.hits().collect()]


def test_best_hits_read_fewer_blocks(docs, index, monkeypatch):
    monkeypatch.setattr(scoring, "FIRST_BLOCKS", 4)
    monkeypatch.setattr(scoring, "GROWTH", 2)
    read = []
    inner = TextIndex.some_blocks
    try:
        TextIndex.some_blocks = lambda self, terms, chosen: read.extend(chosen) or inner(self, terms, chosen)
        got = scoring.best_hits(index, {"w50": 1.0, "w1": 0.1}, 5).collect()
    finally:
        TextIndex.some_blocks = inner
    n = index.bounds({"w1": lambda tf, n: tf, "w50": lambda tf, n: tf}).count()
    assert len(got) == 5 and len(read) == len(set(read)) < n * 0.8


def test_other_searches_fall_back(docs, index):
    s = search(docs).with_scores(index=index).limit(5).fields("id")
    for node in (C.matches_all("t", "w1 w2"), C.phrase("t", "w1 w2"), C.Bool(should=(C.term("t", "w1"),), must_not=(C.term("t", "w2"),)),
                 C.matches("t", "w1 w1")):
        assert scoring.any_terms(node, s.schema, "t") is None
        assert [tuple(x) for x in s.query(node).best().collect()] == [tuple(x) for x in s.query(node).hits().collect()]
    assert scoring.best_hits(index, {"none": 1.0}, 5).count() == 0


def test_phrases_by_positions(docs, index):
    r = random.Random(5)
    s, schema = search(docs), search(docs).schema
    for _ in range(4):
        phrase = " ".join(r.choices(WORDS[:6], k=r.choice([1, 2, 2, 3])))
        node = C.phrase("t", phrase)
        assert rows(s.using(index).query(node).matches(), "id") == rows(s.query(node).matches(), "id"), phrase
        scan = scoring.with_score(docs, schema, node).select("id", F.round("_score", 9))
        stored = scoring.with_score(docs, schema, node, index=index).select("id", F.round("_score", 9))
        assert rows(stored, "*") == rows(scan, "*"), phrase
    assert rows(s.using(index).query(C.phrase("t", "it s été")).matches(), "id") == rows(s.query(C.phrase("t", "it's Été")).matches(), "id")


def test_conditions_answered_by_the_index(docs, index):
    s = search(docs)
    nodes = [C.starts_with("t", "W5"), C.ends_with("t", "59"), C.contains("t", "5"), C.contains("t", "w5,w"), C.wildcard("t", "w?7"),
             C.regexp("t", "w[12]\\d"), C.fuzzy("t", "w511"), C.in_("t", ["w40 w41", "w50", "w1 w2 w3"]), C.matches_all("t", "w3 w9"),
             C.Bool(must=(C.matches("t", "w30 w31"),), must_not=(C.wildcard("t", "w4*"), C.phrase("t", "w1 w2"))),
             ~C.matches("t", "w1"), C.is_("g", "a") & ~C.starts_with("t", "w1"), C.contains("t", ""), C.phrase("t", "")]
    for node in nodes:
        assert rows(s.using(index).query(node).matches(), "id", "g") == rows(s.query(node).matches(), "id", "g"), node


def test_no_text_is_read(spark, docs, index, tmp_path):
    docs.write.parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    node = C.Bool(should=(C.phrase("t", "w1 w2"), C.wildcard("t", "w4?")), must_not=(C.term("t", "w9"),), min_should=1)
    out = Search(stored, DocSchema.of(stored, id="id", text=["t"])).using(index).query(node).matches().select("id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan and "t:string" not in plan
    # positions are read for phrases only
    assert "positions" not in index.frequencies(["w1"])._jdf.queryExecution().executedPlan().toString()


def test_writes_leave_the_index_of_a_fresh_build(spark, tmp_path):
    r = random.Random(8)
    held = {i: (t, g) for i, t, g in texts_of(0, 2, ids=range(40))}
    frame = lambda d: spark.createDataFrame([(i, t, g) for i, (t, g) in d.items()], "id long, t string, g string")
    index = TextIndex.build(frame(held), "id", "t", str(tmp_path / "ix"))
    old, before = index, rows(index.terms(), "*")
    for step in range(7):
        new = {i: (t, g) for i, t, g in texts_of(0, 100 + step, ids=[r.randrange(60) for _ in range(6)])}
        if step % 3 == 2:
            gone = r.sample(sorted(held), 8)
            index = index.delete(spark.createDataFrame([(i,) for i in [*gone, 999]], "id long"))
            held = {i: d for i, d in held.items() if i not in gone}
        else:
            index = index.upsert(frame(new))
            held |= new
        if step in (3, 6):
            index = index.merge()
    fresh = TextIndex.build(frame(held), "id", "t", str(tmp_path / "fresh"))
    assert rows(index.terms(), "*") == rows(fresh.terms(), "*")
    assert rows(index.positions(), "term", "id", "tf", "doc_len", "positions") == rows(fresh.positions(), "term", "id", "tf", "doc_len", "positions")
    now = frame(held)
    s = search(now).query(C.matches("t", "w1 w5 w30")).limit(12).fields("id")
    expected = [tuple(x) for x in s.with_scores(index=fresh).hits().collect()]
    assert [tuple(x) for x in s.with_scores(index=index).best().collect()] == expected
    assert [tuple(x) for x in s.with_scores(index=index).hits().collect()] == expected
    # whoever holds the first version still reads it, and the last one can be opened by its path
    assert rows(old.terms(), "*") == before
    again = TextIndex.open(spark, str(tmp_path / "ix"))
    assert again.segments == index.segments and rows(again.terms(), "*") == rows(fresh.terms(), "*")
    with pytest.raises(ValueError, match="index exists"):
        TextIndex.build(now, "id", "t", str(tmp_path / "ix"))


def test_merges_are_tiered_and_drop_the_deleted(spark, tmp_path):
    one = lambda i: spark.createDataFrame([(i, f"word{i} same")], "id long, t string")
    index = TextIndex.build(one(0), "id", "t", str(tmp_path / "ix"))
    for i in range(1, 5):
        index = index.add(one(i))
    index = index.delete(one(2)).merge()
    assert sum(n for _, n, _ in index.segments) == 4 and len(index.segments) < 4 and not any(g for _, _, g in index.segments)
    assert rows(index.postings("same"), "id") == [(0,), (1,), (3,), (4,)]
    gone = index.delete(spark.range(10).select("id"))
    assert gone.terms().count() == 0 and gone.postings().count() == 0 and gone.numbers() is not None
    assert scoring.best_hits(gone, {"same": 1.0}, 3).count() == 0
    assert rows(gone.add(one(7)).terms(), "term", "df") == [("same", 1), ("word7", 1)]


def test_a_rare_term_is_in_one_file_and_a_frequent_one_in_many(spark, tmp_path):
    text = F.concat_ws(" ", F.lit("same"), F.concat(F.lit("x"), F.col("id") % 500), F.concat(F.lit("y"), F.col("id") % 300))
    docs = spark.range(40_000, numPartitions=8).select("id", text.alias("t"))
    index = TextIndex.build(docs, "id", "t", str(tmp_path / "ix"))
    blocks = index.blocks()[0].select("term", F.input_file_name().alias("file"))
    files = dict(blocks.groupBy("term").agg(F.countDistinct("file").alias("n")).collect())
    assert sum(files.values()) <= len(files) + 8  # only a term at a cut is in two


def test_ranges_of_blocks():
    assert textindex.ranges([]) == [] and textindex.ranges([5]) == [(5, 5)]
    assert textindex.ranges([1, 2, 3, 50, 51, 90], 2) in ([(1, 3), (50, 90)], [(1, 51), (90, 90)])
    assert textindex.ranges([1, 2, 3, 50, 51, 90], 3) == [(1, 3), (50, 51), (90, 90)]
