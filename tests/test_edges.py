"""Inputs at the edge that once lost, doubled or changed rows."""

import pytest
from pyspark.sql import functions as F

from docspark.functions import analysis as A
from docspark.functions import convert
from docspark.operators import aggs, byexample, collapse, proximity, scoring, vectors, writes
from docspark.operators import highlight as H
from docspark.plans import criteria as C
from docspark.plans.search import Order, Search
from docspark.schema import DocSchema, FieldSpec
from docspark.sources.collection import Collection
from docspark.sources.tables import Catalog
from docspark.sources.textindex import TextIndex


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- no cap unless asked ------------------------------------------------------------------------


def test_all_buckets_without_a_size(spark):
    df = spark.range(12_000).select(F.col("id").alias("k"), (F.col("id") % 40).alias("o"), F.lit("x").alias("i"))
    assert aggs.terms_agg(df, "k").count() == 12_000 and aggs.terms_agg(df, "o").count() == 40
    assert aggs.geohash_grid(df.select(F.col("k").cast("string").alias("c")), "c").count() == 12_000
    assert aggs.nested_buckets(df, "o", "i").count() == 40
    assert Search(df, DocSchema.of(df, id="k")).unpaged().hits().count() == 12_000
    assert Search(df, DocSchema.of(df, id="k")).unpaged(10_000).hits().count() == 10_000


@pytest.mark.parametrize("width", [3, 300])
@pytest.mark.parametrize("metric", vectors.SIMILARITIES)
def test_vectors_of_other_lengths_are_no_neighbours(spark, width, metric):
    df = spark.createDataFrame([(1, [1.0] * width), (2, [1.0] * (width + 5)), (3, [0.5] * width), (4, [1.0]), (5, None)],
                               "id int, v array<double>")
    one = vectors.knn(df, "v", [1.0] * width, 10, id="id", metric=metric)
    assert {r["id"] for r in one.collect()} == {1, 3}
    batch = vectors.knn_batch(df, df.where("id <> 3"), "v", 10, id="id", query_id="id", metric=metric)
    found = {}
    for r in batch.collect():
        found.setdefault(r["query_id"], set()).add(r["id"])
    assert found == {1: {1, 3}, 2: {2}, 4: {4}}


# --- ranks --------------------------------------------------------------------------------------


def test_running_total_with_an_outlier_and_strings(spark):
    df = spark.range(20_000).select(F.when(F.col("id") == 7, F.lit(10 ** 18)).otherwise(F.col("id")).alias("k"), F.lit(1).alias("c"))
    ranged = df.repartitionByRange(8, "k").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in ranged) <= 2 * 20_000 / 8
    total = aggs.running_total(df, "k", "c", parts=8).agg(F.max("total"), F.countDistinct("total"), F.max_by("total", "k")).first()
    assert tuple(total) == (20_000,) * 3
    named = df.select(F.concat(F.lit("id-"), F.lpad(F.col("k").cast("string"), 20, "0")).alias("k"), "c")
    docs = Search(named, DocSchema.of(named, id="k"))
    sizes = docs.batches(3000).groupBy("_batch").count().orderBy("_batch").collect()
    assert [r["count"] for r in sizes] == [3000] * 6 + [2000]
    grouped = df.select("k", "c", (F.col("k") % 3).alias("g"))
    last = aggs.running_total(grouped, "k", "c", by=["g"], parts=8).groupBy("g").agg(F.max("total"), F.count("c")).collect()
    assert all(r[1] == r[2] for r in last)


def test_percentiles_with_infinity(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),)], "v double")
    assert tuple(aggs.percentiles(df, "v", (0, 50, 100), exact=True).first()) == (1.0, 2.0, float("inf"))


def test_seconds_over_a_century(spark):
    df = spark.createDataFrame([("1990-01-01 00:00:00",), ("1990-01-01 03:00:00",)], "t string").select(F.col("t").cast("timestamp"))
    assert aggs.date_histogram(df, "t", "second").count() == 3 * 3600 + 1
    month = aggs.date_histogram(df.select(F.explode(F.array("t", F.expr("t + interval 2000 years"))).alias("t")), "t", "month")
    assert month.count() == 24_001 and month.agg(F.sum("doc_count")).first()[0] == 4
    # longer than one array of buckets may be
    long = aggs.date_histogram(df.select(F.explode(F.array("t", F.expr("t + interval 110 years"))).alias("t")), "t", "second")
    assert long.where("doc_count > 0").limit(1)._jdf.queryExecution().analyzed() is not None


# --- writes ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def stored(spark):
    return spark.createDataFrame([(1, "a", 5), (2, "b", 5), (3, "c", 5)], "id int, m string, ver int")


def whole(result, incoming):
    """Accepted and rejected together are the incoming rows, and no id is there twice."""
    assert result.result.groupBy("id").count().where("count > 1").count() == 0
    assert result.accepted.count() + result.rejected.count() == incoming.count()


def test_one_sequence_number_lets_one_change_in(spark, stored):
    inc = spark.createDataFrame([(1, "x", 5), (1, "y", 5), (2, "z", 4), (9, "n", 5)], "id int, m string, ver int")
    r = writes.seqno_conflict(stored, inc, "id", "ver")
    whole(r, inc)
    assert r.accepted.count() == 1 and rows(r.rejected, "id") == [(1,), (2,), (9,)]


def test_repeated_ids_in_one_bulk(spark, stored):
    inc = spark.createDataFrame([(8, "x", 1), (8, "y", 2), (1, "z", 3)], "id int, m string, ver int")
    r = writes.bulk_create(stored, inc, "id")
    whole(r, inc)
    assert rows(r.rejected, "id") == [(1,), (8,)]
    for result in (writes.bulk_index(stored, inc, "id"), writes.upsert_doc(stored, inc, "id", ["m", "ver"]),
                   writes.partial_update(stored, inc.withColumn("id", F.lit(1)), "id", ["m"])):
        assert result.result.groupBy("id").count().where("count > 1").count() == 0


def test_copies_that_lose_by_version_are_not_updates(spark, stored):
    source = spark.createDataFrame([(1, "old", 4), (2, "new", 9), (7, "first", 1)], "id int, m string, ver int")
    counts = writes.Reindex(version="ver").counts(source, stored, "id").first().asDict()
    assert counts == {"total": 3, "created": 1, "updated": 1, "version_conflicts": 1}


def test_a_collection_knows_its_layout(spark, stored, tmp_path):
    path = str(tmp_path / "c")
    c = Collection(spark, path, id="id", buckets=4)
    with pytest.raises(ValueError, match="no such collection"):
        c.merge(stored, lambda cur, inc: writes.bulk_index(cur, inc, "id"))
    c.commit(stored)
    again = Collection(spark, path, id="id")
    assert again.buckets == 4
    again.merge(stored.withColumn("m", F.lit("z")), lambda cur, inc: writes.bulk_index(cur, inc, "id"))
    assert rows(again.read(), "id", "m") == [(1, "z"), (2, "z"), (3, "z")] and again.read_route(2).count() == 1
    with pytest.raises(ValueError, match="4 buckets"):
        Collection(spark, path, id="id", buckets=16)


def test_names_that_lead_to_one_collection(spark):
    a = spark.range(4).withColumnRenamed("id", "n")
    catalog = Catalog(spark).put("a", a)
    catalog.add_alias("low", "a", F.col("n") < 1)
    catalog.add_alias("high", "a", F.col("n") > 1)
    catalog.add_alias("both", "a", F.col("n") < 1)
    catalog.add_alias("both", "a", F.col("n") > 2)
    for names, expected in ((["a", "low"], 4), (["low", "high"], 3), (["both"], 2), (["low", "low"], 1), (["*"], 4)):
        assert catalog.resolve(names).count() == expected


# --- ranges and places ----------------------------------------------------------------------------


def test_overlaps_with_open_sides(spark):
    data = [(1, 1, 5), (2, None, 2), (3, 4, None), (4, None, None), (5, 5, 9), (6, 7, 7)]
    df = spark.createDataFrame(data, "id int, lo int, hi int")
    right = df.select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    low, high = (lambda x: float("-inf") if x is None else x), (lambda x: float("inf") if x is None else x)
    for half in (False, True):
        got = proximity.count_overlaps(df, right, left_range=("lo", "hi"), right_range=("a", "b"), left_id="id",
                                       left_open=half, right_open=half)
        under = (lambda x, y: x < y) if half else (lambda x, y: x <= y)
        # the empty half-open range 7 to 7 is not asked
        expected = [(i, sum(under(low(c), high(b)) and under(low(a), high(d)) for _, c, d in data)) for i, a, b in data]
        assert [g for g in rows(got, "id", "overlaps") if not half or g[0] != 6] == [e for e in expected if not half or e[0] != 6]


def test_area_over_the_antimeridian(spark):
    place = lambda i, lat, lon: (i, (lat, lon))
    points = spark.createDataFrame([place(1, 0.0, 179.5), place(2, 0.0, -179.5), place(3, 0.0, 0.0)],
                                   "id int, location struct<lat: double, lon: double>")
    areas = spark.createDataFrame([("x", (5.0, 179.0, -5.0, -179.0))],
                                  "area string, box struct<top: double, left: double, bottom: double, right: double>")
    found = proximity.points_in_areas(points, areas, 1.0, location="location", box="box")
    assert rows(found, "id") == [(1,), (2,)]


# --- conditions -----------------------------------------------------------------------------------


def test_a_keyword_is_not_split(spark):
    df = spark.createDataFrame([(1, "New"), (2, "New York")], "id int, k string")
    got = Search(df, DocSchema.of(df, id="id")).query(C.matches("k", "New York")).matches()
    assert rows(got, "id") == [(2,)]


def test_text_without_a_term_is_empty(spark):
    df = spark.createDataFrame([(1, "---"), (2, "word"), (3, ""), (4, None)], "id int, t string")
    s = Search(df, DocSchema.of(df, id="id", text=["t"]))
    assert rows(s.query(C.empty("t")).matches(), "id") == [(1,), (3,)]
    assert rows(s.query(C.not_empty("t")).matches(), "id") == [(2,)]


def test_several_texts_and_named_clauses_have_scores(spark):
    df = spark.createDataFrame([(1, ["quick fox", "fox"]), (2, ["dog"]), (3, None)], "id int, t array<string>")
    s = Search(df, DocSchema.of(df, id="id", text=["t"]))
    hits = s.query(C.matches("t", "fox dog")).with_scores().hits().collect()
    assert {r["id"] for r in hits} == {1, 2} and all(r["_score"] > 0 for r in hits)
    named = scoring.matched_queries(df, s.schema, {"fox": C.matches("t", "fox"), "all": C.exists("id")})
    scores = {r["id"]: r["matched_queries"] for r in named.collect()}
    assert scores[1]["fox"] not in (0.0, 1.0) and set(scores[2]) == {"all"} and scores[2]["all"] == 1.0


def test_probes_by_pattern_alone(spark):
    docs = spark.createDataFrame([(1, "ab", 1), (2, "ac", 2), (3, "b", 1)], "id int, s string, n int")
    probes = spark.createDataFrame([("p", "a", None), ("q", "a", 1), ("r", None, None)], "probe string, s string, n int")
    got = byexample.match_examples(docs, probes, ["s", "n"], probe_id="probe", matchers={"s": "starting"})
    assert rows(got, "probe", "id") == [("p", 1), ("p", 2), ("q", 1), ("r", 1), ("r", 2), ("r", 3)]
    only = byexample.match_examples(docs, probes.where("probe = 'p'"), ["s", "n"], probe_id="probe", matchers={"s": "starting"})
    assert rows(only, "id") == [(1,), (2,)]
    none = byexample.match_examples(docs, probes.limit(0), ["s", "n"], probe_id="probe", matchers={"s": "starting"})
    assert none.count() == 0


def test_no_inner_hits_have_the_type_of_some(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    none = collapse.collapse_inner_hits(df, "k", [F.asc("v")], 0, ["v"])
    assert none.schema["inner_hits"].dataType == collapse.collapse_inner_hits(df, "k", [F.asc("v")], 1, ["v"]).schema["inner_hits"].dataType
    assert none.first()["inner_hits"] == []


def test_strict_and_unknown_date_formats(spark):
    df = spark.createDataFrame([("2020-02-03T04:05:06",)], "d string")
    got = df.select(convert.parse_date(F.col("d"), "strict_date_hour_minute_second").cast("string")).first()[0]
    assert got.startswith("2020-02-03 04:05:06")
    with pytest.raises(ValueError, match="unknown date format"):
        convert.parse_date(F.col("d"), "basic_week_date")


# --- the stored text index ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def texts(spark):
    data = [(1, "quick quick fox", "en"), (2, "lazy dog", "en"), (3, "", "en"), (4, None, "de"), (5, "the fox, the dog", "de"), (6, "---", "en")]
    return spark.createDataFrame(data, "id int, t string, lang string")


def test_index_scores_like_the_scan(spark, texts, tmp_path):
    index = TextIndex.build(texts, "id", "t", str(tmp_path / "index"))
    schema = DocSchema.of(texts, id="id", text=["t"])
    nodes = [C.matches("t", "fox dog"), C.matches_all("t", "fox dog"), C.matches("t", "unknown"), C.is_("lang", "en") & C.matches("t", "fox"),
             C.Bool(must=(C.term("t", "fox"),), must_not=(C.term("t", "dog"),)), C.matches("t", "fox") | C.is_("lang", "de")]
    for node in nodes:
        for similarity in ("bm25", "classic"):
            scan = scoring.with_score(texts, schema, node, similarity=similarity)
            stored = scoring.with_score(texts, schema, node, similarity=similarity, index=index)
            expected, got = (dict(rows(df, "id", F.round("_score", 9))) for df in (scan, stored))
            assert got == expected
    assert rows(index.terms(), "term", "df", "freq") == [("dog", 2, 2), ("fox", 2, 2), ("lazy", 1, 1), ("quick", 1, 2), ("the", 1, 2)]
    assert rows(index.with_terms(index.near("fix", 1)), "id") == [(1,), (5,)]
    empty = TextIndex.build(texts.limit(0), "id", "t", str(tmp_path / "none"))
    assert scoring.with_score(texts.limit(0), schema, nodes[0], index=empty).count() == 0


def test_an_index_query_reads_no_text(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame([(1, "quick fox", "en")], "id int, t string, lang string").write.parquet(path)
    docs = spark.read.parquet(path)
    index = TextIndex.build(docs, "id", "t", str(tmp_path / "index"))
    s = Search(docs, DocSchema.of(docs, id="id", text=["t"])).query(C.matches("t", "fox")).with_scores(index=index)
    plan = s.matches().select("id", "_score")._jdf.queryExecution().optimizedPlan().toString()
    read = s.matches().select("id", "_score")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:int>" in read and "EqualTo(term,fox)" in read and "regexp" not in plan


def test_term_counts(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), ([],)], "w array<string>")
    got = [[tuple(x) for x in r[0]] for r in df.select(A.term_counts(F.col("w"))).collect()]
    assert got == [[("a", 1, 3), ("b", 2, 3)], []]


@pytest.mark.parametrize("half", [False, True])
@pytest.mark.parametrize("relation", proximity.RELATIONS)
def test_range_pairs_match_brute_force(spark, relation, half):
    left = [(1, 1, 5), (2, None, 2), (3, 4, None), (4, None, None), (5, 5, 9), (6, 60, 80)]
    right = [(1, 2, 3), (2, 5, 6), (3, None, 1), (4, 9, None), (5, 0, 30)]
    a = spark.createDataFrame(left, "l int, lo int, hi int")
    b = spark.createDataFrame(right, "r int, a int, b int")
    low, high = (lambda x: float("-inf") if x is None else x), (lambda x: float("inf") if x is None else x)
    under = (lambda x, y: x < y) if half else (lambda x, y: x <= y)
    holds = {"intersects": lambda p, q, x, y: under(p, y) and under(x, q), "contains": lambda p, q, x, y: p <= x and y <= q,
             "within": lambda p, q, x, y: x <= p and q <= y}[relation]
    expected = sorted((i, j) for i, p, q in left for j, x, y in right if holds(low(p), high(q), low(x), high(y)))
    for width in (0.7, 3, 1000):
        got = proximity.range_pairs(a, b, left_range=("lo", "hi"), right_range=("a", "b"), width=width, relation=relation, half_open=half)
        assert rows(got, "l", "r") == expected


def test_pattern_probes_come_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(byexample, "PROBES", 3)
    docs = spark.createDataFrame([(i, f"{i:03d}") for i in range(60)], "id int, s string")
    probes = spark.createDataFrame([(f"p{i}", f"0{i}") for i in range(8)] + [("all", None), ("p1", "01")], "probe string, s string")
    got = byexample.match_examples(docs, probes, ["s"], probe_id="probe", matchers={"s": "starting"})
    expected = [(i, f"p{i // 10}") for i in range(60)] + [(i, "all") for i in range(60)]
    assert rows(got, "id", "probe") == sorted(expected, key=repr)


def test_a_long_range_lies_in_few_blocks(spark):
    a = spark.createDataFrame([(1, None, None), (2, 0.0, 1e12), (3, 5.0, 5.5)], "l int, lo double, hi double")
    b = spark.createDataFrame([(i, float(i) * 1e9, float(i) * 1e9 + 1) for i in range(50)], "r int, a double, b double")
    got = proximity.range_pairs(a, b, left_range=("lo", "hi"), right_range=("a", "b"), width=1)
    assert rows(got, "l", "r") == sorted([(k, i) for k in (1, 2) for i in range(50)], key=repr)
    contained = proximity.range_pairs(a, b, left_range=("lo", "hi"), right_range=("a", "b"), width=1, relation="contains")
    assert contained.count() == 100


def test_highlight_marks_what_a_clause_means(spark):
    df = spark.createDataFrame([(1, "The quick, brown fox saw a quack and a brown dog")], "id int, t string")
    schema = DocSchema.of(df, id="id", text=["t"])

    def marked(node, schema=schema):
        hit = H.highlight(df, schema, node, [H.HighlightField("t", pre_tag="[", post_tag="]", fragment_size=0)])
        return hit.first()["highlight"].get("t", [None])[0]

    assert marked(C.phrase("t", "quick brown")) == "The [quick, brown] fox saw a quack and a brown dog"
    assert marked(C.starts_with("t", "qu")) == "The [quick], brown fox saw a [quack] and a brown dog"
    assert marked(C.wildcard("t", "qu?ck")) == "The [quick], brown fox saw a [quack] and a brown dog"
    assert marked(C.matches("t", "fox cat")) == "The quick, brown [fox] saw a quack and a brown dog"
    assert marked(C.matches("t", "cat")) is None
    folded = A.synonym_analyzer([["canine", "dog"]])
    synonyms = DocSchema.of(df, id="id", overrides=[FieldSpec("t", "text", analyzer=folded)])
    assert marked(C.matches("t", "canine"), synonyms) == "The quick, brown fox saw a quack and a brown [dog]"


def test_nested_in_nested(spark):
    df = spark.createDataFrame([(1, [("a", [("x", 5), ("y", 1)]), ("b", [("x", 9)])]), (2, [("a", [("y", 3), ("x", 2)])]), (3, [])],
                               "id int, o array<struct<n: string, c: array<struct<k: string, v: int>>>>")
    s = Search(df, DocSchema.of(df, id="id"))
    assert rows(s.query(C.is_("o.c.k", "x")).matches(), "id") == [(1,), (2,)]
    assert rows(s.query(C.gt("o.c.v", 8)).matches(), "id") == [(1,)]
    only_y = Order("o.c.v", levels={"o.c": (lambda e: e["k"] == "y", None)})
    assert [r["id"] for r in s.sort(only_y.desc()).unpaged().hits().collect()][:2] == [2, 1]
    first = Order("o.c.v", levels={"o.c": (None, 1)})
    assert [r["id"] for r in s.sort(first).unpaged().hits().collect()][:2] == [2, 1]
