"""Operators on small tables, properties, and plans."""

import datetime as dt
import random


import pytest
from pyspark.sql import functions as F

from docspark.functions import convert
from docspark.functions import geo
from docspark.operators import aggs, highlight, proximity, scoring, suggest, vectors, writes
from docspark.operators.collapse import collapse_inner_hits, top_per_key
from docspark.plans import criteria as C
from docspark.plans.search import Search
from docspark.schema import DocSchema
from docspark.sources import sql as S
from docspark.sources import tables
from docspark.sources.collection import Collection
from docspark.streaming import streams


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


# --- writes -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def stored(spark):
    return spark.createDataFrame([(1, "a", 5), (2, "b", 5), (3, "c", 5)], "id int, m string, ver int")


def test_bulk_last_write_wins(spark, stored):
    inc = spark.createDataFrame([(2, "x", 1, 1), (2, "y", 1, 2), (9, "n", 1, 3)], "id int, m string, ver int, seq int")
    r = writes.bulk_index(stored, inc, "id", "seq")
    assert rows(r.result, "id", "m") == [(1, "a"), (2, "y"), (3, "c"), (9, "n")]
    r = writes.bulk_create(stored, inc, "id", "seq")
    assert rows(r.result, "id", "m") == [(1, "a"), (2, "b"), (3, "c"), (9, "n")]
    assert rows(r.rejected, "id", "_reason") == [(2, "document already exists")] * 2


def test_versions(spark, stored):
    inc = spark.createDataFrame([(1, "old", 4, 1), (2, "same", 5, 2), (3, "new", 6, 3), (4, "first", 1, 4), (3, "again", 6, 5)],
                                "id int, m string, ver int, seq int")
    r = writes.version_upsert(stored, inc, "id", "ver", order="seq")
    assert rows(r.result, "id", "m") == [(1, "a"), (2, "b"), (3, "new"), (4, "first")]
    # the second write of 3 loses against the first one of its batch
    assert rows(r.rejected, "id", "m") == [(1, "old"), (2, "same"), (3, "again")]
    r = writes.version_upsert(stored, inc, "id", "ver", order="seq", or_equal=True)
    assert rows(r.result, "id", "m") == [(1, "a"), (2, "same"), (3, "again"), (4, "first")]
    with pytest.raises(ValueError):
        writes.seqno_conflict(stored, inc, "id", "seq", version="ver")


def test_patches(spark, stored):
    patch = spark.createDataFrame([(1, "p", None, 1), (1, None, 7, 2), (8, "q", 1, 3)], "id int, m string, ver int, seq int")
    r = writes.partial_update(stored, patch, "id", ["m", "ver"], order="seq")
    assert rows(r.result) == [(1, "p", 7), (2, "b", 5), (3, "c", 5)]
    assert rows(r.rejected, "id") == [(8,)]
    assert rows(writes.upsert_doc(stored, patch, "id", ["m", "ver"], order="seq").result)[-1] == (8, "q", 1)


def test_delete_and_keep_make_up_all(stored):
    r = writes.delete_by_query(stored, F.col("id") > 1)
    assert rows(r.result.unionByName(r.accepted)) == rows(stored)


def test_slices_are_disjoint_and_cover(spark):
    df = spark.range(1000)
    parts = [df.where(writes.in_slice(F.col("id"), i, 7)) for i in range(7)]
    assert sum(p.count() for p in parts) == 1000
    assert df.where(sum((writes.in_slice(F.col("id"), i, 7).cast("int") for i in range(7)), F.lit(0)) != 1).count() == 0


def test_collection(spark, tmp_path, stored):
    c = Collection(spark, str(tmp_path / "c"), id="id", buckets=4)
    assert not c.exists()
    c.create(stored.schema)
    with pytest.raises(ValueError):
        c.create(stored.schema)
    assert c.read().count() == 0
    c.merge(stored, lambda cur, inc: writes.bulk_index(cur, inc, "id"))
    pinned = c.open_point_in_time()
    change = spark.createDataFrame([(2, "changed", 6)], stored.schema)
    c.merge(change, lambda cur, inc: writes.bulk_index(cur, inc, "id"), batch=3)
    again = spark.createDataFrame([(2, "repeated", 7)], stored.schema)
    c.merge(again, lambda cur, inc: writes.bulk_index(cur, inc, "id"), batch=3)
    assert rows(c.read(), "id", "m") == [(1, "a"), (2, "changed"), (3, "c")]
    assert rows(c.read(pinned), "id", "m") == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(c.read_route(2), "m") == [("changed",)]
    c.merge(stored.where("id = 3"), lambda cur, inc: writes.delete_by_ids(cur, inc, "id"))
    assert rows(c.read(), "id") == [(1,), (2,)]
    c.delete()
    assert not c.exists()
    c.create(stored.schema)
    assert c.read().count() == 0


def test_unfinished_write_is_not_seen(spark, tmp_path, stored):
    c = Collection(spark, str(tmp_path / "c"), id="id", buckets=2)
    c.commit(stored)
    # files of a job that died before its manifest
    stored.withColumn("_bucket", F.lit(0)).write.partitionBy("_bucket").parquet(f"{c.path}/v=00000002")
    assert c.read().count() == 3
    c.commit(stored.limit(1))
    assert c.read().count() == 1


def test_hooks_and_audit(spark, stored):
    hooks = writes.RowHooks().add("before_save", lambda d: d.where("id > 1"))
    assert hooks.run("before_save", stored).count() == 2
    with pytest.raises(ValueError):
        hooks.add("sometime", lambda d: d)


# --- search pieces -----------------------------------------------------------------------------------


def test_missing_names(spark, stored):
    cat = tables.Catalog(spark).put("one", stored).put("two", stored)
    with pytest.raises(tables.MissingIndex):
        cat.resolve(["one", "three"])
    assert cat.resolve(["one", "three"], ignore_unavailable=True).count() == 3
    assert cat.resolve(["x*"]).count() == 0
    with pytest.raises(tables.MissingIndex):
        cat.resolve(["x*"], allow_no_indices=False)
    assert cat.resolve(["*"]).count() == 6
    cat.add_alias("big", "one", F.col("id") > 1)
    assert cat.resolve(["big"]).count() == 2
    cat.remove_alias("big")
    with pytest.raises(tables.MissingIndex):
        cat.resolve(["big"])


def test_collapse_inner_hits(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 9)], "k string, v int")
    c = collapse_inner_hits(df, "k", (F.desc("v"),), 2, ["v"])
    assert {r["k"]: [h["v"] for h in r["inner_hits"]] for r in c.collect()} == {"a": [3, 2], "b": [9]}
    assert {len(r["inner_hits"]) for r in collapse_inner_hits(df, "k", (F.desc("v"),), 0, ["v"]).collect()} == {0}


def test_rescore_keeps_the_rest_below(spark):
    df = spark.createDataFrame([(i, "x " * i + ("y" if i == 3 else "z")) for i in range(1, 9)], "id int, text string")
    schema = DocSchema.of(df, text=["text"], id="id")
    hits = Search(df, schema).query(C.term("text", "x")).with_scores().matches()
    first = [r["id"] for r in hits.orderBy(F.desc("_score"), "id").limit(3).collect()]
    out = scoring.rescore(hits, schema, C.term("text", "y"), tie_break="id", window=3)
    ranked = out.orderBy("_rescored", F.desc("_score"), "id").collect()
    assert {r["id"] for r in ranked[:3]} == set(first) and len(ranked) == 8


def test_highlight_fragments(spark):
    df = spark.createDataFrame([(1, "Some Text, other text and contexts; at last TEXT.")], "id int, t string")
    schema = DocSchema.of(df, text=["t"])
    node = C.matches("t", "text")
    whole = highlight.highlight(df, schema, node, [highlight.HighlightField("t", fragment_size=0)]).first()["highlight"]
    assert whole == {"t": ["Some <em>Text</em>, other <em>text</em> and contexts; at last <em>TEXT</em>."]}
    parts = highlight.highlight(df, schema, node, [highlight.HighlightField(
        "t", "[", "]", fragment_size=12, number_of_fragments=1, order="score", rename="title")]).first()["highlight"]
    assert list(parts) == ["title"] and len(parts["title"]) == 1 and "[" in parts["title"][0]
    none = highlight.highlight(df, schema, C.matches("t", "absent"), [highlight.HighlightField("t", no_match_size=4)])
    assert none.first()["highlight"] == {"t": ["Some"]}


def test_function_score_modes(spark):
    one = spark.range(1)
    def value(**kw):
        f = scoring.function_score(F.lit(2.0), [(None, F.lit(3.0)), (F.lit(False), F.lit(9.0)), (None, F.lit(4.0))], **kw)
        return one.select(f.alias("v")).first()["v"]
    assert value() == 24.0
    assert value(score_mode="sum", boost_mode="replace", max_boost=6) == 6.0
    assert value(score_mode="avg", boost_mode="sum") == 5.5
    assert value(score_mode="first", boost_mode="max") == 3.0
    decay = one.select(scoring.gauss_decay(F.lit(10.0), 0, 10).alias("g"), scoring.exp_decay(F.lit(10.0), 0, 10).alias("e"),
                       scoring.linear_decay(F.lit(10.0), 0, 10).alias("l")).first()
    assert all(abs(x - 0.5) < 1e-12 for x in decay)


def test_knn_from_axis_to_axis(spark):
    # ten directions from the x- to the y-axis: the last one is nearest to y
    df = spark.createDataFrame([(i, [1.0 - i / 9, i / 9]) for i in range(10)], "id int, v array<float>")
    best = vectors.knn(df, "v", [0.0, 1.0], 3, id="id").collect()
    assert [r["id"] for r in best] == [9, 8, 7]
    q = spark.createDataFrame([("y", [0.0, 1.0]), ("x", [1.0, 0.0])], "q string, v array<float>")
    batch = vectors.knn_batch(df, q, "v", 3, id="id", query_id="q").collect()
    assert {r["query_id"]: [x["id"] for x in sorted(batch, key=lambda b: b["rank"]) if x["query_id"] == r["query_id"]]
            for r in batch} == {"y": [9, 8, 7], "x": [0, 1, 2]}


@pytest.mark.parametrize("metric", vectors.SIMILARITIES)
def test_knn_batch_equals_single(spark, metric):
    rng = random.Random(3)
    data = [(i, [rng.choice([-1.0, 0.5, 1.0]) for _ in range(5)]) for i in range(200)]
    df = spark.createDataFrame(data, "id long, v array<double>").repartition(5)
    q = spark.createDataFrame(data[:4], "id long, v array<double>")
    batch = {}
    for r in vectors.knn_batch(df, q, "v", 7, id="id", query_id="id", metric=metric).collect():
        batch.setdefault(r["query_id"], []).append((r["rank"], round(r["_score"], 9)))
    for i, v in data[:4]:
        single = [round(r["_score"], 9) for r in vectors.knn(df, "v", v, 7, id="id", metric=metric).collect()]
        assert [s for _, s in sorted(batch[i])] == single


def test_query_vectors_beyond_one_block(spark, monkeypatch):
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 3)
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(10)], "id int, v array<double>")
    out = vectors.knn_batch(df, df, "v", 1, id="id", query_id="id", metric="l2_norm").collect()
    assert sorted((r["query_id"], r["id"]) for r in out) == [(i, i) for i in range(10)]


def test_approximate_knn_finds_a_subset(spark):
    rng = random.Random(5)
    data = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    df = spark.createDataFrame(data, "id int, v array<double>")
    df = df.withColumn("sig", vectors.plane_signature(F.col("v"), 8, 6))
    hits = vectors.knn_approximate(df, "v", data[7][1], 5, id="id", signature="sig", bits=6, radius=2)
    assert hits.first()["id"] == 7
    everything = vectors.knn_approximate(df, "v", data[7][1], 5, id="id", signature="sig", bits=6, radius=6)
    assert rows(everything, "id") == rows(vectors.knn(df, "v", data[7][1], 5, id="id"), "id")


def test_suggest(spark):
    df = spark.createDataFrame([(1, "the quick brown fox"), (2, "the quick brown dog"), (3, "a quirk")], "id int, t string")
    s = suggest.suggest_term(df, "id", "t", "quikc brwn", size=2)
    assert rows(s, "token", "term") == [("brwn", "brown"), ("quikc", "quick"), ("quikc", "quirk")]
    p = suggest.suggest_phrase(df, "id", "t", "quikc brwn", size=1)
    assert p.first()["phrase"] == "quick brown"
    inputs = suggest.completion_rows(df, "id", F.array("t"), F.col("id"))
    assert [r["id"] for r in suggest.suggest_completion(inputs, "The q", "id").collect()] == [2, 1]
    asked = spark.createDataFrame([("the",), ("",), ("the quick brown d",), ("x",)], "p string")
    batch = suggest.suggest_completion_batch(inputs, asked, "p", "id", size=2)
    assert rows(batch, "prefix", "id") == [
        ("", 2), ("", 3), ("the", 1), ("the", 2), ("the quick brown d", 2)]
    assert suggest.suggest_completion(inputs, "teh", "id", fuzzy_edits=2).count() >= 2


# --- aggregations ----------------------------------------------------------------------------------------


def test_stats_over_buckets(spark):
    df = spark.createDataFrame([("foo",), ("bar",), ("foo",), ("foo",), ("baz",), ("bar",)], "keyword string")
    buckets = aggs.terms_agg(df, "keyword")
    assert [tuple(r) for r in buckets.collect()] == [("foo", 3), ("bar", 2), ("baz", 1)]
    assert aggs.stats_bucket(buckets).first() == (3, 1, 3, 2.0, 6)


def test_running_total_and_percentiles_match_brute_force(spark):
    rng = random.Random(1)
    values = [rng.choice([1.5, 2.5, rng.random() * 1000, 1e9]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
    one = df.groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    got = rows(aggs.running_total(one, "v", "c"), "v", "total")
    assert got == [(v, sum(x <= v for x in values)) for v in sorted(set(values))]
    assert rows(aggs.running_total(one, "v", "c", parts=10), "v", "total") == got
    p = aggs.percentiles(df, "v", (0, 10, 50, 99.9, 100), exact=True).first()
    ordered = sorted(values)
    for point, x in zip((0, 10, 50, 99.9, 100), p):
        at = (len(values) - 1) * point / 100
        low, high = ordered[int(at)], ordered[min(int(at) + 1, len(values) - 1)]
        assert abs(x - (low + (high - low) * (at - int(at)))) < 1e-6 * max(1, abs(x))
    groups = df.withColumn("g", F.when(F.col("v") > 2, "big"))
    assert {r["g"] for r in aggs.percentiles(groups, "v", (50,), exact=True, by=["g"]).collect()} == {None, "big"}
    empty = aggs.percentiles(df.where("v < 0"), "v", (50,), exact=True)
    assert [r["p50"] for r in empty.collect()] in ([None], [])


def test_histogram_fills_gaps(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (31.0,), (None,)], "v double")
    assert rows(aggs.histogram(df, "v", 10)) == [(0.0, 2), (10.0, 0), (20.0, 0), (30.0, 1)]
    far = spark.createDataFrame([(0.0,), (25_000.0,)], "v double")
    assert aggs.histogram(far, "v", 1).agg(F.count("*"), F.countDistinct("key"), F.sum("doc_count")).first() == (25_001, 25_001, 2)
    d = spark.createDataFrame([(dt.datetime(2020, 1, 5),), (dt.datetime(2020, 3, 1),)], "t timestamp")
    assert [r["doc_count"] for r in aggs.date_histogram(d, "t", "month").orderBy("key").collect()] == [1, 0, 1]


def test_hot_place_is_counted_not_paired(spark):
    # a third of the points in one place, checked by brute force
    rng = random.Random(2)
    pts = [(i, 10.0, 20.0) if i % 3 == 0 else (i, rng.uniform(-60, 75), rng.uniform(-179, 179)) for i in range(600)]
    sites = [(100, 10.1, 20.1), (101, 74.0, 0.0), (102, -55.0, 100.0)]
    loc = lambda d, n: d.select(d.columns[0], geo.make_point(F.col("lat"), F.col("lon")).alias(n))
    p = loc(spark.createDataFrame(pts, "id int, lat double, lon double"), "p")
    s = loc(spark.createDataFrame(sites, "sid int, lat double, lon double"), "s")
    got = dict(rows(proximity.count_near(p, s, 1_500_000.0, point_location="p", site_location="s", site_id="sid")))
    import math
    def plane(a, b, c, d):
        x = math.radians(d - b) * math.cos(math.radians((a + c) / 2))
        return math.hypot(x, math.radians(c - a)) * geo.EARTH_RADIUS
    assert got == {sid: sum(plane(la, lo, a, b) <= 1_500_000 for _, la, lo in pts) for sid, a, b in sites}
    assert got[100] >= 200


def test_overlaps_match_brute_force(spark):
    rng = random.Random(4)
    data = [(i, a, a + rng.randint(0, 9)) for i in range(300) for a in [5 if i % 3 == 0 else rng.randint(0, 60)]]
    df = spark.createDataFrame(data, "id int, lo int, hi int")
    right = df.select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    got = dict(rows(proximity.count_overlaps(df, right, left_range=("lo", "hi"), right_range=("a", "b"), left_id="id")))
    assert got == {i: sum(a <= hi and b >= lo for _, a, b in data) for i, lo, hi in data}


def test_more_like_this_matches_brute_force_ranks(spark):
    df = spark.createDataFrame([(1, "red apple red apple pie"), (2, "red apple tart"), (3, "green pear"), (4, "apple pie apple")],
                               "id int, t string")
    src = df.where("id = 1").select("id")
    m = scoring.more_like_this(df, src, "id", "t", min_doc_freq=1, min_term_freq=1)
    assert [r["id"] for r in m.orderBy("rank").collect()][0] in (2, 4)
    assert {r["id"] for r in m.collect()} == {2, 4}


# --- conversions and SQL ----------------------------------------------------------------------------------


def test_dates(spark):
    df = spark.createDataFrame([("2020-02-03",), ("20200203",), ("1580688000000",), ("nonsense",)], "s string")
    parsed = df.select(convert.parse_date(F.col("s"), ["strict_date", "basic_date", "epoch_millis"]).alias("d"))
    assert [str(r["d"]) for r in parsed.collect()] == ["2020-02-03 00:00:00"] * 3 + ["None"]


@pytest.mark.parametrize("name", [n for n in convert.DATE_FORMATS if "time" not in n or "no_millis" not in n])
def test_every_named_format_writes(spark, name):
    one = spark.range(1).select(convert.format_date(F.timestamp_seconds(F.lit(1580731506)), name).alias("s")).first()["s"]
    assert one


def test_ranges(spark):
    r = spark.createDataFrame([('{"gte": 1, "lt": 5}',), ('{"gt": 5}',), (None,)], "s string").select(
        convert.range_from_json(F.col("s"), "int").alias("r"))
    hits = r.select(*[convert.range_contains(F.col("r"), F.lit(v)).alias(f"v{v}") for v in (1, 5, 6)]).collect()
    assert [tuple(h) for h in hits] == [(True, False, False), (False, False, True), (None, None, None)]
    back = [x["j"] for x in r.select(convert.range_to_json(F.col("r")).alias("j")).collect()]
    assert back[:2] == ['{"gte":1,"lt":5}', '{"gt":5}']


def test_addresses(spark):
    df = spark.createDataFrame([("10.0.0.1",), ("10.0.1.0",), ("256.1.1.1",), ("x",)], "ip string")
    assert [r[0] for r in df.select(convert.ip_to_long(F.col("ip"))).collect()] == [167772161, 167772416, None, None]
    assert df.where(convert.ip_in_network(F.col("ip"), "10.0.0.0/24")).count() == 1
    assert df.where(convert.ip_between(F.col("ip"), "10.0.0.1", "10.0.1.0")).count() == 2


def test_names():
    assert convert.kebab_case("lastName") == "last-name" and convert.snake_case("lastName") == "last_name"


def test_parameters(spark, stored):
    with pytest.raises(ValueError):
        S.check_params({"a": None})
    out = S.sql(spark, "select id from t where m = :m", {"t": stored}, args={"m": "x' or '1'='1"})
    assert out.count() == 0
    reg = S.TemplateRegistry(spark)
    reg.put("q", "select id from t where id > :low")
    assert reg.search("q", {"t": stored}, {"low": 1}).count() == 2
    assert reg.delete("q") and not reg.delete("q")
    with pytest.raises(KeyError):
        reg.search("q", {}, {})


# --- streams -------------------------------------------------------------------------------------------------


def test_stream_upsert_equals_batch(spark, tmp_path):
    rng = random.Random(6)
    folder, every = tmp_path / "in", []
    for b in range(4):
        # one id takes a third of the writes; late versions come in later files
        part = [(0 if rng.random() < 0.34 else rng.randint(1, 20), f"{b}-{i}", rng.randint(1, 50), b * 100 + i) for i in range(60)]
        every += part
        spark.createDataFrame(part, "id int, m string, ver int, seq int").coalesce(1).write.mode("append").parquet(str(folder))
    schema = spark.createDataFrame(every[:1], "id int, m string, ver int, seq int").schema
    target = Collection(spark, str(tmp_path / "out"), id="id", buckets=3)
    target.create(schema)
    stream = streams.read_stream(spark, str(folder), schema, files_per_batch=1)
    q = streams.stream_version_upsert(stream, target, str(tmp_path / "cp"), "ver")
    q.awaitTermination()
    best = {}
    for id_, _, ver, _ in every:
        best[id_] = max(ver, best.get(id_, 0))
    assert dict(rows(target.read(), "id", "ver")) == best


# --- plans -----------------------------------------------------------------------------------------------------


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet("/root/testdata/sf0.001/orders.parquet")


def test_filters_and_columns_reach_the_scan(orders):
    s = Search(orders, DocSchema.of(orders, id="o_orderkey")).query(
        C.is_("o_orderstatus", "F") & C.gt("o_totalprice", 10.0) & C.before("o_orderdate", dt.datetime(2000, 1, 1)))
    plan = plan_of(s.matches().select("o_orderkey"))
    for pushed in ("EqualTo(o_orderstatus,F)", "GreaterThan(o_totalprice,10.0)", "LessThanOrEqual(o_orderdate"):
        assert pushed in plan
    assert "o_custkey" not in plan


def test_ranks_are_cut_before_the_shuffle(orders):
    plan = plan_of(top_per_key(orders, "o_custkey", (F.desc("o_totalprice"),), 2))
    assert plan.count("WindowGroupLimit") == 2


def test_top_k_is_a_heap(orders):
    from docspark.plans.search import Order
    plan = plan_of(Search(orders, DocSchema.of(orders, id="o_orderkey")).sort(Order("o_totalprice")).hits())
    assert "TakeOrderedAndProject" in plan and "Exchange rangepartitioning" not in plan


def test_scoring_does_not_shuffle_texts(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    hits = Search(df, DocSchema.of(df, text=["text"], id="doc_id")).query(C.matches("text", "the of")).with_scores().matches()
    plan = plan_of(hits.select("doc_id", "_score")).split("Subquery")[0]
    assert "Exchange" not in plan and "Join" not in plan


def test_postings_reuse_a_partitioning_by_document(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(4, "doc_id")
    assert plan_of(scoring.postings(df, "doc_id", "text")).count("Exchange") == 1


