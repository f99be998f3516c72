"""Small tables: which rows a criterion matches, with the expected ids by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from docspark.functions import analysis as A
from docspark.functions import geo
from docspark.operators import byexample
from docspark.plans import criteria as C
from docspark.plans.criteria import Criteria
from docspark.plans.search import Order, Search, source_filter
from docspark.schema import DocSchema, FieldSpec


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, "Hello World", "red", 10, ["a", "b"], dt.datetime(2020, 1, 1)),
        (2, "hello there, big world", "green", 20, ["b"], dt.datetime(2020, 6, 1)),
        (3, "World of hello", "blue", 30, [], dt.datetime(2021, 1, 1)),
        (4, "", "", 40, None, None),
        (5, None, None, None, ["c"], None),
        (6, "Worlds apart can't e-mail", "dark red", 60, ["a", "c"], dt.datetime(2022, 1, 1)),
    ]
    return spark.createDataFrame(
        rows, "id int, text string, color string, n int, tags array<string>, at timestamp")


@pytest.fixture(scope="module")
def schema(docs):
    return DocSchema.of(docs, text=["text"], id="id")


def ids(docs, schema, node):
    hits = Search(docs, schema).query(node).matches()
    return sorted(r["id"] for r in hits.select("id").collect())


CASES = [
    (C.is_("text", "hello world"), [1, 2, 3]),
    (C.is_("color", "red"), [1]),
    (C.is_("tags", "b"), [1, 2]),
    (C.matches("text", "there apart"), [2, 6]),
    (C.matches_all("text", "there world"), [2]),
    (C.phrase("text", "hello world"), [1]),
    (C.in_("text", ["big world", "world of"]), [2, 3]),
    (C.in_("color", ["red", None, "blue"]), [1, 3]),
    (C.in_("tags", ["c"]), [5, 6]),
    (C.not_in("color", ["red", "green"]), [3, 4, 5, 6]),
    (C.exists("text"), [1, 2, 3, 4, 6]),
    (C.exists("tags"), [1, 2, 5, 6]),
    (C.is_null("tags"), [3, 4]),
    (C.empty("color"), [4]),
    (C.not_empty("color"), [1, 2, 3, 6]),
    (C.starts_with("text", "wor"), [1, 2, 3, 6]),
    (C.ends_with("text", "rlds"), [6]),
    (C.contains("text", "ELL"), [1, 2, 3]),
    (C.contains("text", "e-m"), []),
    (C.starts_with("color", "re"), [1]),
    (C.wildcard("text", "wor?ds"), [6]),
    (C.wildcard("text", "*"), [1, 2, 3, 6]),
    (C.regexp("text", "wor.*"), [1, 2, 3, 6]),
    (C.regexp("color", "re"), []),
    (C.expression("text", ["hello"], ["there", "of"], ["big"]), [3]),
    (C.term("text", "world"), [1, 2, 3]),
    (C.term("text", "World"), []),
    (C.fuzzy("text", "wrold"), [1, 2, 3]),
    (C.fuzzy("text", "helo", 1), [1, 2, 3]),
    (C.fuzzy("text", "xhelo", 1), []),
    (C.search_as_you_type("text", "hello th"), [2]),
    (C.lt("n", 20), [1]), (C.lte("n", 20), [1, 2]), (C.gt("n", 40), [6]), (C.gte("n", 40), [4, 6]),
    (C.between("n", 20, 40), [2, 3, 4]), (C.between("n", None, 20), [1, 2]),
    (C.before("at", dt.datetime(2020, 6, 1)), [1, 2]), (C.after("at", dt.datetime(2020, 6, 1)), [2, 3, 6]),
    (~C.is_("color", "red"), [2, 3, 4, 5, 6]),
    (C.is_("color", "red") | C.gt("n", 50), [1, 6]),
    (C.Bool(should=(C.gt("n", 5), C.lt("n", 25), C.is_("color", "red")), min_should=2), [1, 2]),
    (C.is_("text", "can't"), [6]),
]


@pytest.mark.parametrize("node, expected", CASES, ids=[str(i) for i in range(len(CASES))])
def test_matches(docs, schema, node, expected):
    assert ids(docs, schema, node) == expected


def test_blanks_are_refused(docs, schema):
    for make in (C.starts_with, C.ends_with, C.contains):
        with pytest.raises(ValueError):
            ids(docs, schema, make("text", "two words"))
    with pytest.raises(ValueError):
        ids(docs, schema, C.between("n", None, None))


def test_chain_rule(docs, schema):
    w = Criteria.where
    # all alternatives: any of them
    assert ids(docs, schema, w("color").is_("red").or_("n").gt(50)) == [1, 6]
    # with a required part an alternative only adds to the score
    assert ids(docs, schema, w("n").gte(20).and_("n").lte(30).or_("color").is_("red")) == [2, 3]
    assert ids(docs, schema, w("color").not_().is_("red")) == [2, 3, 4, 5, 6]
    assert ids(docs, schema, w("n").gt(10).and_("color").not_().is_("blue")) == [2, 4, 6]
    negated = w("n").gt(50).or_("color").not_().is_("red")
    assert ids(docs, schema, negated) == [2, 3, 4, 5, 6]
    first = w("color").not_().is_("red").or_("n").lte(10)
    assert ids(docs, schema, first) == [1, 2, 3, 4, 5, 6]
    assert ids(docs, schema, first.build(compat=True)) == [1]
    group = w("n").gt(25).sub(w("color").is_("blue").or_("color").is_("dark red"))
    assert ids(docs, schema, group) == [3, 6]
    assert ids(docs, schema, w("text").starts_with("wor").ends_with("ds")) == [6]


def test_scores(docs, schema):
    node = C.Bool(must=(C.gt("n", 0),), should=(C.is_("color", "red").boost(3.0),))
    hits = Search(docs, schema).query(node).with_scores().matches()
    assert {r["id"]: r["_score"] for r in hits.collect()} == {1: 4.0, 2: 1.0, 3: 1.0, 4: 1.0, 6: 1.0}


def test_score_grows_with_frequency_and_shrinks_with_length(spark):
    df = spark.createDataFrame([(1, "x y z w"), (2, "x x z w"), (3, "x y z w v u"), (4, "y z")], "id int, text string")
    hits = Search(df, DocSchema.of(df, text=["text"], id="id")).query(C.term("text", "x")).with_scores().matches()
    s = {r["id"]: r["_score"] for r in hits.collect()}
    assert s[2] > s[1] > s[3] > 0 and set(s) == {1, 2, 3}


def test_phrase_occurrences_may_overlap(spark):
    df = spark.createDataFrame([("a a a b",)], "t string")
    an = A.STANDARD
    one = df.select(an.phrase_frequency(F.col("t"), ["a", "a"]).alias("scan"),
                    A.phrase_frequency(an.column(F.col("t")), ["a", "a"]).alias("tokens")).first()
    assert one["scan"] == one["tokens"] == 2


def test_scanning_equals_tokenizing(spark):
    texts = ["It's 3.14, naïve café! ΑΒΓ x", "don't-stop__now", "  lead", "ab abc ABC a1b2", "", "ß İ straße"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for an in (A.STANDARD, A.SIMPLE):
        toks = an.column(F.col("t"))
        for term in ("ab", "abc", "3", "café", "now", "stop", "s", "a1b2", "straße"):
            rows = df.select(F.array_contains(toks, term).alias("a"), (an.frequency(F.col("t"), term) > 0).alias("b"),
                             F.size(toks).alias("n"), an.length(F.col("t")).alias("m")).collect()
            assert all(r["a"] == r["b"] or not an.is_term(term) for r in rows), term
            assert all(r["n"] == r["m"] for r in rows)


def test_fuzzy_counts_a_swap_as_one_edit(spark):
    df = spark.createDataFrame([("teh",), ("the",), ("thx",), ("xxe",), ("hte",)], "t string")
    near = lambda k: {r["t"] for r in df.where(A.within_edits(F.col("t"), "the", k)).collect()}
    assert near(0) == {"the"}
    assert near(1) == {"teh", "the", "thx", "hte"}
    assert A.auto_fuzziness("ab") == 0 and A.auto_fuzziness("abc") == 1 and A.auto_fuzziness("abcdef") == 2


def test_synonyms(spark):
    df = spark.createDataFrame([(1, "The British queen"), (2, "an English monarch"), (3, "german queens")], "id int, text string")
    an = A.synonym_analyzer([("british", "english"), ("queen", "monarch")])
    schema = DocSchema.of(df, id="id", overrides=[FieldSpec("text", "text", analyzer=an)])
    assert ids(df, schema, C.is_("text", "english queen")) == [1, 2]
    assert ids(df, schema, C.phrase("text", "british monarch")) == [1, 2]
    hits = Search(df, schema).query(C.is_("text", "monarch")).with_scores().matches()
    assert {r["id"] for r in hits.where("_score > 0").collect()} == {1, 2}


def test_search_after_pages_make_up_the_whole(docs, schema):
    s = Search(docs, schema).sort(Order("color", missing="last"), Order("id")).limit(2)
    seen, after = [], None
    while True:
        page = (s if after is None else s.search_after(*after)).hits().select("id", "color").collect()
        if not page:
            break
        seen += [r["id"] for r in page]
        after = (page[-1]["color"], page[-1]["id"])
    assert seen == [4, 3, 6, 2, 1, 5]


def test_sort_missing_and_modes(docs, schema):
    s = Search(docs, schema)
    order = lambda o: [r["id"] for r in s.sort(o).hits().collect()]
    assert order(Order("n").desc()) == [6, 4, 3, 2, 1, 5]
    assert order(Order("n", missing="first")) == [5, 1, 2, 3, 4, 6]
    assert order(Order("n", missing=25)) == [1, 2, 5, 3, 4, 6]
    assert order(Order("tags").desc()) == [5, 6, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        order(Order("nothing"))
    assert order(Order("nothing", unmapped="long")) == [1, 2, 3, 4, 5, 6]


def test_paging_rules(docs, schema):
    s = Search(docs, schema)
    assert s.size == 10 and s.unpaged().size is None and s.unpaged(10_000).size == 10_000
    assert s.page(1, 4).limit(2).size == 2 and s.page(1, 4).offset == 4
    assert [r["id"] for r in s.page(1, 4).hits().collect()] == [5, 6]
    assert s.query(C.gt("n", 1)).total(up_to=2).first() == (2, "GREATER_THAN_OR_EQUAL_TO")
    assert s.query(C.gt("n", 1)).total(up_to=5).first() == (5, "EQUAL_TO")
    assert s.query(C.gt("n", 1000)).exists().first()[0] is False
    assert len(list(s.stream_results(max_results=4))) == 4


def test_source_filter(docs):
    assert source_filter(docs, ["t*"], ["tags"]).columns == ["text"]
    assert source_filter(docs, fetch=False).columns == []
    deep = docs.select("id", F.struct("n", F.struct("color").alias("in")).alias("out"))
    assert source_filter(deep, ["out.in"]).schema.simpleString() == "struct<out:struct<in:struct<color:string>>>"


def test_null_value_and_ignore_above(docs):
    schema = DocSchema.of(docs, overrides=[FieldSpec("n", "numeric", null_value=-1), FieldSpec("color", "keyword", ignore_above=5)])
    assert ids(docs, schema, C.is_("n", -1)) == [5]
    assert ids(docs, schema, C.exists("color")) == [1, 2, 3, 4]


def test_query_by_example(docs, schema):
    make = byexample.example_criteria
    assert ids(docs, schema, make({"color": "red", "n": 10}, schema)) == [1]
    assert ids(docs, schema, make({"color": "red", "n": 20}, schema, match="any")) == [1, 2]
    assert ids(docs, schema, make({"color": None, "tags": ["x"]}, schema)) == [1, 2, 3, 4, 5, 6]
    assert ids(docs, schema, make({"color": None}, schema, include_nulls=True)) == [5]
    assert ids(docs, schema, make({"color": "re"}, schema, matchers={"color": "containing"})) == [1, 2, 6]
    with pytest.raises(ValueError):
        make({"color": "x"}, schema, ignore_case=True)


def test_geo(spark):
    pts = [(1, 45.78, 3.19), (2, 50.6463, 5.5681), (3, 37.77, -122.42), (4, 0.0, 179.9)]
    df = spark.createDataFrame(pts, "id int, lat double, lon double").select(
        "id", geo.make_point(F.col("lat"), F.col("lon")).alias("location"))
    schema = DocSchema.of(df, id="id")
    assert schema.field("location").role == "geo"
    assert ids(df, schema, C.within("location", geo.Point(45.78, 3.19), geo.Distance(1, "km"))) == [1]
    assert ids(df, schema, C.within("location", "50.6463,5.5681", "600km")) == [1, 2]
    assert ids(df, schema, C.bounded_by("location", geo.Point(10, 170), geo.Point(-10, -170))) == [4]
    assert geo.metres(geo.Distance(1.9, "km")) == 1000.0
    hashed = df.select("id", geo.geohash(F.col("location.lat"), F.col("location.lon"), 8).alias("h"), "location")
    rows = {r["id"]: r["h"] for r in hashed.collect()}
    assert rows[3].startswith("9q8y")
    box = hashed.select(geo.cell_bounds(F.col("h"), 8).alias("b"), "location")
    assert box.where("location.lat between b.bottom and b.top and location.lon between b.left and b.right").count() == 4
    centre = geo.cell_centre(rows[1])
    assert abs(centre.lat - 45.78) < 1e-3 and abs(centre.lon - 3.19) < 1e-3
    assert hashed.select(F.size(geo.cell_neighbors(F.col("h"), 8)).alias("n")).distinct().collect()[0]["n"] == 8


def test_nested_clauses_need_not_meet_in_one_element(spark):
    df = spark.sql("""select 1 id, array(named_struct('name','saturn','model','sl'), named_struct('name','subaru','model','imprezza')) car
        union all select 2, array(named_struct('name','ford','model','focus'))""")
    schema = DocSchema.of(df, id="id")
    assert ids(df, schema, C.is_("car.name", "saturn") & C.is_("car.model", "imprezza")) == [1]
    from docspark.operators.nested import nested_match
    together = nested_match("car", lambda c: (c["name"] == "saturn") & (c["model"] == "imprezza"))
    assert df.where(together).count() == 0
