"""Parents and children in one layout: the results of the plain tables, without an exchange."""

import pytest
from pyspark.sql import functions as F

from docspark.operators import relations
from docspark.sources.related import RelatedTables


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    parents = spark.range(500).select("id", (F.col("id") % 3).cast("string").alias("kind")).unionAll(
        spark.createDataFrame([(None, "x")], "id long, kind string"))
    children = spark.range(2000).select(F.col("id").alias("child"), (F.col("id") * 7 % 620).cast("int").alias("up"), (F.col("id") % 11).alias("v")).unionAll(
        spark.createDataFrame([(9999, None, 1)], "child long, up int, v long"))
    path = str(tmp_path_factory.mktemp("related") / "t")
    return parents, children, RelatedTables.build(parents, children, path, parent_key="id", child_key="up", buckets=6)


@pytest.fixture
def merge_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_relations_need_no_exchange(spark, tables, merge_joins):
    parents, children, stored = tables
    p, c = stored.parents(), stored.children()
    assert rows(p, "id", "kind") == rows(parents, "id", "kind") and rows(c, "child", "up", "v") == rows(children, "child", "up", "v")
    some = F.col("v") > 4
    cases = [(lambda p, c: relations.has_child(p, c, "id", "up", some), ("id", "kind")),
             (lambda p, c: relations.has_child(p, c, "id", "up", some, min_children=2, max_children=3, score_mode="sum", child_score=F.col("v")),
              ("id", "kind", "_score")),
             (lambda p, c: relations.not_has_child(p, c, "id", "up", some), ("id", "kind")),
             (lambda p, c: relations.has_parent(c, p, "up", "id", F.col("kind") == "1"), ("child", "up")),
             (lambda p, c: relations.has_parent(c, p, "up", "id", parent_score=F.length("kind")), ("child", "_score")),
             (lambda p, c: relations.join_inner_hits(p, c, "id", "up", (F.desc("v"), F.asc("child")), ["child", "v"]), ("id", "inner_hits"))]
    for relation, columns in cases:
        got = relation(p, c)
        assert rows(got, *columns) == rows(relation(parents, children), *columns)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan.split("Initial Plan")[0], plan
    again = RelatedTables.open(spark, stored.path)
    assert rows(relations.has_child(again.parents(), again.children(), "id", "up"), "id") == rows(relations.has_child(parents, children, "id", "up"), "id")


def test_children_of_a_parent_are_in_one_file(spark, tables):
    _, children, stored = tables
    found = relations.parent_id(stored.children(), "up", 14)
    assert rows(found, "child") == rows(relations.parent_id(children, "up", 14), "child")
    files = stored.children().select("up", F.input_file_name().alias("file")).distinct()
    assert files.groupBy("up").count().where("count > 1").count() == 0 and files.select("file").distinct().count() == 6
    with pytest.raises(ValueError, match="related tables exist"):
        RelatedTables.build(children, children, stored.path, parent_key="up", child_key="up", buckets=2)
