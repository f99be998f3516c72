"""The stored completion index against scans of all inputs."""

import random

import pytest
from pyspark.sql import functions as F

from docspark.operators import suggest
from docspark.sources.completion import CompletionIndex


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    r = random.Random(2)
    data = []
    for i in range(400):
        names = ["".join(r.choice("aab ") for _ in range(r.randint(0, 9))).strip() + r.choice(["", "1", " X"]) for _ in range(r.randint(1, 3))]
        data.append((i, names, r.randint(0, 6) if i % 50 else None, r.choice(["p", "q", None])))
    data += [(1000 + i, ["abab same"], 5, "p") for i in range(60)] + [(2000, None, 1, "p"), (2001, ["École été"], 9, "q")]
    docs = spark.createDataFrame(data, "id int, names array<string>, w int, kind string").repartition(4)
    rows = suggest.completion_rows(docs, "id", F.col("names"), F.col("w"), ["kind"]).cache()
    return rows, CompletionIndex.build(rows, "id", str(tmp_path_factory.mktemp("completion") / "ix"), contexts=["kind"], depth=4, kept=10)


def listed(df):
    return [tuple(r) for r in df.select("id", "input", "weight").collect()]


@pytest.mark.parametrize("prefix", ["", "a", "AB", "aba", "abab", "abab s", "zz", "b a", "École", "a1"])
def test_lists_equal_the_scan(stored, prefix):
    rows, index = stored
    for size in (1, 5, 10, 25):
        want = suggest.suggest_completion(rows, prefix, "id", size=size)
        assert listed(index.suggest(prefix, size=size)) == listed(want), size
    for value in ("p", "q", "none"):
        want = suggest.suggest_completion(rows, prefix, "id", size=7, context=F.col("kind") == value)
        assert listed(index.suggest(prefix, size=7, context=("kind", value))) == listed(want)


def test_one_list_is_read(spark, stored):
    rows, index = stored
    plan = index.suggest("ab")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(prefix,ab)" in plan and "Exchange hash" not in plan
    assert index.lists().groupBy("scope", "prefix").count().where("count > 10").count() == 0
    again = CompletionIndex.open(spark, index.path)
    assert (again.contexts, again.depth, again.kept) == (("kind",), 4, 10) and listed(again.suggest("a")) == listed(index.suggest("a"))
    with pytest.raises(ValueError, match="no lists for the context"):
        index.suggest("a", context=("other", 1))


def test_many_prefixes_at_once(spark, stored):
    rows, index = stored
    asked = spark.createDataFrame([("a",), ("AB",), ("a",), ("b",), ("zz",), (None,)], "p string")
    got = index.suggest_all(asked, "p", size=3).collect()
    for p in ("a", "AB", "b", "zz"):
        mine = [(r["id"], r["input"], r["weight"]) for r in sorted(got, key=lambda r: r["rank"]) if r["prefix"] == p]
        assert mine == listed(suggest.suggest_completion(rows, p, "id", size=3))
    with pytest.raises(Exception, match="longer than the lists"):
        index.suggest_all(spark.createDataFrame([("ababab",)], "p string"), "p").collect()


def test_no_rows(spark, stored, tmp_path):
    rows, _ = stored
    empty = CompletionIndex.build(rows.limit(0), "id", str(tmp_path / "ix"), contexts=["kind"])
    assert listed(empty.suggest("a")) == [] and listed(empty.suggest("a" * 30)) == []
