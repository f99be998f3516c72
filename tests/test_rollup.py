"""The stored rollup against exact aggregates."""

import random

import pytest
from pyspark.sql import functions as F

from docspark.sources.rollup import RANK_ERROR, Rollup


def data(n, seed):
    r = random.Random(seed)
    return [(r.choice(["a", "b", "b", "b", None]), r.randrange(5), r.randrange(3000), r.choice([None, r.gauss(100, 30)])) for _ in range(n)]


SCHEMA = "k string, day int, user long, v double"


def test_rolled_up_numbers(spark, tmp_path):
    first, second = data(20_000, 1), data(15_000, 2)
    rollup = Rollup.build(spark.createDataFrame(first, SCHEMA).repartition(4), str(tmp_path / "r"), keys=["k", "day"],
                          distinct=["user"], quantiles=["v"], metrics=["v"])
    one, rollup = rollup, rollup.add(spark.createDataFrame(second, SCHEMA))
    rows = first + second
    for by, where, keep in ((["k"], None, lambda r: True), ([], F.col("day") >= 3, lambda r: r[1] >= 3),
                            (["k", "day"], F.col("k") == "b", lambda r: r[0] == "b")):
        got = rollup.aggregate(by, where=where, points=(1, 50, 99)).collect()
        groups = {}
        for r in filter(keep, rows):
            groups.setdefault(tuple(dict(k=r[0], day=r[1])[c] for c in by), []).append(r)
        assert {tuple(g[c] for c in by) for g in got} == set(groups)
        for g in got:
            mine = groups[tuple(g[c] for c in by)]
            values = sorted(r[3] for r in mine if r[3] is not None)
            assert (g["doc_count"], g["v_count"], g["v_min"], g["v_max"]) == (len(mine), len(values), values[0], values[-1])
            assert g["v_sum"] == pytest.approx(sum(values)) and g["v_avg"] == pytest.approx(sum(values) / len(values))
            exact = len({r[2] for r in mine})
            assert abs(g["user_distinct"] - exact) <= 5 * 0.0082 * exact
            for p in (1, 50, 99):
                share = sum(v <= g[f"v_p{p}"] for v in values) / len(values)
                assert abs(share - p / 100) <= 2 * RANK_ERROR
    assert one.aggregate().first()["doc_count"] == 20_000  # an older version stays as it was
    assert Rollup.open(spark, str(tmp_path / "r")).aggregate().first()["doc_count"] == 35_000
    with pytest.raises(ValueError, match="no keys"):
        rollup.aggregate(["user"])
    plan = rollup.aggregate(["k"], where=F.col("day") == 2)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(day,2)" in plan and "user" not in plan.split("ReadSchema")[1].split("\n")[0].replace("distinct_user", "")


def test_nulls_and_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, None, None), (None, 1, None, None)], SCHEMA)
    got = Rollup.build(rows, str(tmp_path / "n"), keys=["k"], distinct=["user"], quantiles=["v"], metrics=["v"]).aggregate(["k"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([("a", 1, 0, None, 0, None, None, None, None), (None, 1, 0, None, 0, None, None, None, None)], key=repr)
    none = Rollup.build(rows.limit(0), str(tmp_path / "e"), keys=["k"], distinct=["user"], quantiles=["v"], metrics=["v"])
    assert none.aggregate(["k"]).count() == 0 and none.aggregate().first()["doc_count"] == 0
