"""Tokens of the secret scan's battery: mixed marks."""

from __future__ import annotations

import random
import re
import string
from collections import Counter

from pyspark.sql import functions as F

from docspark.llm import secrets
from tests.llm.test_operators import B62, token


def test_every_long_part_is_a_candidate():
    key = token(B62, 40, 3)
    parts = lambda t: re.findall(secrets.TOKEN, t)
    assert parts(f"my_app/v1/{key}") == [f"app/v1/{key}"] and parts(f"a_b/{key}/c_d") == [f"b/{key}/c"]
    assert parts(f"key-{key}/{key}") == [f"key-{key}", f"/{key}"]
    for whole in (f"{key}_{key}", f"{key}/a+{key}", key):  # one set of marks: one candidate, as ever
        assert parts(f"é {whole} x") == [whole]


def test_keys_in_paths_are_judged(spark):
    key = token(B62, 64, 3)
    got = spark.createDataFrame([(f"my_app/v1/{key}",), ("some_long/path_to/nothing_at/all",)], "text string")
    out = secrets.scan(got, id="text").select("text", secrets.written("spans")).collect()
    assert sorted(r[1] for r in out) == ["", "random:3:74"]


def names(n):
    r, out = random.Random(1), []
    words = ("get set user name list by id version for with order item count last first new old value index page total data file path "
             "request response handler service factory builder manager test case number of string map create update delete find").split()
    while len(out) < n:
        w = [r.choice(words) for _ in range(r.randint(4, 8))]
        t = "_".join(w) if r.random() < 0.3 else w[0] + "".join(x.capitalize() for x in w[1:])
        i = r.randrange(len(t))
        t = t[:i] + str(r.randrange(10)) + t[i:]
        if 20 <= len(t) <= 48:
            out.append(t)
    return out


def test_recall_by_length_and_encoding(spark):
    """Few keys among very many names: long names must not raise the bar for short keys."""
    alphabets = {"base62": B62, "base32": string.ascii_uppercase + "234567", "base64": B62 + "+/", "base36": string.ascii_lowercase + string.digits}
    table = [("name", 0, t) for t in names(6000)]
    table += [(e, n, token(a, n, 1000 * n + i)) for e, a in alphabets.items() for n in (24, 40, 64) for i in range(60)]
    out = secrets.scan(spark.createDataFrame(table, "e string, n int, text string"), id="text")
    found = {(r["e"], r["n"]): r["f"] / r["all"] for r in out.groupBy("e", "n").agg(
        F.count(F.lit(1)).alias("all"), F.sum((F.size("spans") > 0).cast("int")).alias("f")).collect()}
    assert found["name", 0] <= 0.005
    assert all(found[e, 24] > 0 and found[e, 24] <= found[e, 40] <= found[e, 64] for e in alphabets)
    assert all(found[e, 64] >= 0.8 and found[e, 40] >= 0.4 for e in alphabets)


def test_thresholds_are_those_of_benjamini_hochberg(spark):
    r = random.Random(3)
    table = [(k, min(int(r.expovariate(0.05)), 90), r.randint(1, 40)) for k in ("a:0", "b:1", "c:2") for _ in range(30)]
    merged = Counter()
    for k, s, n in table:
        merged[k, s] += n
    want = {}
    for k in ("a:0", "b:1", "c:2"):
        every = sum(n for (x, _), n in merged.items() if x == k)
        sure = [s for (x, s) in merged if x == k and 10 ** (-s / 10) * every <= 0.01 * sum(n for (y, z), n in merged.items() if y == k and z >= s)]
        if sure:
            want[k] = min(sure)
    steps = spark.createDataFrame([(k, s, n) for (k, s), n in merged.items()], "kind string, step int, n long")
    assert secrets.thresholds(steps, 0.01) == want
    assert secrets.thresholds(steps.limit(0), 0.01) == {}


def test_only_asked_columns_are_kept(spark):
    df = spark.createDataFrame([(1, token(B62, 64, 3), "x")], "id long, text string, spans string")
    assert secrets.scan(df, keep=["id"]).columns == ["id", "base", "spans"]
    assert secrets.scan(df).columns == ["id", "text", "base", "spans"]
