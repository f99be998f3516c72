"""The stored vocabulary against scans of all terms."""

import random
import re

import pytest
from pyspark.sql import functions as F

from docspark.functions import analysis as A
from docspark.sources import vocabulary as module
from docspark.sources.vocabulary import Vocabulary, pieces_of, required


def names(df):
    return sorted(r[0] for r in df.select("term").collect())


@pytest.fixture(scope="module")
def words():
    r = random.Random(4)
    out = {"".join(r.choice("abcde") for _ in range(r.randint(1, 12))) for _ in range(1500)}
    return sorted(out | {"été", "漢字漢字", "a", "", "a.b", "abc" * 30})


@pytest.fixture(scope="module")
def vocabulary(spark, words, tmp_path_factory):
    df = spark.createDataFrame([(w, len(w)) for w in words] + [(None, 0)], "term string, df int")
    return Vocabulary.build(df, str(tmp_path_factory.mktemp("vocabulary") / "v"))


@pytest.mark.parametrize("op, value", [
    ("contains", "abc"), ("contains", "BCDE"), ("contains", "ab"), ("starts_with", "abc"), ("starts_with", "ab"), ("starts_with", "b"),
    ("ends_with", "cde"), ("ends_with", "de"), ("wildcard", "ab*de"), ("wildcard", "*bcd?"), ("wildcard", "a?c"), ("wildcard", "*"),
    ("wildcard", "été"), ("regexp", "ab[cd]e.*"), ("regexp", "abc?de*"), ("regexp", "(ab)+c.*"), ("regexp", "abc|de"), ("regexp", "a{2,3}b+c.*"),
    ("regexp", "a\\.b"), ("regexp", "[ab]{3}cd(e|a).*"), ("regexp", "ab+cd.*"), ("regexp", ".*bcd")])
def test_like_equals_the_scan(vocabulary, words, op, value):
    low = value if op == "regexp" else value.lower()
    tests = {"contains": lambda w: low in w, "starts_with": lambda w: w.startswith(low), "ends_with": lambda w: w.endswith(low),
             "wildcard": lambda w: re.fullmatch(low.replace("*", ".*").replace("?", "."), w, re.S),
             "regexp": lambda w: re.fullmatch(low, w)}
    expected = [w for w in words if tests[op](w)]
    assert names(vocabulary.like(op, value)) == expected
    found = vocabulary.candidates(op, low)
    if found is not None:
        held = names(found)
        assert set(expected) <= set(held) and len(held) <= len(words) / 4


def test_required_grams():
    assert required(pieces_of("wildcard", "ab*")) == ["\x02ab"] and required(pieces_of("contains", "ab")) == []
    assert required(pieces_of("regexp", "abcd?ef.*")) == ["\x02ab", "abc"]
    assert pieces_of("regexp", "a|b") == [] and pieces_of("fuzzy", "a") is None


@pytest.mark.parametrize("word", ["abcde", "abced", "aab", "a", "", "ab", "eabcdeabcd", "abc" * 30, "été", "xyz"])
@pytest.mark.parametrize("edits", [0, 1, 2])
def test_near_equals_the_scan(spark, vocabulary, word, edits):
    scan = vocabulary.terms().where(F.col("term").isNotNull()).where(A.within_edits(F.col("term"), word, edits))
    assert names(vocabulary.near(word, edits)) == names(scan)


def plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        before, row = row, [i + 1]
        for j, y in enumerate(b):
            row.append(min(before[j + 1] + 1, row[j] + 1, before[j] + (x != y)))
    return row[-1]


def swaps(a):
    return {a[:i] + a[i + 1] + a[i] + a[i + 2:] for i in range(len(a) - 1)}


def close(a, b, k):
    """A swap counts as one edit and is made first."""
    return (plain(a, b) <= k or k > 0 and any(plain(v, b) <= k - 1 for v in swaps(a))
            or k > 1 and any(b in swaps(v) for v in swaps(a)))


def test_near_all_words_at_once(spark, vocabulary, words):
    r = random.Random(6)
    asked = r.sample([w for w in words if len(w) < 20], 25) + ["abdce", "ABC", "aabb", None]
    df = spark.createDataFrame([(w, "x") for w in asked + asked[:3]], "w string, term string")
    low = {w.lower() for w in asked if w is not None}
    got = {(x["word"], x["term"]) for x in vocabulary.near_all(df, "w", edits=2).collect()}
    assert got == {(a, w) for a in low for w in words if abs(len(a) - len(w)) < 3 and close(a, w, 2)}
    auto = vocabulary.near_all(df, "w").collect()
    assert len(auto) == len({(x["word"], x["term"]) for x in auto})
    assert {(x["word"], x["term"]) for x in auto} == {(a, w) for a in low for w in words
                                                     if abs(len(a) - len(w)) < 3 and close(a, w, A.auto_fuzziness(a))}
    assert all(x["df"] == len(x["term"]) for x in auto)


def test_the_files_are_filtered(vocabulary):
    plan = vocabulary.like("contains", "abcde")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(gram" in plan
    plan = vocabulary.near("abcde", 2)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(key" in plan
    empty = Vocabulary.build(vocabulary.terms().limit(0), vocabulary.path + "-empty")
    assert empty.near("abc").count() == 0 and empty.like("contains", "abc").count() == 0


def test_terms_of_one_beginning_share_its_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(module, "PART_ROWS", 3)
    terms = [f"abcdefg{i}" for i in range(300)] + ["abcdefg", "abcdef", "bcdefgh", "acbdefg5"]
    v = Vocabulary.build(spark.createDataFrame([(t, 1) for t in terms], "term string, df int"), str(tmp_path / "v"))
    keys = spark.read.parquet(f"{v.path}/keys")
    assert keys.count() == keys.distinct().count() <= 4 * module.KEYS
    # as many files as the rows take, whatever the number of shuffle partitions is
    assert len(keys.inputFiles()) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = ["abcdefg7", "abcdef", "abcdefg", "bcdefgh", "xabcdefg12"]
    got = v.near_all(spark.createDataFrame([(w,) for w in asked], "word string"), edits=2).collect()
    assert sorted((x["word"], x["term"]) for x in got) == sorted((a, t) for a in asked for t in terms if abs(len(a) - len(t)) < 3 and close(a, t, 2))
    for w in asked:
        assert names(v.near(w, 2)) == sorted(t for t in terms if abs(len(w) - len(t)) < 3 and close(t, w, 2)), w
