"""Packing, the prefix trie and the Merkle manifest against brute-force versions and edge inputs."""

from __future__ import annotations

import hashlib
import json
import random
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docspark.llm import merkle, packing, queries, trie
from tests.llm.test_operators import DOCS, EDGE, SF, clashing, documents, rows, sentence

TOKENIZER = str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def edge(spark):
    return documents(spark, EDGE).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- packing -----------------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80), st.integers(40, 60))
def test_best_fit(sizes, capacity):
    """Against the rule itself: the fullest bin that takes the item, longest items first."""
    bins, offsets, heads, fills = packing.best_fit(sizes, capacity)
    full: list[int] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fitting = [f for f in full if f + sizes[i] <= capacity]
        if fitting:
            assert offsets[i] == max(fitting)
            full.remove(max(fitting))
        else:
            assert offsets[i] == 0
        full.append(offsets[i] + sizes[i])
    assert sorted(full) == sorted(fills) and sum(f <= capacity // 2 for f in fills) <= 1
    for b, head in enumerate(heads):
        assert bins[head] == b and offsets[head] == 0


def test_words_have_the_ids_of_the_text():
    model, encode = Tokenizer.from_file(TOKENIZER), packing.encoder(TOKENIZER)
    r, odd = random.Random(3), ["\x1c", "\x85", " ", "é", "́", "Σ", "İ", "'s", "don't", "<|endoftext|>", "…", "漢字", "\U0001f389",
                                " ", "ﬁ", "﻿", "１２", "a" * 300, "\0"]
    texts = [None, "", " \n\t", *[t for _, t, _ in EDGE if t]]
    texts += ["".join(r.choice([*odd, " ", " ", "\n", "\t\r", "\x0b\x0c", "word", "Two"]) for _ in range(40)) for _ in range(300)]
    for t in texts:
        want = model.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(encode(t), "<u4").tolist() == want


def test_columns_have_the_ids_of_their_texts(monkeypatch):
    r, model = random.Random(4), Tokenizer.from_file(TOKENIZER)
    odd = ["\u0378", "\U0003ffff", "<|endoftext|>", "\x85", "\xa0", "\x1c", "\u0301", "\u03a3", "e\u0301", "don't", "b" * 90, "\u2028", "\0"]
    texts = [None, "", " ", "\n", "\u0378", *("".join(r.choice([*odd, *" \t\n\r", "Word", "x1", "two,"]) for _ in range(25)) for _ in range(200))]
    texts += [" ".join(f"w{r.randrange(400)}" for _ in range(30)) for _ in range(100)] + ["", None]
    want = [np.array(model.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    for part, words in ((1, 0), (500, 50), (1 << 23, 1 << 19)):
        monkeypatch.setattr(packing, "PART_BYTES", part)
        monkeypatch.setattr(packing, "KEPT_WORDS", words)
        for kind in (pa.string(), pa.large_string()):
            column = pa.array(["before", *texts, "behind"], kind).slice(1, len(texts))
            assert list(packing.column_encoder(TOKENIZER)(column)) == want
    assert list(packing.column_encoder(TOKENIZER)(pa.array([], pa.string()))) == []
    assert list(packing.column_encoder(TOKENIZER)(pa.array([None, None], pa.string()))) == [b"", b""]


def test_a_worker_splits_runs_together_and_reads_a_tokenizer_once(monkeypatch, tmp_path):
    """A call of the pattern for each run, and a load of the file for each task, were most of the packing's seconds."""
    path, read, calls, splitter = tmp_path / "tokenizer.json", [], [], packing.word_splitter

    def counting(of):
        read.append(of)
        split = splitter(of)
        return split and (lambda text: calls.append(text) or split(text))

    monkeypatch.setattr(packing, "word_splitter", counting)
    path.write_text(Path(TOKENIZER).read_text(encoding="utf-8"), encoding="utf-8")
    text = " ".join(f"A{i}b," for i in range(100))
    want = packing.encoder(str(path))(text)
    assert len(calls) == 1
    assert packing.encoder(str(path))(text) == want and len(read) == 1
    said = json.loads(path.read_text(encoding="utf-8"))
    said["normalizer"] = None  # another file of this name: capitals stay
    path.write_text(json.dumps(said), encoding="utf-8")
    assert packing.encoder(str(path))(text) != want and len(read) == 2


def packs(df, capacity):
    """The pieces by sequence: gapless from 0, none too long; returns the number of sequences."""
    by = defaultdict(list)
    for r in df.collect():
        by[r["sequence_id"]].append((r["offset"], len(r["ids"]) // 4))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packed_edges(spark, edge, empty):
    out = packing.packed(edge, TOKENIZER, capacity=64)
    model, want = Tokenizer.from_file(TOKENIZER), []
    for i, t, _ in EDGE:
        ids = [*model.encode(t or "", add_special_tokens=False).ids, 0]
        want += [(i, nr, at, np.array(ids[at:at + 64], "<u4").tobytes()) for nr, at in enumerate(range(0, len(ids), 64))]
    got = sorted(((r["doc_id"], r["piece"], r["start"], bytes(r["ids"])) for r in out.collect()), key=repr)
    assert got == sorted(want, key=repr)
    total = sum(len(w[3]) // 4 for w in want)
    assert packs(out, 64) <= -(-total // 64) + 2
    assert rows(packing.packed(clashing(edge), TOKENIZER, capacity=64), "doc_id", "piece", "start") == rows(out, "doc_id", "piece", "start")
    assert packing.packed(empty, TOKENIZER).count() == 0


def counted():
    """Encodes a number as so many ids: what the tests need to set lengths."""
    return lambda text: b"\1\0\0\0" * (int(text or 0) - 1)


def test_rounds_merge_what_tasks_leave(spark):
    # each of 40 tasks has one text: no task can pack anything itself
    lengths = [60] * 20 + [40] * 10 + [20] * 5 + [10] * 5
    docs = documents(spark, [(i, str(n), "a") for i, n in enumerate(lengths)]).repartitionByRange(40, "doc_id")
    out = packing.packed(docs, "", capacity=100, encode=counted)
    # neighbours meet first, so 40s that stand together fill up each other and not the 60s far away
    assert packs(out, 100) <= 24 and -(-sum(lengths) // 100) == 18
    # nothing fits anywhere: no round, every text its own sequence
    tall = documents(spark, [(i, "51", "a") for i in range(30)]).repartition(10)
    assert packs(packing.packed(tall, "", capacity=100, encode=counted), 100) == 30
    r = random.Random(5)
    mixed = [r.choice([3, 5, 17, 30, 31, 55, 80, 99]) for _ in range(3000)]
    docs = documents(spark, [(i, str(n), "a") for i, n in enumerate(mixed)]).repartition(60)
    whole = len(packing.best_fit(mixed, 100)[2])
    assert packs(packing.packed(docs, "", capacity=100, encode=counted), 100) <= whole * 1.02


def test_packing_query_is_dense(spark):
    out = queries.QUERIES["op11_packing"](spark, SF).collect()
    assert len({r["sequence_id"] for r in out}) <= 1.02 * sum(r["length"] for r in out) / 2048 + 2
    text_of = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    model = Tokenizer.from_file(TOKENIZER)
    for r in out:
        ids = np.array([*model.encode(text_of[r["doc_id"]] or "", add_special_tokens=False).ids, 0], "<u4")
        part = ids[r["start"]:r["start"] + 2048]
        assert (r["start"], r["length"], r["ids_crc32"]) == (2048 * r["piece"], len(part), zlib.crc32(part.tobytes()))


# --- the prefix trie ---------------------------------------------------------------------------

TALKS = "conv_id long, turn long, role string, text string"


def brute_trie(seqs):
    """``seqs``: conversation to tuple of (role, text)."""
    members, children = defaultdict(list), defaultdict(set)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
            if d:
                children[s[:d - 1]].add(s[:d])
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) if children[p] else 1
        saved[p] = sum(saved[q] for q in children[p]) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    ends = {p: ",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(p)) for p, m in members.items()}
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(ends[p].encode()).hexdigest()) for p, m in members.items()), key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences_of(talks):
    by = defaultdict(list)
    for c, turn, role, text in talks:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: tuple((r, x) for _, _, r, x in sorted(t)) for c, t in by.items()}


@pytest.mark.parametrize("shards", ["1", "4", "70"])
def test_trie_equals_brute_force(spark, shards):
    r = random.Random(7)
    talks = []
    for c in range(300):  # a third share one conversation; the others branch early and late
        talks += [(c, t, "user" if t % 2 else "system", f"line {0 if c % 3 == 0 else r.randrange(2)} {t}" * (1 + t % 3))
                  for t in range(6 if c % 3 == 0 else r.randrange(1, 9))]
    talks += [(900, t, "user", f"long {t // 50}") for t in range(400)] + [(901, t, "user", f"long {t // 50}") for t in range(399)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        out = rows(trie.prefix_trie(trie.sequences(spark.createDataFrame(talks, TALKS).repartition(6))), *COLUMNS)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out == brute_trie(sequences_of(talks))


def test_trie_edges(spark):
    talks = [(1, None, "user", "a"), (1, 0, "user", "b"), (2, 0, None, None), (2, 1, "", ""), (3, 5, "user", "a"), (3, 5, "user", "a"),
             (None, 0, "user", "x"), (4, 0, "us", "er:a"), (5, 0, "user", ":a"), (6, 0, "x", "é漢\U0001f389" * 40_000), (7, 0, "x", "é漢\U0001f389" * 40_000)]
    df = spark.createDataFrame(talks, TALKS)
    want = sequences_of(talks)
    got = rows(trie.prefix_trie(trie.sequences(df)), *COLUMNS)
    # ties are ordered by the dictionary, here equal turns
    assert got == brute_trie(want)
    extra = df.select("*", *[F.lit("x").alias(c) for c in ("key", "turns", "number", "at", "chars", "shard", "parent", "t", "rank")])
    assert rows(trie.prefix_trie(trie.sequences(extra)), *COLUMNS) == got
    assert trie.prefix_trie(trie.sequences(df.limit(0))).count() == 0


def test_shared_starts_can_leave_no_turn(spark):
    talks = [(c, t, "user", f"{c % 2} {t}") for c in [0, 1, 5, 7, 203, 204, 301, 399] for t in range(1 + c % 3)]
    own = sequences_of(talks)
    seqs = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        seqs[c] = own.get(c - c % 100, ())[:h] + s[h:]
    assert any(not s for s in seqs.values())
    df = trie.sequences(spark.createDataFrame(talks, TALKS))
    shares = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    built = trie.with_shared_start(df, shares, F.col("conv_id") - F.col("conv_id") % 100, 5)
    assert rows(trie.prefix_trie(built), *COLUMNS) == brute_trie(seqs)


def test_median_insertion_is_balanced():
    assert sorted(trie.median_order(1000)) == list(range(1000))
    tree = trie.Tree()
    for i in trie.median_order(1000):
        tree.insert([i], [1], i)
    deepest, level = 0, [(tree.down[0], 1)]
    while level:
        node, d = level.pop()
        if node >= 0:
            deepest = max(deepest, d)
            level += [(tree.low[node], d + 1), (tree.high[node], d + 1)]
    assert deepest == 10


# --- the Merkle manifest -----------------------------------------------------------------------

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree_of(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def beside(levels, i):
    out = []
    for level in levels[:-1]:
        j = i ^ 1
        out.append((j < i, level[j]) if j < len(level) else None)
        i //= 2
    return out


def brute_manifest(table, claims):
    by = defaultdict(list)
    for row in table:
        by[row[2]].append(row)
    langs = sorted(by, key=lambda v: (v is not None, (v or "").encode()))
    for v in by.values():
        v.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {v: tree_of([leaf(r) for r in by[v]]) for v in langs}
    over = tree_of([trees[v][-1][0] for v in langs])
    out = []
    for k, v in enumerate(langs):
        for i, row in enumerate(by[v]):
            path = beside(trees[v], i) + beside(over, k)
            now = claims(row)
            for step in path:
                now = h(now) if step is None else h(step[1], now) if step[0] else h(now, step[1])
            out.append((row[0], leaf(row), trees[v][-1][0], over[-1][0], [s[1] for s in path if s], now, now == over[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("band", [1, 3, 12])
def test_manifest_equals_brute_force(spark, band):
    r = random.Random(9)
    table = [(i, r.choice(["a", None, "é"]), r.choice([None, "de", "en", "en", "en", "Z", "é", "漢"]), r.choice([None, i]), r.choice([None, "", sentence(4, i)]))
             for i in range(130)]
    table += [(7, "a", "en", 1, "x"), (7, "a", "en", 1, "x"), (None, None, None, None, None), (None, "a", "en", 2, "y"), (500, "s", "one", 1, "z" * 200_000)]
    df = spark.createDataFrame([(d, t, la, s, n) for d, s, la, n, t in table], DOCS).repartition(7)
    tampered = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    chosen = F.col("doc_id") % 3 == 0
    claim = lambda row: leaf((*row[:3], None if row[3] is None else row[3] + 1, row[4]) if row[0] is not None and row[0] % 3 == 0 else row)
    columns = ["doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified"]
    want = brute_manifest(table, claim)
    got = rows(merkle.manifest(df, FIELDS, claimed=F.when(chosen, merkle.digest(tampered)), band=band), *columns)
    assert got == want and {g[-1] for g in got} == {True, False}
    extra = df.select("*", *[F.lit("x").alias(c) for c in ("tree", "id", "leaf", "claimed", "lo", "n", "digest", "root", "value", "rest")])
    assert rows(merkle.manifest(extra, FIELDS, band=band), *columns[:5]) == sorted((w[:5] for w in want), key=repr)


def test_manifest_of_few_rows(spark, edge, empty):
    assert merkle.manifest(empty, FIELDS).count() == 0
    one = merkle.manifest(documents(spark, [(1, "a", "s")]), FIELDS).first()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["proof"] == [] and one["verified"]
    out = merkle.manifest(edge, FIELDS).collect()
    assert len(out) == len(EDGE) and all(r["verified"] for r in out)
