"""Benchmark decontamination: a BM25 index of test items, block-max bounds, verified overlap."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .toxicity import words_of

#: BM25 parameters.
K1, B = 1.2, 0.75
#: Items whose largest impacts are kept together in a block of a posting list.
PER_BLOCK = 8
#: Texts searched at a time.
TOGETHER = 64
LEAK = "array<struct<item_id: long, score: double, question: double, answer: double, word: long>>"


def parts(text: str) -> tuple[list[bytes], list[bytes]]:
    """Words of the question and of the answer of an item.

    The answer is the last sentence; of a single sentence it is the last quarter of the words.
    """
    pieces = [w for w in (words_of(p) for p in re.split(r"(?<=[.!?])\s+|\n+", text)) if w]
    if len(pieces) > 1:
        return [w for p in pieces[:-1] for w in p], pieces[-1]
    words = pieces[0] if pieces else []
    cut = len(words) - max(1, len(words) // 4)
    return words[:cut], words[cut:]


def shingles(words: list[bytes], width: int) -> set[tuple[bytes, ...]]:
    """All runs of ``width`` words; fewer words are one run, none gives none."""
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


class Index:
    """Postings of test items with BM25 impacts, each as a share of the item's score for itself.

    So a passage that holds all words of an item scores 1 for it. ``items`` are bounded by
    ``search``, which makes several indexes of more.
    """

    def __init__(self, items: list[tuple[int, str]], least: float, width: int):
        self.width, self.least = width, least
        kept = [(i, *parts(t or "")) for i, t in items]
        kept = [(i, q, a) for i, q, a in kept if q or a]
        self.ids = [i for i, _, _ in kept]
        self.questions = [shingles(q, width) for _, q, _ in kept]
        self.answers = [set(a) for _, _, a in kept]
        bags: list[dict[bytes, int]] = []
        for _, q, a in kept:
            bag: dict[bytes, int] = {}
            for w in q + a:
                bag[w] = bag.get(w, 0) + 1
            bags.append(bag)
        lengths = np.array([sum(b.values()) for b in bags], float)
        #: half a passage; any run of words as long as an item lies in one passage
        self.stride = int(lengths.max()) if len(lengths) else 1
        df: dict[bytes, int] = {}
        for b in bags:
            for w in b:
                df[w] = df.get(w, 0) + 1
        order = sorted(df, key=lambda w: (df[w], w))  # rare terms first
        self.terms = {w: t for t, w in enumerate(order)}
        idf = np.log1p((len(bags) - np.array([df[w] for w in order]) + 0.5) / (np.array([df[w] for w in order]) + 0.5))
        item_terms, item_shares = [np.empty(0, np.int64)], [np.empty(0)]
        postings: list[dict[int, float]] = [{} for _ in order]
        for n, b in enumerate(bags):
            t = np.array([self.terms[w] for w in b])
            tf = np.array(list(b.values()), float)
            impact = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[n] / lengths.mean()))
            share = impact / impact.sum()
            item_terms.append(t)
            item_shares.append(share)
            for term, s in zip(t.tolist(), share.tolist()):
                block = n // PER_BLOCK
                postings[term][block] = max(postings[term].get(block, 0.0), s)
        self.item_start = np.cumsum([0, *map(len, bags)])
        self.item_terms, self.item_shares = np.concatenate(item_terms), np.concatenate(item_shares)
        self.n_blocks = -(-len(bags) // PER_BLOCK)
        # common terms, from the end of the order, whose bounds together stay under half the
        # threshold in every block: a passage without a rarer term can reach no item
        common, first = np.zeros(self.n_blocks), len(order)
        while first:
            more = common.copy()
            for block, s in postings[first - 1].items():
                more[block] += s
            if more.max() >= least / 2:
                break
            common, first = more, first - 1
        self.first_common, self.common = first, common
        self.start = np.cumsum([0, *map(len, postings)])
        self.block = np.array([b for p in postings for b in p], np.int64)
        self.bound = np.array([s for p in postings for s in p.values()])

    def candidates(self, passage: np.ndarray, term: np.ndarray) -> list[tuple[int, int]]:
        """``(passage, block)`` whose block maxima reach the threshold, of rows (passage, term)."""
        size = len(self.start)
        key = np.unique(passage * size + term)
        passage, term = key // size, key % size
        rare = term < self.first_common
        bounds, where = self.sums(passage[rare], term[rare])
        hopeful = bounds + self.common[where % self.n_blocks] >= self.least
        where, bounds = where[hopeful], bounds[hopeful]
        if not len(where):
            return []
        some = np.isin(passage, where // self.n_blocks) & ~rare
        extra, also = self.sums(passage[some], term[some])
        if len(also):
            at = np.minimum(np.searchsorted(also, where), len(also) - 1)
            bounds = bounds + np.where(also[at] == where, extra[at], 0.0)
        return [divmod(w, self.n_blocks) for w in where[bounds >= self.least - 1e-9].tolist()]

    def sums(self, passage: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of block maxima of each passage and block that a posting joins, sorted."""
        n = self.start[term + 1] - self.start[term]
        at = np.repeat(self.start[term] - np.cumsum(n) + n, n) + np.arange(n.sum())
        where, which = np.unique(np.repeat(passage, n) * self.n_blocks + self.block[at], return_inverse=True)
        return np.bincount(which, self.bound[at], len(where)) if len(where) else np.empty(0), where

    def search(self, texts: list[str | None], overlap: float) -> list[list[dict]]:
        """For each text every item that one of its passages scores the threshold for and that is
        verified there: its best passage.

        Passage p of a text has the words of its strides p and p + 1, so a run of a stride's
        length lies in one of them; a text of one stride is one passage.
        """
        texts = [words_of(t) for t in texts]
        if not self.ids:
            return [[] for _ in texts]
        get, seen, passages, terms, owner, first = self.terms.get, [], [], [], [], []
        for n, words in enumerate(texts):
            known = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
            places = np.flatnonzero(known >= 0)
            seen.append(known)
            last = max(0, (len(words) - 1) // self.stride - 1)
            segments = places // self.stride
            passages += [len(owner) + np.minimum(segments, last), len(owner) + np.maximum(segments - 1, 0)]
            terms += [known[places]] * 2
            first += [len(owner)] * (last + 1)
            owner += [n] * (last + 1)
        found: list[dict[int, dict]] = [{} for _ in texts]
        at, present = None, np.zeros(len(self.terms), bool)
        for passage, block in self.candidates(np.concatenate(passages), np.concatenate(terms)):
            if at != passage:
                at, best = passage, found[owner[passage]]
                begin = (passage - first[passage]) * self.stride
                span, runs = texts[owner[passage]][begin:begin + 2 * self.stride], None
                held = seen[owner[passage]][begin:begin + 2 * self.stride]
                present[:] = False
                present[held[held >= 0]] = True
            lo = block * PER_BLOCK
            cuts = self.item_start[lo:lo + PER_BLOCK + 1]
            held = np.where(present[self.item_terms[cuts[0]:cuts[-1]]], self.item_shares[cuts[0]:cuts[-1]], 0.0)
            scores = np.add.reduceat(held, cuts[:-1] - cuts[0])
            for k in np.flatnonzero(scores >= self.least).tolist():
                if runs is None:
                    runs, vocabulary = set().union(*(shingles(span, w) for w in range(1, self.width + 1))), set(span)
                q, a = share(self.questions[lo + k], runs), share(self.answers[lo + k], vocabulary)
                new = {"item_id": self.ids[lo + k], "score": float(scores[k]), "question": q, "answer": a, "word": begin}
                if min(q, a) >= overlap and rank(new) > rank(best.get(lo + k)):
                    best[lo + k] = new
        return [[best[n] for n in sorted(best)] for best in found]


def rank(leak: dict | None) -> tuple[float, float]:
    return (min(leak["question"], leak["answer"]), leak["score"]) if leak else (-1.0, 0.0)


def share(wanted: set, there: set) -> float:
    return len(wanted & there) / len(wanted) if wanted else 1.0


def leaks(items: DataFrame, text: Column, *, item_id: str = "item_id", item_text: str = "text",
          least: float = 0.5, overlap: float = 0.8, width: int = 5, per_index: int = 20_000) -> Column:
    """A column with the test items that a text holds, ``[]`` if none: item, BM25 share, overlaps
    of question and answer, and the first word of the best passage.

    Every passage of every text is a query: two strides of words, each as long as the longest
    item. Block-max bounds over the posting lists leave the passages and blocks of items that can
    score ``least``, and those are scored exactly; so all items above it are retrieved. A hit is
    verified: ``overlap`` of the runs of ``width`` words of the question, and of the words of
    the answer, are in the passage.

    Items travel to the tasks in indexes of ``per_index`` at most; more items make more
    indexes and one pass of each text for each. Null and empty texts and items, and texts without
    any known word, give nothing. Repeated items are reported one by one.
    """
    table = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).where("t is not null")
    n = max(1, -(-table.count() // per_index))
    found = []
    for k in range(n):
        # one bounded block of test items
        rows = table.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect() if n > 1 else table.collect()
        index = Index(sorted((r["i"] if r["i"] is not None else -1, r["t"]) for r in rows), least, width)
        found.append(searcher(index, overlap)(text))
    return F.concat(*found) if len(found) > 1 else found[0]


def searcher(index: Index, overlap: float):
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question", pa.float64()),
                               ("answer", pa.float64()), ("word", pa.int64())]))

    @F.arrow_udf(LEAK)
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            each = texts.to_pylist()
            yield pa.array([x for at in range(0, len(each), TOGETHER) for x in index.search(each[at:at + TOGETHER], overlap)],
                           kind)

    return search


def contaminated(docs: DataFrame, items: DataFrame, *, text: str = "text", id: str = "doc_id", **how) -> DataFrame:
    """``(id, item_id, score, question, answer, word)`` of every verified leak.

    A document without one has no row; repeated rows are reported one by one, and so is a null
    id. Columns besides ``id`` and ``text`` are not looked at.
    """
    found = docs.select(F.col(id), leaks(items, F.col(text), **how).alias("_leaks"))
    return found.select(id, F.explode("_leaks").alias("_leak")).select(id, "_leak.*")
