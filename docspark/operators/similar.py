"""The best documents of many sources at once: scores are summed where the documents are, pairs never move."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import postings

#: Documents of a shard and sources of a group, about: what one task holds.
SHARD, GROUP = 1 << 15, 1 << 18
#: Terms that have a number for every document of a shard, at most, and the share of the documents that hold them, at least.
DENSE, DENSE_SHARE = 256, 1 / 32


def best_shared(docs: DataFrame, sources: DataFrame, id: str, documents: Column, n_sources: Column, avg_length: Column,
                worth: Callable, size: int) -> DataFrame:
    """``(source_id, id, _score)``: of every shard of documents the ``size`` best of each source, by the rounded
    score, then by id.

    ``docs`` has ``(id, terms, block)``, rows of one block, id and number of terms counting as one document; ``sources``
    has ``(source_id, terms, weights, need)``, one row for each source. A document scores the sum of weight times
    ``worth(frequency, length, avg_length)`` of the terms that it shares, if it shares ``need`` of
    them. Documents are dealt into shards by a hash of their ids and sources into groups, so that a
    task holds a bounded part of both. Both move as packs in which a term is spelled once, so that a shuffle takes
    a few bytes for each term of a document and, for each shard, of a source.
    """
    def parts(n: Column, of: int) -> Column:
        return F.greatest(F.lit(1), F.ceil(n / of)).cast("int")

    def part(of: Column, n: Column) -> Column:
        return F.pmod(F.xxhash64(of), n).cast("int")

    def all_parts(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    shards, groups = parts(documents, SHARD), parts(n_sources, GROUP)
    dealt = docs.where(F.col(id).isNotNull()).select(part(F.col(id), shards).alias("part"), F.col(id).alias("id"), "block", "terms")
    asked = sources.select(part(F.col("source_id"), groups).alias("part"), "source_id", "terms", "weights", "need")
    dealt = dealt.mapInArrow(in_packs(docs_packs), "part int, pack binary").select(
        F.col("part").alias("shard"), "pack", all_parts(groups).alias("group"))
    asked = asked.mapInArrow(in_packs(source_packs), "part int, pack binary").select(
        F.col("part").alias("group"), "pack", avg_length.cast("double").alias("avg_length"), all_parts(shards).alias("shard"))
    kind = docs.schema[id].dataType
    schema = T.StructType().add("source_id", sources.schema["source_id"].dataType).add(id, kind).add("_score", T.DoubleType())

    def best(held: pa.Table, wanted: pa.Table) -> pa.Table:
        held_, wanted_ = ([opened(x) for x in side["pack"]] for side in (held, wanted))
        if not held_ or not wanted_:
            none = [*held_, *wanted_][0]["id"].slice(0, 0)
            return pa.table([none, none, pa.array([], pa.float64())], ["source_id", id, "_score"])
        avg = wanted["avg_length"][0].as_py()
        return pa.table(best_of_shard(held_, wanted_, lambda tf, length: worth(tf, length, avg), size), ["source_id", id, "_score"])

    return dealt.groupBy("shard", "group").cogroup(asked.groupBy("shard", "group")).applyInArrow(best, schema)


# --- packs ------------------------------------------------------------------------------------------


def sealed(**columns: np.ndarray | pa.Array) -> bytes:
    """Columns of any lengths as compressed bytes."""
    lists = {k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()}
    return postings.sealed(pa.table({k: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for k, v in lists.items()}))


def opened(pack: pa.BinaryScalar) -> dict[str, pa.Array]:
    table = postings.opened(pack)
    return {k: table[k].chunk(0).flatten() for k in table.column_names}


def narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers in as few bytes as all of them fit in."""
    ends = (values.min(), values.max()) if len(values) else (0, 0)
    return values.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if all(np.iinfo(t).min <= x <= np.iinfo(t).max for x in ends)))


def in_packs(packs: Callable[[pa.Table], Iterator[tuple[int, bytes]]]) -> Callable:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, pack in packs(pa.Table.from_batches([batch])):
                yield postings.one_pack(part, pack)

    return each


def docs_packs(docs: pa.Table) -> Iterator[tuple[int, bytes]]:
    """Packs of documents: ids, blocks, lengths and numbers of distinct terms, then for each of these its
    place in ``terms``, as the difference to the one before, and how often the document has it."""
    joined = not pa.types.is_list(docs["terms"].type)
    if joined:
        docs = docs.filter(pc.greater(pc.binary_length(docs["terms"]), 0))
        length = pc.add(pc.count_substring(docs["terms"], " "), 1)
    else:
        docs = docs.filter(pc.greater(pc.list_value_length(docs["terms"]), 0))
        length = pc.list_value_length(docs["terms"])
    for some in postings.groups(docs.append_column("doc_len", pc.cast(length, pa.int64())), postings.PACKED):
        order, parts = postings.by_part(some["part"].to_numpy())
        ids, block, length = some["id"].combine_chunks(), some["block"].to_numpy()[order], some["doc_len"].to_numpy()
        each = pc.split_pattern(some["terms"], " ") if joined else some["terms"]
        terms = pa.concat_arrays([c.flatten() for c in each.chunks]).dictionary_encode("encode")
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        key = np.sort(np.repeat(number << 32, length) | terms.indices.to_numpy())
        one = postings.starts(key)
        tf, key, length = np.diff(np.append(one, len(key))), key[one], length[order]
        code, distinct = key & 0xFFFFFFFF, np.bincount(key >> 32, minlength=len(order))
        ends = np.append(0, np.cumsum(distinct))
        for part, a, b in parts:
            mine = code[ends[a]:ends[b]]
            spoken = np.zeros(len(terms.dictionary), bool)
            spoken[mine] = True
            at = (np.cumsum(spoken) - 1)[mine]
            yield part, sealed(
                id=ids.take(pa.array(order[a:b])), block=block[a:b], length=narrow(length[a:b]), distinct=narrow(distinct[a:b]),
                terms=terms.dictionary.take(pa.array(np.flatnonzero(spoken))), step=narrow(np.diff(at, prepend=0)),
                tf=narrow(tf[ends[a]:ends[b]]))


def source_packs(sources: pa.Table) -> Iterator[tuple[int, bytes]]:
    """Packs of sources: ids, needs and numbers of terms, then for each of these its place among the distinct terms and weights."""
    order, parts = postings.by_part(sources["part"].to_numpy())
    for part, a, b in parts:
        some = sources.take(pa.array(order[a:b]))
        lists, weights = some["terms"].combine_chunks(), some["weights"].combine_chunks().flatten().to_numpy()
        terms = lists.flatten().dictionary_encode()
        weight, nth = np.unique(weights, return_inverse=True)
        pair, at = np.unique(terms.indices.to_numpy().astype(np.int64) * max(1, len(weight)) + nth, return_inverse=True)
        yield part, sealed(
            id=some["source_id"].combine_chunks(), need=narrow(some["need"].to_numpy()),
            n=narrow(pc.list_value_length(lists).to_numpy()), at=narrow(at),
            terms=terms.dictionary.take(pa.array(pair // max(1, len(weight)))), weight=weight[pair % max(1, len(weight))])


# --- a shard ------------------------------------------------------------------------------------------


def wanted_postings(packs: list[dict[str, pa.Array]], terms: pa.Array, worth: Callable) -> tuple:
    """Ids in order; then, sorted by term and id, which term, which id, its worth and how many documents it is of."""
    ids = pa.concat_arrays([p["id"] for p in packs]).dictionary_encode()
    sorted_ = pc.sort_indices(ids.dictionary)
    place = np.empty(len(sorted_), np.int64)
    place[sorted_.to_numpy()] = np.arange(len(place))
    of, length = place[ids.indices.to_numpy()], np.concatenate([p["length"].to_numpy().astype(np.int64) for p in packs])
    block = np.concatenate([p["block"].to_numpy() for p in packs])
    order = np.lexsort((length, block, of))
    own = postings.starts(of[order], block[order], length[order])  # rows that count as one document
    unit = np.empty(len(of), np.int64)
    unit[order] = np.repeat(np.arange(len(own)), np.diff(np.append(own, len(order))))
    of, length = of[order][own], length[order][own].astype(float)
    code_of = pc.fill_null(pc.index_in(pa.concat_arrays([p["terms"] for p in packs]), value_set=terms), -1).to_numpy()
    keys, tfs, row, name = [], [], 0, 0
    for p in packs:
        code = code_of[name + np.cumsum(p["step"].to_numpy(), dtype=np.int64)]
        docs = np.repeat(unit[row:row + len(p["id"])], p["distinct"].to_numpy())
        asked = code >= 0
        keys.append(code[asked].astype(np.int64) << 32 | docs[asked])
        tfs.append(p["tf"].to_numpy()[asked].astype(np.int32))
        row, name = row + len(p["id"]), name + len(p["terms"])
    key, tf = np.concatenate(keys), np.concatenate(tfs)
    del keys, tfs
    if not len(key):
        return ids.dictionary.take(sorted_), key, key, np.array([]), key
    order = np.argsort(key)
    key, tf = key[order], tf[order]
    one = postings.starts(key)
    key, tf = key[one], np.add.reduceat(tf, one, dtype=np.int64)
    code, docs = key >> 32, key & 0xFFFFFFFF
    value, docs = worth(tf.astype(float), length[docs]), of[docs]
    one = postings.starts(code, docs)  # more than one document where ids repeat
    return ids.dictionary.take(sorted_), code[one], docs[one], np.add.reduceat(value, one), np.diff(np.append(one, len(code)))


def best_of_shard(packs: list[dict[str, pa.Array]], sources: list[dict[str, pa.Array]], worth: Callable, size: int) -> list[pa.Array]:
    """Ids of sources, ids of documents and scores.

    For each source the documents are counted that share its terms, and scores are summed up for those that share enough.
    What many documents hold is kept as a number for every document, which spares looking up where to add.
    """
    spelled = pa.concat_arrays([s["terms"] for s in sources])
    terms = spelled.unique()
    term_of, weight = pc.index_in(spelled, value_set=terms).to_numpy(), np.concatenate([s["weight"].to_numpy() for s in sources])
    ids, code, doc, value, held = wanted_postings(packs, terms, worth)
    begin = np.searchsorted(code, np.arange(len(terms) + 1))
    n, many = len(ids), np.diff(begin)
    most = max(int(s["n"].to_numpy().max(initial=0)) for s in sources) * int(held.max(initial=0))
    counter = np.uint8 if most < 256 else np.int64
    held = held.astype(counter)
    dense = np.argsort(-many, kind="stable")[:DENSE]
    dense = dense[many[dense] > n * DENSE_SHARE]
    row = np.full(len(terms), -1)
    row[dense] = np.arange(len(dense))
    values, counts = np.zeros((len(dense), n)), np.zeros((len(dense), n), counter)
    for i, t in enumerate(dense):
        at = doc[begin[t]:begin[t + 1]]
        values[i, at], counts[i, at] = value[begin[t]:begin[t + 1]], held[begin[t]:begin[t + 1]]
    every = pa.concat_arrays([s["id"] for s in sources])
    selves = pc.fill_null(pc.index_in(every, value_set=ids), -1).to_numpy()
    needs = np.concatenate([s["need"].to_numpy() for s in sources]).tolist()
    out: tuple[list, list, list] = ([], [], [])
    nr = pairs = 0
    for s in sources:
        at, ends = s["at"].to_numpy().astype(np.int64) + pairs, np.append(0, np.cumsum(s["n"].to_numpy(), dtype=np.int64))
        pairs += len(s["terms"])
        for a, b in zip(ends[:-1], ends[1:]):
            term, own = term_of[at[a:b]], weight[at[a:b]]
            rows = row[term]
            some, score = np.zeros(n, counter), np.zeros(n)
            for t, w in zip(term[rows < 0].tolist(), own[rows < 0].tolist()):
                lo, hi = begin[t], begin[t + 1]
                score[doc[lo:hi]] += w * value[lo:hi]
                some[doc[lo:hi]] += held[lo:hi]
            kept = list(zip(rows[rows >= 0].tolist(), own[rows >= 0].tolist()))
            for i, _ in kept:
                some += counts[i]
            if selves[nr] >= 0:
                some[selves[nr]] = 0
            found = np.flatnonzero(some >= max(needs[nr], 1))
            score = score[found]
            for i, w in kept:
                score += w * values[i].take(found)
            if len(found) > size:
                near = score >= np.partition(score, len(found) - size)[len(found) - size] - 2e-9  # what may round to the same
                found, score = found[near], score[near]
                first = np.lexsort((found, -np.round(score, 9)))[:size]
                found, score = found[first], score[first]
            out[0].append(np.full(len(found), nr))
            out[1].append(found)
            out[2].append(score)
            nr += 1
    source, doc, score = (np.concatenate(x) for x in out)
    return [every.take(pa.array(source)), ids.take(pa.array(doc)), pa.array(score)]
