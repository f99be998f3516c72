"""Blocks of positional postings, made in the tasks that read the documents and sent by term."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of the batches that tasks give back.
BATCH = 1 << 14
#: Terms of the documents that are packed at once, in whole blocks: what a task holds.
PACKED = 1 << 22


def is_joined(docs: DataFrame) -> bool:
    """Whether ``terms`` is one string with a space between any two terms, else an array."""
    return docs.schema["terms"].dataType == T.StringType()


def term_array(docs: DataFrame) -> Column:
    return F.split("terms", " ") if is_joined(docs) else F.col("terms")


def doc_len(docs: DataFrame) -> Column:
    """The number of terms; null or less than 1 where there is none."""
    if not is_joined(docs):
        return F.size("terms").cast("long")
    spaces = F.octet_length("terms") - F.octet_length(F.replace("terms", F.lit(" "), F.lit("")))
    return F.when(F.octet_length("terms") > 0, spaces + 1).cast("long")


def cuts(docs: DataFrame, block_bits: int, total: int, parts: int, sampled: int) -> list[tuple[str, int]]:
    """The (term, block) where each range but the first begins, ranges having about as many places of terms each.

    Of ``total`` places of terms one in so many is looked at, from a start that hangs on the document; nothing is packed for it.
    About ``parts * sampled`` (term, block) reach the driver.
    """
    if parts < 2:
        return []
    step = max(1, total // (parts * sampled))
    nr = F.monotonically_increasing_id()
    rows = docs.select(F.shiftright(nr, block_bits).alias("block"), "terms", "doc_len", F.pmod(F.xxhash64(nr), F.lit(step)).alias("at"))
    some = rows.where("at < doc_len").select(F.explode(F.filter(term_array(docs), lambda t, i: i % step == F.col("at"))).alias("term"), "block")
    held = sorted(tuple(r) for r in some.collect())  # a few MB: a sort in Spark would read all documents twice
    return [held[i * len(held) // parts] for i in range(1, parts)] if held else []


def range_of(terms: list[str], blocks: np.ndarray, cut: Sequence[tuple[str, int]]) -> np.ndarray:
    """The number of the range of each (term, block)."""
    names = [t for t, _ in cut]
    first, last = (np.array([f(names, t) for t in terms], np.int32) for f in (bisect_left, bisect_right))
    for i in np.flatnonzero(first < last):  # terms that a range begins within
        first[i] = bisect_right(cut, (terms[i], int(blocks[i])), first[i], last[i])
    return first


def packed(docs: DataFrame, block_bits: int, cut: Sequence[tuple[str, int]] = ()) -> DataFrame:
    """``(part, pack)`` of ``(id, doc_len, terms)``: sealed rows ``(term, block, ids, rest)``, one for each term of the documents of a batch.

    Documents are numbered as they are read; those that follow each other are a block. A row has the
    documents of a term in some blocks, ``block`` being the first. ``rest`` has for each document how many
    blocks later it is, then for each how often it has the term, then their lengths, then the
    places of the term in all of them: the bytes of 32-bit numbers. ``part`` is the range that (term, block) is in: what a
    batch has for it moves as one value, compressed as a whole.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            if not table.num_rows:
                continue
            numbers = table["block"].to_numpy()
            whole = int(np.searchsorted(numbers, numbers[-1]))  # the last block may go on in the next batch
            for some in groups(table.slice(0, whole), PACKED):
                yield from parted(pack(some, cut))
            held = table.slice(whole)
        if held is not None:
            yield from parted(pack(held, cut))

    nr = F.shiftright(F.monotonically_increasing_id(), block_bits)
    return docs.select(nr.alias("block"), "id", "doc_len", "terms").mapInArrow(each, "part int, pack binary")


def sealed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def opened(pack: pa.BinaryScalar) -> pa.Table:
    return pa.ipc.open_stream(pack.as_buffer()).read_all()


def parted(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """``(part, pack)``, the rows of each part sealed."""
    order, parts = by_part(rows["part"].to_numpy())
    rows = rows.drop_columns("part").take(pa.array(order))
    for part, a, b in parts:
        yield one_pack(part, sealed(rows.slice(a, b - a)))


def one_pack(part: int, pack: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([pack], pa.binary())], ["part", "pack"])


def by_part(parts: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order that brings rows of a part together, and each part with where it begins and ends."""
    order = np.argsort(parts, kind="stable")
    first = starts(parts[order]) if len(parts) else np.array([], int)
    return order, [(int(parts[order[a]]), int(a), int(b)) for a, b in zip(first, [*first[1:], len(parts)])]


def groups(docs: pa.Table, most: int) -> Iterator[pa.Table]:
    """Documents in groups of whole blocks, each with at most so many terms and a block."""
    if docs.num_rows:
        first, length = starts(docs["block"].to_numpy()), docs["doc_len"].to_numpy()
        at = first[starts((np.cumsum(length) - length)[first] // most)]
        for a, b in zip(at, [*at[1:], docs.num_rows]):
            yield docs.slice(a, b - a)


def unpacked(rows: DataFrame, id: T.DataType) -> DataFrame:
    """``(term, block, n, freq, max_tf, min_len, entries, positions)`` of the packs of a partition, in the order of (term, block)."""
    long = T.LongType()
    entry = T.StructType().add("id", id).add("tf", long).add("doc_len", long)
    schema = (T.StructType().add("term", T.StringType()).add("block", long).add("n", long).add("freq", long).add("max_tf", long)
              .add("min_len", long).add("entries", T.ArrayType(entry)).add("positions", T.ArrayType(T.ArrayType(T.IntegerType()))))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [opened(x) for batch in batches for x in batch["pack"]]
        if held:
            table = pa.concat_tables(held).combine_chunks()
            held.clear()
            table = table.take(pc.sort_indices(table, [("term", "ascending"), ("block", "ascending")])).combine_chunks()
            for batch in table.to_batches(BATCH):
                yield from unpack(batch).to_batches(BATCH)

    return rows.mapInArrow(each, schema)


def starts(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new)


def lists(at: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(at, len(values)), pa.int32()), values)


def numbers(at: np.ndarray, values: np.ndarray) -> pa.Array:
    """32-bit numbers as bytes, a row from each start on."""
    ends = np.append(at, len(values)).astype(np.int64) * 4
    if ends[-1] >= 1 << 31:
        raise ValueError("documents of a block have too many terms")
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)])


def within(sizes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each row, from ``first`` on, as many numbers as its size."""
    return np.arange(sizes.sum()) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)


def pack(docs: pa.Table, cut: Sequence[tuple[str, int]] = ()) -> pa.Table:
    """All places of terms sorted by term, document and place, cut where the term changes."""
    block, length = docs["block"].to_numpy(), docs["doc_len"].to_numpy()
    ids = docs["id"].combine_chunks()
    each = docs["terms"] if pa.types.is_list(docs["terms"].type) else pc.split_pattern(docs["terms"], " ")
    terms = pa.concat_arrays([c.flatten() for c in each.chunks]).dictionary_encode("encode")
    code, place = terms.indices.to_numpy(), within(length, np.zeros(len(length), int))
    own = starts(block, length, ids.dictionary_encode("encode").indices.to_numpy())  # rows of one id and length count as one
    number = np.zeros(len(length), int)
    number[own[1:]] = 1
    doc = np.repeat(np.cumsum(number), length)
    # documents and places are in order, but for rows that are taken together
    order = np.argsort(code, kind="stable") if len(own) == len(length) else np.lexsort((place, doc, code))
    code, doc, place = code[order], doc[order], place[order]
    block, length, ids = block[own], length[own], ids.take(pa.array(own))
    one = starts(code, doc)  # a document of a term
    code, doc, tf = code[one], doc[one], np.diff(np.append(one, len(place)))
    row = starts(code)
    n, freq, first = np.diff(np.append(row, len(one))), np.add.reduceat(tf, row), block[doc[row]]
    size = 3 * n + freq
    at = np.cumsum(size) - size
    rest = np.empty(size.sum(), np.int32)
    rest[within(n, at)] = block[doc] - np.repeat(first, n)
    rest[within(n, at + n)] = tf
    rest[within(n, at + 2 * n)] = length[doc]
    rest[within(freq, at + 3 * n)] = place
    term = terms.dictionary.take(pa.array(code[row]))
    return pa.table([pa.array(range_of(term.to_pylist(), first, cut)), term, pa.array(first), lists(row, ids.take(pa.array(doc))),
                     numbers(at, rest)], ["part", "term", "block", "ids", "rest"])


def unpack(batch: pa.RecordBatch) -> pa.Table:
    """The rows of (term, block) that packed rows hold."""
    ids, held = batch["ids"], batch["rest"].buffers()
    n = np.diff(ids.offsets.to_numpy()).astype(int)
    ends = np.frombuffer(held[1], np.int32)[batch["rest"].offset:][:batch.num_rows + 1] // 4
    size = np.diff(ends).astype(int)
    at, rest, freq = np.cumsum(size) - size, np.frombuffer(held[2], np.int32, ends[-1])[ends[0]:], size - 3 * n
    block = np.repeat(batch["block"].to_numpy(), n) + rest[within(n, at)]
    tf, length = (rest[within(n, at + k * n)].astype(int) for k in (1, 2))
    places = lists(np.cumsum(tf) - tf, pa.array(rest[within(freq, at + 3 * n)]))
    of = np.repeat(np.arange(len(n)), n)
    row = starts(of, block)
    entries = pa.StructArray.from_arrays([ids.flatten(), pa.array(tf), pa.array(length)], ["id", "tf", "doc_len"])
    return pa.table([
        batch["term"].take(pa.array(of[row])), pa.array(block[row]), pa.array(np.diff(np.append(row, len(of)))),
        pa.array(np.add.reduceat(tf, row)), pa.array(np.maximum.reduceat(tf, row)), pa.array(np.minimum.reduceat(length, row)),
        lists(row, entries), lists(row, places)],
        ["term", "block", "n", "freq", "max_tf", "min_len", "entries", "positions"])
