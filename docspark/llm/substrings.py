"""Substring deduplication: Rabin-Karp hashes of every window of words, counted in Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The odd base of the rolling polynomial, modulo 2**64; the digits are 64-bit word hashes.
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Windows whose hashes are held at a time: of one block of documents, and of one bucket.
BLOCK, BUCKET = 1 << 20, 1 << 20
#: Bytes of text in one range of ids.
RANGE_BYTES = 8 << 20


def words_of(text: str | None) -> list[bytes]:
    """Words between the ASCII white space characters, unchanged."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def window_hashes(words: list[bytes], width: int) -> np.ndarray:
    """The Rabin-Karp hash of every window of ``width`` words, in order."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    digits = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    hashes = digits[:n].copy()
    for j in range(1, width):
        hashes *= BASE
        hashes += digits[j:j + n]
    return hashes


def pack(hashes: np.ndarray) -> bytes:
    """Sorted distinct hashes: the first one, then their differences in as few bytes as do."""
    steps = np.diff(hashes)
    size = (int(steps.max()).bit_length() + 7) // 8 if len(steps) else 1
    low = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]
    return bytes([size]) + hashes[:1].astype("<u8").tobytes() + low.tobytes()


def unpack(data: bytes) -> np.ndarray:
    size = data[0]
    low = np.frombuffer(data, np.uint8, offset=9).reshape(-1, size)
    steps = np.zeros((len(low), 8), np.uint8)
    steps[:, :size] = low
    whole = np.concatenate([np.frombuffer(data, "<u8", 1, 1), steps.view("<u8").ravel()])
    return np.cumsum(whole, dtype=np.uint64)


def blocks(rows: Iterator[tuple[int, int, str | None]], width: int):
    """``(chunk, ids, words, hashes)`` of runs of documents, in ascending order of ids.

    A block ends where it has ``BLOCK`` windows and the id changes, or with its chunk: the
    same documents always make the same blocks. Its name is its first id.
    """
    chunk, ids, words, hashes, held = None, [], [], [], 0
    for at, key, text in rows:
        if ids and (at != chunk or held >= BLOCK and key != ids[-1]):
            yield chunk, ids, words, hashes
            ids, words, hashes, held = [], [], [], 0
        split = words_of(text)
        chunk = at
        ids.append(key)
        words.append(split)
        hashes.append(window_hashes(split, width))
        held += len(hashes[-1])
    if ids:
        yield chunk, ids, words, hashes


def starts_of_ranges(docs: DataFrame, id: str, n: int) -> np.ndarray:
    """The least id of each of about ``n`` ranges with as many rows: one number per range."""
    ranges = docs.select(id).where(F.col(id).isNotNull()).repartitionByRange(n, id)
    rows = ranges.groupBy(F.spark_partition_id()).agg(F.min(id).alias("first")).select("first").collect()
    return np.array(sorted(r[0] for r in rows), np.int64)


def without_repeats(docs: DataFrame, *, text: str = "text", id: str = "doc_id", width: int = 13,
                    most_ranges: int = 200_000) -> DataFrame:
    """``(id, n_words, removed, kept)``: what stays of each document without repeated passages.

    A word goes if a window of ``width`` words that covers it also starts in a document with a
    smaller id; windows are judged on the input. ``removed`` lists the maximal intervals of word
    positions ``(start, end)``, end exclusive, ``kept`` joins the other words by one blank.

    Ids are dealt into ranges (at most ``most_ranges``, of which one id each reaches the driver),
    so that of two ranges one lies wholly before the other. A block of a range sends its
    distinct window hashes once, sorted, by the first bits of the hash; where a hash comes from
    several blocks, all but the first get it back as one bit of a mask. What a block repeats of
    its own documents it finds itself. So a passage that a third of all documents hold is sent
    once per block, and no window travels with an id. Hashes have 64 bits: of 10**13 windows
    about one in two million meets another by chance.

    Null and empty texts have no words, and a text shorter than a window loses none. Rows with
    one id don't count as repeats of each other. A row without an id is before and behind
    none: it keeps all words. Repeated rows stay rows; other columns are not looked at.
    """
    schema = "id long, n_words long, removed array<struct<start: long, end: long>>, kept string"
    kept = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    total = kept.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = min(max(1, -(-total // RANGE_BYTES)), most_ranges)
    starts = starts_of_ranges(kept, "id", n)
    bits = max(0, (total // 6 // BUCKET).bit_length())

    @F.pandas_udf("int")
    def chunk_of(ids):
        return ids.map(lambda i: int(np.searchsorted(starts, i, "right")) - 1)

    placed = (kept.where(F.col("id").isNotNull()).withColumn("chunk", chunk_of("id"))
              .repartition(n, "chunk"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((c.as_py(), i.as_py(), t.as_py()) for b in batches for c, i, t in zip(b["chunk"], b["id"], b["text"]))
        for chunk, ids, _, hashes in blocks(rows, width):
            found = np.unique(np.concatenate(hashes))
            if not len(found):
                continue
            buckets = (found >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(found), np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(found)]
            parts = list(zip(cuts, cuts[1:]))
            yield pa.RecordBatch.from_arrays([
                pa.array([int(buckets[a]) for a, _ in parts], pa.int32()), pa.array([chunk] * len(parts), pa.int32()),
                pa.array([ids[0]] * len(parts), pa.int64()), pa.array([pack(found[a:b]) for a, b in parts], pa.binary())],
                ["bucket", "chunk", "block", "hashes"])

    sent = placed.sortWithinPartitions("chunk", "id").select("chunk", "id", "text").mapInArrow(
        send, "bucket int, chunk int, block long, hashes binary")

    def count(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        each = [unpack(x.as_py()) for x in table["hashes"]]
        every = np.concatenate(each)
        order = np.argsort(every, kind="stable")  # earlier blocks first
        again = np.zeros(len(every), bool)
        again[order[1:]] = every[order[1:]] == every[order[:-1]]
        ends = np.cumsum([len(x) for x in each])
        masks = [np.packbits(m).tobytes() for m in np.split(again, ends[:-1])]
        return pa.table([table["chunk"], table["block"], table["bucket"], pa.array([len(x) for x in each], pa.int64()),
                         pa.array(masks, pa.binary())], ["chunk", "block", "bucket", "n", "mask"])

    # a bucket holds a hash once per block at most: near BUCKET hashes by construction
    replies = sent.groupBy("bucket").applyInArrow(count, "chunk int, block long, bucket int, n long, mask binary")

    def cut(docs: pa.Table, masks: pa.Table) -> pa.Table:
        docs = docs.sort_by("id")
        known: dict[int, list] = {}
        for row in masks.sort_by([("block", "ascending"), ("bucket", "ascending")]).to_pylist():
            known.setdefault(row["block"], []).append(np.unpackbits(np.frombuffer(row["mask"], np.uint8),
                                                                    count=row["n"]).astype(bool))
        out: list[tuple] = []
        rows = ((0, i.as_py(), t.as_py()) for i, t in zip(docs["id"], docs["text"]))
        for _, ids, words, hashes in blocks(rows, width):
            every = np.concatenate(hashes)
            found, first, which = np.unique(every, return_index=True, return_inverse=True)
            before = np.concatenate(known[ids[0]]) if len(found) else np.empty(0, bool)
            rank = np.cumsum([0] + [a != b for a, b in zip(ids, ids[1:])])  # of the id
            of = np.repeat(rank, [len(h) for h in hashes])
            # `first` is the first place of a hash, so of the least id in the block
            gone = before[which] | (of > of[first][which]) if len(every) else np.empty(0, bool)
            at = 0
            for key, split, h in zip(ids, words, hashes):
                out.append((key, *reduced(split, gone[at:at + len(h)], width)))
                at += len(h)
        columns = list(zip(*out)) if out else [[], [], [], []]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                         pa.array(columns[2], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                         pa.array(columns[3], pa.string())], ["id", "n_words", "removed", "kept"])

    judged = placed.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        lambda docs, masks: cut(docs.select(["id", "text"]), masks), schema)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = [reduced(words_of(t.as_py()), np.empty(0, bool), width) for t in b["text"]]
            yield pa.RecordBatch.from_arrays([
                b["id"], pa.array([e[0] for e in each], pa.int64()),
                pa.array([e[1] for e in each], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array([e[2] for e in each], pa.string())], ["id", "n_words", "removed", "kept"])

    nameless = kept.where(F.col("id").isNull()).mapInArrow(whole, schema)
    return judged.union(nameless).withColumnRenamed("id", id)


def reduced(words: list[bytes], gone: np.ndarray, width: int) -> tuple[int, list[dict], str]:
    """Number of words, the merged intervals of the windows that are ``gone``, the other words."""
    places = np.flatnonzero(gone)
    if not len(places):
        return len(words), [], b" ".join(words).decode("utf-8", "surrogatepass")
    breaks = np.flatnonzero(np.diff(places) > width)
    begin = places[np.concatenate([[0], breaks + 1])].tolist()
    end = (places[np.concatenate([breaks, [len(places) - 1]])] + width).tolist()
    kept, at = [], 0
    for a, b in zip(begin, end):
        kept += words[at:a]
        at = b
    kept += words[at:]
    return len(words), [{"start": a, "end": b} for a, b in zip(begin, end)], b" ".join(kept).decode("utf-8", "surrogatepass")
