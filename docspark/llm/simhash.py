"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pinned

BITS, RADIUS = 64, 2
#: Shingles whose bits are counted at a time.
BLOCK = 1 << 18


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """The SimHash of the shingles of ``width`` words, repeats included, as unsigned number.

    A to Z are lowered; a text with fewer words is one shingle; one without has 0.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = ends - [len(w) + 1 for w in words]
    k = min(width, len(words))
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    n, ones = len(words) - k + 1, np.zeros(BITS, np.int64)
    begin, end = starts[:n].tolist(), (ends[k - 1:] - 1).tolist()
    for at in range(0, n, BLOCK):
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(begin[at:at + BLOCK], end[at:at + BLOCK])),
                             np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame, *, text: str = "text", id: str = "doc_id", width: int = 3, seed: int = 42) -> DataFrame:
    """``(id, fp)`` of every row, ``fp`` a signed long with the bits of the fingerprint."""
    kept = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), width, seed) for t in batch["text"]], np.uint64)
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(fps.view(np.int64))], ["id", "fp"])

    kind = kept.schema["id"].dataType.simpleString()
    return kept.mapInArrow(each, f"id {kind}, fp long")


def masks() -> list[int]:
    """One mask per table: seven for radius 2.

    Every bit belongs to a nonzero vector of three bits, in turn; a table is such a vector, too,
    and its mask has the bits whose vector has an odd inner product with it. Any two bits
    leave a table whose vector is orthogonal to both, so two fingerprints that differ in those
    bits only have the same key there.
    """
    tables = 2 ** (RADIUS + 1) - 1
    odd = lambda v, i: (v & (i % tables + 1)).bit_count() % 2
    return [sum(odd(v, i) << i for i in range(BITS)) for v in range(1, tables + 1)]


def signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def links(nodes: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` that connect all fingerprints ``fp`` within the radius of each other.

    ``nodes`` holds distinct fingerprints. A bucket, the key of one table, with two or more of
    them is searched exactly and without pairs: two fingerprints differ in at most two bits if
    and only if they share a middle, a value one bit or less away from both. So each
    fingerprint goes to itself and to its neighbours in the free bits of the table. A middle
    has 65 members at most, all within the radius of each other, and links them to the least.
    """
    keys = masks()
    tabled = nodes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"))
        for t, m in enumerate(keys)])).alias("e")).select("fp", "e.t", "e.key")
    busy = tabled.groupBy("t", "key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo < hi")
    members = tabled.join(busy.select("t", "key"), ["t", "key"])
    flips: Column = F.lit(None)
    for t, m in enumerate(keys):
        free = [0] + [1 << i for i in range(BITS) if not m >> i & 1]
        flips = F.when(F.col("t") == t, F.array(*[F.lit(signed(b)) for b in free])).otherwise(flips)
    near = members.select("fp", F.explode(flips).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"))
    groups = near.groupBy("middle").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    return (groups.select(F.array_min("fps").alias("b"), F.explode("fps").alias("a"))
            .where("a > b").select("a", "b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of ``(a, b)``: root is the least node that it reaches.

    Large-star and small-star rounds: every node sends its larger neighbours, then its smaller
    ones, to the least it knows, until nothing changes. A round is two joins and aggregates
    of edges; no component is ever gathered in one place.
    """
    state, before = pinned(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                           .distinct()), None
    while True:
        both = state.union(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        small_m = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_m, "a")
        state = pinned(small.select("a", F.col("m").alias("b"))
                       .union(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct())
        now = state.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h"),
                        F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("x")).first()
        if now == before:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = now


def near_duplicates(docs: DataFrame, *, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``(id, fingerprint, component_id)`` of every document.

    The fingerprint is 16 hexadecimal digits. Fingerprints link at two or fewer differing bits;
    ``component_id`` is the least id that links reach, the document's own included. Rows with
    equal fingerprints are one node, so copies are never paired, and repeated rows stay rows.
    Null and empty texts have fingerprint 0, which links like any other. A null id is never a
    component_id, unless the whole component has none. Other columns are not looked at.
    """
    fps = pinned(fingerprints(docs, text=text, id=id))
    nodes = pinned(fps.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(links(nodes)).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    of = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(of, "root").select("fp", "component_id")
    # a fingerprint that very many documents share is split by the adaptive skew join
    return fps.join(named, "fp").select(
        F.col("id").alias(id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
