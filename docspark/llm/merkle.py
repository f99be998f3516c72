"""A Merkle manifest of a table: nodes labelled by the intervals of leaf ranks that they cover."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pinned, ranked

#: Levels in one band: a block of a band is a subtree of so many levels, built in one task.
BAND = 12
#: Bytes of a digest, and what stands before one in a path: it is on the right, on the left.
SIZE, RIGHT, LEFT, ALONE = 32, b"\1", b"\2", b"\0"


def written(values: Sequence[Column]) -> Column:
    """Values one behind the other: ``-`` for null, else the UTF-8 byte count, a colon and the text."""
    texts = [v.cast("string") for v in values]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def digest(values: Sequence[Column]) -> Column:
    return F.sha2(written(values), 256)


def joined(digests: Sequence[bytes]) -> bytes:
    """The digest of digests, which enter as hexadecimal text."""
    return hashlib.sha256(b"".join([d.hex().encode() for d in digests])).digest()


def height(n: int) -> int:
    """Levels above ``n`` leaves until one node is left."""
    return (n - 1).bit_length()


class Block:
    """The subtree over the nodes of one level that cover the leaf ranks ``lo`` to ``hi``, of ``n``.

    ``levels[j]`` has the digests of level ``level + j``. The node of level l that covers rank r has the
    label ``[r' , min(r' + 2**l, n))`` with r' the multiple of 2**l at or before r.
    """

    def __init__(self, band: int, level: int, lo: int, hi: int, n: int, digests: list[bytes]) -> None:
        self.level, self.lo, self.hi, self.n, self.levels = level, lo, hi, n, [digests]
        for _ in range(min(band, height(n) - level)):
            below = self.levels[-1]
            self.levels.append([joined(below[i:i + 2]) for i in range(0, len(below), 2)])

    def label(self, level: int, rank: int) -> tuple[int, int]:
        start = rank >> level << level
        return start, min(start + (1 << level), self.n)

    def at(self, level: int, start: int) -> bytes:
        return self.levels[level - self.level][(start - self.lo) >> level]

    def path(self, rank: int) -> bytes:
        """What stands beside the node over ``rank`` and beside its ancestors, up to the block's top.

        The sibling covers what the parent's interval has before or behind the node's own.
        """
        steps = []
        for level in range(self.level, self.level + len(self.levels) - 1):
            (lo, hi), (above, end) = self.label(level, rank), self.label(level + 1, rank)
            steps.append(LEFT + self.at(level, above) if above < lo else RIGHT + self.at(level, hi) if hi < end else ALONE)
        return b"".join(steps)


def siblings(path: bytes) -> Iterator[tuple[bytes, bytes]]:
    """``(side, digest)`` of each level, the digest empty where a node is alone."""
    at = 0
    while at < len(path):
        side, at = path[at:at + 1], at + 1
        length = 0 if side == ALONE else SIZE
        yield side, path[at:at + length]
        at += length


def folded(leaf: bytes, path: bytes) -> bytes:
    """The root that ``leaf`` leads to."""
    for side, other in siblings(path):
        leaf = joined([leaf] if side == ALONE else [leaf, other] if side == RIGHT else [other, leaf])
    return leaf


def blocks(nodes: DataFrame, band: int, level: int, extra: Sequence[str] = ()) -> DataFrame:
    """``(tree, lo, hi, n, digests, top)`` and lists of ``extra``: a row for each block of a band.

    ``nodes`` has ``(tree, lo, n, digest)``, the nodes of one level; ``lo`` is the first leaf rank
    that a node covers. A block has at most ``2**band`` of them, in order.
    """
    width = level + band
    members = F.array_sort(F.collect_list(F.struct("lo", "digest", *extra)))
    rows = (nodes.groupBy("tree", "n", F.shiftleft(F.shiftright("lo", width), width).alias("start"))
            .agg(members.alias("m")))
    rows = rows.select("tree", F.col("start").alias("lo"),
                       F.least(F.col("start") + F.lit(1 << width), "n").alias("hi"), "n",
                       F.col("m.digest").alias("digests"), *[F.col(f"m.{c}").alias(c) for c in extra])

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tops = [Block(band, level, lo, hi, n, ds).levels[-1][0] for lo, hi, n, ds in
                    zip(*(b[c].to_pylist() for c in ("lo", "hi", "n", "digests")))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tops, pa.binary())], [*b.schema.names, "top"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return pinned(rows.mapInArrow(top, kinds + ", top binary"))


def bands(leaves: DataFrame, band: int, extra: Sequence[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every band, lowest first, and ``(tree, digest)`` of the one node left of each tree."""
    found, nodes = [], leaves
    most = leaves.agg(F.max("n")).first()[0] or 1
    while not found or band * len(found) < height(most):
        found.append(blocks(nodes, band, band * len(found), extra if not found else ()))
        nodes = found[-1].select("tree", "lo", "n", F.col("top").alias("digest"))
    return found, nodes.select("tree", "digest")


def with_paths(found: list[DataFrame], band: int, above: DataFrame) -> DataFrame:
    """The blocks of the lowest band with ``rest``, the path from their top to the root.

    ``above`` has ``(tree, rest)``, the path from the top of each tree. A band's blocks find the
    node over them among those of the next one by the interval that contains theirs, bucketed by the
    width of a block there.
    """
    def each(batches: Iterator[pa.RecordBatch], level: int) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = {"tree": [], "lo": [], "rest": []}
            for tree, lo, hi, n, ds, rest in zip(*(b[c].to_pylist() for c in ("tree", "lo", "hi", "n", "digests", "rest"))):
                block = Block(band, level, lo, hi, n, ds)
                for i in range(len(ds)):
                    rows["tree"].append(tree)
                    rows["lo"].append(lo + (i << level))
                    rows["rest"].append(block.path(lo + (i << level)) + rest)
            yield pa.RecordBatch.from_pydict(rows, pa.schema([("tree", b.schema.field("tree").type),
                                                              ("lo", pa.int64()), ("rest", pa.binary())]))

    kind = found[0].schema["tree"].dataType.simpleString()
    top = above.select(F.col("tree").alias("of"), F.lit(0).cast("long").alias("from"), "rest")
    for i in range(len(found) - 1, -1, -1):
        level = band * i
        over = F.lit(0).cast("long") if i == len(found) - 1 else F.shiftleft(F.shiftright("lo", level + band), level + band)
        placed = found[i].join(top, F.col("tree").eqNullSafe(F.col("of")) & (over == F.col("from"))).drop("of", "from")
        if i:
            top = pinned(placed.mapInArrow(lambda bs, level=level: each(bs, level), f"tree {kind}, lo long, rest binary")
                         .select(F.col("tree").alias("of"), F.col("lo").alias("from"), "rest"))
    return placed


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` of ``(tree, id, leaf, ..)`` with ``lo``, the rank in its tree, and ``n``, the tree's size.

    They are dealt by sampled ranges of (tree, id, leaf) and pinned; a range counts its rows of
    each tree, and the counts, one for each range and tree, give where its ranks start.
    """
    order = [F.col("tree").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("leaf").asc()]
    at = F.monotonically_increasing_id()
    dealt = pinned(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at)
                   .withColumn("_range", F.shiftright("_at", 33)))
    counts = dealt.groupBy("_range", "tree").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    of = Window.partitionBy("tree")
    before = of.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("_range").alias("_r"), F.col("tree").alias("_t"), "_first", F.sum("_n").over(of).alias("n"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    same = (F.col("_range") == F.col("_r")) & F.col("tree").eqNullSafe(F.col("_t"))
    return (dealt.join(starts, same).withColumn("lo", F.col("_at") - F.col("_first") + F.col("_start"))
            .drop("_at", "_range", "_r", "_t", "_first", "_start"))


def manifest(docs: DataFrame, fields: Sequence[str], *, tree: str = "lang", id: str = "doc_id",
             claimed: Column | None = None, band: int = BAND) -> DataFrame:
    """``(id, leaf, subroot, root, proof, folded_root, verified)`` of every row.

    A leaf is the digest of the row's ``fields``. The leaves of one ``tree`` value ascend by id
    (null first, equal ones by leaf); two neighbours make a node, a last one alone its own, until one
    is left, the subroot. The subroots in the order of the values, null first, make the root in the
    same way. ``proof`` lists the siblings from the leaf to the root, ``folded_root`` is what the leaf
    and these lead to, ``verified`` whether that is the root. Where ``claimed``, a digest, is
    given and not null, it is folded in place of the leaf.

    Every node is labelled by the interval of leaf ranks that it covers. Levels are cut into
    bands of ``band``; a block, the subtree over an aligned interval of ``2**band`` nodes, is built in one
    task, and only its top goes on to the next band. So a tree that holds a third of all rows is spread over
    its blocks, and the next band has a 4096th of the rows. Going down, a block meets the node
    over it by the interval that contains its own, and siblings are what the parent's
    interval has beside the node's.

    Nulls in any field are marked as such, repeated rows are leaves of their own. An empty table
    has no leaf. Other columns are not looked at.
    """
    leaf = digest([F.col(c) for c in fields])
    rows = docs.select(F.col(tree).alias("tree"), F.col(id).alias("id"), F.unhex(leaf).alias("leaf"),
                       F.unhex(F.lit(None).cast("string") if claimed is None else claimed).alias("claimed"))
    leaves = pinned(numbered(rows)).withColumn("digest", F.col("leaf"))
    found, subroots = bands(leaves, band, ["id", "claimed"])
    subroots = pinned(subroots)
    ordered = ranked(subroots, F.col("tree").asc_nulls_first(), name="lo")
    n = subroots.count()
    whole = ordered.select(F.lit(0).alias("tree"), "lo", F.lit(n).cast("long").alias("n"), "digest", F.col("tree").alias("value"))
    over, root = bands(pinned(whole), band, ["value"])
    roots = root.first()
    top = with_paths(over, band, over[0].sparkSession.createDataFrame([(0, b"")], "tree int, rest binary"))

    def of_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            trees, paths = [], []
            for lo, hi, n, ds, values, rest in zip(*(b[c].to_pylist() for c in ("lo", "hi", "n", "digests", "value", "rest"))):
                block = Block(band, 0, lo, hi, n, ds)
                trees += values
                paths += [block.path(lo + i) + rest + d for i, d in enumerate(ds)]
            yield pa.RecordBatch.from_arrays([pa.array(trees, b.schema.field("value").type.value_type),
                                              pa.array(paths, pa.binary())], ["tree", "rest"])

    kind, named = docs.schema[tree].dataType.simpleString(), docs.schema[id].dataType.simpleString()
    # behind the path to the root comes the digest of the subroot, so that both reach the leaves
    above = pinned(top.mapInArrow(of_trees, f"tree {kind}, rest binary"))
    placed = with_paths(found, band, above)
    final = roots["digest"] if roots else b""

    def proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("lo", "hi", "n", "digests", "id", "claimed", "rest")
        for b in batches:
            for lo, hi, n, ds, ids, claims, rest in zip(*(b[c].to_pylist() for c in names)):
                block, rest, subroot, rows = Block(band, 0, lo, hi, n, ds), rest[:-SIZE], rest[-SIZE:], []
                for i, (leaf, claim) in enumerate(zip(ds, claims)):
                    path = block.path(lo + i) + rest
                    fold = folded(leaf if claim is None else claim, path)
                    rows.append((ids[i], leaf.hex(), subroot.hex(), final.hex(),
                                 [d.hex() for _, d in siblings(path) if d], fold.hex(), fold == final))
                columns = list(zip(*rows))
                kinds = [b.schema.field("id").type.value_type, *[pa.string()] * 3, pa.list_(pa.string()), pa.string(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 ["id", "leaf", "subroot", "root", "proof", "folded_root", "verified"])

    return placed.mapInArrow(proofs, f"id {named}, leaf string, subroot string, root string, proof array<string>, "
                             "folded_root string, verified boolean").withColumnRenamed("id", id)
