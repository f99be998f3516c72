"""The prefix trie of conversations: ternary search trees per range of sequences, merged at the boundaries."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pinned, ranked

#: Turns in one range of sequences, about.
SHARD_TURNS = 1 << 19
#: Ranges whose boundary nodes meet in one task of a round.
FAN_IN = 16
#: Ids in one piece of the list of a node's ends.
PIECE = 1 << 16

TURNS = "array<struct<turn: long, chars: long>>"
#: What a range gives: finished nodes, parts of its boundary nodes, pieces of the ends of these.
DONE, EDGE, ENDS = 0, 1, 2
PARTS = ("kind int, shard int, key binary, parent binary, depth long, chars long, conv_id long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, first boolean, last boolean, nr int, piece string")
NAMES = [c.split()[0] for c in PARTS.split(", ")]


def sequences(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """``(conv_id, turns)`` of every conversation, its turns in order as numbers of a dictionary.

    The dictionary numbers the distinct (role, text), known by their SHA-256, so no text leaves
    the task that reads it. Turns are ordered by ``turn``, null first, equal ones by the
    dictionary. A null role or text is empty. Rows without a conversation belong to none and
    are left out. A very frequent turn is split by the adaptive skew join.
    """
    said, of = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    key = F.unhex(F.sha2(F.concat(F.octet_length(of).cast("string"), F.lit(":"), of, said), 256))
    turns = pinned(rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("at"), key.alias("key"),
        F.length(said).cast("long").alias("chars")))
    numbered = ranked(turns.select("key").distinct(), F.col("key"), name="number")
    placed = turns.join(numbered, "key").select("conv_id", F.struct(
        F.col("at").isNotNull().alias("set"), "at", F.col("number").alias("turn"), "chars").alias("t"))
    return placed.groupBy("conv_id").agg(F.transform(
        F.array_sort(F.collect_list("t")), lambda t: F.struct(t["turn"], t["chars"])).alias("turns"))


def median_order(n: int) -> Iterator[int]:
    """0 to n - 1, every range by its median first, so that sorted keys make balanced trees."""
    left = [(0, n)]
    while left:
        lo, hi = left.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            left += [(mid + 1, hi), (lo, mid)]


class Tree:
    """Ternary search tree of turn numbers; node 0 is the root without a turn.

    ``low`` and ``high`` lead to siblings, ``down`` to the children. A node stands behind its
    parent ``up``, so one pass from the last node to the first adds up all subtrees.
    """

    def __init__(self) -> None:
        self.turn, self.chars, self.up, self.depth = [-1], [0], [-1], [0]
        self.low, self.high, self.down, self.run = [-1], [-1], [-1], [-1]

    def insert(self, turns: list[int], chars: list[int], run: int) -> None:
        """Adds the nodes of a sequence; the last one remembers ``run``."""
        node = 0
        for t, c in zip(turns, chars):
            at, link, before = self.down[node], self.down, node
            while at >= 0 and self.turn[at] != t:
                link, before = (self.low, at) if t < self.turn[at] else (self.high, at)
                at = link[at]
            if at < 0:
                at = link[before] = len(self.turn)
                for column, value in ((self.turn, t), (self.chars, c), (self.up, node), (self.depth, self.depth[node] + 1),
                                      (self.low, -1), (self.high, -1), (self.down, -1), (self.run, -1)):
                    column.append(value)
            node = at
        self.run[node] = run

    def path(self, turns: list[int]) -> list[int]:
        """The nodes of a sequence that was inserted, from the root."""
        nodes = [0]
        for t in turns:
            at = self.down[nodes[-1]]
            while self.turn[at] != t:
                at = self.low[at] if t < self.turn[at] else self.high[at]
            nodes.append(at)
        return nodes


def written(ids: list[int]) -> str:
    return ",".join(map(str, ids))


def shard_rows(shard: int, convs: list[int], turns: list[list[int]], chars: list[list[int]]) -> Iterator[dict]:
    """The rows of ``PARTS`` of one range; its sequences are sorted, equal ones by id."""
    starts = [i for i in range(len(turns)) if not i or turns[i] != turns[i - 1]] + [len(turns)]
    tree = Tree()
    for run in median_order(len(starts) - 1):
        tree.insert(turns[starts[run]], chars[starts[run]], run)
    size = len(tree.turn)
    ids = lambda run: convs[starts[run]:starts[run + 1]]
    sides = [tree.path(turns[0]), tree.path(turns[-1])]
    first, last = map(set, sides)
    edge = first | last
    key, none = {0: b"\0" * 16}, hashlib.sha256().hexdigest()
    for path in sides:
        for up, node in zip(path, path[1:]):
            key[node] = hashlib.blake2b(key[up] + tree.turn[node].to_bytes(8, "little"), digest_size=16).digest()
    n, least, children, leaves, saved = [0] * size, [None] * size, [0] * size, [0] * size, [0] * size
    for node in range(size - 1, -1, -1):
        if tree.run[node] >= 0:
            own = ids(tree.run[node])
            n[node] += len(own)
            least[node] = own[0] if least[node] is None else min(own[0], least[node])
        if node in edge:  # other ranges have a share of it
            continue
        leaves[node] = leaves[node] if children[node] else 1
        saved[node] += (n[node] - 1) * tree.chars[node]
        up = tree.up[node]
        n[up] += n[node]
        least[up] = least[node] if least[up] is None else min(least[node], least[up])
        children[up] += 1
        leaves[up] += leaves[node]
        saved[up] += saved[node]
    for node in range(size):
        row = {"shard": shard, "depth": tree.depth[node], "chars": tree.chars[node], "conv_id": least[node],
               "n_convs": n[node], "n_children": children[node], "n_leaves": leaves[node], "saved_tokens": saved[node]}
        run, up = tree.run[node], tree.up[node]
        if node not in edge:
            yield row | {"kind": DONE, "parent": key.get(up), "parent_conv_id": None if up in edge else least[up],
                         "ends_sha256": hashlib.sha256(written(ids(run)).encode()).hexdigest() if run >= 0 else none}
            continue
        yield row | {"kind": EDGE, "key": key[node], "parent": key.get(up), "first": node in first, "last": node in last}
        if run >= 0:
            own = ids(run)
            for nr, at in enumerate(range(0, len(own), PIECE)):
                yield {"kind": ENDS, "shard": shard, "key": key[node], "nr": nr, "piece": written(own[at:at + PIECE])}


def batched(rows: Iterator[dict], size: int = 8192) -> Iterator[pa.RecordBatch]:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in PARTS.split(", "))])
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def parts(seqs: DataFrame, n: int) -> DataFrame:
    """Ranges of sequences, equal ones by id, each a tree: the rows of ``PARTS``."""
    dealt = (seqs.repartitionByRange(n, "turns", "conv_id").sortWithinPartitions("turns", "conv_id")
             .select(F.spark_partition_id().alias("shard"), "conv_id", F.col("turns.turn").alias("turn"),
                     F.col("turns.chars").alias("chars")))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, convs, turns, chars = None, [], [], []
        for batch in batches:
            if batch.num_rows:
                shard = batch["shard"][0].as_py()
                convs += batch["conv_id"].to_pylist()
                turns += batch["turn"].to_pylist()
                chars += batch["chars"].to_pylist()
        if convs:
            yield from batched(shard_rows(shard, convs, turns, chars))

    return dealt.mapInArrow(each, PARTS)


def edges_merged(rows: list[dict]) -> Iterator[dict]:
    """One round for the boundary nodes of neighbouring ranges: those between them are finished.

    Nodes on the first path of the first range or the last path of the last one stay parts.
    A finished child is added to its parent; the deepest nodes come first.
    """
    lo, hi = min(r["shard"] for r in rows), max(r["shard"] for r in rows)
    nodes: dict[bytes, dict] = {}
    for r in rows:
        first, last = r["first"] and r["shard"] == lo, r["last"] and r["shard"] == hi
        known = nodes.get(r["key"])
        if known is None:
            nodes[r["key"]] = r | {"first": first, "last": last}
            continue
        for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
            known[c] += r[c]
        known["first"] |= first
        known["last"] |= last
        both = [x for x in (known["conv_id"], r["conv_id"]) if x is not None]
        known["conv_id"] = min(both, default=None)
    for r in sorted(nodes.values(), key=lambda r: -r["depth"]):
        if r["first"] or r["last"]:
            yield r | {"kind": EDGE, "shard": lo if r["first"] else hi}
            if r["first"] and r["last"]:  # a part of both paths
                yield {**r, "kind": EDGE, "shard": hi, "conv_id": None, "n_convs": 0, "n_children": 0, "n_leaves": 0, "saved_tokens": 0}
            continue
        r |= {"kind": DONE, "n_leaves": r["n_leaves"] if r["n_children"] else 1,
              "saved_tokens": r["saved_tokens"] + (r["n_convs"] - 1) * r["chars"]}
        yield r
        up = nodes.get(r["parent"])
        if up is not None:
            both = [x for x in (up["conv_id"], r["conv_id"]) if x is not None]
            up["conv_id"] = min(both, default=None)
            up["n_children"] += 1
            for c in ("n_convs", "n_leaves", "saved_tokens"):
                up[c] += r[c]


def merge_with(last: bool):
    """The task of a round; in the last one nothing is beyond the ranges that meet."""

    def merge(table: pa.Table) -> pa.Table:
        rows = table.select(NAMES).to_pylist()
        if last:
            rows = [r | {"first": False, "last": False} for r in rows]
        return pa.Table.from_batches(list(batched(edges_merged(rows))))

    return merge


def ends_hashed(pieces: DataFrame) -> DataFrame:
    """``(key, ends_sha256)``: the pieces of a node, in order, go through one hash as a stream."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done: list[tuple] = []
            for key, piece in zip(batch["key"].to_pylist(), batch["piece"].to_pylist()):
                if key != now:
                    if now is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256(piece.encode())
                else:
                    digest.update(b"," + piece.encode())
            yield from batch_of(done)
        if now is not None:
            yield from batch_of([(now, digest.hexdigest())])

    def batch_of(done: list[tuple]) -> Iterator[pa.RecordBatch]:
        if done:
            keys, hashes = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(hashes)], ["key", "ends_sha256"])

    dealt = pieces.select("key", "shard", "nr", "piece").repartition("key").sortWithinPartitions("key", "shard", "nr")
    return dealt.mapInArrow(each, "key binary, ends_sha256 string")


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """All nodes of the trie of ``(conv_id, turns)``, ``turns`` a ``TURNS`` array, an id once.

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256)``: a node stands for a distinct sequence of the first ``depth`` turns and is named
    by its least member, a conversation that begins so. ``n_leaves`` counts the childless nodes of
    its subtree, ``saved_tokens`` adds up what sharing each node's last turn saves there, and
    ``ends_sha256`` is the hash of the ids that end with the node. The root is the empty sequence.

    Sequences are dealt into ranges, equal ones by id, so a conversation that a third of all
    share is spread like any other. A range builds a ternary search tree by median insertion
    and adds up its subtrees in one pass. All nodes off its first and last path are finished;
    those on the two, at most two for each turn of a conversation, are merged up a tree of
    ranges. A task holds one range, or the paths of ``FAN_IN`` ranges. The list of ends of a node
    over several ranges is hashed as a stream, as a hash of one list has to be.

    A conversation is one row, in whole. An empty table has no root.
    """
    total = seqs.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    n = max(int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_TURNS))
    found = pinned(parts(seqs, n))
    edges = found.where(F.col("kind") == EDGE)
    span, done = 1, None
    while True:
        span *= FAN_IN
        merged = pinned(edges.withColumn("group", F.floor(F.col("shard") / span)).groupBy("group").applyInArrow(merge_with(span >= n), PARTS))
        finished = merged.where(F.col("kind") == DONE)
        done = finished if done is None else done.union(finished)
        if span >= n:
            break
        edges = merged.where(F.col("kind") == EDGE)

    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    names = done.select(F.col("key").alias("parent"), F.col("conv_id").alias("_up"))
    ends = ends_hashed(found.where(F.col("kind") == ENDS)).withColumnRenamed("ends_sha256", "_ends")
    empty = F.lit(hashlib.sha256().hexdigest())
    boundary = (done.join(names, "parent", "left").join(ends, "key", "left")
                .withColumn("parent_conv_id", F.col("_up")).withColumn("ends_sha256", F.coalesce("_ends", empty)))
    # a range asks for the names of its own paths, so the many children of one node are spread
    of_shard = (found.where(F.col("kind") == EDGE).select("shard", F.col("key").alias("parent")).join(names, "parent"))
    inner = (found.where(F.col("kind") == DONE).join(of_shard, ["shard", "parent"], "left")
             .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_up")))
    return inner.select(columns).union(boundary.select(columns))


def with_shared_start(seqs: DataFrame, shares: Column, base: Column, most: int) -> DataFrame:
    """Every conversation begins with the first ``shares`` (at most ``most``) turns of conversation ``base``.

    They stand in place of as many own turns; a base that is absent gives none.
    """
    begins = seqs.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most).alias("_begin"))
    joined = seqs.select("conv_id", "turns", shares.cast("int").alias("_h"), base.alias("_base")).join(begins, "_base", "left")
    begin = F.slice(F.coalesce("_begin", F.array().cast(TURNS)), F.lit(1), F.col("_h"))
    own = F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns") - F.col("_h"), F.lit(0)))
    return joined.select("conv_id", F.concat(begin, own).alias("turns"))
