"""Best-fit packing by residuals: full bins leave at once, the others are merged up a tree of partitions."""

from __future__ import annotations

import json
import os
import unicodedata
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pinned

#: Tokens that a task packs at a time, at most but for one text: its bins are a group of the tree.
GROUP_TOKENS = 1 << 24
#: Groups whose underfull bins meet in one task of the next round.
FAN_IN = 16
#: Bytes of text whose words are looked up together, at most but for one text.
PART_BYTES = 1 << 23
#: Words whose ids a Python worker keeps, besides those of one part, and the length of the longest of them.
KEPT_WORDS, KEPT_LETTERS = 1 << 19, 64
#: Bytes of one token id, and no token's id.
WIDTH, LINE_END = 4, (1 << 32) - 1


def byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it can be seen."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(0x100) if b not in seen]
    return {b: b for b in seen} | {b: 0x100 + i for i, b in enumerate(hidden)}


def word_splitter(path: str) -> Callable[[str], list[str]] | None:
    """What the tokenizer file does to a text before its model sees words; None for other kinds of files.

    That is NFC, white space as blanks and lower case, then the words of a pattern. Line feeds come back too.
    """
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    steps = (said["normalizer"] or {}).get("normalizers", [])
    before = (said["pre_tokenizer"] or {}).get("pretokenizers", [])
    if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in before] != ["Split", "ByteLevel"]:
        return None
    split, level = before
    if (split["behavior"], split["invert"], level["add_prefix_space"], level["use_regex"]) != ("Removed", True, False, False):
        return None
    words = regex.compile("\\n|" + split["pattern"]["Regex"]).findall
    # a capital sigma becomes the same letter wherever it stands
    return lambda text: words(unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower())


def encoder(path: str) -> Callable[[str | None], bytes]:
    """A function from texts to their ids, little-endian unsigned 32-bit numbers, without special tokens."""
    encode = column_encoder(path)
    return lambda text: next(encode(pa.array([text], pa.string())))


def column_encoder(path: str) -> Callable[[pa.Array], Iterator[bytes]]:
    """``encoder`` for columns of texts. A Python worker keeps the last one, with its words, for its next tasks."""
    about = os.stat(path)
    return kept_encoder(path, about.st_mtime_ns, about.st_size)


@lru_cache(maxsize=1)
def kept_encoder(path: str, changed: int, size: int) -> Callable[[pa.Array], Iterator[bytes]]:
    """``column_encoder`` for the file as it was changed last.

    The model encodes every word by itself, and no word reaches over ASCII white space. So Arrow numbers the
    distinct runs between white space, these are split into words all at once, the ids of words are kept, and a
    text's ids are those of its runs. A text that spells out an added token or has a letter that is new in
    Unicode, and any text where the file splits words in another way, goes to the tokenizer as a whole.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    model, split, letters = whole.model, word_splitter(path), byte_letters()
    added = [t.content for t in whole.get_added_tokens_decoder().values()]
    of_word: dict[str, bytes] = {}
    assigned: set[str] = set()

    def at_once(text: str | None) -> bytes:
        return np.array(whole.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()

    def ids_of(word: str) -> bytes:
        spelled = word if word.isascii() and word.isprintable() else word.encode("utf-8").decode("latin-1").translate(letters)
        return array("I", [t.id for t in model.tokenize(spelled)]).tobytes()

    def ids_of_lines(lines: str) -> np.ndarray:
        """The ids of every line, each with ``LINE_END`` behind it."""
        words = split(lines)
        distinct = set(words)
        if len(of_word) > KEPT_WORDS:  # those that are in use stay
            kept = {word: of_word[word] for word in distinct.intersection(of_word)}
            of_word.clear()
            of_word.update(kept)
        of_word["\n"] = np.array([LINE_END], "<u4").tobytes()
        new = distinct.difference(of_word)
        of_word.update((word, ids_of(word)) for word in new)
        ids = np.frombuffer(b"".join(map(of_word.__getitem__, words)), "<u4")
        for word in new:
            if len(word) > KEPT_LETTERS:
                del of_word[word]
        return ids

    def with_new_letters(lines: str) -> list[int]:
        """The numbers of the lines that have a letter which is new in Unicode."""
        unseen = set() if lines.isascii() else set(lines) - assigned
        new = {c for c in unseen if unicodedata.category(c) == "Cn"}
        assigned.update(unseen - new)
        return [nr for nr, line in enumerate(lines.split("\n")) if not new.isdisjoint(line)] if new else []

    def of_part(texts: pa.Array) -> list[bytes]:
        by_text = pc.ascii_split_whitespace(texts)
        counts = pc.fill_null(pc.list_value_length(by_text), 0).to_numpy()
        runs = by_text.flatten().dictionary_encode()
        if not len(runs):
            return [b""] * len(texts)
        all_runs = pa.LargeListArray.from_arrays([0, len(runs.dictionary)], runs.dictionary)
        lines = pc.binary_join(all_runs, pa.scalar("\n", texts.type))[0].as_py() + "\n"
        ids, numbers = ids_of_lines(lines), runs.indices.to_numpy()
        ends = np.flatnonzero(ids == LINE_END)
        if len(ends) != len(runs.dictionary):  # words of this file reach over lines
            return [at_once(text.as_py()) for text in texts]
        starts = np.append(0, ends - np.arange(len(ends))) * WIDTH
        of_line = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(starts), pa.py_buffer(ids[ids != LINE_END])])
        _, starts, joined = of_line.take(runs.indices).buffers()
        starts = np.frombuffer(starts, np.int64)[np.append(0, np.cumsum(counts))].tolist()
        joined = memoryview(joined or b"")
        out = [bytes(joined[a:b]) for a, b in pairwise(starts)]
        odd = np.zeros(len(texts), bool)
        if new := with_new_letters(lines):
            odd[np.repeat(np.arange(len(texts)), counts)[np.isin(numbers, new)]] = True
        for token in added:
            odd |= pc.fill_null(pc.match_substring(texts, token), False).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(odd).tolist():
            out[i] = at_once(texts[i].as_py())
        return out

    def encode(texts: pa.Array) -> Iterator[bytes]:
        if split is None:
            yield from (at_once(text.as_py()) for text in texts)
            return
        texts = texts.cast(pa.large_string())
        length = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
        cuts = np.flatnonzero(np.diff(np.cumsum(length) // PART_BYTES)) + 1
        for a, b in pairwise([0, *cuts.tolist(), len(texts)]):
            yield from of_part(texts[a:b])

    return encode


def best_fit(sizes: Sequence[int] | np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int], list[int]]:
    """Best-fit decreasing: the bin and the offset of each item, the first item and the fill of each bin.

    An item goes to the bin with the least room that takes it. Rooms that occur are the bits of
    one number, so the search is a shift.
    """
    sizes = np.asarray(sizes, np.int64)
    order = np.argsort(-sizes, kind="stable")
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    some, heads, fills = 0, [], []
    bins, offsets = [], []
    for item, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = some >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            at = rooms[room].pop()
            if not rooms[room]:
                some ^= 1 << room
        else:
            at, room = len(heads), capacity
            heads.append(item)
            fills.append(0)
        bins.append(at)
        offsets.append(capacity - room)
        room -= size
        fills[at] = capacity - room
        if room:
            rooms[room].append(at)
            some |= 1 << room
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return np.array(bins, np.int64)[back], np.array(offsets, np.int64)[back], heads, fills


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, bytes]]:
    """``(start, ids)`` of the pieces of a text: only one that is too long is cut."""
    for at in range(0, len(ids), capacity * WIDTH):
        yield at // WIDTH, ids[at:at + capacity * WIDTH]


def local_bins(docs: DataFrame, encode: Callable[[], Callable[[pa.Array], Iterable[bytes]]], capacity: int, end: int) -> DataFrame:
    """``(id, piece, start, ids, bin, offset, fill, part)``: every task packs what it reads.

    ``fill`` is set in the first row of a bin. A bin's number holds the task and its place there.
    """
    last = np.array([end], "<u4").tobytes()
    kind = docs.schema["id"].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, code, count = TaskContext.get().partitionId(), encode(), 0
        for pieces in grouped(batches, code):
            at, offset, heads, fills = best_fit([len(p[3]) // WIDTH for p in pieces], capacity)
            fill: list[int | None] = [None] * len(pieces)
            for head, full in zip(heads, fills):
                fill[head] = full
            number = at + (task << 32) + count
            count += len(heads)
            for a in range(0, len(pieces), 4096):  # a batch of whole sequences has a few MB
                b = pieces[a:a + 4096]
                columns = list(zip(*b))
                yield pa.RecordBatch.from_arrays([
                    pa.array([x.as_py() for x in columns[0]], columns[0][0].type), pa.array(columns[1], pa.int32()),
                    pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.binary()), pa.array(number[a:a + 4096]),
                    pa.array(offset[a:a + 4096]), pa.array(fill[a:a + 4096], pa.int32()),
                    pa.array([task] * len(b), pa.int32())],
                    ["id", "piece", "start", "ids", "bin", "offset", "fill", "part"])

    def grouped(batches: Iterable[pa.RecordBatch], code) -> Iterator[list[tuple]]:
        pieces, held = [], 0
        for batch in batches:
            for key, ids in zip(batch["id"], code(batch["text"])):
                ids += last
                pieces += [(key, nr, start, part) for nr, (start, part) in enumerate(cut(ids, capacity))]
                held += len(ids) // WIDTH
                if held >= GROUP_TOKENS:
                    yield pieces
                    pieces, held = [], 0
        if pieces:
            yield pieces

    return docs.mapInArrow(each, f"id {kind}, piece int, start long, ids binary, bin long, offset long, fill int, part int")


def merged(open_: DataFrame, span: int, most: int, capacity: int) -> DataFrame:
    """One round: the underfull bins of ``span`` parts are items of another best fit.

    ``(bin, fill, part, into, shift)``: ``into`` is the bin that took this one at offset ``shift``,
    null for those that stay. Two bins only merge if one of them is at most half full; of
    these there are ``most`` left in all, so no more bins of one fill can be of use and
    the others leave.
    """
    schema = "bin long, fill int, part int, into long, shift long"

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by([("fill", "descending"), ("bin", "ascending")])
        names, parts = table["bin"].to_pylist(), table["part"].to_pylist()
        at, offset, heads, fills = best_fit(table["fill"].to_numpy(), capacity)
        rows, kept = [], {}
        for head, fill in zip(heads, fills):
            kept[fill] = kept.get(fill, 0) + 1
            if kept[fill] <= most:
                rows.append((names[head], fill, parts[head], None, None))
        rows += [(names[i], None, None, names[heads[at[i]]], int(offset[i])) for i in range(len(names)) if heads[at[i]] != i]
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["bin", "fill", "part", "into", "shift"])

    return (open_.withColumn("group", F.floor(F.col("part") / span)).groupBy("group")
            .applyInArrow(lambda table: merge(table.select(["bin", "fill", "part"])), schema))


def packed(docs: DataFrame, tokenizer: str, *, text: str = "text", id: str = "doc_id", capacity: int = 2048,
           end: int = 0, encode: Callable[[], Callable[[str | None], bytes]] | None = None) -> DataFrame:
    """``(id, piece, start, ids, sequence_id, offset)``: every text's ids in sequences of ``capacity`` at most.

    A text is encoded by the ``tokenizer`` file (or by what ``encode`` makes in a task) and gets
    the id ``end`` behind it. Only one longer than a sequence is cut, into whole sequences and a
    rest. ``ids`` are little-endian unsigned 32-bit numbers, ``start`` is how many stand before
    the piece in its text, ``offset`` its place in the sequence.

    Every task packs what it scans by best fit, longest first, ``GROUP_TOKENS`` at a time. A bin
    into which nothing fits that is left anywhere is done. The others are items of further
    rounds, in which ``FAN_IN`` neighbours meet in one task, until one is left: names and fills
    travel, no ids. A group leaves at most one bin that is half full or less, so all rounds
    move no more bins than there were groups, and at most so many of one fill are of use.
    Texts never move: the moves, a row for each group at most, are joined to them.

    Null and empty texts are the one id ``end``. Null ids and repeated rows are rows like any
    other; an empty table gives none. Other columns are not looked at.
    """
    def code() -> Callable[[pa.Array], Iterable[bytes]]:
        if encode is None:
            return column_encoder(tokenizer)
        of_text = encode()
        return lambda texts: map(of_text, texts.to_pylist())

    kept = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    placed = pinned(local_bins(kept, code, capacity, end))
    open_ = placed.where(F.col("fill") < capacity).select("bin", "fill", "part")
    span, rounds = 1, []
    while True:
        left = open_.agg(F.count(F.lit(1)).alias("n"), F.min("fill").alias("least"), F.max("part").alias("last"),
                         F.count(F.when(F.col("fill") <= capacity // 2, F.lit(1))).alias("small")).first()
        if left["n"] < 2 or not left["small"]:
            break
        span *= FAN_IN
        fitting = open_.where(F.col("fill") <= capacity - left["least"])
        done = pinned(merged(fitting, span, left["small"], capacity))
        rounds.append(done.where(F.col("into").isNotNull()).select("bin", "into", "shift"))
        open_ = done.where(F.col("into").isNull()).select("bin", "fill", "part")
        if span > left["last"]:
            break
    moves = None
    for round_ in reversed(rounds):  # a bin may move on with all that it has taken
        if moves is None:
            moves = round_
            continue
        later = moves.select(F.col("bin").alias("into"), F.col("into").alias("_last"), F.col("shift").alias("_more"))
        moves = moves.union(round_.join(later, "into", "left").select(
            "bin", F.coalesce("_last", "into").alias("into"), (F.col("shift") + F.coalesce("_more", F.lit(0))).alias("shift")))
    if moves is not None:
        placed = placed.join(F.broadcast(moves), "bin", "left")  # a row for each group of the first round at most
        placed = placed.withColumn("bin", F.coalesce("into", "bin")).withColumn(
            "offset", F.col("offset") + F.coalesce("shift", F.lit(0)))
    return placed.select(F.col("id").alias(id), "piece", "start", "ids", F.col("bin").alias("sequence_id"), "offset")
