"""Document fingerprints by Order MinHash, with DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, pinned

#: Slots of a fingerprint (a power of two), k-mers per slot, words per k-mer.
SLOTS, PICKED, WIDTH = 32, 2, 2
#: A k-mer is one long: a hash above a position, together 63 bits.
HASH_BITS, PLACE_BITS = 36, 27
HEX = 8


def kmers(words: Column, width: int = WIDTH) -> Column:
    """All k-mers as ``hash << 27 | position``; fewer words than a k-mer are one k-mer."""
    last = F.greatest(F.size(words) - width, F.lit(0))
    full = F.transform(F.sequence(F.lit(0), last), lambda i: F.shiftleft(F.shiftrightunsigned(
        F.xxhash64(*[F.get(words, i + j) for j in range(width)]), 64 - HASH_BITS), PLACE_BITS).bitwiseOR(i.cast("long")))
    return F.when(F.size(words) > 0, full).otherwise(F.array().cast("array<bigint>"))


def value(kmer: Column) -> Column:
    return F.shiftright(kmer, PLACE_BITS)


def repeats(k: Column) -> Column:
    """The later occurrences of k-mers, hashed with the number of the occurrence, sorted.

    Equal k-mers are neighbours in the sorted array ``k``, by position. All but the first of a
    run are picked; among those a run starts where the hash differs from the one before.
    """
    again = F.filter(k, lambda x, i: (i > 0) & (value(x) == value(F.get(k, F.greatest(i - 1, F.lit(0))))))

    def rehashed(r: Column) -> Column:
        begin = F.filter(F.sequence(F.lit(0), F.size(r) - 1), lambda i: (i == 0) | (value(r[i]) != value(
            F.get(r, F.greatest(i - 1, F.lit(0))))))

        def runs(b: Column) -> Column:
            return F.flatten(F.transform(b, lambda start, n: F.transform(
                F.sequence(start, F.coalesce(F.get(b, n + 1), F.size(r)) - 1), lambda i: F.shiftleft(F.shiftrightunsigned(
                    F.xxhash64(value(r[i]), i - start + 1), 64 - HASH_BITS), PLACE_BITS).bitwiseOR(
                        r[i].bitwiseAND(F.lit((1 << PLACE_BITS) - 1))))))

        return F.when(F.size(r) > 0, F.sort_array(let(begin, runs))).otherwise(r)

    return let(again, rehashed)


def fingerprint(text: Column) -> Column:
    """``SLOTS`` times eight hexadecimal digits.

    Slot s orders the occurrence-numbered k-mers by hash XOR s in the top bits, takes the two
    least, puts them back into the order of the text and hashes the pair. A random hash XOR a
    number is as random, so every slot is a fair sample; equal slots estimate how much of the
    text, and of its order, two texts share. Within a part of the hashes, those with equal
    top bits, every slot keeps the order, so only the first two of each part can be among the
    least of any slot: they are picked once, and the slots sort those few.

    A text without words has slots of nothing; all such texts are equal.
    """
    bits = SLOTS.bit_length() - 1
    part = lambda x: F.shiftright(x, HASH_BITS + PLACE_BITS - bits)
    place = F.lit((1 << PLACE_BITS) - 1)

    def first_of_parts(k: Column) -> Column:
        return F.filter(k, lambda x, i: (i < PICKED) | (part(x) != part(F.get(k, F.greatest(i - PICKED, F.lit(0))))))

    def few(k: Column) -> Column:
        firsts = F.filter(k, lambda x, i: (i == 0) | (value(x) != value(F.get(k, F.greatest(i - 1, F.lit(0))))))
        both = F.concat(let(firsts, first_of_parts), let(repeats(k), first_of_parts))
        return let(F.sort_array(both), first_of_parts)

    def slots(few: Column) -> Column:
        def slot(s: Column) -> Column:
            flip = F.shiftleft(s.cast("long"), HASH_BITS + PLACE_BITS - bits)
            # with all parts full the two least of slot s are those of part s, already in order
            least = F.when(F.size(few) == SLOTS * PICKED, F.slice(few, s * PICKED + 1, PICKED)).otherwise(
                F.transform(F.slice(F.sort_array(F.transform(few, lambda x: x.bitwiseXOR(flip))), 1, PICKED),
                            lambda x: x.bitwiseXOR(flip)))

            def pair(m: Column) -> Column:
                a, b = F.get(m, F.lit(0)), F.get(m, F.lit(1))
                in_order = b.isNull() | (a.bitwiseAND(place) < b.bitwiseAND(place))
                return F.when(in_order, F.xxhash64(value(a), value(b))).otherwise(F.xxhash64(value(b), value(a)))

            return F.lower(F.substring(F.lpad(F.hex(let(least, pair)), 16, "0"), 1, HEX))

        return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), slot), "")

    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")
    return let(words, lambda w: let(F.sort_array(kmers(w)), lambda k: let(few(k), slots)))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal slots, 0 to 1."""
    slots = F.sequence(F.lit(0), F.lit(SLOTS - 1))
    same = F.aggregate(slots, F.lit(0), lambda n, i: n + (
        F.substr(a, i * HEX + 1, F.lit(HEX)) == F.substr(b, i * HEX + 1, F.lit(HEX))).cast("int"))
    return same / F.lit(float(SLOTS))


def successors(ids: DataFrame, id: str) -> DataFrame:
    """``ids``, distinct ones, with the ``next`` id in ascending order; the first follows the last.

    Ids are dealt out by range once and pinned; each range links its own, and the last id of a
    range is followed by the first of the next one: one row per range.
    """
    dealt = pinned(ids.repartitionByRange(id).withColumn("_range", F.spark_partition_id()))
    inside = Window.partitionBy("_range").orderBy(id)
    edges = dealt.groupBy("_range").agg(F.min(id).alias("_first"))
    order = Window.orderBy("_range")
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = edges.select("_range", F.coalesce(F.lead("_first").over(order), F.min("_first").over(every)).alias("_after"))
    return (dealt.withColumn("_lead", F.lead(id).over(inside)).join(F.broadcast(after), "_range")  # one row per range
            .select(*ids.columns, F.coalesce("_lead", "_after").alias("next")))


def edited(docs: DataFrame, *, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``(id, next, text, edited)``: each text, and the text with its last quarter exchanged.

    The last floor(n / 4) of n code points are replaced by the first as many of the next text, or all
    it has. The next document is the one with the next larger id, of the last one the first; a
    single document is followed by itself.

    Null texts are empty. Of rows that share an id the least text stands for it as a neighbour,
    and each row is edited. A row without an id has no neighbour: its last quarter is cut off.
    Other columns are not looked at.

    Texts are moved once, by id: of a neighbour only the head that is taken travels on.
    """
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    named = rows.where(F.col("id").isNotNull())
    sizes = named.groupBy("id").agg(F.max(F.length("text")).alias("n"))
    order = pinned(successors(sizes, "id"))
    taken = order.select(F.col("next").alias("id"), F.col("id").alias("of"), F.floor(F.col("n") / 4).cast("int").alias("take"))
    # both joins deal out the same columns by id, so their exchange of texts is one
    heads = named.join(taken, "id").groupBy("of").agg(F.min(F.substr("text", F.lit(1), F.col("take"))).alias("head"))
    joined = named.join(order.select("id", "next"), "id").join(heads.withColumnRenamed("of", "id"), "id", "left")
    alone = rows.where(F.col("id").isNull()).withColumns({"next": F.lit(None).cast(rows.schema["id"].dataType), "head": F.lit("")})
    n, quarter = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    changed = F.concat(F.substr("text", F.lit(1), n - quarter), F.substr(F.coalesce("head", F.lit("")), F.lit(1), quarter))
    return joined.unionByName(alone).select("id", "next", "text", changed.alias("edited"))


def compared(pairs: DataFrame, *kept: Column) -> DataFrame:
    """Fingerprints of what ``edited`` returns: ``id``, the columns ``kept`` (of that input),
    ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next``.

    The last two are shares of equal slots with the edited text and with the next document;
    of rows that share an id the least fingerprint stands for the neighbour. A row without a next
    one has ``near_next`` 0.
    """
    prints = pinned(pairs.select("id", "next", *kept, fingerprint(F.col("text")).alias("fingerprint"),
                                 fingerprint(F.col("edited")).alias("edited_fingerprint")))
    others = prints.groupBy(F.col("id").alias("next")).agg(F.min("fingerprint").alias("_other"))
    own = [c for c in prints.columns if c != "next"]
    return prints.join(others, "next", "left").select(
        *own, likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        F.coalesce(likeness(F.col("fingerprint"), F.col("_other")), F.lit(0.0)).alias("near_next"))
