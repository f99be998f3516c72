"""Secret scans: listed patterns, and a battery of randomness tests over all other tokens."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, pinned

#: Kinds in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run that is long enough is found from its first character on, so the length can stand in the
#: pattern: nothing shorter would have hidden it.
ACCESS, HEX = r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}"
#: Candidates of the battery: runs with the marks of one encoding. A run that mixes both sets of
#: marks is split where a part meets a mark of the other set, so every long part is judged.
TOKEN = (r"[A-Za-z0-9+/]{20,}+(?![_-])|[A-Za-z0-9_-]{20,}+(?![+/])"
         r"|[A-Za-z0-9+/]{20,}+|[A-Za-z0-9_-]{20,}+")

#: Encodings, the narrowest first: name, pattern of the whole token, its alphabet in order.
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = [
    ("hex", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", DIGITS + "abcdef"),
    ("HEX", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", LOWER.upper() + "234567"),
    ("base36", r"^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+$", LOWER + DIGITS),
    ("base62", r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9]+$", LOWER.upper() + LOWER + DIGITS),
    ("base64", r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9+/]+$", LOWER.upper() + LOWER + DIGITS + "+/"),
    ("base64url", r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9_-]+$", LOWER.upper() + LOWER + DIGITS + "-_"),
]
#: Letter shares of running English in percent, a to z (fixed values).
ENGLISH = [8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1,
           2.8, 0.98, 2.4, 0.15, 2.0, 0.074]
#: Where the classes of lengths begin that the control tells apart, after the first.
LENGTHS = (24, 32, 48, 96)
#: What a token of text is taken to be: the share of digits and marks, and how often the class
#: of a character (upper case, lower case, digit, mark) changes to the next, in one case and in
#: two, where names in camel case change often.
OTHER, CHANGES, MIXED_CHANGES = 0.10, 0.20, 0.35
#: Serial correlation of the places of letters in words: vowels and consonants take turns.
SERIAL = -0.15


def spans(text: Column, pattern: str, kind: str, group: int = 0, least: int = 1) -> Column:
    """Spans ``(start, kind, end)`` of leftmost non-overlapping matches, in code points.

    What lies between the matches comes from a split by the same pattern, so the lengths of the
    pieces and matches before it give the place of each. Texts without a match are only searched.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found

    def placed(m: Column, pieces: Column, inner: Column) -> Column:
        steps = F.transform(m, lambda s, i: F.length(pieces[i]) + F.length(s))
        return let(let(steps, lambda s: running(s)), lambda e: F.filter(
            F.transform(m, lambda s, i: F.struct(
                (e[i] - F.length(s)).alias("start"), F.lit(kind).alias("kind"), e[i].alias("end"),
                F.length(inner[i]).alias("size"), s.alias("token"))),
            lambda s: s["size"] >= least))

    found_spans = let(found, lambda m: let(F.split(text, pattern, -1), lambda p: let(inner, lambda g: placed(m, p, g))))
    kind_of = "array<struct<start: int, kind: string, end: int, size: int, token: string>>"
    return F.when(F.rlike(text, F.lit(pattern)), found_spans).otherwise(F.array().cast(kind_of))


def running(steps: Column, part: int = 256) -> Column:
    """Running sums of an array, by parts, so that a text with very many matches stays cheap."""
    def sums(values: Column, start: Column) -> Column:
        return F.aggregate(values, F.array().cast("array<int>"), lambda done, x: F.concat(
            done, F.array(F.coalesce(F.try_element_at(done, F.lit(-1)), start) + x)))

    parts = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / part).cast("int"))
    cut = F.transform(parts, lambda k: F.slice(steps, k * part + 1, part))
    total = lambda values: F.aggregate(values, F.lit(0), lambda a, x: a + x)
    return let(cut, lambda c: let(sums(F.transform(c, total), F.lit(0)), lambda ends: F.flatten(F.transform(
        c, lambda values, k: sums(values, F.when(k > 0, ends[F.greatest(k - 1, F.lit(0))]).otherwise(0))))))


def normal_tail(z: Column) -> Column:
    """P(Z >= z), by the rational approximation of Abramowitz and Stegun, 26.2.17."""
    def tail(z: Column, t: Column) -> Column:
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        return let(F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * poly, lambda upper: F.greatest(
            F.when(z >= 0, upper).otherwise(1 - upper), F.lit(1e-300)))

    return let(z, lambda z: let(1 / (1 + 0.2316419 * F.abs(z)), lambda t: tail(z, t)))


def text_model(alphabet: str) -> tuple[float, float]:
    """What text has in an alphabet: the sums of p**2 and p**3 over the shares p of characters."""
    letters = {c: p / sum(ENGLISH) for c, p in zip(LOWER, ENGLISH)}
    raw = {}
    for c in alphabet:
        raw[c] = letters[c.lower()] * (0.15 if c.isupper() and c.lower() in alphabet else 1) if c.isalpha() else None
    others = sum(1 for p in raw.values() if p is None)
    total = sum(p for p in raw.values() if p is not None)
    share = [(1 - OTHER) * p / total if p is not None else OTHER / others for p in raw.values()]
    return sum(p ** 2 for p in share), sum(p ** 3 for p in share)


def battery(token: Column) -> Column:
    """A struct of the encoding and the p-value of a token; null where no encoding fits.

    The null hypothesis is text. Three statistics say how much more random the token is, each
    one-sided with mean and spread for its length: the chi-squared statistic against a uniform
    alphabet (too small for text, whose letters repeat), runs of character classes (too many),
    and the serial correlation of neighbours (not negative enough). Fisher's sum joins them; its
    six degrees of freedom give the p-value in closed form.
    """
    total = lambda values, of: F.aggregate(values, F.lit(0.0), lambda a, x: a + of(x))

    def uniform(c: Column, n: Column, e: Column) -> Column:
        # pairs of equal characters, a linear form of the chi-squared statistic
        pairs = (total(F.array_distinct(c), lambda x: F.pow(F.size(F.filter(c, lambda y: y == x)).cast("double"), F.lit(2.0))) - n) / 2
        spread = F.sqrt(n * (n - 1) / 2 * (e["p2"] - e["p2"] * e["p2"]) + n * (n - 1) * (n - 2) * (e["p3"] - e["p2"] * e["p2"]))
        return normal_tail((n * (n - 1) / 2 * e["p2"] - pairs) / F.greatest(spread, F.lit(1e-9)))

    def runs(k: Column, n: Column, e: Column) -> Column:
        changes = total(F.sequence(F.lit(1), F.size(k) - 1), lambda i: (F.element_at(k, i) != F.element_at(k, i + 1)).cast("double"))
        often = e["changes"]
        return normal_tail((changes - 0.5 - (n - 1) * often) / F.sqrt((n - 1) * often * (1 - often)))

    def serial(v: Column, n: Column) -> Column:
        mean = total(v, lambda x: x) / n
        return let(mean, lambda m: normal_tail((F.coalesce(F.try_divide(
            total(F.sequence(F.lit(1), F.size(v) - 1), lambda i: (F.element_at(v, i) - m) * (F.element_at(v, i + 1) - m)),
            total(v, lambda x: (x - m) * (x - m))), F.lit(0.0)) - SERIAL) * F.sqrt(n)))

    def p_value(c: Column, e: Column) -> Column:
        n = F.size(c).cast("double")
        kinds = F.transform(c, lambda x: F.translate(x, LOWER + LOWER.upper() + DIGITS, "a" * 26 + "A" * 26 + "0" * 10))
        places = F.transform(c, lambda x: F.instr(e["alphabet"], x).cast("double"))
        logs = (F.log(uniform(c, n, e)) + let(kinds, lambda k: F.log(runs(k, n, e)))
                + let(places, lambda v: F.log(serial(v, n))))
        return let(-logs, lambda half: F.exp(-half) * (1 + half + half * half / 2))

    kind = "struct<encoding: string, alphabet: string, p2: double, p3: double, changes: double>"
    model: Column = F.lit(None).cast(kind)
    for name, pattern, alphabet in reversed(ENCODINGS):
        p2, p3 = text_model(alphabet)
        often = MIXED_CHANGES if "a" in alphabet and "A" in alphabet else CHANGES
        known = F.struct(F.lit(name).alias("encoding"), F.lit(alphabet).alias("alphabet"), F.lit(p2).alias("p2"),
                         F.lit(p3).alias("p3"), F.lit(often).alias("changes"))
        model = F.when(F.rlike(token, F.lit(pattern)), known).otherwise(model)
    return let(model, lambda e: F.when(e.isNotNull(), F.struct(
        e["encoding"].alias("encoding"), let(F.split(token, "(?!^)"), lambda c: p_value(c, e)).alias("p"))))


def length_class(n: Column) -> Column:
    out = F.lit(len(LENGTHS))
    for i in range(len(LENGTHS) - 1, -1, -1):
        out = F.when(n < LENGTHS[i], i).otherwise(out)
    return out


def step_of(p: Column) -> Column:
    """A p-value in steps of a tenth of a decimal digit: those of step s are at most ``10 ** (-s / 10)``."""
    return F.least(F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-300)))), F.lit(3000)).cast("int")


def thresholds(steps: DataFrame, rate: float) -> dict[str, int]:
    """The least step that is sure in each class of ``(kind, step, n)``, by Benjamini-Hochberg in the class.

    A class is an encoding and a range of lengths, so there are a few dozen, each with at most
    3001 steps. Classes without a sure step are left out.
    """
    of = Window.partitionBy("kind")
    every = steps.select("kind", "step", F.sum("n").over(of.orderBy(F.col("step").desc()).rowsBetween(
        Window.unboundedPreceding, 0)).alias("below"), F.sum("n").over(of).alias("all"))
    holds = F.pow(F.lit(10.0), -F.col("step") / 10) * F.col("all") <= F.lit(rate) * F.col("below")
    return dict(every.where(holds).groupBy("kind").agg(F.min("step")).collect())


def scan(docs: DataFrame, *, text: str = "text", id: str = "doc_id", rate: float = 0.01,
         keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` with ``base``, the spans of the listed patterns, and ``spans``, all of them:
    arrays of ``(start, kind, end)`` by start and kind, in code points, end exclusive.

    Assignments are listed with values of 6 or more characters, access keys with 20 or more,
    hexadecimal runs with 24 or more. Other tokens of 20 or more characters are put to the
    battery. The false-discovery control knows lengths: how small a p-value random tokens reach
    hangs on how long they are and on their alphabet, so tokens are classed by encoding
    and length (``LENGTHS``), and Benjamini-Hochberg within a class, over all tokens of all texts, keeps
    the expected share of false ones at ``rate`` there. Long names and paths don't raise the bar for
    short keys. P-values are counted in steps, one small table. Tokens within a listed span are
    neither tested nor counted.

    Texts are scanned once: what is found, without the tokens, is stored with the columns to ``keep``
    (all if nothing is said) in the shared folder, and thresholds are applied to that.

    Null and empty texts have no spans; repeated rows are scanned, and counted, one by one. An empty
    table gives none. Other columns stay as they are; columns called ``base`` or ``spans`` are replaced.
    """
    columns = [c for c in (docs.columns if keep is None else keep) if c not in ("base", "spans")]
    inner = "_found" + "_" * max(map(len, docs.columns))  # longer than any column's name
    body = F.coalesce(F.col(text), F.lit(""))

    def merged(*parts: Column) -> Column:
        def with_rank(part: Column, rank: int) -> Column:
            return F.transform(part, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))

        ranked = [with_rank(part, rank) for rank, part in enumerate(parts)]
        kinds = F.array(*[F.lit(k) for k in KINDS])
        return F.transform(F.array_sort(F.concat(*ranked)), lambda s: F.struct(
            s["start"].alias("start"), kinds[s["rank"]].alias("kind"), s["end"].alias("end")))

    listed = F.struct(spans(body, ASSIGN, "assign", 2, 6).alias("a"), spans(body, ACCESS, "access").alias("k"),
                      spans(body, HEX, "hex").alias("h"), spans(body, TOKEN, "random").alias("t"))

    def places(part: Column) -> Column:
        return F.transform(part, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))

    def judged(s: Column) -> Column:
        kind = lambda b: F.concat_ws(":", b["encoding"], length_class(F.length(s["token"])).cast("string"))
        return let(battery(s["token"]), lambda b: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.when(b.isNotNull(), kind(b)).alias("kind"), step_of(b["p"]).alias("step")))

    def tested(f: Column) -> Column:
        every = F.concat(f["a"], f["k"], f["h"])
        other = F.filter(f["t"], lambda s: ~F.exists(every, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])))
        return F.struct(places(f["a"]).alias("a"), places(f["k"]).alias("k"), places(f["h"]).alias("h"),
                        F.filter(F.transform(other, judged), lambda s: s["kind"].isNotNull()).alias("t"))

    found = pinned(docs.select(*[F.col(c) for c in columns], let(listed, tested).alias(inner)))
    steps = (found.select(F.explode(F.col(inner)["t"]).alias("t")).groupBy(F.col("t.kind").alias("kind"), F.col("t.step").alias("step"))
             .agg(F.count(F.lit(1)).alias("n")))
    limits = thresholds(steps, rate)
    limit = F.create_map(*[F.lit(x) for pair in sorted(limits.items()) for x in pair]) if limits else F.create_map().cast("map<string,int>")
    sure = F.filter(F.col(inner)["t"], lambda s: F.coalesce(s["step"] >= F.try_element_at(limit, s["kind"]), F.lit(False)))
    three = [F.col(inner)[kind] for kind in ("a", "k", "h")]
    return found.select(*columns, merged(*three).alias("base"), merged(*three, sure).alias("spans"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones as one, replaced by ``mark``."""
    empty = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substr(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        inside = (s["start"] < state["at"]) & (state["at"] > 0)
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"),
                        F.when(inside, state["done"]).otherwise(F.concat(state["done"], gap, F.lit(mark))).alias("done"))

    whole = F.aggregate(spans, empty, step, lambda s: F.concat(s["done"], F.substr(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
