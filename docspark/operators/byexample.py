"""Query by example: rows of a probe table stand for the criteria their values spell."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import islice

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import criteria as C
from ..schema import DocSchema
from ..session import pinned

#: Probes by pattern alone that are checked in one scan.
PROBES = 256
MATCHERS = ("default", "exact", "starting", "ending", "containing", "regex")


def _check(matchers: Mapping[str, str], ignore_case: bool):
    if ignore_case:
        raise ValueError("examples match case only")
    bad = set(matchers.values()) - set(MATCHERS)
    if bad:
        raise ValueError(f"unknown matchers {sorted(bad)}, use {MATCHERS}")


def example_criteria(probe: Mapping, schema: DocSchema, *, match: str = "all",
                     matchers: Mapping[str, str] | None = None, ignore: Sequence[str] = (),
                     include_nulls: bool = False, ignore_case: bool = False) -> C.Node:
    """One literal probe as a criteria node. Collections and the version are skipped; a
    null is skipped, or asks for absence with ``include_nulls``."""
    matchers = matchers or {}
    _check(matchers, ignore_case)
    make = {"default": C.is_, "exact": C.matches_all, "starting": C.starts_with,
            "ending": C.ends_with, "containing": C.contains, "regex": C.regexp}
    parts: list[C.Node] = []
    for name, value in probe.items():
        if name in ignore or name == schema.version or isinstance(value, (list, tuple, set)):
            continue
        if value is None:
            if include_nulls or name in matchers:
                parts.append(~C.exists(name))
        elif isinstance(value, Mapping):
            inner = {f"{name}.{k}": v for k, v in value.items()}
            parts.append(example_criteria(inner, schema, match=match, matchers=matchers,
                                          ignore=ignore, include_nulls=include_nulls))
        else:
            parts.append(make[matchers.get(name, "default")](name, value))
    if not parts:
        return C.MatchAll()
    return C.Bool(must=tuple(parts)) if match == "all" else C.Bool(should=tuple(parts), min_should=1)


def match_examples(docs: DataFrame, probes: DataFrame, fields: Sequence[str], *, probe_id: str,
                   matchers: Mapping[str, str] | None = None,
                   include_nulls: bool = False) -> DataFrame:
    """All (probe, document) matches for a table of probes, mode ALL.

    A probe constrains the fields it fills. Probes with the same filled fields share one
    equi-join on exactly those that compare by equality; other matchers refine the pairs.
    Which fields are filled together is looked up first: one number per combination that occurs.
    Probes that fill no field that compares by equality match by pattern alone (one without any
    field matches all documents). They are read ``PROBES`` at a time and become one condition each, checked in
    one scan of the documents; where there are more than one such block, its pairs are stored before the
    next one is read, so neither the driver nor a plan holds more than a block.
    """
    matchers = matchers or {}
    _check(matchers, False)
    equal = [f for f in fields if matchers.get(f, "default") in ("default", "exact")]
    other = [f for f in fields if f not in equal]
    renamed = probes.select(F.col(probe_id), *[F.col(f).alias(f"_q_{f}") for f in fields])
    filled = F.lit(0)
    for i, f in enumerate(equal):
        filled = filled + F.when(F.col(f"_q_{f}").isNotNull(), F.lit(1 << i)).otherwise(F.lit(0))
    masks = sorted(r[0] for r in renamed.select(filled.alias("m")).distinct().collect())
    out = None
    if masks[:1] == [0]:
        rows = renamed.where(filled == 0).distinct().toLocalIterator()
        block = list(islice(rows, PROBES))
        while block:
            found = F.array(*[F.when(_by_pattern(row, equal, other, matchers, include_nulls), F.lit(row[probe_id]))
                              for row in block])
            part = docs.withColumn(probe_id, F.explode(F.array_compact(found)))
            block = list(islice(rows, PROBES))
            if block or out is not None:
                part = pinned(part)
            out = part if out is None else out.unionByName(part)
    for mask in masks:
        if mask == 0:
            continue
        used = [f for i, f in enumerate(equal) if mask >> i & 1]
        part = renamed
        for f in equal:
            q = F.col(f"_q_{f}")
            part = part.where(q.isNotNull() if f in used else q.isNull())
        left = docs
        if include_nulls:
            for f in equal:
                if f not in used:
                    left = left.where(F.col(f).isNull())
        cond: Column = F.lit(True)
        for f in used:
            cond = cond & (F.col(f) == F.col(f"_q_{f}"))
        for f in other:
            cond = cond & _pattern(F.col(f), F.col(f"_q_{f}"), matchers[f], include_nulls)
        joined = left.join(part, cond).drop(*[f"_q_{f}" for f in fields])
        out = joined if out is None else out.unionByName(joined)
    return docs.join(renamed.where(F.lit(False)), F.lit(False)).select(*docs.columns, probe_id) if out is None else out


def _by_pattern(row, equal: Sequence[str], other: Sequence[str], matchers: Mapping[str, str],
                include_nulls: bool) -> Column:
    cond: Column = F.lit(True)
    for f in other:
        cond = cond & _pattern(F.col(f), F.lit(row[f"_q_{f}"]), matchers[f], include_nulls)
    for f in equal if include_nulls else ():
        cond = cond & F.col(f).isNull()
    return cond


def _pattern(value: Column, probe: Column, matcher: str, include_nulls: bool) -> Column:
    hit = {"starting": F.startswith(value, probe), "ending": F.endswith(value, probe),
           "containing": F.contains(value, probe),
           "regex": F.rlike(value, F.concat(F.lit("^(?:"), probe, F.lit(")$")))}[matcher]
    absent = value.isNull() if include_nulls else F.lit(True)
    return F.when(probe.isNull(), absent).otherwise(F.coalesce(hit, F.lit(False)))
