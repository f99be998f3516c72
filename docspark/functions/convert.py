"""Conversions between stored and used values, as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Named date formats and the pattern each stands for. Formats on week-based
# years are not offered.
DATE_FORMATS = {
    "basic_date": "yyyyMMdd",
    "basic_date_time": "yyyyMMdd'T'HHmmss.SSSXXX",
    "basic_date_time_no_millis": "yyyyMMdd'T'HHmmssXXX",
    "basic_ordinal_date": "yyyyDDD",
    "basic_ordinal_date_time": "yyyyDDD'T'HHmmss.SSSXXX",
    "basic_ordinal_date_time_no_millis": "yyyyDDD'T'HHmmssXXX",
    "basic_time": "HHmmss.SSSXXX",
    "basic_time_no_millis": "HHmmssXXX",
    "basic_t_time": "'T'HHmmss.SSSXXX",
    "basic_t_time_no_millis": "'T'HHmmssXXX",
    "date": "yyyy-MM-dd",
    "strict_date": "yyyy-MM-dd",
    "date_hour": "yyyy-MM-dd'T'HH",
    "date_hour_minute": "yyyy-MM-dd'T'HH:mm",
    "date_hour_minute_second": "yyyy-MM-dd'T'HH:mm:ss",
    "date_hour_minute_second_fraction": "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "date_hour_minute_second_millis": "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "date_time": "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "date_time_no_millis": "yyyy-MM-dd'T'HH:mm:ssXXX",
    "date_optional_time": "yyyy-MM-dd['T'HH:mm[:ss[.SSS]][XXX]]",
    "strict_date_optional_time": "yyyy-MM-dd['T'HH:mm[:ss[.SSS]][XXX]]",
    "strict_date_optional_time_nanos": "yyyy-MM-dd['T'HH:mm[:ss[.SSSSSSSSS]][XXX]]",
    "hour": "HH",
    "hour_minute": "HH:mm",
    "hour_minute_second": "HH:mm:ss",
    "hour_minute_second_fraction": "HH:mm:ss.SSS",
    "hour_minute_second_millis": "HH:mm:ss.SSS",
    "ordinal_date": "yyyy-DDD",
    "ordinal_date_time": "yyyy-DDD'T'HH:mm:ss.SSSXXX",
    "ordinal_date_time_no_millis": "yyyy-DDD'T'HH:mm:ssXXX",
    "time": "HH:mm:ss.SSSXXX",
    "time_no_millis": "HH:mm:ssXXX",
    "t_time": "'T'HH:mm:ss.SSSXXX",
    "t_time_no_millis": "'T'HH:mm:ssXXX",
    "year": "yyyy",
    "year_month": "yyyy-MM",
    "year_month_day": "yyyy-MM-dd",
}


def _pattern(name: str) -> str:
    """The pattern of a named format, strict or not, or the pattern itself."""
    plain = name.removeprefix("strict_")
    if name in DATE_FORMATS or plain in DATE_FORMATS:
        return DATE_FORMATS.get(name) or DATE_FORMATS[plain]
    if re.fullmatch(r"[a-z]+(_[a-z]+)+", name):
        raise ValueError(f"unknown date format {name!r}")
    return name


def parse_date(text: Column, formats: Sequence[str] | str) -> Column:
    """The first format that fits; ``epoch_millis`` and ``epoch_second`` are numbers
    (seconds may have a fraction)."""
    tries = []
    for name in [formats] if isinstance(formats, str) else formats:
        if name == "epoch_millis":
            tries.append(F.timestamp_millis(text.try_cast("long")))
        elif name == "epoch_second":
            tries.append(F.timestamp_micros((text.try_cast("double") * 1e6).cast("long")))
        else:
            tries.append(F.try_to_timestamp(text, F.lit(_pattern(name))))
    return F.coalesce(*tries)


def format_date(value: Column, format: str) -> Column:
    if format == "epoch_millis":
        return F.unix_millis(value.cast("timestamp")).cast("string")
    if format == "epoch_second":
        return (F.unix_micros(value.cast("timestamp")) / 1e6).cast("string")
    return F.date_format(value, _pattern(format))


# --- ranges ------------------------------------------------------------------------------------


def make_range(lo: Column, hi: Column, lo_incl: bool = True, hi_incl: bool = True) -> Column:
    return F.struct(lo.alias("lo"), hi.alias("hi"), F.lit(lo_incl).alias("lo_incl"),
                    F.lit(hi_incl).alias("hi_incl"))


def range_from_json(text: Column, bound: str) -> Column:
    """``{"gte": .., "lt": ..}`` to a range; a missing side is open."""
    m = F.from_json(text, f"gt {bound}, gte {bound}, lt {bound}, lte {bound}")
    return F.when(m.isNotNull(), F.struct(
        F.coalesce(m["gte"], m["gt"]).alias("lo"), F.coalesce(m["lte"], m["lt"]).alias("hi"),
        m["gt"].isNull().alias("lo_incl"), m["lt"].isNull().alias("hi_incl")))


def range_to_json(r: Column) -> Column:
    return F.to_json(F.struct(
        F.when(~r["lo_incl"], r["lo"]).alias("gt"), F.when(r["lo_incl"], r["lo"]).alias("gte"),
        F.when(~r["hi_incl"], r["hi"]).alias("lt"), F.when(r["hi_incl"], r["hi"]).alias("lte")))


def _starts_before(value: Column, hi: Column, incl: Column) -> Column:
    return hi.isNull() | F.when(incl, value <= hi).otherwise(value < hi)


def _ends_after(value: Column, lo: Column, incl: Column) -> Column:
    return lo.isNull() | F.when(incl, value >= lo).otherwise(value > lo)


def range_contains(r: Column, value: Column) -> Column:
    inside = _ends_after(value, r["lo"], r["lo_incl"]) & _starts_before(value, r["hi"], r["hi_incl"])
    return F.when(r.isNotNull(), inside)


def ranges_intersect(a: Column, b: Column) -> Column:
    """Two ranges share a value."""
    def reaches(x, y):
        closed = x["hi_incl"] & y["lo_incl"]
        return (x["hi"].isNull() | y["lo"].isNull()
                | F.when(closed, x["hi"] >= y["lo"]).otherwise(x["hi"] > y["lo"]))
    return F.when(a.isNotNull() & b.isNotNull(), reaches(a, b) & reaches(b, a))


def range_within(inner: Column, outer: Column) -> Column:
    low = outer["lo"].isNull() | (inner["lo"] > outer["lo"]) | (
        (inner["lo"] == outer["lo"]) & (outer["lo_incl"] | ~inner["lo_incl"]))
    high = outer["hi"].isNull() | (inner["hi"] < outer["hi"]) | (
        (inner["hi"] == outer["hi"]) & (outer["hi_incl"] | ~inner["hi_incl"]))
    return F.when(inner.isNotNull() & outer.isNotNull(),
                  F.coalesce(low, F.lit(False)) & F.coalesce(high, F.lit(False)))


# --- addresses -----------------------------------------------------------------------------------


# Fixed value: the text form of a v4 address.
IPV4_PATTERN = r"^((25[0-5]|2[0-4]\d|1?\d?\d)(\.(?!$)|$)){4}$"


def ip_to_long(ip: Column) -> Column:
    """A dotted v4 address as a number; null if it is none."""
    number = F.aggregate(F.split(ip, r"\."), F.lit(0).cast("long"),
                         lambda n, octet: n * 256 + octet.cast("long"))
    return F.when(ip.rlike(IPV4_PATTERN), number)


def _ip_number(ip: str) -> int:
    a, b, c, d = (int(x) for x in ip.split("."))
    return ((a * 256 + b) * 256 + c) * 256 + d


def ip_between(ip: Column, low: str, high: str) -> Column:
    """Inclusive. The distance from the middle is compared, so the address is parsed once."""
    a, b = _ip_number(low), _ip_number(high)
    return F.abs(ip_to_long(ip) * 2 - (a + b)) <= b - a


def ip_in_network(ip: Column, cidr: str) -> Column:
    base, bits = cidr.split("/")
    host = 32 - int(bits)
    return F.shiftright(ip_to_long(ip), host) == _ip_number(base) >> host


# --- scalars -------------------------------------------------------------------------------------


def scaled_float(value: Column, factor: float) -> Column:
    return F.round(value * float(factor)) / float(factor)


def to_base64(value: Column) -> Column:
    return F.base64(value.cast("binary"))


def from_base64(value: Column) -> Column:
    return F.unbase64(value)


# Fixed value: the text form of a UUID.
UUID_PATTERN = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


def parse_uuid(text: Column) -> Column:
    """Canonical lower-case form, null if it is no UUID."""
    return F.when(text.rlike(UUID_PATTERN), F.lower(text))


def decimal_to_double(value: Column) -> Column:
    return value.cast("double")


def json_path(text: Column, path: str) -> Column:
    """A dotted path in a JSON string."""
    return F.get_json_object(text, "$." + path)


def flatten_struct(df: DataFrame, separator: str = ".") -> DataFrame:
    """Struct leaves as top-level columns named by their dotted path."""
    out = []

    def walk(struct: T.StructType, column: str, prefix: str):
        for f in struct.fields:
            here = f"{column}.`{f.name}`" if column else f"`{f.name}`"
            name = f"{prefix}{separator}{f.name}" if prefix else f.name
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType, here, name)
            else:
                out.append(F.col(here).alias(name))

    walk(df.schema, "", "")
    return df.select(*out)


def kebab_case(name: str) -> str:
    """``lastName`` and ``last_name`` to ``last-name``."""
    parts = re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", name)
    return "-".join(p.lower() for p in parts)


def snake_case(name: str) -> str:
    return kebab_case(name).replace("-", "_")


def rename_fields(df: DataFrame, strategy=kebab_case) -> DataFrame:
    return df.withColumnsRenamed({c: strategy(c) for c in df.columns})
