"""Parsing of packed text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings of a missing value (fixed values).
MISSING = (".", "", "NA", "0", "-9")


def null_if_missing(c: Column, zero: bool = True) -> Column:
    """Null for a spelling of a missing value; zero: whether 0 is one."""
    return F.when(~F.trim(c).isin(*[m for m in MISSING if zero or m != "0"]), c)


def parse_info(c: Column) -> Column:
    """INFO text as a map; flags without '=' are left out."""
    return F.map_filter(F.str_to_map(c, F.lit(";"), F.lit("=")), lambda _, v: v.isNotNull())


def parse_format(fmt: Column, value: Column) -> Column:
    """FORMAT and sample text as a map; trailing fields that the sample leaves out are null."""
    names = F.split(fmt, ":")
    values = F.split(value, ":")
    return F.map_from_arrays(names, F.transform(names, lambda _, i: F.get(values, i)))


def parse_list(c: Column) -> Column:
    """[a, b] as an array of text."""
    inner = F.regexp_replace(c, r"^\s*\[|\]\s*$|['\"\s]", "")
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, ","))


def number(c: str, default: float | None = None) -> Column:
    """A text as a double; blank is `default`, unreadable is null."""
    value = F.expr(f"try_cast({c} AS DOUBLE)")
    return value if default is None else F.when(F.trim(F.col(c)) == "", F.lit(float(default))).otherwise(value)


def sex_code(c: Column) -> Column:
    """1 male, 2 female, 0 otherwise."""
    return F.when(F.lower(c).isin("male", "m", "1"), 1).when(F.lower(c).isin("female", "f", "2"), 2).otherwise(0)


def slug(c: Column) -> Column:
    """Lower-case words joined by underscores."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_|_$", "")


def human_size(c: Column) -> Column:
    """A base-pair length with its unit."""
    return F.when(c >= 1_000_000, F.concat(F.floor(c / 1_000_000).cast("string"), F.lit("Mb"))).when(c >= 1000, F.concat(F.floor(c / 1000).cast("string"), F.lit("kb"))).otherwise(F.concat(c.cast("string"), F.lit("bp")))
