"""Helpers on columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """df with further columns, worked out once a row: later filters on them are not rewritten into their formulas."""
    return df.select("*", F.inline_outer(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
