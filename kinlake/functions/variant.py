"""Expressions on alleles and variant names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def length_change(ref: str = "ref", alt: str = "alt") -> Column:
    return F.abs(F.length(ref) - F.length(alt))


def is_snp(ref: str = "ref", alt: str = "alt") -> Column:
    return (F.length(ref) == 1) & (F.length(alt) == 1) & (F.col(ref) != F.col(alt))


def is_transition(ref: str = "ref", alt: str = "alt") -> Column:
    return is_snp(ref, alt) & F.concat(ref, alt).isin("AG", "GA", "CT", "TC")


def variant_type(ref: str = "ref", alt: str = "alt") -> Column:
    """SNV where the length stays, else Indel."""
    return F.when(length_change(ref, alt) == 0, "SNV").otherwise("Indel")


def indel_type(ref: str = "ref", alt: str = "alt") -> Column:
    return F.when(F.length(alt) > F.length(ref), "Insertion").when(F.length(alt) < F.length(ref), "Deletion")


def variant_id() -> Column:
    return F.concat_ws(":", "contig", F.col("pos").cast("string"), "ref", "alt")


def varkey(sample: str = "s") -> Column:
    return F.concat_ws(":", "contig", F.col("pos").cast("string"), "ref", "alt", sample)


def parse_variant(name: str) -> list[Column]:
    """contig, pos, ref, alt from contig:pos:ref:alt."""
    parts = F.split(name, ":")
    return [F.get(parts, F.lit(0)).alias("contig"), F.expr(f"try_cast(get(split({name}, ':'), 1) AS INT)").alias("pos"), F.get(parts, F.lit(2)).alias("ref"), F.get(parts, F.lit(3)).alias("alt")]
