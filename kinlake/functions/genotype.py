"""Expressions on genotype entries. A call is two allele numbers (a1, a2); a null a1 is a missing call."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY = ["contig", "pos", "ref", "alt"]


def n_alt(a1: str = "a1", a2: str = "a2") -> Column:
    """Alternate alleles of a biallelic call."""
    return (F.col(a1) > 0).cast("int") + (F.col(a2) > 0).cast("int")


def is_defined() -> Column:
    return F.col("a1").isNotNull()


def is_hom_ref() -> Column:
    return (F.col("a1") == 0) & (F.col("a2") == 0)


def is_het() -> Column:
    return F.col("a1") != F.col("a2")


def is_hom_var() -> Column:
    return (F.col("a1") == F.col("a2")) & (F.col("a1") > 0)


def is_non_ref() -> Column:
    return (F.col("a1") > 0) | (F.col("a2") > 0)


def total(reads: str = "AD") -> Column:
    return F.aggregate(F.col(reads), F.lit(0), lambda a, x: a + x)


def ratio(a: Column, b: Column) -> Column:
    """a / b as a double, null where b is 0."""
    return F.when(b != 0, a.cast("double") / b)


def allele_balance() -> Column:
    """AB: reads of the alternate allele over all allele reads."""
    return ratio(F.get("AD", F.lit(1)), total())


def vaf() -> Column:
    return ratio(F.get("AD", F.lit(1)), F.col("DP"))


def filled_ad(default_dp: int | None = None) -> Column:
    """AD, or [DP, 0] where it is missing in a hom-ref call (with default_dp: [default_dp, 0] in any call)."""
    if default_dp is not None:
        return F.coalesce("AD", F.array(F.lit(default_dp), F.lit(0)))
    return F.when(F.col("AD").isNull() & is_hom_ref(), F.array(F.col("DP"), F.lit(0))).otherwise(F.col("AD"))


def filled_pl() -> Column:
    """PL, or [0, GQ, max(GQ, 3 (AD0 - AD1))] where it is missing in a hom-ref call. Takes AD as filled."""
    guess = F.array(F.lit(0), F.col("GQ"), F.greatest(F.col("GQ"), 3 * (F.get("AD", F.lit(0)) - F.get("AD", F.lit(1)))))
    return F.when(F.col("PL").isNull() & is_hom_ref(), guess).otherwise(F.col("PL"))


def zero_pl() -> Column:
    """PL, or zeros where it is missing."""
    return F.coalesce("PL", F.array(F.lit(0), F.lit(0), F.lit(0)))


def diploid(alleles: Column) -> Column:
    """A haploid call doubled; others as they are."""
    return F.when(F.size(alleles) == 1, F.array_repeat(F.get(alleles, F.lit(0)), 2)).otherwise(alleles)


def global_alleles(local: Column, la: Column) -> Column:
    """Local allele numbers mapped through the list of global ones; missing stays missing."""
    return F.transform(local, lambda a: F.when(a.isNotNull(), F.get(la, a)))


def split_pl(pl: Column, allele: Column, alleles: int) -> Column:
    """PL of the biallelic split: for each number of copies of `allele` the least PL of a genotype with as many."""
    pairs = [(j, k) for k in range(alleles) for j in range(k + 1)]
    copies = lambda j, k: (F.lit(j) == allele).cast("int") + (F.lit(k) == allele).cast("int")
    least = lambda n: F.array_min(F.array(*[F.when(copies(j, k) == n, F.get(pl, F.lit(i))) for i, (j, k) in enumerate(pairs)]))
    return F.array(least(0), least(1), least(2))


def phred_to_probabilities(pl: str) -> Column:
    """10^(-PL/10), scaled to sum 1."""
    raw = F.transform(F.col(pl), lambda x: F.pow(F.lit(10.0), -x / 10))
    whole = F.aggregate(raw, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raw, lambda x: x / whole)
