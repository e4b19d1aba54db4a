"""Predicates on positions. Pseudoautosomal regions are fixed values of the genome builds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Pseudoautosomal regions, first and last position (fixed values).
PAR = {
    "GRCh38": {"X": [(10001, 2781479), (155701383, 156030895)], "Y": [(10001, 2781479), (56887903, 57217415)]},
    "GRCh37": {"X": [(60001, 2699520), (154931044, 155260560)], "Y": [(10001, 2649520), (59034050, 59363566)]},
}


def bare(contig: str = "contig") -> Column:
    return F.regexp_replace(F.col(contig), "^chr", "")


def contig_order(contig: str = "contig") -> Column:
    """1 to 22, X 23, Y 24, mitochondrion 25; null for others."""
    b = bare(contig)
    return F.when(b == "X", 23).when(b == "Y", 24).when(b.isin("M", "MT"), 25).otherwise(F.expr(f"try_cast(regexp_replace({contig}, '^chr', '') AS INT)"))


def in_autosome(contig: str = "contig") -> Column:
    return F.coalesce(contig_order(contig).between(1, 22), F.lit(False))


def _par(sex: str, contig: str, pos: str, build: str) -> Column:
    inside = F.lit(False)
    for a, b in PAR[build][sex]:
        inside = inside | F.col(pos).between(a, b)
    return (bare(contig) == sex) & inside


def in_x_par(contig: str = "contig", pos: str = "pos", build: str = "GRCh38") -> Column:
    return _par("X", contig, pos, build)


def in_y_par(contig: str = "contig", pos: str = "pos", build: str = "GRCh38") -> Column:
    return _par("Y", contig, pos, build)


def in_x_nonpar(contig: str = "contig", pos: str = "pos", build: str = "GRCh38") -> Column:
    return (bare(contig) == "X") & ~_par("X", contig, pos, build)


def in_y_nonpar(contig: str = "contig", pos: str = "pos", build: str = "GRCh38") -> Column:
    return (bare(contig) == "Y") & ~_par("Y", contig, pos, build)


def in_mito(contig: str = "contig") -> Column:
    return bare(contig).isin("M", "MT")


def in_autosome_or_par(contig: str = "contig", pos: str = "pos", build: str = "GRCh38") -> Column:
    return in_autosome(contig) | in_x_par(contig, pos, build) | in_y_par(contig, pos, build)
