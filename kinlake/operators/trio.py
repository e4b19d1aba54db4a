"""Trio operators: the trio matrix, Mendel errors, phase by transmission, transmission tests.

Parents' and child's calls are counts of alternate alleles in the copy state of the place: on one-copy places a call of two
equal alleles counts as that one allele.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import genotype as gt
from ..functions import locus
from ..functions.columns import computed
from .pedigree import trio_members

ENTRY = ["a1", "a2", "AD", "DP", "GQ", "PL"]
#: What calls need.
CALL = ["a1", "a2"]


def trio_entries(entries: DataFrame, trios: DataFrame, complete: bool = True, fields: Sequence[str] = ENTRY, only: Column | None = None) -> DataFrame:
    """One row for each site and trio with structs kid, dad and mom. complete: only rows where all three have an entry
    (else those with the child's). fields: what the structs hold beside s; all of them travel, so name those that are needed.
    only: a condition on role (kid, dad, mom) and the entry's columns that every member of a row asked for meets; other entries do not
    travel, and with complete their rows are left out.

    Entries meet the list of trio members once, and one shuffle by site brings the three together; what is counted or joined
    by site afterwards needs no other. Trios are told apart by their child, whose entry carries the other members' names, so that
    they need no join at the end.

    Entries may name the family of their sample (fam_id, as in trios). Each then meets the trios of that family alone, and all members of a
    trio lie with the family: entries that do so already are not shuffled at all.
    """
    names = ["fam_id", "father", "mother", "is_female"]
    own = trios.groupBy("proband").agg(F.array_sort(F.collect_set(F.struct(*names))).alias("names"))
    kids = own.select(F.col("proband").alias("s"), F.lit("kid").alias("role"), "proband", "names")
    parents = trio_members(trios).where("role <> 'kid'").select("s", "role", "proband").distinct()
    e = F.struct("s", *[c for c in fields if c in entries.columns]).alias("e")
    if "fam_id" in entries.columns:
        by = ["fam_id"]
        rows = entries.join(_by_family(trios, names), "fam_id").select(*entries.columns, F.inline(F.filter("members", lambda m: m["member"] == F.col("s"))))
    else:
        by = []
        rows = entries.join(kids.unionByName(parents, allowMissingColumns=True), "s")
    rows = (rows if only is None else rows.where(only)).select(*by, *gt.KEY, "proband", "role", "names", e)
    # an entry repeated for one site and sample gives one of them; which one is no matter where they are equal
    out = (rows if by else rows.repartition(*gt.KEY)).groupBy(*by, *gt.KEY, "proband").agg(*[F.max(F.when(F.col("role") == r, F.col("e"))).alias(r) for r in ("kid", "dad", "mom")], F.max("names").alias("names"))
    out = out.where("kid is not null and dad is not null and mom is not null" if complete else "kid is not null")
    return out.drop(*by).select(*gt.KEY, "proband", F.inline("names"), "kid", "dad", "mom").select(*gt.KEY, "fam_id", "proband", "father", "mother", "is_female", "kid", "dad", "mom")


def _by_family(trios: DataFrame, names: list[str]) -> DataFrame:
    """One row a family: its trios' members (member, role, proband; the child with the trio's names)."""
    own = trios.groupBy("fam_id", "proband").agg(F.array_sort(F.collect_set(F.struct(*names))).alias("names"))
    kids = own.select("fam_id", F.col("proband").alias("member"), F.lit("kid").alias("role"), "proband", "names")
    parents = trio_members(trios).where("role <> 'kid'").select("fam_id", F.col("s").alias("member"), "role", "proband").distinct()
    members = kids.unionByName(parents, allowMissingColumns=True)
    return members.groupBy("fam_id").agg(F.collect_list(F.struct("member", "role", "proband", "names")).alias("members"))


def may_be_new() -> Column:
    """For `only` of trio_entries: what a member's entry must be where the child has an allele that the parents do not show. A child
    carries the allele and a parent does not, but one parent alone counts on X, Y and the mitochondrion."""
    n = (F.col("a1") > 0).cast("int") + (F.col("a2") > 0).cast("int")
    single = locus.in_x_nonpar() | locus.in_y_nonpar() | locus.in_mito()
    return F.when(F.col("role") == "kid", n > 0).otherwise(single | (n == 0))


def calls(struct: str) -> Column:
    """Alternate alleles of a member's call; null if missing."""
    a1, a2 = F.col(f"{struct}.a1"), F.col(f"{struct}.a2")
    return (a1 > 0).cast("int") + (a2 > 0).cast("int")


def copy_state(build: str = "GRCh38") -> Column:
    """auto, hemi_x, hemi_y or mt, for the child."""
    male = ~F.col("is_female")
    return F.when(locus.in_x_nonpar(build=build) & male, "hemi_x").when(locus.in_y_nonpar(build=build) & male, "hemi_y").when(locus.in_mito(), "mt").when(locus.in_y_nonpar(build=build), F.lit(None)).otherwise("auto")


def mendel_code(kid: Column, dad: Column, mom: Column, state: Column) -> Column:
    """Error codes 1 to 12 of the usual classification, null where there is none (a missing call is no evidence)."""
    ref, het, var = (lambda c: c == 0), (lambda c: c == 1), (lambda c: c == 2)
    missing = lambda c: c.isNull()
    auto = (
        F.when(het(kid) & var(dad) & var(mom), 1).when(het(kid) & ref(dad) & ref(mom), 2)
        .when(var(kid) & ref(dad) & ref(mom), 5).when(var(kid) & ref(dad), 3).when(var(kid) & ref(mom), 4)
        .when(ref(kid) & var(dad) & var(mom), 8).when(ref(kid) & var(dad), 6).when(ref(kid) & var(mom), 7)
    )
    x = F.when(ref(kid) & var(mom), 9).when(var(kid) & ref(mom), 10)
    y = F.when(ref(kid) & var(dad), 11).when(var(kid) & ref(dad), 12)
    return F.when(missing(kid), F.lit(None)).when(state == "auto", auto).when(state == "hemi_x", x).when(state == "hemi_y", y)


#: Who may be wrong (father, mother, child) by Mendel code (fixed values of the classification).
IMPLICATED = {1: (1, 1, 1), 2: (1, 1, 1), 3: (1, 0, 1), 4: (0, 1, 1), 5: (0, 0, 1), 6: (1, 0, 1), 7: (0, 1, 1), 8: (0, 0, 1), 9: (0, 1, 1), 10: (0, 1, 1), 11: (1, 0, 1), 12: (1, 0, 1)}


def mendel_errors(trios: DataFrame, build: str = "GRCh38") -> DataFrame:
    """Rows with a Mendel error, and their code."""
    out = trios.withColumn("mendel_code", mendel_code(calls("kid"), calls("dad"), calls("mom"), copy_state(build)))
    return out.where("mendel_code is not null")


def mendel_rollups(errors: DataFrame) -> dict[str, DataFrame]:
    """Errors by family (both parents), by individual that may be wrong, and by variant."""
    snp = ((F.length("ref") == 1) & (F.length("alt") == 1)).cast("int")
    family = errors.groupBy(F.col("father").alias("pat_id"), F.col("mother").alias("mat_id"), "fam_id").agg(F.countDistinct("proband").alias("children"), F.count("*").alias("errors"), F.sum(snp).alias("snp_errors"))
    members = F.array(*[F.struct(F.col(c).alias("s"), F.coalesce(*[F.when(F.col("mendel_code") == k, F.lit(v[i])) for k, v in IMPLICATED.items()]).alias("own")) for i, c in enumerate(("father", "mother", "proband"))])
    person = errors.select("fam_id", snp.alias("snp"), F.inline(members)).groupBy("s", "fam_id").agg(F.sum("own").alias("errors"), F.sum(F.col("own") * F.col("snp")).alias("snp_errors"))
    return {"family": family, "individual": person, "variant": errors.groupBy(*gt.KEY).agg(F.count("*").alias("errors"))}


def mendel_code2_subset(entries: DataFrame, trios: DataFrame) -> DataFrame:
    """Entries of trio members at the sites and in the trios with Mendel code 2 (a new allele in the child)."""
    hits = mendel_errors(trio_entries(entries, trios, fields=CALL, only=may_be_new())).where("mendel_code = 2")
    cells = hits.select(*gt.KEY, F.explode(F.array("proband", "father", "mother")).alias("s")).distinct()
    return entries.join(cells, [*gt.KEY, "s"], "left_semi")


def _phases(kid: int, dad: int, mom: int, state: str) -> tuple[str | None, int | None]:
    """(phased call father|mother, its number of alternate alleles) if transmission leaves one way, else None."""
    gives = {0: {0}, 1: {0, 1}, 2: {1}}
    if state == "auto":
        ways = {(p, m) for p in gives[dad] for m in gives[mom] if p + m == kid}
        return f"{ways.copy().pop()[0]}|{ways.pop()[1]}" if len(ways) == 1 else None
    giver = mom if state in ("hemi_x", "mt") else dad
    return str(kid // 2) if kid in (0, 2) and kid // 2 in gives[giver] else None


def phase_by_transmission(kid: Column, dad: Column, mom: Column, state: Column) -> Column:
    """The child's call as father|mother allele (one allele on one-copy places); null where parents leave it open, contradict
    it, or a needed call is missing."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for k, d, m in product(range(3), repeat=3):
        if (way := _phases(k, d, m, "auto")) is not None:
            out = out.when((state == "auto") & (kid == k) & (dad == d) & (mom == m), way)
    for s, parent in (("hemi_x", mom), ("mt", mom), ("hemi_y", dad)):
        for k, p in product((0, 2), range(3)):
            if (way := _phases(k, p, p, s)) is not None:
                out = out.when((state == s) & (kid == k) & (parent == p), way)
    return out


def phase_trios(trios: DataFrame, build: str = "GRCh38") -> DataFrame:
    rows = computed(trios, __kid=calls("kid"), __dad=calls("dad"), __mom=calls("mom"), __state=copy_state(build))
    return computed(rows, pbt_gt=phase_by_transmission(*[F.col(c) for c in ("__kid", "__dad", "__mom", "__state")])).drop("__kid", "__dad", "__mom", "__state")


def transmission(pbt: Column) -> Column:
    """Where an alternate allele of a phased call comes from; null for calls of one allele or none."""
    return F.when(pbt == "0|0", "uninherited").when(pbt == "0|1", "inherited_from_mother").when(pbt == "1|0", "inherited_from_father").when(pbt == "1|1", "inherited_from_both")


def transmissions(kid: Column, dad: Column, mom: Column, state: Column) -> tuple[Column, Column]:
    """(t, u): alternate alleles that heterozygous parents passed on and kept, where the trio is consistent."""
    zero = F.lit(0)
    hets = (dad == 1).cast("int") + (mom == 1).cast("int")
    fixed = (dad == 2).cast("int") + (mom == 2).cast("int")
    t = kid - fixed
    ok = (state == "auto") & kid.isNotNull() & dad.isNotNull() & mom.isNotNull() & (hets > 0) & (t >= 0) & (t <= hets)
    x = (state == "hemi_x") & kid.isin(0, 2) & (mom == 1)
    return (
        F.when(ok, t).when(x, (kid / 2).cast("int")).otherwise(zero),
        F.when(ok, hets - t).when(x, 1 - (kid / 2).cast("int")).otherwise(zero),
    )


def tdt(trios: DataFrame, build: str = "GRCh38") -> DataFrame:
    """Transmission disequilibrium by site: t, u and chi2 = (t - u)^2 / (t + u)."""
    t, u = transmissions(calls("kid"), calls("dad"), calls("mom"), copy_state(build))
    out = trios.select(*gt.KEY, t.alias("t"), u.alias("u")).groupBy(*gt.KEY).agg(F.sum("t").alias("t"), F.sum("u").alias("u"))
    return out.withColumn("chi2", gt.ratio((F.col("t") - F.col("u")) * (F.col("t") - F.col("u")), F.col("t") + F.col("u")))


def parent_aware_tdt(trios: DataFrame, build: str = "GRCh38") -> DataFrame:
    """By site: alternate alleles that a heterozygous father, and a heterozygous mother, passed on (t) and kept (u), and those of
    trios where all three are heterozygous (indeterminate: one of each).

    On autosomes, in the pseudo-autosomal part of X, and in daughters both parents count, but no father is taken to be
    heterozygous on X. A son's allele on X comes from the mother, whatever the father's, who must have a plain call.
    """
    k, d, m = calls("kid"), calls("dad"), calls("mom")
    x = locus.in_x_nonpar(build=build)
    two = locus.in_autosome() | ((F.col("contig") == "chrX") & ~x) | F.col("is_female")
    one = x & ~F.col("is_female")
    plain = d.isin(0, 2)
    flag = lambda c: F.sum(F.when(c, 1).otherwise(0))
    dad, mom = two & (d == 1) & ~x, two & (m == 1)
    all_het = dad & (m == 1) & (k == 1)
    return trios.groupBy(*gt.KEY).agg(
        flag(dad & (((k == 1) & (m == 0)) | ((k == 2) & m.isin(1, 2)))).alias("t_from_dad"), flag(dad & (((k == 1) & (m == 2)) | ((k == 0) & m.isin(0, 1)))).alias("u_from_dad"),
        flag((mom & (((k == 1) & (d == 0)) | ((k == 2) & (((d == 1) & ~x) | (d == 2))))) | (one & (m == 1) & (k == 2) & plain)).alias("t_from_mom"),
        flag((mom & (((k == 1) & (d == 2)) | ((k == 0) & (((d == 1) & ~x) | (d == 0))))) | (one & (m == 1) & (k == 0) & plain)).alias("u_from_mom"),
        flag(all_het).alias("t_indeterminate"), flag(all_het).alias("u_indeterminate"),
    )


def split_trios(trios: DataFrame) -> DataFrame:
    """Informative rows: all three called and not all hom-ref, with AC, AN = 6 and AF of the trio."""
    ac = calls("kid") + calls("dad") + calls("mom")
    return trios.withColumn("AC", ac).where("AC > 0").withColumns({"AN": F.lit(6), "AF": F.col("AC") / 6})


def trio_split_stats(trios: DataFrame) -> DataFrame:
    """By trio: rows that are all hom-ref, rows with a missing call, and informative ones."""
    ac = calls("kid") + calls("dad") + calls("mom")
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return trios.groupBy("fam_id", "proband").agg(count(ac == 0).alias("n_hom_ref"), count(ac.isNull()).alias("n_missing"), count(ac > 0).alias("n_ok"))


def parental_origin(kid: Column, dad: Column, mom: Column) -> Column:
    """Which parent a het child's alternate allele comes from, where one is hom-var and the other hom-ref."""
    return F.when((kid == 1) & (dad == 2) & (mom == 0), "father").when((kid == 1) & (dad == 0) & (mom == 2), "mother")
