"""Family filtering of structural variants: all families in one job, with the family as a key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.scratch import written
from .sv import carriers

HOM, HEMI = "1/1", "1"


@dataclass(frozen=True)
class FamilyConfig:
    af: float = 0.01
    last_af: float = 0.001
    most_ac: int = 10
    most_unaffected: int = 5
    most_hom: int = 10
    comp_het: bool = True


def _people(ped: DataFrame) -> DataFrame:
    """Members with their part in the family: affected (2), unaffected (1), somebody's father or mother, male child of two known parents."""
    c = F.col
    own, parent = F.lit(None).cast("boolean"), lambda p, role: F.struct(c(p).alias("s"), F.lit(role == "father").alias("is_father"), F.lit(role == "mother").alias("is_mother"))
    both = c("paternal_id").isNotNull() & c("maternal_id").isNotNull()
    facts = {"aff": c("phenotype") == 2, "unaff": c("phenotype") == 1, "male_proband": both & (c("phenotype") == 2) & (c("sex") == 1), "has_parents": both}
    self_ = F.struct(c("sample_id").alias("s"), F.lit(False).alias("is_father"), F.lit(False).alias("is_mother"), *[v.alias(k) for k, v in facts.items()])
    named = [F.struct(parent(p, r)["s"].alias("s"), parent(p, r)["is_father"].alias("is_father"), parent(p, r)["is_mother"].alias("is_mother"), *[own.alias(k) for k in facts]) for p, r in (("paternal_id", "father"), ("maternal_id", "mother"))]
    rows = ped.select("family_id", F.inline(F.array(self_, *named))).where("s IS NOT NULL")
    # a name that is only somebody's parent has no facts of its own and is no member
    rows = rows.groupBy("family_id", "s").agg(*[F.max(x).alias(x) for x in ("is_father", "is_mother", *facts)])
    return rows.where("has_parents IS NOT NULL").select("family_id", "s", "aff", "unaff", "male_proband", "has_parents", "is_father", "is_mother")


def _families(people: DataFrame) -> DataFrame:
    """Affected members, male probands, and whether a child's parents are both there (trio, quad)."""
    n = lambda c: F.sum(F.when(F.col(c), 1).otherwise(0))
    return people.groupBy("family_id").agg(n("aff").alias("n_aff"), n("male_proband").alias("n_male_probands"), ((n("has_parents") > 0) & (n("is_father") > 0) & (n("is_mother") > 0)).alias("is_trio"))


def family_counts(sv: DataFrame, gt: DataFrame, ped: DataFrame) -> DataFrame:
    """By call and family that carries it: carriers in the family, affected and unaffected ones, and those of the whole cohort; the
    affected carriers' names; and what the rules ask of the members' genotypes.

    gt: name, s, gt as text. 1/0 is read as 0/1, and a missing call or a carrier without a row as 0/0.
    """
    c = F.col
    calls = gt.select("name", "s", F.when(c("gt") == "1/0", "0/1").otherwise(c("gt")).alias("gt"))
    people = written(_people(ped), "people")
    rows = carriers(sv).select("name", "s").join(people, "s").join(calls, ["name", "s"], "left")
    n = lambda x: F.sum(F.when(x, 1).otherwise(0))
    some = lambda x: F.coalesce(F.max(x), F.lit(False))
    het, hom, hemi = c("gt") == "0/1", c("gt") == HOM, c("gt").isin(HOM, HEMI)
    own = rows.groupBy("name", "family_id").agg(
        F.count("*").alias("sc_fam"), n(c("aff")).alias("sc_fam_aff"), n(c("unaff")).alias("sc_fam_unaff"), F.array_sort(F.collect_set(F.when(c("aff"), c("s")))).alias("affected"),
        n(c("aff") & het).alias("aff_het"), some(c("aff") & hom).alias("aff_hom"), some(c("unaff") & hom).alias("unaff_hom"), some(c("male_proband") & hemi).alias("proband_hemi"), some(c("unaff") & hemi).alias("unaff_hemi"),
        some(c("is_father") & het).alias("father_het"), some(c("is_mother") & het).alias("mother_het"),
    )
    # everybody is in one family, so a call's families add up to the cohort
    whole = Window.partitionBy("name")
    own = own.withColumns({"sc_all_aff": F.sum("sc_fam_aff").over(whole), "sc_all_unaff": F.sum("sc_fam_unaff").over(whole), "affected_carriers": F.array_join("affected", ",")})
    return own.join(_families(people), "family_id")


def multi_hit(rows: DataFrame) -> DataFrame:
    """By family and gene: how many calls of the family are on the gene (n_calls), and whether one is the father's alone, one the mother's
    alone, one absent in unaffected members. rows: name, family_id, genes, from_father, from_mother, filt_absent_unaff."""
    by_gene = rows.withColumn("gene", F.explode(F.array_distinct("genes")))
    return by_gene.groupBy("family_id", "gene").agg(F.count("*").alias("n_calls"), F.max("from_father").alias("from_father"), F.max("from_mother").alias("from_mother"), F.max("filt_absent_unaff").alias("is_new"))


def is_hit(trio: Column, n: Column, father: Column, mother: Column, new: Column) -> Column:
    """In trios two of: inherited from the father, from the mother, new. In other families two calls."""
    two = (father & new) | (mother & new) | (father & mother)
    return (n > 1) & F.when(trio, two).otherwise(F.lit(True))


def family_rows(sv: DataFrame, gt: DataFrame, ped: DataFrame, cfg: FamilyConfig = FamilyConfig()) -> DataFrame:  # noqa: B008
    """Rare calls by family with an affected carrier, their counts, and the marks that multi_hit needs. Written once, as all rules read it."""
    c = F.col
    af = F.coalesce(c("gnomad_af"), F.lit(0.0))
    rare = written(sv.where((af <= cfg.af) | c("in_gd")).where(af <= cfg.last_af), "rare-calls")
    rows = rare.drop("samples").join(family_counts(rare, gt, ped).where("sc_fam_aff > 0"), "name")
    all_het = c("aff_het") == c("n_aff")
    few = (c("ac") <= cfg.most_ac) & (c("sc_all_unaff") <= cfg.most_unaffected)
    marks = {
        "filt_absent_unaff": (c("sc_fam_unaff") == 0) & few, "few": few,
        "from_father": all_het & c("father_het") & ~c("mother_het"), "from_mother": all_het & c("mother_het") & ~c("father_het"),
    }
    return written(rows.withColumns(marks), "family-rows")


def family_filter(sv: DataFrame, gt: DataFrame, ped: DataFrame, genes: DataFrame, terms: DataFrame, cfg: FamilyConfig = FamilyConfig()) -> DataFrame:  # noqa: B008
    """Rare calls and families with an affected carrier that one of the rules reports, with the flags of all rules.

    sv: calls with samples, genes and lof_genes (arrays), chr2, ac, n_homalt, gnomad_af (null: 0), in_gd. gt: name, s, gt. genes: gene
    with omim, in_list, constrained (loss or recessive). terms: (s, gene) by the clinical terms of a sample. Calls over af go unless
    they lie in a disorder region; then calls over last_af go as well. Reported are calls in disorder regions and those that are

    absent in unaffected members (filt_absent_unaff; in at most most_ac alleles and most_unaffected unaffected samples of the cohort),
    several hits in a gene (filt_mult_hit, as in is_hit; over all genes of a call together),
    recessive (filt_ar: an affected member is hom-alt, no unaffected one, and at most most_hom of the cohort),
    X-linked recessive (filt_xlr: on X at either end, a male child of two known parents is hom-alt or hemizygous and no unaffected member;
    null in families without such a child),
    inherited (filt_inherited: a gene of the list or a constrained one, an unaffected member carries it, and few of the cohort do).
    """
    c = F.col
    rows = family_rows(sv, gt, ped, cfg)
    listed = genes.groupBy("gene").agg(*[F.max(F.col(x).cast("int")).alias(x) for x in ("omim", "in_list", "constrained")])
    by_gene = rows.select("name", "family_id", F.explode("genes").alias("gene")).distinct()
    found = by_gene.join(listed, "gene", "left").join(multi_hit(rows), ["family_id", "gene"], "left")
    found = found.groupBy("name", "family_id").agg(*[(F.coalesce(F.max(x), F.lit(0)) == 1).alias(f"{x}_match") for x in ("omim", "in_list", "constrained")], F.max("n_calls").alias("n_calls"), *[F.max(x).alias(f"any_{x}") for x in ("from_father", "from_mother", "is_new")])
    lof = rows.select("name", F.explode("lof_genes").alias("gene")).distinct().join(listed.where("in_list = 1"), "gene").select("name").distinct().withColumn("is_lof_genelist", F.lit(True))
    held = rows.select("name", "family_id", F.explode("affected").alias("s"), F.array_distinct("genes").alias("genes")).select("name", "family_id", "s", F.explode("genes").alias("gene"))
    hpo = held.join(terms.select("s", "gene").distinct(), ["s", "gene"], "left_semi").select("name", "family_id").distinct().withColumn("hpo_match", F.lit(True))
    out = rows.join(found, ["name", "family_id"], "left").join(lof, "name", "left").join(hpo, ["name", "family_id"], "left")
    no = lambda x: F.coalesce(x, F.lit(False))
    on_x = (c("chrom") == "chrX") | no(c("chr2") == "chrX")
    out = out.withColumns({
        "filt_mult_hit": no(is_hit(c("is_trio"), c("n_calls"), c("any_from_father"), c("any_from_mother"), c("any_is_new"))),
        "filt_ar": c("aff_hom") & ~c("unaff_hom") & (c("n_homalt") <= cfg.most_hom),
        "filt_xlr": F.when(c("n_male_probands") > 0, c("proband_hemi") & ~c("unaff_hemi") & on_x),
        "filt_inherited": no(c("in_list_match") | c("constrained_match")) & c("few") & (c("sc_fam_unaff") > 0),
        "is_lof": F.size("lof_genes") > 0,
    })
    flags = ["filt_absent_unaff", *["filt_mult_hit"] * cfg.comp_het, "filt_ar", "filt_xlr", "filt_inherited"]
    reported = c("in_gd")
    for f in flags:
        reported = reported | no(c(f))
    keep = ["name", "family_id", "chrom", "svtype", "sc_fam", "sc_fam_aff", "sc_fam_unaff", "sc_all_aff", "sc_all_unaff", "affected_carriers", "in_gd", *flags]
    return out.where(reported).select(*keep, *[no(c(x)).alias(x) for x in ("omim_match", "in_list_match", "constrained_match", "hpo_match", "is_lof", "is_lof_genelist")])
