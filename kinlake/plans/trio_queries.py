"""Queries on genotypes, trios and pedigrees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import genotype as gt
from ..functions import locus, variant
from ..operators import denovo, pedigree, qc, trio
from . import scratch
from . import views as V
from .registry import query

SITE = "contig, pos, ref, alt"
_ALT = "(CASE WHEN a1 > 0 THEN 1 ELSE 0 END + CASE WHEN a2 > 0 THEN 1 ELSE 0 END)"
X_NON = "(contig = 'chrX' AND NOT (pos BETWEEN 10001 AND 2781479 OR pos BETWEEN 155701383 AND 156030895))"
Y_NON = "(contig = 'chrY' AND NOT (pos BETWEEN 10001 AND 2781479 OR pos BETWEEN 56887903 AND 57217415))"
SNP = "(length(ref) = 1 AND length(alt) = 1 AND ref <> alt)"
STATE = f"CASE WHEN {X_NON} AND NOT is_female THEN 'hemi_x' WHEN {Y_NON} AND NOT is_female THEN 'hemi_y' WHEN {Y_NON} THEN NULL ELSE 'auto' END"
MENDEL = f"""CASE WHEN st = 'auto' THEN CASE WHEN kid_n = 1 AND dad_n = 2 AND mom_n = 2 THEN 1 WHEN kid_n = 1 AND dad_n = 0 AND mom_n = 0 THEN 2
  WHEN kid_n = 2 AND dad_n = 0 AND mom_n = 0 THEN 5 WHEN kid_n = 2 AND dad_n = 0 THEN 3 WHEN kid_n = 2 AND mom_n = 0 THEN 4
  WHEN kid_n = 0 AND dad_n = 2 AND mom_n = 2 THEN 8 WHEN kid_n = 0 AND dad_n = 2 THEN 6 WHEN kid_n = 0 AND mom_n = 2 THEN 7 END
  WHEN st = 'hemi_x' THEN CASE WHEN kid_n = 0 AND mom_n = 2 THEN 9 WHEN kid_n = 2 AND mom_n = 0 THEN 10 END
  WHEN st = 'hemi_y' THEN CASE WHEN kid_n = 0 AND dad_n = 2 THEN 11 WHEN kid_n = 2 AND dad_n = 0 THEN 12 END END"""
T_SQL = """CASE WHEN st = 'auto' AND kid_n + dad_n + mom_n IS NULL THEN 0 WHEN st = 'auto' AND (dad_n = 1 OR mom_n = 1) AND kid_n - (CASE WHEN dad_n = 2 THEN 1 ELSE 0 END + CASE WHEN mom_n = 2 THEN 1 ELSE 0 END) BETWEEN 0 AND (CASE WHEN dad_n = 1 THEN 1 ELSE 0 END + CASE WHEN mom_n = 1 THEN 1 ELSE 0 END)
  THEN kid_n - (CASE WHEN dad_n = 2 THEN 1 ELSE 0 END + CASE WHEN mom_n = 2 THEN 1 ELSE 0 END) WHEN st = 'hemi_x' AND kid_n IN (0, 2) AND mom_n = 1 THEN kid_n // 2 ELSE 0 END"""
U_SQL = """CASE WHEN st = 'auto' AND kid_n + dad_n + mom_n IS NULL THEN 0 WHEN st = 'auto' AND (dad_n = 1 OR mom_n = 1) AND kid_n - (CASE WHEN dad_n = 2 THEN 1 ELSE 0 END + CASE WHEN mom_n = 2 THEN 1 ELSE 0 END) BETWEEN 0 AND (CASE WHEN dad_n = 1 THEN 1 ELSE 0 END + CASE WHEN mom_n = 1 THEN 1 ELSE 0 END)
  THEN (CASE WHEN dad_n = 1 THEN 1 ELSE 0 END + CASE WHEN mom_n = 1 THEN 1 ELSE 0 END) - kid_n + (CASE WHEN dad_n = 2 THEN 1 ELSE 0 END + CASE WHEN mom_n = 2 THEN 1 ELSE 0 END) WHEN st = 'hemi_x' AND kid_n IN (0, 2) AND mom_n = 1 THEN 1 - kid_n // 2 ELSE 0 END"""
_MORE = f"SELECT t.*, {STATE} AS st FROM v_trios t"


def _ped(spark: SparkSession, d: str) -> DataFrame:
    return V.view(spark, d, "v_ped")


def _trios(spark: SparkSession, d: str, fields: list[str] = trio.ENTRY) -> DataFrame:
    return trio.trio_entries(V.entries(spark, d, families=True), pedigree.trio_list(_ped(spark, d)), fields=fields)


def _with_counts(spark: SparkSession, d: str, fields: list[str] = trio.ENTRY, only: Column | None = None) -> DataFrame:
    """Trios with site counts and population frequency. The entries are worked out and written once for both."""
    entries = scratch.written(V.entries(spark, d).select(*gt.KEY, "s", *dict.fromkeys([*trio.CALL, *fields])), "entries")
    counts = qc.site_counts(entries)
    sites = V.view(spark, d, "v_sites").select(*gt.KEY, "gnomad_af", "vqslod")
    return trio.trio_entries(entries, pedigree.trio_list(_ped(spark, d)), fields=fields, only=only).join(counts, gt.KEY).join(sites, gt.KEY)


_COUNTS = f"counts AS (SELECT {SITE}, sum(a1 + a2) AS ac, 2 * count(a1) AS an FROM v_entries GROUP BY {SITE} HAVING sum(a1 + a2) > 0)"


@query(f"SELECT {SITE}, s, a1 + a2 = 0 AS hom_ref, a1 <> a2 AS het, a1 = a2 AND a1 > 0 AS hom_var, a1 + a2 > 0 AS non_ref FROM v_entries", "v_entries")
def p1_genotype_predicates(spark, d):
    return V.entries(spark, d).select(*gt.KEY, "s", gt.is_hom_ref().alias("hom_ref"), gt.is_het().alias("het"), gt.is_hom_var().alias("hom_var"), gt.is_non_ref().alias("non_ref"))


@query(f"SELECT {SITE}, contig NOT IN ('chrX', 'chrY') AS autosome, {X_NON} AS x_nonpar, {Y_NON} AS y_nonpar, contig = 'chrX' AND NOT {X_NON} AS x_par, NOT {X_NON} AND NOT {Y_NON} AS auto_or_par FROM v_sites", "v_sites")
def p2_locus_predicates(spark, d):
    return V.view(spark, d, "v_sites").select(*gt.KEY, locus.in_autosome().alias("autosome"), locus.in_x_nonpar().alias("x_nonpar"), locus.in_y_nonpar().alias("y_nonpar"), locus.in_x_par().alias("x_par"), locus.in_autosome_or_par().alias("auto_or_par"))


@query(f"SELECT {SITE}, {SNP} AS snp, CASE WHEN length(ref) = length(alt) THEN 'SNV' ELSE 'Indel' END AS type, abs(length(ref) - length(alt)) AS len, CASE WHEN length(alt) > length(ref) THEN 'Insertion' WHEN length(alt) < length(ref) THEN 'Deletion' END AS indel, concat(contig, ':', pos, ':', ref, ':', alt) AS id FROM v_sites", "v_sites")
def p3_p4_variant_class_and_id(spark, d):
    return V.view(spark, d, "v_sites").select(*gt.KEY, variant.is_snp().alias("snp"), variant.variant_type().alias("type"), variant.length_change().alias("len"), variant.indel_type().alias("indel"), variant.variant_id().alias("id"))


@query(f"SELECT {SITE}, s, CASE WHEN ad_ref + ad_alt > 0 THEN ad_alt / (ad_ref + ad_alt) END AS ab, ad_ref + ad_alt AS dpc, CASE WHEN dp > 0 THEN ad_alt / dp END AS vaf FROM v_entries", "v_entries")
def p5_entry_metrics(spark, d):
    return qc.entry_metrics(V.entries(spark, d)).select(*gt.KEY, "s", F.col("AB").alias("ab"), F.col("DPC").alias("dpc"), F.col("VAF").alias("vaf"))


@query(f"""WITH h AS (SELECT DISTINCT ad_alt AS k, ad_ref + ad_alt AS n FROM v_entries WHERE a1 <> a2),
t AS (SELECT k, n, sum(exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) - n * ln(2.0))) AS tail FROM (SELECT k, n, unnest(range(0, least(k, n - k) + 1)) AS i FROM h) GROUP BY k, n)
SELECT k, n, round(CASE WHEN 2 * k = n THEN 1.0 ELSE least(1.0, 2 * tail) END + 1e-9, 5) AS p FROM t""", "v_entries")
def p6_binomial_pab(spark, d):
    # p hangs on the reads alone, so each pair of counts is tested once
    pairs = V.entries(spark, d).where(gt.is_het()).groupBy(F.get("AD", F.lit(1)).alias("k"), gt.total().alias("n")).agg(F.count("*").alias("calls"))
    rows = qc.annotate_pab(pairs.withColumns({"a1": F.lit(0), "a2": F.lit(1), "AD": F.array(F.col("n") - F.col("k"), "k")}))
    return rows.select("k", "n", F.round(F.col("pAB") + 1e-9, 5).alias("p"))


_BASIC = "NOT (dp < 7 OR dp > 1000 OR (a1 + a2 = 0 AND gq < 25) OR (a1 + a2 > 0 AND pl0 < 25))"


@query(f"SELECT contig, s, count(*) AS n FROM v_entries WHERE {_BASIC} GROUP BY contig, s", "v_entries")
def p7_basic_gt_filter(spark, d):
    return qc.basic_gt_filter(V.entries(spark, d)).groupBy("contig", "s").agg(F.count("*").alias("n"))


@query(f"""SELECT contig, sex, count(*) AS n FROM v_entries JOIN v_ped ON s = sample_id
WHERE NOT ((sex = 2 AND dp < 10) OR (sex = 2 AND {Y_NON}) OR (sex <> 2 AND NOT {X_NON} AND NOT {Y_NON} AND dp < 10) OR (sex <> 2 AND a1 <> a2 AND ({X_NON} OR {Y_NON}))) GROUP BY contig, sex""", "v_entries", "v_ped")
def p8_sex_gt_filter(spark, d):
    out = qc.sex_gt_filter(V.entries(spark, d), _ped(spark, d))
    return out.groupBy("contig", F.when(F.col("is_female"), 2).otherwise(1).alias("sex")).agg(F.count("*").alias("n"))


@query(f"""WITH n AS (SELECT DISTINCT ad_alt AS k, ad_ref + ad_alt AS n FROM v_entries WHERE a1 <> a2),
p AS (SELECT k, n, CASE WHEN 2 * k = n OR n = 0 THEN 1.0 ELSE least(1.0, 2 * (SELECT sum(exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) - n * ln(2.0))) FROM unnest(range(0, least(k, n - k) + 1)) AS u(i))) END AS pab FROM n),
kept AS (SELECT e.* FROM v_entries e LEFT JOIN p ON p.k = e.ad_alt AND p.n = e.ad_ref + e.ad_alt
  WHERE NOT ((a1 <> a2 AND (ad_alt < 0.25 * dp OR pab < 1e-9 OR ad_ref + ad_alt < 0.9 * dp)) OR (a1 = 1 AND a2 = 1 AND ad_alt < 0.9 * dp))),
live AS (SELECT {SITE} FROM kept GROUP BY {SITE} HAVING sum(a1 + a2) > 0)
SELECT {SITE}, count(*) AS n, sum(a1 + a2) AS ac FROM kept JOIN live USING ({SITE}) GROUP BY {SITE}""", "v_entries")
def p9_balance_filters(spark, d):
    return qc.balance_filters(V.entries(spark, d)).groupBy(*gt.KEY).agg(F.count("*").alias("n"), F.sum(gt.n_alt()).alias("ac"))


@query(f"""WITH e AS (SELECT *, gq % 4 = 0 AS no_ad, gq % 3 = 0 AS no_pl FROM v_entries WHERE gq >= 45)
SELECT {SITE}, s, CASE WHEN NOT no_ad THEN ad_ref WHEN a1 + a2 = 0 THEN dp END AS ad0, CASE WHEN NOT no_ad THEN ad_alt WHEN a1 + a2 = 0 THEN 0 END AS ad1,
  CASE WHEN NOT no_pl THEN pl2 WHEN a1 + a2 = 0 THEN greatest(gq, 3 * (CASE WHEN no_ad THEN dp ELSE ad_ref - ad_alt END)) END AS pl2 FROM e""", "v_entries")
def p10_fill_homref(spark, d):
    e = V.entries(spark, d).withColumns({"AD": F.when(F.col("GQ") % 4 != 0, F.col("AD")), "PL": F.when(F.col("GQ") % 3 != 0, F.col("PL"))})
    return qc.fill_homref(e, 45).select(*gt.KEY, "s", F.get("AD", F.lit(0)).alias("ad0"), F.get("AD", F.lit(1)).alias("ad1"), F.get("PL", F.lit(2)).alias("pl2"))


@query(f"""SELECT {SITE}, s, CASE WHEN gq % 4 = 0 THEN 100 ELSE ad_ref END AS ad0, CASE WHEN gq % 4 = 0 THEN 100 ELSE ad_ref + ad_alt END AS dp_est,
  CASE WHEN a1 + a2 = 0 THEN 0 WHEN a1 <> a2 THEN gq ELSE 2 * gq END AS pl0 FROM v_entries""", "v_entries")
def p11_estimate_dp_pl(spark, d):
    e = V.entries(spark, d).withColumns({"AD": F.when(F.col("GQ") % 4 != 0, F.col("AD")), "DP": F.lit(None).cast("int"), "PL": F.lit(None).cast("array<int>")})
    return qc.estimate_dp_pl(e).select(*gt.KEY, "s", F.get("AD", F.lit(0)).alias("ad0"), F.col("DP").alias("dp_est"), F.get("PL", F.lit(0)).alias("pl0"))


@query("SELECT contig, sum(CASE WHEN gq % 3 = 0 THEN 0 ELSE pl0 + pl1 + pl2 END) AS pl FROM v_entries GROUP BY contig", "v_entries")
def p12_fill_pl(spark, d):
    e = qc.fill_pl(V.entries(spark, d).withColumn("PL", F.when(F.col("GQ") % 3 != 0, F.col("PL"))))
    return e.groupBy("contig").agg(F.sum(F.get("PL", F.lit(0)) + F.get("PL", F.lit(1)) + F.get("PL", F.lit(2))).alias("pl"))


@query("SELECT contig, s, a2 AS d1, a2 AS d2, count(*) AS n FROM v_entries GROUP BY contig, s, a2", "v_entries")
def p13_diploidise(spark, d):
    dip = gt.diploid(F.array("a2"))
    return V.entries(spark, d).select("contig", "s", F.get(dip, F.lit(0)).alias("d1"), F.get(dip, F.lit(1)).alias("d2")).groupBy("contig", "s", "d1", "d2").agg(F.count("*").alias("n"))


@query(f"""SELECT {SITE} FROM v_sites WHERE qual >= 150 AND qd >= CASE WHEN {SNP} THEN 3.0 ELSE 4.0 END AND sor <= CASE WHEN {SNP} THEN 2.5 ELSE 3 END
  AND read_pos_rank_sum >= CASE WHEN {SNP} THEN -1.4 ELSE -1.7 END AND mq >= 50""", "v_sites")
def p14_hard_filter_sites(spark, d):
    return qc.hard_filter_sites(V.view(spark, d, "v_sites")).select(*gt.KEY)


@query(f"SELECT contig, s, count(*) AS n FROM v_entries JOIN (SELECT {SITE}, filter FROM v_sites) USING ({SITE}) WHERE ad_ref + ad_alt BETWEEN 10 AND 200 AND (NOT {SNP} OR filter = 'PASS') GROUP BY contig, s", "v_entries", "v_sites")
def p15_depth_pass_filter(spark, d):
    return qc.depth_pass_filter(V.entries(spark, d), V.view(spark, d, "v_sites")).groupBy("contig", "s").agg(F.count("*").alias("n"))


@query(f"""SELECT {SITE}, proband FROM v_trios WHERE kid_n = 1 AND dad_n = 0 AND mom_n = 0 AND kid_ref + kid_alt > 0 AND kid_alt / (kid_ref + kid_alt) BETWEEN CASE WHEN {SNP} THEN 0.22 ELSE 0.20 END AND CASE WHEN {SNP} THEN 0.78 ELSE 0.80 END
  AND dad_alt <= 0.05 * (dad_ref + dad_alt) AND mom_alt <= 0.05 * (mom_ref + mom_alt) AND ({SNP} OR (dad_ref + dad_alt >= 16 AND mom_ref + mom_alt >= 16))""", "v_trios")
def p16_denovo_entry_filter(spark, d):
    return qc.denovo_entry_filter(_trios(spark, d), use_gq=False).select(*gt.KEY, "proband")


@query(f"WITH {_COUNTS} SELECT {SITE}, ac FROM counts JOIN (SELECT {SITE}, gnomad_af, filter FROM v_sites) USING ({SITE}) WHERE ac <= 40 AND ac / an <= 0.3 AND (gnomad_af IS NULL OR gnomad_af <= 0.005) AND filter = 'PASS'", "v_entries", "v_sites")
def p17_freq_filter(spark, d):
    rows = qc.variant_qc(V.entries(spark, d)).join(V.view(spark, d, "v_sites").select(*gt.KEY, "gnomad_af", "filter"), gt.KEY)
    return qc.freq_filter(rows, 40, 0.3, 0.005, True).select(*gt.KEY, F.col("AC").alias("ac"))


@query(f"WITH {_COUNTS} SELECT {SITE}, ac FROM counts JOIN (SELECT {SITE}, gnomad_af, filter FROM v_sites) USING ({SITE}) WHERE filter = 'PASS' AND (gnomad_af <= 0.004 OR ac <= 30)", "v_entries", "v_sites")
def p32_filter_prioritized(spark, d):
    rows = qc.variant_qc(V.entries(spark, d)).join(V.view(spark, d, "v_sites").select(*gt.KEY, "gnomad_af", "filter"), gt.KEY)
    return qc.filter_prioritized(rows, 0.004, 30).select(*gt.KEY, F.col("AC").alias("ac"))


@query(f"WITH {_COUNTS} SELECT {SITE}, proband FROM v_trios JOIN counts USING ({SITE}) WHERE kid_n = 1 AND dad_n = 0 AND mom_n = 0 AND ac / an <= 0.2", "v_trios", variants=("missing",))
def p25_denovo_by_gt(spark, d):
    return denovo.denovo_by_gt(_with_counts(spark, d, trio.CALL, trio.may_be_new()), 0.2).select(*gt.KEY, "proband")


@query("SELECT fam_id, proband, count(*) FILTER (kid_n + dad_n + mom_n = 0) AS n_hom_ref, count(*) FILTER (kid_n + dad_n + mom_n IS NULL) AS n_missing, count(*) FILTER (kid_n + dad_n + mom_n > 0) AS n_ok FROM v_trios GROUP BY fam_id, proband", "v_trios", variants=("missing",))
def p26_trio_split_stats(spark, d):
    return trio.trio_split_stats(_trios(spark, d, trio.CALL))


@query(f"SELECT {SITE}, proband, kid_n + dad_n + mom_n AS ac, (kid_n + dad_n + mom_n) / 6 AS af FROM v_trios WHERE kid_n + dad_n + mom_n > 0", "v_trios", variants=("missing",))
def p26_split_trios(spark, d):
    return trio.split_trios(_trios(spark, d, trio.CALL)).select(*gt.KEY, "proband", F.col("AC").alias("ac"), F.col("AF").alias("af"))


@query(f"WITH live AS (SELECT {SITE} FROM v_entries JOIN v_ped ON s = sample_id WHERE sex = 2 GROUP BY {SITE} HAVING sum(a1 + a2) > 0) SELECT contig, s, count(*) AS n FROM v_entries JOIN live USING ({SITE}) JOIN v_ped ON s = sample_id WHERE sex = 2 GROUP BY contig, s", "v_entries", "v_ped")
def p29_subset_samples(spark, d):
    ids = _ped(spark, d).where("sex = 2").select(F.col("sample_id").alias("s"))
    return qc.subset_samples(V.entries(spark, d), ids).groupBy("contig", "s").agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN sex = 2 THEN concat('X', sample_id) ELSE sample_id END AS s, count(*) AS n FROM v_entries JOIN v_ped ON s = sample_id GROUP BY sample_id, sex", "v_entries", "v_ped")
def p30_rename_samples(spark, d):
    names = _ped(spark, d).where("sex = 2").select(F.col("sample_id").alias("old"), F.concat(F.lit("X"), "sample_id").alias("new"))
    return pedigree.rename_samples(V.entries(spark, d), names).groupBy("s").agg(F.count("*").alias("n"))


@query("SELECT contig, count(*) AS n FROM v_entries WHERE contig NOT IN ('chrY', 'chr1') GROUP BY contig", "v_entries")
def p31_restrict_contigs(spark, d):
    return qc.restrict_contigs(V.entries(spark, d), drop=("chrY", "chr1")).groupBy("contig").agg(F.count("*").alias("n"))


@query(f"SELECT {SITE}, proband, father, mother, is_female, kid_n, dad_n, mom_n, kid_dp, dad_gq, mom_alt FROM v_trios", "v_trios", variants=("missing",))
def j13_trio_entries(spark, d):
    n = lambda m: trio.calls(m).alias(f"{m}_n")
    return _trios(spark, d, [*trio.CALL, "AD", "DP", "GQ"]).select(*gt.KEY, "proband", "father", "mother", "is_female", n("kid"), n("dad"), n("mom"), F.col("kid.DP").alias("kid_dp"), F.col("dad.GQ").alias("dad_gq"), F.get("mom.AD", F.lit(1)).alias("mom_alt"))


@query(f"""SELECT {SITE}, proband, max(CASE WHEN role = 'kid' THEN a1 + a2 END) AS kid_n, max(CASE WHEN role = 'dad' THEN a1 + a2 END) AS dad_n, max(CASE WHEN role = 'mom' THEN a1 + a2 END) AS mom_n,
  count(*) FILTER (role = 'dad') = 0 AS dad_absent, count(*) FILTER (role = 'mom') = 0 AS mom_absent
FROM v_entries e JOIN v_trio_members t ON t.s = e.s GROUP BY {SITE}, proband HAVING count(*) FILTER (role = 'kid') > 0""", "v_entries", "v_trio_members", variants=("missing",))
def j13_partial_trios(spark, d):
    n = lambda m: trio.calls(m).alias(f"{m}_n")
    rows = trio.trio_entries(V.entries(spark, d, families=True), pedigree.trio_list(_ped(spark, d)), fields=trio.CALL, complete=False)
    return rows.select(*gt.KEY, "proband", n("kid"), n("dad"), n("mom"), F.col("dad").isNull().alias("dad_absent"), F.col("mom").isNull().alias("mom_absent"))


@query(f"SELECT {SITE}, sum(a1 + a2) AS ac, 2 * count(a1) AS an, sum(a1 + a2) / (2 * count(a1)) AS af, count(*) FILTER (a1 <> a2) AS n_het, avg(gq) AS gq_mean FROM v_entries GROUP BY {SITE} HAVING sum(a1 + a2) > 0", "v_entries", variants=("missing",))
def ag1_variant_qc(spark, d):
    out = qc.variant_qc(V.entries(spark, d))
    return out.select(*gt.KEY, F.col("AC").alias("ac"), F.col("AN").alias("an"), F.col("AF").alias("af"), "n_het", "gq_mean")


@query(f"""SELECT s, count(a1) AS n_called, count(*) FILTER (a1 <> a2) AS n_het, count(*) FILTER (a1 = 1 AND a2 = 1) AS n_hom_var, coalesce(sum(a1 + a2) FILTER ({SNP}), 0) AS n_snp, coalesce(sum(a1 + a2) FILTER (length(alt) > length(ref)), 0) AS n_insertion,
  CASE WHEN coalesce(sum(a1 + a2) FILTER ({SNP} AND concat(ref, alt) NOT IN ('AG', 'GA', 'CT', 'TC')), 0) > 0 THEN coalesce(sum(a1 + a2) FILTER ({SNP} AND concat(ref, alt) IN ('AG', 'GA', 'CT', 'TC')), 0) / sum(a1 + a2) FILTER ({SNP} AND concat(ref, alt) NOT IN ('AG', 'GA', 'CT', 'TC')) END AS r_ti_tv,
  CASE WHEN count(*) FILTER (a1 = 1 AND a2 = 1) > 0 THEN count(*) FILTER (a1 <> a2) / count(*) FILTER (a1 = 1 AND a2 = 1) END AS r_het_hom_var, avg(dp) AS dp_mean FROM v_entries GROUP BY s""", "v_entries", variants=("missing",))
def ag2_sample_qc(spark, d):
    return qc.sample_qc(V.entries(spark, d)).select("s", "n_called", "n_het", "n_hom_var", "n_snp", "n_insertion", "r_ti_tv", "r_het_hom_var", "dp_mean")


_SEX = f"""sx AS (SELECT e.*, sex = 2 AS f FROM v_entries e JOIN v_ped ON s = sample_id), tot AS (SELECT count(*) FILTER (sex <> 2) AS males, count(*) FILTER (sex = 2) AS females FROM v_ped WHERE sample_id IN (SELECT s FROM v_entries)),
c AS (SELECT {SITE}, count(*) FILTER (NOT f AND a1 <> a2) AS mh, count(*) FILTER (NOT f AND a1 = 1) AS mv, count(a1) FILTER (NOT f) AS mc, count(*) FILTER (f AND a1 <> a2) AS fh, count(*) FILTER (f AND a1 = 1) AS fv, count(a1) FILTER (f) AS fc FROM sx GROUP BY {SITE})"""


@query(f"""WITH {_SEX} SELECT {SITE}, CASE WHEN {Y_NON} THEN mc / males WHEN {X_NON} THEN (mc + 2 * fc) / (males + 2 * females) ELSE (mc + fc) / (males + females) END AS call_rate,
  CASE WHEN {Y_NON} THEN mv WHEN {X_NON} THEN mv + fh + 2 * fv ELSE mh + fh + 2 * (mv + fv) END AS ac, CASE WHEN {Y_NON} THEN mc WHEN {X_NON} THEN mc + 2 * fc ELSE 2 * (mc + fc) END AS an FROM c, tot""", "v_entries", "v_ped", variants=("missing",))
def ag3_sex_aware_site_stats(spark, d):
    out = qc.sex_aware_site_stats(V.entries(spark, d), _ped(spark, d))
    return out.select(*gt.KEY, "call_rate", F.col("AC").alias("ac"), F.col("AN").alias("an"))


@query(f"""WITH {_SEX}, g AS (SELECT {SITE}, CASE WHEN {X_NON} THEN fc - fh - fv ELSE mc + fc - mh - fh - mv - fv END AS r, CASE WHEN {X_NON} THEN fh ELSE mh + fh END AS h, CASE WHEN {X_NON} THEN fv ELSE mv + fv END AS v, {Y_NON} AS y FROM c),
q AS (SELECT *, r + h + v AS n, least(2 * r + h, 2 * v + h) AS rare FROM g),
x AS (SELECT *, unnest(range(rare % 2, rare + 1, 2)) AS k FROM q),
p AS (SELECT *, exp(k * ln(2.0) + lgamma(n + 1.0) - lgamma((rare - k) / 2 + 1.0) - lgamma(k + 1.0) - lgamma(n - (rare + k) / 2 + 1.0) - (lgamma(2.0 * n + 1) - lgamma(rare + 1.0) - lgamma(2.0 * n - rare + 1))) AS pk FROM x),
s AS (SELECT {SITE}, max(pk) FILTER (k = h) AS seen FROM p GROUP BY {SITE})
SELECT {SITE}, round(CASE WHEN max(y) OR max(rare) = 0 THEN 1.0 ELSE sum(CASE WHEN pk * (1 + 1e-7) < seen THEN pk WHEN pk <= seen * (1 + 1e-7) THEN pk / 2 ELSE 0 END) END + 1e-9, 4) AS p_hwe FROM p JOIN s USING ({SITE}) GROUP BY {SITE}""", "v_entries", "v_ped", variants=("missing",))
def ag4_hwe_exact(spark, d):
    return qc.sex_aware_site_stats(V.entries(spark, d), _ped(spark, d)).select(*gt.KEY, F.round(F.col("p_hwe") + 1e-9, 4).alias("p_hwe"))


@query(f"""WITH sites AS (SELECT DISTINCT {SITE} FROM v_entries), n AS (SELECT count(*) FILTER ({Y_NON}) AS y, count(*) FILTER (NOT {Y_NON}) AS rest FROM sites)
SELECT s, CASE WHEN sex = 2 THEN count(a1) FILTER (NOT {Y_NON}) / max(rest) ELSE count(a1) / (max(y) + max(rest)) END AS call_rate FROM v_entries JOIN v_ped ON s = sample_id, n GROUP BY s, sex""", "v_entries", "v_ped", variants=("missing",))
def ag5_sex_aware_sample_call_rate(spark, d):
    return qc.sex_aware_sample_call_rate(V.entries(spark, d), _ped(spark, d))


@query("SELECT CASE WHEN length(ref) = length(alt) THEN 'SNV' ELSE 'Indel' END AS type, proband AS sample, count(*) AS n FROM v_trios WHERE kid_n = 1 AND dad_n = 0 AND mom_n = 0 GROUP BY 1, 2", "v_trios")
def ag7_denovo_counts(spark, d):
    return denovo.flatten_trio(denovo.denovo_by_gt(_trios(spark, d))).groupBy(F.col("TYPE").alias("type"), F.col("SAMPLE").alias("sample")).agg(F.count("*").alias("n"))


_TRIOS = "n AS (SELECT count(*) AS n_trios FROM v_ped k WHERE paternal_id IS NOT NULL)"


@query(f"""WITH {_TRIOS}, f AS (SELECT CASE WHEN length(ref) = length(alt) THEN 'SNV' ELSE 'Indel' END AS type, kid_gq >= 50 AS good FROM v_trios WHERE kid_n = 1 AND dad_n = 0 AND mom_n = 0),
c AS (SELECT 'all' AS class FROM f UNION ALL SELECT type FROM f UNION ALL SELECT 'good' FROM f WHERE good) SELECT class, count(*) AS n, max(n_trios) AS n_trios, count(*) / max(n_trios) AS rate FROM c, n GROUP BY class""", "v_trios", "v_ped")
def ag9_denovo_rates(spark, d):
    flat = denovo.flatten_trio(denovo.denovo_by_gt(_trios(spark, d))).withColumn("good", F.col("GQ_sample") >= 50)
    return denovo.denovo_rates(flat, _ped(spark, d), ["good"])


_G1 = f"""WITH {_COUNTS}, r AS (SELECT t.*, {STATE} AS st, ac, an, greatest((ac - 1) / an, coalesce(gnomad_af, 0), 100 / 30000000) AS f, kid_alt / nullif(kid_ref + kid_alt, 0) AS cab,
  1 / (power(10, -kid_pl0 / 10) + power(10, -kid_pl1 / 10) + power(10, -kid_pl2 / 10)) AS ks, 1 / (power(10, -dad_pl0 / 10) + power(10, -dad_pl1 / 10) + power(10, -dad_pl2 / 10)) AS ds, 1 / (power(10, -mom_pl0 / 10) + power(10, -mom_pl1 / 10) + power(10, -mom_pl2 / 10)) AS ms
  FROM v_trios t JOIN counts USING ({SITE}) JOIN (SELECT {SITE}, gnomad_af FROM v_sites) USING ({SITE})),
a AS (SELECT *, ks * power(10, -kid_pl0 / 10) AS k0, ks * power(10, -kid_pl1 / 10) AS k1, ks * power(10, -kid_pl2 / 10) AS k2, ds * power(10, -dad_pl0 / 10) AS d0, ds * power(10, -dad_pl1 / 10) AS d1, ds * power(10, -dad_pl2 / 10) AS d2, ms * power(10, -mom_pl0 / 10) AS m0, ms * power(10, -mom_pl1 / 10) AS m1 FROM r
  WHERE (st = 'auto' AND kid_n = 1 AND dad_n = 0 AND mom_n = 0) OR (st = 'hemi_x' AND kid_n = 2 AND mom_n = 0) OR (st = 'hemi_y' AND kid_n = 2 AND dad_n = 0)),
b AS (SELECT *, CASE st WHEN 'auto' THEN m0 * d0 * k1 * power(1 - f, 4) * (1e-8 * (1 - 4e-8) + 4e-8 * (1 - 1e-8)) WHEN 'hemi_x' THEN m0 * k2 * power(1 - f, 2) * 1e-8 ELSE d0 * k2 * (1 - f) * 4e-8 END AS new,
  CASE st WHEN 'auto' THEN (m1 * d0 + m0 * d1) * k1 * f * power(1 - f, 3) * (1 - 1e-8) * (1 - 4e-8) + m0 * d0 * k0 * power(1 - f, 4) * (1 - 1e-8) * (1 - 4e-8)
    WHEN 'hemi_x' THEN m1 * k2 * f * (1 - f) * (1 - 1e-8) + m0 * k0 * power(1 - f, 2) * (1 - 1e-8) ELSE d2 * k2 * f * (1 - 4e-8) + d0 * k0 * (1 - f) * (1 - 4e-8) END AS old,
  CASE WHEN st = 'hemi_x' THEN kid_dp / nullif(mom_dp, 0) WHEN st = 'hemi_y' THEN kid_dp / nullif(2 * dad_dp, 0) WHEN {X_NON} THEN kid_dp / nullif(mom_dp + dad_dp, 0) * 0.75 ELSE kid_dp / nullif(mom_dp + dad_dp, 0) END AS dpr FROM a),
g AS (SELECT *, new / (new + old) AS p FROM b WHERE kid_gq >= 20 AND dpr >= 0.1 AND cab >= 0.2 AND new / (new + old) >= 0.05 AND (st = 'hemi_y' OR (mom_ref + mom_alt > 0 AND mom_alt / (mom_ref + mom_alt) <= 0.05)) AND (st = 'hemi_x' OR (dad_ref + dad_alt > 0 AND dad_alt / (dad_ref + dad_alt) <= 0.05))),
l AS (SELECT *, CASE WHEN {SNP} THEN CASE WHEN (p > 0.99 AND cab > 0.3 AND dpr > 0.2) OR (p > 0.99 AND cab > 0.3 AND ac = 1) OR (p > 0.5 AND cab > 0.3 AND ac < 10 AND kid_dp > 10) THEN 'HIGH' WHEN p > 0.5 AND (cab > 0.3 OR ac = 1) THEN 'MEDIUM' WHEN cab > 0.2 THEN 'LOW' END
  ELSE CASE WHEN p > 0.99 AND cab > 0.3 AND ac = 1 THEN 'HIGH' WHEN p > 0.5 AND cab > 0.3 AND ac <= 5 THEN 'MEDIUM' WHEN cab > 0.2 THEN 'LOW' END END AS confidence FROM g)
"""


@query(_G1 + f"SELECT {SITE}, proband, round(p, 6) AS p_de_novo, round(dpr, 6) AS dp_ratio, confidence FROM l WHERE confidence IS NOT NULL", "v_trios", "v_sites", variants=("missing",))
def g1_denovo_posterior(spark, d):
    out = denovo.denovo_posterior(_with_counts(spark, d, only=trio.may_be_new()))
    return out.select(*gt.KEY, "proband", F.round("p_de_novo", 6).alias("p_de_novo"), F.round("dp_ratio", 6).alias("dp_ratio"), "confidence")


@query(f"WITH m AS (SELECT *, {MENDEL} AS code FROM ({_MORE})) SELECT {SITE}, proband, code AS mendel_code FROM m WHERE code IS NOT NULL", "v_trios", variants=("missing",))
def g2_mendel_codes(spark, d):
    return trio.mendel_errors(_trios(spark, d, trio.CALL)).select(*gt.KEY, "proband", "mendel_code")


@query(f"""WITH m AS (SELECT *, {MENDEL} AS code FROM ({_MORE})), h AS (SELECT {SITE}, unnest([proband, father, mother]) AS s FROM m WHERE code = 2)
SELECT contig, s, count(*) AS n FROM v_entries JOIN (SELECT DISTINCT * FROM h) USING ({SITE}, s) GROUP BY contig, s""", "v_trios")
def g3_mendel_code2_subset(spark, d):
    out = trio.mendel_code2_subset(scratch.written(V.entries(spark, d).select(*gt.KEY, "s", *trio.CALL), "entries"), pedigree.trio_list(_ped(spark, d)))
    return out.groupBy("contig", "s").agg(F.count("*").alias("n"))


_PBT = """CASE WHEN st = 'auto' THEN CASE WHEN kid_n = 0 AND dad_n < 2 AND mom_n < 2 THEN '0|0' WHEN kid_n = 2 AND dad_n > 0 AND mom_n > 0 THEN '1|1'
  WHEN kid_n = 1 AND dad_n = 1 AND mom_n = 1 THEN NULL WHEN kid_n = 1 AND dad_n > 0 AND mom_n < 2 AND (dad_n = 2 OR mom_n = 0) THEN '1|0' WHEN kid_n = 1 AND mom_n > 0 AND dad_n < 2 AND (mom_n = 2 OR dad_n = 0) THEN '0|1' END
  WHEN st = 'hemi_x' THEN CASE WHEN kid_n = 0 AND mom_n < 2 THEN '0' WHEN kid_n = 2 AND mom_n > 0 THEN '1' END
  WHEN st = 'hemi_y' THEN CASE WHEN kid_n = 0 AND dad_n < 2 THEN '0' WHEN kid_n = 2 AND dad_n > 0 THEN '1' END END"""


@query(f"WITH p AS (SELECT *, {_PBT} AS pbt FROM ({_MORE})) SELECT {SITE}, proband, pbt AS pbt_gt, CASE pbt WHEN '0|0' THEN 'uninherited' WHEN '0|1' THEN 'inherited_from_mother' WHEN '1|0' THEN 'inherited_from_father' WHEN '1|1' THEN 'inherited_from_both' END AS transmission FROM p", "v_trios", variants=("missing",))
def g4_g5_phase_and_transmission(spark, d):
    return trio.phase_trios(_trios(spark, d, trio.CALL)).select(*gt.KEY, "proband", "pbt_gt", trio.transmission(F.col("pbt_gt")).alias("transmission"))


@query(f"WITH x AS (SELECT *, {T_SQL} AS t1, {U_SQL} AS u1 FROM ({_MORE})) SELECT {SITE}, sum(t1) AS t, sum(u1) AS u, CASE WHEN sum(t1) + sum(u1) > 0 THEN (sum(t1) - sum(u1)) * (sum(t1) - sum(u1)) / (sum(t1) + sum(u1)) END AS chi2 FROM x GROUP BY {SITE}", "v_trios", variants=("missing",))
def g6_tdt(spark, d):
    return trio.tdt(_trios(spark, d, trio.CALL))


_TWO = f"(contig NOT IN ('chrX', 'chrY', 'chrM') OR (contig = 'chrX' AND NOT {X_NON}) OR is_female)"


@query(f"""WITH x AS (SELECT *, {_TWO} AS two, NOT {_TWO} AND {X_NON} AS one, {X_NON} AS xn FROM v_trios)
SELECT {SITE}, count(*) FILTER (two AND dad_n = 1 AND NOT xn AND ((kid_n = 1 AND mom_n = 0) OR (kid_n = 2 AND mom_n IN (1, 2)))) AS t_from_dad,
  count(*) FILTER (two AND dad_n = 1 AND NOT xn AND ((kid_n = 1 AND mom_n = 2) OR (kid_n = 0 AND mom_n IN (0, 1)))) AS u_from_dad,
  count(*) FILTER ((two AND mom_n = 1 AND ((kid_n = 1 AND dad_n = 0) OR (kid_n = 2 AND ((dad_n = 1 AND NOT xn) OR dad_n = 2)))) OR (one AND mom_n = 1 AND kid_n = 2 AND dad_n IN (0, 2))) AS t_from_mom,
  count(*) FILTER ((two AND mom_n = 1 AND ((kid_n = 1 AND dad_n = 2) OR (kid_n = 0 AND ((dad_n = 1 AND NOT xn) OR dad_n = 0)))) OR (one AND mom_n = 1 AND kid_n = 0 AND dad_n IN (0, 2))) AS u_from_mom,
  count(*) FILTER (two AND NOT xn AND kid_n = 1 AND dad_n = 1 AND mom_n = 1) AS t_indeterminate, count(*) FILTER (two AND NOT xn AND kid_n = 1 AND dad_n = 1 AND mom_n = 1) AS u_indeterminate FROM x GROUP BY {SITE}""", "v_trios", variants=("missing",))
def g7_parent_aware_tdt(spark, d):
    return trio.parent_aware_tdt(_trios(spark, d, trio.CALL))


def _rare_sql(kid: int, t: int, u: int) -> str:
    return f"""WITH {_COUNTS}, x AS (SELECT v.*, {T_SQL} AS t1, {U_SQL} AS u1 FROM ({_MORE}) v JOIN counts USING ({SITE}) WHERE ac <= 60), s AS (SELECT *, sum(t1) OVER w AS st1, sum(u1) OVER w AS su1 FROM x WINDOW w AS (PARTITION BY {SITE}))
SELECT {SITE}, proband FROM s WHERE st1 = {t} AND su1 = {u} AND kid_n = {kid} AND (dad_n = 1 OR mom_n = 1) AND least(kid_gq, dad_gq, mom_gq) >= 25"""


@query(_rare_sql(1, 1, 0), "v_trios", within="rare")
def g8_ultra_rare_inherited(spark, d):
    return denovo.ultra_rare_inherited(_with_counts(spark, d), ac=60, gq=25).select(*gt.KEY, "proband")


@query(_rare_sql(0, 0, 1), "v_trios", within="rare")
def g9_ultra_rare_parents(spark, d):
    return denovo.ultra_rare_inherited(_with_counts(spark, d), ac=60, gq=25, parents_only=True).select(*gt.KEY, "proband")


_IMP = "CASE WHEN code IN (1, 2, 3, 6, 11, 12) THEN 1 ELSE 0 END AS d, CASE WHEN code IN (1, 2, 4, 7, 9, 10) THEN 1 ELSE 0 END AS m"


@query(f"""WITH m AS (SELECT *, {MENDEL} AS code FROM ({_MORE})), i AS (SELECT *, {_IMP} FROM m WHERE code IS NOT NULL),
p AS (SELECT father AS s, fam_id, d AS own, {SNP} AS snp FROM i UNION ALL SELECT mother, fam_id, m, {SNP} FROM i UNION ALL SELECT proband, fam_id, 1, {SNP} FROM i)
SELECT s, fam_id, sum(own) AS errors, sum(CASE WHEN snp THEN own ELSE 0 END) AS snp_errors FROM p GROUP BY s, fam_id""", "v_trios", variants=("missing",))
def ag13_mendel_by_individual(spark, d):
    return trio.mendel_rollups(trio.mendel_errors(_trios(spark, d, trio.CALL)))["individual"]


@query(f"WITH m AS (SELECT *, {MENDEL} AS code FROM ({_MORE})) SELECT father AS pat_id, mother AS mat_id, fam_id, count(DISTINCT proband) AS children, count(*) AS errors, count(*) FILTER ({SNP}) AS snp_errors FROM m WHERE code IS NOT NULL GROUP BY father, mother, fam_id", "v_trios")
def ag13_mendel_by_family(spark, d):
    return trio.mendel_rollups(trio.mendel_errors(_trios(spark, d, trio.CALL)))["family"]


@query(f"""SELECT {SITE}, proband, CASE WHEN kid_n = 1 AND dad_n = 2 AND mom_n = 0 THEN 'father' WHEN kid_n = 1 AND dad_n = 0 AND mom_n = 2 THEN 'mother' END AS origin FROM v_trios WHERE kid_n = 1""", "v_trios")
def f16_parental_origin(spark, d):
    t = _trios(spark, d, trio.CALL).where(trio.calls("kid") == 1)
    return t.select(*gt.KEY, "proband", trio.parental_origin(trio.calls("kid"), trio.calls("dad"), trio.calls("mom")).alias("origin"))


@query(f"SELECT {SITE}, s, round(power(10, -pl1 / 10) / (power(10, -pl0 / 10) + power(10, -pl1 / 10) + power(10, -pl2 / 10)), 8) AS p_het FROM v_entries", "v_entries")
def f7_phred_to_probabilities(spark, d):
    return V.entries(spark, d).select(*gt.KEY, "s", F.round(F.get(gt.phred_to_probabilities("PL"), F.lit(1)), 8).alias("p_het"))


_X_SEX = "CASE WHEN x_hom_var > 0 AND x_called > {n} AND x_het / x_hom_var < 0.05 THEN 1 WHEN x_hom_var > 0 AND x_called > {n} AND x_het / x_hom_var > 0.4 THEN 2 ELSE -9 END"
_SEX_OF = "CASE WHEN y_called > 0 AND ped_sex = 1 AND y_ploidy < 0.4 THEN -1 WHEN y_called > 0 AND ped_sex = 2 AND y_ploidy > 0.4 THEN -2 ELSE " + _X_SEX + " END"


@query(f"""WITH e AS (SELECT *, a1 IS NOT NULL AND dp <> 0 AND NOT (a1 <> a2 AND coalesce(ad_alt / nullif(ad_ref + ad_alt, 0) NOT BETWEEN 0.3 AND 0.7, true)) AS called FROM v_entries),
q AS (SELECT s, count(*) FILTER ({X_NON} AND dp >= 7 AND called) AS x_called, count(*) FILTER ({X_NON} AND dp >= 7 AND called AND a1 <> a2) AS x_het, count(*) FILTER ({X_NON} AND dp >= 7 AND called AND a1 = 1) AS x_hom_var,
  count(*) FILTER ({Y_NON} AND called) AS y_called, 2 * avg(dp) FILTER ({X_NON} AND dp >= 7) / avg(dp) FILTER (called AND dp >= 7) AS x_ploidy, 2 * avg(dp) FILTER ({Y_NON}) / avg(dp) FILTER (called AND dp >= 7) AS y_ploidy FROM e GROUP BY s)
SELECT s, x_called, x_het, x_hom_var, y_called, x_ploidy, y_ploidy, sex AS ped_sex, {_SEX_OF.format(n=10).replace('ped_sex', 'sex')} AS sex FROM q LEFT JOIN v_ped ON sample_id = s""", "v_entries", "v_ped", within="sexed")
def g25_infer_sex(spark, d):
    return qc.infer_sex(V.entries(spark, d), ped=_ped(spark, d))


@query("""WITH n AS (SELECT CASE WHEN length(ref) = length(alt) THEN 'SNV' ELSE 'Indel' END AS type, proband AS sample, count(*) AS n FROM v_trios WHERE kid_n = 1 AND dad_n = 0 AND mom_n = 0 GROUP BY 1, 2),
q AS (SELECT type, quantile_cont(n, 0.25) AS q1, quantile_cont(n, 0.75) AS q3 FROM n GROUP BY type) SELECT type, sample, n, q3 + 1.5 * (q3 - q1) AS "limit", n >= q3 + 1.5 * (q3 - q1) AS is_outlier FROM n JOIN q USING (type)""", "v_trios")
def w4_count_outliers(spark, d):
    flat = denovo.flatten_trio(denovo.denovo_by_gt(_trios(spark, d))).select(F.col("TYPE").alias("type"), F.col("SAMPLE").alias("sample"))
    return qc.count_outliers(flat, "sample", ["type"])


@query("""WITH q AS (SELECT s, count(*) FILTER (a1 <> a2) AS n_het FROM v_entries GROUP BY s), f AS (SELECT sample_id AS s FROM v_ped WHERE CAST(substr(sample_id, 2) AS INT) % 5 <> 0), l AS (SELECT max(n_het) AS m FROM q WHERE s NOT IN (SELECT s FROM f))
SELECT s, n_het, m AS "limit" FROM q, l WHERE n_het > m""", "v_entries", "v_ped")
def w5_nhet_outliers(spark, d):
    return qc.nhet_outliers(qc.sample_qc(V.entries(spark, d)), _ped(spark, d).where("CAST(substr(sample_id, 2) AS INT) % 5 <> 0").select(F.col("sample_id").alias("s")))


@query("""SELECT v.*, CASE WHEN count(*) OVER (PARTITION BY family_id) = 1 THEN 'Singleton' WHEN paternal_id IS NOT NULL AND maternal_id IS NOT NULL THEN 'Proband'
  WHEN sample_id IN (SELECT paternal_id FROM v_ped WHERE paternal_id IS NOT NULL) THEN 'Father' WHEN sample_id IN (SELECT maternal_id FROM v_ped WHERE maternal_id IS NOT NULL) THEN 'Mother' ELSE 'Unknown' END AS role FROM v_ped v""", "v_ped")
def w9_sample_roles(spark, d):
    return pedigree.sample_roles(_ped(spark, d))


@query("SELECT v.* FROM v_ped v WHERE family_id IN (SELECT family_id FROM v_ped WHERE paternal_id IS NOT NULL)", "v_ped")
def w10_valid_trios(spark, d):
    return pedigree.valid_trios(_ped(spark, d)).select(*pedigree.COLUMNS)


@query("SELECT family_id AS fam_id, sample_id AS proband, paternal_id AS father, maternal_id AS mother, sex = 2 AS is_female FROM v_ped WHERE paternal_id IS NOT NULL", "v_ped")
def w11_trio_list(spark, d):
    return pedigree.trio_list(_ped(spark, d))


@query("""WITH k AS (SELECT * FROM v_ped WHERE paternal_id IS NOT NULL), r AS (SELECT family_id, sample_id AS s, 'kid' AS role FROM k UNION ALL SELECT family_id, paternal_id, 'dad' FROM k UNION ALL SELECT family_id, maternal_id, 'mom' FROM k)
SELECT family_id AS fam_id, s, role FROM r""", "v_ped")
def w11_sample_list(spark, d):
    return pedigree.sample_list(_ped(spark, d))


@query("SELECT family_id, count(*) AS n_members, count(paternal_id) AS n_children, count(*) = 3 AND count(paternal_id) = 1 AS is_trio FROM v_ped GROUP BY family_id", "v_ped")
def ag14_trio_families(spark, d):
    return pedigree.trio_families(_ped(spark, d))


_BIG = "big AS (SELECT CASE WHEN CAST(substr(family_id, 2) AS BIGINT) % 4 = 0 THEN family_id ELSE concat('F', CAST(substr(family_id, 2) AS BIGINT) - CAST(substr(family_id, 2) AS BIGINT) % 4) END AS family_id, sample_id, paternal_id, maternal_id, sex, phenotype FROM v_ped)"


def _big(spark: SparkSession, d: str) -> DataFrame:
    """Four trios joined into one family."""
    n = F.substring("family_id", 2, 20).cast("long")
    return _ped(spark, d).withColumn("family_id", F.concat(F.lit("F"), (n - n % 4).cast("string")))


@query(f"""WITH {_BIG}, n AS (SELECT family_id, count(*) AS n FROM big GROUP BY family_id), k AS (SELECT big.*, n, row_number() OVER (PARTITION BY family_id ORDER BY sample_id) AS i FROM big JOIN n USING (family_id) WHERE paternal_id IS NOT NULL),
t AS (SELECT CASE WHEN n > 3 THEN concat(family_id, '_', i) ELSE family_id END AS trio, * FROM k)
SELECT trio AS family_id, sample_id, paternal_id, maternal_id, sex, phenotype FROM t UNION ALL SELECT trio, p.sample_id, NULL, NULL, p.sex, p.phenotype FROM t JOIN v_ped p ON p.sample_id IN (t.paternal_id, t.maternal_id)""", "v_ped")
def w8_split_families(spark, d):
    return pedigree.split_families(_big(spark, d))


@query("""WITH i AS (SELECT sample_id, CASE WHEN CAST(substr(sample_id, 2) AS BIGINT) % 7 = 0 THEN 'S1' ELSE paternal_id END AS paternal_id, maternal_id, CASE WHEN CAST(substr(sample_id, 2) AS BIGINT) % 5 = 0 THEN 3 - sex ELSE sex END AS sex, phenotype FROM v_ped),
j AS (SELECT p.sample_id, coalesce(p.paternal_id, '-9') AS p1, coalesce(i.paternal_id, '-9') AS p2, CAST(p.sex AS VARCHAR) AS s1, CAST(i.sex AS VARCHAR) AS s2 FROM v_ped p JOIN i USING (sample_id))
SELECT sample_id, 'paternal_id' AS field, p1 AS given, p2 AS inferred FROM j WHERE p1 <> p2 UNION ALL SELECT sample_id, 'sex', s1, s2 FROM j WHERE s1 <> s2""", "v_ped")
def w12_compare_peds(spark, d):
    n = F.substring("sample_id", 2, 20).cast("long")
    other = _ped(spark, d).withColumns({"paternal_id": F.when(n % 7 == 0, F.lit("S1")).otherwise(F.col("paternal_id")), "sex": F.when(n % 5 == 0, 3 - F.col("sex")).otherwise(F.col("sex"))})
    return pedigree.compare_peds(_ped(spark, d), other)


_OTHER_TEXT = [f"coalesce(CAST({{}}.{c} AS VARCHAR), '-9')" for c in ("family_id", "paternal_id", "maternal_id", "sex", "phenotype")]
_DIFFERS = "(" + " OR ".join(f"{x.format('o')} <> {x.format('p')}" for x in _OTHER_TEXT) + ")"
_SAME = " AND ".join(f"{x.format('o')} = {x.format('p')}" for x in _OTHER_TEXT[1:])


@query(f"SELECT p.* FROM v_ped p LEFT JOIN v_other_ped o USING (sample_id) WHERE o.sample_id IS NULL OR ({_SAME})", "v_ped", "v_other_ped")
def w12_clean_ped(spark, d):
    return pedigree.correct_ped(_ped(spark, d), V.view(spark, d, "v_other_ped"))


@query(f"""WITH r AS (SELECT o.*, CASE WHEN {_DIFFERS} AND (o.paternal_id IS NULL) <> (o.maternal_id IS NULL) THEN coalesce(o.paternal_id, o.maternal_id) END AS other FROM v_other_ped o JOIN v_ped p ON p.sample_id = o.sample_id),
g AS (SELECT r.*, k.sample_id IS NOT NULL AS there, coalesce(k.paternal_id = r.sample_id, false) OR coalesce(k.maternal_id = r.sample_id, false) AS circular FROM r LEFT JOIN v_other_ped k ON k.sample_id = other)
SELECT family_id, sample_id, CASE WHEN NOT circular THEN paternal_id END AS paternal_id, CASE WHEN NOT circular THEN maternal_id END AS maternal_id, sex, phenotype FROM g WHERE NOT there OR circular""", "v_ped", "v_other_ped")
def w12_corrected_ped(spark, d):
    return pedigree.corrected_ped(_ped(spark, d), V.view(spark, d, "v_other_ped"))


@query("""SELECT concat(c, ':', family_id) AS family_id, concat(c, ':', sample_id) AS sample_id, CASE WHEN paternal_id IS NOT NULL THEN concat(c, ':', paternal_id) END AS paternal_id, CASE WHEN maternal_id IS NOT NULL THEN concat(c, ':', maternal_id) END AS maternal_id, sex, phenotype, c AS cohort
FROM v_ped, (SELECT unnest(['a', 'b']) AS c)""", "v_ped")
def w13_merge_peds(spark, d):
    return pedigree.merge_peds({"a": _ped(spark, d), "b": _ped(spark, d)})


@query(f"""WITH {_BIG}, p AS (SELECT a.family_id, a.sample_id AS i, b.sample_id AS j, a.paternal_id AS ap, a.maternal_id AS am, b.paternal_id AS bp, b.maternal_id AS bm FROM big a JOIN big b ON a.family_id = b.family_id AND a.sample_id < b.sample_id),
c AS (SELECT least(paternal_id, maternal_id) AS i, greatest(paternal_id, maternal_id) AS j FROM v_ped WHERE paternal_id IS NOT NULL)
SELECT family_id, i, j, CASE WHEN coalesce(ap = j OR am = j, false) OR coalesce(bp = i OR bm = i, false) THEN 'parent-child' WHEN coalesce(ap = bp AND am = bm, false) THEN 'siblings' ELSE 'related_other' END AS expected FROM p WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.i = p.i AND c.j = p.j)""", "v_ped")
def w14_pedigree_pairs(spark, d):
    return pedigree.pedigree_pairs(_big(spark, d))


@query("SELECT v.* FROM v_ped v WHERE sex = 1 UNION ALL SELECT '-9', sample_id, NULL, NULL, -9, -9 FROM v_ped WHERE sex <> 1", "v_ped")
def w19_pad_ped(spark, d):
    return pedigree.pad_ped(_ped(spark, d).where("sex = 1"), _ped(spark, d).select(F.col("sample_id").alias("s")))


@query("SELECT v.* FROM v_ped v WHERE sample_id IN ('S0', 'S1', 'S2')", "v_ped")
def w20_trio_ped_of(spark, d):
    return pedigree.trio_ped_of(_ped(spark, d), "S2").select(*pedigree.COLUMNS)


@query(f"SELECT {SITE}, list_sort(list(DISTINCT gq)) AS gqs FROM v_entries WHERE a1 + a2 = 0 GROUP BY {SITE}", "v_entries")
def ag23_random_homref_gq(spark, d):
    return qc.random_homref_gq(V.entries(spark, d)).select(*gt.KEY, "gqs")

