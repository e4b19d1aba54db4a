"""Genotype and site quality control on long entries (contig, pos, ref, alt, s, a1, a2, AD, DP, GQ, PL)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import genotype as gt
from ..functions import locus, stats, variant


def _count(c: Column) -> Column:
    return F.sum(F.when(c, 1).otherwise(0))


def entry_metrics(entries: DataFrame) -> DataFrame:
    """AB, DPC (all allele reads) and VAF; null where the divisor is 0."""
    return entries.withColumns({"AB": gt.allele_balance(), "DPC": gt.total(), "VAF": gt.vaf()})


def annotate_pab(entries: DataFrame) -> DataFrame:
    """pAB of het calls: two-sided binomial p of the alternate reads at one half."""
    return entries.withColumn("pAB", F.when(gt.is_het(), stats.binomial_two_sided(F.get("AD", F.lit(1)), gt.total())))


def drop_empty_sites(entries: DataFrame) -> DataFrame:
    """Entries of sites that still carry an alternate allele: one shuffle by site, and the input is worked out once."""
    alleles = F.sum(gt.n_alt()).over(Window.partitionBy(*gt.KEY))
    return entries.withColumn("__ac", alleles).where("__ac > 0").drop("__ac")


def basic_gt_filter(entries: DataFrame) -> DataFrame:
    """Drops entries of DP under 7 or over 1000, hom-ref calls of GQ under 25, others of PL[0] under 25."""
    low_pl = F.get("PL", F.lit(0)) < 25
    bad = (F.col("DP") < 7) | (F.col("DP") > 1000) | (gt.is_hom_ref() & (F.col("GQ") < 25)) | (gt.is_hom_var() & low_pl) | (gt.is_het() & low_pl)
    return entries.where(~F.coalesce(bad, F.lit(False)))


def with_sex(entries: DataFrame, ped: DataFrame) -> DataFrame:
    """is_female by reported sex; null for samples without one. A pedigree has a row a sample and is left to Spark to broadcast."""
    return entries.join(ped.select(F.col("sample_id").alias("s"), (F.col("sex") == 2).alias("is_female")).dropDuplicates(["s"]), "s", "left")


def sex_gt_filter(entries: DataFrame, ped: DataFrame) -> DataFrame:
    """Drops shallow calls (DP under 10) of females, and of males on autosomes and PAR; Y calls of females; het calls of males on
    one-copy regions."""
    x, y = locus.in_x_nonpar(), locus.in_y_nonpar()
    girl, boy = F.col("is_female"), ~F.col("is_female")
    bad = (girl & (F.col("DP") < 10)) | (girl & y) | (boy & locus.in_autosome_or_par() & (F.col("DP") < 10)) | (boy & gt.is_het() & (x | y))
    return with_sex(entries, ped).where(~F.coalesce(bad, F.lit(False)))


def balance_filters(entries: DataFrame) -> DataFrame:
    """Drops het calls with fewer alternate reads than DP/4, pAB under 1e-9 or informative reads under 0.9 DP, and hom-var calls
    with fewer alternate reads than 0.9 DP; then sites without an alternate allele (the rules judge single entries, so one
    check of the sites at the end is enough)."""
    alt = F.get("AD", F.lit(1))
    het_bad = (alt < 0.25 * F.col("DP")) | (gt.total() < 0.9 * F.col("DP")) | stats.binomial_below(alt, gt.total(), 1e-9)
    bad = (gt.is_het() & het_bad) | (gt.is_hom_var() & (alt < 0.9 * F.col("DP")))
    return drop_empty_sites(entries.where(~F.coalesce(bad, F.lit(False))))


def fill_homref(entries: DataFrame, gq_floor: int | None = None) -> DataFrame:
    """AD and PL of hom-ref calls filled in where missing; gq_floor: entries of lower GQ go first."""
    if gq_floor is not None:
        entries = entries.where(F.col("GQ") >= gq_floor)
    return entries.withColumn("AD", gt.filled_ad()).withColumn("PL", gt.filled_pl())


def estimate_dp_pl(entries: DataFrame, default_dp: int = 100) -> DataFrame:
    """AD [default_dp, 0] where missing, DP the sum of AD where missing, PL estimated from GQ by call where missing."""
    out = entries.withColumn("AD", gt.filled_ad(default_dp)).withColumn("DP", F.coalesce("DP", gt.total()))
    g = F.coalesce("GQ", F.lit(0))
    guess = F.when(gt.is_hom_ref(), F.array(F.lit(0), g, 2 * g)).when(gt.is_het(), F.array(g, F.lit(0), g)).when(gt.is_hom_var(), F.array(2 * g, g, F.lit(0)))
    return out.withColumn("PL", F.coalesce("PL", guess))


def fill_pl(entries: DataFrame) -> DataFrame:
    return entries.withColumn("PL", gt.zero_pl())


@dataclass(frozen=True)
class SiteCutoffs:
    """Limits of the site filter; a missing metric fails."""

    snv_qual: float = 150
    snv_sor: float = 2.5
    snv_rank_sum: float = -1.4
    snv_qd: float = 3.0
    snv_mq: float = 50
    indel_qual: float = 150
    indel_sor: float = 3
    indel_rank_sum: float = -1.7
    indel_qd: float = 4.0
    indel_mq: float = 50


def hard_filter_sites(sites: DataFrame, cfg: SiteCutoffs = SiteCutoffs()) -> DataFrame:  # noqa: B008
    """Sites within the limits of their type (qual, sor, read_pos_rank_sum, qd, mq)."""
    snv = variant.is_snp()
    pick = lambda name: F.when(snv, getattr(cfg, f"snv_{name}")).otherwise(getattr(cfg, f"indel_{name}"))
    return sites.where((F.col("qual") >= pick("qual")) & (F.col("sor") <= pick("sor")) & (F.col("read_pos_rank_sum") >= pick("rank_sum")) & (F.col("qd") >= pick("qd")) & (F.col("mq") >= pick("mq")))


def depth_pass_filter(entries: DataFrame, sites: DataFrame, low: int = 10, high: int = 200) -> DataFrame:
    """Entries with low <= DPC <= high; SNVs need a PASS site, indels do not."""
    out = entries.join(sites.select(*gt.KEY, "filter"), gt.KEY).where(gt.total().between(low, high))
    return out.where(~variant.is_snp() | (F.col("filter") == "PASS")).drop("filter")


def denovo_entry_filter(trios: DataFrame, use_gq: bool = True) -> DataFrame:
    """Trio rows whose child is het with AB 0.22 to 0.78 (indels 0.20 to 0.80) and whose parents are hom-ref with AB at most
    0.05 (and, for indels, 16 allele reads or more); use_gq: child GQ 99 or more, parents 30 or more."""
    snp = variant.is_snp()
    depth = lambda m: F.get(F.col(f"{m}.AD"), F.lit(0)) + F.get(F.col(f"{m}.AD"), F.lit(1))
    ab = lambda m: gt.ratio(F.get(F.col(f"{m}.AD"), F.lit(1)), depth(m))
    child = (F.col("kid.a1") != F.col("kid.a2")) & F.when(snp, ab("kid").between(0.22, 0.78)).otherwise(ab("kid").between(0.20, 0.80))
    parent = lambda m: (F.col(f"{m}.a1") + F.col(f"{m}.a2") == 0) & (ab(m) <= 0.05) & (snp | (depth(m) >= 16))
    out = trios.where(child & parent("dad") & parent("mom"))
    return out.where((F.col("kid.GQ") >= 99) & (F.col("dad.GQ") >= 30) & (F.col("mom.GQ") >= 30)) if use_gq else out


def variant_qc(entries: DataFrame) -> DataFrame:
    """By site: AC, AN, AF, n_called, n_het, call_rate and mean GQ of called entries; sites without an alternate allele go."""
    out = entries.groupBy(*gt.KEY).agg(F.sum(gt.n_alt()).alias("AC"), (2 * _count(gt.is_defined())).alias("AN"), _count(gt.is_defined()).alias("n_called"), _count(gt.is_het()).alias("n_het"), F.count("*").alias("n"), F.avg(F.when(gt.is_defined(), F.col("GQ"))).alias("gq_mean"))
    return out.where("AC > 0").withColumns({"AF": F.col("AC") / F.col("AN"), "call_rate": F.col("n_called") / F.col("n")}).drop("n")


def site_counts(entries: DataFrame) -> DataFrame:
    """AC, AN and AF of variant_qc alone, from calls."""
    out = entries.groupBy(*gt.KEY).agg(F.sum(gt.n_alt()).alias("AC"), (2 * _count(gt.is_defined())).alias("AN"))
    return out.where("AC > 0").withColumn("AF", F.col("AC") / F.col("AN"))


def sample_qc(entries: DataFrame) -> DataFrame:
    """By sample: calls by kind, alternate alleles by type, ratios (null where the divisor is 0) and depth and quality means."""
    snp, ti = variant.is_snp(), variant.is_transition()
    longer, shorter = F.length("alt") > F.length("ref"), F.length("alt") < F.length("ref")
    n = gt.n_alt()
    out = entries.groupBy("s").agg(
        _count(gt.is_defined()).alias("n_called"), _count(~gt.is_defined()).alias("n_not_called"), _count(gt.is_hom_ref()).alias("n_hom_ref"), _count(gt.is_het()).alias("n_het"), _count(gt.is_hom_var()).alias("n_hom_var"), _count(gt.is_non_ref()).alias("n_non_ref"),
        F.sum(F.when(snp, n).otherwise(0)).alias("n_snp"), F.sum(F.when(longer, n).otherwise(0)).alias("n_insertion"), F.sum(F.when(shorter, n).otherwise(0)).alias("n_deletion"),
        F.sum(F.when(ti, n).otherwise(0)).alias("n_transition"), F.sum(F.when(snp & ~ti, n).otherwise(0)).alias("n_transversion"), F.avg("DP").alias("dp_mean"), F.avg("GQ").alias("gq_mean"),
    )
    return out.withColumns({"r_ti_tv": gt.ratio(F.col("n_transition"), F.col("n_transversion")), "r_het_hom_var": gt.ratio(F.col("n_het"), F.col("n_hom_var"))})


def sex_aware_site_stats(entries: DataFrame, ped: DataFrame) -> DataFrame:
    """By site: calls by sex, and call_rate, AC and AN by copy state (Y outside PAR: males once; X outside PAR: males once,
    females twice), and pHWE (females alone on X, 1 on Y and MT). Samples without sex count nowhere."""
    rows = with_sex(entries, ped)
    girl, boy = F.col("is_female"), ~F.col("is_female")
    totals = ped.join(entries.select(F.col("s").alias("sample_id")).distinct(), "sample_id", "left_semi").agg(_count(F.col("sex") != 2).alias("males"), _count(F.col("sex") == 2).alias("females"))
    counts = [_count(kind() & who).alias(f"{sex}_{name}") for sex, who in (("male", boy), ("female", girl)) for name, kind in (("hets", gt.is_het), ("homvars", gt.is_hom_var), ("calls", gt.is_defined))]
    out = rows.groupBy(*gt.KEY).agg(*counts).crossJoin(F.broadcast(totals))  # totals is one row
    x, y = locus.in_x_nonpar(), locus.in_y_nonpar()
    c = F.col
    mc, fc = c("male_calls"), c("female_calls")
    hets, homs = c("male_hets") + c("female_hets"), c("male_homvars") + c("female_homvars")
    out = out.withColumns({
        "call_rate": F.when(y, gt.ratio(mc, c("males"))).when(x, gt.ratio(mc + 2 * fc, c("males") + 2 * c("females"))).otherwise(gt.ratio(mc + fc, c("males") + c("females"))),
        "AC": F.when(y, c("male_homvars")).when(x, c("male_homvars") + c("female_hets") + 2 * c("female_homvars")).otherwise(hets + 2 * homs),
        "AN": F.when(y, mc).when(x, mc + 2 * fc).otherwise(2 * (mc + fc)),
    })
    hwe = F.when(y | locus.in_mito(), 1.0).when(x, stats.hardy_weinberg(fc - c("female_hets") - c("female_homvars"), c("female_hets"), c("female_homvars"))).otherwise(stats.hardy_weinberg(mc + fc - hets - homs, hets, homs))
    return out.withColumn("p_hwe", hwe).drop("males", "females")


def hwe_call_rate_filter(stats_rows: DataFrame, call_rate: float = 0.8) -> DataFrame:
    return stats_rows.where((F.col("AC") > 0) & (F.col("call_rate") >= call_rate) & (F.col("p_hwe") >= 1e-12))


def sex_aware_sample_call_rate(entries: DataFrame, ped: DataFrame) -> DataFrame:
    """By sample: called share of all sites; for females of those outside the Y's own region."""
    sites = entries.select("contig", "pos", "ref", "alt").distinct().agg(_count(locus.in_y_nonpar()).alias("y"), _count(~locus.in_y_nonpar()).alias("rest"))
    per = with_sex(entries, ped).groupBy("s", "is_female").agg(_count(gt.is_defined()).alias("called"), _count(gt.is_defined() & ~locus.in_y_nonpar()).alias("off_y"))
    rate = F.when(F.col("is_female"), gt.ratio(F.col("off_y"), F.col("rest"))).otherwise(gt.ratio(F.col("called"), F.col("y") + F.col("rest")))
    return per.crossJoin(F.broadcast(sites)).select("s", rate.alias("call_rate"))


def sex_of(row: dict[str, Column], least_called: int = 10, given: Column | None = None) -> Column:
    """Inferred sex of infer_sex's columns: 1 or 2 by the het to hom-var ratio on X (under 0.05, over 0.4; more than least_called calls),
    -9 where nothing can be said. With calls on Y, a sample that the pedigree gives as male is -1 where its Y is lost, one given as female
    -2 where it has a Y, whatever X says. given: the pedigree's sex; without it the inferred one stands in."""
    ratio = gt.ratio(row["x_het"], F.when(row["x_hom_var"] > 0, row["x_hom_var"]))
    enough = row["x_called"] > least_called
    base = F.when(enough & (ratio < 0.05), 1).when(enough & (ratio > 0.4), 2).otherwise(-9)
    on_y, known = row["y_called"] > 0, base if given is None else given
    return F.when(on_y & (known == 1) & (row["y_ploidy"] < 0.4), -1).when(on_y & (known == 2) & (row["y_ploidy"] > 0.4), -2).otherwise(base)


def infer_sex(entries: DataFrame, least_called: int = 10, least_dp: int = 7, ped: DataFrame | None = None) -> DataFrame:
    """By sample: het and hom-var calls and all calls on X, calls on Y, ploidies of X and Y, and the inferred sex (see sex_of).

    A call with no depth, and a het call with an allele balance outside 0.3 to 0.7, is missing. On X entries need a depth of
    least_dp; a ploidy is twice the mean depth there (on Y of every entry) over that of all called entries of at least least_dp.
    """
    x, y = locus.in_x_nonpar(), locus.in_y_nonpar()
    called = gt.is_defined() & (F.col("DP") != 0) & ~F.coalesce(gt.is_het() & ~F.coalesce(gt.allele_balance().between(0.3, 0.7), F.lit(False)), F.lit(False))
    deep = F.col("DP") >= least_dp
    mean = lambda c: F.avg(F.when(c, F.col("DP")))
    per = entries.withColumns({"__called": called, "__x": x & deep, "__y": y}).groupBy("s").agg(
        _count(F.col("__x") & F.col("__called")).alias("x_called"), _count(F.col("__x") & F.col("__called") & gt.is_het()).alias("x_het"), _count(F.col("__x") & F.col("__called") & gt.is_hom_var()).alias("x_hom_var"),
        _count(F.col("__y") & F.col("__called")).alias("y_called"), mean(F.col("__x")).alias("x_dp"), mean(F.col("__y")).alias("y_dp"), mean(F.col("__called") & deep).alias("all_dp"),
    )
    out = per.withColumns({"x_ploidy": gt.ratio(2 * F.col("x_dp"), F.col("all_dp")), "y_ploidy": gt.ratio(2 * F.col("y_dp"), F.col("all_dp"))}).drop("x_dp", "y_dp", "all_dp")
    columns = {c: F.col(c) for c in out.columns}
    if ped is None:
        return out.withColumn("sex", sex_of(columns, least_called))
    out = out.join(ped.select(F.col("sample_id").alias("s"), F.col("sex").alias("ped_sex")), "s", "left")
    return out.withColumn("sex", sex_of(columns, least_called, F.col("ped_sex")))


def subset_samples(entries: DataFrame, samples: DataFrame) -> DataFrame:
    """Entries of the samples (s), and of them only sites that carry an alternate allele."""
    return drop_empty_sites(entries.join(samples.select("s").distinct(), "s", "left_semi"))


def interval_callrate(entries: DataFrame, bed: DataFrame) -> DataFrame:
    """By interval and sample: share of called entries."""
    from .interval import annotate_points

    named = annotate_points(entries.select(*gt.KEY).distinct(), bed, "intervals")
    return entries.join(named, gt.KEY).select("s", F.explode("intervals").alias("interval"), gt.is_defined().cast("int").alias("ok")).groupBy("interval", "s").agg(F.avg("ok").alias("call_rate"))


def count_outliers(df: DataFrame, sample: str, by: list[str], rule: str = "quartile") -> DataFrame:
    """Samples with their number of rows (within `by`) and whether it is an outlier.

    quartile: at or over Q3 + 1.5 IQR; triple: over ceil(3 (Q3 + 1.5 IQR)); q95: over the 95th centile + 1.5 IQR.
    """
    n = df.groupBy(*by, sample).agg(F.count("*").alias("n"))
    q = n.groupBy(*by).agg(F.percentile("n", F.array(F.lit(0.25), F.lit(0.75), F.lit(0.95))).alias("q"))
    q1, q3, q95 = (F.get("q", F.lit(i)) for i in range(3))
    fence = q3 + 1.5 * (q3 - q1)
    limit = {"quartile": fence, "triple": F.ceil(3 * fence).cast("double"), "q95": q95 + 1.5 * (q3 - q1)}[rule]
    limits = q.select(*by, limit.alias("limit"))
    joined = n.join(limits, by) if by else n.crossJoin(F.broadcast(limits))
    return joined.withColumn("is_outlier", F.col("n") >= F.col("limit") if rule == "quartile" else F.col("n") > F.col("limit"))


def nhet_outliers(qc: DataFrame, flagged: DataFrame) -> DataFrame:
    """Samples with more het calls than any sample that no other check has flagged (s)."""
    top = qc.join(flagged.select("s").distinct(), "s", "left_anti").agg(F.max("n_het").alias("limit"))
    return qc.crossJoin(F.broadcast(top)).where(F.col("n_het") > F.col("limit")).select("s", "n_het", "limit")


def restrict_contigs(df: DataFrame, drop: tuple[str, ...] = (), keep: tuple[str, ...] = (), key: str = "contig") -> DataFrame:
    df = df.where(~F.col(key).isin(*drop)) if drop else df
    return df.where(F.col(key).isin(*keep)) if keep else df


def keep_known(df: DataFrame, known: DataFrame) -> DataFrame:
    return df.join(known.select(*gt.KEY).distinct(), gt.KEY, "left_semi")


def freq_filter(df: DataFrame, cohort_ac: int | None = None, cohort_af: float | None = None, gnomad_af: float | None = None, need_pass: bool = False) -> DataFrame:
    """Rare rows: AC and AF within their limits, gnomad_af within its own or missing, filter PASS if asked."""
    if cohort_ac is not None:
        df = df.where(F.col("AC") <= cohort_ac)
    if cohort_af is not None:
        df = df.where(F.col("AF") <= cohort_af)
    if gnomad_af is not None:
        df = df.where(F.col("gnomad_af").isNull() | (F.col("gnomad_af") <= gnomad_af))
    return df.where(F.col("filter") == "PASS") if need_pass else df


def filter_prioritized(df: DataFrame, popmax: float, cohort_ac: int) -> DataFrame:
    """PASS rows that are rare in the population or in the cohort."""
    return df.where((F.col("filter") == "PASS") & ((F.col("gnomad_af") <= popmax) | (F.col("AC") <= cohort_ac)))


def random_homref_gq(entries: DataFrame) -> DataFrame:
    """By site: the distinct GQs of hom-ref calls and one of them picked by hash of the site, so that a rerun picks the same."""
    out = entries.where(gt.is_hom_ref()).groupBy(*gt.KEY).agg(F.array_sort(F.collect_set("GQ")).alias("gqs"))
    return out.withColumn("gq", F.get("gqs", F.pmod(F.xxhash64(*gt.KEY), F.size("gqs")).cast("int")))
