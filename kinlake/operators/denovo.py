"""De novo calling on the trio matrix (structs kid, dad, mom; see trio.trio_entries)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import genotype as gt
from ..functions import locus, variant
from ..functions.columns import computed
from .trio import calls, copy_state, transmissions


@dataclass(frozen=True)
class DeNovoConfig:
    """Priors and limits of the caller."""

    mother_rate: float = 1 / 100_000_000
    father_rate: float = 1 / 25_000_000
    mito_rate: float = 1e-7
    least_frequency: float = 100 / 30_000_000
    min_gq: int = 20
    min_p: float = 0.05
    max_parent_ab: float = 0.05
    min_child_ab: float = 0.20
    min_dp_ratio: float = 0.10
    ignore_cohort: bool = False


def denovo_posterior(trios: DataFrame, cfg: DeNovoConfig = DeNovoConfig()) -> DataFrame:  # noqa: B008
    """Trio rows with prior, dp_ratio, p_de_novo and confidence (HIGH, MEDIUM, LOW), where a call can be made.

    trios also has AC, AN (site counts) and gnomad_af (null: 0). The alternative to a new mutation in either parent is an alternate
    allele that a parent carries unseen, or none at all; each is weighted by the site's frequency. Sites fall into four copy
    states (two copies; one on X, Y or the mitochondrion). Rows that fail a limit, have a missing value in one, or reach no
    level of confidence are left out.
    """
    c = F.col
    male = ~c("is_female")
    x, y = locus.in_x_nonpar(), locus.in_y_nonpar()
    state = F.when(locus.in_autosome_or_par() | (x & c("is_female")), "auto").when(x & male, "x").when(y & male, "y").when(locus.in_mito(), "mt")
    pop = F.coalesce("gnomad_af", F.lit(0.0))
    known = F.greatest(pop, F.lit(cfg.least_frequency))
    rows = trios.where((pop >= 0) & (pop <= 1)).withColumns({"state": state, "alts": F.lit(1) if cfg.ignore_cohort else c("AC")})
    rows = rows.withColumn("prior", known if cfg.ignore_cohort else F.greatest((c("AC") - 1) / c("AN"), known))
    kid, dad, mom = calls("kid"), calls("dad"), calls("mom")
    fits = ((c("state") == "auto") & (kid == 1) & (dad == 0) & (mom == 0)) | (c("state").isin("x", "mt") & (kid == 2) & (mom == 0)) | ((c("state") == "y") & (kid == 2) & (dad == 0))
    rows = rows.where(fits)
    rows = computed(rows, **{f"pp_{m}": gt.phred_to_probabilities(f"{m}.PL") for m in ("kid", "dad", "mom")})
    p = lambda m, i: F.get(f"pp_{m}", F.lit(i))
    reads = lambda m: F.get(F.col(f"{m}.AD"), F.lit(0)) + F.get(F.col(f"{m}.AD"), F.lit(1))
    ab = lambda m: gt.ratio(F.get(F.col(f"{m}.AD"), F.lit(1)), reads(m))
    dp = lambda m: F.col(f"{m}.DP")
    f, q = c("prior"), 1 - c("prior")

    def posterior(new: Column, *others: Column) -> Column:
        whole = new
        for o in others:
            whole = whole + o
        return new / whole

    mr, fr, tr = cfg.mother_rate, cfg.father_rate, cfg.mito_rate
    quiet = (1 - mr) * (1 - fr)
    seen = p("mom", 0) * p("dad", 0) * p("kid", 1)
    auto = posterior(
        seen * F.pow(q, F.lit(4)) * (mr * (1 - fr) + fr * (1 - mr)),
        (p("mom", 1) * p("dad", 0) + p("mom", 0) * p("dad", 1)) * p("kid", 1) * f * F.pow(q, F.lit(3)) * quiet,
        p("mom", 0) * p("dad", 0) * p("kid", 0) * F.pow(q, F.lit(4)) * quiet,
    )
    on_x = posterior(p("mom", 0) * p("kid", 2) * q * q * mr, p("mom", 1) * p("kid", 2) * f * q * (1 - mr), p("mom", 0) * p("kid", 0) * q * q * (1 - mr))
    single = lambda m, rate: posterior(p(m, 0) * p("kid", 2) * q * rate, p(m, 2) * p("kid", 2) * f * (1 - rate), p(m, 0) * p("kid", 0) * q * (1 - rate))
    rows = computed(rows, **{
        "p_de_novo": F.when(c("state") == "auto", auto).when(c("state") == "x", on_x).when(c("state") == "y", single("dad", fr)).otherwise(single("mom", tr)),
        "child_ab": ab("kid"),
        "dp_ratio": F.when(c("state") == "x", gt.ratio(dp("kid"), dp("mom"))).when(c("state") == "y", gt.ratio(dp("kid"), 2 * dp("dad"))).when(c("state") == "mt", gt.ratio(dp("kid"), 2 * dp("mom")))
        .when(x & c("is_female"), gt.ratio(dp("kid"), dp("mom") + dp("dad")) * 0.75).otherwise(gt.ratio(dp("kid"), dp("mom") + dp("dad"))),
    })
    clean = lambda m: (reads(m) > 0) & (ab(m) <= cfg.max_parent_ab)
    parents = F.when(c("state") == "auto", clean("mom") & clean("dad")).when(c("state") == "y", clean("dad")).otherwise(clean("mom"))
    good = (c("kid.GQ") >= cfg.min_gq) & (c("dp_ratio") >= cfg.min_dp_ratio) & (c("child_ab") >= cfg.min_child_ab) & parents & (c("p_de_novo") >= cfg.min_p)
    pd, cab, n = c("p_de_novo"), c("child_ab"), c("alts")
    snv = F.when(((pd > 0.99) & (cab > 0.3) & ((c("dp_ratio") > 0.2) | (n == 1))) | ((pd > 0.5) & (cab > 0.3) & (n < 10) & (dp("kid") > 10)), "HIGH").when((pd > 0.5) & ((cab > 0.3) | (n == 1)), "MEDIUM").when(cab > 0.2, "LOW")
    indel = F.when((pd > 0.99) & (cab > 0.3) & (n == 1), "HIGH").when((pd > 0.5) & (cab > 0.3) & (n <= 5), "MEDIUM").when(cab > 0.2, "LOW")
    out = rows.where(good).withColumn("confidence", F.when(variant.is_snp(), snv).otherwise(indel)).where("confidence is not null")
    return out.drop("pp_kid", "pp_dad", "pp_mom", "state", "alts", "child_ab")


def denovo_by_gt(trios: DataFrame, af: float | None = None) -> DataFrame:
    """Trio rows with a het child and hom-ref parents; af: at sites of cohort AF up to it (column AF)."""
    out = trios.where((calls("kid") == 1) & (calls("dad") == 0) & (calls("mom") == 0))
    return out if af is None else out.where(F.col("AF") <= af)


def flatten_trio(trios: DataFrame) -> DataFrame:
    """The flat de novo table: VarKey, ID, TYPE, LEN, SAMPLE, and the metrics of each member with its suffix."""
    out = trios.withColumns({"ID": variant.variant_id(), "TYPE": variant.variant_type(), "LEN": variant.length_change(), "SAMPLE": F.col("proband"), "VarKey": variant.varkey("proband")})
    cols = []
    for m, suffix in (("kid", "sample"), ("dad", "father"), ("mom", "mother")):
        reads = F.get(F.col(f"{m}.AD"), F.lit(0)) + F.get(F.col(f"{m}.AD"), F.lit(1))
        alt = F.get(F.col(f"{m}.AD"), F.lit(1))
        cols += [F.concat_ws("/", F.col(f"{m}.a1").cast("string"), F.col(f"{m}.a2").cast("string")).alias(f"GT_{suffix}"), F.col(f"{m}.AD").alias(f"AD_{suffix}"), F.col(f"{m}.DP").alias(f"DP_{suffix}"), F.col(f"{m}.GQ").alias(f"GQ_{suffix}"), F.col(f"{m}.PL").alias(f"PL_{suffix}"), reads.alias(f"DPC_{suffix}"), gt.ratio(alt, reads).alias(f"AB_{suffix}"), gt.ratio(alt, F.col(f"{m}.DP")).alias(f"VAF_{suffix}")]
    return out.select(*[c for c in out.columns if c not in ("kid", "dad", "mom")], *cols)


@dataclass(frozen=True)
class MetricConfig:
    polyx: int = 10
    ac: int = 3
    af: float = 0.005
    gnomad_af: float = 0.01
    parent_gq: int = 40
    parent_ab: float = 0.1
    parent_dpc: int = 10
    vqslod_snv: float = -2.5
    vqslod_indel: float = -2.5


def denovo_metric_filter(flat: DataFrame, cfg: MetricConfig = MetricConfig()) -> DataFrame:  # noqa: B008
    """Flat de novo rows with a sound context: POLYX up to its limit (missing passes), rare by AC or AF, a child call that is certain
    (PL of het 0), gnomad_af up to its limit (missing is 0), and the worse of the parents within limits."""
    worst = lambda f, c: f(f"{c}_father", f"{c}_mother")
    return flat.where(
        F.coalesce(F.col("POLYX") <= cfg.polyx, F.lit(True)) & ((F.col("AC") <= cfg.ac) | (F.col("AF") <= cfg.af)) & (F.get("PL_sample", F.lit(1)) == 0) & (F.coalesce("gnomad_af", F.lit(0.0)) <= cfg.gnomad_af)
        & (worst(F.least, "GQ") >= cfg.parent_gq) & (worst(F.greatest, "AB") <= cfg.parent_ab) & (worst(F.least, "DPC") >= cfg.parent_dpc)
    )


def final_denovo_filter(calls_: DataFrame, cohort_af: float = 0.001, gnomad_af: float = 0.001, least_alt: int = 6, vqslod_snv: float = -2.5, vqslod_indel: float = -1.5) -> DataFrame:
    """De novo calls kept at the end: not LOW, VQSLOD over the limit of the type, rare in cohort and population (missing VQSLOD and
    population values pass), enough alternate reads in the child."""
    limit = F.when(variant.is_snp(), vqslod_snv).otherwise(vqslod_indel)
    return calls_.where((F.col("confidence") != "LOW") & (F.col("vqslod").isNull() | (F.col("vqslod") > limit)) & (F.col("AF") <= cohort_af) & (F.col("gnomad_af").isNull() | (F.col("gnomad_af") <= gnomad_af)) & (F.get(F.col("kid.AD"), F.lit(1)) >= least_alt))


def ultra_rare_inherited(trios: DataFrame, ac: int = 3, gq: int = 30, parents_only: bool = False) -> DataFrame:
    """Trio rows at rare sites where exactly one het parent passed the allele on (t = 1, u = 0) or, with parents_only, kept it
    (t = 0, u = 1), summed over the site; all three calls of enough GQ."""
    from pyspark.sql import Window

    t, u = transmissions(calls("kid"), calls("dad"), calls("mom"), copy_state())
    site = Window.partitionBy(*gt.KEY)
    rows = trios.where(F.col("AC") <= ac).withColumns({"t": t, "u": u}).withColumns({"site_t": F.sum("t").over(site), "site_u": F.sum("u").over(site)})
    want = (F.col("site_t") == (0 if parents_only else 1)) & (F.col("site_u") == (1 if parents_only else 0))
    own = (calls("kid") == (0 if parents_only else 1)) & ((calls("dad") == 1) | (calls("mom") == 1))
    return rows.where(want & own & (F.least(F.col("kid.GQ"), F.col("dad.GQ"), F.col("mom.GQ")) >= gq)).drop("site_t", "site_u")


def denovo_rates(flat: DataFrame, ped: DataFrame, flags: list[str]) -> DataFrame:
    """Calls of each TYPE and flag over the number of complete trios: one row a class."""
    from .pedigree import trio_list

    trios = trio_list(ped).agg(F.count("*").alias("n_trios"))
    classes = F.array(F.struct(F.lit("all").alias("class"), F.lit(True).alias("on")), F.struct(F.col("TYPE").alias("class"), F.lit(True).alias("on")), *[F.struct(F.lit(f).alias("class"), F.col(f).alias("on")) for f in flags])
    n = flat.select(F.inline(classes)).where("on").groupBy("class").agg(F.count("*").alias("n"))
    return n.crossJoin(F.broadcast(trios)).withColumn("rate", gt.ratio(F.col("n"), F.col("n_trios")))
