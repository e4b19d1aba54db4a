"""Consequence prioritisation and clinical filters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import csq as C
from ..functions import genotype as gt
from ..functions import locus
from ..functions.columns import computed
from .trio import calls, copy_state, mendel_code, phase_by_transmission, transmission


def prioritize_csq(df: DataFrame, column: str = "csq", loftee: bool = False) -> DataFrame:
    """Adds the worst transcript of each row (worst), the genes that tie at its score, the class flags of its terms, SII (its most severe
    term is of a class) and isCoding. Canonical transcripts alone are ranked where a row has any."""
    rows = computed(df, __ranked=C.ranked(F.col(column), loftee))
    first = F.get("__ranked", F.lit(0))
    terms = first["csq"]["Consequence"]
    every = [t for v in C.CLASSES.values() for t in v]
    tied = F.array_distinct(F.transform(F.filter("__ranked", lambda r: r["score"] == first["score"]), lambda r: r["symbol"]))
    flags = {k: F.arrays_overlap(terms, C.texts(v)) for k, v in C.CLASSES.items()}
    return rows.withColumns({"worst": first["csq"], "worst_score": first["score"], "most_severe": C.most_severe(terms), "worst_genes": tied, **flags, "SII": C.most_severe(terms).isin(*every), "isCoding": F.arrays_overlap(terms, C.texts(C.CODING))}).drop("__ranked")


def worst_per_gene(df: DataFrame, column: str = "csq") -> DataFrame:
    """One row for each gene of each row: its worst transcript's score and most severe term."""
    keep = [c for c in df.columns if c != column]
    rows = df.select(*keep, F.explode(C.ranked(F.col(column))).alias("r")).select(*keep, F.col("r.symbol").alias("SYMBOL"), F.struct("r.score", "r.place", F.col("r.csq.Consequence").alias("terms")).alias("r"))
    out = rows.groupBy(*keep, "SYMBOL").agg(F.min("r").alias("r"))
    return out.select(*keep, "SYMBOL", F.col("r.score").alias("score"), C.most_severe(F.col("r.terms")).alias("most_severe"))


def top_per_gene(df: DataFrame, score: str, sample: str = "SAMPLE", gene: str = "SYMBOL", tie: str = "VarKey") -> DataFrame:
    """Coding rows: the one of highest score for each sample and gene (ties by `tie`); others stay."""
    best = Window.partitionBy(sample, gene).orderBy(F.desc(score), tie)
    coding = df.where("isCoding").withColumn("__rank", F.row_number().over(best)).where("__rank = 1").drop("__rank")
    return coding.unionByName(df.where("not isCoding"))


def csq_filter(df: DataFrame, column: str = "csq", by_csq: bool = True, by_impact: bool = True) -> DataFrame:
    """One row for each transcript (column csq as a struct) that passes the clinical filter."""
    return df.withColumn(column, F.explode(F.filter(column, lambda t: C.transcript_kept(t, by_csq, by_impact))))


def popmax_af(columns: list[str]) -> Column:
    """The greatest readable value over columns that may be text or arrays of text (of an array the first that is not blank)."""
    return F.greatest(*[F.expr(f"try_cast({c} AS DOUBLE)") for c in columns], F.lit(None).cast("double"))


def first_filled(column: str) -> Column:
    return F.get(F.filter(column, lambda x: x.isNotNull() & ~F.trim(x).isin("", ".")), F.lit(0))


def popmax_filter(df: DataFrame, limit: float, column: str = "gnomad_popmax_af", keep_missing: bool = True) -> DataFrame:
    """Rows rare in every population. Small variants keep missing values, structural ones do not (keep_missing=False)."""
    rare = F.col(column) <= limit
    return df.where(rare | F.col(column).isNull() if keep_missing else rare)


def clinvar_filter(df: DataFrame, keep_pathogenic: bool = True, column: str = "CLNSIG") -> DataFrame:
    """keep_pathogenic: rows called pathogenic or likely so; else rows not called benign (missing ones stay)."""
    text = F.array_join(column, "|")
    return df.where(text.rlike("athogenic")) if keep_pathogenic else df.where(F.col(column).isNull() | ~text.rlike("enign"))


@dataclass(frozen=True)
class ClinicalConfig:
    recessive_af: float = 0.01
    dominant_af: float = 0.001
    mpc: float = 2.0
    am: float = 0.56
    loeuf_v2: float = 0.35
    loeuf_v4: float = 0.6


def _number(c: Column, blank: float) -> Column:
    """Blank text counts as `blank`; 'null' is blank."""
    text = F.regexp_replace(c, "null", "")
    return F.when(text == "", F.lit(blank)).otherwise(text.try_cast("double"))


def _damaging(t: str, cfg: ClinicalConfig) -> Column:
    return (F.col("MPC") >= cfg.mpc) | F.col("MPC").isNull() | (_number(F.col(f"{t}.am_pathogenicity"), 1.0) >= cfg.am)


def omim_recessive(df: DataFrame, cfg: ClinicalConfig = ClinicalConfig(), t: str = "csq") -> DataFrame:  # noqa: B008
    """Transcript rows of recessive genes (code 2), X-linked genes (code 4) on X, or genes without a code that are rare and damaging
    (a missing frequency or MPC passes, a blank AlphaMissense score counts as 1)."""
    code = F.col(f"{t}.OMIM_inheritance_code")
    rare = (F.col("gnomad_popmax_af") <= cfg.recessive_af) | F.col("gnomad_popmax_af").isNull()
    return df.where(code.contains("2") | (code.contains("4") & (locus.bare() == "X")) | ((code == "") & rare & _damaging(t, cfg)))


def omim_dominant(df: DataFrame, cfg: ClinicalConfig = ClinicalConfig(), t: str = "csq") -> DataFrame:  # noqa: B008
    """Rare transcript rows of dominant genes (code 1), or of genes without a code that are damaging and intolerant (a blank LOEUF
    counts as 0)."""
    code = F.col(f"{t}.OMIM_inheritance_code")
    rare = (F.col("gnomad_popmax_af") <= cfg.dominant_af) | F.col("gnomad_popmax_af").isNull()
    intolerant = (_number(F.col(f"{t}.LOEUF_v2"), 0.0) <= cfg.loeuf_v2) | (_number(F.col(f"{t}.LOEUF_v4"), 0.0) <= cfg.loeuf_v4)
    return df.where(rare & (code.contains("1") | ((code == "") & _damaging(t, cfg) & intolerant)))


def nest_csq(df: DataFrame, keys: list[str], columns: list[str], t: str = "csq", order: str = "place") -> DataFrame:
    """Transcript rows back to one row a variant: the transcripts in order, and their text."""
    out = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, t))).alias("r"))
    nested = out.withColumn(t, F.transform("r", lambda r: r[t])).drop("r")
    return nested.withColumn("CSQ", C.encode(F.col(t), columns))


def omim_output(kept: DataFrame, trios: DataFrame, category: str) -> DataFrame:
    """Trio rows of the kept transcripts' variants that a member carries, with the child's phased call (pbt_gt), Mendel code,
    transmission and variant_category: one row for each transcript and trio. A variant that no child among these rows is called at goes.

    kept: site and transcript columns, as omim_recessive and omim_dominant give them. trios: rows of trio_entries, partial ones too; an
    absent or missing parent carries nothing, and leaves the phase open where it is needed.
    """
    names = ["fam_id", "proband", "father", "mother", "is_female"]
    flat = trios.select(*gt.KEY, *names, *[calls(m).alias(f"{m}_n") for m in ("kid", "dad", "mom")], copy_state().alias("state"))
    kid, dad, mom, state = (F.col(x) for x in ("kid_n", "dad_n", "mom_n", "state"))
    rows = flat.where(F.greatest(*[F.coalesce(x, F.lit(0)) for x in (kid, dad, mom)]) > 0).join(kept.select(*gt.KEY).distinct(), gt.KEY, "left_semi")
    called = rows.groupBy(*gt.KEY).agg(F.count("kid_n").alias("__n")).where("__n > 0").select(*gt.KEY)
    rows = computed(rows.join(called, gt.KEY, "left_semi"), pbt_gt=phase_by_transmission(kid, dad, mom, state))
    rows = rows.withColumns({"mendel_code": mendel_code(kid, dad, mom, state), "transmission": transmission(F.col("pbt_gt"))}).drop("state")
    return rows.join(kept, gt.KEY).withColumn("variant_category", F.lit(category))


def comp_het_trio(trios: DataFrame) -> DataFrame:
    """Rows (with gene and pbt_gt) of trio probands that carry two differently phased calls in a gene, on autosomes and PAR."""
    rows = trios.where(locus.in_autosome_or_par() & (calls("kid") > 0) & F.col("pbt_gt").isNotNull())
    genes = rows.groupBy("gene", "proband").agg(F.countDistinct("pbt_gt").alias("n")).where("n > 1")
    return trios.where(locus.in_autosome_or_par() & (calls("kid") > 0)).join(genes.drop("n"), ["gene", "proband"], "left_semi")


def comp_het_other(entries: DataFrame) -> DataFrame:
    """Non-ref entries (with gene) of samples outside trios that carry two variants in a gene, on autosomes and PAR."""
    rows = entries.where(locus.in_autosome_or_par() & gt.is_non_ref())
    genes = rows.groupBy("gene", "s").agg(F.countDistinct(F.struct(*gt.KEY)).alias("n")).where("n > 1")
    return rows.join(genes.drop("n"), ["gene", "s"], "left_semi")


def _x_linked() -> Column:
    return (F.col("omim_code").contains("4") | (locus.bare() == "X")) & (calls("kid") > 0) & ~F.col("is_female")


def _hom_var() -> Column:
    return (calls("kid") == 2) & ~(locus.in_x_nonpar() & ~F.col("is_female"))


def x_linked_recessive(trios: DataFrame) -> DataFrame:
    """Non-ref calls of male probands in X-linked genes (OMIM code 4) or anywhere on X."""
    return trios.where(_x_linked())


def hom_var_proband(trios: DataFrame) -> DataFrame:
    """Hom-var calls of probands, without males on X outside PAR."""
    return trios.where(_hom_var())


def xlr_and_hom_var(trios: DataFrame) -> DataFrame:
    """The rows of both, with variant_category (XLR, hom_var): a call that is of both kinds has two. The trios are gone through once."""
    kinds = F.array(F.when(_x_linked(), "XLR"), F.when(_hom_var(), "hom_var"))
    return trios.select("*", F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("variant_category"))


def group_by_gene(trios: DataFrame) -> DataFrame:
    """By gene and trio: the variants and phased calls of the proband's non-ref calls, sorted by place. A gene's list holds what one
    proband carries in it."""
    rows = trios.where(calls("kid") > 0)
    return rows.groupBy("gene", "proband").agg(F.array_sort(F.collect_list(F.struct(*gt.KEY, "pbt_gt"))).alias("variants"), F.count("*").alias("n"))


def csq_counts(rows: DataFrame, misa: float = 1.0, misb: float = 2.0) -> DataFrame:
    """By gene and phenotype: carried PTV, MisB (MPC at least misb), MisA (at least misa) and synonymous variants. rows: SYMBOL,
    phenotype, MPC and the class flags of the worst consequence."""
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    m = F.col("MPC")
    return rows.groupBy("SYMBOL", "phenotype").agg(n(F.col("isPTV")).alias("PTV"), n(F.col("isMIS") & (m >= misb)).alias("MisB"), n(F.col("isMIS") & (m >= misa) & (m < misb)).alias("MisA"), n(F.col("isSYN")).alias("SYN"))
