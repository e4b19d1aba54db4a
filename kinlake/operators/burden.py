"""Gene burden, C-alpha and gene-set enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import genotype as gt
from ..functions import stats


def c_alpha(variants: DataFrame, groups: list[str], singletons: str = "keep") -> DataFrame:
    """C-alpha by group: T = sum over genes of (y - p0 n)^2 - n p0 (1 - p0), its variance by the binomial law, and the asymptotic p.

    variants: groups, gene, pheno (1 case, 0 control), one row an allele. singletons: keep; group (genes of one allele as one gene); drop.
    """
    genes = variants.groupBy(*groups, "gene").agg(F.sum("pheno").alias("y"), F.count("*").alias("n"))
    if singletons == "group":
        genes = genes.withColumn("gene", F.when(F.col("n") == 1, "SINGLETONS").otherwise(F.col("gene"))).groupBy(*groups, "gene").agg(F.sum("y").alias("y"), F.sum("n").alias("n"))
    elif singletons == "drop":
        genes = genes.where("n > 1")
    p0 = genes.groupBy(*groups).agg((F.sum("y") / F.sum("n")).alias("p0"))
    rows = genes.join(p0, groups)
    n, p = F.col("n"), F.col("p0")
    mean = n * p * (1 - p)
    chance = lambda u: F.exp(stats.log_choose(n, u) + u * F.log(p) + (n - u) * F.log(1 - p))
    spread = F.aggregate(F.sequence(F.lit(0).cast("long"), n), F.lit(0.0), lambda a, u: a + F.pow(F.pow(u - n * p, F.lit(2)) - mean, F.lit(2)) * chance(u))
    out = rows.groupBy(*groups).agg(F.sum(F.pow(F.col("y") - n * p, F.lit(2)) - mean).alias("t"), F.sum(F.when((p > 0) & (p < 1), spread).otherwise(0.0)).alias("v"), F.sum("y").alias("case_alleles"), F.sum("n").alias("alleles"), F.count("*").alias("n_genes"))
    return out.withColumn("p_value", F.when(F.col("v") == 0, 1.0).otherwise(stats.chi2_upper_1df(F.col("t") * F.col("t") / F.col("v"))))


#: Permutations of the C-alpha test, and how many a row of the job draws.
PERMUTATIONS, BLOCK = 10_000, 50


def c_alpha_permutations(variants: DataFrame, permutations: int = PERMUTATIONS, seed: int = 1) -> DataFrame:
    """T of the data and the share of permutations whose T^2 is larger. variants: gene, pheno, one row an allele.

    T needs no more of a permutation than each gene's cases. Dealing all cases anew to alleles makes these a multivariate
    hypergeometric draw over the genes' sizes, so alleles meet as counts by gene, and tasks draw blocks of permutations from
    the list of sizes. numpy draws from up to 1e9 alleles and raises beyond.
    """
    import numpy as np
    import pandas as pd

    def draw(batches):
        for batch in batches:
            for block, first, last, sizes, cases in batch.itertuples(index=False, name=None):
                n, y = np.asarray(sizes, np.int64), np.asarray(cases, np.int64)
                if not len(n):
                    continue
                p = y.sum() / n.sum()
                # sums of whole numbers, so that equal draws have equal T
                t_of = lambda y: (y * y).sum(axis=-1) - 2 * p * (y * n).sum(axis=-1) + p * p * (n * n).sum() - n.sum() * p * (1 - p)  # noqa: E731, B023
                own = float(t_of(y))
                rng = np.random.default_rng([seed, block])
                t = np.array([t_of(rng.multivariate_hypergeometric(n, int(y.sum()), method="marginals")) for _ in range(first, last)])
                yield pd.DataFrame({"t": [own], "larger": [int((t * t > own * own * (1 + 1e-12) + 1e-12).sum())], "drawn": [len(t)]})

    genes = variants.groupBy("gene").agg(F.coalesce(F.sum("pheno"), F.lit(0)).cast("long").alias("y"), F.count("*").alias("n"))
    counts = genes.agg(F.array_sort(F.collect_list(F.struct("n", "y"))).alias("genes"))
    blocks = variants.sparkSession.range(-(-permutations // BLOCK)).select(F.col("id").alias("block"), (F.col("id") * BLOCK).alias("first"), F.least((F.col("id") + 1) * BLOCK, F.lit(permutations)).alias("last"))
    rows = blocks.crossJoin(F.broadcast(counts)).select("block", "first", "last", F.col("genes.n").alias("sizes"), F.col("genes.y").alias("cases"))
    return rows.mapInPandas(draw, "t double, larger long, drawn long").agg(F.max("t").alias("t"), (F.sum("larger") / F.sum("drawn")).alias("p_value"))


def burden_classes(calls: DataFrame, phenotypes: dict[str, tuple[list[int], list[int]]], mpc: float = 2.0) -> DataFrame:
    """C-alpha of each comparison (name: case groups, control groups) and class (SYN, PTV, MIS2, DMG), in one job."""
    classes = {"SYN": F.col("isSYN"), "PTV": F.col("isPTV"), "MIS2": F.col("isMIS") & (F.col("MPC") >= mpc), "DMG": F.col("isPTV") | (F.col("isMIS") & (F.col("MPC") >= mpc))}
    sets = F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in classes.items()]), lambda x: x.isNotNull())
    rows = calls.withColumn("class", F.explode(sets))
    sides = F.filter(F.array(*[F.when(F.col("group").isin(*a, *b), F.struct(F.lit(k).alias("comparison"), F.col("group").isin(*a).cast("int").alias("pheno"))) for k, (a, b) in phenotypes.items()]), lambda x: x.isNotNull())
    return c_alpha(rows.select("class", "gene", F.inline(sides)), ["comparison", "class"])


def balance_groups(df: DataFrame, group: str, key: str, seed: int = 1) -> DataFrame:
    """Every group cut to the size of the least one, by rank of a seeded md5 of the key.

    Ranks are made within the 4096 first digits of the hash, and the sizes of those parts carried over, so no task ranks a group. Rows
    of a null group or key go."""
    rows = df.where(F.col(group).isNotNull() & F.col(key).isNotNull()).withColumn("__h", F.md5(F.concat(F.lit(str(seed)), F.col(key)))).withColumn("__part", F.substring("__h", 1, 3))
    sizes = rows.groupBy(group, "__part").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    least = sizes.groupBy(group).agg(F.sum("__n").alias("__all")).agg(F.min("__all").alias("__least"))
    carry = sizes.select(group, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy(group, "__part").orderBy("__h", key))
    ranked = rows.withColumn("__own", own).join(carry, [group, "__part"]).crossJoin(F.broadcast(least))
    return ranked.where(F.col("__before") + F.col("__own") <= F.col("__least")).select(*df.columns)


def phenotype_gene_counts(calls: DataFrame, classes: list[str]) -> DataFrame:
    """By gene: carried calls of each class and phenotype (columns class_phenotype; none is 0). calls: genes (comma-joined), phenotype,
    varkey and the class flags."""
    rows = calls.withColumn("gene", F.explode(F.array_distinct(F.split("genes", ",")))).where("gene <> ''")
    long = rows.select("gene", "phenotype", "varkey", F.explode(F.filter(F.array(*[F.when(F.col(c), F.lit(c)) for c in classes]), lambda x: x.isNotNull())).alias("class")).distinct()
    return long.groupBy("gene", "class", "phenotype").agg(F.count("*").alias("n"))


def gene_set_enrichment(genes: DataFrame, terms: DataFrame) -> DataFrame:
    """One-sided enrichment of a gene list in every term of its ontology: hits, expected, p (hypergeometric) and p times the number of
    terms. terms: ontology, term, gene. The genes that an ontology's terms hold are its background; terms without a hit have p 1."""
    pairs = terms.select("ontology", "term", "gene").distinct()
    back = pairs.groupBy("ontology").agg(F.countDistinct("gene").alias("all_genes"), F.countDistinct("term").alias("n_terms"))
    listed = genes.select("gene").distinct().withColumn("hit", F.lit(1))
    drawn = pairs.select("ontology", "gene").distinct().join(listed, "gene").groupBy("ontology").agg(F.count("*").alias("drawn"))
    out = pairs.join(listed, "gene", "left").groupBy("ontology", "term").agg(F.count("*").alias("size"), F.count("hit").alias("hits")).join(back, "ontology").join(drawn, "ontology", "left").fillna({"drawn": 0})
    p = stats.hypergeometric_tail(F.col("hits"), F.col("size"), F.col("all_genes") - F.col("size"), F.col("drawn"))
    out = out.withColumn("p", F.when(F.col("hits") == 0, 1.0).otherwise(p))
    return out.withColumns({"expected": F.col("drawn") * F.col("size") / F.col("all_genes"), "p_bonferroni": F.least(F.lit(1.0), F.col("p") * F.col("n_terms"))})


def carrier_comparison(carriers: DataFrame, totals: DataFrame, terms: DataFrame) -> DataFrame:
    """By term: carriers among cases and controls, sample odds ratio and Fisher's two-sided p. carriers: s, group (case or control), gene;
    totals: one row of cases, controls."""
    hit = carriers.join(terms.select("term", "gene").distinct(), "gene").select("term", "s", "group").distinct()
    n = lambda g: F.sum(F.when(F.col("group") == g, 1).otherwise(0))
    out = hit.groupBy("term").agg(n("case").alias("a"), n("control").alias("c")).crossJoin(F.broadcast(totals))
    out = out.withColumns({"b": F.col("cases") - F.col("a"), "d": F.col("controls") - F.col("c")})
    out = out.withColumns({"odds_ratio": gt.ratio(F.col("a") * F.col("d"), F.col("b") * F.col("c")), "p": stats.fisher_two_sided(F.col("a"), F.col("b"), F.col("c"), F.col("d"))})
    tests = out.agg(F.count("*").alias("tests"))
    return out.crossJoin(F.broadcast(tests)).withColumn("p_bonferroni", F.least(F.lit(1.0), F.col("p") * F.col("tests"))).drop("tests")
