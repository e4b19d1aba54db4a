"""Reviewers' verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def review_consensus(responses: DataFrame, tiebreaks: DataFrame | None = None) -> DataFrame:
    """By path: verdicts joined in order of the reviewers, their number, and the consensus: yes if all say so, no_unsure if none does, ''
    if they differ; a tiebreaker's verdict (path, verdict) overrides. Of a reviewer with several responses the least by text counts."""
    one = responses.groupBy("path", "analyst").agg(F.min("verdict").alias("verdict"))
    rows = one.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("analyst", "verdict"))).alias("r"))
    yes = F.col("r.verdict")
    out = rows.select("path", F.array_join(yes, ",").alias("verdicts"), F.size("r").alias("n_reviewers"), F.when(F.forall(yes, lambda v: v == "yes"), "yes").when(F.forall(yes, lambda v: v != "yes"), "no_unsure").otherwise("").alias("consensus"))
    if tiebreaks is None:
        return out
    last = tiebreaks.groupBy("path").agg(F.min("verdict").alias("tie"))
    verdict = F.when(F.col("tie") == "yes", "yes").when(F.col("tie").isNotNull(), "no_unsure").otherwise(F.col("consensus"))
    return out.join(last, "path", "left").withColumn("consensus", verdict).drop("tie")


def review_wide(responses: DataFrame, analysts: list[str]) -> DataFrame:
    """By path: one column a named analyst."""
    return responses.groupBy("path").pivot("analyst", analysts).agg(F.min("verdict"))


def sample_error_flags(calls: DataFrame, parental: DataFrame, sex: DataFrame, sample: str = "s") -> DataFrame:
    """Calls with flags for samples that failed the parental or the sex check."""
    mark = lambda t, n: t.select(F.col("s").alias(sample)).distinct().withColumn(n, F.lit(True))
    out = calls.join(mark(parental, "parental_error"), sample, "left").join(mark(sex, "sex_error"), sample, "left").fillna({"parental_error": False, "sex_error": False})
    return out.withColumn("any_error", F.col("parental_error") | F.col("sex_error"))


def coalesce_gene_names(df: DataFrame, by_id: DataFrame, symbols: DataFrame) -> DataFrame:
    """gene_name: the symbol of the Ensembl id, else the given symbol if it is current, else the current symbol of a previous one, else as
    given. by_id: gene_id, symbol; symbols: symbol, previous (array)."""
    ids = by_id.groupBy("gene_id").agg(F.min("symbol").alias("by_id"))
    now = symbols.select(F.col("symbol").alias("SYMBOL"), F.col("symbol").alias("current")).distinct()
    old = symbols.select(F.explode("previous").alias("old"), F.col("symbol").alias("new")).groupBy(F.col("old").alias("SYMBOL")).agg(F.min("new").alias("renamed"))
    out = df.join(ids, "gene_id", "left").join(now, "SYMBOL", "left").join(old, "SYMBOL", "left")
    return out.withColumn("gene_name", F.coalesce("by_id", "current", "renamed", "SYMBOL")).drop("by_id", "current", "renamed")
