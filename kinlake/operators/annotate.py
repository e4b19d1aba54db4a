"""Annotation joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import genotype as gt


def annotate_by(df: DataFrame, table: DataFrame, keys: list[str], columns: list[str], tie: list[str] | None = None) -> DataFrame:
    """Left join to one row a key of the table: the first by `tie` (all its columns if not given), so that a key repeated in
    the table repeats no row."""
    order = tie or [c for c in table.columns if c not in keys]
    one = table.groupBy(*keys).agg(F.min(F.struct(*dict.fromkeys([*order, *columns]))).alias("__one"))
    return df.join(one, keys, "left").select(*df.columns, *[F.col(f"__one.{c}").alias(c) for c in columns])


def annotate_by_variant(df: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    return annotate_by(df, table, gt.KEY, columns)


def semi_join_variants(df: DataFrame, other: DataFrame) -> DataFrame:
    return df.join(other.select(*gt.KEY), gt.KEY, "left_semi")


def anti_join_variants(df: DataFrame, other: DataFrame) -> DataFrame:
    return df.join(other.select(*gt.KEY), gt.KEY, "left_anti")


def annotate_csq_by(df: DataFrame, table: DataFrame, field: str, key: str, columns: list[str], column: str = "csq") -> DataFrame:
    """Transcripts (array of structs) with further fields looked up by one of theirs; their order stays."""
    ids = [c for c in df.columns if c != column]
    rows = df.select(*ids, F.posexplode_outer(column).alias("__place", "__t")).withColumn(key, F.col(f"__t.{field}"))
    found = annotate_by(rows, table, [key], columns)
    nested = found.groupBy(*ids).agg(F.array_sort(F.collect_list(F.when(F.col("__place").isNotNull(), F.struct("__place", "__t", *columns)))).alias("__r"))
    return nested.withColumn(column, F.transform("__r", lambda r: F.struct(r["__t"].alias("t"), *[r[c].alias(c) for c in columns]))).drop("__r")


def protein_variant(amino_acids: str = "Amino_acids", position: str = "Protein_position") -> Column:
    """A12V from 'A/V' and '12'; null for what is no single change."""
    return F.when(F.col(amino_acids).rlike("^[A-Z]/[A-Z]$") & F.col(position).rlike("^[0-9]+$"), F.concat(F.substring(amino_acids, 1, 1), F.col(position), F.substring(amino_acids, 3, 1)))


def min_gene_metric(df: DataFrame, genes: str, table: DataFrame, metric: str, ids: list[str]) -> DataFrame:
    """Rows with the least value of a gene metric over their array of genes (null where none is known)."""
    found = df.select(*ids, F.explode(F.array_distinct(genes)).alias("gene")).join(table.groupBy("gene").agg(F.min(metric).alias(metric)), "gene")
    return df.join(found.groupBy(*ids).agg(F.min(metric).alias(metric)), ids, "left")


def flag_member(df: DataFrame, other: DataFrame, key: str, flag: str) -> DataFrame:
    """A flag for rows whose key is in the other table."""
    return df.join(other.select(key).distinct().withColumn("__in", F.lit(True)), key, "left").withColumn(flag, F.coalesce("__in", F.lit(False))).drop("__in").select(*df.columns, flag)


def update_annotations(calls: DataFrame, new: DataFrame, columns: list[str], name: str = "name", coords: tuple[str, ...] = ("chrom", "start", "end", "svtype")) -> DataFrame:
    """Columns replaced by those of the same name, else by those of the same place and type; what neither has is kept."""
    by_name = new.groupBy(name).agg(*[F.min(c).alias(f"__n_{c}") for c in columns]).withColumn("__has", F.lit(True))
    by_place = new.groupBy(*coords).agg(*[F.min(c).alias(f"__c_{c}") for c in columns]).withColumn("__at", F.lit(True))
    out = calls.join(by_name, name, "left").join(by_place, list(coords), "left")
    pick = lambda c: F.when(F.col("__has"), F.col(f"__n_{c}")).when(F.col("__at"), F.col(f"__c_{c}")).otherwise(F.col(c)).alias(c)
    return out.select(*[pick(c) if c in columns else F.col(c) for c in calls.columns])


def attach_site_info(df: DataFrame, info: DataFrame, numbers: list[str]) -> DataFrame:
    """Site columns joined on the variant, numbers held to 32 bits."""
    return annotate_by_variant(df, info, numbers).withColumns({c: F.least(F.col(c), F.lit((1 << 31) - 1)) for c in numbers})


def union_cols(a: DataFrame, b: DataFrame) -> DataFrame:
    """Entries of two cohorts at the variants that both have."""
    shared = a.select(*gt.KEY).distinct().join(b.select(*gt.KEY).distinct(), gt.KEY)
    both = a.unionByName(b, allowMissingColumns=True)
    return both.join(shared, gt.KEY, "left_semi")


def merge_samples(tables: list[DataFrame]) -> DataFrame:
    """Entries of several call sets under one another; alleles stay as they are."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def densify(variants: DataFrame, blocks: DataFrame) -> DataFrame:
    """Calls at variant sites in long form: a sample's own call, else a hom-ref call with the GQ and DP of its reference block (pos to
    end) that reaches the site, of several the last to start. What has neither is missing, and a missing call has no row, so the
    result grows with calls and covered sites and not with sites times samples."""
    from .interval import pairs

    sites = variants.select(*gt.KEY).distinct().withColumns({"start": F.col("pos") - 1, "end": F.col("pos")})
    spans = blocks.select("contig", (F.col("pos") - 1).alias("start"), F.col("end"), "s", F.col("GQ").alias("gq"), F.col("DP").alias("dp"))
    held = pairs(sites, spans, ["contig"]).groupBy(*gt.KEY, F.col("b_s").alias("s")).agg(F.max(F.struct("b_start", "b_gq", "b_dp")).alias("b"))
    own = variants.select(*gt.KEY, "s", "a1", "a2", "GQ", "DP")
    from_block = held.join(own.select(*gt.KEY, "s"), [*gt.KEY, "s"], "left_anti").select(*gt.KEY, "s", F.lit(0).alias("a1"), F.lit(0).alias("a2"), F.col("b.b_gq").alias("GQ"), F.col("b.b_dp").alias("DP"))
    return own.unionByName(from_block)
