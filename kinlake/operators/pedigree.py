"""Pedigree tables: family_id, sample_id, paternal_id, maternal_id, sex (1 male, 2 female), phenotype (2 affected)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COLUMNS = ["family_id", "sample_id", "paternal_id", "maternal_id", "sex", "phenotype"]


def trio_list(ped: DataFrame) -> DataFrame:
    """Complete trios: fam_id, proband, father, mother, is_female."""
    have = ped.select(F.col("sample_id").alias("__id"))
    kids = ped.where(F.col("paternal_id").isNotNull() & F.col("maternal_id").isNotNull())
    kids = kids.join(have.withColumnRenamed("__id", "__f"), F.col("paternal_id") == F.col("__f"), "left_semi").join(have.withColumnRenamed("__id", "__m"), F.col("maternal_id") == F.col("__m"), "left_semi")
    return kids.select(F.col("family_id").alias("fam_id"), F.col("sample_id").alias("proband"), F.col("paternal_id").alias("father"), F.col("maternal_id").alias("mother"), (F.col("sex") == 2).alias("is_female"))


def trio_members(trios: DataFrame) -> DataFrame:
    """One row a member: s, role (kid, dad, mom) and the trio's columns."""
    role = lambda c, r: F.struct(F.col(c).alias("s"), F.lit(r).alias("role"))
    return trios.select(*trios.columns, F.inline(F.array(role("proband", "kid"), role("father", "dad"), role("mother", "mom"))))


def sample_list(ped: DataFrame) -> DataFrame:
    return trio_members(trio_list(ped)).select("fam_id", "s", "role").distinct()


def trio_ped_of(ped: DataFrame, sample: str) -> DataFrame:
    """The rows of a sample and its parents."""
    own = ped.where(F.col("sample_id") == sample)
    ids = own.select(F.explode(F.array("sample_id", "paternal_id", "maternal_id")).alias("sample_id")).where("sample_id is not null")
    return ped.join(ids, "sample_id", "left_semi")


def trio_families(ped: DataFrame) -> DataFrame:
    """Families with their size and whether they are one trio of three members."""
    kids = F.sum((F.col("paternal_id").isNotNull() & F.col("maternal_id").isNotNull()).cast("int"))
    return ped.groupBy("family_id").agg(F.count("*").alias("n_members"), kids.alias("n_children")).withColumn("is_trio", (F.col("n_members") == 3) & (F.col("n_children") == 1))


def split_families(ped: DataFrame) -> DataFrame:
    """Families of over three members become one trio a child, named family_1, family_2, ...; parents who are absent
    are null, and only complete trios stay."""
    size = ped.groupBy("family_id").agg(F.count("*").alias("n"))
    kids = trio_list(ped).join(size, F.col("fam_id") == F.col("family_id"))
    number = F.row_number().over(Window.partitionBy("fam_id").orderBy("proband"))
    kids = kids.withColumn("k", number).withColumn("trio_id", F.when(F.col("n") > 3, F.concat_ws("_", "fam_id", F.col("k").cast("string"))).otherwise(F.col("fam_id")))
    rows = trio_members(kids.select("trio_id", "proband", "father", "mother"))
    people = ped.select(F.col("sample_id").alias("s"), "sex", "phenotype")
    child = F.col("role") == "kid"
    return rows.join(people, "s").select(F.col("trio_id").alias("family_id"), F.col("s").alias("sample_id"), F.when(child, F.col("father")).alias("paternal_id"), F.when(child, F.col("mother")).alias("maternal_id"), "sex", "phenotype")


def sample_roles(ped: DataFrame) -> DataFrame:
    """role: Proband (both parents named), Father or Mother (named by a child), Singleton (alone in the family), Unknown."""
    family = Window.partitionBy("family_id")
    fathers = ped.select(F.col("paternal_id").alias("sample_id"), F.lit(True).alias("__father")).where("sample_id is not null").distinct()
    mothers = ped.select(F.col("maternal_id").alias("sample_id"), F.lit(True).alias("__mother")).where("sample_id is not null").distinct()
    out = ped.withColumn("__n", F.count("*").over(family)).join(fathers, "sample_id", "left").join(mothers, "sample_id", "left")
    role = F.when(F.col("__n") == 1, "Singleton").when(F.col("paternal_id").isNotNull() & F.col("maternal_id").isNotNull(), "Proband").when(F.col("__father"), "Father").when(F.col("__mother"), "Mother").otherwise("Unknown")
    return out.withColumn("role", role).select(*COLUMNS, "role")


def valid_trios(ped: DataFrame) -> DataFrame:
    """Rows of families with a proband, a father of sex 1 and a mother of sex 2."""
    roles = sample_roles(ped)
    has = lambda role, sex=None: F.max(((F.col("role") == role) & (F.lit(True) if sex is None else F.col("sex") == sex)).cast("int")) == 1
    good = roles.groupBy("family_id").agg((has("Proband") & has("Father", 1) & has("Mother", 2)).alias("ok")).where("ok")
    return ped.join(good, "family_id", "left_semi")


def compare_peds(ped: DataFrame, inferred: DataFrame) -> DataFrame:
    """One row for each field on which two pedigrees differ, null written as -9."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-9"))
    other = inferred.select("sample_id", *[F.col(c).alias(f"__{c}") for c in COLUMNS[2:]])
    rows = ped.join(other, "sample_id").select("sample_id", F.inline(F.array(*[F.struct(F.lit(c).alias("field"), text(c).alias("given"), text(f"__{c}").alias("inferred")) for c in COLUMNS[2:]])))
    return rows.where("given <> inferred")


def correct_ped(ped: DataFrame, inferred: DataFrame) -> DataFrame:
    """Rows of ped whose fields all agree with the inferred pedigree (or that it doesn't hold)."""
    return ped.join(compare_peds(ped, inferred).select("sample_id").distinct(), "sample_id", "left_anti")


def corrected_ped(ped: DataFrame, inferred: DataFrame) -> DataFrame:
    """Inferred rows of ped's samples, corrected where they differ from ped in any field (family included): if one inferred parent is missing
    and the other is a sample of the inferred pedigree, then that parent goes too where the sample is its own parent's parent, else the
    sample goes. Other rows stay as inferred. Rules look at the inferred pedigree as given, so the order of rows doesn't matter."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-9"))
    given = ped.select("sample_id", *[text(c).alias(f"__{c}") for c in COLUMNS if c != "sample_id"])
    own = inferred.select(*COLUMNS)
    rows = own.join(given, "sample_id")
    differs = F.lit(False)
    for c in COLUMNS:
        differs = differs | (F.lit(False) if c == "sample_id" else text(c) != F.col(f"__{c}"))
    one = F.col("paternal_id").isNull() != F.col("maternal_id").isNull()
    rows = rows.select(*COLUMNS, F.when(differs & one, F.coalesce("paternal_id", "maternal_id")).alias("__other"))
    known = own.select(F.col("sample_id").alias("__other"), F.array("paternal_id", "maternal_id").alias("__grand"))
    rows = rows.join(known, "__other", "left")
    circular = F.coalesce(F.array_contains(F.array_compact("__grand"), F.col("sample_id")), F.lit(False))
    parent = lambda c: F.when(~circular, F.col(c)).alias(c)
    return rows.where(F.col("__grand").isNull() | circular).select("family_id", "sample_id", parent("paternal_id"), parent("maternal_id"), "sex", "phenotype")


def merge_peds(peds: dict[str, DataFrame]) -> DataFrame:
    """Pedigrees under one another, families and samples prefixed by cohort."""
    out = None
    for cohort, ped in peds.items():
        name = lambda c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{cohort}:"), F.col(c))).alias(c)  # noqa: E731, B023
        part = ped.select(*[name(c) for c in COLUMNS[:4]], "sex", "phenotype", F.lit(cohort).alias("cohort"))
        out = part if out is None else out.unionByName(part)
    return out


def pedigree_pairs(ped: DataFrame) -> DataFrame:
    """Every pair within a family (i < j) with its expected relationship; the two parents of a child are left out."""
    a = ped.select("family_id", *[F.col(c).alias(f"i_{c}") for c in ("sample_id", "paternal_id", "maternal_id")])
    b = ped.select("family_id", *[F.col(c).alias(f"j_{c}") for c in ("sample_id", "paternal_id", "maternal_id")])
    both = a.join(b, "family_id").where("i_sample_id < j_sample_id")
    off = lambda c, p: F.coalesce((F.col(f"{c}_paternal_id") == F.col(f"{p}_sample_id")) | (F.col(f"{c}_maternal_id") == F.col(f"{p}_sample_id")), F.lit(False))
    same = F.coalesce((F.col("i_paternal_id") == F.col("j_paternal_id")) & (F.col("i_maternal_id") == F.col("j_maternal_id")), F.lit(False))
    couples = ped.where("paternal_id is not null and maternal_id is not null").select(F.least("paternal_id", "maternal_id").alias("i_sample_id"), F.greatest("paternal_id", "maternal_id").alias("j_sample_id")).distinct()
    both = both.join(couples, ["i_sample_id", "j_sample_id"], "left_anti")
    return both.select("family_id", F.col("i_sample_id").alias("i"), F.col("j_sample_id").alias("j"), F.when(off("i", "j") | off("j", "i"), "parent-child").when(same, "siblings").otherwise("related_other").alias("expected"))


def pad_ped(ped: DataFrame, samples: DataFrame) -> DataFrame:
    """ped with the samples (s) that it lacks, as family -9 without parents, sex and phenotype -9."""
    absent = samples.select(F.col("s").alias("sample_id")).distinct().join(ped, "sample_id", "left_anti")
    text = lambda v, c: F.lit(v).cast(ped.schema[c].dataType).alias(c)
    return ped.select(*COLUMNS).unionByName(absent.select(F.lit("-9").alias("family_id"), "sample_id", text(None, "paternal_id"), text(None, "maternal_id"), text(-9, "sex"), text(-9, "phenotype")))


def rename_samples(df: DataFrame, names: DataFrame, column: str = "s") -> DataFrame:
    """Samples renamed by a map (old, new); those not in it stay."""
    return df.join(names.select(F.col("old").alias(column), F.col("new").alias("__new")), column, "left").withColumn(column, F.coalesce("__new", column)).drop("__new").select(*df.columns)


def batches_for_families(families: DataFrame, ped: DataFrame, sample_map: DataFrame, files: DataFrame) -> DataFrame:
    """File rows of the batches that hold a sample of the families."""
    samples = ped.join(families, "family_id", "left_semi").select(F.col("sample_id").alias("s"))
    return files.join(sample_map.join(samples, "s", "left_semi").select("batch").distinct(), "batch", "left_semi")


def manifest_tables(samples: DataFrame, callers: list[str]) -> dict[str, DataFrame]:
    """A wide manifest (s, batch, coverage_file, a column a caller) as sample_batch, batch_coverage and batch_files tables."""
    return {
        "sample_batch": samples.select("s", "batch").distinct(),
        "batch_coverage": samples.select("batch", "coverage_file").where("coverage_file is not null").distinct(),
        "batch_files": samples.unpivot(["batch"], callers, "caller", "file").where("file is not null").distinct(),
    }


def is_affected() -> Column:
    return F.col("phenotype") == 2
