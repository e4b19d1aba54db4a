"""Readers and writers of the field's text formats, and of the native store."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import null_if_missing, parse_format, parse_info

_FIXED = ["contig", "pos", "id", "ref", "alt", "qual", "filter", "info"]


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path)


def vcf_samples(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Sample names from the header line."""
    head = _lines(spark, path).where(F.col("value").startswith("#CHROM")).select(F.split("value", "\t").alias("h")).first()
    return list(head["h"])[9:] if head else []


def read_vcf_sites(spark: SparkSession, path: str | list[str], find: str | None = None, replace: str = ".") -> DataFrame:
    """Sites, one row an alternate allele: contig, pos, id, ref, alt, allele (its number), alleles (all), qual, filter (array, empty for
    PASS), info (map). find, replace: a text put in place of another before parsing. Only the first eight fields are cut from a line."""
    value = F.col("value") if find is None else F.replace(F.col("value"), F.lit(find), F.lit(replace))
    part = F.split(value, "\t", 9)
    rows = _lines(spark, path).where(~F.col("value").startswith("#") & (F.col("value") != "")).select(*[F.get(part, F.lit(i)).alias(n) for i, n in enumerate(_FIXED)])
    rows = rows.withColumns({"pos": F.col("pos").cast("int"), "qual": F.col("qual").try_cast("double"), "filter": F.when(F.col("filter").isin("PASS", "."), F.array().cast("array<string>")).otherwise(F.split("filter", ";")), "info": parse_info(F.col("info")), "alleles": F.split("alt", ",")})
    return rows.select("contig", "pos", "id", "ref", F.posexplode("alleles").alias("k", "one"), "alleles", "qual", "filter", "info").select("contig", "pos", "id", "ref", F.col("one").alias("alt"), (F.col("k") + 1).alias("allele"), "alleles", "qual", "filter", "info")


def read_vcf_entries(spark: SparkSession, path: str | list[str], samples: list[str] | None = None) -> DataFrame:
    """Genotypes in long form: contig, pos, ref, alts (array), s, a1, a2, phased, AD, DP, GQ, PL. samples: only these are unpacked."""
    names = vcf_samples(spark, path)
    part = F.split("value", "\t")
    rows = _lines(spark, path).where(~F.col("value").startswith("#") & (F.col("value") != "")).select(part.alias("f"))
    get = lambda i: F.get("f", F.lit(i))
    wanted = F.array(*[F.struct(F.lit(n).alias("s"), F.get("f", F.lit(9 + i)).alias("v")) for i, n in enumerate(names) if samples is None or n in samples])
    rows = rows.select(get(0).alias("contig"), get(1).cast("int").alias("pos"), get(3).alias("ref"), F.split(get(4), ",").alias("alts"), get(8).alias("fmt"), F.inline(wanted))
    rows = rows.withColumn("m", parse_format(F.col("fmt"), F.col("v")))
    field = lambda k: F.element_at("m", k)
    call = field("GT")
    alleles = F.transform(F.split(call, "[/|]"), lambda a: a.try_cast("int"))
    ints = lambda k: F.when(field(k) != ".", F.transform(F.split(field(k), ","), lambda x: x.try_cast("int")))
    a1 = F.get(alleles, F.lit(0))
    return rows.select("contig", "pos", "ref", "alts", "s", a1.alias("a1"), F.coalesce(F.get(alleles, F.lit(1)), F.when(F.size(alleles) == 1, a1)).alias("a2"), call.contains("|").alias("phased"), ints("AD").alias("AD"), field("DP").try_cast("int").alias("DP"), field("GQ").try_cast("int").alias("GQ"), ints("PL").alias("PL"))


def read_bed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """contig, start, end, name; a header line, or any line without numbers, is passed over."""
    part = F.split("value", "\t")
    rows = _lines(spark, path).select(F.get(part, F.lit(0)).alias("contig"), F.get(part, F.lit(1)).try_cast("int").alias("start"), F.get(part, F.lit(2)).try_cast("int").alias("end"), F.get(part, F.lit(3)).alias("name"))
    return rows.where("start is not null and end is not null")


def read_ped(spark: SparkSession, path: str | list[str], samples: DataFrame | None = None) -> DataFrame:
    """The first six columns of a pedigree, header or not, missing parents as null, one row a sample (the first by its fields), restricted
    to samples (s) if given."""
    part = F.split(F.trim("value"), r"\s+")
    names = ["family_id", "sample_id", "paternal_id", "maternal_id", "sex", "phenotype"]
    rows = _lines(spark, path).where(~F.col("value").startswith("#") & (F.trim("value") != "")).select(*[F.get(part, F.lit(i)).alias(n) for i, n in enumerate(names)])
    rows = rows.where(~F.lower("sample_id").isin("sample_id", "individualid", "iid")).withColumns({"paternal_id": null_if_missing(F.col("paternal_id")), "maternal_id": null_if_missing(F.col("maternal_id")), "sex": F.col("sex").try_cast("int"), "phenotype": F.col("phenotype").try_cast("int")})
    one = rows.groupBy("sample_id").agg(F.min(F.struct(*[n for n in names if n != "sample_id"])).alias("r"))
    out = one.select("r.family_id", "sample_id", "r.paternal_id", "r.maternal_id", "r.sex", "r.phenotype")
    return out if samples is None else out.join(samples.select(F.col("s").alias("sample_id")).distinct(), "sample_id", "left_semi")


def read_tsvs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Tab-separated files with headers, united by column name; what a file lacks is null."""
    tables = [spark.read.csv(p, sep="\t", header=True) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def save_table(df: DataFrame, path: str, by: str | None = "contig") -> None:
    """Parquet, one folder a contig, so that readers prune."""
    writer = df.write.mode("error")
    (writer.partitionBy(by) if by else writer).parquet(path)


def load_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def merge_stores(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Stores under one another, by column name; what a store lacks is null. Partition folders stay prunable in each."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [load_table(spark, p) for p in paths])


def sites_vcf_lines(df: DataFrame) -> DataFrame:
    """Lines of a sites-only VCF body in coordinate order within partitions."""
    field = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(".")) if c in df.columns else F.lit(".")
    return df.sortWithinPartitions("contig", "pos").select(F.concat_ws("\t", "contig", F.col("pos").cast("string"), field("id"), "ref", "alt", field("qual"), field("filter"), F.lit(".")).alias("value"))


def write_sites_vcf(df: DataFrame, path: str) -> None:
    """A folder with the header as its first file and the body in further ones."""
    head = df.sparkSession.createDataFrame([("##fileformat=VCFv4.2",), ("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO",)], "value string").coalesce(1)
    head.write.mode("error").text(f"{path}/header")
    sites_vcf_lines(df).write.mode("error").text(f"{path}/body")


def write_sharded(df: DataFrame, path: str, shards: int | None = None, per_shard: int | None = None) -> None:
    """A number of files, or files of at most per_shard rows, each with the header."""
    writer = (df.repartition(shards) if shards else df).write.mode("error").option("header", True).option("sep", "\t")
    (writer.option("maxRecordsPerFile", per_shard) if per_shard else writer).csv(path)


def extract_fields(df: DataFrame, regions: DataFrame, columns: list[str]) -> DataFrame:
    """Columns of sites or entries inside the regions (contig, start, end)."""
    from ..operators.interval import points_in

    return points_in(df, regions).select(*columns)


def chosen_field(df: DataFrame, plain: str, allele_specific: str, allele: str = "allele") -> Column:
    """The allele's own value of an array field where that field is missing in fewer rows than the plain one, else the plain value."""
    nulls = df.agg(F.sum(F.col(plain).isNull().cast("int")).alias("p"), F.sum(F.col(allele_specific).isNull().cast("int")).alias("a")).first()
    own = F.get(allele_specific, F.col(allele) - 1)
    return F.coalesce(own, F.col(plain)) if (nulls["a"] or 0) < (nulls["p"] or 0) else F.col(plain)
