"""Set operations, sampling, chunking and sorting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import genotype as gt
from ..functions.locus import contig_order


def union_distinct(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both; where a key is in both, a's row (of a key repeated in one table, the first by its fields)."""
    both = a.withColumn("__src", F.lit(0)).unionByName(b.withColumn("__src", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in keys and c != "__src"]
    one = both.groupBy(*keys).agg(F.min(F.struct("__src", *rest)).alias("__r"))
    return one.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])


def union_shared_samples(a: DataFrame, b: DataFrame, sample: str = "s") -> DataFrame:
    """Entries of two call sets on the samples that both have; columns that one lacks are null."""
    shared = a.select(sample).intersect(b.select(sample))
    return a.unionByName(b, allowMissingColumns=True).join(shared, sample, "left_semi")


def stack_call_sets(tables: dict[str, DataFrame], shared: list[str]) -> DataFrame:
    """Call sets under one another: shared columns by name, others prefixed by the set's name; data_type names the set."""
    parts = [t.select(*shared, *[F.col(c).alias(f"{n}_{c}") for c in t.columns if c not in shared], F.lit(n).alias("data_type")) for n, t in tables.items()]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def names_only_in(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).distinct().join(b.select(key), key, "left_anti")


def join_multiallelic(sites: DataFrame) -> DataFrame:
    """Biallelic rows at one place as one record: the longest reference, alternates extended to it, sorted; equal rows count once."""
    rows = sites.select(*gt.KEY).distinct()
    longest = rows.groupBy("contig", "pos").agg(F.max_by("ref", F.struct(F.length("ref"), "ref")).alias("long"))
    padded = rows.join(longest, ["contig", "pos"]).withColumn("alt", F.concat("alt", F.expr("substring(long, length(ref) + 1)")))
    return padded.groupBy("contig", "pos", F.col("long").alias("ref")).agg(F.array_sort(F.collect_set("alt")).alias("alts"))


def split_multiallelic(sites: DataFrame) -> DataFrame:
    """One row an alternate allele of alts, in one pass."""
    return sites.select(*[c for c in sites.columns if c != "alts"], F.posexplode("alts").alias("__k", "alt")).withColumn("allele", F.col("__k") + 1).drop("__k")


def sort_variants(df: DataFrame) -> DataFrame:
    """Coordinate order: autosomes, X, Y, mitochondrion, then other contigs by name."""
    return df.orderBy(F.coalesce(contig_order(), F.lit(99)), "contig", "pos", "ref", "alt")


def downsample(df: DataFrame, total: int, sample: str = "SAMPLE", key: str = "VarKey", first: str | None = None) -> DataFrame:
    """All rows where `first` holds, and of the others an equal number from every sample, the rest of total shared out (rounded down, so
    none where the others' samples outnumber it). Which ones goes by the md5 of the key."""
    of_first = F.coalesce(F.col(first), F.lit(False)) if first else F.lit(False)
    rows = df.withColumn("__first", of_first)
    sizes = rows.agg(F.sum(F.col("__first").cast("int")).alias("__n"), F.countDistinct(F.when(~F.col("__first"), F.col(sample))).alias("__samples"))
    rank = F.row_number().over(Window.partitionBy(sample).orderBy(F.md5(key), key))
    others = rows.where("not __first").withColumn("__r", rank).crossJoin(F.broadcast(sizes))
    share = F.floor(F.greatest(F.lit(total) - F.col("__n"), F.lit(0)) / F.greatest("__samples", F.lit(1)))
    return rows.where("__first").drop("__first").unionByName(others.where(F.col("__r") <= share).drop("__r", "__n", "__samples", "__first"))


def chunk_ids(ids: DataFrame, size: int, key: str = "s", digits: int = 2) -> DataFrame:
    """Ids (a pedigree's samples or families) in runs of `size` by name. Runs are numbered within groups by the first hex digits of the
    ids' md5, each group a task; a group's last run may be shorter."""
    rows = ids.select(key).distinct().withColumn("g", F.substring(F.md5(key), 1, digits))
    return rows.withColumn("k", F.floor((F.row_number().over(Window.partitionBy("g").orderBy(key)) - 1) / size)).select(key, F.concat_ws("-", "g", F.col("k").cast("string")).alias("chunk"))


#: Chunks that may be broadcast.
LISTED = 1_000_000


def chunk_pairs(chunks: DataFrame) -> DataFrame:
    """Every pair of chunks, each with itself included. The list of chunks is worked out once; one side is dealt over as many tasks as
    shuffles have, however short the list is, since there are as many pairs as its square."""
    from ..plans.scratch import written

    names = written(chunks.select("chunk").distinct(), "chunks")
    a = names.select(F.col("chunk").alias("a")).repartition(int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")), "a")
    b = names.select(F.col("chunk").alias("b"))
    return a.join(F.broadcast(b) if names.count() <= LISTED else b, F.col("a") <= F.col("b"))


def step_stats(steps: dict[str, DataFrame], sample: str = "SAMPLE") -> DataFrame:
    """By step of a pipeline: trios, rows, and the mean and deviation of rows a trio."""
    rows = reduce(lambda a, b: a.unionByName(b), [t.groupBy(F.col(sample).alias("s")).agg(F.count("*").alias("n")).withColumn("step", F.lit(n)) for n, t in steps.items()])
    return rows.groupBy("step").agg(F.count("*").alias("n_trios"), F.sum("n").alias("n_variants"), F.avg("n").alias("mean"), F.stddev_samp("n").alias("sd"))
