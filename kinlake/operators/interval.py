"""Interval operators: binned range joins, coverage, nearest, merging. Intervals are 0-based, half-open.

Both sides are cut into bins of one width; rows meet on (keys, bin), and a pair is kept in the bin where its overlap
starts, so no pair is seen twice and no distinct is needed. A dense bin is an ordinary skewed join key, which
adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Default bin width in base pairs; best near the usual length of the shorter side.
BIN = 16_384


def _bins(start: Column, end: Column, width: int) -> Column:
    return F.explode(F.sequence(F.floor(start / width).cast("long"), F.floor((F.greatest(end, start + 1) - 1) / width).cast("long")))


def pairs(a: DataFrame, b: DataFrame, keys: Sequence[str], width: int = BIN, start: str = "start", end: str = "end") -> DataFrame:
    """All overlapping pairs: columns of a, columns of b with the prefix b_, and overlap (base pairs).

    keys: columns that must be equal. A zero-length interval counts as one base pair. Null coordinates never overlap.
    """
    length = lambda c: F.greatest(F.col(c), F.col(c.replace(end, start)) + 1)
    left = a.withColumn("__bin", _bins(F.col(start), F.col(end), width))
    right = b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns]).withColumn("__bin_b", _bins(F.col(f"b_{start}"), F.col(f"b_{end}"), width))
    a_end, b_end = length(end), F.greatest(F.col(f"b_{end}"), F.col(f"b_{start}") + 1)
    on = F.col("__bin") == F.col("__bin_b")
    for k in keys:
        on = on & (left[k] == right[f"b_{k}"])
    low = F.greatest(F.col(start), F.col(f"b_{start}"))
    met = left.join(right, on).where((F.col(start) < b_end) & (F.col(f"b_{start}") < a_end) & (F.floor(low / width) == F.col("__bin")))
    return met.withColumn("overlap", (F.least(a_end, b_end) - low).cast("long")).drop("__bin", "__bin_b")


def sweep(probes: DataFrame, evidence: DataFrame, width: int = BIN) -> DataFrame:
    """Many kinds of interval tests in one join: each probe (key, lo, hi, own columns) with all evidence (key, b_start, b_end, own columns)
    of its key that it overlaps, each pair once. A probe that meets nothing in a bin stays there with nulls, so every probe stays at least
    once; one without coordinates or key stays and meets nothing. Zero-length intervals count as one base pair. key says what is tested
    and whose it is, so that different tests share one shuffle; the evidence's key is not returned."""
    bins = lambda a, b: F.sequence(F.floor(a / width).cast("long"), F.floor((F.greatest(b, a + 1) - 1) / width).cast("long"))
    c = F.col
    left = probes.withColumn("__bin", F.explode_outer(bins(c("lo"), c("hi"))))
    right = evidence.withColumnRenamed("key", "__key").withColumn("__at", F.explode(bins(c("b_start"), c("b_end"))))
    meet = (c("lo") < F.greatest("b_end", c("b_start") + 1)) & (c("b_start") < F.greatest("hi", c("lo") + 1)) & (F.floor(F.greatest("lo", "b_start") / width) == c("__bin"))
    return left.join(right, (c("key") == c("__key")) & (c("__bin") == c("__at")) & meet, "left").drop("__key", "__bin", "__at")


def overlap_join(a: DataFrame, b: DataFrame, keys: Sequence[str], f: float = 0.0, reciprocal: bool = False, how: str = "inner", id_col: str = "name", width: int = BIN, start: str = "start", end: str = "end") -> DataFrame:
    """Pairs whose overlap is at least the fraction f of a (and of b, if reciprocal). how="left": every row of a, with
    overlap 0 where it meets none; id_col then names the rows of a."""
    size = lambda s, e: F.greatest(F.col(e) - F.col(s), F.lit(1))
    met = pairs(a, b, keys, width, start, end)
    met = met.where(F.col("overlap") >= f * size(start, end))
    if reciprocal:
        met = met.where(F.col("overlap") >= f * size(f"b_{start}", f"b_{end}"))
    if how == "inner":
        return met
    lone = a.join(met.select(id_col).distinct(), id_col, "left_anti")
    return met.unionByName(lone, allowMissingColumns=True).withColumn("overlap", F.coalesce("overlap", F.lit(0).cast("long")))


def overlap_semi(a: DataFrame, b: DataFrame, keys: Sequence[str], id_col: str = "name", f: float = 0.0, **kw) -> DataFrame:
    return a.join(overlap_join(a, b, keys, f, id_col=id_col, **kw).select(id_col).distinct(), id_col, "left_semi")


def overlap_anti(a: DataFrame, b: DataFrame, keys: Sequence[str], id_col: str = "name", f: float = 0.0, **kw) -> DataFrame:
    """Rows of a that overlap nothing of b (by the fraction f of a)."""
    return a.join(overlap_join(a, b, keys, f, id_col=id_col, **kw).select(id_col).distinct(), id_col, "left_anti")


def points_in(points: DataFrame, bed: DataFrame, key: str = "contig", pos: str = "pos", keep: bool = True, width: int = BIN) -> DataFrame:
    """Points (1-based) inside any interval, or outside all of them."""
    right = bed.select(F.col(key).alias("__key"), F.col("start").alias("__s"), F.col("end").alias("__e"), _bins(F.col("start"), F.col("end"), width).alias("__bin"))
    on = (points[key] == right["__key"]) & (F.floor((points[pos] - 1) / width) == right["__bin"]) & (points[pos] > right["__s"]) & (points[pos] <= right["__e"])
    return points.join(right, on, "left_semi" if keep else "left_anti")


def annotate_points(points: DataFrame, bed: DataFrame, column: str, key: str = "contig", pos: str = "pos", width: int = BIN) -> DataFrame:
    """Points with the sorted names of the intervals that hold them (empty where none does)."""
    right = bed.select(F.col(key).alias("__key"), F.col("start").alias("__s"), F.col("end").alias("__e"), F.col("name").alias("__name"), _bins(F.col("start"), F.col("end"), width).alias("__bin"))
    on = (points[key] == right["__key"]) & (F.floor((points[pos] - 1) / width) == right["__bin"]) & (points[pos] > right["__s"]) & (points[pos] <= right["__e"])
    met = points.join(right, on, "left").groupBy(*points.columns).agg(F.array_sort(F.collect_set("__name")).alias(column))
    return met


def islands(df: DataFrame, keys: Sequence[str], distance: int = 0, start: str = "start", end: str = "end", width: int = BIN) -> DataFrame:
    """Rows with __island: one number (within the keys) for intervals that are chained by gaps of at most `distance`.

    Rows are ordered within bins of their start, so the work spreads over bins and not over the few values of the keys. How far the
    bins before reach, and how many islands begin in them, is carried over from a table of one row a bin. Keys are not null.
    """
    whole = [*keys, "__at"]
    rows = df.withColumn("__at", F.floor(F.col(start) / width))
    before = Window.partitionBy(*keys).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    own = Window.partitionBy(*whole).orderBy(start, end)
    carry = rows.groupBy(*whole).agg(F.max(end).alias("__top")).select(*whole, F.max("__top").over(before).alias("__carry"))
    reach = F.greatest(F.max(end).over(own.rowsBetween(Window.unboundedPreceding, -1)), "__carry")
    rows = rows.join(carry, whole).withColumn("__new", F.when(reach.isNull() | (F.col(start) > reach + distance), 1).otherwise(0)).drop("__carry")
    begun = rows.groupBy(*whole).agg(F.sum("__new").alias("__n")).select(*whole, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__begun"))
    number = F.col("__begun") + F.sum("__new").over(own.rowsBetween(Window.unboundedPreceding, 0))
    return rows.join(begun, whole).withColumn("__island", number).drop("__at", "__new", "__begun")


def merge_intervals(df: DataFrame, keys: Sequence[str], distance: int = 0, start: str = "start", end: str = "end", name: str = "name") -> DataFrame:
    """Intervals no further apart than `distance` joined into one, with their names (sorted, comma-joined) and number."""
    found = islands(df, keys, distance, start, end)
    return found.groupBy(*keys, "__island").agg(F.min(start).alias(start), F.max(end).alias(end), F.array_join(F.array_sort(F.collect_list(name)), ",").alias("names"), F.count("*").alias("n")).drop("__island")


def coverage_fraction(a: DataFrame, b: DataFrame, keys: Sequence[str], id_col: str = "name", width: int = BIN, start: str = "start", end: str = "end") -> DataFrame:
    """Rows of a with the fraction of each that the union of b covers."""
    met = pairs(a, b, keys, width, start, end).select(id_col, F.greatest(start, f"b_{start}").alias("lo"), F.least(end, f"b_{end}").alias("hi"))
    order = Window.partitionBy(id_col).orderBy("lo", "hi")
    reach = F.coalesce(F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.col("lo"))
    covered = met.withColumn("__new", F.greatest(F.col("hi") - F.greatest(F.col("lo"), reach), F.lit(0))).groupBy(id_col).agg(F.sum("__new").alias("__covered"))
    return a.join(covered, id_col, "left").withColumn("covered", F.coalesce("__covered", F.lit(0)) / F.greatest(F.col(end) - F.col(start), F.lit(1))).drop("__covered")


def nearest(a: DataFrame, b: DataFrame, keys: Sequence[str], max_distance: int, id_col: str = "name", b_id: str = "name", start: str = "start") -> DataFrame:
    """For each row of a the row of b with the nearest start, closer than max_distance (ties: by b_id)."""
    width = max_distance
    left = a.withColumn("__bin", F.explode(F.array(*[F.floor(F.col(start) / width) + d for d in (-1, 0, 1)])))
    right = b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns]).withColumn("__bin_b", F.floor(F.col(f"b_{start}") / width))
    on = F.col("__bin") == F.col("__bin_b")
    for k in keys:
        on = on & (left[k] == right[f"b_{k}"])
    met = left.join(right, on).withColumn("distance", F.abs(F.col(start) - F.col(f"b_{start}"))).where(F.col("distance") < max_distance).drop("__bin", "__bin_b")
    best = Window.partitionBy(id_col).orderBy("distance", f"b_{b_id}")
    return met.withColumn("__rank", F.row_number().over(best)).where("__rank = 1").drop("__rank")


def pad_intervals(df: DataFrame, share: float = 0.2, start: str = "start", end: str = "end") -> DataFrame:
    """Each side wider by a share of the length; starts never below 1."""
    pad = F.floor((F.col(end) - F.col(start)) * share)
    return df.withColumns({start: F.greatest(F.col(start) - pad, F.lit(1)).cast("long"), end: (F.col(end) + pad).cast("long")})


def window_intervals(df: DataFrame, k: float, lengths: dict[str, int], key: str = "contig", start: str = "start", end: str = "end") -> DataFrame:
    """Each side wider by k lengths, kept within the contig (lengths: by contig; others are not clamped)."""
    pad = F.floor((F.col(end) - F.col(start)) * k).cast("long")
    top = F.coalesce(*[F.when(F.col(key) == c, F.lit(n)) for c, n in lengths.items()], F.lit((1 << 31) - 1))
    return df.withColumns({start: F.greatest(F.col(start) - pad, F.lit(0)).cast("long"), end: F.least(F.col(end) + pad, top).cast("long")})


def count_by_coords(df: DataFrame, coords: Sequence[str]) -> DataFrame:
    """Rows with the number of rows at the same coordinates."""
    return df.withColumn("n_at", F.count("*").over(Window.partitionBy(*coords)))


def liftover(df: DataFrame, chain: DataFrame, width: int = BIN, contig: str = "contig", pos: str = "pos") -> tuple[DataFrame, DataFrame]:
    """(mapped, rejected). chain: blocks contig, start, end, to_contig, to_start, to_end, strand; a minus block runs
    backwards. A position in several blocks takes the first by to_contig and to_start."""
    blocks = chain.select(F.col("contig").alias("__c"), "start", "end", "to_contig", "to_start", "to_end", "strand", _bins(F.col("start"), F.col("end"), width).alias("__bin"))
    zero = df[pos] - 1
    on = (df[contig] == blocks["__c"]) & (F.floor(zero / width) == blocks["__bin"]) & (zero >= blocks["start"]) & (zero < blocks["end"])
    step = F.col(pos) - 1 - F.col("start")
    new = F.when(F.col("strand") == "-", F.col("to_end") - step).otherwise(F.col("to_start") + step + 1)
    first = Window.partitionBy(*df.columns).orderBy("to_contig", "to_start")
    mapped = df.join(blocks, on).withColumn("new_pos", new).withColumn("__rank", F.row_number().over(first)).where("__rank = 1")
    mapped = mapped.select(*df.columns, F.col("to_contig").alias("new_contig"), "new_pos")
    return mapped, df.join(blocks, on, "left_anti")
