"""Curated events in a call set: mosaics, translocations, genomic disorders, aneuploidies, and rows added or removed by hand.

A call row has name, s, chrom, start, end, svtype and more columns of its own; rows that come from an event lack those and get nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import interval


def match_intervals(calls: DataFrame, events: DataFrame) -> DataFrame:
    """(event, name) of calls of the same sample and contig that overlap an event (event, s, chrom, start, end)."""
    own = events.select("event", "s", "chrom", "start", "end")
    return interval.pairs(own, calls.select("name", "s", "chrom", "start", "end"), ["chrom", "s"]).select("event", F.col("b_name").alias("name")).distinct()


def match_translocations(calls: DataFrame, events: DataFrame, slop: int = 1000) -> DataFrame:
    """(event, name) of calls of the same sample whose two ends lie within `slop` of an event's two ends, in either order.

    calls and events: s, chrom, pos, chrom2, pos2 (and name or event). Both ends must meet, so the rows are joined by sample and a hash of
    both ends' bins; an event's ends stand in their own bins and the neighbouring ones, in both orders.
    """
    at = lambda pos: F.floor(F.col(pos) / slop)
    key = lambda a, x, b, y: F.xxhash64(F.col(a), x, F.col(b), y)
    ends = calls.select("name", "s", "chrom", "pos", "chrom2", "pos2", key("chrom", at("pos"), "chrom2", at("pos2")).alias("ends"))
    one = events.select("event", "s", *[F.col(c).alias(f"e_{c}") for c in ("chrom", "pos", "chrom2", "pos2")])
    turned = one.select("event", "s", F.col("e_chrom2").alias("e_chrom"), F.col("e_pos2").alias("e_pos"), F.col("e_chrom").alias("e_chrom2"), F.col("e_pos").alias("e_pos2"))
    near = lambda c: F.explode(F.array(*[at(c) + d for d in (-1, 0, 1)]))
    both = one.unionByName(turned).withColumn("__x", near("e_pos")).withColumn("__y", near("e_pos2"))
    both = both.withColumn("ends", key("e_chrom", F.col("__x"), "e_chrom2", F.col("__y")))
    met = ends.join(both, ["s", "ends"])
    close = lambda a, b: F.abs(F.col(a) - F.col(b)) <= slop
    met = met.where((F.col("chrom") == F.col("e_chrom")) & (F.col("chrom2") == F.col("e_chrom2")) & close("pos", "e_pos") & close("pos2", "e_pos2"))
    return met.select("event", "name").distinct()


def flag_and_add(calls: DataFrame, events: DataFrame, met: DataFrame, kind: str, named: DataFrame | None = None, **verdict: str) -> DataFrame:
    """Calls with is_<kind> (met by an event, or named by hand: s and name) and is_<kind>_manual false; below them the events that met no
    call, both true, with the columns of `verdict`. Events that met a call add no row."""
    hit = met.select("name").distinct()
    if named is not None:
        hit = hit.unionByName(named.select("name")).distinct()
    old = calls.join(hit.withColumn("__hit", F.lit(True)), "name", "left").withColumns({f"is_{kind}": F.coalesce("__hit", F.lit(False)), f"is_{kind}_manual": F.lit(False)}).drop("__hit")
    fresh = events.join(met.select("event").distinct(), "event", "left_anti").withColumn("name", F.col("event"))
    fresh = fresh.withColumns({f"is_{kind}": F.lit(True), f"is_{kind}_manual": F.lit(True)} | {k: F.lit(v) for k, v in verdict.items()})
    kept = [c for c in fresh.columns if c in old.columns]
    return old.unionByName(fresh.select(*kept), allowMissingColumns=True)


def replace_aneuploidies(calls: DataFrame, events: DataFrame, **verdict: str) -> DataFrame:
    """Calls without those of an aneuploid contig (same sample, contig and type), and a row for each aneuploidy (event, s, chrom, svtype, ...)."""
    kept = calls.join(events.select("chrom", "s", "svtype").distinct(), ["chrom", "s", "svtype"], "left_anti").select(*calls.columns).withColumn("is_aneuploidy", F.lit(False))
    fresh = events.withColumn("name", F.col("event")).withColumns({"is_aneuploidy": F.lit(True)} | {k: F.lit(v) for k, v in verdict.items()})
    return kept.unionByName(fresh.select(*[c for c in fresh.columns if c in kept.columns]), allowMissingColumns=True)


def curate(
    calls: DataFrame, mosaics: DataFrame, translocations: DataFrame, disorders: DataFrame, aneuploidies: DataFrame, remove: DataFrame, add: DataFrame,
    samples: DataFrame, mosaics_by_hand: DataFrame | None = None, slop: int = 1000, result: str = "yes",
) -> DataFrame:
    """The final call table, step by step: mosaics, translocations and disorders flagged and added, aneuploid contigs replaced, rows taken
    out (remove: name) and put in (add) by hand, only samples of this set kept, sample errors marked.

    calls: name, s, chrom, start, end, svtype, is_highly_complex, is_unbalanced_tloc, and chrom2, pos2 of translocations. Events: event, s, chrom,
    start, end, svtype (translocations: chrom, pos, chrom2, pos2 too). mosaics_by_hand: names that a reviewer called mosaic. samples:
    s, parental_error, sex_error. Missing complexity flags become false, is_<kind> flags of rows from other steps false too.
    """
    yes = {"result_final": result}
    if "result_final" not in calls.columns:
        calls = calls.withColumn("result_final", F.lit(None).cast("string"))
    out = flag_and_add(calls, mosaics, match_intervals(calls, mosaics), "mosaic", mosaics_by_hand, **yes)
    ends = calls.where("chrom2 IS NOT NULL").withColumn("pos", F.col("start"))
    out = flag_and_add(out, translocations, match_translocations(ends, translocations, slop), "tloc", **yes)
    out = flag_and_add(out, disorders, match_intervals(calls, disorders), "GD", **yes)
    out = replace_aneuploidies(out, aneuploidies, **yes)
    out = out.join(remove.select("name").distinct(), "name", "left_anti").unionByName(add, allowMissingColumns=True)
    flags = [c for c in out.columns if c.startswith("is_")]
    out = out.withColumns({c: F.coalesce(c, F.lit(False)) for c in flags})
    bad: dict[str, Column] = {"relatedness_error": F.coalesce("parental_error", F.lit(False)), "sex_error": F.coalesce("sex_error", F.lit(False))}
    out = out.join(samples.select("s", "parental_error", "sex_error"), "s").withColumns(bad).drop("parental_error")
    return out.withColumn("any_error", F.col("relatedness_error") | F.col("sex_error"))
