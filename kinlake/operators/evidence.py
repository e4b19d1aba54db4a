"""Read evidence (discordant pairs, split reads) in windows around calls, by one sweep over sorted evidence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .interval import BIN

#: Evidence rows of a bin that one task sweeps, on average; fuller bins are dealt to several.
ROWS = 200_000
#: Bases to either side of a split read that are shown, and colours of strands and sides (fixed values).
READ_PAD = 5
COLOURS = {"+": "255,0,0", "-": "0,255,0", "left": "0,0,255", "right": "255,0,0"}


def window_segments(windows: DataFrame, width: int = BIN, keys: Sequence[str] = ("chrom",)) -> tuple[DataFrame, DataFrame]:
    """(segments: keys, bin, segment_start, segment_end; members: the same and the columns of the windows that hold the segment).

    Windows (keys, start, end, ...) are cut at bins and, within a bin and key, wherever one of them starts or ends, so that a segment lies wholly
    inside or outside each window: what is found in a segment is shared by all windows over it.
    """
    whole, rest = [*keys, "bin"], [c for c in windows.columns if c not in keys]
    bins = F.explode(F.sequence(F.floor(F.col("start") / width).cast("long"), F.floor((F.col("end") - 1) / width).cast("long"))).alias("bin")
    cut = windows.where("start < end").select(*keys, *rest, bins)
    cut = cut.withColumns({"__lo": F.greatest("start", F.col("bin") * width), "__hi": F.least("end", (F.col("bin") + 1) * width)})
    ends = cut.select(*whole, F.explode(F.array("__lo", "__hi")).alias("segment_start")).distinct()
    after = F.lead("segment_start").over(Window.partitionBy(*whole).orderBy("segment_start"))
    pieces = ends.withColumn("segment_end", after).where("segment_end IS NOT NULL")
    members = cut.join(pieces, whole).where("segment_start >= __lo AND segment_end <= __hi").drop("__lo", "__hi")
    return members.select(*whole, "segment_start", "segment_end").distinct(), members


def segment_evidence(evidence: DataFrame, segments: DataFrame, width: int = BIN, rows: int = ROWS, keys: Sequence[str] = ("chrom",)) -> DataFrame:
    """Evidence (keys, pos from 1, ...) with the segment (segment_start, segment_end) that holds it; what none holds goes.

    Evidence of bins without a segment is left out by a join on the bin, which prunes files of evidence that is stored by bin. The rest is
    swept once, in order of position, each row taking the last segment that began before it. A bin of over `rows` rows is dealt to
    as many sweeps as it needs, each with the bin's segments.
    """
    whole = [*keys, "bin"]
    used = segments.select(*whole).distinct()
    placed = evidence.withColumn("bin", F.floor((F.col("pos") - 1) / width)).join(used, whole, "left_semi")
    deals = placed.groupBy(*whole).agg(F.ceil(F.count("*") / F.lit(rows)).cast("int").alias("__deals"))
    fields = [c for c in placed.columns if c not in whole]
    row = placed.join(deals, whole).select(*whole, F.pmod(F.xxhash64(*fields), "__deals").cast("int").alias("__deal"), (F.col("pos") - 1).alias("__at"), F.lit(1).alias("__kind"), F.struct(*fields).alias("__row"))
    seg = segments.join(deals, whole).select(*whole, F.explode(F.sequence(F.lit(0), F.col("__deals") - 1)).alias("__deal"), F.col("segment_start").alias("__at"), F.lit(0).alias("__kind"), F.struct("segment_start", "segment_end").alias("__seg"))
    swept = row.unionByName(seg, allowMissingColumns=True)
    order = Window.partitionBy(*whole, "__deal").orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    met = swept.withColumn("__seg", F.last("__seg", ignorenulls=True).over(order)).where(F.col("__row").isNotNull() & (F.col("__at") < F.col("__seg.segment_end")))
    return met.select(*whole, "__seg.*", "__row.*")


def as_track(evidence: DataFrame) -> DataFrame:
    """What is shown of evidence (kind PE or SR, chrom, pos, chrom2, pos2, strand, side, s): from, to and colour. Pairs across contigs have
    no place in a track."""
    c = F.col
    colour = lambda by: F.coalesce(*[F.when(c(by) == k, F.lit(v)) for k, v in COLOURS.items()])
    pair = c("kind") == "PE"
    first: Column = F.when(pair, c("pos")).otherwise(c("pos") - READ_PAD)
    last = F.when(pair, c("pos2")).otherwise(c("pos") + READ_PAD)
    kept = evidence.where(~pair | (c("chrom") == c("chrom2")))
    return kept.select("kind", "chrom", "pos", "s", first.alias("from"), last.alias("to"), F.when(pair, colour("strand")).otherwise(colour("side")).alias("colour"))


def evidence_in_roi(windows: DataFrame, evidence: DataFrame, width: int = BIN, rows: int = ROWS) -> DataFrame:
    """Rows of the track of each window's own sample: name, part, s, kind, chrom, pos, from, to, colour.

    windows: name, part, chrom, start, end (from 0, half-open), s. A long call, which has a window at either end, gets the rows of both.
    Repeated rows of evidence stay. Null positions lie nowhere.

    A sample has few windows in a bin, so evidence meets them by one equi join on (chrom, s, bin), and only bins of a sample with over `rows`
    rows of evidence are swept (segment_evidence), where overlapping windows share what is found. Each row of evidence goes one way.
    """
    from ..plans.scratch import written

    keys = ["chrom", "s"]  # other samples' windows cut nothing
    whole = [*keys, "bin"]
    windows = windows.select("name", "part", "chrom", "start", "end", "s").where("start < end")
    bins = F.explode(F.sequence(F.floor(F.col("start") / width).cast("long"), F.floor((F.col("end") - 1) / width).cast("long"))).alias("bin")
    track = as_track(evidence).where("pos IS NOT NULL").withColumn("bin", F.floor((F.col("pos") - 1) / width))
    out = ["name", "part", "s", "kind", "chrom", "pos", "from", "to", "colour"]
    full = track.groupBy(*whole).agg(F.count("*").alias("__n")).where(F.col("__n") > rows).select(*whole)
    full = F.broadcast(written(full, "full-bins"))  # as many as the evidence over `rows` at most
    few = windows.select("*", bins).join(full, whole, "left_anti").join(track, whole).where("pos > start AND pos <= end").select(*out)
    hot = windows.select("*", bins).join(full, whole, "left_semi")
    hot = hot.groupBy(*hot.columns).agg(F.count("*").alias("__times")).drop("bin").distinct()  # a window once, however many of its bins are swept
    segments, members = window_segments(hot, width, keys)
    placed = segment_evidence(track.join(full, whole, "left_semi").drop("bin"), segments, width, rows, keys)
    of = members.select(*whole, "segment_start", "name", "part", F.explode(F.sequence(F.lit(1).cast("long"), "__times")).alias("__time"))
    return few.unionByName(placed.join(of, [*whole, "segment_start"]).select(*out))
