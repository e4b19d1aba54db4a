"""Read-depth tests on long coverage (chrom, start, end, s, cov)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import genotype as gt
from ..functions import stats
from . import interval


def rebin_coverage(coverage: DataFrame, medians: DataFrame, calls: DataFrame, bins: int = 10) -> DataFrame:
    """By call, sample and one of at most `bins` equal runs of bins: depth summed and divided by the sample's median times the bins.
    Bins without a row count as depth 0. calls: name, chrom, start, end; medians: s, median."""
    met = interval.pairs(calls, coverage, ["chrom"])
    width = F.greatest((F.col("end") - F.col("start")) / bins, F.lit(1.0))
    rows = met.withColumn("bin", F.least(F.floor((F.greatest(F.col("b_start"), F.col("start")) - F.col("start")) / width), F.lit(bins - 1)).cast("int"))
    per = rows.groupBy("name", F.col("b_s").alias("s"), "bin").agg(F.sum("b_cov").alias("cov"))
    held = rows.groupBy("name", "bin").agg(F.countDistinct("b_start").alias("n_bins"))
    grid = held.join(per.select("name", "s").distinct(), "name")
    out = grid.join(per, ["name", "s", "bin"], "left").join(medians, "s")
    return out.select("name", "s", "bin", gt.ratio(F.coalesce("cov", F.lit(0)), F.col("median") * F.col("n_bins")).alias("depth"))


def depth_test(depth: DataFrame, carriers: DataFrame) -> DataFrame:
    """By call and carrier: one-sample z of its median depth against all other samples of the call, one-sided p, its rank by depth and the
    second-worst p over bins. depth: name, s, bin, depth; carriers: name, s."""
    median = depth.groupBy("name", "s").agg(F.percentile("depth", F.lit(0.5)).alias("m"))
    marked = median.join(carriers.select("name", "s").distinct().withColumn("own", F.lit(True)), ["name", "s"], "left").withColumn("own", F.coalesce("own", F.lit(False)))
    control = marked.where("not own").groupBy("name").agg(F.avg("m").alias("mean"), F.stddev_samp("m").alias("sd"), F.count("*").alias("n_controls"))
    rank = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("m"), "s"))
    out = marked.withColumn("rank", rank).where("own").join(control, "name")
    z = gt.ratio(F.col("m") - F.col("mean"), F.col("sd"))
    by_bin = depth.join(carriers.select("name", "s").distinct().withColumn("own", F.lit(True)), ["name", "s"], "left")
    each = by_bin.where("own is null").groupBy("name", "bin").agg(F.avg("depth").alias("bm"), F.stddev_samp("depth").alias("bs"))
    worst = by_bin.where("own").join(each, ["name", "bin"]).withColumn("bp", stats.normal_upper(F.abs(gt.ratio(F.col("depth") - F.col("bm"), F.col("bs")))))
    second = worst.withColumn("__r", F.row_number().over(Window.partitionBy("name", "s").orderBy(F.desc_nulls_last("bp"), "bin"))).where("__r = 2").select("name", "s", F.col("bp").alias("second_worst_p"))
    return out.withColumn("z", z).withColumn("p", stats.normal_upper(F.abs(F.col("z")))).join(second, ["name", "s"], "left").select("name", "s", "m", "mean", "sd", "z", "p", "rank", "second_worst_p", (F.col("m") - F.col("mean")).alias("separation"))


def two_group_test(depth: DataFrame, carriers: DataFrame, kinds: DataFrame | None = None) -> DataFrame:
    """By call: z of the carriers' mean depth against the mean and variance that drawing as many samples at random has, and a one-sided p.

    Where the power of a t test to see half a copy over the controls' spread is above 0.8, p is that of z (test twoSampPerm); else, and
    for one carrier, it is Fisher's combination of the p of each carrier against the controls (test singlesampZ). Where carriers outnumber
    controls the two change places. kinds: name, svtype (DEL looks for less depth, others for more); without it the side that is seen.
    """
    median = depth.groupBy("name", "s").agg(F.percentile("depth", F.lit(0.5)).alias("m"))
    marked = median.join(carriers.select("name", "s").distinct().withColumn("own", F.lit(1)), ["name", "s"], "left").fillna({"own": 0})
    side = lambda f, own: f(F.when(F.col("own") == own, F.col("m")))
    groups = [side(f, own).alias(f"{k}_{own}") for own in (0, 1) for k, f in (("mean", F.avg), ("sd", F.stddev_samp))]
    out = marked.groupBy("name").agg(F.avg("m").alias("mean"), F.var_pop("m").alias("var"), F.count("*").alias("n"), F.sum("own").alias("k"), side(F.avg, 1).alias("own_mean"), *groups).where("k > 0 and k < n and n > 1")
    se = F.sqrt(F.col("var") / F.col("k") * (F.col("n") - F.col("k")) / (F.col("n") - 1))
    out = out.withColumn("z", gt.ratio(F.col("own_mean") - F.col("mean"), se)).withColumn("swapped", F.col("n") < 2 * F.col("k"))
    fewer = F.col("own_mean") < F.col("mean")
    if kinds is not None:
        out = out.join(kinds.select("name", "svtype").distinct(), "name", "left")
        fewer = F.coalesce(F.upper("svtype") == "DEL", fewer)
    out = out.withColumn("sign", F.when(fewer, -1.0).otherwise(1.0))
    cases = F.when(F.col("swapped"), F.col("n") - F.col("k")).otherwise(F.col("k"))
    mean, sd = (F.when(F.col("swapped"), F.col(f"{x}_1")).otherwise(F.col(f"{x}_0")) for x in ("mean", "sd"))
    out = out.withColumns({"cases": cases, "c_mean": mean, "c_sd": sd})
    out = out.withColumn("power", stats.t_test_power(F.col("n") - F.col("cases"), F.col("cases"), gt.ratio(F.lit(0.5), F.col("c_sd"))))
    rows = marked.join(out.select("name", "swapped", "sign", "c_mean", "c_sd"), "name").where((F.col("own") == 1) != F.col("swapped"))
    # carriers and controls that change places look for the other side
    turned = F.when(F.col("swapped"), -F.col("sign")).otherwise(F.col("sign"))
    single = rows.withColumn("p1", stats.normal_upper(turned * gt.ratio(F.col("m") - F.col("c_mean"), F.col("c_sd"))))
    sums = single.groupBy("name").agg((-2 * F.sum(F.log(F.greatest("p1", F.lit(1e-300))))).alias("x"), F.count("p1").alias("singles"), F.max("p1").alias("p1"))
    out = out.join(sums, "name")
    powered = F.coalesce(F.col("power") > 0.8, F.lit(False))
    combined = F.when(F.col("singles") == F.col("cases"), F.when(F.col("cases") == 1, F.col("p1")).otherwise(stats.chi2_upper_even_of(F.col("x"), F.col("cases"))))
    p = F.when(powered, stats.normal_upper(F.col("sign") * F.col("z"))).otherwise(combined)
    test = F.when(powered, "twoSampPerm").otherwise("singlesampZ")
    return out.select("name", "mean", "var", "n", "k", "own_mean", "z", "power", test.alias("test"), p.alias("p"))


#: Width and offset of copy states above the last cutoff, and the largest quality (fixed values).
STATE_STEP, STATE_EDGE, TOP_GQ = 0.5, 0.25, 999


def copy_states(median: DataFrame, cutoffs: DataFrame, adjust: bool = True) -> DataFrame:
    """By call and sample: m (corrected), copy_state, gq, and the call's correction and gq_var.

    A median's state is the first whose cutoff it does not pass; above the last cutoff states go on in steps of one half. With
    adjust, a call's medians are moved so that its most common state (the least of equals) has its median at that state's mean; a
    negative one is 0, and homozygous deletions are not moved up. gq is the difference of phred-scaled z tests against the nearer
    neighbour state and the own one, by the spread of state 2; gq_var that of the median distance from 1 of samples not in state 2
    (0 where fewer than two are). cutoffs: copy_state 0, 1, ..., mean, sd, cutoff (a fixed handful of rows). Medians are not null.
    """
    c = F.col
    states = cutoffs.agg(F.array_sort(F.collect_list(F.struct("copy_state", "cutoff", "mean"))).alias("states"), F.max(F.when(c("copy_state") == 2, c("sd"))).alias("sd"))
    states = states.select("sd", c("states.cutoff").alias("cuts"), c("states.mean").alias("means"))

    def state(m: Column) -> Column:
        over, n = F.size(F.filter("cuts", lambda x: x < m)), F.size("cuts")
        return F.when(over < n, over).otherwise(F.greatest(n, F.ceil((m - STATE_EDGE) / STATE_STEP).cast("int")))

    mean = lambda k: F.coalesce(F.get("means", k), k * F.lit(STATE_STEP))
    rows = median.crossJoin(F.broadcast(states)).withColumn("first", state(c("m")))
    per = rows.groupBy("name", "first").agg(F.count("*").alias("n"), F.percentile("m", F.lit(0.5)).alias("mid"), F.first("means").alias("means"))
    top = per.groupBy("name").agg(F.max_by(F.struct(c("first"), c("mid"), c("means")), F.struct("n", (-c("first")).alias("least"))).alias("top"))
    shift = top.select("name", (F.coalesce(F.get("top.means", c("top.first")), c("top.first") * F.lit(STATE_STEP)) - c("top.mid")).alias("correction"))
    rows = rows.join(shift, "name")
    if adjust:
        moved = F.greatest(c("m") + c("correction"), F.lit(0.0))
        kept = (c("correction") > 0) & (moved - c("correction") < F.get("cuts", F.lit(0)))
        rows = rows.withColumn("m", F.when(kept, moved - c("correction")).otherwise(moved))
    rows = rows.withColumn("copy_state", state(c("m")))
    phred = lambda x: -10 * F.log10(stats.normal_upper(F.abs(x) / c("sd")))
    test = lambda k: F.when(stats.normal_upper(F.abs(c("m") - mean(k)) / c("sd")) > 1e-300, phred(c("m") - mean(k))).otherwise(1e6)
    low = F.when(c("copy_state") == 0, 1).otherwise(c("copy_state") - 1)
    gq = F.round(F.least(test(low), test(c("copy_state") + 1)) - test(c("copy_state")))
    rows = rows.withColumn("gq", F.when(gq > TOP_GQ, TOP_GQ).when(gq < 0, 1).otherwise(gq).cast("int"))
    off = F.when(c("copy_state") != 2, F.abs(c("m") - 1))
    per_call = rows.groupBy("name").agg(F.count(off).alias("n_off"), F.percentile(off, F.lit(0.5)).alias("off"), F.max("sd").alias("sd"))
    tail = stats.normal_upper(c("off") / c("sd"))
    of_call = F.when(c("n_off") < 2, 0).when(tail <= 1e-300, TOP_GQ).otherwise(F.least(F.lit(TOP_GQ), F.round(-10 * F.log10(tail)).cast("int")))
    return rows.join(per_call.select("name", of_call.cast("int").alias("gq_var")), "name").select("name", "s", "m", "copy_state", "gq", "correction", "gq_var")


def inner_bins(depth: DataFrame) -> DataFrame:
    """depth without the first and last bin of calls that have four bins or more: they are noisy."""
    ends = depth.groupBy("name").agg(F.min("bin").alias("__lo"), F.max("bin").alias("__hi"), F.countDistinct("bin").alias("__n"))
    return depth.join(ends, "name").where("__n < 4 OR (bin > __lo AND bin < __hi)").drop("__lo", "__hi", "__n")


def family_roles(ped: DataFrame) -> DataFrame:
    """proband, s and role (p1, s1, fa, mo) for every child: a sample with a named parent, or alone in its family. Siblings share both
    named parents."""
    alone = Window.partitionBy("family_id")
    kids = ped.withColumn("__n", F.count("*").over(alone)).where("paternal_id IS NOT NULL OR maternal_id IS NOT NULL OR __n = 1")
    own = lambda c, role: F.struct(F.col(c).alias("s"), F.lit(role).alias("role"))
    near = kids.select(F.col("sample_id").alias("proband"), F.inline(F.array(own("sample_id", "p1"), own("paternal_id", "fa"), own("maternal_id", "mo")))).where("s IS NOT NULL")
    both = kids.where("paternal_id IS NOT NULL AND maternal_id IS NOT NULL").select("sample_id", "paternal_id", "maternal_id")
    sibs = both.join(both.withColumnRenamed("sample_id", "s"), ["paternal_id", "maternal_id"]).where("sample_id <> s")
    return near.unionByName(sibs.select(F.col("sample_id").alias("proband"), "s", F.lit("s1").alias("role")))


def _moments(rows: DataFrame, families: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """mean and sd of the controls of each (keys, proband): samples of these keys that neither carry the call nor belong to the family.

    A key's sums over its non-carriers are made once; a family's own non-carriers are taken off them. Values are summed as differences
    from the key's mean, so that nothing is lost. rows: keys, s, own, value; families: proband, s.
    """
    free = rows.where("NOT own")
    centre = free.groupBy(*keys).agg(F.avg(value).alias("__c"))
    free = free.join(centre, keys).withColumn("__d", F.col(value) - F.col("__c"))
    sums = [F.count("__d"), F.sum("__d"), F.sum(F.col("__d") * F.col("__d"))]
    whole = free.groupBy(*keys, "__c").agg(*[x.alias(f"__w{i}") for i, x in enumerate(sums)])
    family = free.join(families, "s").groupBy(*keys, "proband").agg(*[x.alias(f"__f{i}") for i, x in enumerate(sums)])
    met = rows.join(families, "s").select(*keys, "proband").distinct()
    left = met.join(whole, keys).join(family, [*keys, "proband"], "left")
    n, one, two = (F.col(f"__w{i}") - F.coalesce(f"__f{i}", F.lit(0)) for i in range(3))
    spread = F.greatest(two - one * one / n, F.lit(0.0)) / (n - 1)
    return left.select(*keys, "proband", n.alias("n_controls"), F.when(n > 0, F.col("__c") + one / n).alias("mean"), F.when(n > 1, F.sqrt(spread)).alias("sd"))


def _left_out_medians(rows: DataFrame, families: DataFrame) -> DataFrame:
    """The median of the same controls, from the ranks of all non-carriers: the middle place is moved up past each relative before it."""
    keys = ["name", "grp"]
    free = rows.where("NOT own").withColumn("__at", F.row_number().over(Window.partitionBy(*keys).orderBy("m", "s")))
    size = free.groupBy(*keys).agg(F.count("*").alias("__n"))
    gone = free.join(families, "s").groupBy(*keys, "proband").agg(F.sort_array(F.collect_set("__at")).alias("__gone"))
    met = rows.join(families, "s").select(*keys, "proband").distinct().join(size, keys).join(gone, [*keys, "proband"], "left")
    met = met.withColumn("__gone", F.coalesce("__gone", F.array().cast("array<int>"))).withColumn("__left", F.col("__n") - F.size("__gone"))
    # of n left, places floor((n + 1) / 2) and floor((n + 2) / 2)
    moved = lambda start: F.aggregate("__gone", start.cast("int"), lambda at, g: F.when(g <= at, at + 1).otherwise(at))
    places = F.array(*[moved(F.floor((F.col("__left") + d) / 2)) for d in (1, 2)])
    places = met.where("__left > 0").select(*keys, "proband", F.explode(places).alias("__at"))
    return places.join(free.select(*keys, "__at", "m"), [*keys, "__at"]).groupBy(*keys, "proband").agg(F.avg("m").alias("median"))


def family_depth(depth: DataFrame, carriers: DataFrame, ped: DataFrame, kinds: DataFrame) -> DataFrame:
    """By call and family member (proband, s, role: p1, s1, fa, mo): median depth m, n_controls, z against the member's own controls and
    its one-sided p, the second-worst p over bins, rank and separation.

    Controls are the samples that neither carry the call nor belong to the family; on X and Y only those of the member's sex. depth: name,
    s, bin, depth; carriers: name, s; kinds: name, chrom, svtype (DEL looks for less depth, others for more). A member is ranked among all
    samples (of its sex on X and Y), ties by their mean rank; separation is the distance from the controls' median. Members without
    depth have no row, those of unknown sex none on X and Y.
    """
    c = F.col
    kind = kinds.select("name", F.regexp_replace("chrom", "^chr", "").isin("X", "Y").alias("__sexed"), (F.upper("svtype") == "DEL").alias("is_del"))
    people = ped.select(c("sample_id").alias("s"), "sex")
    marked = carriers.select("name", "s").distinct().withColumn("own", F.lit(True))
    rows = inner_bins(depth).join(kind, "name").join(people, "s", "left").withColumn("grp", F.when(~c("__sexed"), 0).otherwise(c("sex"))).where("grp IS NOT NULL AND (NOT __sexed OR sex IN (1, 2))")
    rows = rows.join(marked, ["name", "s"], "left").withColumn("own", F.coalesce("own", F.lit(False)))
    median = rows.groupBy("name", "s", "grp", "own", "is_del").agg(F.percentile("depth", F.lit(0.5)).alias("m")).where("m IS NOT NULL")
    roles = family_roles(ped)
    families = roles.select("proband", "s").distinct()
    place = Window.partitionBy("name", "grp").orderBy("m")
    ties = Window.partitionBy("name", "grp", "m")
    mean_rank = F.rank().over(place) + (F.count("*").over(ties) - 1) / 2
    up = mean_rank.alias("__rank")
    ranked = median.select("*", up, F.count("*").over(Window.partitionBy("name", "grp")).alias("__n"))
    out = ranked.join(roles, "s").join(_moments(median, families, "m", ["name", "grp"]), ["name", "grp", "proband"]).join(_left_out_medians(median, families).withColumnRenamed("median", "__mid"), ["name", "grp", "proband"], "left")
    toward = lambda x: F.when(c("is_del"), -x).otherwise(x)
    z = gt.ratio(c("m") - c("mean"), c("sd"))
    bins = rows.where("depth IS NOT NULL")
    each = bins.join(families, "s").join(_moments(bins, families, "depth", ["name", "grp", "bin"]), ["name", "grp", "bin", "proband"])
    each = each.withColumn("bp", stats.normal_upper(toward(gt.ratio(c("depth") - c("mean"), c("sd")))))
    worst = F.sort_array(F.collect_list("bp"), asc=False)
    second = each.groupBy("name", "proband", "s").agg(worst.alias("__bp")).select("name", "proband", "s", F.when(F.size("__bp") > 1, F.get("__bp", F.lit(1))).otherwise(F.get("__bp", F.lit(0))).alias("second_worst_p"))
    out = out.withColumn("z", z).join(second, ["name", "proband", "s"], "left")
    rank = F.when(c("is_del"), c("__rank")).otherwise(c("__n") - c("__rank") + 1)
    return out.select("name", "proband", "s", "role", "m", "n_controls", "mean", "sd", "z", stats.normal_upper(toward(c("z"))).alias("p"), "second_worst_p", rank.alias("rank"), toward(c("m") - c("__mid")).alias("separation"))


def silhouette(x: np.ndarray, of: np.ndarray) -> float:
    """Mean silhouette width of one-dimensional values in clusters; a value alone in its cluster counts 0."""
    kinds = np.unique(of)
    if len(kinds) < 2:
        return 0.0
    far = np.stack([np.abs(x[:, None] - x[of == k]).sum(axis=1) for k in kinds], axis=1)
    size = np.array([(of == k).sum() for k in kinds])
    own = np.searchsorted(kinds, of)
    here = far[np.arange(len(x)), own] / np.maximum(size[own] - 1, 1)
    away = far / size
    away[np.arange(len(x)), own] = np.inf
    there = away.min(axis=1)
    width = (there - here) / np.maximum(np.maximum(here, there), 1e-300)
    return float(np.where(size[own] > 1, width, 0.0).mean())


def depth_clusters(median: DataFrame, first: float = 0.1, last: float = 0.5, step: float = 0.1, most: int = 100) -> DataFrame:
    """By call: the number of copy states, by k-means from centres spaced 0, i, 2 i, ... for each interval i; of the intervals the one with
    the best mean silhouette (the last of equals) counts. A call's samples are one group in a task; its size is the number of samples,
    which a cohort bounds. Medians are not null."""
    import pandas as pd

    intervals = np.round(np.arange(first, last + step / 2, step), 10)

    def means(x: np.ndarray, i: float) -> np.ndarray:
        centre = np.arange(min(most, max(len(x) - 1, 0)) + 1) * i
        for _ in range(100):
            of = np.abs(x[:, None] - centre).argmin(axis=1)
            new = np.array([x[of == c].mean() if (of == c).any() else centre[c] for c in range(len(centre))])
            if np.array_equal(new, centre):
                break
            centre = new
        return of

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        x = np.sort(group["m"].to_numpy(float))
        found = [(silhouette(x, of), k, len(np.unique(of))) for k, of in enumerate(means(x, i) for i in intervals)]
        width, k, n = max(found, key=lambda r: (r[0], r[1]))
        return pd.DataFrame({"name": [group["name"].iloc[0]], "n_states": [n], "interval": [float(intervals[k])], "silhouette": [width]})

    return median.groupBy("name").applyInPandas(fit, "name string, n_states int, interval double, silhouette double")


def trio_baf(trios: DataFrame, windows: DataFrame) -> DataFrame:
    """By window and trio: SNV rows with the allele balance of each member. windows: name, chrom, start, end (0-based)."""
    ab = lambda m: gt.ratio(F.get(F.col(f"{m}.AD"), F.lit(1)), F.get(F.col(f"{m}.AD"), F.lit(0)) + F.get(F.col(f"{m}.AD"), F.lit(1))).alias(f"ab_{m}")
    n = lambda m: (F.col(f"{m}.a1") + F.col(f"{m}.a2")).alias(f"gt_{m}")
    points = trios.where((F.length("ref") == 1) & (F.length("alt") == 1)).select(F.col("contig").alias("chrom"), (F.col("pos") - 1).alias("start"), F.col("pos").alias("end"), "proband", *[n(m) for m in ("kid", "dad", "mom")], *[ab(m) for m in ("kid", "dad", "mom")])
    met = interval.pairs(points, windows, ["chrom"])
    return met.select(F.col("b_name").alias("name"), "chrom", F.col("end").alias("pos"), "proband", "gt_kid", "gt_dad", "gt_mom", "ab_kid", "ab_dad", "ab_mom")


def trio_gt_counts(baf: DataFrame) -> DataFrame:
    """By window: how often each combination of calls stands, and the child's mean allele balance."""
    return baf.groupBy("name", "gt_dad", "gt_mom", "gt_kid").agg(F.count("*").alias("n"), F.avg("ab_kid").alias("ab_mean"))


def baf_medians(baf: DataFrame) -> DataFrame:
    """By window: the exact median allele balance above and below one half of each member."""
    side = lambda m, up: F.percentile(F.when(F.col(f"ab_{m}") > 0.5 if up else F.col(f"ab_{m}") < 0.5, F.col(f"ab_{m}")), F.lit(0.5)).alias(f"{m}_{'above' if up else 'below'}")
    return baf.groupBy("name").agg(*[side(m, up) for m in ("kid", "dad", "mom") for up in (True, False)])
