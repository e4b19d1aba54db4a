"""Structural-variant operators. A call has name, chrom, start, end, svtype and samples (sorted array of carriers)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import genotype as gt
from ..functions.text import human_size
from . import interval
from .pedigree import trio_list, trio_members


def carriers(sv: DataFrame) -> DataFrame:
    return sv.select(*[c for c in sv.columns if c != "samples"], F.explode("samples").alias("s"))


def carrier_counts(sv: DataFrame, ped: DataFrame) -> DataFrame:
    """By call: carriers among children, parents, affected and unaffected samples, and their share of all parents."""
    kids = trio_list(ped)
    parents = kids.select(F.explode(F.array("father", "mother")).alias("s")).distinct().withColumn("is_parent", F.lit(1))
    people = ped.select(F.col("sample_id").alias("s"), (F.col("phenotype") == 2).cast("int").alias("aff"), F.col("paternal_id").isNotNull().cast("int").alias("is_child")).join(parents, "s", "left").fillna({"is_parent": 0})
    total = parents.agg(F.count("*").alias("n_parents_all"))
    rows = carriers(sv).select("name", "s").join(people, "s")
    out = rows.groupBy("name").agg(F.sum("is_child").alias("n_children"), F.sum("is_parent").alias("n_parents"), F.sum("aff").alias("n_affected"), F.sum(1 - F.col("aff")).alias("n_unaffected"))
    return out.crossJoin(F.broadcast(total)).withColumn("parent_af", gt.ratio(F.col("n_parents"), F.col("n_parents_all"))).drop("n_parents_all")


def sv_flags(sv: DataFrame, large: int = 5000, depth_small: int = 10000) -> DataFrame:
    """is_cnv, is_large_cnv, is_small_cnv, is_depth_only, is_depth_only_small, contains_RD and the size as text."""
    size = F.col("end") - F.col("start")
    cnv = F.col("svtype").isin("DEL", "DUP")
    depth = F.col("algorithms") == "depth"
    return sv.withColumns({"is_cnv": cnv, "is_large_cnv": cnv & (size >= large), "is_small_cnv": cnv & (size < large), "is_depth_only": depth, "is_depth_only_small": depth & (size < depth_small), "contains_RD": F.array_contains(F.split("evidence", ","), "RD"), "size_text": human_size(size)})


def reshape_raw(raw: DataFrame, ped: DataFrame) -> DataFrame:
    """Raw calls with their carrier's family and whether it is a parent."""
    parents = trio_list(ped).select(F.explode(F.array("father", "mother")).alias("s")).distinct().withColumn("is_parent", F.lit(True))
    return raw.join(ped.select(F.col("sample_id").alias("s"), "family_id"), "s").join(parents, "s", "left").withColumn("is_parent", F.coalesce("is_parent", F.lit(False)))


def sv_to_bed(sites: DataFrame, carriers_: DataFrame) -> DataFrame:
    """Sites with their carriers joined into one text."""
    joined = carriers_.groupBy("name").agg(F.array_join(F.array_sort(F.collect_set("s")), ",").alias("samples"))
    return sites.join(joined, "name")


def variant_to_bed(df: DataFrame) -> DataFrame:
    """Small variants as intervals: insertions pos to pos + length, deletions pos - length to pos."""
    size = F.abs(F.length("alt") - F.length("ref"))
    ins = F.length("alt") >= F.length("ref")
    return df.select(F.col("contig").alias("chrom"), F.when(ins, F.col("pos")).otherwise(F.col("pos") - size).alias("start"), F.when(ins, F.col("pos") + size).otherwise(F.col("pos")).alias("end"), F.concat_ws(":", "contig", F.col("pos").cast("string"), "ref", "alt").alias("name"))


def sv_bed_to_vcf(sv: DataFrame) -> DataFrame:
    """VCF columns of calls: chrom, pos, id, ref, alt, info by type (a call of several types is written as an insertion)."""
    size = F.col("end") - F.col("start")
    kind = F.when(F.col("svtype").contains(","), "INS").otherwise(F.col("svtype"))
    info = F.when(kind == "INS", F.format_string("SVTYPE=INS;SVLEN=%d;END=%d", size, F.col("start") + 1)).when(kind == "CTX", F.format_string("SVTYPE=CTX;CHR2=%s;END2=%d", F.col("chrom"), F.col("end"))).otherwise(F.format_string("SVTYPE=%s;SVLEN=%d;END=%d", kind, size, F.col("end")))
    return sv.select(F.col("chrom"), F.col("start").alias("pos"), F.col("name").alias("id"), F.lit("N").alias("ref"), F.concat(F.lit("<"), kind, F.lit(">")).alias("alt"), info.alias("info"))


def genotype_columns(sv: DataFrame, samples: list[str]) -> DataFrame:
    """One column a named sample: 0/1 for carriers, else 0/0."""
    return sv.select("name", *[F.when(F.array_contains("samples", s), "0/1").otherwise("0/0").alias(s) for s in samples])


def gene_explode(sv: DataFrame, fields: list[str]) -> DataFrame:
    """One row for each gene of a call with the fields that name it; complex calls have no gene, breakends go."""
    genes = F.array(*[F.struct(F.lit(f).alias("field"), F.split(F.coalesce(F.col(f), F.lit("")), ",").alias("genes")) for f in fields])
    rows = sv.where(F.col("svtype") != "BND").withColumn("__g", F.explode(genes)).withColumn("gene", F.explode("__g.genes")).where("gene <> ''").withColumn("gene", F.when(F.col("svtype") != "CPX", F.col("gene")))
    keep = [c for c in sv.columns if c not in fields]
    return rows.groupBy(*keep, "gene").agg(F.array_sort(F.collect_set("__g.field")).alias("gene_source"))


def cpx_intervals(df: DataFrame, column: str = "cpx_intervals") -> DataFrame:
    """TYPE_chr:start-end parts of a complex call, one row each."""
    part = F.explode(F.split(column, ","))
    rows = df.withColumn("__p", part).where("__p <> ''")
    take = lambda i: F.regexp_extract("__p", r"^([A-Z]+)_(\w+):(\d+)-(\d+)$", i)
    return rows.select(*[c for c in df.columns if c != column], take(1).alias("part_type"), take(2).alias("part_chrom"), take(3).cast("int").alias("part_start"), take(4).cast("int").alias("part_end"))


def flag_duplicate_cpx(rows: DataFrame) -> DataFrame:
    """is_duplicate: complex rows after the first (by name) at one place of one sample."""
    order = Window.partitionBy("svtype", "chrom", "start", "end", "s").orderBy("name")
    return rows.withColumn("is_duplicate", (F.col("svtype") == "CPX") & (F.row_number().over(order) > 1))


def cluster_calls(calls: DataFrame, keys: list[str], distance: int = 0) -> DataFrame:
    """Calls merged by keys and distance: span, joined names, carriers and number."""
    rows = interval.islands(calls, keys, distance)
    return rows.groupBy(*keys, "__island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.array_join(F.array_sort(F.collect_set("name")), ",").alias("names"), F.count("*").alias("n_calls"), F.sum(F.col("end") - F.col("start")).alias("bases")).drop("__island")


def fragmented(calls: DataFrame, keys: list[str], distance: int) -> DataFrame:
    """Calls with the first name of their cluster (name_fix) and whether the cluster holds several (is_fragmented)."""
    whole = Window.partitionBy(*keys, "__island")
    return interval.islands(calls, keys, distance).withColumns({"name_fix": F.min("name").over(whole), "is_fragmented": F.count("*").over(whole) > 1}).drop("__island")


def parent_median_coverage(calls: DataFrame, trios: DataFrame, coverage: DataFrame, cutoff: float, pad: int = 100) -> DataFrame:
    """By call and child: the exact median bin of each parent over the call (insertions padded), and whether either is under the
    cutoff. calls: name, chrom, start, end, svtype, s; coverage: chrom, start, end, s, cov."""
    rows = calls.join(trios.select(F.col("proband").alias("s"), "father", "mother"), "s")
    ins = F.col("svtype") == "INS"
    rows = rows.withColumns({"start": F.when(ins, F.col("start") - pad).otherwise(F.col("start")), "end": F.when(ins, F.col("end") + pad).otherwise(F.col("end"))})
    parents = rows.select("name", F.col("s").alias("child"), "chrom", "start", "end", F.inline(F.array(F.struct(F.col("father").alias("s"), F.lit("father").alias("role")), F.struct(F.col("mother").alias("s"), F.lit("mother").alias("role")))))
    met = interval.pairs(parents, coverage, ["chrom", "s"])
    out = met.groupBy("name", "child").agg(*[F.percentile(F.when(F.col("role") == r, F.col("b_cov")), F.lit(0.5)).alias(f"{r}_median") for r in ("father", "mother")])
    return out.withColumn("low_coverage", F.coalesce(F.least("father_median", "mother_median") < cutoff, F.lit(False)))


def disorder_calls(regions: DataFrame, calls: DataFrame, by: str, f: float = 0.3) -> DataFrame:
    """Pairs of a region and a call of the same type that counts for it: either they overlap reciprocally by f, or the calls of one
    sample or family (column `by`) together cover f of the region and no one call of it alone covers f of this region or of another
    that overlaps it. Columns of both (calls with the prefix b_) and reciprocal."""
    size, own = F.greatest(F.col("end") - F.col("start"), F.lit(1)), ["name", "chrom", "svtype", "start", "end", f"b_{by}"]
    met = interval.pairs(regions, calls, ["chrom", "svtype"]).withColumn("alone", F.col("overlap") >= f * size)
    met = met.withColumn("reciprocal", F.col("alone") & (F.col("overlap") >= f * F.greatest(F.col("b_end") - F.col("b_start"), F.lit(1))))
    together = _covered(met, own).where(F.col("covered") >= f * size).drop("covered").withColumn("id", F.concat_ws("|", "name", "svtype", f"b_{by}"))
    single = met.where("alone").select(*own).distinct().withColumnRenamed(f"b_{by}", by).drop("name")
    kept = interval.overlap_anti(together.withColumnRenamed(f"b_{by}", by), single, ["chrom", "svtype", by], id_col="id").select("name", "svtype", F.col(by).alias(f"b_{by}"), F.lit(True).alias("kept"))
    return met.join(kept, ["name", "svtype", f"b_{by}"], "left").where(F.col("reciprocal") | F.col("kept"))


def genomic_disorders(raw_depth: DataFrame, gd: DataFrame, ped: DataFrame, f: float = 0.3) -> DataFrame:
    """Depth calls of each child that count for a disorder region (see disorder_calls); de novo where no call of the same type that
    counts in a parent covers f of the child's call. gd: name, chrom, start, end, svtype (several joined by ;)."""
    regions = gd.withColumn("svtype", F.explode(F.split("svtype", ";")))
    raw = reshape_raw(raw_depth, ped)
    kids = disorder_calls(regions, raw.where("not is_parent"), "s", f)
    kids = kids.select("name", "svtype", F.col("b_s").alias("s"), F.col("b_family_id").alias("family_id"), "chrom", F.col("b_start").alias("start"), F.col("b_end").alias("end"), "reciprocal").distinct()
    parents = disorder_calls(regions, raw.where("is_parent"), "family_id", f)
    parents = parents.select("svtype", F.col("b_family_id").alias("family_id"), "chrom", F.col("b_start").alias("start"), F.col("b_end").alias("end")).distinct()
    call = ["s", "svtype", "chrom", "start", "end"]
    seen = interval.overlap_join(kids.select(*call, "family_id").distinct(), parents, ["chrom", "svtype", "family_id"], f).select(*call).distinct().withColumn("in_parent", F.lit(True))
    return kids.join(seen, call, "left").withColumn("is_de_novo", F.col("in_parent").isNull()).drop("in_parent")


def _covered(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Bases of [start, end) that the union of the b intervals covers, by keys (which hold start and end)."""
    rows = pairs.select(*keys, F.greatest("start", "b_start").alias("lo"), F.least("end", "b_end").alias("hi"))
    order = Window.partitionBy(*keys).orderBy("lo", "hi")
    reach = F.coalesce(F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.col("lo"))
    return rows.withColumn("__add", F.greatest(F.col("hi") - F.greatest("lo", reach), F.lit(0))).groupBy(*keys).agg(F.sum("__add").alias("covered"))


def ctx_windows(sv: DataFrame, margin: int = 20) -> DataFrame:
    """Translocations, one row a carrier, with windows around the first breakpoint."""
    return carriers(sv.where("svtype = 'CTX'")).select("name", "chrom", (F.col("start") - margin).alias("start"), (F.col("start") + margin).alias("end"), "s")


def sv_pathogenic(sv: DataFrame, disorders: DataFrame) -> DataFrame:
    """Calls that ClinVar calls pathogenic or likely so, dbVar pathogenic, or that bear a disorder's name."""
    named = sv.join(disorders.select("name").distinct().withColumn("__gd", F.lit(True)), "name", "left")
    return named.where(F.coalesce(F.col("clinvar").rlike("athogenic"), F.lit(False)) | F.coalesce(F.lower("dbvar") == "pathogenic", F.lit(False)) | F.col("__gd").isNotNull()).drop("__gd")


def flag_gene_list(sv: DataFrame, genes: list[str], fields: list[str], size: int) -> DataFrame:
    """Calls with their genes on the list, the fields that name them, and whether they pass the size."""
    listed = F.array(*[F.lit(g) for g in genes])
    own = lambda f: F.array_intersect(F.split(F.coalesce(F.col(f), F.lit("")), ","), listed)
    hit = F.array_sort(F.array_distinct(F.flatten(F.array(*[own(f) for f in fields]))))
    source = F.filter(F.array(*[F.when(F.size(own(f)) > 0, F.lit(f)) for f in fields]), lambda x: x.isNotNull())
    return sv.withColumns({"list_genes": hit, "list_source": source, "passes_size": (F.col("end") - F.col("start")) >= size})


@dataclass(frozen=True)
class DeNovoSVConfig:
    """Limits of the cascade; compat leaves out the two rules that the original set never applied."""

    gnomad_af: float = 0.01
    cohort_af: float = 0.01
    parents_af: float = 0.05
    parents_sc: int | None = None
    large: int = 5000
    depth_from: int = 5000
    large_overlap: float = 0.5
    small_overlap: float = 0.1
    parents_overlap: float = 0.5
    exclude_share: float = 0.5
    depth_only: int = 10000
    coverage: float = 10
    min_gq: int = 0
    nearest: int = 100
    longest_parent_depth: int = 1_000_000
    compat: bool = False


#: Flags of the cascade in its order (fixed values): the first that applies stays. The last two are set after all others.
SV_FLAGS = (
    "AF", "in_parent", "wham_only", "same_cn_as_parents", "not_in_raw_files_or_in_parents_raw_files", "in_blacklist_region", "large_cnv_with_parent_overlap", "small_cnv_SR_only",
    "depth_only_small_variant", "del_with_rdcn2_pe_only", "bad_gq_in_parents", "ins_filter", "low_coverage_in_parents", "not_del_dup_ins", "duplicated_cpx",
)


def _people(ped: DataFrame, kids: DataFrame) -> DataFrame:
    """One row a person: s, family_id, is_child (a father is named), is_parent (of a complete trio) and the families of those trios."""
    of = kids.select("fam_id", F.explode(F.array("father", "mother")).alias("s")).groupBy("s").agg(F.collect_set("fam_id").alias("parent_of"))
    people = ped.select(F.col("sample_id").alias("s"), "family_id", F.col("paternal_id").isNotNull().alias("is_child"))
    return people.join(of, "s", "left").withColumn("is_parent", F.col("parent_of").isNotNull())


def _child_calls(calls: DataFrame, people: DataFrame, kids: DataFrame, gts: DataFrame) -> DataFrame:
    """One row a call and child that carries it: the call's columns with its carriers among children and parents, the trio, whether a
    parent carries it (own_parent), and GQ and RD_CN of the three. A trio's records meet in one aggregate, without lists of carriers."""
    own = [c for c in calls.columns if c != "samples"]
    carried = calls.select(*own, F.explode("samples").alias("s"))
    count = lambda c: F.sum(F.col(c).cast("int"))
    counted = carried.join(people, "s").groupBy(*own).agg(count("is_child").alias("n_children"), count("is_parent").alias("n_parents"))
    records = carried.select("name", "s", F.lit(True).alias("carried")).unionByName(gts.select("name", "s", "GQ", "RD_CN"), allowMissingColumns=True)
    role = lambda r, c: F.when(F.col("role") == r, F.col(c))
    formats = [F.min(role(r, c)).alias(f"{r}_{n}") for r in ("kid", "dad", "mom") for c, n in (("GQ", "gq"), ("RD_CN", "cn"))]
    trio = [F.col("fam_id"), F.col("proband"), F.col("father"), F.col("mother")]
    by_trio = records.join(trio_members(kids), "s").groupBy("name", *trio).agg(
        F.max(role("kid", "carried")).alias("carried"), F.coalesce(F.max(F.when(F.col("role") != "kid", F.col("carried"))), F.lit(False)).alias("own_parent"), *formats
    )
    return counted.join(by_trio.where("carried").drop("carried").withColumnRenamed("proband", "s"), "name")


def _evidence(calls: DataFrame, people: DataFrame, raw: DataFrame, gd: DataFrame, exclude: DataFrame, coverage: DataFrame, cfg: DeNovoSVConfig) -> DataFrame:
    """All that calls are held against as one table: key (what, contig and whose), b_start, b_end, b_cov. Null parts never meet."""
    c = F.col
    key = lambda what, *parts: F.concat(F.lit(what), *[F.concat(F.lit("|"), c(p)) for p in parts])
    place = [c("start").alias("b_start"), c("end").alias("b_end")]
    known = raw.join(people, "s").withColumn("kind", F.when(c("is_depth"), "depth").otherwise("other"))
    known = known.where(~(c("is_parent") & c("is_depth") & (c("end") - c("start") >= cfg.longest_parent_depth)))
    whose = F.when(c("is_parent"), key("par", "kind", "svtype", "chrom", "family_id")).otherwise(key("own", "kind", "svtype", "chrom", "s"))
    large = calls.where(c("svtype").isin("DEL", "DUP") & (c("svlen") >= cfg.large)).select("chrom", "start", "end", F.explode("samples").alias("s"))
    large = large.join(people.where("is_parent"), "s").withColumn("fam_id", F.explode("parent_of"))
    depth = coverage.join(people.where("is_parent").select("s"), "s", "left_semi")
    out = known.select(whose.alias("key"), *place).unionByName(large.select(key("call", "chrom", "fam_id").alias("key"), *place))
    out = out.unionByName(gd.select(key("gd", "chrom").alias("key"), *place)).unionByName(exclude.select(key("ex", "chrom").alias("key"), *place))
    return out.withColumn("b_cov", F.lit(None).cast("double")).unionByName(depth.select(key("cov", "chrom", "s").alias("key"), *place, c("cov").cast("double").alias("b_cov")))


def denovo_sv(sv: DataFrame, ped: DataFrame, gts: DataFrame, raw: DataFrame, gd: DataFrame, exclude: DataFrame, coverage: DataFrame, cfg: DeNovoSVConfig = DeNovoSVConfig()) -> DataFrame:  # noqa: B008
    """One row for each call and child that carries it: is_de_novo, filter_flag (one of SV_FLAGS, or de_novo), in_gd.

    sv: name (unique), chrom, start, end, svtype, samples, algorithms, evidence, filter, gnomad_af, and af (without it, carriers of all
    samples). gts: name, s, GQ, RD_CN. raw: chrom, start, end, svtype, s, is_depth. gd, exclude: name, chrom, start, end. All contigs and
    families run in one job. A call's tests against intervals are probes of one binned sweep over all evidence (own and parents' raw
    calls, parents' large calls, regions, parents' coverage); one aggregate by call and child then gives every outcome, and the order
    of the rules is the order of one expression. Calls that a parent, their type or their records settle send one probe, for disorder
    regions; calls that are too frequent send all, since a disorder region lets them pass that rule.
    Calls of other types than DEL, DUP and INS need to pass only the first two rules. A call without coordinates meets nothing and stays.
    """
    c = F.col
    kids = trio_list(ped)
    people = _people(ped, kids)
    calls = sv.where(~c("svtype").isin("BND", "CNV")).withColumns({"svlen": c("end") - c("start"), "n_carriers": F.size("samples")})
    calls = calls.select("name", "chrom", "start", "end", "svtype", "algorithms", "evidence", "filter", "gnomad_af", "svlen", "n_carriers", "samples", *[x for x in sv.columns if x == "af"])
    total = people.agg(F.countDistinct("s").alias("n_all"), F.countDistinct(F.when(c("is_parent"), c("s"))).alias("n_all_parents"))
    rows = _child_calls(calls, people, kids, gts).crossJoin(F.broadcast(total))
    af = c("af") if "af" in sv.columns else c("n_carriers") / c("n_all")
    size = F.greatest(c("end") - c("start"), F.lit(1))
    kind, length = c("svtype"), c("end") - c("start")
    is_ins, is_cnv = kind == "INS", kind.isin("DEL", "DUP")
    is_large, is_small = is_cnv & (length >= cfg.large), is_cnv & (length < cfg.large)
    by_depth = is_large & (length >= cfg.depth_from)
    intent = F.lit(not cfg.compat)
    most_parents = F.lit(cfg.parents_sc) if cfg.parents_sc is not None else c("n_all_parents")
    alone = ~c("own_parent") & (c("n_children") >= 1) & (gt.ratio(c("n_parents"), c("n_all_parents")) <= cfg.parents_af) & (c("n_parents") <= most_parents)
    early = {
        "wham_only": intent & (c("algorithms") == "wham") & (c("kid_gq") == 1),
        "same_cn_as_parents": intent & (length > 5000) & (c("chrom") != "chrX") & ((c("kid_cn") == c("dad_cn")) | (c("kid_cn") == c("mom_cn"))),
    }
    late = {
        "small_cnv_SR_only": is_small & (c("evidence") == "SR") & ~c("filter").contains("BOTHSIDES_SUPPORT"),
        "depth_only_small_variant": (kind == "DUP") & (c("algorithms") == "depth") & (length <= cfg.depth_only),
        "del_with_rdcn2_pe_only": (kind == "DEL") & c("kid_cn").isin(2, 3) & (c("evidence") == "PE"),
        "bad_gq_in_parents": c("dad_gq").isNotNull() & c("mom_gq").isNotNull() & (F.least("dad_gq", "mom_gq") <= cfg.min_gq),  # a missing one clears both
        "ins_filter": is_ins & c("algorithms").isin("manta", "melt") & (c("evidence") == "SR") & ((c("kid_gq") == 0) | c("filter").contains("HIGH_SR_BACKGROUND")),
    }
    first = lambda tests: F.coalesce(*[F.when(t, name) for name, t in tests.items()])
    rows = rows.withColumns({
        "rare": (c("gnomad_af").isNull() | (c("gnomad_af") <= cfg.gnomad_af)) & (af <= cfg.cohort_af), "alone": F.coalesce(alone, F.lit(False)), "early": first(early), "late": first(late),
    })
    held = ["name", "s", "chrom", "start", "end", "svtype", "rare", "alone", "early", "late"]
    key = lambda what, *parts: F.concat(F.lit(what), *[F.concat(F.lit("|"), p if isinstance(p, Column) else c(p)) for p in parts])
    probe = lambda test, k, lo=c("start"), hi=c("end"): F.struct(F.lit(test).alias("test"), k.alias("key"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))  # noqa: B008, E731
    mode = F.when(by_depth, "depth").otherwise("other")
    near = [F.when(is_ins, c("start") - cfg.nearest + 1).otherwise(c("start")), F.when(is_ins, c("start") + cfg.nearest).otherwise(c("end"))]
    padded = [F.when(is_ins, c("start") - 100).otherwise(c("start")), F.when(is_ins, c("end") + 100).otherwise(c("end"))]
    open_ = c("alone") & (is_cnv | is_ins) & c("early").isNull()
    asked = F.array(
        probe("gd", key("gd", "chrom")), F.when(open_, probe("own", key("own", mode, "svtype", "chrom", "s"), *near)), F.when(open_, probe("par", key("par", mode, "svtype", "chrom", "fam_id"), *near)),
        F.when(open_, probe("ex", key("ex", "chrom"))), F.when(open_ & is_large, probe("call", key("call", "chrom", "fam_id"))),
        F.when(open_, probe("dad", key("cov", "chrom", "father"), *padded)), F.when(open_, probe("mom", key("cov", "chrom", "mother"), *padded)),
    )
    probes = rows.select(*held, F.inline(F.filter(asked, lambda x: x.isNotNull())))
    met = interval.sweep(probes, _evidence(calls, people, raw, gd, exclude, coverage, cfg)).repartition("name", "s")
    there = lambda x: F.when(c("b_start").isNotNull(), x)  # greatest and least pass over nulls
    met = met.withColumns({"left": there(F.greatest("start", "b_start")), "right": there(F.least("end", "b_end")), "b_size": there(F.greatest(c("b_end") - c("b_start"), F.lit(1)))})
    met = met.withColumn("over", there(F.least(F.greatest("end", c("start") + 1), F.greatest("b_end", c("b_start") + 1)) - c("left")))
    reach = F.max("right").over(Window.partitionBy("name", "s", "test").orderBy("left", "right").rowsBetween(Window.unboundedPreceding, -1))
    met = met.withColumn("fresh", F.greatest(c("right") - F.greatest("left", F.coalesce(reach, c("left"))), F.lit(0)))
    least = F.when(is_small, cfg.small_overlap).otherwise(cfg.large_overlap)
    shown = F.when(is_ins, F.abs(c("start") - c("b_start")) < cfg.nearest).otherwise((c("over") >= least * size) & (c("over") >= least * c("b_size")))
    of = lambda test: (c("test") == test) & c("b_start").isNotNull()
    any_ = lambda test, hit: F.coalesce(F.max(F.when(of(test), hit)), F.lit(False))
    share = lambda test: F.coalesce(F.sum(F.when(of(test), c("fresh"))), F.lit(0)) / size
    median = lambda who: F.percentile(F.when(c("test") == who, c("b_cov")), F.lit(0.5)).alias(who)
    rows = met.groupBy(*held).agg(
        any_("gd", c("over") >= 0.5 * size).alias("in_gd"), any_("own", ~by_depth & shown).alias("own"), any_("par", ~by_depth & shown).alias("par"),
        share("own").alias("own_share"), share("par").alias("par_share"), share("ex").alias("ex_share"), share("call").alias("call_share"), median("dad"), median("mom"),
    )
    in_raw = lambda who: F.when(by_depth, c(f"{who}_share") > cfg.large_overlap).otherwise(c(who))
    flag = F.coalesce(
        F.when(~(c("in_gd") | c("rare")), "AF"), F.when(~c("alone"), "in_parent"), F.when(~(is_cnv | is_ins), "not_del_dup_ins"), c("early"),
        F.when(~(in_raw("own") & ~in_raw("par")), "not_in_raw_files_or_in_parents_raw_files"), F.when(c("ex_share") > cfg.exclude_share, "in_blacklist_region"),
        F.when(is_large & (c("call_share") >= cfg.parents_overlap), "large_cnv_with_parent_overlap"), c("late"), F.when(F.least("dad", "mom") < cfg.coverage, "low_coverage_in_parents"), F.lit("de_novo"),
    )
    new = c("filter_flag").isin("de_novo", "not_del_dup_ins")
    rows = flag_duplicate_cpx(rows.withColumn("filter_flag", flag))
    rows = rows.withColumn("filter_flag", F.when(new & c("is_duplicate"), "duplicated_cpx").otherwise(c("filter_flag")))
    return rows.select("name", "s", "chrom", "start", "end", "svtype", new.alias("is_de_novo"), "filter_flag", "in_gd")


def denovo_sv_output(rows: DataFrame) -> DataFrame:
    """What the cascade hands on: de novo calls, filtered insertions, and calls in disorder regions."""
    return rows.where(F.col("is_de_novo") | (F.col("filter_flag") == "ins_filter") | F.col("in_gd"))


def families_with_calls(sv: DataFrame, ped: DataFrame) -> DataFrame:
    return carriers(sv).select("s").distinct().join(ped, F.col("s") == F.col("sample_id")).select("family_id").distinct()


def depth_sample_set(all_samples: DataFrame, outliers: DataFrame, sv: DataFrame) -> DataFrame:
    """Samples to test each call with: all but outliers, unless the outlier carries the call."""
    clean = all_samples.join(outliers.select("s").distinct(), "s", "left_anti")
    own = carriers(sv).select("name", "s").join(outliers.select("s").distinct(), "s", "left_semi")
    return own.select("name", "s"), clean


def pe_evidence(breakpoints: DataFrame, pe: DataFrame, w1: int = 2000, w2: int = 1000) -> DataFrame:
    """Read pairs near a call's first breakpoint whose mate is near its second, of the carrier. breakpoints: name, chrom, pos, chrom2,
    pos2, s; pe: chrom, pos, chrom2, pos2, s."""
    left = breakpoints.select("name", "s", "chrom", (F.col("pos") - w1).alias("start"), (F.col("pos") + w1 + 1).alias("end"), "chrom2", "pos2")
    right = pe.select("chrom", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"), "s", F.col("chrom2").alias("to"), F.col("pos2").alias("to_pos"))
    met = interval.pairs(left, right, ["chrom", "s"], width=2 * w1)
    return met.where((F.col("chrom2") == F.col("b_to")) & (F.abs(F.col("pos2") - F.col("b_to_pos")) <= w2)).select("name", "s", F.col("b_start").alias("pe_pos"), F.col("b_to_pos").alias("mate_pos"))


def tloc_frequency(hits: DataFrame) -> DataFrame:
    """By call: samples with at least 1, 4 and 10 supporting pairs."""
    per = hits.groupBy("name", "s").agg(F.count("*").alias("n"))
    return per.groupBy("name").agg(*[F.sum(F.when(F.col("n") >= k, 1).otherwise(0)).alias(f"n_{k}") for k in (1, 4, 10)])


def roi_windows(sv: DataFrame, split: int = 15000, margin: int = 3000) -> DataFrame:
    """Windows to look for read evidence in: the whole call with a margin, or one around each breakpoint of a long call."""
    long = (F.col("end") - F.col("start")) >= split
    box = lambda a, b, part: F.struct((a - margin).alias("start"), (b + margin).alias("end"), F.lit(part).alias("part"))
    both = F.array(box(F.col("start"), F.col("start"), "left"), box(F.col("end"), F.col("end"), "right"))
    return sv.select("name", "chrom", F.inline(F.when(long, both).otherwise(F.array(box(F.col("start"), F.col("end"), "whole")))))


def when_manual(manual: Column, standard: Column, flag: Column) -> Column:
    """The manual value for highly complex calls, else the standard one; a missing flag is not complex."""
    return F.when(F.coalesce(flag, F.lit(False)), manual).otherwise(standard)
