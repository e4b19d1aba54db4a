"""Queries on intervals, structural variants, families and depth."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import annotate, depth, family, interval, pedigree, sv, trio
from . import views as V
from .registry import query

_NAMES = {"start_pos": "start", "end_pos": "end"}


def _ped(spark: SparkSession, d: str) -> DataFrame:
    return V.view(spark, d, "v_ped")


def _sv(spark: SparkSession, d: str) -> DataFrame:
    return V.sv(spark, d).withColumnsRenamed(_NAMES)


def _regions(spark: SparkSession, d: str) -> DataFrame:
    return V.view(spark, d, "v_regions").withColumnsRenamed(_NAMES)


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return V.view(spark, d, "v_raw").withColumnsRenamed(_NAMES)


def _coverage(spark: SparkSession, d: str) -> DataFrame:
    return V.view(spark, d, "v_coverage").withColumnsRenamed(_NAMES)


_LEN_A, _LEN_B = "greatest(a.end_pos - a.start_pos, 1)", "greatest(b.end_pos - b.start_pos, 1)"
_MEET = "a.chrom = b.chrom AND a.start_pos < b.end_pos AND b.start_pos < a.end_pos"
_OVER = "least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos)"
_POINT = "s.contig = r.chrom AND s.pos > r.start_pos AND s.pos <= r.end_pos"


@query(f"SELECT s.contig, s.pos FROM v_sites s WHERE EXISTS (SELECT 1 FROM v_regions r WHERE {_POINT})", "v_sites", "v_regions")
def j4_points_keep(spark, d):
    bed = _regions(spark, d).withColumnRenamed("chrom", "contig")
    return interval.points_in(V.view(spark, d, "v_sites"), bed).select("contig", "pos")


@query(f"SELECT s.contig, s.pos FROM v_sites s WHERE NOT EXISTS (SELECT 1 FROM v_regions r WHERE {_POINT})", "v_sites", "v_regions")
def j4_points_drop(spark, d):
    bed = _regions(spark, d).withColumnRenamed("chrom", "contig")
    return interval.points_in(V.view(spark, d, "v_sites"), bed, keep=False).select("contig", "pos")


@query(f"SELECT s.contig, s.pos, coalesce(string_agg(DISTINCT r.name, ',' ORDER BY r.name), '') AS regions FROM v_sites s LEFT JOIN v_regions r ON {_POINT} GROUP BY s.contig, s.pos", "v_sites", "v_regions")
def j4_annotate_points(spark, d):
    bed = _regions(spark, d).withColumnRenamed("chrom", "contig")
    return interval.annotate_points(V.view(spark, d, "v_sites").select("contig", "pos"), bed, "regions").withColumn("regions", F.array_join("regions", ","))


@query(f"SELECT a.name, b.name AS region, {_OVER} AS overlap FROM v_sv a JOIN v_regions b ON {_MEET} WHERE {_OVER} >= 0.3 * {_LEN_A}", "v_sv", "v_regions")
def j5_overlap_fraction(spark, d):
    return interval.overlap_join(_sv(spark, d), _regions(spark, d), ["chrom"], 0.3).select("name", F.col("b_name").alias("region"), "overlap")


@query(f"SELECT a.name, b.name AS region, {_OVER} AS overlap FROM v_sv a JOIN v_regions b ON {_MEET} WHERE {_OVER} >= 0.5 * {_LEN_A} AND {_OVER} >= 0.5 * {_LEN_B}", "v_sv", "v_regions")
def j5_overlap_reciprocal(spark, d):
    return interval.overlap_join(_sv(spark, d), _regions(spark, d), ["chrom"], 0.5, True).select("name", F.col("b_name").alias("region"), "overlap")


@query(f"SELECT a.name, b.name AS region, CASE WHEN b.name IS NULL THEN 0 ELSE {_OVER} END AS overlap FROM v_sv a LEFT JOIN v_regions b ON {_MEET}", "v_sv", "v_regions")
def j6_overlap_left(spark, d):
    return interval.overlap_join(_sv(spark, d), _regions(spark, d), ["chrom"], how="left").select("name", F.col("b_name").alias("region"), "overlap")


@query(f"SELECT a.name FROM v_sv a WHERE NOT EXISTS (SELECT 1 FROM v_regions b WHERE {_MEET} AND {_OVER} >= 0.25 * {_LEN_A})", "v_sv", "v_regions")
def j7_overlap_anti(spark, d):
    return interval.overlap_anti(_sv(spark, d), _regions(spark, d), ["chrom"], f=0.25).select("name")


@query(f"""WITH m AS (SELECT a.name, greatest(a.start_pos, b.start_pos) AS lo, least(a.end_pos, b.end_pos) AS hi FROM v_sv a JOIN v_regions b ON {_MEET}),
r AS (SELECT *, coalesce(max(hi) OVER (PARTITION BY name ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), lo) AS reach FROM m), c AS (SELECT name, sum(greatest(hi - greatest(lo, reach), 0)) AS n FROM r GROUP BY name)
SELECT a.name, round(coalesce(n, 0) / {_LEN_A}, 8) AS covered FROM v_sv a LEFT JOIN c USING (name)""", "v_sv", "v_regions")
def j8_coverage_fraction(spark, d):
    return interval.coverage_fraction(_sv(spark, d), _regions(spark, d), ["chrom"]).select("name", F.round("covered", 8).alias("covered"))


@query("""WITH m AS (SELECT a.name, b.name AS region, abs(a.start_pos - b.start_pos) AS distance FROM v_sv a JOIN v_regions b ON a.chrom = b.chrom AND abs(a.start_pos - b.start_pos) < 400)
SELECT name, region, distance FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY distance, region) AS r FROM m) WHERE r = 1""", "v_sv", "v_regions")
def j9_nearest(spark, d):
    return interval.nearest(_sv(spark, d), _regions(spark, d), ["chrom"], 400).select("name", F.col("b_name").alias("region"), "distance")


_ISLANDS = """WITH r AS (SELECT *, max(end_pos) OVER (PARTITION BY chrom, svtype ORDER BY start_pos, end_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM v_sv),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_pos > reach + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY chrom, svtype ORDER BY start_pos, end_pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM r)"""


@query(f'{_ISLANDS} SELECT chrom, svtype, min(start_pos) AS "start", max(end_pos) AS "end", string_agg(name, \',\' ORDER BY name) AS names, count(*) AS n FROM i GROUP BY chrom, svtype, island', "v_sv")
def w3_merge_intervals(spark, d):
    return interval.merge_intervals(_sv(spark, d).drop("samples"), ["chrom", "svtype"], 50)


@query("SELECT name, greatest(start_pos - CAST(floor((end_pos - start_pos) * 0.2) AS BIGINT), 1) AS \"start\", end_pos + CAST(floor((end_pos - start_pos) * 0.2) AS BIGINT) AS \"end\" FROM v_sv", "v_sv")
def w15_pad_intervals(spark, d):
    return interval.pad_intervals(_sv(spark, d)).select("name", "start", "end")


@query("SELECT name, greatest(start_pos - (end_pos - start_pos), 0) AS \"start\", least(end_pos + (end_pos - start_pos), CASE WHEN chrom = 'chr1' THEN 5000 ELSE 2147483647 END) AS \"end\" FROM v_sv", "v_sv")
def w16_window_intervals(spark, d):
    return interval.window_intervals(_sv(spark, d), 1, {"chr1": 5000}, "chrom").select("name", "start", "end")


@query("SELECT chrom, start_pos AS \"start\", end_pos AS \"end\", svtype, s, count(*) OVER (PARTITION BY chrom, start_pos, end_pos, svtype) AS n_at FROM v_raw", "v_raw")
def w17_count_by_coords(spark, d):
    return interval.count_by_coords(_raw(spark, d), ["chrom", "start", "end", "svtype"]).select("chrom", "start", "end", "svtype", "s", "n_at")


_CHAIN = "chain AS (SELECT chrom AS contig, start_pos, end_pos, chrom AS to_contig, start_pos + 100000 AS to_start, end_pos + 100000 AS to_end, CASE WHEN CAST(substr(name, 2) AS BIGINT) % 2 = 0 THEN '+' ELSE '-' END AS strand FROM v_regions)"


@query(f"""WITH {_CHAIN}, m AS (SELECT s.contig, s.pos, to_contig AS new_contig, CASE WHEN strand = '-' THEN to_end - (s.pos - 1 - start_pos) ELSE to_start + (s.pos - 1 - start_pos) + 1 END AS new_pos, row_number() OVER (PARTITION BY s.contig, s.pos ORDER BY to_contig, to_start) AS r
FROM v_sites s JOIN chain c ON s.contig = c.contig AND s.pos - 1 >= start_pos AND s.pos - 1 < end_pos) SELECT contig, pos, new_contig, new_pos FROM m WHERE r = 1""", "v_sites", "v_regions")
def j18_liftover(spark, d):
    r = _regions(spark, d)
    chain = r.select(F.col("chrom").alias("contig"), "start", "end", F.col("chrom").alias("to_contig"), (F.col("start") + 100000).alias("to_start"), (F.col("end") + 100000).alias("to_end"), F.when(F.substring("name", 2, 20).cast("long") % 2 == 0, "+").otherwise("-").alias("strand"))
    return interval.liftover(V.view(spark, d, "v_sites").select("contig", "pos"), chain)[0]


@query("SELECT name, chrom, start_pos AS \"start\", end_pos AS \"end\", (SELECT string_agg(s, ',' ORDER BY s) FROM v_sv_carriers c WHERE c.name = v.name) AS samples FROM v_sv v", "v_sv", "v_sv_carriers")
def src10_sv_to_bed(spark, d):
    return sv.sv_to_bed(_sv(spark, d).select("name", "chrom", "start", "end"), V.view(spark, d, "v_sv_carriers"))


@query("""SELECT contig AS chrom, CASE WHEN length(alt) >= length(ref) THEN pos ELSE pos - abs(length(alt) - length(ref)) END AS "start", CASE WHEN length(alt) >= length(ref) THEN pos + abs(length(alt) - length(ref)) ELSE pos END AS "end", concat(contig, ':', pos, ':', ref, ':', alt) AS name FROM v_sites""", "v_sites")
def src11_variant_to_bed(spark, d):
    return sv.variant_to_bed(V.view(spark, d, "v_sites"))


@query("""SELECT chrom, start_pos AS pos, name AS id, 'N' AS ref, concat('<', svtype, '>') AS alt, CASE svtype WHEN 'INS' THEN concat('SVTYPE=INS;SVLEN=', end_pos - start_pos, ';END=', start_pos + 1) WHEN 'CTX' THEN concat('SVTYPE=CTX;CHR2=', chrom, ';END2=', end_pos) ELSE concat('SVTYPE=', svtype, ';SVLEN=', end_pos - start_pos, ';END=', end_pos) END AS info FROM v_sv""", "v_sv")
def src9_sv_bed_to_vcf(spark, d):
    return sv.sv_bed_to_vcf(_sv(spark, d))


@query("SELECT v.name, CASE WHEN max(CASE WHEN s = 'S2' THEN 1 ELSE 0 END) = 1 THEN '0/1' ELSE '0/0' END AS \"S2\", CASE WHEN max(CASE WHEN s = 'S5' THEN 1 ELSE 0 END) = 1 THEN '0/1' ELSE '0/0' END AS \"S5\" FROM v_sv v LEFT JOIN v_sv_carriers c ON c.name = v.name GROUP BY v.name", "v_sv", "v_sv_carriers")
def src9_genotype_columns(spark, d):
    return sv.genotype_columns(_sv(spark, d), ["S2", "S5"])


@query("SELECT chrom, start_pos + 1 AS \"start\", end_pos AS \"end\", s, cov FROM v_coverage", "v_coverage")
def src14_shift_start(spark, d):
    return _coverage(spark, d).withColumn("start", F.col("start") + 1)


@query("""WITH k AS (SELECT * FROM v_ped WHERE paternal_id IS NOT NULL), par AS (SELECT paternal_id AS s FROM k UNION SELECT maternal_id FROM k)
SELECT name, count(*) FILTER (p.paternal_id IS NOT NULL) AS n_children, count(*) FILTER (par.s IS NOT NULL) AS n_parents, count(*) FILTER (phenotype = 2) AS n_affected, count(*) FILTER (phenotype <> 2) AS n_unaffected, count(*) FILTER (par.s IS NOT NULL) / (SELECT count(*) FROM par) AS parent_af
FROM v_sv_carriers c JOIN v_ped p ON c.s = p.sample_id LEFT JOIN par ON par.s = c.s GROUP BY name""", "v_sv_carriers", "v_ped")
def ag6_carrier_counts(spark, d):
    return sv.carrier_counts(_sv(spark, d), _ped(spark, d))


@query("""SELECT name, svtype IN ('DEL', 'DUP') AND end_pos - start_pos >= 5000 AS is_large_cnv, svtype IN ('DEL', 'DUP') AND end_pos - start_pos < 5000 AS is_small_cnv, algorithms = 'depth' AS is_depth_only, algorithms = 'depth' AND end_pos - start_pos < 10000 AS is_depth_only_small, evidence IN ('RD', 'RD,PE') AS contains_rd,
CASE WHEN end_pos - start_pos >= 1000000 THEN concat((end_pos - start_pos) // 1000000, 'Mb') WHEN end_pos - start_pos >= 1000 THEN concat((end_pos - start_pos) // 1000, 'kb') ELSE concat(end_pos - start_pos, 'bp') END AS size_text FROM v_sv""", "v_sv")
def f18_f9_sv_flags(spark, d):
    return sv.sv_flags(_sv(spark, d)).select("name", "is_large_cnv", "is_small_cnv", "is_depth_only", "is_depth_only_small", F.col("contains_RD").alias("contains_rd"), "size_text")


@query("SELECT chrom, start_pos AS \"start\", svtype, r.s, family_id, p.paternal_id IS NULL AND EXISTS (SELECT 1 FROM v_ped k WHERE k.paternal_id = r.s OR k.maternal_id = r.s) AS is_parent FROM v_raw r JOIN v_ped p ON p.sample_id = r.s", "v_raw", "v_ped")
def g17_reshape_raw(spark, d):
    return sv.reshape_raw(_raw(spark, d), _ped(spark, d)).select("chrom", "start", "svtype", "s", "family_id", "is_parent")


@query("""WITH o AS (SELECT v.name, c.s, row_number() OVER (PARTITION BY svtype, chrom, start_pos, end_pos, c.s ORDER BY v.name) AS r, svtype FROM v_sv v JOIN v_sv_carriers c USING (name)) SELECT name, s, svtype = 'CPX' AND r > 1 AS is_duplicate FROM o""", "v_sv", "v_sv_carriers")
def w6_flag_duplicate_cpx(spark, d):
    return sv.flag_duplicate_cpx(sv.carriers(_sv(spark, d))).select("name", "s", "is_duplicate")


_CL = """WITH r AS (SELECT *, max(end_pos) OVER (PARTITION BY chrom, svtype ORDER BY start_pos, end_pos, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM v_sv),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_pos > reach THEN 1 ELSE 0 END) OVER (PARTITION BY chrom, svtype ORDER BY start_pos, end_pos, name ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM r)"""


@query(f'{_CL} SELECT chrom, svtype, min(start_pos) AS "start", max(end_pos) AS "end", string_agg(DISTINCT name, \',\' ORDER BY name) AS names, count(*) AS n_calls, sum(end_pos - start_pos) AS bases FROM i GROUP BY chrom, svtype, island', "v_sv")
def ag15_cluster_calls(spark, d):
    return sv.cluster_calls(_sv(spark, d).drop("samples"), ["chrom", "svtype"])


@query(f"{_CL} SELECT name, min(name) OVER (PARTITION BY chrom, svtype, island) AS name_fix, count(*) OVER (PARTITION BY chrom, svtype, island) > 1 AS is_fragmented FROM i", "v_sv")
def g23_fragmented(spark, d):
    return sv.fragmented(_sv(spark, d).drop("samples"), ["chrom", "svtype"], 0).select("name", "name_fix", "is_fragmented")


_SVT = "c AS (SELECT v.name, v.chrom, CASE WHEN svtype = 'INS' THEN start_pos - 100 ELSE start_pos END AS st, CASE WHEN svtype = 'INS' THEN end_pos + 100 ELSE end_pos END AS en, x.s AS child, p.paternal_id, p.maternal_id FROM v_sv v JOIN v_sv_carriers x USING (name) JOIN v_ped p ON p.sample_id = x.s AND p.paternal_id IS NOT NULL)"


@query(f"""WITH {_SVT} SELECT c.name, child, quantile_cont(cov, 0.5) FILTER (b.s = paternal_id) AS father_median, quantile_cont(cov, 0.5) FILTER (b.s = maternal_id) AS mother_median,
coalesce(least(quantile_cont(cov, 0.5) FILTER (b.s = paternal_id), quantile_cont(cov, 0.5) FILTER (b.s = maternal_id)) < 50, false) AS low_coverage
FROM c JOIN v_coverage b ON b.chrom = c.chrom AND b.s IN (paternal_id, maternal_id) AND c.st < b.end_pos AND b.start_pos < greatest(c.en, c.st + 1) GROUP BY c.name, child""", "v_sv", "v_sv_carriers", "v_ped", "v_coverage")
def ag20_parent_median_coverage(spark, d):
    calls = sv.carriers(_sv(spark, d)).select("name", "chrom", "start", "end", "svtype", "s")
    return sv.parent_median_coverage(calls, pedigree.trio_list(_ped(spark, d)), _coverage(spark, d), 50)


def _share(name: str, rows: str, other: str, on: str, test: str) -> str:
    """SQL of the calls (name, s) of which the union of others covers a share that passes the test."""
    return f"""{name} AS (SELECT name, s FROM (SELECT *, greatest(hi - greatest(lo, coalesce(max(hi) OVER (PARTITION BY name, s ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), lo)), 0) AS part
  FROM (SELECT a.name, a.s, a.len, greatest(a.start_pos, b.start_pos) AS lo, least(a.end_pos, b.end_pos) AS hi FROM r a JOIN {other} b ON {_MEET} AND {on} WHERE {rows})) GROUP BY name, s, len HAVING sum(part) {test} * len)"""


_OWN, _FAMILY = "b.svtype = a.svtype AND NOT b.is_parent AND b.s = a.s", "b.svtype = a.svtype AND b.is_parent AND b.fam = a.fam"


def _in_raw(name: str, on: str) -> str:
    """SQL of the calls (name, s) that raw calls of the child, or of its parents, show."""
    both = f"{_OVER} >= {{f}} * {_LEN_A} AND {_OVER} >= {{f}} * {_LEN_B}"
    return f"""{_share(name + "_long", "a.svtype IN ('DEL', 'DUP') AND a.len >= 5000", "raw", on + " AND b.is_depth AND (NOT b.is_parent OR b.end_pos - b.start_pos < 1000000)", "> 0.5")},
{name} AS (SELECT name, s FROM {name}_long UNION SELECT a.name, a.s FROM r a JOIN raw b ON b.chrom = a.chrom AND {on} AND NOT b.is_depth WHERE a.svtype = 'INS' AND abs(a.start_pos - b.start_pos) < 100
  UNION SELECT a.name, a.s FROM r a JOIN raw b ON {_MEET} AND {on} AND NOT b.is_depth WHERE a.svtype IN ('DEL', 'DUP') AND ((a.len < 3000 AND {both.format(f=0.1)}) OR (a.len BETWEEN 3000 AND 4999 AND {both.format(f=0.5)})))"""


_CASCADE = f"""WITH k AS (SELECT family_id AS fam, sample_id AS s, paternal_id AS dad, maternal_id AS mom FROM v_ped WHERE paternal_id IS NOT NULL AND maternal_id IS NOT NULL), pa AS (SELECT fam, dad AS s FROM k UNION SELECT fam, mom FROM k),
n AS (SELECT name, count(*) FILTER (p.paternal_id IS NOT NULL) AS n_children, count(*) FILTER (x.s IN (SELECT s FROM pa)) AS n_parents, count(*) AS n_carriers FROM v_sv_carriers x JOIN v_ped p ON p.sample_id = x.s GROUP BY name),
r AS (SELECT v.*, v.end_pos - v.start_pos AS len, k.*, n_children, n_parents, n_carriers / (SELECT count(*) FROM v_ped) AS af, n_parents / (SELECT count(DISTINCT s) FROM pa) AS parent_af, d.name IS NOT NULL OR m.name IS NOT NULL AS own_parent, fk.gq AS kid_gq, fk.rd_cn AS kid_cn, fd.gq AS dad_gq, fd.rd_cn AS dad_cn, fm.gq AS mom_gq, fm.rd_cn AS mom_cn
  FROM v_sv v JOIN v_sv_carriers x USING (name) JOIN k ON k.s = x.s JOIN n ON n.name = v.name LEFT JOIN v_sv_carriers d ON d.name = v.name AND d.s = k.dad LEFT JOIN v_sv_carriers m ON m.name = v.name AND m.s = k.mom
  LEFT JOIN v_sv_format fk ON fk.name = v.name AND fk.s = k.s LEFT JOIN v_sv_format fd ON fd.name = v.name AND fd.s = k.dad LEFT JOIN v_sv_format fm ON fm.name = v.name AND fm.s = k.mom),
raw AS (SELECT w.*, p.family_id AS fam, w.s IN (SELECT s FROM pa) AS is_parent FROM v_raw w JOIN v_ped p ON p.sample_id = w.s),
big AS (SELECT v.chrom, v.start_pos, v.end_pos, pa.fam FROM v_sv v JOIN v_sv_carriers x USING (name) JOIN pa ON pa.s = x.s WHERE svtype IN ('DEL', 'DUP') AND v.end_pos - v.start_pos >= 3000),
{_in_raw("own", _OWN)}, {_in_raw("par", _FAMILY)}, {_share("ex", "true", "v_regions", "true", "> 0.5")}, {_share("pc", "a.svtype IN ('DEL', 'DUP') AND a.len >= 3000", "big", "b.fam = a.fam", ">= 0.5")},
gd AS (SELECT DISTINCT a.name, a.s FROM r a JOIN v_regions b ON {_MEET} WHERE CAST(substr(b.name, 2) AS INT) % 10 = 0 AND {_OVER} >= 0.5 * {_LEN_A}),
lc AS (SELECT a.name, a.s FROM (SELECT *, CASE WHEN svtype = 'INS' THEN start_pos - 100 ELSE start_pos END AS st, CASE WHEN svtype = 'INS' THEN end_pos + 100 ELSE end_pos END AS en FROM r) a JOIN v_coverage b ON b.chrom = a.chrom AND b.s IN (dad, mom) AND a.st < b.end_pos AND b.start_pos < greatest(a.en, a.st + 1)
  GROUP BY a.name, a.s HAVING coalesce(least(quantile_cont(cov, 0.5) FILTER (b.s = dad), quantile_cont(cov, 0.5) FILTER (b.s = mom)) < 10, false)),
t AS (SELECT r.*, gd.name IS NOT NULL AS in_gd, svtype IN ('DEL', 'DUP') AND len >= 3000 AS large, svtype IN ('DEL', 'DUP') AND len < 3000 AS small, own.name IS NOT NULL AND par.name IS NULL AS raw_ok, ex.name IS NOT NULL AS excluded, pc.name IS NOT NULL AS par_call, lc.name IS NOT NULL AS low_cov
  FROM r LEFT JOIN gd ON gd.name = r.name AND gd.s = r.s LEFT JOIN own ON own.name = r.name AND own.s = r.s LEFT JOIN par ON par.name = r.name AND par.s = r.s LEFT JOIN ex ON ex.name = r.name AND ex.s = r.s LEFT JOIN pc ON pc.name = r.name AND pc.s = r.s LEFT JOIN lc ON lc.name = r.name AND lc.s = r.s),
f AS (SELECT *, CASE WHEN NOT (in_gd OR ((gnomad_af IS NULL OR gnomad_af <= 0.01) AND af <= 0.01)) THEN 'AF' WHEN own_parent OR n_children < 1 OR parent_af > 0.05 THEN 'in_parent' WHEN svtype NOT IN ('DEL', 'DUP', 'INS') THEN 'not_del_dup_ins'
  WHEN algorithms = 'wham' AND kid_gq = 1 THEN 'wham_only' WHEN len > 5000 AND chrom <> 'chrX' AND (kid_cn = dad_cn OR kid_cn = mom_cn) THEN 'same_cn_as_parents' WHEN NOT raw_ok THEN 'not_in_raw_files_or_in_parents_raw_files' WHEN excluded THEN 'in_blacklist_region'
  WHEN large AND par_call THEN 'large_cnv_with_parent_overlap' WHEN small AND evidence = 'SR' AND filter NOT LIKE '%BOTHSIDES_SUPPORT%' THEN 'small_cnv_SR_only' WHEN svtype = 'DUP' AND algorithms = 'depth' AND len <= 10000 THEN 'depth_only_small_variant'
  WHEN svtype = 'DEL' AND kid_cn IN (2, 3) AND evidence = 'PE' THEN 'del_with_rdcn2_pe_only' WHEN dad_gq IS NOT NULL AND mom_gq IS NOT NULL AND least(dad_gq, mom_gq) <= 0 THEN 'bad_gq_in_parents'
  WHEN svtype = 'INS' AND algorithms IN ('manta', 'melt') AND evidence = 'SR' AND (kid_gq = 0 OR filter LIKE '%HIGH_SR_BACKGROUND%') THEN 'ins_filter' WHEN low_cov THEN 'low_coverage_in_parents' ELSE 'de_novo' END AS flag,
  row_number() OVER (PARTITION BY svtype, chrom, start_pos, end_pos, s ORDER BY name) > 1 AND svtype = 'CPX' AS dup FROM t)
SELECT name, s, chrom, start_pos AS "start", end_pos AS "end", svtype, flag IN ('de_novo', 'not_del_dup_ins') AND NOT dup AS is_de_novo, CASE WHEN dup AND flag IN ('de_novo', 'not_del_dup_ins') THEN 'duplicated_cpx' ELSE flag END AS filter_flag, in_gd FROM f"""
_CASCADE_VIEWS = ("v_sv", "v_sv_carriers", "v_sv_format", "v_ped", "v_raw", "v_regions", "v_coverage")


@query(_CASCADE, *_CASCADE_VIEWS, variants=("cascade",))
def g16_denovo_sv(spark, d):
    gts = V.view(spark, d, "v_sv_format").withColumnsRenamed({"gq": "GQ", "rd_cn": "RD_CN"})
    gd = _regions(spark, d).where(F.substring("name", 2, 9).cast("int") % 10 == 0)
    return sv.denovo_sv(_sv(spark, d), _ped(spark, d), gts, _raw(spark, d), gd, _regions(spark, d), _coverage(spark, d), sv.DeNovoSVConfig(large=3000))


@query(f"SELECT * FROM ({_CASCADE}) WHERE is_de_novo OR filter_flag = 'ins_filter' OR in_gd", *_CASCADE_VIEWS, within="cascade")
def g16_denovo_sv_output(spark, d):
    return sv.denovo_sv_output(g16_denovo_sv(spark, d))


def _disorder(by: str, parents: bool) -> str:
    """SQL of the pairs of a region and a call that counts for it, for children or parents."""
    t = "q" if parents else "k"
    who = "s IN (SELECT paternal_id FROM v_ped UNION SELECT maternal_id FROM v_ped)"
    return f"""{t}m AS (SELECT r.name, r.chrom, r.start_pos AS rs, r.end_pos AS re, c.svtype, c.s, family_id, c.start_pos, c.end_pos, least(r.end_pos, c.end_pos) - greatest(r.start_pos, c.start_pos) AS o
  FROM v_regions r JOIN v_raw c ON c.chrom = r.chrom AND r.start_pos < c.end_pos AND c.start_pos < r.end_pos JOIN v_ped ON sample_id = s WHERE is_depth AND c.svtype IN ('DEL', 'DUP') AND {'' if parents else 'NOT '}coalesce({who}, false)),
{t}c AS (SELECT name, svtype, {by} AS b, sum(greatest(hi - greatest(lo, reach), 0)) AS covered FROM (SELECT *, coalesce(max(hi) OVER (PARTITION BY name, svtype, {by} ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), lo) AS reach FROM (SELECT *, greatest(rs, start_pos) AS lo, least(re, end_pos) AS hi FROM {t}m)) GROUP BY name, svtype, {by}),
{t}s AS (SELECT DISTINCT chrom, svtype, {by} AS b, rs, re FROM {t}m WHERE o >= 0.3 * (re - rs)),
{t} AS (SELECT m.*, o >= 0.3 * (re - rs) AND o >= 0.3 * (end_pos - start_pos) AS reciprocal FROM {t}m m JOIN {t}c c ON c.name = m.name AND c.svtype = m.svtype AND c.b = m.{by}
  WHERE (o >= 0.3 * (re - rs) AND o >= 0.3 * (end_pos - start_pos)) OR (covered >= 0.3 * (re - rs) AND NOT EXISTS (SELECT 1 FROM {t}s x WHERE x.chrom = m.chrom AND x.svtype = m.svtype AND x.b = m.{by} AND x.rs < m.re AND m.rs < x.re)))"""


@query(f"""WITH {_disorder('s', False)}, {_disorder('family_id', True)}
SELECT DISTINCT name, svtype, s, family_id, chrom, start_pos AS "start", end_pos AS "end", reciprocal, NOT EXISTS (SELECT 1 FROM q WHERE q.chrom = k.chrom AND q.svtype = k.svtype AND q.family_id = k.family_id AND least(q.end_pos, k.end_pos) - greatest(q.start_pos, k.start_pos) >= 0.3 * (k.end_pos - k.start_pos)) AS is_de_novo
FROM k""", "v_regions", "v_raw", "v_ped")
def g18_genomic_disorders(spark, d):
    gd = _regions(spark, d).withColumn("svtype", F.lit("DEL;DUP"))
    return sv.genomic_disorders(_raw(spark, d).where("is_depth"), gd, _ped(spark, d))


@query("SELECT v.name, chrom, start_pos - 20 AS \"start\", start_pos + 20 AS \"end\", s FROM v_sv v JOIN v_sv_carriers c USING (name) WHERE svtype = 'CTX'", "v_sv", "v_sv_carriers")
def g30_ctx_windows(spark, d):
    return sv.ctx_windows(_sv(spark, d))


@query("SELECT DISTINCT family_id FROM v_sv_carriers JOIN v_ped ON s = sample_id", "v_sv_carriers", "v_ped")
def p37_families_with_calls(spark, d):
    return sv.families_with_calls(_sv(spark, d), _ped(spark, d))


@query("SELECT c.name, c.s FROM v_sv_carriers c JOIN v_ped p ON p.sample_id = c.s WHERE phenotype = 2", "v_sv_carriers", "v_ped")
def p38_depth_sample_set(spark, d):
    everyone = _ped(spark, d).select(F.col("sample_id").alias("s"))
    out = _ped(spark, d).where("phenotype = 2").select(F.col("sample_id").alias("s"))
    return sv.depth_sample_set(everyone, out, _sv(spark, d))[0]


@query("""WITH b AS (SELECT v.name, c.s, v.chrom, start_pos AS pos, end_pos AS pos2 FROM v_sv v JOIN v_sv_carriers c USING (name) WHERE svtype = 'CTX')
SELECT b.name, b.s, r.start_pos AS pe_pos, r.end_pos AS mate_pos FROM b JOIN v_raw r ON r.chrom = b.chrom AND r.s = b.s AND abs(r.start_pos - b.pos) <= 500 AND abs(r.end_pos - b.pos2) <= 1000""", "v_sv", "v_sv_carriers", "v_raw")
def j22_pe_evidence(spark, d):
    return sv.pe_evidence(*_pe(spark, d), 500, 1000)


def _pe(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    bp = sv.carriers(_sv(spark, d)).where("svtype = 'CTX'").select("name", "s", "chrom", F.col("start").alias("pos"), F.col("chrom").alias("chrom2"), F.col("end").alias("pos2"))
    pe = _raw(spark, d).select("chrom", F.col("start").alias("pos"), F.col("chrom").alias("chrom2"), F.col("end").alias("pos2"), "s")
    return bp, pe


@query("""WITH b AS (SELECT v.name, c.s, v.chrom, start_pos AS pos, end_pos AS pos2 FROM v_sv v JOIN v_sv_carriers c USING (name) WHERE svtype = 'CTX'),
h AS (SELECT b.name, b.s, count(*) AS n FROM b JOIN v_raw r ON r.chrom = b.chrom AND r.s = b.s AND abs(r.start_pos - b.pos) <= 500 AND abs(r.end_pos - b.pos2) <= 1000 GROUP BY b.name, b.s)
SELECT name, count(*) AS n_1, count(*) FILTER (n >= 4) AS n_4, count(*) FILTER (n >= 10) AS n_10 FROM h GROUP BY name""", "v_sv", "v_sv_carriers", "v_raw")
def ag19_tloc_frequency(spark, d):
    return sv.tloc_frequency(sv.pe_evidence(*_pe(spark, d), 500, 1000))


@query("""SELECT name, chrom, start_pos - 3000 AS "start", end_pos + 3000 AS "end", 'whole' AS part FROM v_sv WHERE end_pos - start_pos < 1500
UNION ALL SELECT name, chrom, start_pos - 3000, start_pos + 3000, 'left' FROM v_sv WHERE end_pos - start_pos >= 1500 UNION ALL SELECT name, chrom, end_pos - 3000, end_pos + 3000, 'right' FROM v_sv WHERE end_pos - start_pos >= 1500""", "v_sv")
def j23_roi_windows(spark, d):
    return sv.roi_windows(_sv(spark, d), split=1500)


@query(f"SELECT a.chrom, a.start_pos AS \"start\", a.end_pos AS \"end\", a.s FROM v_raw a WHERE svtype = 'CTX' AND NOT EXISTS (SELECT 1 FROM v_sv b JOIN v_sv_carriers c USING (name) WHERE b.svtype = 'CTX' AND c.s = a.s AND {_MEET})", "v_raw", "v_sv", "v_sv_carriers")
def j24_raw_only(spark, d):
    raw = _raw(spark, d).where("svtype = 'CTX'").withColumn("name", F.concat_ws(":", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), "s", F.col("is_depth").cast("string")))
    called = sv.carriers(_sv(spark, d)).where("svtype = 'CTX'")
    return interval.overlap_anti(raw, called, ["chrom", "s"]).select("chrom", "start", "end", "s")


_GENES = "g AS (SELECT v.*, CASE WHEN CAST(substr(name, 3, strpos(name, '_') - 3) AS BIGINT) % 3 = 0 THEN 'GA,GB' WHEN CAST(substr(name, 3, strpos(name, '_') - 3) AS BIGINT) % 3 = 1 THEN 'GB' ELSE '' END AS lof, CASE WHEN svtype = 'DUP' THEN 'GC' ELSE '' END AS dup FROM v_sv v)"


def _genes(spark: SparkSession, d: str) -> DataFrame:
    n = F.regexp_extract("name", r"^SV(\d+)_", 1).cast("long") % 3
    return _sv(spark, d).drop("samples").withColumns({"lof": F.when(n == 0, "GA,GB").when(n == 1, "GB").otherwise(""), "dup": F.when(F.col("svtype") == "DUP", "GC").otherwise("")})


@query(f"""WITH {_GENES}, e AS (SELECT name, svtype, 'lof' AS f, unnest(string_split(lof, ',')) AS gene FROM g UNION ALL SELECT name, svtype, 'dup', unnest(string_split(dup, ',')) FROM g)
SELECT name, CASE WHEN svtype <> 'CPX' THEN gene END AS gene, string_agg(DISTINCT f, ',' ORDER BY f) AS source FROM e WHERE gene <> '' GROUP BY 1, 2""", "v_sv")
def g14_gene_explode(spark, d):
    return sv.gene_explode(_genes(spark, d), ["lof", "dup"]).select("name", "gene", F.array_join("gene_source", ",").alias("source"))


@query(f"WITH {_GENES} SELECT name, CASE WHEN lof LIKE 'GA%' THEN 'GA' ELSE '' END AS list_genes, end_pos - start_pos >= 1000 AS passes_size FROM g", "v_sv")
def p28_flag_gene_list(spark, d):
    out = sv.flag_gene_list(_genes(spark, d), ["GA", "GX"], ["lof", "dup"], 1000)
    return out.select("name", F.array_join("list_genes", ",").alias("list_genes"), "passes_size")


@query("SELECT name, svtype FROM v_sv WHERE svtype = 'DEL' OR gnomad_af > 0.04 OR name IN ('SV1_1', 'SV2_2')", "v_sv")
def p34_sv_pathogenic(spark, d):
    calls = _sv(spark, d).withColumns({"clinvar": F.when(F.col("svtype") == "DEL", "Likely_pathogenic"), "dbvar": F.when(F.col("gnomad_af") > 0.04, "Pathogenic").otherwise("Benign")})
    return sv.sv_pathogenic(calls, calls.where("name in ('SV1_1', 'SV2_2')").select("name")).select("name", "svtype")


@query("SELECT name, svtype, concat('DEL_', chrom, ':', start_pos, '-', end_pos) AS part, chrom AS part_chrom, start_pos AS part_start, end_pos AS part_end FROM v_sv WHERE svtype = 'CPX'", "v_sv")
def f15_cpx_intervals(spark, d):
    rows = _sv(spark, d).where("svtype = 'CPX'").withColumn("cpx_intervals", F.concat(F.lit("DEL_"), "chrom", F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string"), F.lit(",")))
    out = sv.cpx_intervals(rows)
    return out.select("name", "svtype", F.concat("part_type", F.lit("_"), "part_chrom", F.lit(":"), F.col("part_start").cast("string"), F.lit("-"), F.col("part_end").cast("string")).alias("part"), "part_chrom", "part_start", "part_end")


@query("SELECT name, CASE WHEN svtype = 'CPX' THEN 'manual' ELSE algorithms END AS algorithms FROM v_sv", "v_sv")
def g31_manual_columns(spark, d):
    flag = F.when(F.col("svtype") != "INS", F.col("svtype") == "CPX")
    return _sv(spark, d).select("name", sv.when_manual(F.lit("manual"), F.col("algorithms"), flag).alias("algorithms"))


@query("""WITH a AS (SELECT name, chrom, start_pos, end_pos, svtype FROM v_sv), r AS (SELECT a.name, CASE WHEN b.name IS NOT NULL THEN least((least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos)) / greatest(a.end_pos - a.start_pos, 1), 1) END AS share, b.name AS region FROM a LEFT JOIN v_regions b ON a.chrom = b.chrom AND a.start_pos < b.end_pos AND b.start_pos < a.end_pos)
SELECT name, count(region) AS n_regions, round(coalesce(max(share), 0), 8) AS best FROM r GROUP BY name""", "v_sv", "v_regions")
def g21_overlap_proportions(spark, d):
    met = interval.overlap_join(_sv(spark, d).drop("samples"), _regions(spark, d), ["chrom"], how="left")
    share = F.least(F.col("overlap") / F.greatest(F.col("end") - F.col("start"), F.lit(1)), F.lit(1.0))
    return met.groupBy("name").agg(F.count("b_name").alias("n_regions"), F.round(F.coalesce(F.max(share), F.lit(0.0)), 8).alias("best"))


def _family_input(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    n = F.regexp_extract("name", r"^SV(\d+)_", 1).cast("long")
    gene = lambda x: F.concat(F.lit("G"), x.cast("string"))
    gt = V.view(spark, d, "v_sv_gt")
    counts = gt.groupBy("name").agg(F.sum(F.when(F.col("gt") == "1/1", 2).when(F.col("gt") == "./.", 0).otherwise(1)).alias("ac"), F.sum(F.when(F.col("gt") == "1/1", 1).otherwise(0)).alias("n_homalt"))
    calls = _sv(spark, d).join(counts, "name").withColumns({
        "genes": F.when(n % 4 == 0, F.array(F.lit("G1"), gene(n % 20))).otherwise(F.array(gene(n % 20))), "lof_genes": F.when(n % 2 == 0, F.array(gene(n % 20))).otherwise(F.array().cast("array<string>")),
        "in_gd": n % 15 == 0, "gnomad_af": F.col("gnomad_af") / 20, "chr2": F.when((F.col("svtype") == "CTX") & (n % 9 == 2), F.lit("chrX")),
    })
    listed = {"omim": ("G1", "G2", "G3"), "in_list": ("G2", "G7"), "constrained": ("G4", "G9", "G11")}
    genes = calls.select(F.explode("genes").alias("gene")).distinct().withColumns({k: F.col("gene").isin(*v) for k, v in listed.items()})
    terms = _ped(spark, d).select(F.col("sample_id").alias("s"), gene(F.substring("sample_id", 2, 20).cast("long") % 20).alias("gene"))
    return {"sv": calls, "gt": gt, "ped": _ped(spark, d), "genes": genes, "terms": terms}


_FAM = """n AS (SELECT v.*, CAST(substr(name, 3, strpos(name, '_') - 3) AS BIGINT) AS k FROM v_sv v), t AS (SELECT name, sum(CASE gt WHEN '1/1' THEN 2 WHEN './.' THEN 0 ELSE 1 END) AS ac, count(*) FILTER (gt = '1/1') AS n_homalt FROM v_sv_gt GROUP BY name),
rare AS (SELECT n.*, ac, n_homalt, k % 15 = 0 AS in_gd FROM n JOIN t USING (name) WHERE coalesce(gnomad_af / 20, 0) <= 0.001),
dads AS (SELECT DISTINCT family_id, paternal_id AS s FROM v_ped WHERE paternal_id IS NOT NULL), moms AS (SELECT DISTINCT family_id, maternal_id AS s FROM v_ped WHERE maternal_id IS NOT NULL),
p AS (SELECT v.family_id, v.sample_id AS s, phenotype = 2 AS aff, phenotype = 1 AS unaff, phenotype = 2 AND sex = 1 AND paternal_id IS NOT NULL AND maternal_id IS NOT NULL AS boy, d.s IS NOT NULL AS dad, m.s IS NOT NULL AS mom, paternal_id IS NOT NULL AND maternal_id IS NOT NULL AS kid
  FROM v_ped v LEFT JOIN dads d ON d.family_id = v.family_id AND d.s = v.sample_id LEFT JOIN moms m ON m.family_id = v.family_id AND m.s = v.sample_id),
fam AS (SELECT family_id, count(*) FILTER (aff) AS n_aff, count(*) FILTER (boy) AS n_boys, bool_or(kid) AND bool_or(dad) AND bool_or(mom) AS is_trio FROM p GROUP BY family_id),
c AS (SELECT r.name, p.*, CASE gt WHEN '1/0' THEN '0/1' ELSE gt END AS gt FROM rare r JOIN v_sv_carriers x USING (name) JOIN p ON p.s = x.s LEFT JOIN v_sv_gt g ON g.name = r.name AND g.s = x.s),
a AS (SELECT name, count(*) FILTER (aff) AS sc_all_aff, count(*) FILTER (unaff) AS sc_all_unaff FROM c GROUP BY name),
f AS (SELECT name, family_id, count(*) AS sc_fam, count(*) FILTER (aff) AS sc_fam_aff, count(*) FILTER (unaff) AS sc_fam_unaff, string_agg(s, ',' ORDER BY s) FILTER (aff) AS affected_carriers, count(*) FILTER (aff AND gt = '0/1') AS aff_het,
  count(*) FILTER (aff AND gt = '1/1') > 0 AS aff_hom, count(*) FILTER (unaff AND gt = '1/1') > 0 AS unaff_hom, count(*) FILTER (boy AND gt IN ('1/1', '1')) > 0 AS boy_hemi, count(*) FILTER (unaff AND gt IN ('1/1', '1')) > 0 AS unaff_hemi,
  count(*) FILTER (dad AND gt = '0/1') > 0 AS dad_het, count(*) FILTER (mom AND gt = '0/1') > 0 AS mom_het FROM c GROUP BY name, family_id),
x AS (SELECT f.*, r.k, r.chrom, r.svtype, r.in_gd, r.n_homalt, ac, sc_all_aff, sc_all_unaff, n_aff, n_boys, is_trio, sc_fam_unaff = 0 AND ac <= 10 AND sc_all_unaff <= 5 AS filt_absent_unaff, aff_het = n_aff AND dad_het AND NOT mom_het AS from_dad, aff_het = n_aff AND mom_het AND NOT dad_het AS from_mom
  FROM f JOIN a USING (name) JOIN rare r USING (name) JOIN fam USING (family_id) WHERE sc_fam_aff > 0),
xg AS (SELECT x.*, concat('G', k % 20) AS gene FROM x UNION ALL SELECT x.*, 'G1' FROM x WHERE k % 4 = 0 AND k % 20 <> 1)"""


@query(f"""WITH {_FAM}, h AS (SELECT l.name, l.family_id, count(DISTINCT o.name) > 1 AND (NOT l.is_trio OR (bool_or(o.from_dad) AND bool_or(o.filt_absent_unaff)) OR (bool_or(o.from_mom) AND bool_or(o.filt_absent_unaff)) OR (bool_or(o.from_dad) AND bool_or(o.from_mom))) AS filt_mult_hit
  FROM xg l JOIN xg o ON o.family_id = l.family_id AND o.gene = l.gene GROUP BY l.name, l.family_id, l.is_trio),
y AS (SELECT x.*, filt_mult_hit, aff_hom AND NOT unaff_hom AND n_homalt <= 10 AS filt_ar, CASE WHEN n_boys > 0 THEN boy_hemi AND NOT unaff_hemi AND (chrom = 'chrX' OR (svtype = 'CTX' AND k % 9 = 2)) END AS filt_xlr,
  k % 20 IN (2, 7) AS in_list_match, k % 20 IN (4, 9, 11) AS constrained_match, k % 4 = 0 OR k % 20 IN (1, 2, 3) AS omim_match, k % 2 = 0 AS is_lof, k % 20 = 2 AS is_lof_genelist FROM x JOIN h USING (name, family_id)),
z AS (SELECT y.*, (in_list_match OR constrained_match) AND ac <= 10 AND sc_all_unaff <= 5 AND sc_fam_unaff > 0 AS filt_inherited FROM y),
hpo AS (SELECT DISTINCT c.name, c.family_id FROM c JOIN xg USING (name, family_id) WHERE c.aff AND gene = concat('G', CAST(substr(c.s, 2) AS BIGINT) % 20))
SELECT name, family_id, chrom, svtype, sc_fam, sc_fam_aff, sc_fam_unaff, sc_all_aff, sc_all_unaff, affected_carriers, in_gd, filt_absent_unaff, filt_mult_hit, filt_ar, filt_xlr, filt_inherited, omim_match, in_list_match, constrained_match, hpo.name IS NOT NULL AS hpo_match, is_lof, is_lof_genelist
FROM z LEFT JOIN hpo USING (name, family_id) WHERE in_gd OR filt_absent_unaff OR filt_mult_hit OR filt_ar OR coalesce(filt_xlr, false) OR filt_inherited""", "v_sv", "v_sv_carriers", "v_sv_gt", "v_ped")
def g19_family_filter(spark, d):
    return family.family_filter(**_family_input(spark, d))


@query(f"""WITH {_FAM} SELECT family_id, gene, count(*) AS n_calls, count(*) > 1 AND (NOT is_trio OR (count(*) FILTER (from_dad) > 0 AND count(*) FILTER (from_mom OR filt_absent_unaff) > 0) OR (count(*) FILTER (from_mom) > 0 AND count(*) FILTER (filt_absent_unaff) > 0)) AS multi_hit
FROM xg GROUP BY family_id, gene, is_trio""", "v_sv", "v_sv_carriers", "v_sv_gt", "v_ped")
def g20_multi_hit(spark, d):
    x = _family_input(spark, d)
    rows = family.family_rows(x["sv"], x["gt"], x["ped"])
    hits = family.multi_hit(rows).join(rows.select("family_id", "is_trio").distinct(), "family_id")
    return hits.select("family_id", "gene", "n_calls", family.is_hit(*[F.col(k) for k in ("is_trio", "n_calls", "from_father", "from_mother", "is_new")]).alias("multi_hit"))


def _calls(spark: SparkSession, d: str) -> DataFrame:
    return _regions(spark, d).select("name", "chrom", "start", "end")


def _medians(spark: SparkSession, d: str) -> DataFrame:
    return _coverage(spark, d).groupBy("s").agg(F.percentile("cov", F.lit(0.5)).alias("median"))


_DEPTH = """md AS (SELECT s, quantile_cont(cov, 0.5) AS median FROM v_coverage GROUP BY s),
m AS (SELECT a.name, b.s, b.start_pos, b.cov, CAST(least(floor((greatest(b.start_pos, a.start_pos) - a.start_pos) / greatest((a.end_pos - a.start_pos) / 4, 1.0)), 3) AS INT) AS bin FROM v_regions a JOIN v_coverage b ON a.chrom = b.chrom AND a.start_pos < b.end_pos AND b.start_pos < a.end_pos),
h AS (SELECT name, bin, count(DISTINCT start_pos) AS n_bins FROM m GROUP BY name, bin), p AS (SELECT name, s, bin, sum(cov) AS cov FROM m GROUP BY name, s, bin),
da AS (SELECT h.name, x.s, h.bin, coalesce(p.cov, 0) / nullif(md.median * n_bins, 0) AS depth FROM h JOIN (SELECT DISTINCT name, s FROM m) x ON x.name = h.name LEFT JOIN p ON p.name = h.name AND p.s = x.s AND p.bin = h.bin JOIN md ON md.s = x.s),
db AS (SELECT name, min(bin) AS lo, max(bin) AS hi, count(DISTINCT bin) AS n FROM da GROUP BY name),
dp AS (SELECT da.* FROM da JOIN db USING (name) WHERE n < 4 OR (bin > lo AND bin < hi))"""


@query(f"WITH {_DEPTH} SELECT name, s, bin, round(depth, 8) AS depth FROM da", "v_regions", "v_coverage")
def w18_rebin_coverage(spark, d):
    return depth.rebin_coverage(_coverage(spark, d), _medians(spark, d), _calls(spark, d), 4).withColumn("depth", F.round("depth", 8))


def _depth(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = depth.rebin_coverage(_coverage(spark, d), _medians(spark, d), _calls(spark, d), 4)
    own = rows.select("name", "s").distinct().where(F.substring("s", 2, 9).cast("int") % 5 == 0)
    return depth.inner_bins(rows), own


@query(f"""WITH {_DEPTH}, q AS (SELECT name, s, quantile_cont(depth, 0.5) AS m, CAST(substr(s, 2) AS INT) % 5 = 0 AS own FROM dp GROUP BY name, s), c AS (SELECT name, avg(m) AS mean, stddev_samp(m) AS sd FROM q WHERE NOT own GROUP BY name),
r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY m DESC, s) AS rank FROM q)
SELECT name, s, round(m, 6) AS m, round((m - mean) / nullif(sd, 0), 5) AS z, rank FROM r JOIN c USING (name) WHERE own""", "v_regions", "v_coverage")
def m18_depth_test(spark, d):
    return depth.depth_test(*_depth(spark, d)).select("name", "s", F.round("m", 6).alias("m"), F.round("z", 5).alias("z"), "rank")


@query(f"""WITH {_DEPTH}, q AS (SELECT name, s, quantile_cont(depth, 0.5) AS m, CASE WHEN CAST(substr(s, 2) AS INT) % 5 = 0 THEN 1 ELSE 0 END AS own FROM dp GROUP BY name, s),
g AS (SELECT name, avg(m) AS mean, var_pop(m) AS var, count(*) AS n, sum(own) AS k, avg(m) FILTER (own = 1) AS om FROM q GROUP BY name)
SELECT name, round((om - mean) / nullif(sqrt(var / k * (n - k) / (n - 1)), 0), 5) AS z FROM g WHERE k > 0 AND k < n AND n > 1""", "v_regions", "v_coverage")
def m19_two_group_test(spark, d):
    return depth.two_group_test(*_depth(spark, d)).select("name", F.round("z", 5).alias("z"))


def _median(spark: SparkSession, d: str) -> DataFrame:
    return _depth(spark, d)[0].groupBy("name", "s").agg(F.percentile("depth", F.lit(0.5)).alias("m"))


_STATE = "CASE WHEN m <= 0.25 THEN 0 WHEN m <= 0.75 THEN 1 WHEN m <= 1.25 THEN 2 WHEN m <= 1.75 THEN 3 ELSE greatest(4, CAST(ceil((m - 0.25) / 0.5) AS INT)) END"


@query(f"""WITH {_DEPTH} , q AS (SELECT name, s, quantile_cont(depth, 0.5) AS m FROM dp GROUP BY name, s), a AS (SELECT *, {_STATE} AS st FROM q WHERE m IS NOT NULL),
n AS (SELECT name, st, count(*) AS n, quantile_cont(m, 0.5) AS mid FROM a GROUP BY name, st), t AS (SELECT name, st * 0.5 - mid AS corr FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY n DESC, st) AS r FROM n) WHERE r = 1),
b AS (SELECT name, s, corr, CASE WHEN corr > 0 AND greatest(m + corr, 0) - corr < 0.25 THEN greatest(m + corr, 0) - corr ELSE greatest(m + corr, 0) END AS m FROM a JOIN t USING (name)), c AS (SELECT *, {_STATE} AS copy_state FROM b)
SELECT name, s, round(m, 6) AS m, copy_state, round(corr, 6) AS correction, count(*) FILTER (copy_state <> 2) OVER (PARTITION BY name) < 2 AS no_call FROM c""", "v_regions", "v_coverage")
def m20_copy_states(spark, d):
    cut = spark.createDataFrame([(0, 0.0, 0.1, 0.25), (1, 0.5, 0.1, 0.75), (2, 1.0, 0.1, 1.25), (3, 1.5, 0.1, 1.75)], "copy_state int, mean double, sd double, cutoff double")
    out = depth.copy_states(_median(spark, d).where("m is not null"), cut)
    return out.select("name", "s", F.round("m", 6).alias("m"), "copy_state", F.round("correction", 6).alias("correction"), (F.col("gq_var") == 0).alias("no_call"))


@query()
def m21_depth_clusters(spark, d):
    return depth.depth_clusters(_median(spark, d).where("m is not null"))


_BAF = """baf AS (SELECT r.name, t.*, kid_alt / nullif(kid_ref + kid_alt, 0) AS abk, dad_alt / nullif(dad_ref + dad_alt, 0) AS abd FROM v_trios t JOIN v_regions r ON t.contig = r.chrom AND t.pos > r.start_pos AND t.pos <= r.end_pos WHERE length(ref) = 1 AND length(alt) = 1)"""


def _baf(spark: SparkSession, d: str) -> DataFrame:
    return depth.trio_baf(trio.trio_entries(V.entries(spark, d, families=True), pedigree.trio_list(_ped(spark, d)), fields=[*trio.CALL, "AD"]), _regions(spark, d))


@query(f"WITH {_BAF} SELECT name, contig AS chrom, pos, proband, kid_n AS gt_kid, abk AS ab_kid, abd AS ab_dad FROM baf", "v_trios", "v_regions")
def g22_trio_baf(spark, d):
    return _baf(spark, d).select("name", "chrom", "pos", "proband", "gt_kid", "ab_kid", "ab_dad")


@query(f"WITH {_BAF} SELECT name, dad_n AS gt_dad, mom_n AS gt_mom, kid_n AS gt_kid, count(*) AS n, round(avg(abk), 8) AS ab_mean FROM baf GROUP BY 1, 2, 3, 4", "v_trios", "v_regions")
def ag17_trio_gt_counts(spark, d):
    return depth.trio_gt_counts(_baf(spark, d)).withColumn("ab_mean", F.round("ab_mean", 8))


@query(f"WITH {_BAF} SELECT name, quantile_cont(abk, 0.5) FILTER (abk > 0.5) AS kid_above, quantile_cont(abk, 0.5) FILTER (abk < 0.5) AS kid_below FROM baf GROUP BY name", "v_trios", "v_regions")
def ag18_baf_medians(spark, d):
    return depth.baf_medians(_baf(spark, d)).select("name", "kid_above", "kid_below")


@query(f"WITH e AS (SELECT r.name AS interval, e.s, a1 FROM v_entries e JOIN v_regions r ON e.contig = r.chrom AND e.pos > r.start_pos AND e.pos <= r.end_pos) SELECT interval, s, count(a1) / count(*) AS call_rate FROM e GROUP BY interval, s", "v_entries", "v_regions", variants=("missing",))
def ag21_interval_callrate(spark, d):
    from ..operators import qc

    return qc.interval_callrate(V.entries(spark, d), _regions(spark, d).withColumnRenamed("chrom", "contig"))


@query("""WITH n AS (SELECT name, chrom, start_pos, end_pos, svtype, CAST(substr(name, 3, strpos(name, '_') - 3) AS BIGINT) AS k FROM v_sv), b AS (SELECT *, concat('new', k % 7) AS ann FROM n WHERE k % 2 = 0),
bn AS (SELECT name, min(ann) AS ann FROM b GROUP BY name), bc AS (SELECT chrom, start_pos, end_pos, svtype, min(ann) AS ann FROM b GROUP BY ALL)
SELECT n.name, CASE WHEN bn.ann IS NOT NULL THEN bn.ann WHEN bc.ann IS NOT NULL THEN bc.ann ELSE 'old' END AS ann FROM n LEFT JOIN bn USING (name) LEFT JOIN bc ON bc.chrom = n.chrom AND bc.start_pos = n.start_pos AND bc.end_pos = n.end_pos AND bc.svtype = n.svtype""", "v_sv")
def j20_update_annotations(spark, d):
    k = F.regexp_extract("name", r"^SV(\d+)_", 1).cast("long")
    calls = _sv(spark, d).drop("samples").withColumn("ann", F.lit("old"))
    new = calls.where(k % 2 == 0).withColumn("ann", F.concat(F.lit("new"), (k % 7).cast("string")))
    return annotate.update_annotations(calls, new, ["ann"]).select("name", "ann")


@query("SELECT name, CASE WHEN svtype = 'DEL' THEN 1 ELSE 2 END AS sex, concat('p_', lower(svtype), '_x') AS slug FROM v_sv", "v_sv")
def f10_f11_slug_and_sex(spark, d):
    return _sv(spark, d).select("name", text.sex_code(F.when(F.col("svtype") == "DEL", "Male").otherwise("F")).alias("sex"), text.slug(F.concat(F.lit("P: "), "svtype", F.lit(" (X)"))).alias("slug"))
