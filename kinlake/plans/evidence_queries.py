"""Queries on read evidence, family depth and curated events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import curated, depth, evidence, sv
from . import views as V
from .registry import query
from .sv_queries import _DEPTH, _calls, _depth, _ped, _sv

SPLIT = 1500


@query(f"""WITH w AS (
  SELECT name, chrom, start_pos - 3000 AS a, end_pos + 3000 AS b, 'whole' AS part FROM v_sv WHERE end_pos - start_pos < {SPLIT}
  UNION ALL SELECT name, chrom, start_pos - 3000, start_pos + 3000, 'left' FROM v_sv WHERE end_pos - start_pos >= {SPLIT}
  UNION ALL SELECT name, chrom, end_pos - 3000, end_pos + 3000, 'right' FROM v_sv WHERE end_pos - start_pos >= {SPLIT})
SELECT w.name, w.part, c.s, e.kind, e.chrom, e.pos, CASE e.kind WHEN 'PE' THEN e.pos ELSE e.pos - 5 END AS "from", CASE e.kind WHEN 'PE' THEN e.pos2 ELSE e.pos + 5 END AS "to",
  CASE WHEN e.kind = 'PE' AND strand = '+' OR e.kind = 'SR' AND side = 'right' THEN '255,0,0' WHEN e.kind = 'PE' THEN '0,255,0' ELSE '0,0,255' END AS colour
FROM w JOIN v_sv_carriers c USING (name) JOIN v_evidence e ON e.chrom = w.chrom AND e.s = c.s AND e.pos > w.a AND e.pos <= w.b WHERE e.kind = 'SR' OR e.chrom = e.chrom2""", "v_sv", "v_sv_carriers", "v_evidence")
def j23_evidence_in_roi(spark, d):
    calls = _sv(spark, d)
    windows = sv.roi_windows(calls, split=SPLIT).join(sv.carriers(calls).select("name", "s"), "name")
    return evidence.evidence_in_roi(windows, V.view(spark, d, "v_evidence"))


_ROLES = """kid AS (SELECT * FROM v_quads WHERE paternal_id IS NOT NULL),
ro AS (SELECT sample_id AS proband, sample_id AS s, 'p1' AS role FROM kid UNION ALL SELECT sample_id, paternal_id, 'fa' FROM kid UNION ALL SELECT sample_id, maternal_id, 'mo' FROM kid
  UNION ALL SELECT a.sample_id, b.sample_id, 's1' FROM kid a JOIN kid b ON a.paternal_id = b.paternal_id AND a.maternal_id = b.maternal_id AND a.sample_id <> b.sample_id)"""


@query(f"""WITH {_DEPTH}, {_ROLES},
kd AS (SELECT name, chrom IN ('chrX', 'chrY') AS sexed, CAST(substr(name, 2) AS INT) % 2 = 0 AS is_del FROM v_regions),
q AS MATERIALIZED (SELECT name, s, CASE WHEN sexed THEN sex ELSE 0 END AS grp, is_del, CAST(substr(s, 2) AS INT) % 5 = 0 AS own, quantile_cont(depth, 0.5) AS m FROM dp JOIN kd USING (name) JOIN v_quads ON sample_id = s GROUP BY ALL HAVING m IS NOT NULL),
r AS (SELECT *, rank() OVER (PARTITION BY name, grp ORDER BY m) + (count(*) OVER (PARTITION BY name, grp, m) - 1) / 2 AS rk, count(*) OVER (PARTITION BY name, grp) AS n FROM q),
c AS (SELECT a.name, a.proband, a.s, count(*) AS n_controls, avg(b.m) AS mean, stddev_samp(b.m) AS sd, quantile_cont(b.m, 0.5) AS mid FROM (SELECT * FROM q JOIN ro USING (s)) a JOIN q b ON b.name = a.name AND b.grp = a.grp AND NOT b.own
  AND NOT EXISTS (SELECT 1 FROM ro f WHERE f.proband = a.proband AND f.s = b.s) GROUP BY a.name, a.proband, a.s)
SELECT name, proband, s, role, n_controls, round(m, 6) AS m, round((m - mean) / nullif(sd, 0), 5) AS z, CASE WHEN is_del THEN rk ELSE n - rk + 1 END AS rank, round(CASE WHEN is_del THEN mid - m ELSE m - mid END, 6) AS separation
FROM r JOIN ro USING (s) JOIN c USING (name, proband, s)""", "v_regions", "v_coverage", "v_quads")
def m22_family_depth(spark, d):
    rows, own = _depth(spark, d)
    kinds = _calls(spark, d).select("name", "chrom", F.when(F.substring("name", 2, 9).cast("int") % 2 == 0, "DEL").otherwise("DUP").alias("svtype"))
    out = depth.family_depth(rows, own, V.view(spark, d, "v_quads"), kinds).where("n_controls > 0")
    return out.select("name", "proband", "s", "role", "n_controls", F.round("m", 6).alias("m"), F.round("z", 5).alias("z"), "rank", F.round("separation", 6).alias("separation"))


def _curated(spark: SparkSession, d: str, kind: str) -> DataFrame:
    return V.view(spark, d, "v_curated").where(F.col("kind") == kind).withColumnsRenamed({"start_pos": "start", "end_pos": "end"})


_FLAGS = ("is_mosaic", "is_mosaic_manual", "is_tloc", "is_tloc_manual", "is_GD", "is_GD_manual", "is_aneuploidy")
_FALSE = ", ".join("false" for _ in _FLAGS)


@query(f"""WITH k AS MATERIALIZED (SELECT concat(v.name, '|', c.s) AS name, c.s, v.chrom, start_pos, end_pos, svtype, chrom2, pos2, svtype = 'CPX' AS cpx FROM v_sv v JOIN v_sv_carriers c USING (name) LEFT JOIN v_sv_ends USING (name)),
hand AS (SELECT name FROM k WHERE name LIKE '%_6|%' AND svtype = 'DUP'),
iv AS MATERIALIZED (SELECT DISTINCT e.kind, e.event, k.name FROM v_curated e JOIN k ON k.s = e.s AND k.chrom = e.chrom AND e.start_pos < k.end_pos AND k.start_pos < e.end_pos WHERE e.kind <> 'tloc'),
te AS (SELECT event, s, svtype, CASE WHEN turned THEN chrom2 ELSE chrom END AS c1, CASE WHEN turned THEN pos2 ELSE start_pos END AS p1, CASE WHEN turned THEN chrom ELSE chrom2 END AS c2, CASE WHEN turned THEN start_pos ELSE pos2 END AS p2, start_pos, end_pos, chrom FROM v_curated WHERE kind = 'tloc'),
tm AS MATERIALIZED (SELECT DISTINCT event, name FROM te JOIN k ON k.s = te.s AND ((k.chrom = c1 AND k.chrom2 = c2 AND abs(k.start_pos - p1) <= 1000 AND abs(k.pos2 - p2) <= 1000) OR (k.chrom = c2 AND k.chrom2 = c1 AND abs(k.start_pos - p2) <= 1000 AND abs(k.pos2 - p1) <= 1000))),
a0 AS (SELECT name, s, chrom, start_pos, end_pos, svtype, NULL AS result_final, cpx, name IN (SELECT name FROM iv WHERE kind = 'mosaic') OR name IN (SELECT name FROM hand) AS is_mosaic, false AS is_mosaic_manual,
  name IN (SELECT name FROM tm) AS is_tloc, false AS is_tloc_manual, name IN (SELECT name FROM iv WHERE kind = 'disorder') AS is_GD, false AS is_GD_manual FROM k
  UNION ALL SELECT event, s, chrom, start_pos, end_pos, svtype, 'yes', NULL, true, true, false, false, false, false FROM v_curated WHERE kind = 'mosaic' AND event NOT IN (SELECT event FROM iv)
  UNION ALL SELECT event, s, chrom, start_pos, end_pos, svtype, 'yes', NULL, false, false, true, true, false, false FROM te WHERE event NOT IN (SELECT event FROM tm)
  UNION ALL SELECT event, s, chrom, start_pos, end_pos, svtype, 'yes', NULL, false, false, false, false, true, true FROM v_curated WHERE kind = 'disorder' AND event NOT IN (SELECT event FROM iv)),
an AS (SELECT concat('A', s_suppkey) AS name, concat('S', s_suppkey * 3) AS s, concat('chr', s_suppkey % 22 + 1) AS chrom, CASE WHEN s_suppkey % 2 = 0 THEN 'DUP' ELSE 'DEL' END AS svtype FROM supplier),
a1 AS (SELECT *, false AS is_aneuploidy FROM a0 WHERE NOT EXISTS (SELECT 1 FROM an WHERE an.chrom = a0.chrom AND an.s = a0.s AND an.svtype = a0.svtype)
  UNION ALL SELECT name, s, chrom, NULL, NULL, svtype, 'yes', NULL, false, false, false, false, false, false, true FROM an),
a2 AS (SELECT * FROM a1 WHERE name NOT LIKE '%_7|%' UNION ALL SELECT concat('H', n_nationkey), concat('S', n_nationkey), 'chr1', CAST(100 * n_nationkey AS INT), CAST(100 * n_nationkey + 50 AS INT), 'DEL', 'yes', NULL, {_FALSE} FROM nation),
p AS (SELECT sample_id AS s, CAST(substr(sample_id, 2) AS INT) % 11 = 0 AS pe, CAST(substr(sample_id, 2) AS INT) % 17 = 0 AS sx FROM v_ped WHERE CAST(substr(sample_id, 2) AS INT) % 7 <> 3)
SELECT name, s, chrom, start_pos AS "start", end_pos AS "end", svtype, result_final, coalesce(cpx, false) AS is_highly_complex, {', '.join(_FLAGS)}, pe AS relatedness_error, sx AS sex_error, pe OR sx AS any_error FROM a2 JOIN p USING (s)""", "v_sv", "v_sv_carriers", "v_sv_ends", "v_curated", "v_ped")
def s8_curated_events(spark, d):
    c = F.col
    calls = sv.carriers(_sv(spark, d)).join(V.view(spark, d, "v_sv_ends"), "name", "left").withColumn("name", F.concat_ws("|", "name", "s"))
    calls = calls.select("name", "s", "chrom", "start", "end", "svtype", "chrom2", "pos2", F.when(c("svtype") != "INS", c("svtype") == "CPX").alias("is_highly_complex"), F.lit(None).cast("boolean").alias("is_unbalanced_tloc"))
    end = lambda a, b: F.when(c("turned"), c(b)).otherwise(c(a))
    tlocs = _curated(spark, d, "tloc").withColumns({"c1": end("chrom", "chrom2"), "p1": end("start", "pos2"), "c2": end("chrom2", "chrom"), "p2": end("pos2", "start"), "own": c("chrom")})
    tlocs = tlocs.select("event", "s", "start", "end", "svtype", c("c1").alias("chrom"), c("p1").alias("pos"), c("c2").alias("chrom2"), c("p2").alias("pos2"), "own")
    supplier, nation = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("supplier", "nation"))
    k = c("s_suppkey")
    odd = supplier.select(F.concat(F.lit("A"), k).alias("event"), F.concat(F.lit("S"), k * 3).alias("s"), F.concat(F.lit("chr"), k % 22 + 1).alias("chrom"), F.when(k % 2 == 0, "DUP").otherwise("DEL").alias("svtype"))
    n = c("n_nationkey")
    add = nation.select(F.concat(F.lit("H"), n).alias("name"), F.concat(F.lit("S"), n).alias("s"), F.lit("chr1").alias("chrom"), (100 * n).cast("int").alias("start"), (100 * n + 50).cast("int").alias("end"), F.lit("DEL").alias("svtype"), F.lit("yes").alias("result_final"))
    no = F.substring("sample_id", 2, 9).cast("int")
    samples = _ped(spark, d).where(no % 7 != 3).select(c("sample_id").alias("s"), (no % 11 == 0).alias("parental_error"), (no % 17 == 0).alias("sex_error"))
    out = curated.curate(calls, _curated(spark, d, "mosaic"), tlocs, _curated(spark, d, "disorder"), odd, calls.where("name LIKE '%_7|%'"), add, samples, calls.where("name LIKE '%_6|%' AND svtype = 'DUP'").select("name"))
    # a translocation's row stands at the end that the view names first
    out = out.join(tlocs.select(c("event").alias("name"), "own"), "name", "left").withColumn("chrom", F.coalesce("own", "chrom"))
    return out.select("name", "s", "chrom", "start", "end", "svtype", "result_final", "is_highly_complex", *_FLAGS, "relatedness_error", "sex_error", "any_error")
