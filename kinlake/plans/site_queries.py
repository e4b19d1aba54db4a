"""Queries on annotations, consequences, relatedness, burden, learning, sets and reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import csq as C
from ..functions import genotype as gt
from ..functions import text, variant
from ..operators import annotate, burden, clinical, denovo, learn, pairs, pedigree, qc, related, review, sets, trio
from ..sources import files
from . import scratch
from . import views as V
from .registry import query
from .trio_queries import _COUNTS, _G1, _MORE, _PBT, MENDEL, SITE, SNP, X_NON

COLUMNS = ["Allele", "Consequence", "IMPACT", "SYMBOL", "Feature", "BIOTYPE", "CANONICAL", "PolyPhen", "LoF"]


def _sites(spark: SparkSession, d: str) -> DataFrame:
    return V.view(spark, d, "v_sites")


def _ped(spark: SparkSession, d: str) -> DataFrame:
    return V.view(spark, d, "v_ped")


def _trios(spark: SparkSession, d: str, fields: list[str] = trio.ENTRY) -> DataFrame:
    return trio.trio_entries(V.entries(spark, d, families=True), pedigree.trio_list(_ped(spark, d)), fields=fields)


def _csq(spark: SparkSession, d: str) -> DataFrame:
    """Sites with decoded transcripts."""
    rows = V.view(spark, d, "v_csq").withColumn("texts", F.filter(F.array("csq1", "csq2"), lambda x: x.isNotNull()))
    return rows.withColumn("csq", C.decode(F.col("texts"), COLUMNS))


_TERMS = ", ".join(f"('{t}', {i})" for i, t in enumerate(C.ORDER))
#: Transcripts of v_csq as rows: place, fields, rank of the most severe term, score.
_TX = f"""o(term, r) AS (VALUES {_TERMS}), raw AS (SELECT site_id, contig, pos, ref, alt, 0 AS place, csq1 AS t FROM v_csq UNION ALL SELECT site_id, contig, pos, ref, alt, 1, csq2 FROM v_csq WHERE csq2 IS NOT NULL),
f AS (SELECT *, string_split(t, '|') AS x FROM raw), tx AS (SELECT *, x[2] AS terms, x[3] AS impact, x[4] AS symbol, x[5] AS feature, x[6] AS biotype, x[7] AS canonical, x[8] AS polyphen, (SELECT min(r) FROM o WHERE list_contains(string_split(f.x[2], '&'), o.term)) AS sev FROM f),
sc AS (SELECT *, CAST(CASE WHEN biotype <> 'protein_coding' THEN sev + 600 WHEN canonical <> 'YES' THEN sev + 500 WHEN contains(polyphen, 'probably_damaging') THEN sev - 0.5 WHEN contains(polyphen, 'possibly_damaging') THEN sev - 0.25 WHEN contains(polyphen, 'benign') THEN sev - 0.1 ELSE sev END AS DOUBLE) AS score,
  max(CASE WHEN canonical = 'YES' THEN 1 ELSE 0 END) OVER (PARTITION BY site_id) AS has FROM tx),
rk AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY score, place) AS n, min(score) OVER (PARTITION BY site_id) AS best FROM sc WHERE has = 0 OR canonical = 'YES')"""


@query("SELECT contig, pos, csq1 AS one, CASE WHEN csq2 IS NULL THEN csq1 ELSE concat(csq1, ',', csq2) END AS text, CASE WHEN csq2 IS NULL THEN 1 ELSE 2 END AS n FROM v_csq", "v_csq")
def f2_f3_csq_decode_encode(spark, d):
    rows = _csq(spark, d)
    back = C.encode(F.col("csq"), COLUMNS)
    return rows.select("contig", "pos", F.get(F.split(back, ","), F.lit(0)).alias("one"), back.alias("text"), F.size("csq").alias("n"))


@query(f"WITH {_TX} SELECT site_id, place, term AS most_severe FROM tx JOIN o ON o.r = tx.sev", "v_csq")
def f8_most_severe(spark, d):
    return _csq(spark, d).select("site_id", F.posexplode("csq").alias("place", "t")).select("site_id", "place", C.most_severe(F.col("t.Consequence")).alias("most_severe"))


@query(f"""WITH {_TX}, w AS (SELECT * FROM rk WHERE n = 1), g AS (SELECT site_id, string_agg(symbol, ',' ORDER BY symbol) AS genes FROM (SELECT DISTINCT site_id, symbol FROM rk WHERE score = best) GROUP BY site_id)
SELECT w.site_id, symbol AS worst_symbol, score AS worst_score, term AS most_severe, genes AS worst_genes, terms LIKE '%frameshift_variant%' OR terms LIKE '%stop_gained%' AS is_ptv, terms LIKE '%missense_variant%' AS is_mis, terms LIKE '%synonymous_variant%' AS is_syn, terms LIKE '%splice_region_variant%' AS is_srg,
term IN ('frameshift_variant', 'stop_gained', 'missense_variant', 'synonymous_variant', 'splice_region_variant', 'stop_lost', 'inframe_deletion') AS sii FROM w JOIN g USING (site_id) JOIN o ON o.r = w.sev""", "v_csq")
def g10_prioritize_csq(spark, d):
    out = clinical.prioritize_csq(_csq(spark, d))
    return out.select("site_id", F.col("worst.SYMBOL").alias("worst_symbol"), "worst_score", "most_severe", F.array_join(F.array_sort("worst_genes"), ",").alias("worst_genes"), F.col("isPTV").alias("is_ptv"), F.col("isMIS").alias("is_mis"), F.col("isSYN").alias("is_syn"), F.col("isSRG").alias("is_srg"), F.col("SII").alias("sii"))


@query(f"WITH {_TX}, g AS (SELECT *, row_number() OVER (PARTITION BY site_id, symbol ORDER BY score, place) AS k FROM rk) SELECT site_id, symbol, score, term AS most_severe FROM g JOIN o ON o.r = g.sev WHERE k = 1", "v_csq")
def w1_worst_per_gene(spark, d):
    return clinical.worst_per_gene(_csq(spark, d).select("site_id", "csq")).withColumnRenamed("SYMBOL", "symbol")


_KEEP = "canonical = 'YES' AND EXISTS (SELECT 1 FROM (SELECT unnest(string_split(terms, '&')) AS u) WHERE u NOT IN ('intergenic_variant', 'upstream_gene_variant', 'downstream_gene_variant', 'synonymous_variant', 'coding_sequence_variant', 'sequence_variant')) AND (impact IN ('HIGH', 'MODERATE') OR terms LIKE '%splice_region_variant%')"


def _transcripts(spark: SparkSession, d: str) -> DataFrame:
    """Sites with transcripts that also carry gene-level fields, as text."""
    n = F.substring("symbol", 7, 5).cast("int")
    more = F.struct(F.lit("").alias("MANE_PLUS_CLINICAL"), F.when(n % 5 == 0, "1").when(n % 5 == 1, "2").when(n % 5 == 2, "4").otherwise("").alias("OMIM_inheritance_code"), F.when(F.col("site_id") % 3 == 0, "").otherwise(F.concat(F.lit("0."), (F.col("site_id") % 10).cast("string"))).alias("am_pathogenicity"), F.when(F.col("site_id") % 4 == 0, "null").otherwise(F.concat(F.lit("0."), (F.col("site_id") % 7).cast("string"))).alias("LOEUF_v2"), F.lit("0.9").alias("LOEUF_v4"))
    rows = _csq(spark, d).join(_sites(spark, d).select("site_id", "symbol", "mpc", "gnomad_af"), "site_id")
    full = F.transform("csq", lambda t: F.struct(*[t[c].alias(c) for c in COLUMNS], *[more[c].alias(c) for c in ("MANE_PLUS_CLINICAL", "OMIM_inheritance_code", "am_pathogenicity", "LOEUF_v2", "LOEUF_v4")]))
    return rows.withColumn("csq", full).withColumnsRenamed({"mpc": "MPC", "gnomad_af": "gnomad_popmax_af"})


@query(f"WITH {_TX} SELECT site_id, symbol, terms FROM tx WHERE {_KEEP}", "v_csq")
def p20_csq_filter(spark, d):
    return clinical.csq_filter(_transcripts(spark, d)).select("site_id", F.col("csq.SYMBOL").alias("symbol"), F.array_join("csq.Consequence", "&").alias("terms"))


_GENE = f"""WITH {_TX}, k AS (SELECT tx.*, s.mpc, s.gnomad_af, CASE CAST(substr(s.symbol, 7) AS INT) % 5 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '4' ELSE '' END AS code, CASE WHEN site_id % 3 = 0 THEN 1.0 ELSE site_id % 10 / 10.0 END AS am, CASE WHEN site_id % 4 = 0 THEN 0.0 ELSE site_id % 7 / 10.0 END AS l2
FROM tx JOIN (SELECT site_id, symbol, mpc, gnomad_af FROM v_sites) s USING (site_id) WHERE {_KEEP})"""
_DMG = "(mpc >= 2.0 OR mpc IS NULL OR am >= 0.56)"


@query(f"{_GENE} SELECT site_id, place FROM k WHERE code = '2' OR (code = '4' AND contig = 'chrX') OR (code = '' AND (gnomad_af <= 0.01 OR gnomad_af IS NULL) AND {_DMG})", "v_csq")
def p21_omim_recessive(spark, d):
    rows = _transcripts(spark, d).withColumn("csq", F.transform("csq", lambda t, i: t.withField("place", i)))
    return clinical.omim_recessive(clinical.csq_filter(rows)).select("site_id", F.col("csq.place").alias("place"))


@query(f"{_GENE} SELECT site_id, place FROM k WHERE (gnomad_af <= 0.001 OR gnomad_af IS NULL) AND (code = '1' OR (code = '' AND {_DMG} AND l2 <= 0.35))", "v_csq")
def p22_omim_dominant(spark, d):
    rows = _transcripts(spark, d).withColumn("csq", F.transform("csq", lambda t, i: t.withField("place", i)))
    return clinical.omim_dominant(clinical.csq_filter(rows)).select("site_id", F.col("csq.place").alias("place"))


@query("SELECT site_id, greatest(gnomad_af, mpc / 100) AS popmax FROM v_sites WHERE greatest(gnomad_af, mpc / 100) <= 0.02 OR (gnomad_af IS NULL AND mpc IS NULL)", "v_sites")
def p18_popmax(spark, d):
    rows = _sites(spark, d).withColumns({"gnomADe_AF": F.col("gnomad_af").cast("string"), "gnomADg_AF": F.coalesce((F.col("mpc") / 100).cast("string"), F.lit("."))})
    out = rows.withColumn("gnomad_popmax_af", clinical.popmax_af(["gnomADe_AF", "gnomADg_AF"]))
    return clinical.popmax_filter(out, 0.02).select("site_id", F.col("gnomad_popmax_af").alias("popmax"))


@query("SELECT site_id FROM v_sites WHERE site_id % 6 IN (0, 1, 4, 5)", "v_sites")
def p19_clinvar(spark, d):
    k = F.col("site_id") % 6
    sig = F.when(k == 0, F.array(F.lit("Pathogenic"))).when(k == 1, F.array(F.lit("Uncertain"), F.lit("Likely_pathogenic"))).when(k == 2, F.array(F.lit("Benign"))).when(k == 3, F.array(F.lit("Likely_benign")))
    return clinical.clinvar_filter(_sites(spark, d).withColumn("CLNSIG", sig), keep_pathogenic=False).select("site_id")


def _coding(spark: SparkSession, d: str) -> DataFrame:
    out = clinical.prioritize_csq(_csq(spark, d)).select(*gt.KEY, "site_id", F.col("worst.SYMBOL").alias("SYMBOL"), "worst_score", "isPTV", "isMIS", "isSYN", F.coalesce("isCoding", F.lit(False)).alias("isCoding"))
    calls = denovo.flatten_trio(denovo.denovo_by_gt(_trios(spark, d))).select(*gt.KEY, "VarKey", "SAMPLE")
    return calls.join(out, gt.KEY)


_CODING = "'coding_sequence_variant', 'frameshift_variant', 'inframe_deletion', 'inframe_insertion', 'missense_variant', 'stop_gained', 'stop_lost', 'synonymous_variant'"
_DN = f"""{_TX}, w AS (SELECT *, EXISTS (SELECT 1 FROM (SELECT unnest(string_split(terms, '&')) AS u) WHERE u IN ({_CODING})) AS coding FROM rk WHERE n = 1), dn AS (SELECT w.*, proband, concat(w.contig, ':', w.pos, ':', w.ref, ':', w.alt, ':', proband) AS varkey FROM w JOIN v_trios t ON t.contig = w.contig AND t.pos = w.pos AND t.ref = w.ref AND t.alt = w.alt WHERE kid_n = 1 AND dad_n = 0 AND mom_n = 0)"""


@query(f"WITH {_DN} SELECT varkey, symbol FROM (SELECT *, row_number() OVER (PARTITION BY proband, symbol, coding ORDER BY score DESC, varkey) AS k FROM dn) WHERE NOT coding OR k = 1", "v_csq", "v_trios")
def w2_top_per_gene(spark, d):
    return clinical.top_per_gene(_coding(spark, d), "worst_score").select(F.col("VarKey").alias("varkey"), F.col("SYMBOL").alias("symbol"))


@query(f"""WITH {_DN} SELECT symbol, phenotype, count(*) FILTER (terms LIKE '%frameshift_variant%' OR terms LIKE '%stop_gained%') AS ptv, count(*) FILTER (terms LIKE '%missense_variant%' AND mpc >= 2) AS misb, count(*) FILTER (terms LIKE '%missense_variant%' AND mpc >= 1 AND mpc < 2) AS misa, count(*) FILTER (terms LIKE '%synonymous_variant%') AS syn
FROM dn JOIN (SELECT site_id, mpc FROM v_sites) USING (site_id) JOIN v_ped ON sample_id = proband GROUP BY symbol, phenotype""", "v_csq", "v_trios", "v_ped")
def ag8_csq_counts(spark, d):
    rows = _coding(spark, d).join(_sites(spark, d).select("site_id", F.col("mpc").alias("MPC")), "site_id").join(_ped(spark, d), F.col("SAMPLE") == F.col("sample_id"))
    out = clinical.csq_counts(rows)
    return out.select(F.col("SYMBOL").alias("symbol"), "phenotype", F.col("PTV").alias("ptv"), F.col("MisB").alias("misb"), F.col("MisA").alias("misa"), F.col("SYN").alias("syn"))


@query(f"""WITH {_DN}, c AS (SELECT DISTINCT symbol AS gene, phenotype, varkey, unnest([CASE WHEN terms LIKE '%frameshift_variant%' OR terms LIKE '%stop_gained%' THEN 'isPTV' END, CASE WHEN terms LIKE '%missense_variant%' THEN 'isMIS' END, CASE WHEN terms LIKE '%synonymous_variant%' THEN 'isSYN' END]) AS class FROM dn JOIN v_ped ON sample_id = proband)
SELECT gene, class, phenotype, count(*) AS n FROM c WHERE class IS NOT NULL GROUP BY gene, class, phenotype""", "v_csq", "v_trios", "v_ped")
def ag22_phenotype_gene_counts(spark, d):
    rows = _coding(spark, d).join(_ped(spark, d), F.col("SAMPLE") == F.col("sample_id")).withColumnsRenamed({"SYMBOL": "genes", "VarKey": "varkey"})
    return burden.phenotype_gene_counts(rows, ["isPTV", "isMIS", "isSYN"])


@query("WITH t AS (SELECT contig, pos, ref, alt, min(mpc) AS mpc FROM (SELECT * FROM v_sites WHERE site_id % 3 <> 0 UNION ALL SELECT * FROM v_sites WHERE site_id % 3 = 1) GROUP BY ALL) SELECT s.contig, s.pos, t.mpc AS score FROM v_sites s LEFT JOIN t USING (contig, pos, ref, alt)".replace("GROUP BY ALL", "GROUP BY contig, pos, ref, alt"), "v_sites")
def j1_annotate_by_variant(spark, d):
    s = _sites(spark, d)
    table = s.where("site_id % 3 <> 0").unionByName(s.where("site_id % 3 = 1")).select(*gt.KEY, F.col("mpc").alias("score"))
    return annotate.annotate_by_variant(s.select(*gt.KEY), table, ["score"]).select("contig", "pos", "score")


@query("SELECT contig, pos FROM v_sites WHERE site_id % 4 = 0", "v_sites")
def j2_semi_join(spark, d):
    return annotate.semi_join_variants(_sites(spark, d), _sites(spark, d).where("site_id % 4 = 0")).select("contig", "pos")


@query("SELECT contig, pos FROM v_sites WHERE site_id % 4 <> 0", "v_sites")
def j3_anti_join(spark, d):
    return annotate.anti_join_variants(_sites(spark, d), _sites(spark, d).where("site_id % 4 = 0")).select("contig", "pos")


@query(f"WITH {_TX} SELECT site_id, place, CASE WHEN CAST(substr(symbol, 7) AS INT) % 2 = 0 THEN CAST(substr(symbol, 7) AS INT) / 10 END AS loeuf FROM tx", "v_csq")
def j10_annotate_csq(spark, d):
    n = F.substring("SYMBOL", 7, 5).cast("int")
    table = _csq(spark, d).select(F.explode("csq.SYMBOL").alias("SYMBOL")).distinct().where(n % 2 == 0).select(F.col("SYMBOL").alias("gene"), (n / 10).alias("loeuf"))
    out = annotate.annotate_csq_by(_csq(spark, d).select("site_id", "csq"), table, "SYMBOL", "gene", ["loeuf"])
    return out.select("site_id", F.posexplode("csq").alias("place", "r")).select("site_id", "place", F.col("r.loeuf").alias("loeuf"))


@query("SELECT site_id, CASE WHEN site_id % 3 = 0 THEN concat('A', site_id % 50, 'V') END AS pv, CASE WHEN site_id % 3 = 0 AND site_id % 50 < 25 THEN site_id % 50 / 50 END AS am FROM v_sites", "v_sites")
def j11_composite_lookup(spark, d):
    rows = _sites(spark, d).select("site_id", F.when(F.col("site_id") % 3 == 0, "A/V").otherwise("A").alias("Amino_acids"), (F.col("site_id") % 50).cast("string").alias("Protein_position")).withColumn("pv", annotate.protein_variant())
    table = rows.select("site_id", "pv", (F.col("site_id") % 50 / 50).alias("am")).where("pv is not null and site_id % 50 < 25")
    return annotate.annotate_by(rows.select("site_id", "pv"), table, ["site_id", "pv"], ["am"])


@query(f"WITH {_TX} SELECT site_id, min(CASE WHEN CAST(substr(symbol, 7) AS INT) % 2 = 0 THEN CAST(substr(symbol, 7) AS INT) / 10 END) AS loeuf FROM tx GROUP BY site_id", "v_csq")
def j12_min_gene_metric(spark, d):
    n = F.substring("gene", 7, 5).cast("int")
    rows = _csq(spark, d).select("site_id", F.col("csq.SYMBOL").alias("genes"))
    table = rows.select(F.explode("genes").alias("gene")).distinct().where(n % 2 == 0).select("gene", (n / 10).alias("loeuf"))
    return annotate.min_gene_metric(rows, "genes", table, "loeuf", ["site_id"]).select("site_id", "loeuf")


@query(f"WITH k AS (SELECT {SITE} FROM v_entries WHERE s IN (SELECT sample_id FROM v_ped WHERE sex = 1) INTERSECT SELECT {SITE} FROM v_entries WHERE s IN (SELECT sample_id FROM v_ped WHERE sex = 2)) SELECT contig, count(*) AS n FROM v_entries JOIN k USING ({SITE}) GROUP BY contig", "v_entries", "v_ped")
def j14_union_cols(spark, d):
    rows = qc.with_sex(V.entries(spark, d), _ped(spark, d))
    a, b = rows.where("not is_female").drop("is_female"), rows.where("is_female").drop("is_female")
    return annotate.union_cols(a, b).groupBy("contig").agg(F.count("*").alias("n"))


@query("SELECT contig, count(*) AS n, count(DISTINCT s) AS samples FROM v_entries GROUP BY contig", "v_entries")
def j15_merge_samples(spark, d):
    e = V.entries(spark, d)
    odd = F.substring("s", 2, 9).cast("int") % 2 == 1
    return annotate.merge_samples([e.where(odd), e.where(~odd)]).groupBy("contig").agg(F.count("*").alias("n"), F.countDistinct("s").alias("samples"))


@query(f"""WITH c AS (SELECT * FROM v_entries WHERE a1 + a2 > 0), b AS (SELECT contig, pos AS first, pos + 150 AS last, s, gq FROM v_entries WHERE a1 + a2 = 0),
g AS (SELECT x.{SITE.replace(', ', ', x.')}, b.s, arg_max(b.gq, CAST(b.first AS BIGINT) * 1000 + b.gq) AS gq FROM (SELECT DISTINCT {SITE} FROM c) x JOIN b ON b.contig = x.contig AND x.pos BETWEEN b.first AND b.last GROUP BY x.{SITE.replace(', ', ', x.')}, b.s)
SELECT contig, pos, s, a1 + a2 AS n, gq FROM c UNION ALL SELECT g.contig, g.pos, g.s, 0, g.gq FROM g WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.contig = g.contig AND c.pos = g.pos AND c.ref = g.ref AND c.alt = g.alt AND c.s = g.s)""", "v_entries")
def j16_densify(spark, d):
    e = V.entries(spark, d)
    blocks = e.where("a1 + a2 = 0").select("contig", "pos", (F.col("pos") + 150).alias("end"), "s", "GQ", "DP")
    return annotate.densify(e.where("a1 + a2 > 0"), blocks).select("contig", "pos", "s", (F.col("a1") + F.col("a2")).alias("n"), F.col("GQ").alias("gq"))


@query("SELECT contig, pos, least(site_id * 3000000, 2147483647) AS big FROM v_sites", "v_sites")
def j17_attach_site_info(spark, d):
    info = _sites(spark, d).select(*gt.KEY, (F.col("site_id") * 3_000_000).alias("big"))
    return annotate.attach_site_info(_sites(spark, d).select(*gt.KEY), info, ["big"]).select("contig", "pos", "big")


@query("SELECT site_id, site_id % 5 = 0 AS is_known FROM v_sites", "v_sites")
def j19_flag_member(spark, d):
    return annotate.flag_member(_sites(spark, d).select("site_id"), _sites(spark, d).where("site_id % 5 = 0"), "site_id", "is_known")


@query("SELECT site_id, site_id % 11 AS polyx FROM v_sites WHERE site_id % 2 = 0 UNION ALL SELECT site_id, NULL FROM v_sites WHERE site_id % 2 = 1", "v_sites")
def j25_attach_polyx(spark, d):
    table = _sites(spark, d).where("site_id % 2 = 0").select("site_id", (F.col("site_id") % 11).alias("polyx"))
    return annotate.annotate_by(_sites(spark, d).select("site_id"), table, ["site_id"], ["polyx"])


@query(f"WITH {_DN} SELECT varkey, symbol, score FROM dn", "v_csq", "v_trios")
def j26_merge_vep(spark, d):
    return _coding(spark, d).select(F.col("VarKey").alias("varkey"), F.col("SYMBOL").alias("symbol"), F.col("worst_score").alias("score"))


@query("WITH p AS (SELECT least(i, j) AS i, greatest(i, j) AS j, kin, ibd0, ibd1, ibd2 FROM v_kinship) SELECT i, j, kin, CASE WHEN kin < 0.1 THEN 'unrelated' WHEN kin < 0.19 THEN 'second degree relatives' WHEN kin BETWEEN 0.19 AND 0.4 AND ibd0 <= 0.2 AND ibd1 >= 0.75 AND ibd2 <= 0.125 THEN 'parent-child' WHEN kin BETWEEN 0.19 AND 0.4 AND ibd0 BETWEEN 0.2 AND 0.425 AND ibd1 BETWEEN 0.275 AND 0.75 AND ibd2 BETWEEN 0.1 AND 0.5 THEN 'siblings' WHEN ibd0 <= 0.2 AND ibd1 BETWEEN -0.15 AND 0.1 AND ibd2 BETWEEN 0.75 AND 1.25 THEN 'duplicate/twins' ELSE 'ambiguous' END AS class FROM p", "v_kinship")
def g26_j21_relationship(spark, d):
    rel = related.orient_pairs(V.view(spark, d, "v_kinship"))
    return rel.select("i", "j", "kin", related.relationship(F.col("kin"), F.col("ibd0"), F.col("ibd1"), F.col("ibd2")).alias("class"))


_CLASS = """CASE WHEN kin < 0.1 THEN 'unrelated' WHEN kin < 0.19 THEN 'second degree relatives' WHEN kin BETWEEN 0.19 AND 0.4 AND ibd0 <= 0.2 AND ibd1 >= 0.75 AND ibd2 <= 0.125 THEN 'parent-child' WHEN kin BETWEEN 0.19 AND 0.4 AND ibd0 BETWEEN 0.2 AND 0.425 AND ibd1 BETWEEN 0.275 AND 0.75 AND ibd2 BETWEEN 0.1 AND 0.5 THEN 'siblings'
  WHEN ibd0 <= 0.2 AND ibd1 BETWEEN -0.15 AND 0.1 AND ibd2 BETWEEN 0.75 AND 1.25 THEN 'duplicate/twins' ELSE 'ambiguous' END"""


_EXPECTED = """x AS (SELECT a.sample_id AS i, b.sample_id AS j, CASE
  WHEN a.paternal_id = b.sample_id OR a.maternal_id = b.sample_id OR b.paternal_id = a.sample_id OR b.maternal_id = a.sample_id THEN 'parent-child'
  WHEN a.paternal_id = b.paternal_id AND a.maternal_id = b.maternal_id THEN 'siblings' ELSE 'related_other' END AS expected
  FROM v_ped a JOIN v_ped b ON a.family_id = b.family_id AND a.sample_id < b.sample_id
  WHERE NOT EXISTS (SELECT 1 FROM v_ped k WHERE least(k.paternal_id, k.maternal_id) = a.sample_id AND greatest(k.paternal_id, k.maternal_id) = b.sample_id)),
r AS (SELECT i, j, coalesce(expected, 'unrelated') AS expected, coalesce(inferred, 'unrelated') AS inferred, kin FROM x FULL JOIN c USING (i, j))"""


@query(f"""WITH c AS (SELECT least(i, j) AS i, greatest(i, j) AS j, kin, {_CLASS} AS inferred FROM v_kinship), {_EXPECTED}
SELECT i, j, expected, kin, inferred, expected = inferred AS agrees FROM r WHERE expected <> 'unrelated' OR inferred <> 'unrelated'""", "v_kinship", "v_ped")
def g27_relationship_report(spark, d):
    return related.relationship_report(V.view(spark, d, "v_kinship"), _ped(spark, d))


#: Kinship and shares identical by descent with one component, pair by pair.
_PC_RELATE = f"""e AS MATERIALIZED (SELECT {SITE}, s, (a1 + a2)::DOUBLE AS g FROM v_entries WHERE a1 IS NOT NULL),
sc AS (SELECT s, coalesce(count(*) FILTER (g = 1) / nullif(count(*) FILTER (g = 2), 0), 0) - 2 AS v FROM e GROUP BY s),
m AS (SELECT {SITE}, count(*) AS n, sum(g) AS sg, sum(v) AS sv, sum(v * v) AS vv, sum(v * g) AS vg FROM e JOIN sc USING (s) GROUP BY ALL),
b AS (SELECT {SITE}, n, sg, sv, CASE WHEN vv > 0 AND (vv - sv * sv / n) / vv > 1e-9 THEN (vg - sv * sg / n) / (vv - sv * sv / n) ELSE 0 END AS slope FROM m),
mu AS (SELECT {SITE}, s, g, ((sg - slope * sv) / n + slope * v) / 2 AS mu FROM e JOIN sc USING (s) JOIN b USING ({SITE})),
q AS MATERIALIZED (SELECT {SITE}, s, g, mu, mu * (1 - mu) AS v, g - 2 * mu AS r, CASE g WHEN 0 THEN mu WHEN 2 THEN 1 - mu ELSE 0 END AS d FROM mu WHERE mu BETWEEN 0.01 AND 0.99),
f AS (SELECT s, 2 * sum(r * r) / (4 * sum(v)) AS f FROM q GROUP BY s),
z AS (SELECT a.s AS i, b.s AS j, count(*) AS n_sites, sum(a.r * b.r) / (4 * sum(sqrt(a.v * b.v))) AS kin,
  sum((a.d - a.v * fa.f) * (b.d - b.v * fb.f)) / sum(a.v * b.v) AS ibd2,
  count(*) FILTER (abs(a.g - b.g) = 2) / sum(pow(a.mu * (1 - b.mu), 2) + pow((1 - a.mu) * b.mu, 2)) AS ibs0
  FROM q a JOIN q b USING ({SITE}) JOIN f fa ON fa.s = a.s JOIN f fb ON fb.s = b.s WHERE a.s < b.s GROUP BY a.s, b.s),
y AS (SELECT i, j, n_sites, kin, ibd2, CASE WHEN kin > pow(2, -2.5) THEN 1 - 4 * kin + ibd2 ELSE ibs0 END AS ibd0 FROM z),
pr AS (SELECT i, j, n_sites, kin, ibd0, 1 - ibd0 - ibd2 AS ibd1, ibd2 FROM y)"""


def _pc_relate(spark: SparkSession, d: str) -> DataFrame:
    scores = _scores(spark, d).select("s", F.array(F.col("pc1") - 2).alias("scores"))
    return pairs.pc_relate(V.entries(spark, d), scores, 1)


@query(f"WITH {_PC_RELATE} SELECT i, j, n_sites, round(kin + 1e-9, 6) AS kin, round(ibd0 + 1e-9, 6) AS ibd0, round(ibd1 + 1e-9, 6) AS ibd1, round(ibd2 + 1e-9, 6) AS ibd2 FROM pr", "v_entries")
def m12_pc_relate(spark, d):
    # ties of the sixth place are moved off, so that both engines round alike
    return _pc_relate(spark, d).select("i", "j", "n_sites", *[F.round(F.col(c) + 1e-9, 6).alias(c) for c in ("kin", "ibd0", "ibd1", "ibd2")])


@query(f"WITH {_PC_RELATE}, c AS (SELECT i, j, round(kin + 1e-9, 6) AS kin, {_CLASS} AS inferred FROM pr), {_EXPECTED} SELECT i, j, expected, kin, inferred, expected = inferred AS agrees FROM r WHERE expected <> 'unrelated' OR inferred <> 'unrelated'", "v_entries", "v_ped")
def g27_pc_relate_report(spark, d):
    out = related.relationship_report(_pc_relate(spark, d), _ped(spark, d), oriented=True)
    return out.select("i", "j", "expected", F.round(F.col("kin") + 1e-9, 6).alias("kin"), "inferred", "agrees")


@query("WITH x AS (SELECT contig, pos, s, a1 + a2 AS n FROM v_entries), m AS (SELECT a.s AS i, b.s AS j, a.n AS ni, b.n AS nj FROM x a JOIN x b USING (contig, pos) WHERE a.s < b.s AND (a.n > 0 OR b.n > 0)) SELECT i, j, count(*) FILTER (ni = 1 AND nj = 1) AS het_het, count(*) FILTER ((ni = 0 AND nj = 2) OR (ni = 2 AND nj = 0)) AS ibs0, (count(*) FILTER (ni = 1 AND nj = 1) - 2 * count(*) FILTER ((ni = 0 AND nj = 2) OR (ni = 2 AND nj = 0))) / nullif(count(*) FILTER (ni = 1) + count(*) FILTER (nj = 1), 0) AS kinship FROM m GROUP BY i, j", "v_entries")
def g28_king(spark, d):
    return pairs.king_pairs(V.entries(spark, d)).select("i", "j", "het_het", "ibs0", "kinship")


@query("WITH c AS (SELECT i, j, kin, CASE WHEN kin < 0.1 THEN 5 WHEN kin < 0.19 THEN 3 WHEN kin BETWEEN 0.19 AND 0.4 AND ibd0 <= 0.2 AND ibd1 >= 0.75 AND ibd2 <= 0.125 THEN 1 WHEN kin BETWEEN 0.19 AND 0.4 AND ibd0 BETWEEN 0.2 AND 0.425 AND ibd1 BETWEEN 0.275 AND 0.75 AND ibd2 BETWEEN 0.1 AND 0.5 THEN 2 WHEN ibd0 <= 0.2 AND ibd1 BETWEEN -0.15 AND 0.1 AND ibd2 BETWEEN 0.75 AND 1.25 THEN 0 ELSE 4 END AS r FROM v_kinship), b AS (SELECT i AS s, j AS other, kin, r FROM c UNION ALL SELECT j, i, kin, r FROM c) SELECT s, other, kin FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY r, kin DESC, other) AS k FROM b) WHERE k = 1", "v_kinship")
def w7_dedup_relatedness(spark, d):
    return related.dedup_relatedness(V.view(spark, d, "v_kinship")).select("s", "other", "kin")


def _rank_sql(c: str, ranks: dict[str, int]) -> str:
    return f"CASE {c} {' '.join(f"WHEN '{k}' THEN {v}" for k, v in ranks.items())} ELSE -1 END"


_PAIR_ORDER = f"""CASE WHEN ped_relationship = 'unrelated' THEN md5(concat(i, '|', j, '|', relationship)) END, {_rank_sql('ped_relationship', related.EXPECTED_RANK)} DESC, {_rank_sql('relationship', related.INFERRED_RANK)} DESC, kin DESC, i, j"""


@query(f"""SELECT i, j, kin, ped_relationship, relationship FROM (SELECT *, row_number() OVER (PARTITION BY least(i, j), greatest(i, j), ped_relationship = 'unrelated' ORDER BY {_PAIR_ORDER}) AS r FROM v_pair_rows) WHERE r = 1""", "v_pair_rows")
def w7_unique_pairs(spark, d):
    return related.unique_pairs(V.view(spark, d, "v_pair_rows"))


@query(f"""SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY CASE WHEN role IN ('Proband', 'Mother', 'Father') THEN 1 ELSE 0 END DESC,
  {_rank_sql('mother_status', related.INFERRED_RANK)} + {_rank_sql('father_status', related.INFERRED_RANK)} DESC, coalesce(mother_kin, 0) + coalesce(father_kin, 0) DESC, family_id) AS r FROM v_sample_rows) WHERE r = 1""", "v_sample_rows")
def w7_unique_samples(spark, d):
    return related.unique_samples(V.view(spark, d, "v_sample_rows"))


@query(f"SELECT * FROM (SELECT i, j, kin, ibd0, ibd1, ibd2, {_CLASS} AS class FROM v_kinship) WHERE class <> 'unrelated' OR substr(md5(concat(i, '|', j)), 1, 4) < '0ccc'", "v_kinship")
def t4_sample_pairs(spark, d):
    return related.sample_pairs(V.view(spark, d, "v_kinship"))


@query(f"""WITH RECURSIVE c AS (SELECT i, j FROM v_kinship WHERE {_CLASS} = 'duplicate/twins'), e AS (SELECT i, j FROM c UNION SELECT j, i FROM c), r AS (SELECT i AS s, i AS t FROM e UNION SELECT r.s, e.j FROM r JOIN e ON e.i = r.t),
g AS (SELECT s, min(t) AS root FROM r GROUP BY s), k AS (SELECT g.s, root, 4 - (CASE WHEN sex IN (1, 2) THEN 1 ELSE 0 END + CASE WHEN paternal_id IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN maternal_id IS NOT NULL THEN 1 ELSE 0 END) AS rank FROM g JOIN v_ped ON sample_id = g.s),
b AS (SELECT *, row_number() OVER (PARTITION BY root ORDER BY rank, s) AS n FROM k)
SELECT max(s) FILTER (n = 1) AS kept, string_agg(s, ',' ORDER BY s) FILTER (n > 1) AS filtered FROM b GROUP BY root""", "v_kinship", "v_ped")
def g27_duplicate_groups(spark, d):
    return related.duplicate_groups(V.view(spark, d, "v_kinship"), _ped(spark, d))


def _alleles(spark: SparkSession, d: str, entries: DataFrame | None = None) -> DataFrame:
    """One row a carried allele of children: gene, case or not."""
    e = (V.entries(spark, d) if entries is None else entries).where("a1 + a2 > 0").join(_sites(spark, d).select(*gt.KEY, "symbol", "transcript"), gt.KEY).join(_ped(spark, d), F.col("s") == F.col("sample_id"))
    return e.select(F.concat_ws(":", "contig", F.col("pos").cast("string"), "s").alias("allele"), F.col("transcript").alias("gene"), (F.col("phenotype") == 2).cast("int").alias("pheno"), F.when(F.col("sex") == 2, "F").otherwise("M").alias("grp"))


_ALL = f"al AS (SELECT transcript AS gene, CASE WHEN phenotype = 2 THEN 1 ELSE 0 END AS pheno, CASE WHEN sex = 2 THEN 'F' ELSE 'M' END AS grp FROM v_entries JOIN (SELECT {SITE}, transcript FROM v_sites) USING ({SITE}) JOIN v_ped ON s = sample_id WHERE a1 + a2 > 0)"


@query(f"""WITH {_ALL}, g AS (SELECT grp, gene, sum(pheno) AS y, count(*) AS n FROM al GROUP BY grp, gene), p AS (SELECT grp, sum(y) / sum(n) AS p0 FROM g GROUP BY grp),
u AS (SELECT grp, gene, n, p0, unnest(range(0, n + 1)) AS u FROM g JOIN p USING (grp)), v AS (SELECT grp, sum(power(power(u - n * p0, 2) - n * p0 * (1 - p0), 2) * exp(lgamma(n + 1.0) - lgamma(u + 1.0) - lgamma(n - u + 1.0) + u * ln(p0) + (n - u) * ln(1 - p0))) AS v FROM u WHERE p0 > 0 AND p0 < 1 GROUP BY grp),
t AS (SELECT grp, sum(power(y - n * p0, 2) - n * p0 * (1 - p0)) AS t, sum(y) AS case_alleles, count(*) AS n_genes FROM g JOIN p USING (grp) GROUP BY grp)
SELECT grp, round(t, 4) AS t, round(v / 1000, 2) AS v, case_alleles, n_genes FROM t JOIN v USING (grp)""", "v_entries", "v_sites", "v_ped")
def m14_c_alpha(spark, d):
    out = burden.c_alpha(_alleles(spark, d), ["grp"])
    return out.select("grp", F.round("t", 4).alias("t"), F.round(F.col("v") / 1000, 2).alias("v"), "case_alleles", "n_genes")


@query()
def m14_c_alpha_permutations(spark, d):
    entries = scratch.written(V.entries(spark, d).select(*gt.KEY, "s", *trio.CALL), "entries")
    trios = trio.trio_entries(entries, pedigree.trio_list(_ped(spark, d)), fields=trio.CALL, only=trio.may_be_new())
    new = denovo.denovo_by_gt(trios).select("contig", "pos", F.col("proband").alias("s"))
    return burden.c_alpha_permutations(_alleles(spark, d, entries.where("a1 + a2 > 0").join(new, ["contig", "pos", "s"])))


@query()
def m15_burden_classes(spark, d):
    rows = _coding(spark, d).join(_sites(spark, d).select("site_id", F.col("mpc").alias("MPC"), "transcript"), "site_id").join(_ped(spark, d), F.col("SAMPLE") == F.col("sample_id"))
    rows = rows.select(F.col("transcript").alias("gene"), F.col("phenotype").cast("int").alias("group"), "isSYN", "isPTV", "isMIS", "MPC")
    return burden.burden_classes(rows, {"2_vs_1": ([2], [1])})


_PTV, _MIS2 = "(terms LIKE '%frameshift_variant%' OR terms LIKE '%stop_gained%')", "(terms LIKE '%missense_variant%' AND s.mpc >= 2)"


@query(f"""WITH {_DN}, a AS (SELECT s.transcript AS gene, CASE WHEN phenotype = 2 THEN 1 ELSE 0 END AS pheno,
  unnest([CASE WHEN terms LIKE '%synonymous_variant%' THEN 'SYN' END, CASE WHEN {_PTV} THEN 'PTV' END, CASE WHEN {_MIS2} THEN 'MIS2' END, CASE WHEN {_PTV} OR {_MIS2} THEN 'DMG' END]) AS class
  FROM dn JOIN (SELECT site_id, transcript, mpc FROM v_sites) s ON s.site_id = dn.site_id JOIN v_ped ON sample_id = proband),
g AS (SELECT class, gene, sum(pheno) AS y, count(*) AS n FROM a WHERE class IS NOT NULL GROUP BY class, gene), p AS (SELECT class, sum(y) / sum(n) AS p0 FROM g GROUP BY class), u AS (SELECT class, n, p0, unnest(range(0, n + 1)) AS u FROM g JOIN p USING (class)),
v AS (SELECT class, sum(power(power(u - n * p0, 2) - n * p0 * (1 - p0), 2) * exp(lgamma(n + 1.0) - lgamma(u + 1.0) - lgamma(n - u + 1.0) + u * ln(p0) + (n - u) * ln(1 - p0))) AS v FROM u WHERE p0 > 0 AND p0 < 1 GROUP BY class)
SELECT '2_vs_1' AS comparison, class, round(sum(power(y - n * p0, 2) - n * p0 * (1 - p0)), 4) AS t, round(coalesce(max(v), 0), 3) AS v, sum(y) AS case_alleles, sum(n) AS alleles, count(*) AS n_genes
FROM g JOIN p USING (class) LEFT JOIN v USING (class) GROUP BY class""", "v_csq", "v_trios", "v_sites", "v_ped")
def m15_burden_statistics(spark, d):
    """m15_burden_classes without its p, which SQL has no function for."""
    return m15_burden_classes(spark, d).select("comparison", "class", F.round("t", 4).alias("t"), F.round("v", 3).alias("v"), "case_alleles", "alleles", "n_genes")


@query("SELECT family_id, sample_id, paternal_id, maternal_id, sex, phenotype FROM (SELECT *, row_number() OVER (PARTITION BY phenotype ORDER BY md5(concat('1', sample_id)), sample_id) AS r FROM v_ped) WHERE r <= (SELECT min(n) FROM (SELECT count(*) AS n FROM v_ped GROUP BY phenotype))", "v_ped")
def t3_balance_groups(spark, d):
    return burden.balance_groups(_ped(spark, d), "phenotype", "sample_id")


def _terms(spark: SparkSession, d: str) -> DataFrame:
    s = _sites(spark, d)
    return s.select(F.when(F.col("site_id") % 2 == 0, "BP").otherwise("MF").alias("ontology"), F.concat(F.lit("GO"), (F.col("site_id") % 12).cast("string")).alias("term"), F.col("transcript").alias("gene")).distinct()


@query("""WITH tm AS (SELECT DISTINCT CASE WHEN site_id % 2 = 0 THEN 'BP' ELSE 'MF' END AS ontology, concat('GO', site_id % 12) AS term, transcript AS gene FROM v_sites), l AS (SELECT DISTINCT transcript AS gene FROM v_sites WHERE site_id % 50 < 15),
b AS (SELECT ontology, count(DISTINCT gene) AS all_genes, count(DISTINCT term) AS n_terms FROM tm GROUP BY ontology), w AS (SELECT ontology, count(*) AS drawn FROM (SELECT DISTINCT ontology, gene FROM tm) JOIN l USING (gene) GROUP BY ontology),
t AS (SELECT ontology, term, count(*) AS size, count(l.gene) AS hits FROM tm LEFT JOIN l USING (gene) GROUP BY ontology, term),
x AS (SELECT ontology, term, sum(exp(lgamma(size + 1.0) - lgamma(i + 1.0) - lgamma(size - i + 1.0) + lgamma(all_genes - size + 1.0) - lgamma(drawn - i + 1.0) - lgamma(all_genes - size - drawn + i + 1.0) - lgamma(all_genes + 1.0) + lgamma(drawn + 1.0) + lgamma(all_genes - drawn + 1.0))) AS p
  FROM (SELECT *, unnest(range(greatest(hits, drawn - (all_genes - size), 0), least(size, drawn) + 1)) AS i FROM t JOIN b USING (ontology) JOIN w USING (ontology)) GROUP BY ontology, term)
SELECT ontology, term, size, hits, round(CASE WHEN hits = 0 THEN 1.0 ELSE least(1.0, p) END, 5) AS p FROM t JOIN x USING (ontology, term)""", "v_sites")
def m16_gene_set_enrichment(spark, d):
    genes = _sites(spark, d).where("site_id % 50 < 15").select(F.col("transcript").alias("gene")).distinct()
    return burden.gene_set_enrichment(genes, _terms(spark, d)).select("ontology", "term", "size", "hits", F.round("p", 5).alias("p"))


@query("""WITH tm AS (SELECT DISTINCT concat('GO', site_id % 12) AS term, transcript AS gene FROM v_sites), c AS (SELECT DISTINCT e.s, s.transcript AS gene, CASE WHEN p.phenotype = 2 THEN 1 ELSE 0 END AS k FROM v_entries e JOIN v_sites s ON s.contig = e.contig AND s.pos = e.pos JOIN v_ped p ON p.sample_id = e.s WHERE a1 = 1 AND a2 = 1),
h AS (SELECT DISTINCT term, s, k FROM c JOIN tm USING (gene)), n AS (SELECT count(*) FILTER (phenotype = 2) AS cases, count(*) FILTER (phenotype <> 2) AS controls FROM v_ped),
q AS (SELECT term, CAST(sum(k) AS BIGINT) AS a, CAST(cases - sum(k) AS BIGINT) AS b, CAST(count(*) - sum(k) AS BIGINT) AS c, CAST(controls - (count(*) - sum(k)) AS BIGINT) AS d FROM h, n GROUP BY term, cases, controls),
i AS (SELECT *, unnest(range(greatest(0, a - d), least(a + b, a + c) + 1)) AS x FROM q), r AS (SELECT *, exp(lgamma(a + b + 1.0) - lgamma(x + 1.0) - lgamma(a + b - x + 1.0) + lgamma(c + d + 1.0) - lgamma(a + c - x + 1.0) - lgamma(d - a + x + 1.0) - lgamma(a + b + c + d + 1.0) + lgamma(a + c + 1.0) + lgamma(b + d + 1.0)) AS px FROM i),
s AS (SELECT term, max(px) FILTER (x = a) AS seen FROM r GROUP BY term)
SELECT q.term, q.a, q.c, round(p, 5) AS p, q.a * q.d / nullif(q.b * q.c, 0) AS odds_ratio FROM q JOIN (SELECT term, least(1.0, sum(CASE WHEN px <= seen * (1 + 1e-7) THEN px ELSE 0 END)) AS p FROM r JOIN s USING (term) GROUP BY term) USING (term)""", "v_sites", "v_entries", "v_ped")
def m17_carrier_comparison(spark, d):
    e = V.entries(spark, d).where(gt.is_hom_var()).join(_sites(spark, d).select(*gt.KEY, "transcript"), gt.KEY).join(_ped(spark, d), F.col("s") == F.col("sample_id"))
    carriers = e.select("s", F.col("transcript").alias("gene"), F.when(F.col("phenotype") == 2, "case").otherwise("control").alias("group"))
    totals = _ped(spark, d).agg(F.sum((F.col("phenotype") == 2).cast("long")).alias("cases"), F.sum((F.col("phenotype") != 2).cast("long")).alias("controls"))
    out = burden.carrier_comparison(carriers, totals, _terms(spark, d))
    return out.select("term", "a", "c", F.round("p", 5).alias("p"), "odds_ratio")


_FEATURES = ["vqslod", "qd", "mq", "fs"]


def _scored(spark: SparkSession, d: str) -> DataFrame:
    """Features with a score that SQL can make too."""
    return V.view(spark, d, "v_features").withColumn("probability", F.least(F.col("qd") / 100 + F.col("label") * 0.1, F.lit(1.0)))


_SCORE = "sc AS (SELECT label, least(qd / 100 + label * 0.1, 1.0) AS p FROM v_features), th AS (SELECT unnest(range(0, 10)) AS k), cm AS (SELECT round(k * 0.05, 4) AS threshold, count(*) FILTER (label = 1 AND p >= round(k * 0.05, 4)) AS tp, count(*) FILTER (label = 1 AND p < round(k * 0.05, 4)) AS fn, count(*) FILTER (label = 0 AND p >= round(k * 0.05, 4)) AS fp, count(*) FILTER (label = 0 AND p < round(k * 0.05, 4)) AS tn FROM sc, th GROUP BY k)"


@query(f"WITH {_SCORE} SELECT threshold, tp, fn, fp, tn, (tp / (tp + fn) + tn / (tn + fp)) / 2 AS auc FROM cm", "v_features")
def m3_threshold_scan(spark, d):
    return learn.threshold_scan(_scored(spark, d)).select("threshold", "tp", "fn", "fp", "tn", "auc")


@query("SELECT tp, fn, fp, tn, fn / (fn + tn) AS false_omission, fp / (fp + tp) AS false_discovery FROM (SELECT count(*) FILTER (label = 1 AND qd > 25) AS tp, count(*) FILTER (label = 1 AND qd <= 25) AS fn, count(*) FILTER (label = 0 AND qd > 25) AS fp, count(*) FILTER (label = 0 AND qd <= 25) AS tn FROM v_features)", "v_features")
def m4_confusion(spark, d):
    return learn.confusion_metrics(V.view(spark, d, "v_features").withColumn("predicted", (F.col("qd") > 25).cast("int")))


@query("SELECT label, count(*) AS n, sum(qd) AS qd FROM v_features WHERE qd % 5 <> 0 GROUP BY label", "v_features")
def m6_pu_features(spark, d):
    rows = V.view(spark, d, "v_features").withColumn("qd", F.when(F.col("qd") % 5 != 0, F.col("qd")))
    out = learn.pu_features(rows.where("label = 1").drop("label"), rows.drop("label"), _FEATURES)
    return out.groupBy("label").agg(F.count("*").alias("n"), F.sum("qd").alias("qd"))


@query()
def m1_bagging_pu(spark, d):
    rows = V.view(spark, d, "v_features")
    models = learn.bagging_pu(rows, _FEATURES)
    return learn.pu_scores(models, rows, _FEATURES).select("varkey", "label", "probability")


@query()
def m2_out_of_fold(spark, d):
    return learn.out_of_fold(V.view(spark, d, "v_features"), _FEATURES, bags=1, trees=50).select("varkey", "label", "probability")


@query()
def m7_feature_importance(spark, d):
    rows = V.view(spark, d, "v_features")
    return learn.feature_importance(learn.bagging_pu(rows, _FEATURES, bags=2), _FEATURES, spark)


@query()
def m9_hwe_pca(spark, d):
    return learn.hwe_pca(V.entries(spark, d), k=2)[0].select("s", F.get("scores", F.lit(0)).alias("pc1"), F.get("scores", F.lit(1)).alias("pc2"))


@query(f"""WITH {_COUNTS}, l AS (SELECT {SITE}, ac / an AS p, (ac % 10 - 5) / 10.0 AS w FROM counts WHERE ac < an) SELECT s, round(sum((a1 + a2 - 2 * p) / sqrt(2 * p * (1 - p)) * w) / sqrt(count(*)), 6) AS pc1 FROM v_entries JOIN l USING ({SITE}) GROUP BY s""", "v_entries")
def m10_project_pcs(spark, d):
    table = qc.variant_qc(V.entries(spark, d)).where("AC < AN").select(*gt.KEY, F.col("AF").alias("pca_af"), F.array((F.col("AC") % 10 - 5) / 10.0).alias("loadings"))
    return learn.project_pcs(V.entries(spark, d), table, 1).withColumn("pc1", F.round("pc1", 6))


def _scores(spark: SparkSession, d: str) -> DataFrame:
    return qc.sample_qc(V.entries(spark, d)).select("s", F.coalesce("r_het_hom_var", F.lit(0.0)).alias("pc1"), F.coalesce("dp_mean", F.lit(0.0)).alias("pc2"))


@query()
def m11_assign_ancestry(spark, d):
    # two groups that lie apart on the first score, and what is between them
    pop = F.when(F.col("pc1") < 2, "popA").when(F.col("pc1") > 4, "popB")
    scores = scratch.written(_scores(spark, d), "scores")  # the fit reads its rows several times
    ref = scores.where(F.substring("s", 2, 9).cast("int") % 2 == 0).withColumn("pop", pop).where("pop is not null")
    return learn.assign_ancestry(ref, scores, ["pc1", "pc2"])


@query()
def m13_infer_platform(spark, d):
    regions = V.view(spark, d, "v_regions").withColumnsRenamed({"chrom": "contig", "start_pos": "start", "end_pos": "end"})
    return learn.infer_platform(qc.interval_callrate(V.entries(spark, d), regions), 3).select("s", "platform")


def _pbt(spark: SparkSession, d: str) -> DataFrame:
    """Phased calls of children that carry the allele, with gene and code; few enough to meet their sites."""
    genes = _sites(spark, d).select(*gt.KEY, F.col("transcript").alias("gene"), F.when(F.col("site_id") % 5 == 0, "4").otherwise("2").alias("omim_code"))
    return trio.phase_trios(_trios(spark, d, trio.CALL).where(trio.calls("kid") > 0)).join(genes, gt.KEY)


_P = f"""pb AS (SELECT t.*, transcript AS gene, CASE WHEN site_id % 5 = 0 THEN '4' ELSE '2' END AS code, CASE WHEN kid_n = 2 AND dad_n > 0 AND mom_n > 0 THEN '1|1' WHEN kid_n = 1 AND dad_n = 1 AND mom_n = 1 THEN NULL WHEN kid_n = 1 AND dad_n > 0 AND mom_n < 2 AND (dad_n = 2 OR mom_n = 0) THEN '1|0' WHEN kid_n = 1 AND mom_n > 0 AND dad_n < 2 AND (mom_n = 2 OR dad_n = 0) THEN '0|1' END AS pbt FROM v_trios t JOIN (SELECT {SITE}, transcript, site_id FROM v_sites) USING ({SITE}) WHERE kid_n > 0)"""
_AUTO = f"(NOT {X_NON} AND NOT (contig = 'chrY' AND NOT (pos BETWEEN 10001 AND 2781479)))"


@query(f"WITH {_P}, a AS (SELECT * FROM pb WHERE {_AUTO}), g AS (SELECT gene, proband FROM a WHERE pbt IS NOT NULL GROUP BY gene, proband HAVING count(DISTINCT pbt) > 1) SELECT {SITE}, gene, proband FROM a JOIN g USING (gene, proband)", "v_trios", "v_sites")
def g11_comp_het_trio(spark, d):
    return clinical.comp_het_trio(_pbt(spark, d)).select(*gt.KEY, "gene", "proband")


@query(f"WITH e AS (SELECT {SITE}, s, transcript AS gene FROM v_entries JOIN (SELECT {SITE}, transcript FROM v_sites) USING ({SITE}) JOIN v_ped ON s = sample_id WHERE paternal_id IS NULL AND a1 + a2 > 0 AND {_AUTO}), g AS (SELECT gene, s FROM e GROUP BY gene, s HAVING count(*) > 1) SELECT {SITE}, gene, s FROM e JOIN g USING (gene, s)", "v_entries", "v_sites", "v_ped")
def g12_comp_het_other(spark, d):
    parents = _ped(spark, d).where("paternal_id is null").select(F.col("sample_id").alias("s"))
    rows = V.entries(spark, d).join(parents, "s", "left_semi").join(_sites(spark, d).select(*gt.KEY, F.col("transcript").alias("gene")), gt.KEY)
    return clinical.comp_het_other(rows).select(*gt.KEY, "gene", "s")


@query(f"WITH {_P} SELECT {SITE}, proband, 'XLR' AS variant_category FROM pb WHERE (code = '4' OR contig = 'chrX') AND NOT is_female UNION ALL SELECT {SITE}, proband, 'hom_var' FROM pb WHERE kid_n = 2 AND NOT ({X_NON} AND NOT is_female)", "v_trios", "v_sites")
def g13_xlr_and_hom_var(spark, d):
    return clinical.xlr_and_hom_var(_pbt(spark, d)).select(*gt.KEY, "proband", "variant_category")


@query(f"WITH {_P} SELECT gene, proband, count(*) AS n FROM pb GROUP BY gene, proband", "v_trios", "v_sites")
def ag12_group_by_gene(spark, d):
    return clinical.group_by_gene(_pbt(spark, d)).select("gene", "proband", "n")


@query("SELECT site_id, CASE WHEN csq2 IS NULL THEN csq1 ELSE concat(csq1, ',', csq2) END AS text FROM v_csq", "v_csq")
def ag11_nest_csq(spark, d):
    rows = _csq(spark, d).select("site_id", F.posexplode("csq").alias("place", "csq"))
    return clinical.nest_csq(rows, ["site_id"], COLUMNS).select("site_id", F.col("CSQ").alias("text"))


@query(f"WITH {_P} SELECT {SITE}, proband FROM pb JOIN (SELECT {SITE}, site_id, gnomad_af FROM v_sites) USING ({SITE}) WHERE site_id % 6 < 2 AND (gnomad_af <= 0.005 OR gnomad_af IS NULL)", "v_trios", "v_sites")
def g15_clinvar_output(spark, d):
    k = F.col("site_id") % 6
    sites = _sites(spark, d).withColumns({"CLNSIG": F.when(k < 2, F.array(F.lit("Likely_pathogenic"))).when(k == 2, F.array(F.lit("Benign"))), "gnomad_popmax_af": F.col("gnomad_af")})
    kept = clinical.popmax_filter(clinical.clinvar_filter(sites), 0.005).select(*gt.KEY)
    return _pbt(spark, d).where(trio.calls("kid") > 0).join(kept, gt.KEY, "left_semi").select(*gt.KEY, "proband")


_OUT = f"""ph AS (SELECT *, {_PBT} AS pbt_gt, {MENDEL} AS mendel_code FROM ({_MORE}) WHERE coalesce(kid_n, 0) > 0 OR coalesce(dad_n, 0) > 0 OR coalesce(mom_n, 0) > 0),
oo AS (SELECT {SITE}, place, proband, pbt_gt, mendel_code, CASE pbt_gt WHEN '0|0' THEN 'uninherited' WHEN '0|1' THEN 'inherited_from_mother' WHEN '1|0' THEN 'inherited_from_father' WHEN '1|1' THEN 'inherited_from_both' END AS transmission
  FROM kept JOIN ph USING ({SITE}) JOIN (SELECT {SITE} FROM ph GROUP BY {SITE} HAVING count(kid_n) > 0) USING ({SITE}))"""


def _omim(spark: SparkSession, d: str, keep, category: str) -> DataFrame:
    rows = _transcripts(spark, d).withColumn("csq", F.transform("csq", lambda t, i: t.withField("place", i)))
    kept = keep(clinical.csq_filter(rows)).select(*gt.KEY, F.col("csq.place").alias("place"))
    return clinical.omim_output(kept, _trios(spark, d), category).select(*gt.KEY, "place", "proband", "pbt_gt", "mendel_code", "transmission", "variant_category")


@query(f"""{_GENE}, kept AS (SELECT {SITE}, place FROM k WHERE code = '2' OR (code = '4' AND contig = 'chrX') OR (code = '' AND (gnomad_af <= 0.01 OR gnomad_af IS NULL) AND {_DMG})), {_OUT}
SELECT *, 'OMIM_recessive' AS variant_category FROM oo""", "v_csq", "v_trios", variants=("missing",))
def g15_recessive_output(spark, d):
    return _omim(spark, d, clinical.omim_recessive, "OMIM_recessive")


@query(f"""{_GENE}, kept AS (SELECT {SITE}, place FROM k WHERE (gnomad_af <= 0.001 OR gnomad_af IS NULL) AND (code = '1' OR (code = '' AND {_DMG} AND l2 <= 0.35))), {_OUT}
SELECT *, 'OMIM_dominant' AS variant_category FROM oo""", "v_csq", "v_trios", variants=("missing",))
def g15_dominant_output(spark, d):
    return _omim(spark, d, clinical.omim_dominant, "OMIM_dominant")


def _flat(spark: SparkSession, d: str) -> DataFrame:
    """Trios that may hold a new allele, with AC, AN, AF and columns of their site; the entries are worked out and written once."""
    entries = scratch.written(V.entries(spark, d), "entries")
    trios = trio.trio_entries(entries, pedigree.trio_list(_ped(spark, d)), only=trio.may_be_new())
    return trios.join(qc.site_counts(entries), gt.KEY).join(_sites(spark, d).select(*gt.KEY, "site_id", "gnomad_af", "vqslod"), gt.KEY)


@query(f"""WITH {_COUNTS} SELECT concat(contig, ':', pos, ':', ref, ':', alt, ':', proband) AS varkey FROM v_trios JOIN counts USING ({SITE}) JOIN (SELECT {SITE}, site_id, gnomad_af FROM v_sites) USING ({SITE})
WHERE kid_n = 1 AND dad_n = 0 AND mom_n = 0 AND site_id % 13 <= 10 AND (ac <= 3 OR ac / an <= 0.4) AND kid_pl1 = 0 AND coalesce(gnomad_af, 0) <= 0.01 AND least(dad_gq, mom_gq) >= 40 AND greatest(dad_alt / (dad_ref + dad_alt), mom_alt / (mom_ref + mom_alt)) <= 0.1 AND least(dad_ref + dad_alt, mom_ref + mom_alt) >= 10""", "v_trios", "v_sites")
def p24_denovo_metric_filter(spark, d):
    flat = denovo.flatten_trio(denovo.denovo_by_gt(_flat(spark, d))).withColumn("POLYX", F.col("site_id") % 13)
    return denovo.denovo_metric_filter(flat, denovo.MetricConfig(af=0.4)).select(F.col("VarKey").alias("varkey"))


@query(_G1 + f"""SELECT {SITE}, proband, confidence FROM l JOIN (SELECT {SITE}, vqslod, gnomad_af FROM v_sites) USING ({SITE}) WHERE confidence <> 'LOW' AND (vqslod IS NULL OR vqslod > CASE WHEN {SNP} THEN -2.5 ELSE -1.5 END)
AND ac / an <= 0.4 AND (gnomad_af IS NULL OR gnomad_af <= 0.01) AND kid_alt >= 6""", "v_trios", "v_sites")
def p23_final_denovo_filter(spark, d):
    calls = denovo.denovo_posterior(_flat(spark, d))
    return denovo.final_denovo_filter(calls, cohort_af=0.4, gnomad_af=0.01).select(*gt.KEY, "proband", "confidence")


@query("SELECT contig, pos FROM v_sites WHERE site_id % 7 = 0", "v_sites")
def p27_keep_known(spark, d):
    return qc.keep_known(_sites(spark, d), _sites(spark, d).where("site_id % 7 = 0")).select("contig", "pos")


@query("SELECT proband, contig, pos FROM v_trios t WHERE kid_n = 1 AND kid_dp = kid_ref + kid_alt AND dad_dp = dad_ref + dad_alt AND mom_dp = mom_ref + mom_alt AND NOT EXISTS (SELECT 1 FROM v_regions r WHERE t.contig = r.chrom AND t.pos > r.start_pos AND t.pos <= r.end_pos)", "v_trios", "v_regions")
def p33_remove_regions(spark, d):
    from ..operators.interval import points_in

    regions = V.view(spark, d, "v_regions").withColumnsRenamed({"chrom": "contig", "start_pos": "start", "end_pos": "end"})
    flat = denovo.flatten_trio(_trios(spark, d).where(trio.calls("kid") == 1))
    same = F.lit(True)
    for m in ("sample", "father", "mother"):
        same = same & (F.col(f"DPC_{m}") == F.col(f"DP_{m}"))
    return points_in(flat.where(same), regions, keep=False).select("proband", "contig", "pos")


@query("SELECT DISTINCT concat('B', c_nationkey) AS batch, u.caller, u.file FROM customer, (VALUES ('manta'), ('wham')) c(caller), LATERAL (SELECT c.caller AS caller, concat(c.caller, '/', c_nationkey) AS file) u")
def p35_manifest(spark, d):
    wide = spark.read.parquet(f"{d}/customer.parquet").select(F.concat(F.lit("S"), "c_custkey").alias("s"), F.concat(F.lit("B"), "c_nationkey").alias("batch"), F.concat(F.lit("cov/"), "c_nationkey").alias("coverage_file"), F.concat(F.lit("manta/"), "c_nationkey").alias("manta"), F.concat(F.lit("wham/"), "c_nationkey").alias("wham"))
    return pedigree.manifest_tables(wide, ["manta", "wham"])["batch_files"]


@query("SELECT DISTINCT concat('B', c_nationkey) AS batch, concat('file', c_nationkey) AS file FROM customer JOIN v_ped ON sample_id = concat('S', c_custkey) WHERE family_id IN ('F1', 'F2', 'F3')", "v_ped")
def p36_batches_for_families(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet").select(F.concat(F.lit("S"), "c_custkey").alias("s"), F.concat(F.lit("B"), "c_nationkey").alias("batch"), F.concat(F.lit("file"), "c_nationkey").alias("file"))
    families = _ped(spark, d).where("family_id in ('F1', 'F2', 'F3')").select("family_id").distinct()
    return pedigree.batches_for_families(families, _ped(spark, d), c.select("s", "batch"), c.select("batch", "file").distinct()).select("batch", "file")


@query("WITH o AS (SELECT path, analyst, min(verdict) AS v FROM v_reviews GROUP BY path, analyst), g AS (SELECT path, string_agg(v, ',' ORDER BY analyst, v) AS verdicts, count(*) AS n_reviewers, CASE WHEN bool_and(v = 'yes') THEN 'yes' WHEN bool_and(v <> 'yes') THEN 'no_unsure' ELSE '' END AS c FROM o GROUP BY path) SELECT path, verdicts, n_reviewers, CASE WHEN path LIKE '%7' THEN 'yes' ELSE c END AS consensus FROM g", "v_reviews")
def ag16_review_consensus(spark, d):
    r = V.view(spark, d, "v_reviews")
    return review.review_consensus(r, r.where("path like '%7'").select("path", F.lit("yes").alias("verdict")).distinct())


@query("SELECT path, min(verdict) FILTER (analyst = 'analyst_user') AS analyst_user, min(verdict) FILTER (analyst = 'analyst_assistant') AS analyst_assistant FROM v_reviews GROUP BY path", "v_reviews")
def ag16_review_wide(spark, d):
    return review.review_wide(V.view(spark, d, "v_reviews"), ["analyst_user", "analyst_assistant"])


@query("SELECT name, s, phenotype = 2 AS parental_error, sex = 2 AS sex_error, phenotype = 2 OR sex = 2 AS any_error FROM v_sv_carriers JOIN v_ped ON s = sample_id", "v_sv_carriers", "v_ped")
def g24_sample_error_flags(spark, d):
    ids = lambda c: _ped(spark, d).where(c).select(F.col("sample_id").alias("s"))
    return review.sample_error_flags(V.view(spark, d, "v_sv_carriers"), ids("phenotype = 2"), ids("sex = 2"))


@query("SELECT site_id, CASE WHEN site_id % 3 = 0 THEN concat('ID', site_id % 50) WHEN site_id % 3 = 1 THEN transcript ELSE concat('N', substr(transcript, 2)) END AS gene_name FROM v_sites", "v_sites")
def f17_gene_names(spark, d):
    s = _sites(spark, d)
    by_id = s.where("site_id % 3 = 0").select((F.col("site_id") % 150).cast("string").alias("gene_id"), F.concat(F.lit("ID"), (F.col("site_id") % 50).cast("string")).alias("symbol")).distinct()
    rows = s.select("site_id", F.when(F.col("site_id") % 3 == 0, (F.col("site_id") % 150).cast("string")).alias("gene_id"), F.when(F.col("site_id") % 3 == 2, F.concat(F.lit("OLD"), F.substring("transcript", 2, 9))).otherwise(F.col("transcript")).alias("SYMBOL"))
    symbols = s.select(F.concat(F.lit("N"), F.substring("transcript", 2, 9)).alias("symbol"), F.array(F.concat(F.lit("OLD"), F.substring("transcript", 2, 9))).alias("previous")).distinct()
    return review.coalesce_gene_names(rows, by_id, symbols).select("site_id", "gene_name")


@query("SELECT site_id, CASE WHEN site_id % 2 = 0 THEN 'a' ELSE 'b' END AS src FROM v_sites", "v_sites")
def s1_union_distinct(spark, d):
    s = _sites(spark, d)
    return sets.union_distinct(s.where("site_id % 2 = 0").select("site_id", F.lit("a").alias("src")), s.select("site_id", F.lit("b").alias("src")), ["site_id"])


@query("SELECT s, count(*) AS n FROM (SELECT s FROM v_entries UNION ALL SELECT s FROM v_sv_carriers) WHERE s IN (SELECT s FROM v_entries INTERSECT SELECT s FROM v_sv_carriers) GROUP BY s", "v_entries", "v_sv_carriers")
def s2_union_shared_samples(spark, d):
    return sets.union_shared_samples(V.entries(spark, d), V.view(spark, d, "v_sv_carriers")).groupBy("s").agg(F.count("*").alias("n"))


@query("SELECT name, 'wes' AS data_type, 1 AS wes_x, NULL AS wgs_y FROM v_sv WHERE svtype = 'DEL' UNION ALL SELECT name, 'wgs', NULL, 2 FROM v_sv WHERE svtype = 'DUP'", "v_sv")
def s3_stack_call_sets(spark, d):
    v = V.view(spark, d, "v_sv")
    return sets.stack_call_sets({"wes": v.where("svtype = 'DEL'").select("name", F.lit(1).alias("x")), "wgs": v.where("svtype = 'DUP'").select("name", F.lit(2).alias("y"))}, ["name"])


_MULTI = "SELECT contig, pos, ref, alt FROM v_sites UNION ALL SELECT contig, pos, ref, concat(ref, 'GG') FROM v_sites WHERE site_id % 3 = 0 UNION ALL SELECT contig, pos, ref, alt FROM v_sites WHERE site_id % 2 = 0"


def _multi(spark: SparkSession, d: str) -> DataFrame:
    s = _sites(spark, d)
    return s.select(*gt.KEY).unionByName(s.where("site_id % 3 = 0").select("contig", "pos", "ref", F.concat("ref", F.lit("GG")).alias("alt"))).unionByName(s.where("site_id % 2 = 0").select(*gt.KEY))


@query(f"WITH m AS (SELECT DISTINCT * FROM ({_MULTI})) SELECT contig, pos, ref, string_agg(alt, ',' ORDER BY alt) AS alts FROM m GROUP BY contig, pos, ref", "v_sites")
def s9_join_multiallelic(spark, d):
    return sets.join_multiallelic(_multi(spark, d)).withColumn("alts", F.array_join("alts", ","))


@query(f"WITH m AS (SELECT DISTINCT * FROM ({_MULTI})) SELECT contig, pos, ref, alt, row_number() OVER (PARTITION BY contig, pos, ref ORDER BY alt) AS allele FROM m", "v_sites")
def s4_split_multiallelic(spark, d):
    return sets.split_multiallelic(sets.join_multiallelic(_multi(spark, d))).select(*gt.KEY, "allele")


@query("SELECT s FROM v_entries EXCEPT SELECT s FROM v_sv_carriers JOIN v_sv USING (name) WHERE svtype = 'CTX' AND filter <> 'PASS'", "v_entries", "v_sv", "v_sv_carriers")
def s5_names_only_in(spark, d):
    low = V.view(spark, d, "v_sv").where("svtype = 'CTX' AND filter <> 'PASS'").select("name")
    return sets.names_only_in(V.entries(spark, d), V.view(spark, d, "v_sv_carriers").join(low, "name"), "s")


@query("SELECT s FROM v_entries INTERSECT SELECT s FROM v_sv_carriers", "v_entries", "v_sv_carriers")
def s6_intersect(spark, d):
    return V.entries(spark, d).select("s").intersect(V.view(spark, d, "v_sv_carriers").select("s"))


@query("SELECT site_id, 'snv' AS kind FROM v_sites WHERE length(ref) = length(alt) UNION ALL SELECT site_id, 'indel' FROM v_sites WHERE length(ref) <> length(alt)", "v_sites")
def s7_s10_union_tables(spark, d):
    s = _sites(spark, d).withColumn("kind", F.when(variant.variant_type() == "SNV", "snv").otherwise("indel")).select("site_id", "kind")
    return annotate.merge_samples([s.where("kind = 'snv'"), s.where("kind = 'indel'")])


@query("SELECT contig, pos, ref, alt, row_number() OVER (ORDER BY CASE contig WHEN 'chrX' THEN 23 WHEN 'chrY' THEN 24 ELSE CAST(substr(contig, 4) AS INT) END, contig, pos, ref, alt) - 1 AS place FROM v_sites", "v_sites")
def t1_sort_variants(spark, d):
    rows = sets.sort_variants(_sites(spark, d).select(*gt.KEY))
    # places are counted over sorted partitions, as a check of the order
    return rows.withColumn("id", F.monotonically_increasing_id()).select(*gt.KEY, "id").transform(_places)


def _places(rows: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    part = F.shiftright("id", 33)
    sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own = rows.withColumn("part", part)
    return own.join(F.broadcast(sizes), "part").select(*gt.KEY, (F.col("before") + F.col("id") - F.shiftleft("part", 33)).alias("place"))


@query("""WITH r AS (SELECT proband, concat(t.contig, ':', t.pos, ':', t.ref, ':', t.alt, ':', proband) AS k, gnomad_af IS NOT NULL AND gnomad_af > 0.008 AS known FROM v_trios t JOIN v_sites USING (contig, pos, ref, alt) WHERE kid_n = 1 AND dad_n = 0 AND mom_n = 0),
z AS (SELECT count(*) FILTER (known) AS n, count(DISTINCT proband) FILTER (NOT known) AS m, 3 * count(*) // 4 AS total FROM r), o AS (SELECT r.*, row_number() OVER (PARTITION BY proband ORDER BY md5(k), k) AS rk FROM r WHERE NOT known)
SELECT proband AS "SAMPLE", k AS "VarKey", known FROM r WHERE known UNION ALL SELECT proband, k, known FROM o, z WHERE rk <= greatest(total - n, 0) // greatest(m, 1)""", "v_trios", "v_sites")
def t2_downsample(spark, d):
    trios = trio.trio_entries(V.entries(spark, d, families=True), pedigree.trio_list(_ped(spark, d)), only=trio.may_be_new())
    flat = denovo.flatten_trio(denovo.denovo_by_gt(trios).join(_sites(spark, d).select(*gt.KEY, "gnomad_af"), gt.KEY)).withColumn("known", F.coalesce(F.col("gnomad_af") > 0.008, F.lit(False)))
    flat = scratch.written(flat.select("SAMPLE", "VarKey", "known"), "flat")  # counted and read several times
    return sets.downsample(flat, 3 * flat.count() // 4, first="known").select("SAMPLE", "VarKey", "known")


@query("""WITH c AS (SELECT DISTINCT concat(g, '-', (rk - 1) // 40) AS chunk FROM (SELECT sample_id, substr(md5(sample_id), 1, 1) AS g, row_number() OVER (PARTITION BY substr(md5(sample_id), 1, 1) ORDER BY sample_id) AS rk FROM v_ped))
SELECT a.chunk AS a, b.chunk AS b FROM c a JOIN c b ON a.chunk <= b.chunk""", "v_ped")
def t5_chunk_pairs(spark, d):
    return sets.chunk_pairs(sets.chunk_ids(_ped(spark, d).select(F.col("sample_id").alias("s")), 40, digits=1))


@query("WITH a AS (SELECT proband, count(*) AS n FROM v_trios WHERE kid_n = 1 GROUP BY proband), b AS (SELECT proband, count(*) AS n FROM v_trios WHERE kid_n = 1 AND dad_n = 0 AND mom_n = 0 GROUP BY proband) SELECT 'het' AS step, count(*) AS n_trios, sum(n) AS n_variants, avg(n) AS mean, stddev_samp(n) AS sd FROM a UNION ALL SELECT 'denovo', count(*), sum(n), avg(n), stddev_samp(n) FROM b", "v_trios")
def ag10_step_stats(spark, d):
    t = _trios(spark, d).withColumnRenamed("proband", "SAMPLE")
    return sets.step_stats({"het": t.where(trio.calls("kid") == 1), "denovo": denovo.denovo_by_gt(t)})


@query("SELECT site_id, concat('AC=', site_id % 9, ';DB') AS info, CAST(site_id % 9 AS VARCHAR) AS ac, 1 AS n FROM v_sites", "v_sites")
def src2_parse_info(spark, d):
    rows = _sites(spark, d).select("site_id", F.concat(F.lit("AC="), (F.col("site_id") % 9).cast("string"), F.lit(";DB")).alias("info"))
    m = text.parse_info(F.col("info"))
    return rows.select("site_id", "info", F.element_at(m, "AC").alias("ac"), F.size(m).alias("n"))


@query("SELECT contig, pos, s, CAST(ad_alt AS VARCHAR) AS alt_reads, CASE WHEN ad_ref + ad_alt > 0 THEN ad_alt / (ad_ref + ad_alt) END AS ab, NULL AS gq FROM v_entries", "v_entries")
def src3_parse_format(spark, d):
    e = V.entries(spark, d).select("contig", "pos", "s", F.concat_ws(":", F.concat_ws("/", F.col("a1").cast("string"), F.col("a2").cast("string")), F.concat_ws(",", F.get("AD", F.lit(0)).cast("string"), F.get("AD", F.lit(1)).cast("string"))).alias("v"))
    m = text.parse_format(F.lit("GT:AD:GQ"), F.col("v"))
    reads = F.split(F.element_at(m, "AD"), ",")
    a, b = F.get(reads, F.lit(0)).cast("int"), F.get(reads, F.lit(1)).cast("int")
    return e.select("contig", "pos", "s", F.get(reads, F.lit(1)).alias("alt_reads"), gt.ratio(b, a + b).alias("ab"), F.element_at(m, "GQ").alias("gq"))


@query("SELECT site_id, contig AS c, pos AS p, ref AS r, alt AS a FROM v_sites", "v_sites")
def f4_parse_variant(spark, d):
    rows = _sites(spark, d).select("site_id", variant.variant_id().alias("id"))
    return rows.select("site_id", *[c.alias(n) for c, n in zip(variant.parse_variant("id"), "cpra", strict=True)])


@query("SELECT site_id, 3 AS n, 'b' AS second, CASE WHEN site_id % 3 = 0 THEN 7.0 WHEN site_id % 3 = 1 THEN NULL ELSE 1.5 END AS num FROM v_sites", "v_sites")
def f1_f5_f6_text(spark, d):
    rows = _sites(spark, d).select("site_id", text.parse_list(F.lit("['a', 'b', 'c']")).alias("l"), F.when(F.col("site_id") % 3 == 0, "").when(F.col("site_id") % 3 == 1, "x").otherwise("1.5").alias("t"))
    return rows.select("site_id", F.size("l").alias("n"), F.get("l", F.lit(1)).alias("second"), text.number("t", 7.0).alias("num"))


@query(f"SELECT {SITE}, s, least(pl0, pl2) AS p0, CASE WHEN pl1 < pl0 THEN pl1 ELSE pl0 END AS low FROM v_entries", "v_entries")
def f13_split_pl(spark, d):
    e = V.entries(spark, d)
    pl = lambda i: F.get("PL", F.lit(i))
    three = F.array(pl(0), pl(1), pl(2), pl(0), pl(1), pl(2))
    out = gt.split_pl(three, F.lit(2), 3)
    return e.select(*gt.KEY, "s", F.least(pl(0), F.get(out, F.lit(2))).alias("p0"), F.least(F.get(out, F.lit(1)), pl(0)).alias("low"))


@query("SELECT contig, s, sum(CASE WHEN a2 = 1 THEN 3 ELSE 0 END) AS g FROM v_entries GROUP BY contig, s", "v_entries")
def f14_local_alleles(spark, d):
    g = gt.global_alleles(F.array("a1", "a2"), F.array(F.lit(0), F.lit(3)))
    return V.entries(spark, d).groupBy("contig", "s").agg(F.sum(F.get(g, F.lit(1))).alias("g"))


@query("SELECT site_id, CASE WHEN site_id % 4 = 0 THEN CAST(site_id AS DOUBLE) ELSE 1.0 END AS v FROM v_sites", "v_sites")
def f12_allele_specific(spark, d):
    rows = _sites(spark, d).select("site_id", F.when(F.col("site_id") % 2 == 0, F.lit(1.0)).alias("QD"), F.when(F.col("site_id") % 4 == 0, F.array(F.col("site_id").cast("double"))).otherwise(F.array(F.lit(1.0))).alias("AS_QD"), F.lit(1).alias("allele"))
    return rows.select("site_id", files.chosen_field(rows, "QD", "AS_QD").alias("v"))


@query("SELECT contig, pos, qd, mq FROM v_sites s WHERE EXISTS (SELECT 1 FROM v_regions r WHERE s.contig = r.chrom AND s.pos > r.start_pos AND s.pos <= r.end_pos)", "v_sites", "v_regions")
def src13_extract_fields(spark, d):
    regions = V.view(spark, d, "v_regions").withColumnsRenamed({"chrom": "contig", "start_pos": "start", "end_pos": "end"})
    return files.extract_fields(_sites(spark, d), regions, ["contig", "pos", "qd", "mq"])


@query("SELECT concat(contig, chr(9), pos, chr(9), '.', chr(9), ref, chr(9), alt, chr(9), '.', chr(9), filter, chr(9), '.') AS value FROM v_sites", "v_sites")
def src8_sites_vcf(spark, d):
    return files.sites_vcf_lines(_sites(spark, d).drop("qual"))



# Files: a view is written as text and read back.


def _text(*columns: str) -> Column:
    return F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("0")) for c in columns])


@query("SELECT contig, pos, ref, alt, CASE WHEN qual IS NULL THEN 0 ELSE 1 END AS has_qual FROM v_sites", "v_sites")
def src1_vcf_sites(spark, d):
    path = scratch.folder(spark, "vcf")
    files.write_sites_vcf(_sites(spark, d).select(*gt.KEY, "qual"), path)
    return files.read_vcf_sites(spark, [f"{path}/header", f"{path}/body"]).select(*gt.KEY, F.col("qual").isNotNull().cast("int").alias("has_qual"))


_MEMBERS = ("kid", "dad", "mom")


@query(" UNION ALL ".join(f"SELECT contig, pos, ref, alt, '{m}' AS s, CASE WHEN {m}_n = 2 THEN 1 ELSE 0 END AS a1, CASE WHEN {m}_n > 0 THEN 1 ELSE 0 END AS a2, {m}_n % 2 = 1 AS phased, {m}_ref AS ad_ref, {m}_alt AS ad_alt, {m}_dp AS dp, {m}_gq AS gq, {m}_pl0 AS pl0, {m}_pl1 AS pl1, {m}_pl2 AS pl2 FROM v_trios" for m in _MEMBERS), "v_trios")
def src1_vcf_entries(spark, d):
    """Genotypes of all trios through VCF text: a line a trio and site with three samples, hets phased."""
    path = scratch.folder(spark, "entries")
    text = lambda c: F.coalesce(c.cast("string"), F.lit("."))
    call = lambda m: F.when(trio.calls(m) == 2, "1/1").when(trio.calls(m) == 1, "0|1").otherwise("0/0")
    both = lambda m, c, n: F.concat_ws(",", *[text(F.get(f"{m}.{c}", F.lit(k))) for k in range(n)])
    field = lambda m: F.concat_ws(":", call(m), both(m, "AD", 2), text(F.col(f"{m}.DP")), text(F.col(f"{m}.GQ")), both(m, "PL", 3))
    rows = _trios(spark, d)
    lines = rows.select(F.concat_ws("\t", "contig", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), F.lit("PASS"), F.lit("."), F.lit("GT:AD:DP:GQ:PL"), *[field(m) for m in _MEMBERS]).alias("value"))
    head = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *_MEMBERS])
    spark.createDataFrame([("##fileformat=VCFv4.2",), (head,)], "value string").coalesce(1).write.text(f"{path}/header")
    lines.write.text(f"{path}/body")
    out = files.read_vcf_entries(spark, [f"{path}/header", f"{path}/body"])
    parts = {"ad_ref": ("AD", 0), "ad_alt": ("AD", 1), "pl0": ("PL", 0), "pl1": ("PL", 1), "pl2": ("PL", 2)}
    return out.select("contig", "pos", "ref", F.col("alts")[0].alias("alt"), "s", "a1", "a2", "phased", F.col("DP").alias("dp"), F.col("GQ").alias("gq"), *[F.col(c)[i].alias(k) for k, (c, i) in parts.items()])


@query(f"SELECT {', '.join(gt.KEY)}, qual FROM v_sites", "v_sites")
def src7_merge_stores(spark, d):
    """Two stores, one of which lacks a column, read as one table."""
    paths = [scratch.folder(spark, "store") for _ in range(2)]
    rows = _sites(spark, d).select(*gt.KEY, "qual")
    files.save_table(rows.where("qual is not null"), paths[0])
    files.save_table(rows.where("qual is null").drop("qual"), paths[1])
    return files.merge_stores(spark, paths).select(*gt.KEY, "qual")


@query('SELECT name, chrom AS contig, start_pos AS "start", end_pos AS "end" FROM v_regions', "v_regions")
def src4_bed(spark, d):
    path = scratch.folder(spark, "bed")
    rows = V.view(spark, d, "v_regions").select(_text("chrom", "start_pos", "end_pos", "name").alias("value"))
    rows.unionByName(spark.createDataFrame([("chrom\tstart\tend\tname",)], "value string")).write.text(path)
    return files.read_bed(spark, path).select("name", "contig", "start", "end")


@query("SELECT family_id, sample_id, paternal_id, maternal_id, sex, phenotype FROM v_ped", "v_ped")
def src5_ped(spark, d):
    path = scratch.folder(spark, "ped")
    _ped(spark, d).select(_text("family_id", "sample_id", "paternal_id", "maternal_id", "sex", "phenotype").alias("value")).write.text(path)
    return files.read_ped(spark, path)


@query("SELECT contig, CAST(pos AS VARCHAR) AS pos, ref, NULL AS alt FROM v_sites WHERE length(alt) = 1 UNION ALL SELECT contig, CAST(pos AS VARCHAR), ref, alt FROM v_sites WHERE length(alt) > 1", "v_sites")
def src6_tsvs(spark, d):
    one, two = scratch.folder(spark, "tsv"), scratch.folder(spark, "tsv")
    files.write_sharded(_sites(spark, d).where("length(alt) = 1").select("contig", "pos", "ref"), one, shards=3)
    files.write_sharded(_sites(spark, d).where("length(alt) > 1").select("alt", "contig", "pos", "ref"), two, per_shard=100)
    return files.read_tsvs(spark, [one, two])


@query("SELECT contig, count(*) AS n, sum(pos) AS pos FROM v_sites WHERE contig IN ('chr1', 'chrX') GROUP BY contig", "v_sites")
def src7_store(spark, d):
    path = scratch.folder(spark, "store")
    files.save_table(_sites(spark, d), path)
    return files.load_table(spark, path).where("contig in ('chr1', 'chrX')").groupBy("contig").agg(F.count("*").alias("n"), F.sum("pos").alias("pos"))


@query("SELECT contig, CAST(pos AS VARCHAR) AS pos, ref, alt, 5 AS files FROM v_sites", "v_sites")
def src12_sharded(spark, d):
    path = scratch.folder(spark, "shards")
    files.write_sharded(_sites(spark, d).select(*gt.KEY), path, shards=5)
    rows = files.read_tsvs(spark, [path])
    return rows.crossJoin(F.broadcast(rows.select(F.input_file_name().alias("f")).agg(F.countDistinct("f").cast("int").alias("files"))))


@query()
def m5_cascade(spark, d):
    return learn.cascade(V.view(spark, d, "v_features"), ["qd", "mq"], ["vqslod", "fs"], bags=1, trees=20).select("varkey", "label", "sample_probability", "probability")


@query()
def m8_grid_search(spark, d):
    return learn.grid_search(V.view(spark, d, "v_features"), _FEATURES, (3, 5), (10, 20))


@query()
def m24_known_variant_run(spark, d):
    rows = V.view(spark, d, "v_features").withColumns({"LEN": (F.col("qd") % 60).cast("int"), "POLYX": (F.col("mq") % 12).cast("int")})
    known = rows.where("label = 0 and qd > 40").select("varkey")
    return learn.known_variant_run(rows.where("label = 1").drop("label"), rows.where("label = 0").drop("label"), known, _FEATURES, bags=1, trees=20).drop("LEN", "POLYX", *_FEATURES)
