"""The cascade of de novo structural calls, and the sweep behind it, on small tables."""

import random

from pyspark.sql import functions as F

from kinlake.operators import interval, sv

PED = [("F1", "kid", "dad", "mom", 1, 2), ("F1", "dad", None, None, 1, 1), ("F1", "mom", None, None, 2, 1)] + [(f"Z{i}", f"z{i}", None, None, 1, 1) for i in range(300)]
RAW = "chrom string, start int, end int, svtype string, s string, is_depth boolean"
PLACE = "name string, chrom string, start int, end int"


def test_sweep_gives_each_pair_once_and_keeps_every_probe(spark):
    rng = random.Random(7)
    probes = [(i, rng.choice(["a", "b", None]), rng.randrange(300), 0) for i in range(120)]
    probes = [(i, k, lo, lo + rng.choice([0, 1, 5, 90])) for i, k, lo, _ in probes] + [(500, "a", None, None)]
    places = [(rng.choice(["a", "b", "c"]), lo, lo + rng.choice([0, 3, 60])) for lo in [rng.randrange(300) for _ in range(100)]]
    left = spark.createDataFrame(probes, "id int, key string, lo int, hi int")
    right = spark.createDataFrame([(*p, n) for n, p in enumerate(places)], "key string, b_start int, b_end int, n int")
    got = [(r.id, r.n) for r in interval.sweep(left, right, width=16).collect()]
    want = sorted(
        (i, n) for i, k, lo, hi in probes if lo is not None for n, (q, s, e) in enumerate(places) if k == q and lo < max(e, s + 1) and s < max(hi, lo + 1)
    )
    assert sorted(x for x in got if x[1] is not None) == want
    assert {i for i, _ in got} == {p[0] for p in probes}


def cascade(spark, calls, raw, gts=(), coverage=(), exclude=(), gd=(), **limits):
    cols = "name string, chrom string, start int, end int, svtype string, samples array<string>, algorithms string, evidence string, filter string, gnomad_af double"
    rows = [(n, c, a, b, t, who, "manta", "PE,SR", "PASS", None) for n, c, a, b, t, who in calls]
    table = lambda r, schema: spark.createDataFrame(list(r), schema)
    ped = table(PED, "family_id string, sample_id string, paternal_id string, maternal_id string, sex int, phenotype int")
    out = sv.denovo_sv(
        table(rows, cols), ped, table(gts, "name string, s string, GQ int, RD_CN int"), table(raw, RAW), table(gd, PLACE), table(exclude, PLACE),
        table(coverage, "chrom string, start int, end int, s string, cov int"), sv.DeNovoSVConfig(**limits),
    )
    return {r.name: r.filter_flag for r in out.collect()}


def test_a_long_call_is_covered_by_the_union_across_bins_with_gaps(spark):
    far = 16_384 * 5
    calls = [("whole", "chr1", 100, far, "DEL", ["kid"]), ("half", "chr2", 0, far, "DEL", ["kid"]), ("shared", "chr3", 0, far, "DEL", ["kid"])]
    raw = [("chr1", 50, 30_000, "DEL", "kid", True), ("chr1", 20_000, 30_000, "DEL", "kid", True), ("chr1", 60_000, far, "DEL", "kid", True)]
    raw += [("chr2", 0, far // 2, "DEL", "kid", True), ("chr2", 10, far // 2, "DEL", "kid", True)]
    raw += [("chr3", 0, far, "DEL", who, True) for who in ("kid", "dad")]
    not_in = "not_in_raw_files_or_in_parents_raw_files"
    assert cascade(spark, calls, raw) == {"whole": "de_novo", "half": not_in, "shared": not_in}


def test_insertions_by_distance_regions_by_share_and_parents_by_depth(spark):
    calls = [("near", "chr1", 1000, 1001, "INS", ["kid"]), ("far", "chr1", 5000, 5001, "INS", ["kid"]), ("in", "chr2", 100, 200, "DEL", ["kid"]), ("out", "chr2", 1000, 1100, "DEL", ["kid"])]
    calls += [("thin", "chr4", 1000, 1200, "DUP", ["kid"]), ("theirs", "chr5", 10, 60, "DEL", ["kid", "mom"]), ("turned", "chr5", 10, 60, "INV", ["kid"]), ("common", "chr6", 10, 60, "DEL", ["kid", *[f"z{i}" for i in range(9)]])]
    calls += [("lost", None, None, None, "DEL", ["kid"]), ("blank", "chr7", 1, 9, "DEL", None), ("break", "chr7", 1, 9, "BND", ["kid"])]
    raw = [("chr1", 1099, 1100, "INS", "kid", False), ("chr1", 5100, 5101, "INS", "kid", False)] + [("chr2", a, a + 100, "DEL", "kid", False) for a in (100, 1000)] + [("chr4", 1000, 1200, "DUP", "kid", False)]
    flags = cascade(spark, calls, raw, exclude=[("x", "chr2", 149, 400)], coverage=[("chr4", 1000, 1100, s, 5 if s == "dad" else 50) for s in ("dad", "mom")])
    not_in = "not_in_raw_files_or_in_parents_raw_files"
    assert flags == {"near": "de_novo", "far": not_in, "in": "in_blacklist_region", "out": "de_novo", "thin": "low_coverage_in_parents", "theirs": "in_parent", "turned": "not_del_dup_ins", "common": "AF", "lost": not_in}


def test_a_disorder_region_overrides_frequency_and_parents_records_count(spark):
    calls = [("common", "chr6", 10, 60, "DEL", ["kid", *[f"z{i}" for i in range(9)]]), ("bad", "chr8", 10, 60, "DEL", ["kid"]), ("half", "chr9", 10, 60, "DEL", ["kid"])]
    raw = [(c, 10, 60, "DEL", "kid", False) for c in ("chr6", "chr8", "chr9")]
    gts = [("bad", "dad", 0, 1), ("bad", "mom", 40, 1), ("half", "dad", 0, 1)]
    assert cascade(spark, calls, raw, gts, gd=[("g", "chr6", 35, 90)]) == {"common": "de_novo", "bad": "bad_gq_in_parents", "half": "de_novo"}


def test_no_calls_give_no_rows_and_one_shuffle_serves_all_tests(spark):
    assert cascade(spark, [], []) == {}
    probes = spark.range(3).select(F.col("id"), F.lit("k").alias("key"), F.lit(1).alias("lo"), F.lit(9).alias("hi"))
    evidence = spark.range(3).select(F.lit("k").alias("key"), F.lit(1).alias("b_start"), F.lit(9).alias("b_end"))
    plan = interval.sweep(probes, evidence)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
