"""Enumerated truth tables and hand-worked cases."""

import math
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinlake.functions import csq, genotype, locus, stats, text
from kinlake.operators import burden, denovo, depth, family, learn, pedigree, qc, trio

CODES = {
    (1, 2, 2): 1, (1, 0, 0): 2, (2, 0, 1): 3, (2, 0, 2): 3, (2, 1, 0): 4, (2, 2, 0): 4, (2, 0, 0): 5, (0, 2, 0): 6, (0, 2, 1): 6, (0, 0, 2): 7, (0, 1, 2): 7, (0, 2, 2): 8,
}


def test_mendel_codes_of_every_trio(spark):
    rows = [(k, d, m) for k, d, m in product((None, 0, 1, 2), repeat=3)]
    df = spark.createDataFrame(rows, "k int, d int, m int")
    states = {s: trio.mendel_code(F.col("k"), F.col("d"), F.col("m"), F.lit(s)).alias(s) for s in ("auto", "hemi_x", "hemi_y")}
    for r in df.select("k", "d", "m", *states.values()).collect():
        if None not in (r.k, r.d, r.m):
            assert r.auto == CODES.get((r.k, r.d, r.m)), r
        assert r.hemi_x == {(0, 2): 9, (2, 0): 10}.get((r.k, r.m)), r
        assert r.hemi_y == {(0, 2): 11, (2, 0): 12}.get((r.k, r.d)), r


def test_phase_and_transmission_agree(spark):
    """Where phase is known, the transmitted alleles of het parents are those that the test counts."""
    df = spark.createDataFrame(list(product((0, 1, 2), repeat=3)), "k int, d int, m int")
    k, d, m, s = F.col("k"), F.col("d"), F.col("m"), F.lit("auto")
    t, u = trio.transmissions(k, d, m, s)
    for r in df.select("k", "d", "m", trio.phase_by_transmission(k, d, m, s).alias("p"), t.alias("t"), u.alias("u")).collect():
        hets = (r.d == 1) + (r.m == 1)
        consistent = any(a + b == r.k for a in ({0, 1} if r.d == 1 else {r.d // 2}) for b in ({0, 1} if r.m == 1 else {r.m // 2}))
        assert r.t + r.u == (hets if consistent else 0), r
        if r.p:
            a, b = map(int, r.p.split("|"))
            assert a + b == r.k and a in ({0, 1} if r.d == 1 else {r.d // 2}) and b in ({0, 1} if r.m == 1 else {r.m // 2})
            assert r.t == a * (r.d == 1) + b * (r.m == 1)
        else:
            assert not consistent or (r.k, r.d, r.m) == (1, 1, 1), r


@pytest.fixture
def one_trio(spark):
    def make(contig="chr1", pos=100, alt="T", kid=(0, 1, [20, 20], 40, 99, [200, 0, 200]), dad=(0, 0, [40, 0], 40, 99, [0, 99, 200]), mom=(0, 0, [40, 0], 40, 99, [0, 99, 200]), female=False, ac=1, an=200, gnomad=None):
        entry = "struct<s:string,a1:int,a2:int,AD:array<int>,DP:int,GQ:int,PL:array<int>>"
        row = (contig, pos, "A", alt, "F1", "c", "d", "m", female, ("c", *kid), ("d", *dad), ("m", *mom), ac, an, gnomad)
        return spark.createDataFrame([row], f"contig string, pos int, ref string, alt string, fam_id string, proband string, father string, mother string, is_female boolean, kid {entry}, dad {entry}, mom {entry}, AC int, AN int, gnomad_af double")

    return make


def test_denovo_confidence(one_trio):
    call = lambda **kw: [r.confidence for r in denovo.denovo_posterior(one_trio(**kw)).collect()]
    hom = (1, 1, [0, 30], 30, 99, [200, 99, 0])
    assert call() == ["HIGH"]
    assert call(alt="TT") == ["HIGH"]
    assert call(alt="TT", ac=4) == ["MEDIUM"]
    assert call(kid=(0, 1, [38, 12], 50, 99, [200, 0, 200]), ac=20) == ["LOW"]
    assert call(kid=(0, 1, [20, 20], 40, 10, [90, 0, 90])) == []  # low GQ
    assert call(kid=(0, 1, [38, 2], 40, 99, [90, 0, 90])) == []  # child's balance
    assert call(dad=(0, 0, [30, 10], 40, 99, [0, 99, 200])) == []  # parent's balance
    assert call(dad=(0, 0, [0, 0], 40, 99, [0, 99, 200])) == []  # no reads
    assert call(dad=(0, 1, [20, 20], 40, 99, [90, 0, 90])) == []  # inherited
    assert call(contig="chrX", pos=5_000_000, kid=hom) == ["HIGH"]
    assert call(contig="chrY", pos=5_000_000, kid=hom) == ["HIGH"]
    assert call(contig="chrM", kid=hom) == ["HIGH"]
    assert call(contig="chrX", pos=5_000_000, kid=hom, female=True) == []


def test_exact_tests_against_known_values(spark):
    one = spark.range(1)
    n = lambda x: F.lit(x).cast("long")
    r = one.select(
        stats.binomial_two_sided(n(0), n(0)).alias("b0"), stats.binomial_two_sided(n(5), n(10)).alias("b5"), stats.binomial_two_sided(n(2), n(10)).alias("b2"),
        stats.fisher_two_sided(n(3), n(1), n(1), n(3)).alias("f"), stats.hardy_weinberg(n(10), n(0), n(0)).alias("h0"), stats.hardy_weinberg(n(3), n(5), n(2)).alias("h"),
        stats.chi2_upper_1df(F.lit(3.841459)).alias("c"), stats.normal_upper(F.lit(1.959964)).alias("z"), stats.log_factorial(n(10)).alias("lf"), stats.hypergeometric_tail(n(0), n(5), n(5), n(3)).alias("t0"),
    ).first()
    assert r.b0 == 1 and r.b5 == 1 and r.b2 == pytest.approx(0.109375)
    assert r.f == pytest.approx(34 / 70) and r.h0 == 1 and 0.5 < r.h <= 1
    assert r.c == pytest.approx(0.05, abs=1e-6) and r.z == pytest.approx(0.025, abs=1e-6)
    assert r.lf == pytest.approx(15.104412573075516) and r.t0 == pytest.approx(1)


def test_copy_states_and_sentinels(spark):
    df = spark.createDataFrame([("chr1", 5), ("chrX", 20_000), ("chrX", 9_000_000), ("Y", 9_000_000), ("chrM", 3)], "contig string, pos int")
    got = [(r.a, r.x, r.y, r.p, r.m) for r in df.select(locus.in_autosome().alias("a"), locus.in_x_nonpar().alias("x"), locus.in_y_nonpar().alias("y"), locus.in_autosome_or_par().alias("p"), locus.in_mito().alias("m")).collect()]
    assert got == [(True, False, False, True, False), (False, False, False, True, False), (False, True, False, False, False), (False, False, True, False, False), (False, False, False, False, True)]
    vals = spark.createDataFrame([(".",), ("",), ("NA",), ("0",), ("-9",), ("S1",)], "v string")
    assert [r[0] for r in vals.select(text.null_if_missing(F.col("v"))).collect()] == [None] * 5 + ["S1"]


def test_split_pl_and_missing_fill(spark):
    one = spark.range(1)
    pl = F.array(*[F.lit(x) for x in (50, 40, 30, 20, 10, 0)])  # 00 01 11 02 12 22
    assert one.select(genotype.split_pl(pl, F.lit(1), 3)).first()[0] == [0, 10, 30]
    assert one.select(genotype.split_pl(pl, F.lit(2), 3)).first()[0] == [30, 10, 0]
    e = spark.createDataFrame([("1", 1, "A", "T", "s", 0, 0, None, 30, 40, None), ("1", 1, "A", "T", "t", 0, 1, None, 30, 40, None)], "contig string, pos int, ref string, alt string, s string, a1 int, a2 int, AD array<int>, DP int, GQ int, PL array<int>")
    a, b = qc.fill_homref(e).orderBy("s").collect()
    assert (a.AD, a.PL) == ([30, 0], [0, 40, 90]) and (b.AD, b.PL) == (None, None)


def test_csq_edges(spark):
    cols = ["Consequence", "BIOTYPE", "CANONICAL", "PolyPhen", "SYMBOL"]
    df = spark.createDataFrame([(1, [""]), (2, ["no_such_term|protein_coding|YES||G"]), (3, ["missense_variant|protein_coding|||A", "missense_variant|protein_coding|||B"])], "i int, t array<string>")
    from kinlake.operators.clinical import prioritize_csq

    rows = {r.i: r for r in prioritize_csq(df.withColumn("csq", csq.decode(F.col("t"), cols))).collect()}
    assert rows[1].worst.SYMBOL == "." and rows[2].worst is None and rows[3].worst.SYMBOL == "A" and sorted(rows[3].worst_genes) == ["A", "B"]


def test_pedigree_shapes(spark):
    cols = "family_id string, sample_id string, paternal_id string, maternal_id string, sex int, phenotype int"
    ped = spark.createDataFrame([("F", "d", None, None, 1, 1), ("F", "m", None, None, 2, 1), ("F", "k1", "d", "m", 1, 2), ("F", "k2", "d", "m", 2, 1), ("S", "x", None, None, 1, 2), ("B", "y", "z", "m", 1, 2)], cols)
    assert sorted(r.proband for r in pedigree.trio_list(ped).collect()) == ["k1", "k2"]
    assert sorted({r.family_id for r in pedigree.split_families(ped).collect()}) == ["F_1", "F_2"]
    assert {r.sample_id: r.role for r in pedigree.sample_roles(ped).collect()} == {"d": "Father", "m": "Mother", "k1": "Proband", "k2": "Proband", "x": "Singleton", "y": "Singleton"}
    pairs = {(r.i, r.j): r.expected for r in pedigree.pedigree_pairs(ped).collect()}
    assert pairs[("k1", "k2")] == "siblings" and pairs[("d", "k1")] == "parent-child" and ("d", "m") not in pairs
    empty = ped.where("false")
    assert pedigree.trio_list(empty).count() == 0 and pedigree.sample_roles(empty).count() == 0


def test_c_alpha_permutations_resolve_a_small_p(spark):
    import numpy as np

    genes = [("hot", 9, 7), ("cold", 12, 1), *[(f"g{k}", 4, 1 + k % 2) for k in range(12)]]
    rows = [(f"{g}:{i}", g, int(i < y)) for g, n, y in genes for i in range(n)]
    of, pheno = np.array([[g for g, *_ in genes].index(r[1]) for r in rows]), np.array([r[2] for r in rows])
    n, p = np.bincount(of), pheno.mean()
    t_of = lambda x: float(((np.bincount(of, x) - n * p) ** 2 - n * p * (1 - p)).sum())
    rng = np.random.default_rng(2)
    want = np.mean([t_of(rng.permutation(pheno)) ** 2 > t_of(pheno) ** 2 + 1e-9 for _ in range(40_000)])
    out = burden.c_alpha_permutations(spark.createDataFrame(rows, "allele string, gene string, pheno int"))
    got = out.first()
    assert 0.0005 < want < 0.045 and abs(got.t - t_of(pheno)) < 1e-9
    assert got.p_value == pytest.approx(want, abs=5 * (want / 10_000) ** 0.5) and got.p_value * 10_000 == pytest.approx(round(got.p_value * 10_000))
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_two_group_test_by_power(spark):
    import math

    norm = lambda z: math.erfc(z / 2**0.5) / 2
    spread = [-0.1, 0.1, -0.05, 0.05, 0.0, 0.08, -0.08, 0.02]
    rows = [(c, f"c{i}", 0, 1 + x * w) for c, w in (("quiet", 1), ("noisy", 9), ("one", 1)) for i, x in enumerate(spread)]
    own = [("quiet", "a", 0.55), ("quiet", "b", 0.5), ("noisy", "a", 0.5), ("noisy", "b", 0.3), ("one", "a", 0.9)]
    made = spark.createDataFrame(rows + [(c, s, 0, m) for c, s, m in own], "name string, s string, bin int, depth double")
    out = {r["name"]: r for r in depth.two_group_test(made, spark.createDataFrame([x[:2] for x in own], "name string, s string")).collect()}
    single = lambda c: [norm((1 + sum(spread) / 8 * w - m) / sd(w)) for n, _, m in own if n == c for w in [9 if c == "noisy" else 1]]
    sd = lambda w: w * (sum((x - sum(spread) / 8) ** 2 for x in spread) / 7) ** 0.5
    assert out["quiet"].test == "twoSampPerm" and out["quiet"].power > 0.99 and out["quiet"].p == pytest.approx(norm(abs(out["quiet"].z)), rel=1e-5)
    half = -sum(math.log(p) for p in single("noisy"))
    assert out["noisy"].test == "singlesampZ" and out["noisy"].p == pytest.approx(math.exp(-half) * (1 + half), rel=1e-5)
    assert out["one"].power is None and out["one"].test == "singlesampZ" and out["one"].p == pytest.approx(single("one")[0], rel=1e-5)
    # Cohen's table: 26 a group give power 0.80 at effect 0.7, level 0.05 one-sided
    power = spark.range(1).select(stats.t_test_power(F.lit(26), F.lit(26), F.lit(0.7))).first()[0]
    assert power == pytest.approx(0.80, abs=0.01)


def test_principal_components_are_those_of_the_singular_value_decomposition(spark):
    rng = np.random.default_rng(8)
    n, m = 30, 60
    freq = np.where(np.arange(n)[:, None] < 15, rng.uniform(0.1, 0.5, m), rng.uniform(0.3, 0.9, m))
    g = rng.binomial(2, freq)
    g = g[:, (g.sum(0) > 0) & (g.sum(0) < 2 * n)]
    rows = [("chr1", j, "A", "C", f"s{i}", int(g[i, j] == 2), int(g[i, j] > 0)) for i in range(n) for j in range(g.shape[1])]
    scores, _ = learn.hwe_pca(spark.createDataFrame(rows, "contig string, pos int, ref string, alt string, s string, a1 int, a2 int"), k=2, rounds=60, extra=4)
    p = g.mean(0) / 2
    u = np.linalg.svd((g - 2 * p) / np.sqrt(2 * p * (1 - p)), full_matrices=False)[0]
    got = {r.s: r.scores for r in scores.collect()}
    v = np.array([got[f"s{i}"] for i in range(n)])
    for k in range(2):
        assert abs(abs(v[:, k] @ u[:, k]) - 1) < 1e-3


def family_case(gts, sex=1, chrom="chr1", chr2=None, genes=("G",), extra=(), **row):
    """A trio F (dad, mom, kid affected) and the genotypes of one call or several."""
    ped = [("F", "kid", "dad", "mom", sex, 2), ("F", "dad", None, None, 1, 1), ("F", "mom", None, None, 2, 1), *extra]
    calls = [("v", gts, chrom, chr2, list(genes))] if isinstance(gts, dict) else gts
    sv = [(n, c, c2, "DEL", [s for s, x in who.items() if x != "0/0"], g, row.get("ac", 3), row.get("hom", 1), row.get("af"), row.get("gd", False), list(row.get("lof", []))) for n, who, c, c2, g in calls]
    gt_rows = [(n, s, x) for n, who, *_ in calls for s, x in who.items()]
    return {
        "sv": (sv, "name string, chrom string, chr2 string, svtype string, samples array<string>, genes array<string>, ac int, n_homalt int, gnomad_af double, in_gd boolean, lof_genes array<string>"),
        "gt": (gt_rows, "name string, s string, gt string"), "ped": (ped, "family_id string, sample_id string, paternal_id string, maternal_id string, sex int, phenotype int"),
        "genes": ([("G", True, True, False)], "gene string, omim boolean, in_list boolean, constrained boolean"), "terms": ([("kid", "G")], "s string, gene string"),
    }


@pytest.mark.parametrize(
    ("case", "want"),
    [
        (family_case({"kid": "0/1"}), {"filt_absent_unaff"}),
        (family_case({"kid": "0/1"}, ac=11), set()),
        (family_case({"kid": "1/1", "dad": "1/0", "mom": "0/1"}), {"filt_ar", "filt_inherited"}),
        (family_case({"kid": "1/1", "dad": "1/1"}, hom=2), {"filt_inherited"}),
        (family_case({"kid": "1/1", "mom": "0/1"}, hom=11), {"filt_inherited"}),
        (family_case({"kid": "1", "mom": "0/1"}, chrom="chrX"), {"filt_xlr", "filt_inherited"}),
        (family_case({"kid": "1", "mom": "0/1"}, chr2="chrX"), {"filt_xlr", "filt_inherited"}),
        (family_case({"kid": "1", "dad": "1", "mom": "0/1"}, chrom="chrX"), {"filt_inherited"}),
        (family_case({"kid": "0/1", "mom": "0/1"}, genes=("H",)), set()),
        (family_case([("v", {"kid": "0/1", "dad": "0/1"}, "chr1", None, ["H"]), ("w", {"kid": "0/1", "mom": "0/1"}, "chr1", None, ["H", "K"])]), {"filt_mult_hit"}),
        (family_case([("v", {"kid": "0/1", "dad": "0/1"}, "chr1", None, ["H"]), ("w", {"kid": "0/1", "dad": "0/1"}, "chr1", None, ["H"])]), set()),
    ],
)
def test_family_rules(spark, case, want):
    out = family.family_filter(**{k: spark.createDataFrame(*v) for k, v in case.items()}).where("name = 'v'").collect()
    flags = {f for r in out for f in ("filt_absent_unaff", "filt_mult_hit", "filt_ar", "filt_xlr", "filt_inherited") if r[f]}
    assert flags == want and all(r.hpo_match == ("G" in case["sv"][0][0][5]) for r in out)


def test_copy_states_and_their_quality(spark):
    cut = spark.createDataFrame([(0, 0.0, 0.1, 0.25), (1, 0.5, 0.1, 0.75), (2, 1.0, 0.1, 1.25), (3, 1.5, 0.1, 1.75)], "copy_state int, mean double, sd double, cutoff double")
    values = {"a": 1.1, "b": 1.1, "c": 1.15, "d": 0.6, "e": 0.1, "f": 2.6}
    rows = spark.createDataFrame([("v", s, m) for s, m in values.items()], "name string, s string, m double")
    got = {r.s: r for r in depth.copy_states(rows, cut).collect()}
    tail = lambda z: math.erfc(z / math.sqrt(2)) / 2
    for s, m in values.items():
        m = max(m - 0.1, 0)
        state = next((k for k, c in enumerate((0.25, 0.75, 1.25, 1.75)) if m <= c), max(4, math.ceil((m - 0.25) / 0.5)))
        q = lambda k: -10 * math.log10(tail(abs(m - k * 0.5) / 0.1)) if tail(abs(m - k * 0.5) / 0.1) > 1e-300 else 1e6  # noqa: E731, B023
        gq = round(min(q(state - 1 if state else 1), q(state + 1)) - q(state))
        assert got[s].copy_state == state and abs(got[s].m - m) < 1e-9 and abs(got[s].gq - min(max(gq, 1), 999)) <= 1
    assert abs(got["a"].correction + 0.1) < 1e-9 and got["a"].gq_var > 0


def test_silhouette_and_clusters_of_depth(spark):
    x = np.array([0.0, 0.1, 0.05, 1.0, 1.1, 2.0])
    of = np.array([0, 0, 0, 1, 1, 2])
    want = []
    for i in range(6):
        d = lambda k: [abs(x[i] - x[j]) for j in range(6) if of[j] == k and j != i]  # noqa: E731, B023
        a, b = (np.mean(d(of[i])) if d(of[i]) else None), min(np.mean(d(k)) for k in range(3) if k != of[i])
        want.append(0.0 if a is None else (b - a) / max(a, b))
    assert abs(depth.silhouette(x, of) - np.mean(want)) < 1e-12
    rows = [("v", float(m)) for m in (0.48, 0.5, 0.52, 0.99, 1.0, 1.01, 1.5, 1.52)] + [("w", 1.0), ("w", 1.0), ("u", 1.0)]
    got = {r.name: r.n_states for r in depth.depth_clusters(spark.createDataFrame(rows, "name string, m double")).collect()}
    assert got == {"v": 3, "w": 1, "u": 1}


def test_hardy_weinberg_against_enumeration(spark):
    """Every outcome weighed in whole numbers; also where an outcome is so rare that the weights of others overflow."""
    from fractions import Fraction
    from math import factorial

    cases = [(3, 5, 2), (0, 7, 0), (0, 1, 0), (40, 0, 3), (10, 21, 11), (1, 0, 1), (60, 30, 0), (0, 6, 9), (2000, 0, 2000)]
    got = {(r.a, r.b, r.c): r.p for r in spark.createDataFrame([*cases, (None, 1, 1)], "a long, b long, c long").withColumn("p", stats.hardy_weinberg(F.col("a"), F.col("b"), F.col("c"))).collect()}
    for a, b, c in cases[:-1]:
        n, rare = a + b + c, min(2 * a + b, 2 * c + b)
        w = {h: Fraction(2**h, factorial((rare - h) // 2) * factorial(h) * factorial(n - (rare + h) // 2)) for h in range(rare % 2, rare + 1, 2)}
        want = (sum(x for x in w.values() if x < w[b]) + sum(x for x in w.values() if x == w[b]) / 2) / sum(w.values())
        assert got[a, b, c] == pytest.approx(float(want), rel=1e-9)
    assert got[2000, 0, 2000] == 0 and got[None, 1, 1] is None


def test_hardy_weinberg_takes_no_logarithm_per_outcome():
    assert "ln(" not in str(stats.hardy_weinberg(F.col("a"), F.col("b"), F.col("c"))).lower()


def test_entries_that_show_no_new_allele_do_not_travel(spark):
    """Every combination of calls (missing too) on an autosome, X, Y and the mitochondrion: the same calls from fewer rows."""
    trios = spark.createDataFrame([("f1", "k1", "d1", "m1", False), ("f2", "k2", "d2", "m2", True)], "fam_id string, proband string, father string, mother string, is_female boolean")
    alleles, pl = {0: (0, 0), 1: (0, 1), 2: (1, 1), None: (None, None)}, {0: [0, 40, 80], 1: [50, 0, 50], 2: [80, 40, 0], None: None}
    found = []
    for at, (contig, fam, calls) in enumerate(product(("chr1", "chrX", "chrY", "chrM"), (1, 2), product(alleles, repeat=3))):
        found += [(contig, 5_000_000 + at, "A", "C", f"{m}{fam}", *alleles[n], [20, 10 if m == "k" else 0], 30, 50, pl[n]) for m, n in zip("kdm", calls, strict=True)]
    entries = spark.createDataFrame(found, "contig string, pos int, ref string, alt string, s string, a1 int, a2 int, AD array<int>, DP int, GQ int, PL array<int>")
    every, some = (trio.trio_entries(entries, trios, only=x).withColumns({"AC": F.lit(1), "AN": F.lit(90), "gnomad_af": F.lit(0.001)}) for x in (None, trio.may_be_new()))
    show = lambda df: sorted((r.contig, r.pos, r.proband) for r in df.select("contig", "pos", "proband").collect())
    for keep in (denovo.denovo_posterior, denovo.denovo_by_gt, lambda t: trio.mendel_errors(t).where("mendel_code = 2")):
        want = show(keep(every))
        assert want and show(keep(some)) == want
    assert some.count() < every.count() / 2
