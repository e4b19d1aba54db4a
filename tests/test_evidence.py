"""Evidence in windows, the family depth module and curated events against plain loops."""

import math
import statistics as st
from collections import Counter, defaultdict

import numpy as np
import pytest

from kinlake.operators import curated, depth, evidence, sv


@pytest.mark.parametrize("rows", [10**6, 3])
def test_evidence_in_windows(spark, rows):
    rng = np.random.default_rng(1)
    calls = [(f"v{i}", f"chr{i % 2}", int(s := rng.integers(0, 60000)), int(s + rng.choice([50, 900, 16000, 40000])), [f"s{k}" for k in range(i % 3 + 1)]) for i in range(25)]
    ev = [("PE" if rng.random() < 0.6 else "SR", f"chr{rng.integers(0, 2)}", int(rng.integers(1, 110000)), f"chr{rng.integers(0, 2)}", int(rng.integers(1, 110000)), str(rng.choice(["+", "-"])), str(rng.choice(["left", "right"])), f"s{rng.integers(0, 4)}") for _ in range(900)]
    ev += [ev[0]] * 5 + [("SR", "chr1", None, None, None, None, "left", "s0")]
    calls_df = spark.createDataFrame(calls, "name string, chrom string, start int, end int, samples array<string>")
    windows = sv.roi_windows(calls_df).join(sv.carriers(calls_df).select("name", "s"), "name")
    ev_df = spark.createDataFrame(ev, "kind string, chrom string, pos int, chrom2 string, pos2 int, strand string, side string, s string")
    got = Counter((r.name, r.part, r.s, r.kind, r.pos, r["from"], r["to"], r.colour) for r in evidence.evidence_in_roi(windows, ev_df, rows=rows).collect())
    want = Counter()
    for name, chrom, start, end, samples in calls:
        parts = [("left", start, start), ("right", end, end)] if end - start >= 15000 else [("whole", start, end)]
        for part, a, b in parts:
            for kind, c, pos, c2, pos2, strand, side, s in ev:
                if c == chrom and pos is not None and s in samples and a - 3000 < pos <= b + 3000:
                    if kind == "PE" and c2 == c:
                        want[name, part, s, kind, pos, pos, pos2, {"+": "255,0,0", "-": "0,255,0"}[strand]] += 1
                    if kind == "SR":
                        want[name, part, s, kind, pos, pos - 5, pos + 5, {"left": "0,0,255", "right": "255,0,0"}[side]] += 1
    assert got == want and len(got) > 100
    assert {k[1] for k in got} == {"left", "right", "whole"}


def test_few_windows_of_a_sample_need_no_sweep(spark):
    """Evidence that no fuller bin holds meets its windows without a sorted sweep; repeated windows stay, swept or not."""
    windows = spark.createDataFrame([("a", "whole", "1", 10, 50, "s0")] * 2 + [("b", "whole", "1", 40, 40000, "s0")], "name string, part string, chrom string, start int, end int, s string")
    ev = spark.createDataFrame([("SR", "1", p, "1", p, "+", "left", "s0") for p in (10, 11, 45, 50, 51, 20000, 40000, 40001)], "kind string, chrom string, pos int, chrom2 string, pos2 int, strand string, side string, s string")
    want = Counter({("a", 11): 2, ("a", 45): 2, ("a", 50): 2, ("b", 45): 1, ("b", 50): 1, ("b", 51): 1, ("b", 20000): 1, ("b", 40000): 1})
    for rows in (1, 4, 100):
        assert Counter((r.name, r.pos) for r in evidence.evidence_in_roi(windows, ev, rows=rows).collect()) == want
    out = evidence.evidence_in_roi(windows, ev)
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Window" not in final


def test_segments_lie_inside_or_outside(spark):
    windows = spark.createDataFrame([("a", "1", 10, 50), ("b", "1", 30, 90), ("c", "1", 30, 50), ("d", "1", 60, 60)], "name string, chrom string, start int, end int")
    segments, members = evidence.window_segments(windows, 64)
    assert sorted((r.segment_start, r.segment_end) for r in segments.collect()) == [(10, 30), (30, 50), (50, 64), (64, 90)]
    held = defaultdict(set)
    for r in members.collect():
        held[r.segment_start].add(r.name)
    assert held == {10: {"a"}, 30: {"a", "b", "c"}, 50: {"b"}, 64: {"b"}}


PED = "family_id string, sample_id string, paternal_id string, maternal_id string, sex int, phenotype int"


def test_family_depth(spark):
    rng = np.random.default_rng(3)
    ped = []
    for f in range(5):
        ped += [(f"F{f}", f"d{f}", None, None, 1, 1), (f"F{f}", f"m{f}", None, None, 2, 1)]
        ped += [(f"F{f}", f"k{f}{i}", f"d{f}", f"m{f}", 1 + (f + i) % 2, 2) for i in range(f % 3 + 1)]
    ped += [("F9", "one", None, None, 2, 1), ("F8", "half", "d0", None, 1, 2), ("F8", "unknown", None, None, 0, 1)]
    kinds = [("del1", "chr1", "DEL"), ("dup1", "chr2", "DUP"), ("delX", "chrX", "DEL"), ("dupY", "Y", "dup")]
    values = {}
    for name, _, _ in kinds:
        bins = 5 if name != "dup1" else 3
        for p in ped:
            for b in range(bins):
                values[name, p[1], b] = float(np.round(rng.normal(1, 0.2), 2))
    carriers = [("del1", "k00"), ("del1", "k10"), ("delX", "m1"), ("dup1", "one")]
    got = {(r.name, r.proband, r.s): r for r in depth.family_depth(
        spark.createDataFrame([(n, s, b, v) for (n, s, b), v in values.items()], "name string, s string, bin int, depth double"),
        spark.createDataFrame(carriers, "name string, s string"), spark.createDataFrame(ped, PED), spark.createDataFrame(kinds, "name string, chrom string, svtype string")).collect()}
    people = {p[1]: p for p in ped}
    size = Counter(p[0] for p in ped)
    tail = lambda z: 0.5 * math.erfc(z / math.sqrt(2))
    seen = 0
    for fam, kid, dad, mom, *_ in ped:
        if not (dad or mom or size[fam] == 1):
            continue
        sibs = [p[1] for p in ped if dad and mom and p[2:4] == (dad, mom) and p[1] != kid]
        family = {kid, *sibs, *(x for x in (dad, mom) if x)}
        for s, role in [(kid, "p1"), *((x, "s1") for x in sibs), *((x, r) for x, r in ((dad, "fa"), (mom, "mo")) if x)]:
            for name, chrom, kind in kinds:
                sexed, bins = chrom in ("chrX", "Y"), [1, 2, 3] if name != "dup1" else [0, 1, 2]
                if sexed and people[s][4] not in (1, 2):
                    continue
                group = [p for p in people if not sexed or people[p][4] == people[s][4]]
                m = {p: st.median(values[name, p, b] for b in bins) for p in group}
                free = [p for p in group if p not in family and (name, p) not in carriers]
                sign = -1 if kind == "DEL" else 1
                r = got[name, kid, s]
                z = (m[s] - st.mean(m[p] for p in free)) / st.stdev(m[p] for p in free)
                assert (r.role, r.n_controls) == (role, len(free)) and abs(r.z - z) < 1e-9 and abs(r.p - tail(sign * z)) < 2e-7
                worst = sorted((tail(sign * (values[name, s, b] - st.mean(values[name, p, b] for p in free)) / st.stdev(values[name, p, b] for p in free)) for b in bins), reverse=True)
                assert abs(r.second_worst_p - worst[1]) < 2e-7
                below, equal = sum(v < m[s] for v in m.values()), sum(v == m[s] for v in m.values())
                rank = below + (equal + 1) / 2
                assert r.rank == (rank if kind == "DEL" else len(m) - rank + 1)
                assert abs(r.separation - sign * (m[s] - st.median(m[p] for p in free))) < 1e-12
                seen += 1
    assert seen == len(got) > 60


def test_translocations_meet_in_either_order(spark):
    calls = spark.createDataFrame([("a", "s1", "1", 5000, "2", 90000), ("b", "s1", "2", 90100, "1", 4500), ("c", "s2", "1", 5000, "2", 90000), ("d", "s1", "1", 5000, "2", 92000), ("e", "s1", "1", 7000, "1", 7100)], "name string, s string, chrom string, pos int, chrom2 string, pos2 int")
    events = spark.createDataFrame([("x", "s1", "2", 90500, "1", 5400), ("y", "s1", "1", 6500, "1", 7900), ("z", "s1", "3", 5000, "2", 90000)], "event string, s string, chrom string, pos int, chrom2 string, pos2 int")
    assert sorted(map(tuple, curated.match_translocations(calls, events, 1000).collect())) == [("x", "a"), ("x", "b"), ("y", "e")]


def test_curation_step_by_step(spark):
    call = "name string, s string, chrom string, start int, end int, svtype string, chrom2 string, pos2 int, is_highly_complex boolean, is_unbalanced_tloc boolean, size int"
    calls = spark.createDataFrame([
        ("mos", "s1", "1", 100, 200, "DEL", None, None, None, None, 1), ("hand", "s2", "1", 900, 950, "DUP", None, None, True, None, 2), ("ctx", "s1", "1", 5000, 5001, "CTX", "2", 70000, False, True, 3),
        ("gd", "s2", "3", 10, 90, "DEL", None, None, False, False, 4), ("gone", "s1", "4", 10, 90, "DEL", None, None, False, False, 5), ("aneu", "s2", "5", 10, 90, "DUP", None, None, False, False, 6), ("away", "s9", "5", 10, 90, "DUP", None, None, False, False, 7),
    ], call)
    event = "event string, s string, chrom string, start int, end int, svtype string"
    mosaics = spark.createDataFrame([("m1", "s1", "1", 150, 160, "DEL"), ("m2", "s2", "1", 150, 160, "DEL")], event)
    tlocs = spark.createDataFrame([("t1", "s1", "2", 70300, 70301, "CTX", 70300, "1", 4800), ("t2", "s1", "2", 75300, 75301, "CTX", 75300, "1", 4800)], event + ", pos int, chrom2 string, pos2 int")
    disorders = spark.createDataFrame([("g1", "s2", "3", 50, 300, "DEL")], event)
    odd = spark.createDataFrame([("tri5", "s2", "5", "DUP")], "event string, s string, chrom string, svtype string")
    samples = spark.createDataFrame([("s1", True, None), ("s2", False, False)], "s string, parental_error boolean, sex_error boolean")
    add = spark.createDataFrame([("new", "s1", "6", 1, 2, "INV")], "name string, s string, chrom string, start int, end int, svtype string")
    only = lambda name: spark.createDataFrame([(name,)], "name string")
    got = {r.name: r for r in curated.curate(calls, mosaics, tlocs, disorders, odd, only("gone"), add, samples, only("hand")).collect()}
    assert set(got) == {"mos", "m2", "hand", "ctx", "t2", "gd", "tri5", "new"}
    on = {n: {c for c in r.asDict() if c.startswith("is_") and r[c]} for n, r in got.items()}
    assert on == {"mos": {"is_mosaic"}, "m2": {"is_mosaic", "is_mosaic_manual"}, "hand": {"is_mosaic", "is_highly_complex"}, "ctx": {"is_tloc", "is_unbalanced_tloc"}, "t2": {"is_tloc", "is_tloc_manual"}, "gd": {"is_GD"}, "tri5": {"is_aneuploidy"}, "new": set()}
    assert got["ctx"].any_error and got["ctx"].relatedness_error and not got["gd"].any_error and got["m2"].result_final == "yes" and got["mos"].result_final is None and got["t2"].size is None
