"""Interval operators against brute force."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kinlake.operators import interval

spans = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 200), st.integers(0, 60)), max_size=12)


def table(spark, rows):
    return spark.createDataFrame([(f"n{i}", c, s, s + n) for i, (c, s, n) in enumerate(rows)], "name string, chrom string, start int, end int")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(spans, spans)
def test_pairs_are_those_of_a_plain_comparison(spark, a, b):
    got = sorted((r["name"], r["b_name"], r["overlap"]) for r in interval.pairs(table(spark, a), table(spark, b), ["chrom"], width=16).collect())
    end = lambda s, n: max(s + n, s + 1)
    want = sorted((f"n{i}", f"n{j}", min(end(*x[1:]), end(*y[1:])) - max(x[1], y[1])) for i, x in enumerate(a) for j, y in enumerate(b) if x[0] == y[0] and x[1] < end(*y[1:]) and y[1] < end(*x[1:]))
    assert got == want


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(spans, spans)
def test_coverage_counts_overlaps_once(spark, a, b):
    got = {r["name"]: r["covered"] for r in interval.coverage_fraction(table(spark, a), table(spark, b), ["chrom"], width=16).collect()}
    for i, (c, s, n) in enumerate(a):
        inside = {p for d, t, m in b if d == c for p in range(max(s, t), min(s + n, t + m))}
        assert abs(got[f"n{i}"] - len(inside) / max(n, 1)) < 1e-9


def test_merge_distance_and_nesting(spark):
    rows = [("a", 0, 10), ("a", 15, 5), ("a", 26, 4), ("a", 100, 50), ("a", 110, 5), ("b", 0, 5)]
    got = sorted((r.chrom, r.start, r.end, r.n) for r in interval.merge_intervals(table(spark, rows), ["chrom"], 5).collect())
    assert got == [("a", 0, 20, 2), ("a", 26, 30, 1), ("a", 100, 150, 2), ("b", 0, 5, 1)]
    again = interval.merge_intervals(table(spark, [(c, s, e - s) for c, s, e, _ in got]), ["chrom"], 5)
    assert again.count() == len(got)


def test_nearest_and_exact_fraction(spark):
    a, b = table(spark, [("a", 100, 10), ("b", 50, 10)]), table(spark, [("a", 95, 10), ("a", 199, 1), ("b", 200, 1)])
    assert [(r.name, r.distance) for r in interval.nearest(a, b, ["chrom"], 100).collect()] == [("n0", 5)]
    assert interval.overlap_join(a, b, ["chrom"], 0.5).count() == 1 and interval.overlap_join(a, b, ["chrom"], 0.51).count() == 0
    left = {r["name"]: r["overlap"] for r in interval.overlap_join(a, b, ["chrom"], how="left").collect()}
    assert left == {"n0": 5, "n1": 0}
