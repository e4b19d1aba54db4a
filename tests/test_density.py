"""Density clusters and platform inference against brute force."""

import numpy as np
import pytest

from kinlake.operators import density, learn


def brute_clusters(x, least, k):
    """Straight from the definition: components at each distance, from above."""
    n = len(x)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    core = np.sort(d, axis=1)[:, k]
    reach = np.maximum(np.maximum(d, core[:, None]), core[None])
    np.fill_diagonal(reach, 0)
    # every merge distance, from a plain minimum spanning tree
    inside, near, heights = {0}, reach[0].copy(), []
    while len(inside) < n:
        j = min((p for p in range(n) if p not in inside), key=lambda p: near[p])
        heights.append(near[j])
        inside.add(j)
        near = np.minimum(near, reach[j])
    shortest = max(heights) * density.SHORTEST

    def parts(points, w):
        """Components of points by edges lighter than w."""
        left, out = set(points), []
        while left:
            todo = [left.pop()]
            part = list(todo)
            while todo:
                p = todo.pop()
                new = [q for q in left if max(reach[p, q], shortest) < w]
                left.difference_update(new)
                todo += new
                part += new
            out.append(sorted(part))
        return out

    def walk(points, born):
        """(stability, the clusters chosen at or below, as lists of points)"""
        members, now, total, found = list(points), list(points), 0.0, []
        while True:
            within = reach[np.ix_(now, now)]
            w = max((h for h in (max(v, shortest) for v in heights) if len(parts(now, h)) > 1), default=None)
            if w is None or not within.size:
                return total, [members] if born else []
            split = parts(now, w)
            large = [p for p in split if len(p) >= least]
            if len(large) == 1:
                total += (1 / w - born) * (len(now) - len(large[0]))
                now = large[0]
                continue
            total += (1 / w - born) * len(now)
            below = [walk(p, 1 / w) for p in large]
            under = sum(b[0] for b in below)
            if born and not under > total:
                return total, [members]
            return under, [c for b in below for c in b[1]]

    out = np.full(n, -1)
    for c, members in enumerate(sorted(walk(list(range(n)), 0.0)[1])):
        out[members] = c
    return out


def planted(rng, dims=3):
    blobs = [rng.normal(c, s, (n, dims)) for c, s, n in ((0, 0.1, 40), (2, 0.3, 35), (2.9, 0.1, 25), (7, 0.2, 6))]
    x = np.concatenate([*blobs, rng.uniform(-4, 9, (25, dims)), np.repeat(blobs[0][:1], 12, axis=0)])
    return x[rng.permutation(len(x))]


@pytest.mark.parametrize(("cell", "least", "k"), [(2048, 10, 10), (16, 10, 3), (16, 5, 8)])
def test_clusters_by_brute_force(spark, monkeypatch, cell, least, k):
    monkeypatch.setattr(density, "CELL", cell)
    x = planted(np.random.default_rng(cell + least))
    names = [f"p{i:03d}" for i in range(len(x))]
    rows = [(names[i], [float(v) for v in x[i]]) for i in np.random.default_rng(0).permutation(len(x))]
    got = {r.s: r.cluster for r in density.density_clusters(spark.createDataFrame(rows, "s string, x array<double>").repartition(3), least, k).collect()}
    want = brute_clusters(x, least, k)
    seen: dict = {}
    want = [-1 if c < 0 else seen.setdefault(c, len(seen)) for c in want.tolist()]
    assert [got[n] for n in names] == want
    assert -1 in want and len(set(want)) >= 3


def test_spanning_tree_weighs_least(spark, monkeypatch):
    monkeypatch.setattr(density, "CELL", 12)
    x = planted(np.random.default_rng(9), 2)
    points = spark.createDataFrame([(f"p{i:03d}", [float(v) for v in p]) for i, p in enumerate(x)], "s string, x array<double>")
    placed, boxes, begin = density._placed(points, len(x), 4)
    assert len(begin) > 5
    cores = density.core_distances(placed, boxes, 3)
    rows = sorted(cores.join(placed.select("idx", "s"), "idx").collect(), key=lambda r: r.idx)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    core = np.sort(d, axis=1)[:, 3]
    assert all(abs(core[int(r.s[1:])] - r.core) < 1e-12 for r in rows)
    edges = density.spanning_tree(cores, boxes, begin)
    y = np.array([r.x for r in rows])
    c = np.array([r.core for r in rows])
    reach = np.maximum(np.maximum(np.sqrt(((y[:, None] - y[None]) ** 2).sum(2)), c[:, None]), c[None])
    near, inside, total = reach[0].copy(), {0}, 0.0
    while len(inside) < len(y):
        j = min((p for p in range(len(y)) if p not in inside), key=lambda p: near[p])
        total += near[j]
        inside.add(j)
        near = np.minimum(near, reach[j])
    assert len(edges) == len(y) - 1 and abs(edges[:, 2].sum() - total) < 1e-9


def test_few_points(spark):
    one = lambda rows: [(r.s, r.cluster) for r in density.density_clusters(spark.createDataFrame(rows, "s string, x array<double>"), 2, 1).collect()]
    assert one([]) == [] and one([("a", [1.0])]) == [("a", -1)]
    assert sorted(one([("a", [1.0]), ("b", [1.0]), ("c", [9.0])])) == [("a", -1), ("b", -1), ("c", -1)]
    assert sorted(one([("a", [0.0]), ("b", [0.1]), ("c", [5.0]), ("d", [5.1])])) == [("a", 0), ("b", 0), ("c", 1), ("d", 1)]


def platforms(rng):
    """Three platforms of samples over 40 intervals, some odd samples and one that is called nowhere."""
    kinds = rng.random((3, 40)) < 0.5
    on = [np.where(rng.random(40) < 0.03, ~kinds[i % 3], kinds[i % 3]) for i in range(60)] + [rng.random(40) < 0.5 for _ in range(4)] + [np.zeros(40, bool)]
    return np.array(on), [i % 3 for i in range(60)]


def test_platforms(spark):
    on, kinds = platforms(np.random.default_rng(5))
    rows = [(f"i{j}", f"s{i:02d}", 0.9 if on[i, j] else 0.25) for i in range(len(on)) for j in range(40) if on[i, j] or (i + j) % 3]
    callrate = spark.createDataFrame([*rows, ("i0", f"s{len(on) - 1:02d}", 0.0)], "interval string, s string, call_rate double")
    scores = {r.s: r.scores for r in learn.callrate_pca(callrate, 3, tolerance=1e-9).collect()}
    x = on - on.mean(0)
    u, w, _ = np.linalg.svd(x, full_matrices=False)
    got = np.array([scores[f"s{i:02d}"] for i in range(len(on))])
    for d in range(3):
        want = u[:, d] * w[d]
        assert min(abs(got[:, d] - want).max(), abs(got[:, d] + want).max()) < 1e-4
    rows = learn.infer_platform(callrate, 3, least=8, neighbours=4).collect()
    found = {r.s: r.platform for r in rows}
    assert len(found) == len(on)
    by_kind = [{found[f"s{i:02d}"] for i in range(60) if kinds[i] == p} - {"platform_-1"} for p in range(3)]
    assert all(len(p) == 1 for p in by_kind) and len(set.union(*by_kind)) == 3
    want = brute_clusters(np.array([r.scores for r in sorted(rows, key=lambda r: r.s)]), 8, 4)
    seen: dict = {}
    assert [found[s] for s in sorted(found)] == [f"platform_{-1 if c < 0 else seen.setdefault(c, len(seen))}" for c in want.tolist()]
