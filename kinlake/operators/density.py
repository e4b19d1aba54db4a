"""Density clustering of points on a few components, by hierarchy of mutual reachability; noise is labelled -1.

Points are dealt into cells by median splits. A cell's points meet those of other cells only where the cells' boxes are near enough to
matter, so distances are exact and no list of all pairs is made. The minimum spanning tree grows by rounds: every component takes its
lightest edge to another. Its edges, one fewer than the points, are cut into the stable clusters on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Points that can be clustered: the tree of so many (24 MB) is cut on the driver.
POINTS = 1_000_000
#: Points of a cell, on average, and points by which the cells are laid out (their shape changes no result).
CELL, LAYOUT = 2048, 50_000
#: Numbers of a block of distances.
BLOCK = 2_000_000
#: Distances below this share of the longest edge count as that, so that equal points have a finite density.
SHORTEST = 1e-9


def _split(x: np.ndarray, depth: int) -> list:
    """Median splits, widest side first: [dimension, value, low, high], or None for a cell."""
    if depth == 0 or len(x) < 2:
        return None
    d = int(np.ptp(x, axis=0).argmax())
    at = float(np.median(x[:, d]))
    low = x[:, d] <= at
    if low.all() or not low.any():
        return None
    return [d, at, _split(x[low], depth - 1), _split(x[~low], depth - 1)]


def _cells(x: np.ndarray, tree: list | None) -> np.ndarray:
    out = np.zeros(len(x), np.int64)
    stack, n = [(tree, np.arange(len(x)))], 0
    while stack:
        node, rows = stack.pop()
        if node is None:
            out[rows] = n
            n += 1
            continue
        low = x[rows, node[0]] <= node[1]
        stack += [(node[2], rows[low]), (node[3], rows[~low])]
    return out


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64).reshape(len(column), -1)


def _distances(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Blocks of rows of the distances from a to b, with the number of the first row."""
    step = max(1, BLOCK // max(1, b.size))
    for lo in range(0, len(a), step):
        yield lo, np.sqrt(((a[lo : lo + step, None, :] - b[None, :, :]) ** 2).sum(2))


class _Boxes:
    """The cells' boxes, on the driver and in tasks: one row a cell."""

    def __init__(self, rows: list):
        self.low, self.high = np.array([r.low for r in rows], np.float64), np.array([r.high for r in rows], np.float64)

    def reach(self, x: np.ndarray) -> np.ndarray:
        """The least distance from each point to each box."""
        off = np.maximum(np.maximum(self.low[None] - x[:, None], x[:, None] - self.high[None]), 0)
        return np.sqrt((off**2).sum(2)) * (1 - 1e-12)

    def spread(self) -> np.ndarray:
        """The largest distance between points of each two boxes."""
        off = np.maximum(np.abs(self.high[:, None] - self.low[None]), np.abs(self.high[None] - self.low[:, None]))
        return np.sqrt((off**2).sum(2)) * (1 + 1e-12)


def _placed(points: DataFrame, n: int, least: int) -> tuple[DataFrame, _Boxes, np.ndarray]:
    """idx, s, cell and x of every point (idx runs through the cells), the boxes, and where each cell's idx begin."""
    from ..plans.scratch import written

    spark = points.sparkSession
    some = points.orderBy(F.xxhash64("s"), "s").limit(LAYOUT).select("x").collect()
    x = np.array([r.x for r in some], np.float64).reshape(len(some), -1)
    tree = _split(x, max(0, int(np.log2(max(1, n / max(CELL, 4 * least))))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("s"), b.column("x"), pa.array(_cells(_matrix(b.column("x")), tree))], names=["s", "x", "cell"])

    dealt = written(points.select("s", "x").mapInArrow(run, "s string, x array<double>, cell long"), "cells")
    side = lambda f: F.array(*[f(F.get("x", F.lit(d))) for d in range(x.shape[1])])
    rows = dealt.groupBy("cell").agg(F.count("*").alias("n"), side(F.min).alias("low"), side(F.max).alias("high")).orderBy("cell").collect()
    begin = np.append(0, np.cumsum([r.n for r in rows]))
    base = spark.createDataFrame([(r.cell, i, int(begin[i])) for i, r in enumerate(rows)], "cell long, place int, begin long")
    own = Window.partitionBy("cell").orderBy("s")
    numbered = dealt.join(F.broadcast(base), "cell").withColumn("idx", F.col("begin") + F.row_number().over(own) - 1)
    return written(numbered.select("idx", "s", F.col("place").alias("cell"), "x"), "points"), _Boxes(rows), begin


def _visits(extra: str, bound, boxes: _Boxes):
    """Rows (target, idx, x, extra...) for every cell but its own that a point must be held against: nearer than its bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                part = b.slice(lo, 4096)
                x, cell = _matrix(part.column("x")), part.column("cell").to_numpy()
                near = bound(part, boxes.reach(x))
                near[np.arange(len(x)), cell] = False
                i, target = np.nonzero(near)
                yield pa.RecordBatch.from_arrays([pa.array(target.astype(np.int32)), *[part.column(c).take(pa.array(i)) for c in ("idx", "x", extra)]], names=["target", "idx", "x", extra])

    return run


def core_distances(placed: DataFrame, boxes: _Boxes, k: int) -> DataFrame:
    """idx, cell, x and core: the distance to the k-th nearest other point."""
    from ..plans.scratch import written

    def own(rows: pa.Table) -> pa.Table:
        x, near = _matrix(rows["x"]), []
        for _, d in _distances(x, x):
            near += list(np.sort(np.partition(d, min(k, len(x) - 1), axis=1)[:, : k + 1], axis=1))
        bound = [float(r[k]) if len(r) > k else np.inf for r in near]
        return rows.select(["idx", "cell", "x"]).append_column("near", pa.array(near, pa.list_(pa.float64()))).append_column("bound", pa.array(bound, pa.float64()))

    inside = written(placed.groupBy("cell").applyInArrow(own, "idx long, cell int, x array<double>, near array<double>, bound double"), "near")

    def other(guests: pa.Table, hosts: pa.Table) -> pa.Table:
        near = []
        if len(guests) and len(hosts):
            x, y, bound = _matrix(guests["x"]), _matrix(hosts["x"]), guests["bound"].to_numpy()
            for lo, d in _distances(x, y):
                near += [np.sort(r[r < bound[lo + i]])[: k + 1] for i, r in enumerate(d)]
        return pa.table({"idx": guests["idx"][: len(near)], "near": pa.array(near, pa.list_(pa.float64()))}, pa.schema([("idx", pa.int64()), ("near", pa.list_(pa.float64()))]))

    guests = inside.mapInArrow(_visits("bound", lambda b, reach: reach < b.column("bound").to_numpy()[:, None], boxes), "target int, idx long, x array<double>, bound double")
    outside = guests.groupBy("target").cogroup(placed.groupBy("cell")).applyInArrow(other, "idx long, near array<double>")
    every = inside.select("idx", "near").unionByName(outside)
    core = every.groupBy("idx").agg(F.get(F.sort_array(F.flatten(F.collect_list("near"))), F.lit(k)).alias("core"))
    return inside.select("idx", "cell", "x").join(core, "idx")


def _lightest(label, x, core, idx, y, core_y, idx_y) -> tuple[list, list, list, list]:
    """Of each component among x its lightest edge to a point of y in another: component, weight and both ends."""
    best: dict[int, tuple[float, int, int]] = {}
    own, their = label[idx], label[idx_y]
    for lo, d in _distances(x, y):
        w = np.maximum(np.maximum(d, core[lo : lo + len(d), None]), core_y[None])
        w[own[lo : lo + len(d), None] == their[None]] = np.inf
        j = w.argmin(1)
        v = w[np.arange(len(w)), j]
        for i in np.flatnonzero(np.isfinite(v)):
            c = int(own[lo + i])
            if c not in best or v[i] < best[c][0]:
                best[c] = (float(v[i]), int(idx[lo + i]), int(idx_y[j[i]]))
    return [list(z) for z in zip(*[(c, *e) for c, e in best.items()], strict=True)] if best else [[], [], [], []]


_EDGE = pa.schema([("comp", pa.int64()), ("w", pa.float64()), ("p", pa.int64()), ("q", pa.int64())])


def _inside(shared):
    """Lightest edges within a cell."""

    def run(rows: pa.Table) -> pa.Table:
        label, idx = shared.value[0], rows["idx"].to_numpy()
        found = [[], [], [], []]
        if len(np.unique(label[idx])) > 1:
            x, core = _matrix(rows["x"]), rows["core"].to_numpy()
            found = _lightest(label, x, core, idx, x, core, idx)
        return pa.table(found, schema=_EDGE)

    return run


def _near(shared, limits):
    """Whether a point may have a lighter edge to a cell than its component's limit."""

    def run(b: pa.RecordBatch, reach: np.ndarray) -> np.ndarray:
        label, pure = shared.value
        own = label[b.column("idx").to_numpy()]
        return (np.maximum(reach, b.column("core").to_numpy()[:, None]) <= limits.value[own][:, None]) & (pure[None] != own[:, None])

    return run


def _outside(shared):
    """Lightest edges from guests to the points of a cell."""

    def run(guests: pa.Table, hosts: pa.Table) -> pa.Table:
        found = [[], [], [], []]
        if len(guests) and len(hosts):
            part = lambda t: (_matrix(t["x"]), t["core"].to_numpy(), t["idx"].to_numpy())
            found = _lightest(shared.value[0], *part(guests), *part(hosts))
        return pa.table(found, schema=_EDGE)

    return run


def spanning_tree(points: DataFrame, boxes: _Boxes, begin: np.ndarray) -> np.ndarray:
    """Edges (p, q, weight) of a minimum spanning tree of the mutual reachability. points: idx, cell, x, core."""
    spark, n = points.sparkSession, int(begin[-1])
    top = np.zeros(len(begin) - 1)
    for r in points.groupBy("cell").agg(F.max("core").alias("core")).collect():
        top[r.cell] = r.core
    longest = np.maximum(boxes.spread(), np.maximum(top[:, None], top[None]))
    label, edges = np.arange(n), []
    schema = "comp long, w double, p long, q long"

    def leaders(df: DataFrame) -> dict[int, tuple]:
        rows = df.groupBy("comp").agg(F.min(F.struct("w", "p", "q")).alias("e")).collect()  # one a component
        return {r.comp: (r.e.w, r.e.p, r.e.q) for r in rows}

    while len(edges) < n - 1:
        held = [np.unique(label[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]
        pure = np.array([h[0] if len(h) == 1 else -1 for h in held])
        # between whole boxes: what an edge from a component to another cell weighs at most
        bound = np.full(n, np.inf)
        for a in np.flatnonzero(pure >= 0):  # in other cells two components meet anyway
            strange = pure != pure[a]
            if strange.any():
                bound[pure[a]] = min(bound[pure[a]], longest[a][strange].min())
        shared = spark.sparkContext.broadcast((label, pure))
        best = leaders(points.groupBy("cell").applyInArrow(_inside(shared), schema))
        for c, (w, _, _) in best.items():
            bound[c] = min(bound[c], w)
        limits = spark.sparkContext.broadcast(bound)
        if len(begin) > 2:
            guests = points.mapInArrow(_visits("core", _near(shared, limits), boxes), "target int, idx long, x array<double>, core double")
            for c, e in leaders(guests.groupBy("target").cogroup(points.groupBy("cell")).applyInArrow(_outside(shared), schema)).items():
                best[c] = min(best.get(c, e), e)
        parent = {int(c): int(c) for c in np.unique(label)}

        def root(c: int, parent=parent) -> int:
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        for w, p, q in sorted(best.values()):
            a, b = root(int(label[p])), root(int(label[q]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                edges.append((p, q, w))
        to = np.arange(n)
        for c in parent:
            to[c] = root(c)
        label = to[label]
        shared.destroy()
        limits.destroy()
    return np.array(edges, np.float64).reshape(-1, 3)


def stable_clusters(n: int, edges: np.ndarray, least: int) -> np.ndarray:
    """The cluster of each point, numbered by their first points, -1 for noise.

    Going up the tree, points join at rising distances; components that join at one distance join at once. Going down, a component
    that falls into two or more parts of at least `least` points ends there and the parts begin; smaller parts fall out of
    it. A cluster's stability adds up, over its points, the density 1 / distance at which they leave less that at which it began. A
    cluster is chosen over those below it unless they are more stable together; the whole is never one.
    """
    order = np.argsort(edges[:, 2], kind="stable")
    shortest = max(float(edges[:, 2].max(initial=0)) * SHORTEST, 1e-300)
    height, children, size = [0.0] * n, [[] for _ in range(n)], [1] * n
    parent, node = list(range(n)), list(range(n))

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    at = 0
    while at < len(order):
        w = max(edges[order[at], 2], shortest)
        met: dict[int, list[int]] = {}
        while at < len(order) and max(edges[order[at], 2], shortest) == w:
            a, b = (root(int(e)) for e in edges[order[at], :2])
            more, fewer = sorted((met.pop(a, [node[a]]), met.pop(b, [node[b]])), key=len, reverse=True)
            more.extend(fewer)
            met[a], parent[b] = more, a
            at += 1
        for a, parts in met.items():
            node[a] = len(height)
            height.append(w)
            children.append(parts)
            size.append(sum(size[c] for c in parts))
    whole = node[root(0)]
    above, birth, stability, left = [-1], [0.0], [0.0], np.zeros(n, np.int64)
    stack = [(whole, 0)]
    while stack:
        top, c = stack.pop()
        density = 1 / height[top] if height[top] else 0.0
        large = [x for x in children[top] if size[x] >= least]
        for x in children[top]:
            if size[x] >= least and len(large) == 1:
                stack.append((x, c))
                continue
            stability[c] += (density - birth[c]) * size[x]
            if size[x] >= least:
                above.append(c)
                birth.append(density)
                stability.append(0.0)
                stack.append((x, len(above) - 1))
            else:
                below = [x]
                while below:
                    y = below.pop()
                    if y < n:
                        left[y] = c
                    below += children[y]
    value, chosen, under = list(stability), [False] * len(above), [0.0] * len(above)
    for c in range(len(above) - 1, 0, -1):
        chosen[c] = not under[c] > stability[c]
        value[c] = stability[c] if chosen[c] else under[c]
        under[above[c]] += value[c]
    final = [-1] * len(above)
    for c in range(1, len(above)):  # a cluster above comes first
        final[c] = final[above[c]] if final[above[c]] >= 0 else c if chosen[c] else -1
    of = np.array([final[c] for c in left.tolist()], np.int64)
    names: dict[int, int] = {}
    return np.array([-1 if c < 0 else names.setdefault(c, len(names)) for c in of.tolist()], np.int64)


def density_clusters(points: DataFrame, least: int, neighbours: int | None = None) -> DataFrame:
    """s and cluster (from 0, by the first name; -1 for noise) of points (s, x: array of doubles).

    least: points of a cluster at least; neighbours: which neighbour's distance is a point's core distance (as many as `least` if not
    given). Names are unique and coordinates finite. Fewer points than two clusters need are all noise; no point, no row. More than POINTS points
    are refused, as their tree is cut on the driver.
    """
    n = points.count()
    if n > POINTS:
        raise ValueError(f"{n} points: at most {POINTS} can be clustered")
    if n < 2:
        return points.select("s", F.lit(-1).cast("long").alias("cluster"))
    from ..plans.scratch import written

    spark = points.sparkSession
    k = min(neighbours or least, n - 1)
    placed, boxes, begin = _placed(points, n, k + 1)
    cores = written(core_distances(placed, boxes, k), "cores")
    names = {r.idx: r.s for r in placed.select("idx", "s").collect()}  # at most POINTS
    order = sorted(range(n), key=names.__getitem__)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    edges = spanning_tree(cores, boxes, begin)
    edges[:, 0], edges[:, 1] = place[edges[:, 0].astype(int)], place[edges[:, 1].astype(int)]
    of = stable_clusters(n, edges, least)
    return spark.createDataFrame([(names[i], int(c)) for i, c in zip(order, of.tolist(), strict=True)], "s string, cluster long")
