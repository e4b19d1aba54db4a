"""Centroid clustering of integer vectors; nearest centroids by a vantage-point tree."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import tidy

#: Centroids in a leaf of the tree at most.
LEAF = 4
#: Vectors that are searched for at once.
BLOCK = 4096
#: Integer components are held within this reach, so that their sums fit 38 digits.
REACH = 10**18
#: Distances are 64-bit; a longer one is returned as this.
LONGEST = 2**63 - 1
#: What square roots and their differences may be off by, relative to their size: bounds are eased by it, never sharpened.
EASE = 1e-14


def _as_numbers(x: np.ndarray, other: int) -> np.ndarray:
    """x in a type in which squared distances to vectors within `other` are exact: doubles, longs or Python's integers."""
    reach = max(int(abs(x).max(initial=0)), other)
    most = x.shape[1] * (2 * reach) ** 2
    return x.astype(np.float64 if most < 2**53 else np.int64 if most < 2**63 else object)


class CentroidTree:
    """A vantage-point tree over centroids.

    An inner node holds one centroid, its vantage point, and halves the others by their distance to it; each half knows the least
    and the largest of these distances. A leaf holds up to LEAF centroids. `nearest` searches best first, each vector by its own
    order of nodes: a node whose bound is at most the best distance so far is entered (equal ones too, since an equally near
    centroid of smaller number may be there), all else is cut. Distances are exact integers; bounds are square roots, eased by
    their rounding.
    """

    def __init__(self, centroids: np.ndarray, leaf: int = LEAF):
        self.centroids = centroids
        self.reach = int(abs(centroids).max(initial=0))
        self.leaf = leaf
        self.nodes: list[dict] = []
        self._build(np.arange(len(centroids)))

    def _build(self, members: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append({})
        if len(members) <= self.leaf:
            self.nodes[at] = {"members": members, "halves": []}
            return at
        vantage, rest = members[:1], members[1:]
        far = np.sqrt(self._distances(_as_numbers(self.centroids[rest], self.reach), vantage)[:, 0].astype(np.float64))
        order = np.argsort(far, kind="stable")
        cut = len(order) // 2
        halves = [(self._build(np.sort(rest[h])), far[h].min(), far[h].max()) for h in (order[:cut], order[cut:]) if len(h)]
        self.nodes[at] = {"members": vantage, "halves": halves}
        return at

    def _distances(self, q: np.ndarray, members: np.ndarray) -> np.ndarray:
        c = self.centroids[members].astype(q.dtype)
        if q.dtype == np.float64:  # whole numbers below 2^53, whatever the order of the sums
            return (q * q).sum(1)[:, None] + (c * c).sum(1) - 2 * (q @ c.T)
        return np.stack([((q - x) ** 2).sum(1) for x in c], 1)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the nearest centroid of each vector (of equally near ones the smallest), and the squared distance."""
        q = _as_numbers(vectors, self.reach)
        who, best = np.full(len(q), -1), np.zeros(len(q), q.dtype)
        bound = np.full((len(q), len(self.nodes)), np.inf)
        bound[:, 0] = 0
        active = np.arange(len(q))
        while len(active):
            node = bound[active].argmin(1)
            radius = np.where(who[active] < 0, np.inf, np.sqrt(best[active].astype(np.float64)) * (1 + EASE))
            inside = bound[active, node] <= np.minimum(radius, np.finfo(float).max)
            active, node = active[inside], node[inside]
            for x in np.unique(node):
                rows = active[node == x]
                members, halves = self.nodes[x]["members"], self.nodes[x]["halves"]
                far = self._distances(q[rows], members)
                j = far.argmin(1)  # the first of equals; members are in rising order
                d, c = far[np.arange(len(rows)), j], members[j]
                better = (who[rows] < 0) | (d < best[rows]) | ((d == best[rows]) & (c < who[rows]))
                best[rows[better]], who[rows[better]] = d[better], c[better]
                if halves:
                    r = np.sqrt(far[:, 0].astype(np.float64))
                    for child, low, high in halves:
                        ease = EASE * (r + high)
                        bound[rows, child] = np.maximum(bound[rows, x], np.maximum(r - high, low - r) - ease)
                bound[rows, x] = np.inf
        return who, best if q.dtype == object else best.astype(np.int64)


def _whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) in doubles."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * x.astype(np.float64)), -REACH, REACH).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int, scale: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and integer vectors of what is kept, a block at a time."""
    for batch in batches:
        right = pc.fill_null(pc.equal(pc.list_value_length(batch.column(1)), dims), False)
        batch = batch.filter(right)
        for lo in range(0, batch.num_rows, BLOCK):
            part = batch.slice(lo, BLOCK)
            x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)  # a null becomes NaN
            finite = np.isfinite(x.astype(np.float64)).all(1)
            yield part.column(0).filter(pa.array(finite)), _whole(x[finite], scale)


def _sums(tree, dims: int, scale: int):
    """Rows (cluster, dim, total, n) of a task: component sums, and the sum of distances as dimension -1."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, np.ndarray]] = {}
        for _, x in _blocks(batches, dims, scale):
            if not len(x):
                continue
            who, far = tree.value.nearest(x)
            order = np.argsort(who, kind="stable")
            clusters, first, n = np.unique(who[order], return_index=True, return_counts=True)
            wide = np.concatenate([x.astype(object), far.astype(object)[:, None]], 1) if _wide(x, far) else np.column_stack([x, far])
            totals = np.add.reduceat(wide[order], first, axis=0).astype(object)
            for c, k, t in zip(clusters.tolist(), n.tolist(), totals, strict=True):
                before = found.get(c, (0, 0))
                found[c] = (before[0] + k, before[1] + t)
        rows = [(c, d if d < dims else -1, Decimal(int(v)), n) for c, (n, t) in sorted(found.items()) for d, v in enumerate(t)]
        kinds = (pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["cluster", "dim", "total", "n"])

    return run


def _wide(x: np.ndarray, far: np.ndarray) -> bool:
    """Whether a block's sums may leave 64 bits."""
    return far.dtype == object or max(int(abs(x).max()), int(far.max())) * len(x) >= 2**63


def _assign(tree, dims: int, scale: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks(batches, dims, scale):
            who, far = tree.value.nearest(x)
            yield pa.RecordBatch.from_arrays([ids, pa.array(who, pa.int32()), pa.array([min(int(d), LONGEST) for d in far], pa.int64())], names=["vec_id", "cluster", "distance"])

    return run


def _gathered(vectors: DataFrame, tree, dims: int, scale: int) -> dict[int, tuple[int, list[int], int]]:
    """Of each cluster its size, component sums and sum of distances: k times dims + 1 numbers."""
    sums = vectors.mapInArrow(_sums(tree, dims, scale), "cluster int, dim int, total decimal(38,0), n long")
    out: dict[int, tuple[int, list[int], int]] = {}
    for r in sums.groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        n, totals, far = out.setdefault(r.cluster, (r.n, [0] * dims, 0))
        if r.dim < 0:
            out[r.cluster] = (n, totals, int(r.total))
        else:
            totals[r.dim] = int(r.total)
    return out


def first_centroids(vectors: DataFrame, k: int, seed: int, dims: int, scale: int) -> np.ndarray:
    """The k kept vectors with the smallest SHA-256 of '<seed>:<vec_id>', as integers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    kept = vectors.where((F.size("embedding") == dims) & finite)
    by = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(by.asc_nulls_last(), "embedding").select("embedding").limit(k).collect()
    return _whole(np.array([r.embedding for r in rows], np.float64).reshape(-1, dims), scale)


def cluster_vectors(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3, leaf: int = LEAF) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid (array of long) of every kept vector.

    A vector (`embedding`, an array) is kept if it has `dims` components, none null or non-finite; a component x becomes
    floor(scale * x). The first centroids are the kept vectors with the smallest SHA-256 of '<seed>:<vec_id>'. A round assigns
    each vector to the nearest centroid (ties: the smaller number) and replaces each centroid that has vectors by their floored
    mean; after the last round all are assigned once more. The tree over the centroids is built anew and broadcast each round
    (k times dims numbers); a task returns the sums of its vectors by cluster, so no vector is shuffled, however many repeat. A
    round that changes no centroid is the last one that is worked out, as all others would repeat it. The table is scanned
    once a round; nothing is kept between rounds but the centroids, on the driver.

    A null vec_id is assigned like any other and seeds a centroid last; repeated rows are assigned each by itself, and seed in
    the order of their components. Fewer than k kept vectors make as many centroids; none, or an empty table, an empty result.
    Components beyond 10^18 count as that, squared distances beyond 64 bits are returned as the largest long. Other columns are
    not looked at.
    """
    spark = vectors.sparkSession
    vectors = vectors.select("vec_id", "embedding")
    centroids = first_centroids(vectors, k, seed, dims, scale)
    fields = [*vectors.select("vec_id").schema, T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
    if not len(centroids):
        return spark.createDataFrame([], T.StructType([*fields, *(T.StructField(c, T.LongType()) for c in ("cluster_inertia", "inertia")), T.StructField("centroid", T.ArrayType(T.LongType()))]))
    for _ in range(rounds):
        tree = spark.sparkContext.broadcast(CentroidTree(centroids, leaf))
        moved = centroids.copy()
        for c, (n, totals, _far) in _gathered(vectors, tree, dims, scale).items():
            moved[c] = [t // n for t in totals]
        tree.destroy()
        if (moved == centroids).all():
            break
        centroids = moved
    tree = spark.sparkContext.broadcast(CentroidTree(centroids, leaf))
    far = {c: x[2] for c, x in _gathered(vectors, tree, dims, scale).items()}
    whole = min(sum(far.values()), LONGEST)
    rows = [(c, min(d, LONGEST), whole, centroids[c].tolist()) for c, d in far.items()]
    named = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<bigint>")
    out = vectors.mapInArrow(_assign(tree, dims, scale), T.StructType(fields))
    return out.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")  # at most k rows


def centroid_digest(centroid: list[int]) -> str:
    """SHA-256 of the components as decimal integers joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
