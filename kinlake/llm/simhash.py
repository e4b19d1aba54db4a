"""SimHash near-duplicates: fingerprints linked within a Hamming radius through BK-trees."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, materialise, mix, one_of_each, remove_rows, small, text_chunks, text_key, tidy
from .components import components

SHINGLE, RADIUS, SEED = 3, 2, 42
#: The 64 bits are cut into this many blocks; within RADIUS bits at least BLOCKS - RADIUS blocks are equal.
BLOCKS = 4


#: Shingles of one text whose hashes are held at once.
SHINGLES = 50_000


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """In how many of the hashes each bit is set."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(counts: np.ndarray, n: int) -> int:
    """Bit b is 1 where it is set in over half of the n hashes."""
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(column: pa.Array) -> list[int]:
    out, h64 = [], xxhash.xxh64_intdigest
    for lo, hi, texts in text_chunks(column):
        w = Words(texts, lower=True)
        data, first = w.data, w.first
        for k in range(hi - lo):
            i, j = int(first[k]), int(first[k + 1])
            if i == j:
                out.append(0)
                continue
            size = min(SHINGLE, j - i)
            counts = np.zeros(64, np.int64)
            for at in range(i, j - size + 1, SHINGLES):
                to = min(at + SHINGLES, j - size + 1)
                spans = zip(w.starts[at:to].tolist(), w.ends[at + size - 1 : to + size - 1].tolist(), strict=True)
                counts += bit_counts(np.array([h64(data[a:b], SEED) for a, b in spans], np.uint64))
            out.append(fingerprint(counts, j - i - size + 1))
    return out


@tidy
def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array(_fingerprints(batch.column(2)), np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], names=["doc_id", "text_key", "fp"])


class BKTree:
    """BK-tree over 64-bit values: a child hangs on the edge that carries its Hamming distance to the parent."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.children: dict[int, list[tuple[int, int]]] = {}
        todo = [(0, np.arange(1, len(values)))] if len(values) else []
        while todo:
            node, below = todo.pop()
            if not len(below):
                continue
            d = np.bitwise_count(values[below] ^ values[node]).astype(np.int64)
            order = np.argsort(d, kind="stable")
            below, d = below[order], d[order]
            cut = np.flatnonzero(np.diff(d, prepend=-1))
            self.children[node] = [(int(d[c]), int(below[c])) for c in cut]
            todo += [(int(g[0]), g[1:]) for g in np.split(below, cut[1:])]

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(node, numbers of the queries within the radius of it); only edges within the radius are followed."""
        todo = [(0, np.arange(len(queries)))] if len(self.values) else []
        while todo:
            node, asked = todo.pop()
            d = np.bitwise_count(queries[asked] ^ self.values[node]).astype(np.int64)
            yield node, asked[d <= radius]
            for edge, child in self.children.get(node, ()):
                if len(on := asked[np.abs(d - edge) <= radius]):
                    todo.append((child, on))


def forest(values: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links (value number, number of its tree's root) that join what is reachable; not all pairs."""
    parent = np.arange(len(values))

    def roots(x: np.ndarray) -> np.ndarray:
        r = parent[x]
        while not np.array_equal(up := parent[r], r):
            r = up
        parent[x] = r
        return r

    for node, near in BKTree(values).within(values, radius):
        if len(near) > 1:
            r = np.unique(roots(np.append(near, node)))
            parent[r] = r[0]
    every = roots(np.arange(len(values)))
    return [(i, int(r)) for i, r in enumerate(every) if i != r]


@tidy
def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by shard; a shard may run over several batches."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def out(kind: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        cut = np.flatnonzero((np.diff(kind, prepend=-1) != 0) | (np.diff(key, prepend=key[:1]) != 0))
        size = np.diff(np.append(cut, len(key)))
        pairs = [(fp[c + i], fp[c + r]) for c, n in zip(cut[size > 1], size[size > 1], strict=True) for i, r in forest(fp[c : c + n].view(np.uint64))]
        a = np.array(pairs, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        kind, key, fp = (batch.column(i).to_numpy() for i in range(3))
        if held:
            kind, key, fp = (np.concatenate(x) for x in zip(*held, (kind, key, fp), strict=True))
            held = []
        last = int(np.flatnonzero((kind != kind[-1]) | (key != key[-1]))[-1]) + 1 if (kind[0], key[0]) != (kind[-1], key[-1]) else 0
        held = [(kind[last:], key[last:], fp[last:])]
        if last:
            yield out(kind[:last], key[:last], fp[:last])
    if held:
        yield out(*held[0])


def _shards() -> Column:
    """For each choice of blocks that can all be equal within the radius: its number and their bits."""
    width = 64 // BLOCKS
    part = lambda b: F.shiftrightunsigned(F.shiftleft("fp", 64 - width * (b + 1)), 64 - width)
    keys = []
    for n, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - RADIUS)):
        key = F.lit(0).cast("long")
        for b in chosen:
            key = F.shiftleft(key, width).bitwiseOR(part(b))
        keys.append(F.struct(F.lit(n).alias("kind"), key.alias("key")))
    return F.inline(F.array(*keys))


def simhash_groups(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, fp (the fingerprint's 64 bits as a long) and component_id of every document.

    Texts are lower-cased (A-Z), cut into words [^\\x20\\x09-\\x0D]+ and 3-word shingles, repeats included (a text of
    fewer words is one shingle; null or no word: fingerprint zero, linked like any other). h is a shingle's XXH64
    with seed 42; a bit is 1 if set in over half of the h. Fingerprints within 2 bits are linked; component_id is
    the smallest doc_id reachable, a document's own included (null doc_ids count only where a group has no other).
    Rows that repeat a doc_id are documents of their own. An empty table gives an empty result; other columns are
    not looked at. Texts of any length are read whole.

    Equal fingerprints are made one before anything is compared. Two fingerprints within 2 bits agree on two of four
    16-bit blocks, so for each of the six choices of two blocks the fingerprints are dealt by those 32 bits, and each
    such shard is searched through its own BK-tree. No tree covers the whole corpus, since such a one could not be
    broadcast at scale; shards yield spanning links, never all pairs.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")
    rows = materialise(rows.mapInArrow(_scan, "doc_id long, text_key long, fp long"), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    dealt = distinct.select(_shards(), "fp").repartition("kind", "key").sortWithinPartitions("kind", "key")
    links = dealt.mapInArrow(_link, "a long, b long")
    roots = components(links)
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    linked = named.where("root <> fp").select("root").distinct()
    names = named.join(linked, "root", "left_semi").groupBy("root").agg(F.min("least").alias("component_id"))
    members = named.join(names, "root").select("fp", "component_id")
    # fingerprints alone in their component keep their own least id
    ids = distinct.join(small(materialise(members, "members")), "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return rows.join(ids, "fp").select("doc_id", "text_key", "fp", "component_id")


#: The pipeline's stage: words in a shingle, and the least Jaccard similarity of shingle sets that makes two texts near copies.
STAGE_SHINGLE, SIMILAR = 5, 0.8
#: Words' multipliers within a shingle.
_ODD = np.random.default_rng(SEED).integers(1 << 62, 1 << 63, STAGE_SHINGLE, dtype=np.uint64) | np.uint64(1)
#: One document in so many is looked at to find shingles that many documents have: of those, the most frequent, at most so many, come last in
#: the order of shingles. Any order gives the same groups; a good one makes fewer pairs.
LOOKED_AT, OFTEN, LAST = 8, 8, 200_000
#: Documents of a larger bucket that are held against all of other groups there, by round: a few first, since what they join needs no further
#: comparison, then every one.
LEADERS = (4, None)
#: Documents of a bucket whose pairs are made in one piece; of larger ones a task holds so many documents against the others at once.
FEW, SHARE = 64, 1024
#: Longs of a parity map, bits of one that is made for documents of candidate pairs only, and pairs whose texts are looked at in one step.
LONGS, WIDE, TEXTS = 8, 4096, 100


def _shingles(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the five-word shingles, where each text's begin); a text of fewer words is one shingle."""
    w = Words(texts, lower=True)
    n = len(w.starts)
    h = np.concatenate((w.hashes(), np.zeros(STAGE_SHINGLE, np.uint64)))
    full = mix(sum(h[j : j + n] * _ODD[j] for j in range(STAGE_SHINGLE)))
    whole = np.arange(n) + STAGE_SHINGLE <= w.first[1:][w.row]
    size = np.maximum(w.counts - STAGE_SHINGLE + 1, 1)
    starts = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint64)
    short = np.flatnonzero(w.counts < STAGE_SHINGLE)
    taken = np.ones(len(out), bool)
    taken[starts[short]] = False
    out[taken] = full[whole]
    for k in short:
        at, c = int(w.first[k]), int(w.counts[k])
        out[starts[k]] = mix(np.array([(h[at : at + c] * _ODD[:c]).sum() + np.uint64(c)], np.uint64))[0]
    return out, starts


def _prefix(size: int) -> int:
    """How many of a set's first shingles, in the order of all, two sets of the similarity must have one in common of."""
    return size - math.ceil(SIMILAR * size - 1e-9) + 1


@tidy
def _each_shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, text) to the distinct shingles of each text."""
    for batch in batches:
        for _, _, texts in text_chunks(batch.column(1)):
            hashes, starts = _shingles(texts)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.unique(x) for x in np.split(hashes, starts[1:])]).view(np.int64))], names=["shingle"])


def _firsts(often: np.ndarray):
    """(row, text) to (row, size of its set, parity map, its first shingles). often: shingles that come last, the most frequent at the end;
    others come in the order of their hashes. Bit b of the map is the parity of the shingles that fall on b, so that maps
    differ in at most as many bits as their sets differ in shingles."""
    by_hash = np.argsort(often)
    known, places = often[by_hash], by_hash + 1

    def firsts(x: np.ndarray) -> np.ndarray:
        n = _prefix(len(x))
        if len(known):
            at = np.minimum(np.searchsorted(known, x), len(known) - 1)
            last = np.where(known[at] == x, places[at], 0)
            x = x[np.argsort(last, kind="stable")]
        return x[:n]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in text_chunks(batch.column(1)):
                hashes, starts = _shingles(texts)
                sets = [np.unique(x) for x in np.split(hashes, starts[1:])]
                found = [firsts(x) for x in sets]
                maps = np.stack([np.packbits(np.bincount((x >> np.uint64(32)) % np.uint64(64 * LONGS), minlength=64 * LONGS) % 2 == 1, bitorder="little").view("<i8") for x in sets])
                lists = lambda flat, ends: pa.ListArray.from_arrays(pa.array(np.asarray(ends, np.int32)), pa.array(flat))
                keys = lists(np.concatenate(found).view(np.int64), np.cumsum([0, *map(len, found)]))
                cols = [batch.column(0).slice(lo, hi - lo), pa.array([len(x) for x in sets], pa.int32()), lists(maps.reshape(-1), np.arange(hi - lo + 1) * LONGS), keys]
                yield pa.RecordBatch.from_arrays(cols, names=["row", "size", "bits", "keys"])

    return run


@tidy
def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of pairs with both texts to those whose shingle sets have at least the similarity, without the texts."""
    for batch in batches:
        kept = np.zeros(batch.num_rows, bool)
        names = batch.schema.names[:-2]
        for lo in range(0, batch.num_rows, TEXTS):
            ones, others = (batch.column(len(names) + k).slice(lo, TEXTS).cast(pa.binary()).to_pylist() for k in (0, 1))
            hashes, starts = _shingles(ones + others)
            sets = [np.unique(x) for x in np.split(hashes, starts[1:])]
            for k, (x, y) in enumerate(zip(sets[: len(ones)], sets[len(ones) :], strict=True)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                kept[lo + k] = both >= SIMILAR * (len(x) + len(y) - both) - 1e-9
        yield batch.select(names).filter(pa.array(kept))


@tidy
def _wide_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, text) to (row, size of its set, a parity map of WIDE bits)."""
    for batch in batches:
        for lo, hi, texts in text_chunks(batch.column(1)):
            hashes, starts = _shingles(texts)
            sets = [np.unique(x) for x in np.split(hashes, starts[1:])]
            maps = [np.packbits(np.bincount((x >> np.uint64(32)) % np.uint64(WIDE), minlength=WIDE) % 2 == 1).tobytes() for x in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([len(x) for x in sets], pa.int32()), pa.array(maps)], names=["row", "size", "map"])


@tidy
def _near_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of pairs with both sizes and maps to those that may be similar, without these columns."""
    for batch in batches:
        if batch.num_rows:
            n, m, x, y = (batch.column(batch.num_columns - 4 + k) for k in range(4))
            bits = lambda c: np.frombuffer(b"".join(c.to_pylist()), np.uint64).reshape(batch.num_rows, -1)
            differ = np.bitwise_count(bits(x) ^ bits(y)).sum(axis=1, dtype=np.int64)
            near = differ <= (n.to_numpy().astype(np.int64) + m.to_numpy()) * ((1 - SIMILAR) / (1 + SIMILAR)) + 1e-9
            yield batch.select(batch.schema.names[:-4]).filter(pa.array(near))


def _similar(pairs: DataFrame, named: DataFrame) -> DataFrame:
    """The rows of pairs (a, b, ...: longs) whose shingle sets have at least the similarity, counted exactly. Texts travel rather than their
    sets, which are longer and can't be compressed, and only those of pairs that wider parity maps leave."""
    schema = ", ".join(f"{c} long" for c in pairs.columns)
    pairs = materialise(pairs, "pairs")
    ids = lambda: small(materialise(pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct(), "rows"))
    maps = named.join(ids(), "row", "left_semi").select("row", "text").mapInArrow(_wide_maps, "row long, size int, map binary").dropDuplicates(["row"])
    maps = materialise(maps, "maps")
    of = lambda c: maps.select(F.col("row").alias(c), F.col("size").alias(f"size_{c}"), F.col("map").alias(f"map_{c}"))
    near = pairs.join(of("a"), "a").join(of("b"), "b").select(*pairs.columns, "size_a", "size_b", "map_a", "map_b")
    pairs = materialise(near.mapInArrow(_near_maps, schema), "pairs")
    texts = named.join(ids(), "row", "left_semi").select("row", "text").dropDuplicates(["row"])
    side = lambda c: texts.select(F.col("row").alias(c), F.col("text").alias(f"text_{c}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b").select(*pairs.columns, "text_a", "text_b")
    return rows.mapInArrow(_checked, schema)


def _united(names: DataFrame, pairs: DataFrame, named: DataFrame) -> DataFrame:
    """names (row, root) after the roots of pairs (a, b, root_a, root_b) of the similarity were made one."""
    new = materialise(_similar(pairs, named).select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct(), "near")
    if new.isEmpty():
        return names
    merged = small(materialise(components(new).select(F.col("node").alias("root"), F.col("root").alias("into")), "merged"))
    return materialise(names.join(merged, "root", "left").select("row", F.coalesce("into", "root").alias("root")), "names")


def _often(texts: DataFrame) -> np.ndarray:
    """Shingles that many documents have, the most frequent at the end."""
    looked = texts.where(F.pmod("row", F.lit(LOOKED_AT)) == 0).select("row", "text").mapInArrow(_each_shingle, "shingle long")
    found = looked.groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") >= OFTEN).orderBy(F.desc("n"), "shingle").limit(LAST).collect()
    return np.array([r.shingle for r in reversed(found)], np.int64).view(np.uint64)


def _buckets(texts: DataFrame, repeated: bool) -> tuple[DataFrame, DataFrame]:
    """(key, row, n): the documents of each bucket of several, and their number; and (row, size, bits). Sets of the similarity have one
    of their first shingles in common, so that each such pair shares a bucket."""
    found = texts.select("row", "text").mapInArrow(_firsts(_often(texts)), "row long, size int, bits array<long>, keys array<long>")
    found = materialise(found.dropDuplicates(["row"]) if repeated else found, "firsts")
    keys = found.select("row", F.explode("keys").alias("key"))
    shared = keys.withColumn("n", F.count("*").over(Window.partitionBy("key"))).where("n > 1")  # one shuffle, whatever the size
    return materialise(shared, "shared"), found.select("row", "size", "bits")


@tidy
def _pairs_within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rows, sizes, bits) of buckets to (a, b): their pairs that may be similar (as in _may_be_similar)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        row, size = (batch.column(c).flatten().to_numpy() for c in (0, 1))
        bits = batch.column(2).flatten().flatten().to_numpy().view(np.uint64).reshape(-1, LONGS)
        n = np.diff(batch.column(0).offsets.to_numpy())
        bucket = np.repeat(np.arange(len(n)), n)
        found = [np.empty((0, 2), np.int64)]
        for d in range(1, int(n.max())):
            at = np.flatnonzero(bucket[d:] == bucket[:-d])
            x, y = size[at].astype(np.float64), size[at + d].astype(np.float64)
            at = at[np.minimum(x, y) >= SIMILAR * np.maximum(x, y) - 1e-9]
            differ = np.bitwise_count(bits[at] ^ bits[at + d]).sum(axis=1, dtype=np.int64)
            at = at[differ <= (size[at].astype(np.int64) + size[at + d]) * ((1 - SIMILAR) / (1 + SIMILAR)) + 1e-9]
            found.append(np.sort(np.column_stack([row[at], row[at + d]]), axis=1))
        pairs = np.unique(np.concatenate(found), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _in_several_groups(buckets: DataFrame, names: DataFrame, over: int) -> DataFrame:
    """Rows of buckets of over `over` documents that are not all of one root, with their roots."""
    rooted = materialise(buckets.join(names, "row"), "rooted")
    still = rooted.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.max("n").alias("of")).where(F.expr("least <> most") & (F.col("of") > over)).select("key")
    return rooted.join(small(materialise(still, "open")), "key")


def _may_be_similar(x: str, y: str) -> Column:
    """False only for pairs whose sets can't have the similarity: by their sizes, and by the bits in which their parity maps differ."""
    n, m = F.col(f"{x}.size"), F.col(f"{y}.size")
    differ = F.lit(0)
    for k in range(LONGS):
        differ = differ + F.bit_count(F.get(f"{x}.bits", F.lit(k)).bitwiseXOR(F.get(f"{y}.bits", F.lit(k))))
    return (F.least(n, m) >= SIMILAR * F.greatest(n, m) - 1e-9) & (differ <= (n + m) * (1 - SIMILAR) / (1 + SIMILAR) + 1e-9)


def _merge(buckets: DataFrame, names: DataFrame, sizes: DataFrame, named: DataFrame) -> DataFrame:
    """names (row, root) after growing numbers of a bucket's documents, in the end all, were held against those of other groups in it. What
    is held against each other is dealt by parts of a bucket, so that a large one is the work of many tasks."""
    low = 0
    for high in LEADERS:
        rest = _in_several_groups(buckets, names, low).where("row <> first").withColumn("rank", F.pmod(F.xxhash64("key", "row"), F.col("n"))).where(F.col("rank") >= low)
        rest = materialise(rest.join(sizes, "row").select("key", "rank", F.struct("row", "root", "size", "bits").alias("x"), F.ceil(F.col("n") / SHARE).cast("int").alias("parts")), "rest")
        if rest.isEmpty():
            break
        lead = (rest if high is None else rest.where(F.col("rank") < high)).select("key", F.col("x").alias("y"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        dealt = rest.withColumn("part", F.pmod(F.xxhash64(F.col("x.row")), "parts").cast("int"))
        pairs = dealt.join(lead, ["key", "part"]).where(F.col("x.root") != F.col("y.root"))
        pairs = (pairs.where(F.col("x.row") < F.col("y.row")) if high is None else pairs).where(_may_be_similar("x", "y"))
        before = F.col("x.row") < F.col("y.row")
        either = lambda c, swap: F.when(before != swap, F.col(f"x.{c}")).otherwise(F.col(f"y.{c}"))
        pairs = pairs.select(either("row", False).alias("a"), either("row", True).alias("b"), either("root", False).alias("root_a"), either("root", True).alias("root_b")).distinct()
        names = _united(names, pairs, named)
        low = high
    return names


def near_copies(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two tables of doc_id and text_key: the rows that drop_near_copies removes, and of the others those names that several rows have."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text").withColumn("row", F.xxhash64("doc_id", "text_key"))
    again = materialise(named.groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1"), "again")
    shared, sizes = _buckets(named, not again.isEmpty())
    few = shared.where(F.col("n") <= FEW).select("key", "row").join(sizes, "row").groupBy("key").agg(F.collect_list(F.struct("row", "size", "bits")).alias("x"))
    pairs = few.select("x.row", "x.size", "x.bits").mapInArrow(_pairs_within, "a long, b long")
    # in larger buckets every document is held against the first at first: as many pairs as rows
    many = shared.where(F.col("n") > FEW)
    many = materialise(many.join(small(many.groupBy("key").agg(F.min("row").alias("first"))), "key"), "many")
    of = lambda c: sizes.select(F.col("row").alias(c), F.struct("size", "bits").alias(f"of_{c}"))
    firsts = many.where("row <> first").select(F.col("first").alias("a"), F.col("row").alias("b")).distinct()
    firsts = firsts.join(of("a"), "a").join(of("b"), "b").where(_may_be_similar("of_a", "of_b")).select("a", "b")
    pairs = materialise(pairs.unionByName(firsts).distinct(), "candidates")
    links = materialise(_similar(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), named), "near")
    roots = small(materialise(components(links).withColumnRenamed("node", "row"), "roots"))
    ids = materialise(pairs.select(F.explode(F.array("a", "b")).alias("row")).unionByName(many.select("row")).distinct(), "rows")
    names = materialise(ids.join(roots, "row", "left").withColumn("root", F.coalesce("root", "row")), "names")
    named_as = lambda c: small(names.select(F.col("row").alias(c), F.col("root").alias(f"root_{c}")))
    names = _united(names, pairs.join(named_as("a"), "a").join(named_as("b"), "b").where("root_a <> root_b").select("a", "b", "root_a", "root_b"), named)
    names = _merge(many, names, sizes, named)
    members = materialise(names.join(named.select("row", "doc_id", "text_key"), "row"), "members")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    kept = members.groupBy("root").agg(F.min(rank).alias("kept")).repartition("root")
    return members.join(kept, "root").where(rank != F.col("kept")).select("doc_id", "text_key"), again


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of near copies, columns unchanged, whatever their names: the one of the smallest doc_id (null
    comes last). Of rows that repeat a doc_id and text one stays; a null text equals an empty one, and such texts are near copies of
    each other. An empty table gives an empty result; texts of any length are compared whole.

    Near copies have sets of five-word shingles (texts as in simhash_groups) of Jaccard similarity 0.8 or more; groups are what such
    pairs link, all of them: no pair is missed. 64 bits of SimHash differ by 10 on average at 0.8, so that no blocks of a useful length
    stay equal within a radius that holds every pair. Candidates are therefore the documents that share one of the first fifth of their
    shingles in one order of all, with frequent ones last (prefix filter), which every pair of the similarity does. In a bucket of up to 64
    every two are held against each other, one pair a document first, then those that it leaves in different groups. In a larger one every document is held against the first; where that leaves it in several groups,
    a few and then all of its documents are held against those of other groups. Sizes and parity maps rule out most pairs that can't be similar, and each pair that counts is checked against
    both full sets. What is left over is quadratic in a bucket of many documents that are nearly, but not quite, similar.
    """
    gone, again = near_copies(docs)
    return one_of_each(remove_rows(docs, gone), again)
