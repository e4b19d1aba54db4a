"""Exact substring deduplication over word windows by super-k-mer partitioning."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, mix, text_bytes, text_chunks, text_key, tidy

WINDOW, MMER = 35, 4
#: Bytes of packed strings that a bucket holds on average (before compression).
BUCKET_BYTES = 6_000_000
#: Windows of one packed string at most; a longer run travels as several strings.
RUN = 512
#: Minimisers are weighed in so many cells a bucket; the windows of a cell of over HOT_BYTES travel one by one, dealt by their own hash.
CELLS, HOT_BYTES = 16, 12_000_000
#: Heavy cells whose numbers every task holds (8 MB); were there more, the lighter ones would stay whole.
HOT_CELLS = 1_000_000
#: Buckets of one task, on average.
TASK_BUCKETS = 10
#: Bytes of strings that a task packs together, and repeated strings it remembers to have sent.
PACK_BYTES, SENT = 12_000_000, 20_000

PACKED = "bucket int, doc_id long, text_key long, dups binary, block binary"
SPANS = "doc_id long, text_key long, dups binary"


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values."""
    size = 1
    while 2 * size <= width:
        h, size = np.minimum(h[:-size], h[size:]), 2 * size
    return np.minimum(h[: len(h) - (width - size)], h[width - size :]) if size < width else h


#: Low bits of a minimiser's key that hold its position, to tell one occurrence from several.
_PLACE = np.uint64((1 << 24) - 1)


def window_hashes(h: np.ndarray) -> np.ndarray:
    """A hash for the WINDOW words from each place on."""
    roll = np.zeros(max(0, len(h) - WINDOW + 1), np.uint64)
    for k in range(WINDOW):
        roll = roll * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(roll)]
    return roll


def _stretch(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ..., start + count - 1 of every pair, one after another."""
    return np.repeat(start, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)


def super_kmers(w: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of one text that share a minimiser: first word, number of windows, minimiser, and whether the
    minimiser stands at several places in the run (only then can a window occur twice inside it). h: the words' hashes."""
    none = np.zeros(0, np.int64)
    if len(w.starts) < WINDOW:
        return none, none, none, none.astype(bool)
    n = len(h) - MMER + 1
    m = h[:n].copy()
    for k in range(1, MMER):
        m = m * np.uint64(0x100000001B3) + h[k : n + k]
    m = mix(m) & ~_PLACE
    at = np.arange(n, dtype=np.uint64) & _PLACE
    left, right = (_sliding_min(m | x, WINDOW - MMER + 1) for x in (at, _PLACE - at))
    start = np.flatnonzero(w.row[: len(left)] == w.row[WINDOW - 1 :])
    if not len(start):
        return none, none, none, none.astype(bool)
    left, right = left[start], right[start]
    low = (left >> np.uint64(24)).astype(np.int64)
    new = (np.diff(start, prepend=-2) != 1) | (np.diff(low, prepend=-1) != 0)
    cut = np.flatnonzero(new)
    size = np.diff(np.append(cut, len(start)))
    if size.max() > RUN:
        reps = -(-size // RUN)
        part = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        cut = np.repeat(cut, reps) + part * RUN
        size = np.diff(np.append(cut, len(start)))
    many = ((left & _PLACE) != _PLACE - (right & _PLACE)) | np.append(False, (left[1:] != left[:-1]) & ~new[1:])
    return start[cut], size, low[cut], np.add.reduceat(many, cut) > 0


def _weigh(cells: int):
    """Texts to bytes of packed strings by cell of minimisers; strings that repeat within a stretch count once, as they travel."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for _, _, texts in text_chunks(batch.column(0)):
                w = Words(texts)
                h = w.hashes()
                first, count, low, _ = super_kmers(w, h)
                if not len(first):
                    continue
                once = np.unique(mix(window_hashes(h)[first] + count.astype(np.uint64)), return_index=True)[1]
                begin, end = w.starts[first[once]], w.ends[first[once] + count[once] + WINDOW - 2]
                cell, at = np.unique(np.append(cell, low[once] % cells), return_inverse=True)
                size = np.bincount(at, weights=np.append(size, end - begin), minlength=len(cell)).astype(np.int64)
                if len(cell) > 500_000:
                    yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(size)], names=["cell", "bytes"])
                    cell, size = cell[:0], size[:0]
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(size)], names=["cell", "bytes"])

    return run


def _spans(pairs: np.ndarray) -> bytes:
    return np.ascontiguousarray(pairs, np.int32).tobytes()


#: A packed string's numbers in a block: minimiser, name and place of its text, windows, bytes, and flags (1: occurs twice in its
#: stretch, 2: its minimiser stands at several places in it, 4: its doc_id is null).
_ROW = np.dtype([("low", "<i8"), ("doc", "<i8"), ("key", "<i8"), ("place", "<i8"), ("count", "<i4"), ("size", "<i4"), ("flags", "u1")])


def _pack(buckets: int, hot: np.ndarray, spread: int):
    """Texts to packed strings. A string that occurs twice in a stretch is a repeat whatever else there is: its places
    are passed on at once, and it travels once from a task, without places. Others travel with their place. Windows of the cells
    in `hot` travel as strings of one window to the `spread` buckets after the others."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        held: dict[int, list] = {}
        known: list[tuple] = []
        sent: set[bytes] = set()
        size = 0
        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, _, texts in text_chunks(batch.column(2)):
                w = Words(texts)
                h = w.hashes()
                first, count, low, many = super_kmers(w, h)
                dealt = low % buckets
                if len(hot) and len(first) and (split := np.isin(low % (buckets * CELLS), hot)).any():
                    each = _stretch(first[split], count[split])
                    own = (window_hashes(h)[each] >> np.uint64(1)).astype(np.int64)
                    first, count, low = np.append(first[~split], each), np.append(count[~split], np.ones_like(each)), np.append(low[~split], own)
                    many, dealt = np.append(many[~split], np.zeros(len(each), bool)), np.append(dealt[~split], buckets + own % spread)
                row = w.row[first] + lo
                place = (first - w.first[w.row[first]]).astype(np.int64)
                begin, end = w.starts[first], w.ends[first + count + WINDOW - 2] if len(first) else first
                seen: dict[bytes, int] = {}
                twin = np.zeros(len(first), bool)
                data = w.data
                for j, (a, b) in enumerate(zip(begin.tolist(), end.tolist(), strict=True)):
                    if (k := seen.setdefault(data[a:b], j)) != j:
                        twin[j] = twin[k] = True
                for s in sent.intersection(seen):
                    s_at = seen.pop(s)
                    twin[s_at] = True
                t = np.flatnonzero(twin)
                t = t[np.argsort(row[t], kind="stable")]
                for at in np.split(t, np.flatnonzero(np.diff(row[t])) + 1):
                    if len(at):
                        r = int(row[at[0]])
                        known.append((ids[r], keys[r], _spans(np.stack([place[at], place[at] + count[at]], axis=1))))
                for s, j in seen.items():
                    size += len(s)
                    r, again = int(row[j]), bool(twin[j])
                    flags = again + 2 * bool(many[j]) + 4 * (ids[r] is None)
                    held.setdefault(int(dealt[j]), []).append((s, (int(low[j]), ids[r] or 0, keys[r], int(place[j]), int(count[j]), len(s), flags)))
                    if again and len(sent) < SENT:
                        sent.add(s)
                if size > PACK_BYTES or len(known) > SENT:
                    yield _emit(held, known, squeeze, buckets)
                    held, known, size = {}, [], 0
        if held or known:
            yield _emit(held, known, squeeze, buckets)

    return run


def _emit(held: dict, known: list, squeeze: zstandard.ZstdCompressor, buckets: int) -> pa.RecordBatch:
    out = [(hash(x[:2]) % buckets, *x, None) for x in known]
    for bucket, rows in held.items():
        strings, numbers = zip(*rows, strict=True)
        out.append((bucket, None, None, None, squeeze.compress(b"".join([len(rows).to_bytes(4, "little"), np.array(list(numbers), _ROW).tobytes(), *strings]))))
    types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    cols = zip(*out, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=["bucket", "doc_id", "text_key", "dups", "block"])


def _unpack(blocks: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Numbers and strings of the blocks."""
    numbers, strings = [np.zeros(0, _ROW)], []
    for block in map(zstandard.decompress, blocks):
        n = int.from_bytes(block[:4], "little")
        numbers.append(np.frombuffer(block, _ROW, n, 4))
        ends = 4 + n * _ROW.itemsize + np.cumsum(numbers[-1]["size"], dtype=np.int64)
        strings += [block[a:b] for a, b in zip((ends - numbers[-1]["size"]).tolist(), ends.tolist(), strict=True)]
    return np.concatenate(numbers), strings


def repeated_windows(strings: list[bytes], counts: np.ndarray, sure: np.ndarray) -> list[np.ndarray]:
    """For each string, which of its windows occur more than once in the bucket. Windows are sorted by hash; equal
    neighbours are compared byte for byte, so a window counts only with windows that are the same words."""
    w = Words(strings)
    roll = window_hashes(w.hashes())
    start = _stretch(w.first[:-1], counts)
    order = np.argsort(roll[start], kind="stable")
    sorted_hash = roll[start][order]
    same = np.append(sorted_hash[1:] == sorted_hash[:-1], False)
    hit = np.repeat(sure, counts)
    group = np.flatnonzero(same | np.append(False, same[:-1]))
    data = w.data
    a, b = w.starts[start], w.ends[start + WINDOW - 1]
    seen: dict[bytes, int] = {}
    last = None
    for g in group.tolist():
        if sorted_hash[g] != last:
            seen, last = {}, sorted_hash[g]
        i = int(order[g])
        if (j := seen.setdefault(data[a[i] : b[i]], i)) != i:
            hit[i] = hit[j] = True
    return np.split(hit, np.cumsum(counts)[:-1])


def _count(key: tuple, rows: pa.Table) -> pa.Table:
    out = [(d, k, x) for d, k, x in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "text_key", "dups")), strict=True) if x is not None]
    table, strings = _unpack([x for x in rows.column("block").to_pylist() if x is not None])
    if len(table):
        # a minimiser at one place of one string leaves nothing to compare
        _, inverse, times = np.unique(table["low"], return_inverse=True, return_counts=True)
        keep = np.flatnonzero((times[inverse] > 1) | (table["flags"] & 2 > 0))
        table, strings = table[keep], [strings[k] for k in keep.tolist()]
    if len(table):
        twin = table["flags"] & 1 > 0
        # equal strings from several tasks or stretches: one of them is compared, all are repeats
        number: dict[bytes, int] = {}
        at = np.array([number.setdefault(s, len(number)) for s in strings])
        one = np.unique(at, return_index=True)[1]
        sure = (np.bincount(at) > 1) | (np.bincount(at, weights=twin) > 0)
        hits = repeated_windows(list(number), table["count"][one].astype(np.int64), sure)
        for j, k in enumerate(at.tolist()):
            if not twin[j] and (h := hits[k]).any():
                edge = np.flatnonzero(np.diff(np.concatenate(([0], h.view(np.int8), [0]))))
                r = table[j]
                out.append((None if r["flags"] & 4 else int(r["doc"]), int(r["key"]), _spans(edge.reshape(-1, 2) + r["place"])))
    cols = list(zip(*out, strict=True)) or [(), (), ()]
    return pa.table([pa.array(list(c), t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["doc_id", "text_key", "dups"])


@tidy
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, dups = batch.column(0), batch.column(2)
        for lo, hi, texts in text_chunks(batch.column(1)):
            counts, removed, kept = [], [], []
            for x, spans in zip(texts, dups.slice(lo, hi - lo).to_pylist(), strict=True):
                words = x.split() if x else []
                counts.append(len(words))
                if spans:
                    step = np.zeros(len(words) + 1, np.int64)
                    for s in spans:
                        pairs = np.frombuffer(s, np.int32).reshape(-1, 2)
                        np.add.at(step, pairs[:, 0], 1)
                        np.add.at(step, pairs[:, 1] + WINDOW - 1, -1)
                    words = list(compress(words, (np.cumsum(step[:-1]) == 0).tolist()))
                removed.append(counts[-1] - len(words))
                kept.append(b" ".join(words))
            cols = [docs.slice(lo, hi - lo), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, joined by one blank) of every document.

    Words are [^\\x20\\x09-\\x0D]+ of the whole text, unchanged; a null text has none. A window is 35 consecutive
    words of one document; every word covered by a window whose words also start anywhere else, the same document
    included, is removed. Windows are judged on the input. Documents of fewer than 35 words keep all. Rows that
    repeat a doc_id are documents of their own. An empty table gives an empty result; other columns are not looked at.
    Texts of any length are judged whole.

    Consecutive windows that share a minimiser (the least hash of 4 consecutive words) travel as one packed string
    to the bucket of that minimiser, compressed with what else the task has for the bucket. The number of buckets, and
    of tasks that read them, follows the table's bytes. A string that repeats in a task travels once, so what a bucket gets
    of a large group of copies is bounded by the tasks and not by the copies. A minimiser with many differing strings, as of a
    line that stands in many documents, would make one bucket grow: minimisers are weighed first, in cells, and
    the windows of heavy cells travel as strings of their own, dealt over as many buckets as their bytes need.
    """
    spark = docs.sparkSession
    buckets = max(16, -(-3 * text_bytes(docs) // bucket_bytes))
    weights = docs.select("text").mapInArrow(_weigh(buckets * CELLS), "cell long, bytes long").groupBy("cell").agg(F.sum("bytes").alias("bytes"))
    heavy = weights.where(F.col("bytes") > hot_bytes).orderBy(F.desc("bytes"), "cell").limit(HOT_CELLS).toArrow()
    hot = np.sort(heavy.column("cell").to_numpy())
    # a window takes WINDOW words of a string that has half as many more on average
    spread = max(16, -(-int(heavy.column("bytes").to_numpy().sum()) * WINDOW // 3 // bucket_bytes))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(buckets + spread * (len(hot) > 0)) // TASK_BUCKETS))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")
    packed = rows.mapInArrow(_pack(buckets, hot, spread), PACKED).repartition(tasks, "bucket")
    spans = packed.groupBy("bucket").applyInArrow(_count, SPANS)
    spans = spans.groupBy("doc_id", "text_key").agg(F.collect_list("dups").alias("dups"))  # as many as the text has runs
    spans = spans.withColumnsRenamed({"doc_id": "of_id", "text_key": "of_key"}).hint("shuffle_hash")
    on = rows["doc_id"].eqNullSafe(spans["of_id"]) & (rows["text_key"] == spans["of_key"])
    out = rows.join(spans, on, "left").select("doc_id", "text", "dups")
    return out.mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept string")
