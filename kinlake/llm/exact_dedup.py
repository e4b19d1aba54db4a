"""Exact deduplication by a cuckoo-filter index over text digests."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, one_of_each, remove_rows, text_key, tidy

#: Digests that one index task holds at most, on average.
ROWS_PER_TASK = 250_000
#: Rows of a task whose copies are combined before the shuffle.
COMBINED = 50_000
_FIRST = (1 << 63) - 1


class CuckooIndex:
    """Live digests in a cuckoo filter: buckets of four slots, each with a 16-bit fingerprint and the number of the stored entry
    that it stands for.

    There is no other way to an entry than through the filter. A lookup compares the fingerprints of a digest's two
    buckets; where one is equal, the content stored behind that slot (the full digest) decides, so a wrong hit costs a
    comparison and never an answer. delete() empties the slot of a live digest. When an insertion finds no room the
    filter is built anew at twice the size from the stored digests.
    """

    SLOTS, KICKS = 4, 200

    def __init__(self, buckets: int = 1024):
        self.digests: list[bytes | None] = []
        self.entries: list[list[int] | None] = []
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.buckets = buckets
        self.marks, self.numbers = [0] * (buckets * self.SLOTS), [0] * (buckets * self.SLOTS)

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[:2], "little") or 1
        one = int.from_bytes(digest[2:10], "little") & (self.buckets - 1)
        return mark, one, self._other(one, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995) & (self.buckets - 1))

    def _slot(self, digest: bytes) -> int:
        """The slot of a live digest, or -1."""
        mark, one, two = self._places(digest)
        marks = self.marks
        for at in (one * 4, two * 4):
            if mark in marks[at : at + 4]:
                for s in range(at, at + 4):
                    if marks[s] == mark and self.digests[self.numbers[s]] == digest:
                        return s
        return -1

    def get(self, digest: bytes) -> list[int] | None:
        """The entry of a live digest."""
        s = self._slot(digest)
        return self.entries[self.numbers[s]] if s >= 0 else None

    def insert(self, digest: bytes, entry: list[int]) -> None:
        """A digest that is not live becomes so."""
        self.digests.append(digest)
        self.entries.append(entry)
        if not self._place(len(self.digests) - 1):
            self._grow()

    def _place(self, number: int) -> bool:
        mark, one, two = self._places(self.digests[number])
        marks, numbers = self.marks, self.numbers
        for at in (one * 4, two * 4):
            if 0 in marks[at : at + 4]:
                s = marks.index(0, at, at + 4)
                marks[s], numbers[s] = mark, number
                return True
        b = two
        for k in range(self.KICKS):
            s = b * 4 + (mark + k) % 4
            mark, marks[s] = marks[s], mark
            number, numbers[s] = numbers[s], number
            b = self._other(b, mark)
            if 0 in marks[b * 4 : b * 4 + 4]:
                s = marks.index(0, b * 4, b * 4 + 4)
                marks[s], numbers[s] = mark, number
                return True
        return False

    def _grow(self) -> None:
        """Twice the size, and again where that is too small; deleted content goes."""
        live = [k for k, d in enumerate(self.digests) if d is not None]
        self.digests, self.entries = [self.digests[k] for k in live], [self.entries[k] for k in live]
        size = self.buckets
        while True:
            size *= 2
            self._clear(size)
            if all(self._place(k) for k in range(len(self.digests))):
                return

    def delete(self, digest: bytes) -> bool:
        """Takes a live digest out of the filter, and its content with it."""
        s = self._slot(digest)
        if s < 0:
            return False
        self.digests[self.numbers[s]] = self.entries[self.numbers[s]] = None
        self.marks[s] = 0
        return True

    def live(self) -> Iterator[tuple[bytes, list[int]]]:
        return ((d, e) for d, e in zip(self.digests, self.entries, strict=True) if d is not None)


def _fold(index: CuckooIndex, batch: pa.RecordBatch) -> None:
    cols = [batch.column(i).to_pylist() for i in range(4)]
    for digest, doc, row, n in zip(*cols, strict=True):
        doc = _FIRST if doc is None else doc
        if (e := index.get(digest)) is None:
            index.insert(digest, [doc, row, n])
        else:
            if (doc, row) < (e[0], e[1]):
                e[0], e[1] = doc, row
            e[2] += n


def _rows(index: CuckooIndex) -> Iterator[pa.RecordBatch]:
    items = index.live()
    while part := [x for _, x in zip(range(20_000), items)]:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([d for d, _ in part], pa.binary()),
                pa.array([None if e[0] == _FIRST else e[0] for _, e in part], pa.int64()),
                pa.array([e[1] for _, e in part], pa.int64()),
                pa.array([e[2] for _, e in part], pa.int64()),
            ],
            names=["digest", "keep_id", "keep_row", "group_size"],
        )


@tidy
def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within a task before the shuffle: copies among COMBINED rows or more travel as one row."""
    index, size = CuckooIndex(4096), 0
    for batch in batches:
        _fold(index, batch)
        size += batch.num_rows
        if size >= COMBINED:
            yield from _rows(index)
            index, size = CuckooIndex(4096), 0
    yield from _rows(index)


@tidy
def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by gone, where there is such a column: deletions come after all insertions."""
    index = CuckooIndex()
    for batch in batches:
        if batch.num_columns > 4 and batch.num_rows:
            gone = np.asarray(batch.column(4).to_pylist(), bool)
            _fold(index, batch.filter(pa.array(~gone)))
            for digest in batch.filter(pa.array(gone)).column(0).to_pylist():
                index.delete(digest)
        else:
            _fold(index, batch)
    yield from _rows(index)


GROUP = "digest binary, keep_id long, keep_row long, group_size long"


def exact_dedup(docs: DataFrame, retired: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, text_key, digest (SHA-256 of the normalised text), keep_id, group_size, kept.

    Texts are equal when identical after replacing each run of [\\x20\\x09-\\x0D] by one blank; null counts as empty.
    Of equal texts the row with the smallest doc_id stays (a null doc_id comes last; of rows that repeat a doc_id and
    text, exactly one stays). retired: a table with a text column; those texts are deleted from the live index, and
    all their documents come back with keep_id null and kept false. An empty table gives an empty result. Columns
    other than doc_id and text are not looked at. Texts of any length are hashed whole.

    What the filter's slots stand for are full SHA-256 digests of the content, against which every hit is compared. Copies are
    combined before the shuffle, so a group of any size reaches its bucket as one row a batch; the way back to the
    documents is a join on light rows that adaptive execution can split.
    """
    spark = docs.sparkSession
    digest = lambda c: F.unhex(F.sha2(F.regexp_replace(F.coalesce(c, F.lit("")), "[\\x20\\x09-\\x0D]+", " "), 256))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), digest(F.col("text")).alias("digest"), F.monotonically_increasing_id().alias("row"))
    rows = materialise(rows, "digests")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS_PER_TASK))
    entries = rows.select("digest", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), F.lit(1).cast("long").alias("group_size")).mapInArrow(_combine, GROUP)
    if retired is not None:
        gone = retired.select(digest(F.col("text")).alias("digest")).distinct().select("digest", F.lit(None).cast("long").alias("keep_id"), F.lit(0).cast("long").alias("keep_row"), F.lit(0).cast("long").alias("group_size"), F.lit(True).alias("gone"))
        entries = entries.withColumn("gone", F.lit(False)).unionByName(gone).repartition(tasks, "digest").sortWithinPartitions("gone")
    else:
        entries = entries.repartition(tasks, "digest")
    groups = entries.mapInArrow(_index, GROUP)
    out = rows.join(groups, "digest", "left")
    return out.select("doc_id", "text_key", "digest", "keep_id", F.coalesce("group_size", F.lit(0)).cast("long").alias("group_size"), F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of equal texts (as in exact_dedup), columns unchanged, whatever their names.

    The row with the smallest doc_id stays (a null doc_id comes last); of rows that repeat a doc_id and text exactly one stays,
    and a null text equals an empty one. Texts of any length are compared whole. An empty table gives an empty result.
    """
    found = materialise(exact_dedup(docs), "groups")
    names = found.groupBy("doc_id", "text_key").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    out = remove_rows(docs, names.where("not kept"))
    return one_of_each(out, names.where("kept and n > 1"))
