"""Helpers shared by the training-data operators: tables in the shared folder, row keys, word arrays."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a two-column key table may be broadcast (about 50 MB); beyond it, joins shuffle.
BROADCAST_ROWS = 1_000_000
#: Rows of an Arrow batch between Spark and Python at most: documents are large, and both sides hold whole batches.
BATCH_ROWS = 1000
#: Bytes of text that one vectorised step works on, whatever the size of the Arrow batch.
CHUNK_BYTES = 2_000_000

#: Bytes that are hashed at once.
STRETCH = 1_000_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_tables: dict[str, np.ndarray] = {}
_own: list[str] = []
_kept: dict[str, dict] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one of our own only where that is unset and the master is local (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if not _own:
            _own.append(f"file://{tempfile.mkdtemp(prefix='spark-kinlake-')}")
        path = _own[0]
    return path.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """For a session that works on documents: Arrow batches of at most BATCH_ROWS rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    have = int(spark.conf.get(key))
    if have <= 0 or have > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def materialise(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write a table to the shared folder and read it again: cuts the lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: str = "text") -> Column:
    """With doc_id this names a row even where a doc_id is repeated with another text."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def text_bytes(docs: DataFrame) -> int:
    """Total UTF-8 bytes of the texts; sizes buckets."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a counted table of at most `limit` rows; larger ones are left to a shuffle join."""
    return F.broadcast(df) if df.count() <= limit else df


def remove_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the rows named in gone (doc_id, text_key); all columns of docs stay as they are."""
    gone = small(gone.select(F.col("doc_id").alias("__gone_id"), F.col("text_key").alias("__gone_key")).distinct())
    on = docs["doc_id"].eqNullSafe(gone["__gone_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == gone["__gone_key"])
    return docs.join(gone, on, "left_anti")


def one_of_each(docs: DataFrame, names: DataFrame) -> DataFrame:
    """docs with one of the rows that share a name (doc_id, text_key) of `names`; other rows stay. A null text equals an empty one."""
    names = names.select(F.col("doc_id").alias("__again_id")).distinct()
    if names.isEmpty():
        return docs
    names = small(names)
    on = docs["doc_id"].eqNullSafe(names["__again_id"])
    again = docs.join(names, on, "left_semi").withColumn("__again_text", F.coalesce("text", F.lit(""))).dropDuplicates(["doc_id", "__again_text"]).drop("__again_text")
    return docs.join(names, on, "left_anti").unionByName(again)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, list[bytes | None]]]:
    """(first row, row after the last, UTF-8 texts) of stretches of about `limit` bytes; a longer text may be a stretch of its own."""
    data = column.cast(pa.binary())
    if not len(data):
        return
    starts = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data)].astype(np.int64)
    cut = np.flatnonzero(np.diff((starts - starts[0]) // limit, prepend=-1)).tolist()
    for lo, hi in zip(cut, [*cut[1:], len(data)], strict=True):
        yield lo, hi, data.slice(lo, hi - lo).to_pylist()


def gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have about `limit` bytes, where larger stretches share more work."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= limit:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def kept(owner: str) -> dict:
    """What an operator's tasks keep in a worker process from one to the next; that of other operators is dropped."""
    others = [k for k in _kept if k != owner]
    for k in others:
        del _kept[k]
    if others:
        release()
    return _kept.setdefault(owner, {})


def release() -> None:
    """Gives freed memory back to the machine."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable) -> Callable:
    """A task's function over batches, with an eye on memory: a worker process serves many tasks of many operators."""

    @functools.wraps(run)
    def task(batches: Iterator) -> Iterator:
        kept(run.__module__)
        yield from run(batches)
        release()

    return task


def _powers(name: str, base: int, n: int) -> np.ndarray:
    have = _tables.get(name)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = _tables[name] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of a sum or product of hashes counts."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """Words [^\\x20\\x09-\\x0D]+ of several texts in one buffer: words end with a blank, texts with a newline."""

    def __init__(self, texts: list[bytes | None], lower: bool = False):
        parts = [b" ".join((x.lower() if lower else x).split()) if x else b"" for x in texts]
        self.data = b"\n".join(parts) + b"\n"
        self.buf = np.frombuffer(self.data, np.uint8)
        newline = self.buf == 10
        ends = np.flatnonzero(newline | (self.buf == 32))
        starts = np.empty_like(ends)
        starts[0] = 0
        starts[1:] = ends[:-1] + 1
        row = np.cumsum(newline[ends]) - newline[ends]
        word = ends > starts
        self.starts, self.ends, self.row = starts[word], ends[word], row[word]
        self.counts = np.bincount(self.row, minlength=len(texts))
        self.first = np.concatenate(([0], np.cumsum(self.counts)))

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the words; equal words have equal hashes wherever they stand."""
        out = np.empty(len(self.starts), np.uint64)
        i = 0
        while i < len(out):  # a stretch of words at a time, so that the sums stay small
            base = self.starts[i]
            j = max(i + 1, int(np.searchsorted(self.ends, base + STRETCH, "right")))
            n = int(self.ends[j - 1] - base)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((self.buf[base : base + n].astype(np.uint64) + np.uint64(1)) * _powers("up", _BASE, n), out=sums[1:])
            a, b = self.starts[i:j] - base, self.ends[i:j] - base
            out[i:j] = mix((sums[b] - sums[a]) * _powers("down", _INVERSE, n)[a])
            i = j
        return out

    def text(self, i: int, j: int) -> bytes:
        """Words i to j - 1 of one text, joined by blanks."""
        return self.data[self.starts[i] : self.ends[j - 1]]
