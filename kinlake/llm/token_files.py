"""Token ids of documents in binary blocks, with a minimal perfect hash index from document keys to places."""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CHUNK_BYTES, Words, kept, mix, shared_dir, small, small_batches, text_bytes, text_chunks, tidy
from .packing import KEPT_PRETOKENS, WordTokenizer, _gather

TOKENIZER, END_ID = "byte_bpe_50k.json", 0
#: Bytes of text that one writing task gets on average.
TASK_BYTES = 64_000_000
#: Ids of a block; a longer document is a block of its own.
BLOCK_IDS = 262_144
#: Bytes of a Parquet row group of blocks.
ROW_GROUP = 33_554_432
#: Blocks name the ranges of 2^BIN keys in which they have documents.
BIN = 10
#: Bits of a level of the perfect hash for each key that is left.
ROOM = 2

BLOCK = "part int, block int, before long, n_docs int, n_ids long, width int, first_key long, last_key long, bins array<bigint>, payload binary, keys binary, offsets binary, levels array<int>, bits binary, prints binary, places binary"

#: The tokenizer's own pre-tokens (fixed pattern) of a word with its blank, for the characters that `_ODD` leaves.
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
_PRETOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\s0-9{_LETTER}]+|\s+")
_ODD = re.compile("[^\t\n\r -~À-ɏ]|<\\|")
#: Where a text may be cut: its pre-tokens never go across a single blank between plain characters.
_CUT = re.compile(rb"[!-~](?= [!-~])")


class Units(Words):
    """Texts cut into what the tokenizer never joins: words, with the blank before them, and the rest of white space.

    Of white space before a word a last blank belongs to the word, another last character stands alone, and what is before it is
    one unit; white space at a text's end is one unit.
    """

    def __init__(self, texts: list[bytes | None]):
        self.data = b"\n".join([t or b"" for t in texts]) + b"\n"
        self.buf = np.frombuffer(self.data, np.uint8)
        size = np.array([len(t or b"") + 1 for t in texts], np.int64)
        limit = np.cumsum(size) - 1  # where the line feed behind each text stands
        white = (self.buf == 32) | ((self.buf >= 9) & (self.buf <= 13))
        edge = np.diff(white.astype(np.int8))
        begin = np.flatnonzero(edge == -1) + 1  # of words
        if not white[0]:
            begin = np.append(0, begin)
        end = np.flatnonzero(edge == 1) + 1
        lead = np.zeros(len(begin), np.int64)
        lead[begin > 0] = self.buf[begin[begin > 0] - 1] == 32
        # white space: from the end of the word (or text) before to the word, or to the text's end
        row = np.searchsorted(limit, begin)
        text_begin = limit - size + 1
        before = np.maximum(np.append(0, end[:-1]), text_begin[row]) if len(begin) else begin
        spans = [(begin - lead, end)]
        last = begin - 1
        some = begin > before
        spans.append((before[some & (last > before)], last[some & (last > before)]))
        other = some & (lead == 0)
        spans.append((last[other], begin[other]))
        tail = text_begin.copy()
        np.maximum.at(tail, row, end)
        spans.append((tail[limit > tail], limit[limit > tail]))
        starts, ends = (np.concatenate([s[i] for s in spans]).astype(np.int64) for i in (0, 1))
        order = np.argsort(starts, kind="stable")
        self.starts, self.ends = starts[order], ends[order]
        self.row = np.searchsorted(limit, self.starts)
        self.counts = np.bincount(self.row, minlength=len(texts))
        self.first = np.concatenate(([0], np.cumsum(self.counts)))


class ByteTokenizer(WordTokenizer):
    """Ids of texts by a byte-level tokenizer, white space and case kept. Distinct units are put together from their pre-tokens,
    each of which goes through the tokenizer once; texts with other than plain characters, or with the start of a special token,
    go through it whole."""

    def _together(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self._each(texts)

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [_PRETOKEN.findall(w.decode()) for w in words]
        known = len(self.number)
        unseen = list({p for f in found for p in f}.difference(self.number))
        self._learn(unseen)
        n = np.array([self.number[p] for f in found for p in f], np.int64)
        size = self.piece_at[n + 1] - self.piece_at[n]
        ids = _gather(self.pieces, self.piece_at[n], size)
        if len(self.number) > KEPT_PRETOKENS:
            keep = max(known, KEPT_PRETOKENS)
            for p in unseen[max(0, keep - known) :]:
                del self.number[p]
            self.piece_at = self.piece_at[: keep + 1].copy()
            self.pieces = self.pieces[: self.piece_at[-1]].copy()
        owner = np.repeat(np.arange(len(words)), [len(f) for f in found])
        return ids, np.bincount(owner, weights=size, minlength=len(words)).astype(np.int64)

    def _units(self, texts: list[bytes | None]) -> Words:
        return Units(texts)

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and where each text's begin (one more: the end)."""
        odd = np.zeros(len(texts), bool)
        if _ODD.search(b"\n".join([t or b"" for t in texts]).decode()):
            odd = np.array([bool(_ODD.search((t or b"").decode())) for t in texts])
        flat, size = np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        plain, strange = np.flatnonzero(~odd), np.flatnonzero(odd)
        if len(plain):
            flat, starts = super().encode([texts[i] for i in plain])
            size[plain] = np.diff(starts)
        if not len(strange):
            return flat, np.append(0, np.cumsum(size))
        whole, size[strange] = self._each([texts[i].decode() for i in strange])
        order = np.append(plain, strange)
        start = np.empty(len(texts), np.int64)
        start[order] = np.cumsum(size[order]) - size[order]
        return _gather(np.append(flat, whole), start, size), np.append(0, np.cumsum(size))


def text_sections(text: bytes, limit: int = CHUNK_BYTES) -> Iterator[bytes]:
    """A text in sections of about `limit` bytes, cut before a single blank; one without such a place is one section."""
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + limit) if at + limit < len(text) else None
        end = cut.end() if cut else len(text)
        yield text[at:end]
        at = end


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys by a cascade of bit arrays: a key's place in a level is its own if no other
    key of that level fell there; those that clash go on to the next. The slot is the number of set bits before the key's, so n keys
    have the slots 0 to n - 1, and a look-up reads a few bits whatever the number of keys. A strange key gets some slot or none,
    which the fingerprint of the slot settles."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.rank = np.cumsum(bits) - bits

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels, left = [], [], keys
        while len(left):
            size = 64 * -(-ROOM * len(left) // 64)
            at = cls._place(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[at]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        salted = keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        return (mix(salted) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where no level has a bit for it."""
        out, left, base = np.full(len(keys), -1), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = base + self._place(keys[left], level, size)
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left = left[~hit]
            base += size
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    """32 bits of a key, by another hash than the places'."""
    return (mix(keys ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype("<u4")


def make_block(part: int, block: int, before: int, keys: list[int | None], ids: list[np.ndarray], width: int) -> tuple:
    """A block of documents in rising order of their keys, nulls last."""
    size = np.array([len(x) for x in ids], np.int64)
    own = np.array([k for k in keys if k is not None], np.int64)
    first = np.flatnonzero(np.diff(own, prepend=own[:1] - 1)) if len(own) else np.zeros(0, np.int64)
    distinct = own[first].view(np.uint64)
    perfect = PerfectHash.of(distinct)
    slot = perfect.slots(distinct)
    prints, places = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u4")
    prints[slot], places[slot] = fingerprints(distinct), first
    payload = np.concatenate(ids).astype(f"<u{width}").tobytes()
    offsets = np.append(0, np.cumsum(size)).astype("<u8").tobytes()
    span = (int(own[0]), int(own[-1])) if len(own) else (None, None)
    bins = np.unique(own >> BIN).tolist()
    index = (perfect.sizes, np.packbits(perfect.bits).tobytes(), prints.tobytes(), places.tobytes())
    return (part, block, before, len(ids), int(size.sum()), width, *span, bins, payload, own.astype("<i8").tobytes(), offsets, *index)


class BlockReader:
    """Keyed access to the documents of one block."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["payload"], f"<u{row['width']}")
        self.keys = np.frombuffer(row["keys"], "<i8")
        self.offsets = np.frombuffer(row["offsets"], "<u8").astype(np.int64)
        self.n_docs = row["n_docs"]
        self.prints, self.places = (np.frombuffer(row[x], "<u4") for x in ("prints", "places"))
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(row["levels"])).astype(bool)
        self.perfect = PerfectHash(row["levels"], bits)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place in the block of the first document of each key, -1 if the block has none."""
        if not len(self.prints):
            return np.full(len(keys), -1)
        wanted = keys.astype(np.int64).view(np.uint64)
        slot = self.perfect.slots(wanted)
        place = self.places[slot].astype(np.int64)
        same = (slot >= 0) & (self.prints[slot] == fingerprints(wanted)) & (self.keys[place] == keys)
        return np.where(same, place, -1)

    def every(self) -> tuple[np.ndarray, np.ndarray]:
        """All documents: their places, found by their keys (a key's further documents follow its first), and those of null keys."""
        first = self.find(self.keys)
        if (first < 0).any():
            raise ValueError("a key of the block is not in its index")
        nth = np.arange(len(first)) - np.searchsorted(self.keys, self.keys)
        return first + nth, np.arange(len(first), self.n_docs)

    def document(self, place: int) -> np.ndarray:
        return self.ids[self.offsets[place] : self.offsets[place + 1]]


def _arrow(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64())}
    fields = [f.split(" ") for f in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[t]) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])


def _write(file: str, end_id: int, block_ids: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = kept(__name__)
        encoder = held.get(file) or held.setdefault(file, ByteTokenizer(file))
        width = 2 if max(len(encoder.closes) - 1, end_id) < 1 << 16 else 4
        part, block, before, size = TaskContext.get().partitionId(), 0, 0, 0
        keys, ids, end = [], [], np.array([end_id], np.uint32)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            for lo, hi, texts in text_chunks(batch.column(1)):
                if hi - lo == 1 and texts[0] and len(texts[0]) > 2 * CHUNK_BYTES:
                    flat = np.concatenate([encoder.encode([x])[0] for x in text_sections(texts[0])])
                    starts = np.array([0, len(flat)])
                else:
                    flat, starts = encoder.encode(texts)
                for i in range(hi - lo):
                    n = int(starts[i + 1] - starts[i]) + 1
                    if keys and size + n > block_ids:
                        yield _arrow([made := make_block(part, block, before, keys, ids, width)], BLOCK)
                        block, before, size, keys, ids = block + 1, before + made[4], 0, [], []
                    keys.append(docs[lo + i])
                    ids.append(np.append(flat[starts[i] : starts[i + 1]], end).astype(f"<u{width}"))
                    size += n
        if keys:
            yield _arrow([make_block(part, block, before, keys, ids, width)], BLOCK)

    return run


def write_ids(docs: DataFrame, path: str, file: str | None = None, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Writes the ids of all documents to `path`, in rising order of doc_id (nulls last).

    A file is the output of one task, a row of it one block: little-endian ids end to end (`payload`, 2 bytes each where the vocabulary
    allows, else 4), where each document begins (`offsets`), the documents' keys, and the index: a minimal perfect hash of the distinct
    keys (`levels`, `bits`) whose slots hold a fingerprint (`prints`) and the place of the key's first document (`places`). Parts, and
    blocks in them, follow the order of doc_id; `before` counts the ids of the part before the block. Spark's committed writer puts
    the files in place, so a task that is lost and run again leaves nothing behind, and any store that Spark writes to will do.

    A null text is empty: the end id alone. A very long text is encoded in sections and may be a block of its own. Rows that repeat a
    doc_id follow each other; a doc_id of very many rows is dealt by its texts too. An empty table makes an empty file.
    """
    if file is None:
        import public_tokenizers

        file = public_tokenizers.path(TOKENIZER)
    work = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-text_bytes(work) // TASK_BYTES))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    dealt = work.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    blocks = dealt.mapInArrow(_write(file, end_id, block_ids), BLOCK)
    blocks.write.option("parquet.block.size", ROW_GROUP).parquet(path)


def _read(end_id: int, keep_ids: bool):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = batch.slice(row, 1).to_pylist()[0]
                reader = BlockReader(block)
                named, nameless = reader.every()
                ids = reader.ids.astype("<u4", copy=False)
                data, rows = memoryview(ids).cast("B"), []
                for place, key in zip([*named.tolist(), *nameless.tolist()], [*reader.keys.tolist(), *[None] * len(nameless)], strict=True):
                    a, b = int(reader.offsets[place]), int(reader.offsets[place + 1])
                    if ids[b - 1] != end_id:
                        raise ValueError(f"document {key} does not close with the end id")
                    own = data[4 * a : 4 * b]
                    rows.append((block["part"], key, block["before"] + a, b - a, zlib.crc32(own), bytes(own) if keep_ids else None))
                yield _arrow(rows, READ)

    return run


READ = "part int, doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"


def _starts(blocks: DataFrame) -> DataFrame:
    """part and base: the ids of all parts before it. One row a writing task, whose number follows from bytes."""
    rows = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    bases = np.append(0, np.cumsum([r.n for r in rows])).tolist()
    return small(blocks.sparkSession.createDataFrame([(r.part, b) for r, b in zip(rows, bases[:-1], strict=True)], "part int, base long"))


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCK).parquet(path)


def read_ids(spark: SparkSession, path: str, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and ids (32-bit, little-endian; null unless asked for) of
    every document in the files, found by its key in its block's index. Each block is read once, by itself; null keys, which no index
    holds, follow the others. Rows that repeat a doc_id come back each by itself; an empty file gives an empty result."""
    blocks = _blocks(spark, path)
    return blocks.mapInArrow(_read(end_id, keep_ids), READ).join(_starts(blocks), "part").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", "ids")


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            block = batch.slice(row, 1).to_pylist()[0]
            reader, keys = BlockReader(block), np.array(block["wanted"], np.int64)
            rows = []
            for key, place in zip(keys.tolist(), reader.find(keys).tolist(), strict=True):
                while 0 <= place < len(reader.keys) and reader.keys[place] == key:
                    rows.append((block["part"], key, block["before"] + int(reader.offsets[place]), reader.document(place).astype("<u4").tobytes()))
                    place += 1
            yield _arrow(rows, "part int, doc_id long, start long, ids binary")


def find_documents(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """doc_id, start and ids of the documents that `keys` (doc_id) names: keyed access, by the index of the block that may have them.

    Keys meet the blocks that have documents in the same range of 2^BIN keys, and of these the one or few whose first and last key
    enclose them; there the perfect hash gives the place. Repeated keys are asked for once, null keys and those that no
    document has give no row, a doc_id of several rows gives all of them.
    """
    blocks = _blocks(spark, path)
    asked = keys.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct().withColumn("bin", F.shiftright("doc_id", BIN))
    ranges = blocks.select("part", "block", "first_key", "last_key", F.explode("bins").alias("bin"))
    meet = asked.join(ranges, "bin").where("doc_id BETWEEN first_key AND last_key")
    wanted = meet.groupBy("part", "block").agg(F.collect_list("doc_id").alias("wanted"))
    # a block's row holds its wanted keys: at most as many as it has ids in its range
    found = blocks.join(small(wanted), ["part", "block"]).mapInArrow(_find, "part int, doc_id long, start long, ids binary")
    return found.join(_starts(blocks), "part").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "ids")


def encode_documents(docs: DataFrame, file: str | None = None, end_id: int = END_ID) -> DataFrame:
    """write_ids to a new table in the shared folder, and read_ids of it."""
    spark = docs.sparkSession
    small_batches(spark)
    path = f"{shared_dir(spark)}/ids-{uuid.uuid4().hex}"
    write_ids(docs, path, file, end_id)
    return read_ids(spark, path, end_id)
