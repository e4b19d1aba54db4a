"""Best-fit packing of tokenised documents into sequences, after Martello-Toth dominance reduction."""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, Words, kept, materialise, text_chunks, tidy

_BLANK = re.compile(rb"[\x20\x09-\x0D]")
CAPACITY, END_ID = 4096, 1
TOKENIZER = "word_bpe_49k.json"
#: Words and pre-tokens whose ids a worker keeps; of words the most used stay, of pre-tokens the first met.
KEPT_WORDS, KEPT_PRETOKENS = 600_000, 150_000
#: Pre-tokens that go through the tokenizer as one text.
JOINED = 1000
#: Pieces of one length that one task ranks at most, on average.
ROWS_PER_RANK = 200_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


#: The tokenizer's own pre-tokens (fixed pattern), with the end of a word; and characters beyond those for which this pattern and
#: str.lower() do as the tokenizer does.
_PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|\n")
_ODD = regex.compile("[^\n!-~\u00c0-\u024f]|<\\|")


def _gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches (start, size) of flat, one after another."""
    at = np.cumsum(size) - size
    return flat[np.repeat(start - at, size) + np.arange(int(size.sum()))]


class WordTokenizer:
    """Ids of texts. The tokenizer never joins across white space, nor across its pre-tokens, so the ids of a word are put together
    from those of its lower-cased pre-tokens; a pre-token, which many words share, goes through the tokenizer once. Words with
    other than plain letters and signs go through it whole. Words are told apart by 64-bit hashes, their ids lie end to end in one array."""

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a pre-token
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.hashes, self.start, self.size, self.used = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.uint32)
        self.number: dict[str, int] = {}
        self.piece_at, self.pieces = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64)

    def _together(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for pre-tokens, as one text; each ends with the first token that closes it."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(texts)], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(texts) or ends[-1] != len(ids):
            return self._each(texts)
        return ids, np.diff(ends, prepend=0)

    def _learn(self, texts: list[str]) -> None:
        """Numbers and ids for new pre-tokens."""
        for k in range(0, len(texts), JOINED):
            part = texts[k : k + JOINED]
            ids, size = self._together(part)
            self.number.update(zip(part, range(len(self.piece_at) - 1, len(self.piece_at) - 1 + len(part)), strict=True))
            self.piece_at = np.append(self.piece_at, self.piece_at[-1] + np.cumsum(size))
            self.pieces = np.append(self.pieces, ids)

    def _plain(self, joined: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words that stand one a line, and how many each has."""
        tokens = _PRETOKEN.findall(joined.lower())
        known = len(self.number)
        unseen = list(set(tokens).difference(self.number, ("\n",)))
        self._learn(unseen)
        self.number["\n"] = -1
        n = np.fromiter(map(self.number.__getitem__, tokens), np.int64, len(tokens))
        del self.number["\n"]
        line = np.cumsum(n < 0)
        n, line = n[n >= 0], line[n >= 0]
        size = self.piece_at[n + 1] - self.piece_at[n]
        ids = _gather(self.pieces, self.piece_at[n], size)
        if len(self.number) > KEPT_PRETOKENS:
            keep = max(known, KEPT_PRETOKENS)
            for p in unseen[max(0, keep - known) :]:
                del self.number[p]
            self.piece_at = self.piece_at[: keep + 1].copy()
            self.pieces = self.pieces[: self.piece_at[-1]].copy()
        return ids, np.bincount(line, weights=size, minlength=joined.count("\n") + 1).astype(np.int64)

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, and how many each has."""
        joined = b"\n".join(words).decode()
        if not _ODD.search(joined):
            return self._plain(joined)
        texts = joined.split("\n")
        odd = np.array([bool(_ODD.search(x)) for x in texts])
        size, parts = np.zeros(len(words), np.int64), []
        for kind, run in ((False, lambda x: self._plain("\n".join(x))), (True, self._each)):
            at = np.flatnonzero(odd == kind)
            ids, size[at] = run([texts[i] for i in at]) if len(at) else (np.zeros(0, np.uint32), size[at])
            parts.append(ids)
        flat = np.concatenate(parts)
        start = np.zeros(len(words), np.int64)
        order = np.argsort(odd, kind="stable")
        start[order] = np.cumsum(size[order]) - size[order]
        return _gather(flat, start, size), size

    def _keep(self, hashes: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        """New words join those that are held; beyond KEPT_WORDS the more used half of that number stays."""
        start = len(self.flat) + np.cumsum(size) - size
        self.flat = np.append(self.flat, ids)
        merged = [np.append(a, b) for a, b in ((self.hashes, hashes), (self.start, start), (self.size, size.astype(np.int32)), (self.used, np.ones(len(size), np.int32)))]
        order = np.argsort(merged[0], kind="stable")  # two sorted runs
        self.hashes, self.start, self.size, self.used = (x[order] for x in merged)
        if len(self.hashes) > KEPT_WORDS:
            stay = np.sort(np.argsort(-self.used, kind="stable")[: KEPT_WORDS // 2])
            self.hashes, self.start, self.size, self.used = (x[stay] for x in (self.hashes, self.start, self.size, self.used // 2))
            self.flat = _gather(self.flat, self.start, self.size)
            self.start = np.cumsum(self.size, dtype=np.int64) - self.size

    def _units(self, texts: list[bytes | None]) -> Words:
        """What the tokenizer never joins."""
        return Words(texts)

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and where each text's begin (one more: the end)."""
        w = self._units(texts)
        if not len(w.starts):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        hashes, first, inverse = np.unique(w.hashes(), return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, hashes)
        new = np.append(self.hashes, np.uint64(0))[at] != hashes
        new |= at == len(self.hashes)
        if new.any():
            ids, size = self._words([w.data[a:b] for a, b in zip(w.starts[first[new]].tolist(), w.ends[first[new]].tolist(), strict=True)])
            held = at[~new]
            self.used[held] += 1
            flat = np.append(_gather(self.flat, self.start[held], self.size[held]), ids)
            each = np.empty(len(hashes), np.int64)
            each[~new], each[new] = self.size[held], size
            order = np.argsort(new, kind="stable")
            start = np.empty(len(hashes), np.int64)
            start[order] = np.cumsum(each[order]) - each[order]
            self._keep(hashes[new], ids, size)
        else:
            self.used[at] += 1
            flat, start, each = self.flat, self.start[at], self.size[at].astype(np.int64)
        size = each[inverse]
        ends = np.append(0, np.cumsum(size))
        return _gather(flat, start[inverse], size), ends[w.first]


def _tokenizer(file: str) -> WordTokenizer:
    """One for each worker process."""
    held = kept(__name__)
    if file not in held:
        held[file] = WordTokenizer(file)
    return held[file]


def _sections(text: bytes) -> Iterator[bytes]:
    """A text in sections of about CHUNK_BYTES, cut where a word ends; a longer word is a section of its own."""
    at = 0
    while at < len(text):
        end = at + CHUNK_BYTES
        blank = _BLANK.search(text, end) if end < len(text) else None
        end = blank.start() if blank else len(text)
        yield text[at:end]
        at = end


def _ids(encoder: WordTokenizer, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    if len(texts) > 1 or not texts[0] or len(texts[0]) <= 2 * CHUNK_BYTES:
        return encoder.encode(texts)
    ids = np.concatenate([encoder.encode([x])[0] for x in _sections(texts[0])])
    return ids, np.array([0, len(ids)])


def _pieces(file: str, capacity: int, keep_ids: bool):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _tokenizer(file)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            docs = batch.column(0)
            for lo, hi, texts in text_chunks(batch.column(1)):
                ids, starts = _ids(encoder, texts)
                data = memoryview(ids.astype("<u4", copy=False)).cast("B")
                count = np.diff(starts) + 1  # with the end
                pieces = -(-count // capacity)
                doc = np.repeat(np.arange(hi - lo), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(count[doc] - start, capacity)
                last = piece == pieces[doc] - 1
                a = (starts[doc] + start) * 4
                b = a + (length - last) * 4
                spans = list(zip(a.tolist(), b.tolist(), last.tolist(), strict=True))
                sums = [zlib.crc32(end, zlib.crc32(data[x:y])) if z else zlib.crc32(data[x:y]) for x, y, z in spans]
                parts = [bytes(data[x:y]) + end * z for x, y, z in spans] if keep_ids else None
                cols = [docs.take(pa.array(doc + lo)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(sums, pa.int64()), pa.array(parts, pa.binary()) if keep_ids else pa.nulls(len(doc), pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return run


class _Stock:
    """How many pieces there are of each length; at most `capacity` lengths."""

    def __init__(self, counts: dict[int, int]):
        self.count = {s: n for s, n in counts.items() if n}
        self.sizes = sorted(self.count)

    def take(self, size: int, n: int) -> None:
        self.count[size] -= n
        if not self.count[size]:
            del self.count[size]
            del self.sizes[bisect_left(self.sizes, size)]

    def two_least(self) -> int:
        """The sum of the two shortest pieces left."""
        if not self.sizes:
            return 1 << 60
        a = self.sizes[0]
        return 2 * a if self.count[a] > 1 else a + self.sizes[1] if len(self.sizes) > 1 else 1 << 60


def plan_patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (number of sequences, [(length, pieces of that length), ...]) that use up the counted pieces.

    Reduction, from the longest length down: a set is fixed for all its pieces at once where no other set with that
    piece can do better: the piece alone if nothing fits beside it, with a piece that fills the rest exactly, or
    with the longest piece that fits if no two pieces do. The rest is packed best-fit decreasing; equal gaps are
    filled together, so the work follows the number of lengths and not of pieces.
    """
    stock, out = _Stock(counts), []
    for size in sorted(counts, reverse=True):
        while n := stock.count.get(size, 0):
            rest = capacity - size
            stock.take(size, n)  # look at what is left beside one piece of this length
            fits = [s for s in (stock.sizes[: bisect_right(stock.sizes, rest)][-1:])]
            own = rest >= size and n > 1
            best = max(fits + [size] * own, default=0)
            least_two = stock.two_least() if not own else min(stock.two_least(), size + (stock.sizes[0] if stock.sizes else size), 2 * size if n > 2 else 1 << 60)
            if not best:
                out.append((n, [(size, 1)]))
                continue
            if best == rest or least_two > rest:
                if best == size:
                    out.append((n // 2, [(size, 2)]))
                    if n % 2:
                        stock.count[size] = 1
                        insort(stock.sizes, size)
                        if n == 1:
                            break
                    continue
                k = min(n, stock.count[best])
                out.append((k, [(size, 1), (best, 1)]))
                stock.take(best, k)
                if n > k:
                    stock.count[size] = n - k
                    insort(stock.sizes, size)
                continue
            stock.count[size] = n
            insort(stock.sizes, size)
            break
    out += _best_fit(stock, capacity)
    return [(n, runs) for n, runs in out if n]


def _best_fit(stock: _Stock, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    open_by_gap: dict[int, list[list]] = {}
    gaps: list[int] = []

    def put(gap: int, n: int, runs: list[tuple[int, int]]) -> None:
        if gap not in open_by_gap:
            open_by_gap[gap] = []
            insort(gaps, gap)
        open_by_gap[gap].append([n, runs])

    for size in reversed(stock.sizes):
        left = stock.count[size]
        while left:
            i = bisect_left(gaps, size)
            if i == len(gaps):
                each = capacity // size
                if left // each:
                    put(capacity - each * size, left // each, [(size, each)])
                if left % each:
                    put(capacity - left % each * size, 1, [(size, left % each)])
                break
            gap = gaps[i]
            n, runs = open_by_gap[gap].pop()
            if not open_by_gap[gap]:
                del open_by_gap[gap]
                del gaps[i]
            each = min(gap // size, left)  # best fit keeps filling the sequence it has chosen
            full = min(n, left // each)
            put(gap - each * size, full, [*runs, (size, each)])
            if n > full:
                put(gap, n - full, runs)
            left -= full * each
    return [(n, runs) for group in open_by_gap.values() for n, runs in group]


def _slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, pieces a sequence, first sequence, offset there), by rising rank."""
    taken: dict[int, int] = {}
    rows: dict[int, list] = {}
    sequence = 0
    for n, runs in patterns:
        at = 0
        for size, each in runs:
            rank = taken.get(size, 0)
            rows.setdefault(size, []).append((rank, each, sequence, at))
            taken[size] = rank + n * each
            at += size * each
        sequence += n
    return {s: np.array(r, np.int64) for s, r in rows.items()}


def pack_documents(docs: DataFrame, file: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece (with keep_ids, its ids too).

    A document's ids are the tokenizer's for the whole text (null: none) and then id 1, so every document has a
    piece. Only documents of over `capacity` ids are cut, into pieces of `capacity` and a last one. Pieces go into as
    few sequences of at most `capacity` ids as the method finds; offsets are gapless from 0. Rows that repeat a doc_id
    are packed each by itself; an empty table gives an empty result; other columns are not looked at.

    The plan needs only how many pieces there are of each length, at most `capacity` numbers. Pieces are then ranked
    within their length, in salted groups so that a common length is ranked by many tasks, and take the rank's place.
    """
    if file is None:
        import public_tokenizers

        file = public_tokenizers.path(TOKENIZER)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pieces(file, capacity, keep_ids), PIECES)
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}  # at most `capacity` rows
    slots = rows.sparkSession.sparkContext.broadcast(_slots(plan_patterns(counts, capacity)))
    salts = max(1, -(-sum(counts.values()) // ROWS_PER_RANK)) * 16
    light = rows.select("length", "row", "doc_id", "piece", "start", "ids_crc32", F.pmod(F.xxhash64("row"), F.lit(salts)).alias("salt"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = light.groupBy("length", "salt").agg(F.count("*").alias("n")).select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = light.withColumn("own", F.row_number().over(Window.partitionBy("length", "salt").orderBy("row"))).join(offsets, ["length", "salt"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "row", (F.col("before") + F.col("own") - 1).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(6).to_numpy()
            sequence, offset = np.empty_like(length), np.empty_like(length)
            order = np.argsort(length, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if not len(at):
                    continue
                table = slots.value[int(length[at[0]])]
                own = table[np.searchsorted(table[:, 0], rank[at], "right") - 1]
                k = rank[at] - own[:, 0]
                sequence[at] = own[:, 2] + k // own[:, 1]
                offset[at] = own[:, 3] + k % own[:, 1] * length[at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "row", "sequence_id", "offset"])

    out = ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, row long, sequence_id long, offset long")
    if keep_ids:
        out = out.join(rows.select("row", "ids"), "row")
    return out.drop("row")
