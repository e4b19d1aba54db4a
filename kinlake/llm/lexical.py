"""Ranked lexical search: classes of documents with the same bag of item terms are scored once."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, kept, materialise, tidy

#: Fixed value: terms are made of digits, letters A to Z (lower-cased) and every character beyond ASCII.
_TERM = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TO_TERMS = bytes(c if c in _TERM or c > 127 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_BREAK = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
#: Fixed values of the weights: 1000 * ln((2N + 2) / (2df + 1)), length norm 100 - 75 + 75 * n * N div L, 10^9 * tf div (1000 * tf + 8 * m).
FLAT, SLOPE, NORM = 100, 75, 8
#: Term occurrences of the items that are searched for in one pass over the documents; their terms are broadcast (about 50 MB).
ITEM_TERMS = 2_000_000
#: Cells (terms of a block of items times items) of a dense block of weights, and (documents times terms) of one of documents.
CELLS = 4_000_000


class Items(NamedTuple):
    """The items of one pass: their ids, the distinct terms, and for each item its term numbers with counts."""

    ids: list
    terms: list[bytes]
    bags: list[list[tuple[int, int]]]


def term_sections(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a stretch of about CHUNK_BYTES at a time, cut where a term ends."""
    at = 0
    while at < len(text):
        cut = _BREAK.search(text, at + CHUNK_BYTES) if at + CHUNK_BYTES < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end].translate(_TO_TERMS).split()
        at = end


def item_passes(items: DataFrame, limit: int = ITEM_TERMS) -> Iterator[Items]:
    """The items in stretches of about `limit` term occurrences; an item of more is a stretch of its own."""

    def stretch(held: list) -> Items:
        terms = sorted({t for _, bag in held for t in bag})
        number = {t: i for i, t in enumerate(terms)}
        return Items([i for i, _ in held], terms, [sorted((number[t], n) for t, n in bag.items()) for _, bag in held])

    held, size = [], 0
    for r in items.select("item_id", F.col("text").cast("binary").alias("text")).toLocalIterator():
        bag: Counter = Counter()
        for words in term_sections(bytes(r.text or b"")):
            bag.update(words)
        if held and size + len(bag) > limit:
            yield stretch(held)
            held, size = [], 0
        held.append((r.item_id, bag))
        size += len(bag)
    if held:
        yield stretch(held)


def _bags(terms):
    """doc_id, n (all terms) and bag of every document: (term number, occurrences) of the item terms, as pairs of 32-bit numbers."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = kept(__name__)
        if held.get("of") != terms.id:
            held.clear()
            held.update(of=terms.id, number={t: i for i, t in enumerate(terms.value)})
        get = held["number"].get
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            n, bags = np.zeros(len(texts), np.int64), []
            for i, text in enumerate(texts):
                bag: Counter = Counter()
                for words in term_sections(text.as_py() or b""):
                    n[i] += len(words)
                    bag.update(map(get, words))
                bag.pop(None, None)
                flat = np.array(sorted(bag.items()), "<u4")
                bags.append(flat.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(bags, pa.binary())], names=["doc_id", "n", "bag"])

    return run


@tidy
def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, documents) of a task."""
    df = np.zeros(0, np.int64)
    for batch in batches:
        terms = np.frombuffer(b"".join(x.as_py() for x in batch.column(0)), "<u4")[::2]
        if len(terms):
            here = np.bincount(terms, minlength=len(df))
            here[: len(df)] += df
            df = here
    have = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(have.astype(np.int32)), pa.array(df[have])], names=["term", "df"])


class Block(NamedTuple):
    """Items that are scored by one matrix: place in the pass of the first, their terms, weights (terms by items)."""

    first: int
    terms: np.ndarray
    weights: np.ndarray


def weight_blocks(items: Items, weight: np.ndarray, cells: int = CELLS) -> Iterator[Block]:
    """Dense weights (term weight times its occurrences in the item) of a few items at a time, over their own terms alone."""
    lo = 0
    while lo < len(items.bags):
        hi, terms = lo, set()
        while hi < len(items.bags):
            more = terms | {t for t, _ in items.bags[hi]}
            if hi > lo and len(more) * (hi + 1 - lo) > cells:
                break
            terms, hi = more, hi + 1
        own = np.array(sorted(terms), np.int64)
        w = np.zeros((len(own), hi - lo), np.int64)
        for j in range(lo, hi):
            if items.bags[j]:
                t, n = np.array(items.bags[j]).T
                w[np.searchsorted(own, t), j - lo] = weight[t] * n
        # below 2^53 sums of doubles are exact
        yield Block(lo, own, w.astype(np.float64) if w.sum(0).max(initial=0) * 10**6 < 2**53 else w)
        lo = hi


class Best:
    """The k best classes of each item so far: higher scores first, then the smaller first document."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.least = np.ones(n, np.int64)  # scores above 0 count
        self.item, self.score, self.first = (np.zeros(0, np.int64) for _ in range(3))
        self.rows: list[list] = []

    def add(self, item0: int, scores: np.ndarray, first: np.ndarray, members: list) -> None:
        """scores: classes by items from item0 on; first: the classes' smallest doc_ids."""
        c, j = np.nonzero(scores >= self.least[item0 : item0 + scores.shape[1]])
        if not len(c):
            return
        item, score = np.append(self.item, j + item0), np.append(self.score, scores[c, j].astype(np.int64))
        ids = np.append(self.first, first[c])
        order = np.lexsort((ids, -score, item))
        begin = np.flatnonzero(np.diff(item[order], prepend=-1))
        rank = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
        stay = order[rank < self.k]
        old = len(self.rows)
        self.rows = [self.rows[x] if x < old else members[c[x - old]] for x in stay.tolist()]
        self.item, self.score, self.first = item[stay], score[stay], ids[stay]
        full = order[rank == self.k - 1]
        self.least[item[full]] = score[full]


def _score(blocks, n_items: int, k: int):
    """The k best classes of each item among those of a task."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(n_items, k)
        step = max(1, CELLS // max([1, *(len(b.terms) + b.weights.shape[1] for b in blocks.value)]))
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                m, ids = part.column("m").to_numpy(), part.column("ids").to_pylist()
                bags = [np.frombuffer(x.as_py(), "<u4") for x in part.column("bag")]
                row = np.repeat(np.arange(len(bags)), [len(b) // 2 for b in bags])
                flat = np.concatenate(bags).astype(np.int64)
                term, tf = flat[::2], flat[1::2]
                gain = 1_000_000_000 * tf // (1000 * tf + NORM * m[row])
                first = np.array([np.iinfo(np.int64).max if x[0] is None else x[0] for x in ids], np.int64)
                for b in blocks.value:
                    at = np.minimum(np.searchsorted(b.terms, term), len(b.terms) - 1) if len(b.terms) else np.zeros(0, np.int64)
                    if not len(at):
                        continue
                    own = b.terms[at] == term
                    dense = np.zeros((len(bags), len(b.terms)), b.weights.dtype)
                    dense[row[own], at[own]] = gain[own]
                    best.add(b.first, dense @ b.weights, first, ids)
        yield pa.RecordBatch.from_arrays([pa.array(best.item, pa.int32()), pa.array(best.score), pa.array(best.rows, pa.list_(pa.int64()))], names=["item", "score", "ids"])

    return run


def bag_classes(bags: DataFrame, k: int) -> DataFrame:
    """m, bag and ids (its k smallest doc_ids, rising) of every class of documents that share m and bag, byte for byte.

    The hash deals and sorts; rows meet only where m and the bag itself are equal too. At most k rows of a class leave a task, so a
    class of very many documents isn't gathered.
    """
    own = Window.partitionBy("hash", "m", "bag").orderBy(F.col("doc_id").asc_nulls_last())
    ranked = bags.withColumn("hash", F.xxhash64("bag", "m")).withColumn("nth", F.row_number().over(own)).where(F.col("nth") <= k)
    return ranked.groupBy("hash", "m", "bag").agg(F.sort_array(F.collect_list(F.struct(F.col("nth"), F.col("doc_id")))).alias("x")).select("m", "bag", F.col("x.doc_id").alias("ids"))


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id and score: of each item its k highest-scoring documents with a score above 0.

    Terms are the maximal stretches of digits, letters and non-ASCII characters of the whole text, A-Z lower-cased. Every
    document becomes the bag of its item terms, with the length norm m; documents of equal bags and m are one class, scored once
    against all items of a pass by dense blocks. The classes that lead in a task, then over all, are spread out to their
    documents by rising doc_id. Statistics are those of all documents; scores are whole numbers.

    A null text has no terms; a null doc_id comes last among equal scores; rows that repeat a doc_id are ranked each by itself. A very
    long text is read in stretches. Items without a term, a null item text among them, have no row, and a repeated item_id is
    ranked as one row of items each, by itself, under the same id. Empty tables give an empty result. Other columns are not looked at.
    """
    spark = docs.sparkSession
    work = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for part in item_passes(items):
        terms = spark.sparkContext.broadcast(part.terms)
        bags = materialise(work.mapInArrow(_bags(_Named(terms)), "doc_id long, n long, bag binary"), "bags", "zstd")
        total = bags.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
        if not total.docs:
            break
        found = bags.where(F.length("bag") > 0)
        df = np.zeros(len(part.terms), np.int64)
        for r in found.select("bag").mapInArrow(_frequencies, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():  # one row a term of the items
            df[r.term] = r.df
        weight = np.array([math.floor(1000 * math.log((2 * total.docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        m = F.expr(f"{FLAT - SLOPE} + ({SLOPE} * n * {total.docs}L) div {total.terms}L").alias("m")
        classes = bag_classes(found.select("doc_id", "bag", m), k)
        blocks = spark.sparkContext.broadcast(list(weight_blocks(part, weight)))
        lead = classes.mapInArrow(_score(blocks, len(part.ids), k), "item int, score long, ids array<bigint>")
        by_class = Window.partitionBy("item").orderBy(F.desc("score"), F.col("ids")[0].asc_nulls_last())
        lead = lead.withColumn("nth", F.row_number().over(by_class)).where(F.col("nth") <= k)
        by_doc = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        spread = lead.select("item", "score", F.explode("ids").alias("doc_id")).withColumn("rank", F.row_number().over(by_doc)).where(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(part.ids)), f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        ranked = spread.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # the items of a pass are bounded
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        return spark.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    return out


class _Named:
    """A broadcast with a name by which a worker knows what it has kept of it."""

    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, broadcast._jbroadcast.id()

    def __getstate__(self):
        return self.broadcast, self.id

    def __setstate__(self, state):
        self.broadcast, self.id = state

    @property
    def value(self):
        return self.broadcast.value
