"""Brown class-based bigram model: exchange clustering, class transitions, word emissions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, gathered, materialise, text_chunks, tidy

#: Words whose hashes every task holds (at most, the most frequent); all others are looked up by a join.
HELD_WORDS = 300_000
#: Words that sequential exchange clusters on the driver (the most frequent; at most ANCHORS squared numbers), and classes. Every other
#: word then moves to the class that fits its own neighbours best.
ANCHORS, CLASSES, PASSES = 1000, 48, 200
#: A move must raise the log likelihood by so much for each bigram.
TOLERANCE = 1e-8
#: Strength of the unigram class distribution in the transitions.
PRIOR = 20.0
ALPHA = 0.1
#: Groups that a frequent word's neighbours are added up in first.
SALTS = 64
#: Counts up to which words are told apart by their exact count when the most frequent are sought; above, by 1000 steps a doubling.
EXACT = 100_000
_END = 0


def exchange_clustering(bigrams: np.ndarray, classes: int = CLASSES, passes: int = PASSES) -> np.ndarray:
    """A class for each unit. Units are first dealt by frequency; then each in turn moves to the class that raises the
    likelihood of the class bigram model most, until a pass has no move that raises it by more than TOLERANCE a bigram (or `passes`
    are over). bigrams: counts (unit, next unit)."""
    units = len(bigrams)
    f = lambda x: x * np.log(np.maximum(x, 1e-300))
    total = bigrams.sum(axis=1) + bigrams.sum(axis=0)
    least = TOLERANCE * bigrams.sum()
    classes = min(classes, units)
    of = np.empty(units, np.int64)
    of[np.argsort(-total, kind="stable")] = np.arange(units) % classes
    one = np.eye(classes)[of]
    g = one.T @ bigrams @ one
    for _ in range(passes):
        moved = False
        for u in np.argsort(-total, kind="stable"):
            if not total[u]:
                continue
            own = bigrams[u, u]
            right = np.bincount(of, weights=bigrams[u], minlength=classes)
            left = np.bincount(of, weights=bigrams[:, u], minlength=classes)
            c = of[u]
            right[c] -= own
            left[c] -= own
            g[c] -= right
            g[:, c] -= left
            g[c, c] -= own
            rows, cols = g.sum(axis=1), g.sum(axis=0)
            diag = np.arange(classes)
            up, across = g + right[None, :], g + left[:, None]
            gain = (f(up) - f(g)).sum(axis=1) + (f(across) - f(g)).sum(axis=0)
            d = g[diag, diag]
            gain += f(d + right + left + own) - f(d + right) - f(d + left) + f(d)
            out, into = right.sum() + own, left.sum() + own
            gain -= f(rows + out) - f(rows) + f(cols + into) - f(cols)
            best = int(gain.argmax())
            if gain[best] <= gain[c] + least:
                best = c
            moved |= best != c
            of[u] = best
            g[best] += right
            g[:, best] += left
            g[best, best] += own
        if not moved:
            break
    return of


@tidy
def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in gathered(batches, 6_000_000):
        for lo, hi, texts in text_chunks(batch.column(0), 6_000_000):
            w = Words(texts, lower=True)
            _, first, n = np.unique(w.hashes(), return_index=True, return_counts=True)
            data = w.data
            words = [data[a:b] for a, b in zip(w.starts[first].tolist(), w.ends[first].tolist(), strict=True)]
            # an end is counted with each text, as the empty word
            yield pa.RecordBatch.from_arrays([pa.array([*words, b""], pa.binary()).cast(pa.string()), pa.array(np.append(n, hi - lo))], names=["word", "n"])


def most_frequent(counts: DataFrame, limit: int) -> tuple[list[str], np.ndarray]:
    """The most frequent words and their counts, `limit` at most: all down to some count, and of those one step less frequent as many
    hash groups as there is room for. Only numbers of words by step and by group are collected to find where to cut."""
    step = F.when(F.col("n") < EXACT, F.col("n")).otherwise(EXACT + F.floor(F.log2(F.col("n") / EXACT) * 1000)).cast("long")
    words = counts.where("word <> ''").select("word", "n", step.alias("step"), F.pmod(F.xxhash64("word"), F.lit(1024)).alias("part"))
    room, floor, parts = limit, 0, 0
    for r in sorted(words.groupBy("step").count().collect(), key=lambda r: -r["step"]):  # at most EXACT steps and 64,000 more
        if r["count"] > room:
            floor = r["step"]
            break
        room -= r["count"]
    if floor:
        sizes = dict(words.where(F.col("step") == floor).groupBy("part").count().collect())
        while parts < 1024 and sizes.get(parts, 0) <= room:
            room -= sizes.get(parts, 0)
            parts += 1
    table = words.where((F.col("step") > floor) | ((F.col("step") == floor) & (F.col("part") < parts))).select("word", "n").toArrow()
    found, n = table.column("word").to_pylist(), table.column("n").to_numpy()
    order = sorted(range(len(found)), key=lambda i: (-n[i], found[i]))
    return [found[i] for i in order], n[order]


class Held:
    """Numbers of the held words by hash: 1 for the most frequent, and so on; 0 is the end of a text."""

    def __init__(self, words: list[str]):
        h = Words([x.encode() for x in words]).hashes() if words else np.zeros(0, np.uint64)
        order = np.argsort(h)
        self.hashes, self.number = h[order], (order + 1).astype(np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Numbers, or -1."""
        if not len(self.hashes):
            return np.full(len(h), -1, np.int32)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.number[at], np.int32(-1))


SEQUENCES = "doc_id long, held_out boolean, words binary, rare array<string>"


def _sequences(held):
    """Texts to the numbers of their words: held ones by their number, the k-th distinct other word of a text by -1 - k."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = held.value
        for batch in batches:
            for lo, hi, texts in text_chunks(batch.column(2)):
                w = Words(texts, lower=True)
                n, data = hi - lo, w.data
                number = v.find(w.hashes())
                words: list[dict[bytes, int]] = [{} for _ in range(n)]
                at = np.flatnonzero(number < 0)
                rare = []
                for r, a, b in zip(w.row[at].tolist(), w.starts[at].tolist(), w.ends[at].tolist(), strict=True):
                    d = words[r]
                    rare.append(-1 - d.setdefault(data[a:b], len(d)))
                number[at] = rare
                sizes = np.append(0, np.cumsum([len(d) for d in words])).astype(np.int32)
                flat = pa.array([x for d in words for x in d], pa.binary()).cast(pa.string())
                cols = [batch.column(0).slice(lo, n), batch.column(1).slice(lo, n), _binary(number.astype("<i4"), w.first), pa.ListArray.from_arrays(sizes, flat)]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "held_out", "words", "rare"])

    return run


def _binary(numbers: np.ndarray, first: np.ndarray) -> pa.Array:
    """One binary value for each stretch of numbers."""
    offsets = (first * numbers.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(numbers.tobytes())])


def _numbers(column: pa.Array, kind: str | np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all values end to end, and where each value's begin (one more: the end)."""
    kind = np.dtype(kind)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(kind) if data is not None and len(column) else np.zeros(0, kind)
    return flat, (offsets - offsets[0]) // kind.itemsize


def _with_ends(numbers: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers with an end before the first text and after every text, and the place of each word there."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    place = np.arange(len(numbers)) + row + 1
    out = np.full(len(numbers) + len(first), _END, np.int64)
    out[place] = numbers
    return out, place


def _anchor_pairs(anchors: int):
    """Counts of neighbours among ends (0), anchors, and all other words together (the last number)."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = anchors + 2
        total = np.zeros(units * units, np.int64)
        for batch in batches:
            numbers, first = _numbers(batch.column(0), "<i4")
            s, _ = _with_ends(np.where((numbers < 0) | (numbers > anchors), anchors + 1, numbers), first)
            pairs, n = np.unique(s[:-1] * units + s[1:], return_counts=True)
            total[pairs] += n
        pairs = np.flatnonzero(total)
        for k in range(0, len(pairs), 50_000):
            p = pairs[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(total[p])], names=["pair", "n"])

    return run


#: How often a word stands beside a class: its left neighbours' classes, then its right neighbours'.
_CELL = np.dtype([("cell", "<u2"), ("n", "<u4")])
CONTEXTS = "number long, word string, salt int, times long, cells binary"


def _contexts(classes: np.ndarray, width: int):
    """Words that are no anchors, with the classes of anchors and ends beside them; classes: by number, ends first; width: how many."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = len(classes) - 1
        part = TaskContext.get().partitionId() % SALTS + 1
        number, cells = [], []

        def flush() -> Iterator[pa.RecordBatch]:
            """The held words of all batches so far."""
            if number:
                yield from rows(np.concatenate(number), np.concatenate(cells), None)
                number.clear(), cells.clear()

        def rows(who: np.ndarray, beside: np.ndarray, names: pa.Array | None) -> Iterator[pa.RecordBatch]:
            """who: a word's number for each of its tokens, repeated; beside: pairs (class before, class after), -1 where it is no anchor."""
            order = np.argsort(who, kind="stable")
            who, beside = who[order], beside[order]
            own = np.flatnonzero(np.diff(who, prepend=-1))
            times = np.diff(np.append(own, len(who)))
            at = np.repeat(np.arange(len(own)), times)
            key = np.concatenate([at * (2 * width) + beside[:, 0], at * (2 * width) + width + beside[:, 1]])[np.concatenate([beside[:, 0], beside[:, 1]]) >= 0]
            key, n = np.unique(key, return_counts=True)
            found = np.empty(len(key), _CELL)
            found["cell"], found["n"] = key % (2 * width), n
            first = np.searchsorted(key // (2 * width), np.arange(len(own) + 1))
            cols = [pa.array(who[own]), pa.nulls(len(own), pa.string()), pa.array(np.full(len(own), part, np.int32)), pa.array(times), _binary(found, first)]
            if names is not None:
                cols[0], cols[1], cols[2] = pa.nulls(len(own), pa.int64()), names.take(pa.array(who[own])), pa.array(np.zeros(len(own), np.int32))
            yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in CONTEXTS.split(", ")])

        for batch in batches:
            numbers, first = _numbers(batch.column(0), "<i4")
            s, place = _with_ends(numbers, first)
            near = np.where((s >= 0) & (s <= anchors), classes[np.clip(s, 0, anchors)], -1)
            beside = np.stack([near[place - 1], near[place + 1]], axis=1)
            held = numbers > anchors
            number.append(numbers[held].astype(np.int64))
            cells.append(beside[held].astype(np.int16))
            if sum(map(len, number)) > 1_000_000:
                yield from flush()
            names = batch.column(1)
            offsets = np.asarray(names.offsets).astype(np.int64)
            row = np.repeat(np.arange(len(first) - 1), np.diff(first))
            rare = numbers < 0
            who = offsets[row[rare]] - offsets[0] - 1 - numbers[rare]
            if len(who):  # equal words of several texts meet before the shuffle
                flat = names.flatten().dictionary_encode()
                yield from rows(flat.indices.to_numpy().astype(np.int64)[who], beside[rare].astype(np.int16), flat.dictionary)
        yield from flush()

    return run


def _added(column: pa.ListArray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of each row's list of cells, added up: (row, cell, n)."""
    flat, first = _numbers(column.flatten(), _CELL)
    lists = np.asarray(column.offsets).astype(np.int64)
    bounds = first[lists - lists[0]]
    key = np.repeat(np.arange(len(column)), np.diff(bounds)) * (2 * width) + flat["cell"]
    key, at = np.unique(key, return_inverse=True)
    return key // (2 * width), key % (2 * width), np.bincount(at, weights=flat["n"], minlength=len(key)).astype(np.int64)


def _merge(width: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, cell, n = _added(batch.column(4), width)
            found = np.empty(len(row), _CELL)
            found["cell"], found["n"] = cell, n
            cols = [*batch.columns[:4], _binary(found, np.searchsorted(row, np.arange(batch.num_rows + 1)))]
            yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in CONTEXTS.split(", ")])

    return run


def fit(grid: np.ndarray) -> np.ndarray:
    """What a neighbour of a class tells about a word's class: (left classes, then right ones) by class. It is the first-order change of
    the class bigram likelihood when a word with that neighbour moves to the class, which is what exchange goes by."""
    g = grid + 0.5
    total = g.sum()
    own = np.log(g * total / np.outer(g.sum(axis=1), g.sum(axis=0)))
    return np.concatenate([own, own.T])


def _choose(table: np.ndarray):
    """Rows of cells to the class that fits best; without a neighbour that tells, class -1."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = table.shape[1]
        for batch in batches:
            row, cell, n = _added(batch.column(4), width)
            best = np.full(batch.num_rows, -1, np.int32)
            if len(row):
                own = np.flatnonzero(np.diff(row, prepend=-1))
                best[row[own]] = np.add.reduceat(table[cell] * n[:, None], own).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(best)], names=["number", "word", "times", "class"])

    return run


RESOLVED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, classes binary"


def _resolve(model, size: float):
    """Rows (words, found, doc_id, held_out) to the classes of their words, one byte each, and their base scores. found: (k, n, c) of the
    text's k-th other word, which the model has seen n times and put into class c."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, of, other = model.value
        logp = np.log10((counts + ALPHA) / size)
        for batch in batches:
            numbers, first = _numbers(batch.column(0), "<i4")
            lists = np.asarray(batch.column(1).offsets).astype(np.int64)
            k, n, c = (batch.column(1).flatten().field(i).to_numpy(zero_copy_only=False) for i in range(3))
            own = np.repeat(lists[:-1] - lists[0], np.diff(lists)) + k
            times, kind = np.zeros(len(k), np.int64), np.full(len(k), other, np.int64)
            times[own], kind[own] = n, np.where(c < 0, other, c)
            row = np.repeat(np.arange(batch.num_rows), np.diff(first))
            rare = numbers < 0
            at = lists[row[rare]] - lists[0] - 1 - numbers[rare]
            classes, each, known = of[np.maximum(numbers, 0)], logp[np.maximum(numbers, 0)], np.ones(len(numbers), bool)
            classes[rare], each[rare], known[rare] = kind[at], np.log10((times[at] + ALPHA) / size), times[at] > 0
            base = np.bincount(row, weights=each, minlength=batch.num_rows) + logp[_END]
            seen = np.bincount(row, weights=known, minlength=batch.num_rows).astype(np.int64) + (counts[_END] > 0)
            cols = [batch.column(2), batch.column(3), pa.array(np.diff(first) + 1), pa.array(seen), pa.array(base), _binary(classes.astype("u1"), first)]
            yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in RESOLVED.split(", ")])

    return run


def _class_runs(column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The classes of all texts with the end's before and after each, and where each text's words begin."""
    classes, first = _numbers(column, "u1")
    s, place = _with_ends(classes, first)
    out = np.full(len(s), end, np.int64)
    out[place] = classes
    return out, first


def _class_pairs(width: int, end: int):
    """Counts of neighbouring classes."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width, np.int64)
        for batch in batches:
            s, _ = _class_runs(batch.column(0), end)
            total += np.bincount(s[:-1] * width + s[1:], minlength=len(total))
        pairs = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(total[pairs])], names=["pair", "n"])

    return run


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score(shift: np.ndarray, end: int):
    """Resolved rows to their scores; shift: log10 of transition over share, by class before and class."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, first = _class_runs(batch.column(5), end)
            row = np.repeat(np.arange(batch.num_rows), np.diff(first) + 1)
            moved = np.bincount(row, weights=shift[s[:-1], s[1:]], minlength=batch.num_rows)
            cols = [*batch.columns[:5], pa.array(batch.column(4).to_numpy() + moved)]
            yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in SCORED.split(", ")])

    return run


def score_documents(docs: DataFrame, held_out) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    held_out: a condition on doc_id; the model learns from all other documents. Texts are lower-cased (A-Z) and cut
    into words [^\\x20\\x09-\\x0D]+; an end follows every text and counts as a token. A null text is empty and has the end
    alone. base_score is the sum over tokens of log10((c + 0.1) / (N + 0.1 (V + 1))); n_known counts tokens with
    c > 0. Where nothing was learned all counts are 0. Rows that repeat a doc_id are scored each by itself; an empty table
    gives an empty result; other columns are not looked at. Texts of any length are scored whole.

    score adds classes: P(w | before) = P(class of w | class of the word before) P(w | class of w). Exchange clustering
    deals the ANCHORS most frequent words and the end over CLASSES classes until no move helps; every other learned word,
    however rare, then moves to the class that its own neighbours among them ask for. Words without such a neighbour
    and the one unknown word have a class of their own. Transitions are smoothed by the classes' shares, emissions are
    the base probabilities within a class, so the probabilities of all next words sum to 1.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    train = rows.where("not held_out").select("text")
    counts = materialise(train.mapInArrow(_word_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    size = tokens + ALPHA * (distinct + 1)
    ends = (counts.where("word = ''").agg(F.sum("n")).first()[0]) or 0
    words, n = most_frequent(counts, HELD_WORDS)
    held = spark.sparkContext.broadcast(Held(words))
    told = materialise(rows.mapInArrow(_sequences(held), SEQUENCES).withColumn("row", F.monotonically_increasing_id()), "sequences", "zstd")
    learned = told.where("not held_out")

    # the most frequent words: exchange among them and ends; what they stand beside else is one more unit
    anchors = min(ANCHORS, len(words))
    units = anchors + 2
    pairs = learned.select("words").mapInArrow(_anchor_pairs(anchors), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()  # at most units x units
    grid = np.zeros(units * units)
    grid[pairs.column("pair").to_numpy()] = pairs.column("n").to_numpy()
    grid = grid.reshape(units, units)
    of = exchange_clustering(grid)
    other = int(of.max()) + 1
    one = np.eye(other)[of[:-1]]

    # all others, by their own neighbours
    found = learned.select("words", "rare").mapInArrow(_contexts(of[:-1], other), CONTEXTS)
    total = lambda x: x.groupBy("number", "word", "salt").agg(F.sum("times").alias("times"), F.collect_list("cells").alias("cells"))
    found = materialise(total(found).mapInArrow(_merge(other), CONTEXTS), "contexts", "zstd")
    choose = _choose(fit(one.T @ grid[:-1, :-1] @ one))
    kinds = "number long, word string, times long, class int"
    rare = materialise(found.where("salt = 0").withColumn("cells", F.array("cells")).mapInArrow(choose, kinds), "classes")
    common = total(found.where("salt > 0").withColumn("salt", F.lit(0))).mapInArrow(choose, kinds).select("number", "class").toArrow()  # at most HELD_WORDS rows
    held_class = np.full(len(words) + 1, other, np.int64)
    held_class[: anchors + 1] = of[:-1]
    kind = common.column("class").to_numpy()
    held_class[common.column("number").to_numpy()] = np.where(kind < 0, other, kind)
    model = spark.sparkContext.broadcast((np.append(ends, n).astype(np.int64), held_class, other))

    # every text's rare words get their counts and classes; then class transitions, then scores
    asked = told.select("row", F.posexplode("rare").alias("k", "word"))
    asked = asked.join(rare.select("word", "times", "class"), "word", "left").groupBy("row").agg(F.collect_list(F.struct("k", F.coalesce("times", F.lit(0)).alias("n"), F.coalesce("class", F.lit(-1)).alias("c"))).alias("found"))
    joined = told.drop("rare").join(asked, "row", "left").withColumn("found", F.coalesce("found", F.array().cast("array<struct<k:int,n:bigint,c:int>>")))
    resolved = materialise(joined.select("words", "found", "doc_id", "held_out").mapInArrow(_resolve(model, float(size)), RESOLVED), "resolved")
    end = int(of[_END])
    pairs = resolved.where("not held_out").select("classes").mapInArrow(_class_pairs(other + 1, end), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()  # classes squared
    seen = np.zeros((other + 1) ** 2)
    seen[pairs.column("pair").to_numpy()] = pairs.column("n").to_numpy()
    shift = transitions(seen.reshape(other + 1, other + 1), class_shares(rare, model.value, ends, size))
    out = resolved.mapInArrow(_score(shift, end), SCORED)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")


def class_shares(rare: DataFrame, model: tuple, ends: int, size: float) -> np.ndarray:
    """The base probability of each class: of its words, and for the last one of the unknown word too."""
    counts, of, other = model
    mass, members = np.bincount(of, weights=counts, minlength=other + 1), np.bincount(of, minlength=other + 1).astype(float)
    if not ends:  # nothing was learned, not even an end
        members[of[_END]] -= 1
    for r in rare.groupBy("class").agg(F.sum("times").alias("n"), F.count("*").alias("words")).collect():  # one row a class
        c = other if r["class"] < 0 else r["class"]
        mass[c] += r["n"]
        members[c] += r["words"]
    members[other] += 1
    return (mass + ALPHA * members) / size


def transitions(seen: np.ndarray, share: np.ndarray) -> np.ndarray:
    """log10 of P(class | class before) over the class's share."""
    moves = (seen + PRIOR * share) / (seen.sum(axis=1, keepdims=True) + PRIOR * share.sum())
    return np.log10(np.maximum(moves, 1e-300) / np.maximum(share, 1e-300))
