"""Benchmark decontamination by winnowed k-gram fingerprints; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, remove_rows, small, text_key

WINDOW, GRAM = 10, 6
#: Fingerprints of the benchmark up to which they are broadcast (some 300 bytes each, with their words); beyond it the join shuffles.
FINGERPRINTS = 100_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PICK = WINDOW - GRAM + 1  # grams that a window of words holds: the least of them is kept


def words(text: Column) -> Column:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after A-Z are lower-cased; null has none."""
    # split and array_remove, since extracting every match is some ten times slower
    parts = F.split(F.translate(text, _UPPER, _LOWER), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
    return F.coalesce(F.array_remove(parts, ""), F.array().cast("array<string>"))


def _grams(words: str, size: int) -> Column:
    """Hashes of `size` consecutive words at each place; the low byte is left for the place."""
    tail = lambda i: [F.get(F.col(words), i + k) for k in range(1, size)]
    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - (size - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *tail(i)).bitwiseAND(F.lit(~255)))


def _winnowed(df: DataFrame) -> DataFrame:
    """Adds picked: for each window of WINDOW words its fingerprint, the least gram hash with its place modulo 256 in the low byte;
    null where the window before has the same, so that each is kept once."""
    tail = lambda i: [F.get(F.col("words"), i + k) for k in range(1, GRAM)]
    hashed = lambda x, i: F.xxhash64(x, *tail(i)).bitwiseAND(F.lit(~255)).bitwiseOR(i.bitwiseAND(F.lit(255)).cast("long"))
    marked = df.withColumn("marked", F.transform(F.slice("words", 1, F.greatest(F.size("words") - (GRAM - 1), F.lit(0))), hashed))
    windows = F.slice("marked", 1, F.greatest(F.size("words") - (WINDOW - 1), F.lit(0)))
    least = lambda x, i: F.least(x, *[F.get(F.col("marked"), i + k) for k in range(1, _PICK)])
    every = marked.withColumn("every", F.transform(windows, least)).drop("marked")
    return every.withColumn("picked", F.transform("every", lambda x, i: F.when((i == 0) | (F.get(F.col("every"), i - 1) != x), x))).drop("every")


def _meetings(docs: DataFrame, places: DataFrame) -> DataFrame:
    """Pairs of a kept gram of a document and a place of an item with the same hash, with the words around both."""
    near = ["doc_id", "text_key", "item_id", "p", "doc_before", "doc_from", "item_before", "item_from"]
    value = F.col("pick").bitwiseAND(F.lit(~255))
    # outer, for else Spark would test the size of the array before it is made, and make it twice
    seen = _winnowed(docs).select("doc_id", "text_key", "words", F.posexplode_outer("picked").alias("i", "pick")).where("pick is not null")
    seen = seen.withColumns({"value": value, "p": (F.col("i") + F.pmod(F.col("pick").bitwiseAND(F.lit(255)) - F.col("i"), F.lit(256))).cast("int")})
    if places.count() <= FINGERPRINTS:
        met = seen.join(F.broadcast(places), "value")
        return materialise(met.select("doc_id", "text_key", *_context("words", "p", "doc"), "item_id", "p", "item_before", "item_from").select(near), "meetings")
    # only numbers are shuffled to find the documents' grams that the benchmark has; then each document with one meets its grams, and
    # only those carry words
    values = places.select("value").distinct()
    found = materialise(seen.select("doc_id", "text_key", "value", "p").distinct().join(values, "value", "left_semi"), "found")
    grams = found.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("p", "value")).alias("grams"))  # as many as the text has
    grams = small(materialise(grams.withColumnsRenamed({"doc_id": "of_id", "text_key": "of_key"}), "grams"), FINGERPRINTS // 100)
    with_text = docs.select("doc_id", "text_key", "text")
    held = with_text.join(grams, with_text["doc_id"].eqNullSafe(grams["of_id"]) & (with_text["text_key"] == grams["of_key"]))
    held = held.select("doc_id", "text_key", words(F.col("text")).alias("words"), "grams").select("doc_id", "text_key", "words", F.explode("grams").alias("g"))
    held = held.select("doc_id", "text_key", "words", F.col("g.p").alias("p"), F.col("g.value").alias("value"))
    cut = materialise(held.select("doc_id", "text_key", "value", "p", *_context("words", "p", "doc")), "contexts")
    return materialise(cut.join(places, "value").select(near), "meetings")


def _hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, text_key, item_id, first: places of documents where a window of an item of WINDOW words or more starts."""
    kept = _winnowed(items).select("item_id", F.explode(F.array_distinct(F.transform(F.filter("picked", lambda x: x.isNotNull()), lambda x: x.bitwiseAND(F.lit(~255))))).alias("value"))
    # the places of every gram with a kept value, so that no tie within a window can hide an alignment
    places = items.withColumn("gram", _grams("words", GRAM)).select("item_id", "words", F.posexplode_outer("gram").alias("q", "value"))
    places = places.join(kept, ["item_id", "value"], "left_semi").select("item_id", "value", "q", *_context("words", "q", "item"))
    # meetings are written, so that the comparison of words stays out of the join, which then runs in one generated loop with the scan
    met = _meetings(docs, materialise(places, "fingerprints"))
    # extend: the run of equal words to the left and to the right of the gram, as far as a window that holds it reaches
    equal = lambda a, b, n: F.coalesce(F.aggregate(F.sequence(F.lit(0), F.lit(n - 1)), F.lit(0), lambda run, k: F.when((run == k) & (F.get(F.col(a), k) == F.get(F.col(b), k)), run + 1).otherwise(run)), F.lit(0))
    met = met.withColumns({"left": equal("doc_before", "item_before", WINDOW - GRAM), "right": equal("doc_from", "item_from", WINDOW)})
    met = met.where((F.col("right") >= GRAM) & (F.col("left") + F.col("right") >= WINDOW))
    return met.select("doc_id", "text_key", "item_id", (F.col("p") - F.col("left")).alias("first"), (F.col("left") + F.col("right")).alias("n"))


def _context(words: str, at: str, name: str) -> list[Column]:
    """Words before a place, nearest first, and words from it on."""
    before = F.reverse(F.slice(words, F.greatest(F.col(at) - (WINDOW - GRAM - 1), F.lit(1)), F.least(F.col(at), F.lit(WINDOW - GRAM))))
    return [before.alias(f"{name}_before"), F.slice(words, F.col(at) + 1, WINDOW).alias(f"{name}_from")]


def _short_hits(docs: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """The same for items of `size` words, fewer than a window: their one gram is looked up at every place."""
    wanted = items.where(F.size("words") == size).select("item_id", F.col("words").alias("item_words"), F.xxhash64(*[F.get("words", F.lit(k)) for k in range(size)]).bitwiseAND(F.lit(~255)).alias("value"))
    wanted = small(materialise(wanted, "fingerprints"), FINGERPRINTS)
    seen = docs.withColumn("gram", _grams("words", size)).select("doc_id", "text_key", "words", F.posexplode_outer("gram").alias("first", "value"))
    own = seen.select("doc_id", "text_key", "first", "value", F.slice("words", F.col("first") + 1, size).alias("own_words"))
    met = own.join(wanted, "value").where("own_words = item_words")
    return met.select("doc_id", "text_key", "item_id", "first", F.lit(size).alias("n"))


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, items (sorted as strings), contaminated of every document.

    A benchmark window is 10 consecutive words of an item; an item of fewer words, but not none, is one window. A
    document word inside any occurrence of a window is hit; items are those with an occurring window. A null text
    has no words, and an item without words, or whose text is null, never occurs. Rows that repeat a doc_id are documents of their own,
    unless they repeat the text too, whose results are equal. Of an item_id that repeats, all texts count. Empty tables give
    no hits, or an empty result. Other columns are not looked at. Texts of any length are searched whole.

    Winnowing: of the 6-gram hashes in each window of 10 words the least is kept, on both sides by value and once for
    consecutive windows, so a shared span of 10 words shares a kept gram. Documents meet the benchmark on kept grams; a
    meeting is extended word by word to both sides and counts if the run reaches 10 words. Fingerprints of a benchmark of over
    FINGERPRINTS grams are not broadcast: hashes are shuffled first, and words go only with grams that the benchmark has.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text", words(F.col("text")).alias("words"))
    items = materialise(benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("words")).where(F.size("words") > 0).distinct(), "items")
    # several texts of one item_id are told apart while they are matched
    items = items.withColumn("item_id", F.struct("item_id", F.xxhash64("words").alias("text")))
    sizes = sorted(r[0] for r in items.where(F.size("words") < WINDOW).select(F.size("words")).distinct().collect())  # at most WINDOW - 1 numbers
    hits = _hits(rows, items.where(F.size("words") >= WINDOW))
    for size in sizes:
        hits = hits.unionByName(_short_hits(rows, items, size))
    spans = hits.select("doc_id", "text_key", F.col("item_id")["item_id"].alias("item_id"), "first", "n").distinct()
    # a document's spans and items: no more than its words and the benchmark's items
    marked = spans.groupBy("doc_id", "text_key").agg(
        F.size(F.array_distinct(F.flatten(F.transform(F.collect_set(F.struct("first", "n")), lambda s: F.sequence(s["first"], s["first"] + s["n"] - 1))))).cast("long").alias("n_hit"),
        F.array_sort(F.collect_set("item_id")).alias("items"),
    ).withColumnsRenamed({"doc_id": "of_id", "text_key": "of_key"})
    counted = rows.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"))
    out = counted.join(marked, counted["doc_id"].eqNullSafe(marked["of_id"]) & (counted["text_key"] == marked["of_key"]), "left")
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("doc_id", "text_key", "n_words", hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), (hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that hold a benchmark window (as in find_contamination), columns unchanged, whatever their names.

    Rows that repeat a doc_id and text stay or go together, a null doc_id is one like any other, a null text holds nothing and
    stays. Empty tables drop nothing, or give an empty result.
    """
    return remove_rows(docs, find_contamination(docs, benchmark).where("contaminated"))
