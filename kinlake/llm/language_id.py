"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_chunks, tidy

#: N-grams of 1 to 3 letters (a word's ends count as a blank); the PROFILE most frequent make a profile.
PROFILE = 400
UNKNOWN = "und"
#: Characters counted at once (more only where a word is longer).
CHUNK = 250_000
_BLANK = re.compile(r"\s")


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _codes(text: str) -> np.ndarray:
    """Lower-cased letters, with one blank for whatever stands between, before and after."""
    cps = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[cps]
    codes = np.where(letter, cps, 32).astype(np.int64)
    return codes[letter | np.append(True, letter[:-1])]


def _grams(codes: np.ndarray) -> np.ndarray:
    """N-grams, each as one number of 21 bits a character; none crosses a blank."""
    pair = (codes[:-1] << 21) | codes[1:]
    triple = (pair[:-1] << 21) | codes[2:]
    return np.concatenate((codes[codes != 32], pair, triple[codes[1:-1] != 32]))


def _sections(text: str) -> Iterator[str]:
    """The text cut at white space into sections of about CHUNK characters; no n-gram stands in two of them."""
    at = 0
    while at < len(text):
        blank = _BLANK.search(text, at + CHUNK) if at + CHUNK < len(text) else None
        end = blank.end() if blank else len(text)
        yield text[at:end]
        at = end


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text, and how often each stands in it."""
    parts = [np.unique(_grams(codes), return_counts=True) for codes in map(_codes, _sections(text)) if len(codes) > 1]
    if len(parts) < 2:
        return parts[0] if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(inverse, weights=np.concatenate([c for _, c in parts])).astype(np.int64)


def ranked(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The PROFILE most frequent, by falling count and then by key."""
    if len(keys) > 4 * PROFILE:
        least = np.partition(counts, len(counts) - PROFILE)[len(counts) - PROFILE]
        keep = counts >= least
        keys, counts = keys[keep], counts[keep]
    return keys[np.lexsort((keys, -counts))[:PROFILE]]


class Profiles:
    """Ranks of n-grams by language, and the out-of-place distance of a text to each."""

    def __init__(self, profiles: dict[str, list[int]]):
        self.langs = sorted(profiles)
        self.keys = np.unique(np.array([k for p in profiles.values() for k in p], np.int64))
        self.ranks = np.full((len(self.keys) + 1, len(self.langs)), -1, np.int64)
        for j, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.keys, np.array(profiles[lang], np.int64)), j] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language (of equally near ones the first by name) and 1 minus its share of the farthest distance."""
        if not text or not self.langs:
            return UNKNOWN, 0.0
        keys, counts = counted(text)
        if not len(keys):
            return UNKNOWN, 0.0
        top = ranked(keys, counts)
        at = np.minimum(np.searchsorted(self.keys, top), len(self.keys) - 1)
        at[self.keys[at] != top] = len(self.keys)
        rank = self.ranks[at]
        away = np.where(rank < 0, PROFILE, np.abs(rank - np.arange(len(top))[:, None])).sum(axis=0)
        best = int(away.argmin())
        return self.langs[best], float(1 - away[best] / (PROFILE * len(top)))


@tidy
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts of a task by language, added up over its texts before the shuffle."""
    held: dict[str, list] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            n = np.bincount(inverse, weights=np.concatenate([c for _, c in parts])).astype(np.int64)
            parts[:] = [(keys, n)]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys), pa.array(n)], names=["lang", "gram", "n"])

    for batch in batches:
        texts = (x.decode() for _, _, part in text_chunks(batch.column(1)) for x in part)
        for lang, text in zip(batch.column(0).to_pylist(), texts, strict=True):
            k, c = counted(text)
            held.setdefault(lang, []).append((k, c))
            size += len(k)
            if size > 2_000_000:
                for _ in flush():
                    pass
                size = sum(len(p[0][0]) for p in held.values())
                if size > 1_000_000:
                    yield from flush()
                    held.clear()
                    size = 0
    yield from flush()


def train_profiles(labelled: DataFrame) -> Profiles:
    """Profiles from all labelled rows (text, lang), nulls left out; a profile holds PROFILE n-grams, whatever the corpus."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    grams = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    kept = grams.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= PROFILE)
    profiles: dict[str, list[int]] = {}
    for r in kept.orderBy("lang", "rank").collect():  # PROFILE rows a language
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return Profiles(profiles)


def language_of(profiles: Profiles, text: Column) -> Column:
    """struct(lang_pred, score) of a text."""

    @F.arrow_udf("lang_pred string, score double")
    @tidy
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            found = [profiles.predict(x and x.decode()) for _, _, texts in text_chunks(column) for x in texts]
            langs, scores = zip(*found, strict=True) if found else ((), ())
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    return predict(text)


def held_out(buckets: int = 4, out: int = 2) -> Column:
    """Whether crc32(doc_id as text) mod `buckets` is `out`; a null doc_id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % buckets == out, F.lit(False))


def identify_languages(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """doc_id, text, lang_pred and score of every document, from profiles learned on `labelled` (text, lang).

    Only the text decides: its PROFILE most frequent n-grams of 1 to 3 letters are ranked, and the language with the
    least sum of rank differences wins (an n-gram that a profile lacks counts PROFILE). score is 1 minus the share
    that this sum has of the largest possible. A null text, or one without a letter, and every text where nothing
    was learned, gives `und` and 0. Texts of any length are counted whole; repeated rows are judged each by itself; an
    empty table gives an empty result; other columns are not looked at.
    """
    found = language_of(train_profiles(labelled), F.col("text"))
    out = docs.select("doc_id", "text").withColumn("found", found)
    return out.select("doc_id", "text", "found.lang_pred", "found.score")


def drop_unidentified(docs: DataFrame, labelled: DataFrame, least: float = 0.0) -> DataFrame:
    """docs without those whose language is `und` or whose score is under `least`, columns unchanged, whatever their names.

    Rows are judged by their text alone, each by itself: a null or empty text and one without a letter go, repeated rows and
    null doc_ids stay or go like any other, texts of any length are judged whole. An empty table gives an empty result.
    """
    found = language_of(train_profiles(labelled), F.col("text"))
    out = docs.withColumn("__found", found)
    return out.where((F.col("__found.lang_pred") != UNKNOWN) & (F.col("__found.score") >= least)).drop("__found")
