"""Every operator against brute force on a small table of odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from kinlake.llm import class_model, components, decontamination, exact_dedup, language_id, packing, sharding, simhash, substring_dedup, token_counts, url_filter
from kinlake.llm.common import Words, text_chunks

public_tokenizers = pytest.importorskip("public_tokenizers")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, shard int, kept boolean, score double, bucket int"
PASSAGE = " ".join(f"shared{i}" for i in range(60))


def odd_rows():
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdeéñß"), rng.integers(1, 7)))
    texts = [None, "", "   ", "one", "Two  words", "two\twords", "Two words", "123 456 !!", "a " * 200, "x" * 3000, "Ünï cödé İ ﬁ <|endoftext|> I'll they've", " lead", "lead", "\x0b\x0c tail \r\n"]
    texts += [" ".join(word() for _ in range(n)) for n in (34, 35, 36, 80, 300)]
    long = " ".join(word() for _ in range(6000))
    texts += [long, long, long + " more", "pre " + PASSAGE + " post", "other start " + PASSAGE, PASSAGE + " " + PASSAGE]
    base = [word() for _ in range(400)]
    for k in range(4):
        copy = list(base)
        copy[7 * k] = "changed"
        texts.append(" ".join(copy))
    texts += ["the very same text"] * 12
    rows = [(i, t, ("en", "fr", None)[i % 3], "s", 0, 7, False, 0.5, 3) for i, t in enumerate(texts)]
    return [*rows, rows[19], (5, "a second text under one id", "en", "s", 0, 7, False, 0.5, 3), (None, "no id", "en", "s", 0, 7, False, 0.5, 3)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "d")
    spark.createDataFrame(odd_rows(), COLUMNS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def words(t):
    return t.encode().split() if t else []


def test_word_arrays():
    texts = [None, b"", b"a bb", b" cc\t", b"\x00z"]
    w = Words(texts)
    assert w.counts.tolist() == [0, 0, 2, 1, 1] and w.text(0, 2) == b"a bb"
    h = Words([b"a b a", b"a"]).hashes()
    assert h[0] == h[2] == h[3] != h[1]
    column = pa.array(["zz", "aa", "", None, "aaa", "b"]).slice(1)
    assert list(text_chunks(column, 2)) == [(0, 1, [b"aa"]), (1, 4, [b"", None, b"aaa"]), (4, 5, [b"b"])] and list(text_chunks(column.slice(0, 0))) == []


def test_url_rules(spark):
    urls = [None, "", "nourl", "http://", "https://Foo.COM", "http://foo.com/", "http://example.com/en/x?q", "http://www.example.com/en/", "http://a.www.example.com/en/", "http://badexample.com/en/", "http://x.net/es", "http://x.net/es/1#y", "http://net/fr/", "http://a.com:80/", "http://a.org/x.net/es/", "a://b://c.com/", "http://" + "a." * 3000 + "net/es/" + "y" * 5000]
    rows = [(i, u, "h", "old") for i, u in enumerate(urls)]
    got = {r.page_id: r for r in url_filter.judge_urls(spark.createDataFrame([*rows, rows[5]], "page_id int, url string, html string, verdict string")).collect()}
    for i, u in enumerate(urls):
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host) :])[0]
            host = host.lower()
        fits = [(v, r) for v, r in url_filter.RULES if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
        verdict, rule = max(fits, key=lambda x: len(x[1]), default=("allow", None))
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), u
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id int, url string")).count() == 0


def test_shift_and_over_several_words():
    globs = [f"*.{'h' * n}.org/p{n}/**" for n in range(1, 40)]
    texts = [f".x.{'h' * n}.org/p{m}/z".encode() for n in (1, 20, 39) for m in (1, 20, 39)]
    got = url_filter.ShiftAnd(globs).run(texts)
    assert got.sum() == 3 and all(got[i].any() == (i % 4 == 0) for i in range(9))


def test_shards(docs, empty):
    rows = sharding.shard_documents(docs, 5, bucket_bytes=4000).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.text or "") for r in rows) == sorted((r.doc_id is None, r.doc_id, r.text or "") for r in docs.collect())
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 5)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len({r.bucket for r in rows}) > 1
    by_id = defaultdict(set)
    for r in rows:
        by_id[r.doc_id].add((r.shard, r.grown_shard))
    assert all(len(v) == 1 for v in by_id.values())
    assert sharding.shard_documents(empty, 5).count() == 0


def test_shards_by_brute_force(docs):
    """Shard, bucket and place of every row from the seed alone, one row at a time."""
    shards, seed, bucket_bytes = 5, 7, 4000

    def hashed(*parts):
        h = 42
        for x in parts:
            if x is not None:
                h = xxhash.xxh64_intdigest(x.encode() if isinstance(x, str) else x[1].to_bytes(x[0], "little", signed=True), h)
        return h - (1 << 64) if h >> 63 else h

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    key = lambda i: None if i is None else (8, i)
    shard = lambda i, n: max(range(n), key=lambda s: (hashed((4, seed), (4, s), key(i)), s))
    total = sum(len((t or "").encode()) for _, t in rows)
    buckets = max(sharding.LEAST_BUCKETS, -(-total // (shards * bucket_bytes)))
    placed = defaultdict(list)
    for i, t in rows:
        placed[shard(i, shards), hashed((4, seed + 1), key(i), t or "") % buckets].append((i, t))
    want, begun = [], Counter()
    for (s, b), held in sorted(placed.items()):
        held.sort(key=lambda r: (-1 if r[0] is None else r[0], hashed(r[1])))
        place = np.arange(len(held))
        np.random.default_rng([seed, s, b]).shuffle(place)
        want += [(*held[k], s, shard(held[k][0], shards + 1), b, begun[s] + n) for n, k in enumerate(place)]
        begun[s] += len(held)
    got = sharding.shard_documents(docs, shards, seed, bucket_bytes).select("doc_id", "text", "shard", "grown_shard", "bucket", "slot").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_shards_are_written_in_order(docs, tmp_path):
    sharding.write_shards(sharding.shard_documents(docs, 3), str(tmp_path / "s"))
    back = docs.sparkSession.read.parquet(str(tmp_path / "s"))
    assert back.count() == docs.count() and len(list((tmp_path / "s").glob("shard=*"))) == 3
    for shard in (tmp_path / "s").glob("shard=*"):
        slots = []
        for bucket in sorted(shard.glob("bucket=*"), key=lambda p: int(p.name.split("=")[1])):
            for file in sorted(bucket.glob("*.parquet")):
                slots += pq.ParquetFile(file).read(columns=["slot"]).column("slot").to_pylist()
        assert slots == list(range(len(slots))) and slots


def test_windows_that_repeat(docs, empty):
    rows = [(r.doc_id, words(r.text)) for r in docs.collect()]
    seen = Counter(tuple(w[i : i + 35]) for _, w in rows for i in range(len(w) - 34))
    want = []
    for doc, w in rows:
        keep = [True] * len(w)
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                keep[i : i + 35] = [False] * 35
        want.append((doc, len(w), len(w) - sum(keep), b" ".join(x for x, k in zip(w, keep, strict=True) if k).decode()))
    for size, hot in ((6_000_000, 12_000_000), (2000, 12_000_000), (6_000_000, 1500), (2000, 0)):  # with hot 0 every window travels alone
        assert sorted(map(str, map(tuple, substring_dedup.remove_repeats(docs, size, hot).collect()))) == sorted(map(str, want))
    assert any(x[2] for x in want) and substring_dedup.remove_repeats(empty).count() == 0


def test_a_line_in_many_documents_is_spread(spark):
    """A line shorter than a window, between words that differ: no bucket grows with the number of its documents."""
    rng = np.random.default_rng(4)
    line = " ".join(f"boiler{i}" for i in range(30))
    word = lambda n: " ".join(map(str, rng.integers(0, 10**9, n)))
    texts = [f"{word(10)} {line} {word(10)}" for _ in range(1500)]
    texts += [f"{word(5)} {line} one two three four five {word(5)}" for _ in range(2)]  # these two share windows
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for hot in (1 << 40, 20_000):
        out = substring_dedup.remove_repeats(rows, 50_000, hot)
        assert sorted((r.doc_id, r.n_removed) for r in out.where("n_removed > 0").collect()) == [(1500, 35), (1501, 35)]

    def strings(hot, spread):
        """Packed strings by bucket."""
        held = Counter()
        for batch in rows.selectExpr("doc_id", "doc_id as text_key", "text").toArrow().to_batches():
            for x in substring_dedup._pack(16, hot, spread)(iter([batch])):
                for bucket, block in zip(x.column(0).to_pylist(), x.column(4).to_pylist(), strict=True):
                    held[bucket] += len(substring_dedup._unpack([block])[1]) if block else 0
        return held

    whole, split = strings(np.arange(0), 16), strings(np.arange(16 * substring_dedup.CELLS), 64)
    assert max(whole.values()) > 2 * sum(whole.values()) / len(whole)
    assert max(split.values()) < 1.5 * sum(split.values()) / len(split) and min(split) >= 16


def test_super_kmers_cover_every_window_once():
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["a", "b", "c"], n)).encode() for n in (0, 34, 35, 900, 2000)] + [b"z " * 700]
    w = Words(texts)
    first, count, low, _ = substring_dedup.super_kmers(w, w.hashes())
    got = sorted(i for f, c in zip(first, count, strict=True) for i in range(f, f + c))
    want = [int(w.first[k] + i) for k, n in enumerate(w.counts) for i in range(max(0, n - 34))]
    assert got == want and count.max() <= substring_dedup.RUN


def test_class_model(docs, empty):
    rows = [(r.doc_id, [x.lower() for x in words(r.text)] + [b""]) for r in docs.collect()]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    c = Counter(t for d, w in rows if not held(d) for t in w)
    n, v = sum(c.values()), len(c)
    want = sorted((str(d), held(d), len(w), sum(c[t] > 0 for t in w), n, round(sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in w), 6)) for d, w in rows)
    out = class_model.score_documents(docs, language_id.held_out(10, 0)).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
    assert all(math.isfinite(r.score) and r.score <= 0 for r in out)
    assert class_model.score_documents(empty, language_id.held_out(10, 0)).count() == 0


def brute_scores(rows, held, held_words, anchors):
    """The class model by plain dictionaries, from the same clustering of the anchors: scores by row, and all probabilities of the words
    that may follow each word."""
    texts = [([x.lower() for x in words(t)], held(d)) for d, t in rows]
    train = [w for w, out in texts if not out]
    c = Counter(x for w in train for x in w)
    top = sorted(c, key=lambda x: (-c[x], x))[:held_words]
    anchors = min(anchors, len(top))
    unit = {b"": 0} | {x: i + 1 for i, x in enumerate(top[:anchors])}
    grid = np.zeros((anchors + 2, anchors + 2))
    run = lambda w: [b"", *w, b""]
    for w in train:
        for x, y in zip(run(w), run(w)[1:]):
            grid[unit.get(x, anchors + 1), unit.get(y, anchors + 1)] += 1
    of = class_model.exchange_clustering(grid)
    other = int(of.max()) + 1
    between = np.zeros((other, other))
    for i in range(anchors + 1):
        for j in range(anchors + 1):
            between[of[i], of[j]] += grid[i, j]
    fit = class_model.fit(between)
    kind = {x: int(of[i]) for x, i in unit.items()}
    told = defaultdict(lambda: np.zeros(other))
    for w in train:
        r = run(w)
        for i in range(1, len(r) - 1):
            if r[i] not in unit:
                for near, side in ((r[i - 1], 0), (r[i + 1], other)):
                    if near in unit:
                        told[r[i]] += fit[side + of[unit[near]]]
    kind |= {x: int(v.argmax()) for x, v in told.items()}
    kind_of = lambda x: kind.get(x, other)
    n = sum(c.values()) + len(train)
    size = n + 0.1 * (len(c) + 1 + 1)
    known = {x: (k + 0.1) / size for x, k in c.items()} | {b"": (len(train) + 0.1) / size}
    base = lambda x: known.get(x, 0.1 / size)
    share = np.zeros(other + 1)
    for x, p in known.items():
        share[kind_of(x)] += p
    share[other] += 0.1 / size
    seen = np.zeros((other + 1, other + 1))
    for w in train:
        for x, y in zip(run(w), run(w)[1:]):
            seen[kind_of(x), kind_of(y)] += 1
    moves = (seen + class_model.PRIOR * share) / (seen.sum(axis=1, keepdims=True) + class_model.PRIOR)
    p = lambda x, y: moves[kind_of(x), kind_of(y)] * base(y) / share[kind_of(y)]
    sums = [sum(p(x, y) for y in known) + p(x, b"never seen") for x in [*list(known)[:20], b"never seen"]]
    return [sum(math.log10(p(x, y)) for x, y in zip(run(w), run(w)[1:])) for w, _ in texts], sums


@pytest.mark.parametrize(("held_words", "anchors"), [(300_000, 1000), (40, 12), (1, 1)])
def test_scores_and_distribution_by_brute_force(docs, monkeypatch, held_words, anchors):
    """With few held words most go through the join; the probabilities of all next words, the unknown one included, sum to 1."""
    monkeypatch.setattr(class_model, "HELD_WORDS", held_words)
    monkeypatch.setattr(class_model, "ANCHORS", anchors)
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    counts = Counter(x.lower() for d, t in rows if not held(d) for x in words(t))
    frame = docs.sparkSession.createDataFrame([(k.decode(), v) for k, v in counts.items()], "word string, n long")
    found, _ = class_model.most_frequent(frame, held_words)
    assert len(found) <= held_words
    monkeypatch.setattr(class_model, "most_frequent", lambda *_: (ranked, np.array([counts[x.encode()] for x in ranked])))
    ranked = [x.decode() for x in sorted(counts, key=lambda x: (-counts[x], x))[:held_words]]
    want, sums = brute_scores(rows, held, held_words, anchors)
    assert all(abs(s - 1) < 1e-9 for s in sums)
    out = class_model.score_documents(docs, language_id.held_out(10, 0)).collect()
    assert sorted((str(r.doc_id), round(r.score, 4)) for r in out) == sorted((str(d), round(s, 4)) for (d, _), s in zip(rows, want, strict=True))


def test_most_frequent_words_are_bounded(spark, monkeypatch):
    """Counts over the exact steps, many equal ones, and more frequent words than there is room for."""
    monkeypatch.setattr(class_model, "EXACT", 50)
    rows = [(f"a{i}", 1000 + i) for i in range(30)] + [(f"b{i}", 60) for i in range(5000)] + [(f"c{i}", 7) for i in range(100)] + [("", 10**6)]
    frame = spark.createDataFrame(rows, "word string, n long")
    for limit in (0, 3, 30, 31, 2000, 5030, 5100, 10_000):
        found, n = class_model.most_frequent(frame, limit)
        assert len(found) <= limit and len(found) >= min(limit, 5130) * 0.5 * (limit > 29) and list(n) == sorted(n, reverse=True) and "" not in found
        if len(found) < 5130:
            assert len(set(found)) == len(found)
    assert len(class_model.most_frequent(frame, 10_000)[0]) == 5130


def test_model_beats_its_base(spark, monkeypatch):
    monkeypatch.setattr(class_model, "HELD_WORDS", 3)
    rows = [(i, " ".join(("the cat sat" if i % 2 else "un chat noir",) * (1 + i % 5))) for i in range(60)]
    out = class_model.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), language_id.held_out(10, 0)).collect()
    held = [r for r in out if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_exchange_clustering_finds_two_kinds():
    b = np.zeros((6, 6))
    for i in (0, 2, 4):
        for j in (1, 3, 5):
            b[i, j] = b[j, i] = 10
    of = class_model.exchange_clustering(b, 2)
    assert of[0] == of[2] == of[4] != of[1] == of[3] == of[5]


def test_token_counts(docs, empty):
    pieces = token_counts.load_pieces(public_tokenizers.path(token_counts.VOCABULARY))
    least = min(pieces.values()) - 1

    def best(word):
        scores = [(0.0, 0)]
        for i in range(1, len(word) + 1):
            size = len(word[i - 1].encode())
            found = [(scores[i - 1][0] + size * least, scores[i - 1][1] - size)]
            found += [(scores[k][0] + pieces[word[k:i]], scores[k][1] - 1) for k in range(i) if word[k:i] in pieces]
            scores.append(max(found))
        return -scores[-1][1]

    memo = {}
    want = [(r.doc_id, len(words(r.text)), sum(memo.get(w) or memo.setdefault(w, best("▁" + w.decode())) for w in words(r.text))) for r in docs.collect()]
    got = [tuple(r)[:3] for r in token_counts.count_tokens(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want)) and token_counts.count_tokens(empty).count() == 0


def test_a_long_word_leaves_no_trie_behind():
    pieces = {"a": -1.0, "ab": -1.5, "b": -1.2, "abba": -2.5}
    trie = token_counts.PretokenTrie(pieces)
    rng = np.random.default_rng(2)
    for n in (1, 5, 60, 199):
        word = "".join(rng.choice(list("abé"), n))
        assert trie.count(word) == trie.count_long(word)
    nodes = len(trie.score)
    assert trie.count("abba" * 50_000) == 50_000 and len(trie.score) == nodes


def test_languages(docs, empty, spark):
    en, fr = "the cat and the dog went to the house with all of them ", "le chat et le chien sont dans la maison avec tous les autres "
    train = spark.createDataFrame([(en * 5, "en"), (fr * 5, "fr"), (None, "en"), (en, None)], "text string, lang string")
    rows = spark.createDataFrame([(1, "The dog and the cat"), (2, "Le chien dans la maison"), (3, None), (4, "123 !!"), (5, ""), (6, en * 30_000)], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify_languages(rows, train).collect()}
    assert [got[i][0] for i in (1, 2, 3, 4, 5, 6)] == ["en", "fr", "und", "und", "und", "en"] and all(0 <= s <= 1 for _, s in got.values())
    assert language_id.identify_languages(empty, train).count() == 0
    assert {r.lang_pred for r in language_id.identify_languages(rows, train.where("false")).collect()} == {"und"}
    kept = language_id.drop_unidentified(docs, docs)
    assert kept.columns == docs.columns and kept.count() == docs.where("text rlike '[a-zA-Zéñß]'").count()


def ngrams(text):
    """N-grams of 1 to 3 letters by plain string work."""
    runs = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    found = Counter()
    line = f" {' '.join(runs)} " if runs else ""
    for n in (1, 2, 3):
        for i in range(len(line) - n + 1):
            g = line[i : i + n]
            if g != " " and not (n == 3 and g[1] == " "):
                found[g] += 1
    return found


def number(gram):
    out = 0
    for c in gram:
        out = out << 21 | ord(c)
    return out


def profile(counts):
    return sorted(counts, key=lambda g: (-counts[g], number(g)))[: language_id.PROFILE]


@pytest.mark.parametrize("size", [language_id.PROFILE, 12])
def test_languages_by_brute_force(docs, spark, monkeypatch, size):
    """Ranks, ties, distance and score of every document, with whole and with cut profiles."""
    monkeypatch.setattr(language_id, "PROFILE", size)
    monkeypatch.setattr(language_id, "CHUNK", 50)
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    totals = defaultdict(Counter)
    for _, t, lang in rows:
        if lang is not None and t is not None:
            totals[lang] += ngrams(t)
    ranks = {lang: {g: i for i, g in enumerate(profile(c))} for lang, c in totals.items()}
    want = []
    for doc, t, _ in rows:
        top = profile(ngrams(t or ""))
        away = {lang: sum(abs(r[g] - i) if g in r else size for i, g in enumerate(top)) for lang, r in ranks.items()}
        best = min(sorted(away), key=away.get)
        want.append((doc, best, round(1 - away[best] / (size * len(top)), 9)) if top else (doc, "und", 0.0))
    # profiles are made here and not in workers, which would not see the patched sizes
    profiles = language_id.Profiles({lang: [number(g) for g in r] for lang, r in ranks.items()})
    got = [(doc, *profiles.predict(t)) for doc, t, _ in rows]
    assert sorted(str((d, p, round(s, 9))) for d, p, s in got) == sorted(map(str, want))
    if size == 400:
        out = language_id.identify_languages(docs, docs.select("text", "lang")).collect()
        assert sorted(str((r.doc_id, r.lang_pred, round(r.score, 9))) for r in out) == sorted(map(str, want))


def test_ngram_counts_in_chunks(monkeypatch):
    text = "ab cd\té " * 50
    whole = language_id.counted(text)
    monkeypatch.setattr(language_id, "CHUNK", 7)
    parts = language_id.counted(text)
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts, strict=True))


def low(t):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if c.isascii() else c for c in t or ""))


@pytest.mark.parametrize("broadcast", [True, False])
def test_benchmark_windows(docs, empty, spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontamination, "FINGERPRINTS", 0)
    bench = [(1, PASSAGE), (2, "Two words"), (3, None), (4, "!!"), (5, "a a a a a a a a a a a a"), (6, " ".join(f"shared{i}" for i in range(50, 70))), (7, "nowhere to be found in any of these texts at all"), (10, "One"), (10, "no id")]
    rows = [(r.doc_id, low(r.text)) for r in docs.collect()]
    want = []
    for doc, w in rows:
        hit, items = set(), set()
        for item, t in bench:
            x = low(t)
            size = min(10, len(x))
            for i in range(len(x) - size + 1 if x else 0):
                for p in range(len(w) - size + 1):
                    if w[p : p + size] == x[i : i + size]:
                        hit |= set(range(p, p + size))
                        items.add(str(item))
        want.append((doc, len(w), len(hit), sorted(items), bool(hit)))
    table = spark.createDataFrame([(i, t, "x", 0, 0, False) for i, t in bench], "item_id long, text string, words string, value int, doc_id int, contaminated boolean")
    got = decontamination.find_contamination(docs, table)
    assert sorted(map(str, map(tuple, got.drop("text_key").collect()))) == sorted(map(str, want)) and any(x[4] for x in want)
    assert decontamination.find_contamination(empty, table).count() == 0
    assert decontamination.find_contamination(docs, table.where("false")).where("contaminated").count() == 0
    kept = decontamination.drop_contaminated(docs, table)
    assert kept.columns == docs.columns and kept.count() == sum(not x[4] for x in want)


def test_benchmark_beyond_a_broadcast_shuffles_no_words(docs, spark, monkeypatch, capsys):
    """Where the hashes are looked for, only numbers are exchanged."""
    monkeypatch.setattr(decontamination, "FINGERPRINTS", 0)
    tables = []
    real = decontamination.materialise
    monkeypatch.setattr(decontamination, "materialise", lambda df, label: tables.append((label, df)) or real(df, label))
    decontamination.find_contamination(docs, spark.createDataFrame([(1, PASSAGE)], "item_id long, text string"))
    found = next(df for label, df in tables if label == "found")
    found.explain("formatted")
    plan = capsys.readouterr().out
    exchanges = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert exchanges and not any("words" in x or "text#" in x or "marked" in x for x in exchanges), exchanges


def fingerprint(t):
    w = [x.lower() for x in words(t)]
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_and_components(docs, empty):
    rows = [(r.doc_id, fingerprint(r.text)) for r in docs.collect()]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 2:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {}
    for g, (doc, _) in zip(group, rows, strict=True):
        if doc is not None:
            least[g] = min(least.get(g, doc), doc)
    want = sorted(str((d, f, least.get(g))) for g, (d, f) in zip(group, rows, strict=True))
    out = simhash.simhash_groups(docs).collect()
    assert sorted(str((r.doc_id, r.fp % (1 << 64), r.component_id)) for r in out) == want
    assert simhash.simhash_groups(empty).count() == 0
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns and simhash.drop_near_copies(empty).count() == 0
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert len(set(ids)) == len(ids) and "5" in ids  # the other text of doc_id 5 is a copy of document 4's


def test_near_copies_under_null_and_repeated_ids(spark):
    base = [f"w{i}" for i in range(100)]
    near = [" ".join([*base[:k], "changed", *base[k + 1 :]]) for k in (0, 99, 98)]
    alone = " ".join(f"v{i}" for i in range(50))
    rows = [(None, near[0]), (None, near[1]), (None, near[2]), (None, alone), (None, alone), (9, "x"), (9, "x"), (3, None), (3, ""), (4, " ")]
    kept = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(str((r.doc_id, r.text in near or r.text)) for r in kept if r.doc_id != 3) == sorted(map(str, [(None, True), (None, alone), (9, "x")]))
    assert sum(r.doc_id == 3 for r in kept) == 1


def test_fingerprint_of_many_shingles(monkeypatch):
    text = " ".join(str(i % 71) for i in range(500))
    monkeypatch.setattr(simhash, "SHINGLES", 7)
    assert simhash._fingerprints(pa.array([text, "a", None])) == [fingerprint(text), fingerprint("a"), 0]


def test_near_copies_of_similarity_08_go(spark):
    rng = np.random.default_rng(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts, sets = [], []
    for n in (12, 60, 200, 400, 1000):
        for _ in range(6):
            base = list(rng.choice(vocabulary, n))
            texts.append(base)
            for changes in (1, 2, 4, 8, 16):
                copy = list(base)
                for at in rng.choice(n, min(changes, n), replace=False):
                    copy[at] = "changed"
                texts.append(copy)
    rows = [(None if i % 50 == 7 else (i * 7919) % 1009, " ".join(t)) for i, t in enumerate(texts)] + [(None, "Two words"), (2000, "two WORDS"), (2001, "two")]
    for _, t in rows:
        w = t.lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    order = lambda i: (rows[i][0] is None, rows[i][0] or 0)
    want = {rows[min((i for i in range(len(rows)) if group[i] == g), key=order)][1] for g in set(group)}
    kept = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(want) < 0.8 * len(rows) and sorted(r.text for r in kept) == sorted(want)


def test_bk_tree_finds_all_within_the_radius():
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    values = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) for c in centre]))
    found = {(int(node), int(q)) for node, near in simhash.BKTree(values).within(values, 2) for q in near}
    assert found == {(i, j) for i, a in enumerate(values) for j, b in enumerate(values) if int(a ^ b).bit_count() <= 2}


def test_components_of_a_chain_and_a_star(docs, spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_equal_texts(docs, empty):
    norm = lambda t: re.sub(r"[\x20\x09-\x0d]+", " ", t or "")
    rows = [(r.doc_id, norm(r.text)) for r in docs.collect()]
    size = Counter(t for _, t in rows)
    keep = {t: min((d for d, x in rows if x == t and d is not None), default=None) for t in size}
    out = exact_dedup.exact_dedup(docs).collect()
    got = sorted(str((r.doc_id, r.keep_id, r.group_size, bytes(r.digest).hex())) for r in out)
    assert got == sorted(str((d, keep[t], size[t], hashlib.sha256(t.encode()).hexdigest())) for d, t in rows)
    assert sum(r.kept for r in out) == len(size) and all(r.doc_id == r.keep_id for r in out if r.kept)
    assert exact_dedup.exact_dedup(empty).count() == 0
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and sorted(norm(r.text) for r in kept.collect()) == sorted(size)


def test_equal_texts_without_an_id_keep_one_row(spark):
    rows = [(None, "a text"), (None, "a text"), (None, "b  text"), (None, "b text"), (None, None), (None, ""), (5, "c text"), (None, "c text"), (7, None), (7, "")]
    kept = exact_dedup.drop_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    norm = lambda t: re.sub(r"\s+", " ", t or "")
    assert sorted(norm(r.text) for r in kept) == ["", "a text", "b text", "c text"]
    assert {r.doc_id for r in kept if norm(r.text) in ("", "c text")} == {5, 7}
    twice = spark.createDataFrame([(3, None), (3, "")], "doc_id long, text string")
    assert exact_dedup.drop_copies(twice).count() == 1


def test_retired_texts_leave_the_index(docs):
    out = exact_dedup.exact_dedup(docs, docs.where("text = 'the very same text'")).collect()
    gone = [r for r in out if r.keep_id is None and r.doc_id is not None]
    assert len(gone) == 12 and not any(r.kept for r in gone)


def test_cuckoo_index_grows_and_deletes():
    index = exact_dedup.CuckooIndex(2)
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for d in digests:
        index.insert(d, [0, 0, 1])
    assert index.buckets * index.SLOTS >= 3000 and all(index.get(d) for d in digests)
    assert all(index.delete(d) for d in digests[::2]) and not index.delete(digests[0])
    assert all(index.get(d) is None for d in digests[::2]) and all(index.get(d) for d in digests[1::2])
    assert sorted(d for d, _ in index.live()) == sorted(digests[1::2])


def test_cuckoo_index_answers_through_its_filter_and_compares_content():
    index = exact_dedup.CuckooIndex(1)
    twins = [b"ab" + bytes(8) + bytes([i]) * 22 for i in range(6)]  # equal fingerprints and buckets
    for i, d in enumerate(twins):
        index.insert(d, [i, 0, 1])
    assert [index.get(d)[0] for d in twins] == list(range(6)) and index.get(b"ab" + bytes(8) + b"x" * 22) is None
    assert index.delete(twins[2]) and index.get(twins[2]) is None and index.get(twins[3])[0] == 3
    index.marks = [0] * len(index.marks)
    assert all(index.get(d) is None for d in twins)  # an empty filter knows nothing


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = []
    for r in docs.collect():
        ids = [*t.encode(r.text or "", add_special_tokens=False).ids, 1]
        want += [(r.doc_id, k, a, len(ids[a : a + 4096]), zlib.crc32(np.array(ids[a : a + 4096], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), 4096))]
    rows = packing.pack_documents(docs, keep_ids=True).collect()
    assert sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows) == sorted(map(str, want))
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in rows) and packing.pack_documents(empty).count() == 0
    check_places(rows)


def check_places(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return len(by)


@pytest.mark.parametrize("seed", range(8))
def test_plans_use_every_piece_and_few_sequences(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 101, 400) if seed % 2 else np.minimum(rng.geometric(0.02, 600), 100)
    counts = Counter(sizes.tolist())
    plan = packing.plan_patterns(counts, 100)
    used = Counter()
    for n, runs in plan:
        assert n > 0 and sum(s * k for s, k in runs) <= 100
        for s, k in runs:
            used[s] += n * k
    assert used == counts
    bound = max(-(-int(sizes.sum()) // 100), int((sizes > 50).sum()))
    assert sum(n for n, _ in plan) <= bound * 1.03 + 1
    ranks = {s: sorted((int(r[0]), int(r[1])) for r in table) for s, table in packing._slots(plan).items()}
    assert all(t[0][0] == 0 for t in ranks.values())


def test_plan_of_fixed_cases():
    total = lambda c, cap=10: sum(n for n, _ in packing.plan_patterns(c, cap))
    assert total({10: 3}) == 3 and total({6: 2, 4: 2}) == 2 and total({5: 5}) == 3 and total({9: 1, 8: 1}) == 2 and total({}) == 0
    assert total({6: 1, 3: 1, 2: 1, 1: 1, 7: 1}) == 2 and total({1: 25}) == 3
