"""Centroid clustering, lexical search and token files against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinlake.llm import centroids, lexical, token_files

public_tokenizers = pytest.importorskip("public_tokenizers")


# centroid clustering


def brute_clusters(rows, k=8, rounds=10, dims=64, scale=1024, seed=3):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    cents = [list(v) for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for j, vs in groups.items():
            cents[j] = [sum(col) // len(vs) for col in zip(*vs, strict=True)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, c, d in found:
        inertia[c] += d
    most = lambda x: min(x, centroids.LONGEST)
    return Counter((i, c, most(d), most(inertia[c]), most(sum(inertia.values())), tuple(cents[c])) for i, c, d in found)


def clusters(df):
    return Counter((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, tuple(r.centroid)) for r in df.collect())


def odd_vectors(dims, n, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.round(rng.normal(size=(n, dims)), 2))]
    rows += [(n + i, rows[i % 3][1]) for i in range(40)]  # one vector in many copies
    rows += [(900, None), (901, []), (902, [1.0] * (dims - 1)), (903, [1.0] * (dims + 1)), (904, [None] + [1.0] * (dims - 1))]
    rows += [(905, [float("nan")] + [1.0] * (dims - 1)), (906, [float("-inf")] + [1.0] * (dims - 1)), (None, [0.5] * dims), rows[4], rows[4]]
    return rows


@pytest.mark.parametrize(("k", "leaf"), [(8, 4), (8, 1), (3, 2), (1, 4), (500, 4)])
def test_clusters_by_brute_force(spark, k, leaf):
    rows = odd_vectors(4, 90)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "vec_id long, embedding array<double>, label string, cluster int, k int").repartition(5)
    assert clusters(centroids.cluster_vectors(df, k=k, rounds=4, dims=4, scale=16, leaf=leaf)) == brute_clusters(rows, k, 4, 4, 16)


def test_clusters_of_the_query(spark):
    rows = odd_vectors(64, 150)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert clusters(centroids.cluster_vectors(df)) == brute_clusters(rows)


def test_clusters_of_long_components(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(40, 3)) * 800_000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert clusters(centroids.cluster_vectors(df, k=4, rounds=3, dims=3)) == brute_clusters(rows, 4, 3, 3)
    far = [(1, [1e300, 0.0]), (2, [-1e300, 0.0]), (3, [0.0, 0.0])]
    got = {r.vec_id: (r.distance, r.inertia) for r in centroids.cluster_vectors(spark.createDataFrame(far, "vec_id long, embedding array<double>"), k=1, rounds=1, dims=2).collect()}
    assert len(got) == 3 and got[1] == (centroids.LONGEST, centroids.LONGEST)


def test_no_vectors(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        out = centroids.cluster_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
        assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]


def test_tree_keeps_ties_and_cuts():
    grid = np.array([[x, y] for x in range(-6, 7, 2) for y in range(-6, 7, 2)], np.int64)
    points = np.array([[x, y] for x in range(-8, 9) for y in range(-8, 9)], np.int64)
    tree = centroids.CentroidTree(np.concatenate([grid, grid]), leaf=2)
    looked = []
    measure = tree._distances
    tree._distances = lambda q, members: looked.append(len(q) * len(members)) or measure(q, members)
    who, far = tree.nearest(points)
    want = [min((int(((p - c) ** 2).sum()), j) for j, c in enumerate(grid)) for p in points]
    assert list(zip(far.tolist(), who.tolist(), strict=True)) == want
    assert sum(looked) < 0.7 * len(points) * 2 * len(grid)  # the rest was cut


# ranked lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_ranks(docs, items, k=10):
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, total = sum(n > 0 for *_, n in bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = Counter()
    for item, text in items:
        scores = []
        for i, bag, n in bags:
            m = 100 - 75 + (75 * n * n_docs) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m)) for t in terms(text) if bag[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        for rank, (s, _, _, i) in enumerate(sorted(scores)[:k], 1):
            out[item, rank, i, -s] += 1
    return out


def odd_texts():
    rng = np.random.default_rng(3)
    word = lambda: f"w{int(rng.zipf(1.4)) % 60}"
    texts = [None, "", " ,.", "One one ONE", "é È ñ", "İ dotted", "w1-w2_w3/w4", "rare " * 500, "w1 " * 3]
    texts += [" ".join(word() for _ in range(int(rng.integers(1, 120)))) for _ in range(120)]
    texts += ["w3 w5 copy"] * 30 + ["copy w5 w3"] * 5 + [texts[20]] * 14
    rows = list(enumerate(texts))[::-1]
    return [*rows, rows[3], (7, "a second text w5 w9"), (None, "w5 w9 no id"), (None, "w3 w5 copy")]


ITEMS = [(1, "w1 w3, W5. w5"), (2, None), (3, ""), (4, "nowhere to be found"), (5, "one é È w40 w41 w42"), (5, "rare W9"), (6, "w3 w5 copy"), (None, "w7")]


@pytest.mark.parametrize(("limit", "cells"), [(lexical.ITEM_TERMS, lexical.CELLS), (6, 12)])
def test_ranks_by_brute_force(spark, monkeypatch, limit, cells):
    monkeypatch.setattr(lexical, "CHUNK_BYTES", 50)
    docs = spark.createDataFrame([(*r, "x", 1) for r in odd_texts()], "doc_id long, text string, bag string, score int").repartition(6)
    items = spark.createDataFrame([(*r, 0) for r in ITEMS], "item_id long, text string, rank int")
    real = lexical.item_passes
    monkeypatch.setattr(lexical, "item_passes", lambda x: real(x, limit))
    blocks = lexical.weight_blocks
    monkeypatch.setattr(lexical, "weight_blocks", lambda a, b: blocks(a, b, cells))
    for k in (10, 3):
        got = Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.rank_documents(docs, items, k).collect())
        assert got == brute_ranks(odd_texts(), ITEMS, k)


def test_ranks_of_nothing(spark):
    docs, items = spark.createDataFrame([(1, None), (2, "...")], "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    some = spark.createDataFrame([(1, "w1")], "doc_id long, text string")
    for d, i in ((docs, items), (docs.where("false"), items), (some, items.where("false")), (some, items.where("item_id = 2"))):
        out = lexical.rank_documents(d, i)
        assert out.count() == 0 and out.columns == ["item_id", "rank", "doc_id", "score"]


def test_equal_bags_are_one_class(spark):
    bags = spark.createDataFrame([(i, b"ab" if i % 3 else b"cd", 5 if i % 2 else 6) for i in range(60)] + [(None, b"ab", 5)], "doc_id long, bag binary, m long").repartition(4)
    got = {(bytes(r.bag), r.m): r.ids for r in lexical.bag_classes(bags, 4).collect()}
    assert len(got) == 4 and got[b"ab", 5] == [1, 5, 7, 11] and got[b"cd", 6] == [0, 6, 12, 18]


def test_terms_in_stretches():
    text = ("Aé-9 " * 100 + "x" * 300 + ", end").encode()
    import unittest.mock as mock

    with mock.patch.object(lexical, "CHUNK_BYTES", 37):
        parts = list(lexical.term_sections(text))
    assert len(parts) > 5 and [w.decode() for p in parts for w in p] == terms(text.decode())


# token files


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(token_files.TOKENIZER))


WHITE = [None, "", " ", "  ", "\n", " \n ", "a", " a", "  a", "\n\na", "\t a \n b  ", "a \n", "I'll they've 're'd x'", "don't  stop\r\nnow", "Ünï cödé x  y", "日本語 text", "<|endoftext|>", "a <|endoftext|> b", "<| x", "_under_ 12ab34", "x\x0by\x0cz", "ǀ × ÷", "  lead  and  tail  "]


def test_units_are_what_the_tokenizer_splits(tokenizer):
    encoder = token_files.ByteTokenizer(public_tokenizers.path(token_files.TOKENIZER))
    rng = np.random.default_rng(4)
    pieces = ["a", "Bc", "é", "'s", "'", " ", "  ", "\n", "\t", "1", "22", "-", "_", ".", "ß"]
    texts = WHITE + ["".join(rng.choice(pieces, int(rng.integers(1, 40)))) for _ in range(600)]
    for _ in range(2):  # the second time from what is kept
        ids, starts = encoder.encode([None if t is None else t.encode() for t in texts])
        for i, t in enumerate(texts):
            assert ids[starts[i] : starts[i + 1]].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids, repr(t)


def test_plain_characters_are_split_alike(tokenizer):
    split = tokenizer.pre_tokenizer.pre_tokenize_str
    for c in [*map(chr, range(32, 127)), *map(chr, range(0xC0, 0x250))]:
        for text in (f"a{c}b", f"1{c}2", f"a {c}", f"-{c}-"):
            spans = [text[a:b] for _, (a, b) in split(text)]
            assert token_files._PRETOKEN.findall(text) == spans, text


def test_perfect_hash():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 63, 5000):
        keys = np.unique(rng.integers(-(2**62), 2**62, n)).view(np.uint64)
        perfect = token_files.PerfectHash.of(keys)
        assert sorted(perfect.slots(keys).tolist()) == list(range(len(keys)))
        assert perfect.bits.sum() == len(keys) and len(perfect.bits) <= 64 * 40 + 6 * len(keys)


def token_rows():
    rng = np.random.default_rng(6)
    texts = WHITE + [" ".join(rng.choice(["the", "Thing,", "of", "\n\nand", "éa"], int(rng.integers(1, 60)))) for _ in range(80)]
    texts.append("word " * 9000 + "x" * 5000)
    rows = [(int(i) * 37 - 900, t) for i, t in enumerate(texts)]
    return [*rows, rows[30], rows[30], (rows[5][0], "other text"), (None, "no id"), (None, "none either"), (2**62, "far"), (-(2**62), "low")]


@pytest.fixture(scope="module")
def token_docs(spark):
    return spark.createDataFrame([(*r, "x", 1) for r in token_rows()], "doc_id long, text string, part string, start int").repartition(4)


def test_token_files_come_back(spark, token_docs, tokenizer, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "CHUNK_BYTES", 3000)
    path = str(tmp_path / "ids")
    token_files.write_ids(token_docs, path, block_ids=300)
    got = sorted(token_files.read_ids(spark, path, keep_ids=True).collect(), key=lambda r: r.start)
    ids = {(i, t or ""): [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in token_rows()}
    assert [r.doc_id for r in got] == sorted((i for i, _ in token_rows() if i is not None)) + [None, None]
    at, left = 0, Counter((i, tuple(ids[i, t or ""])) for i, t in token_rows())
    for r in got:
        own = np.frombuffer(r.ids, "<u4")
        assert r.start == at and r.n_tokens == len(own) and r.ids_crc32 == zlib.crc32(own.astype("<u4").tobytes())
        left[r.doc_id, tuple(own.tolist())] -= 1
        at += len(own)
    assert not any(left.values())
    blocks = spark.read.parquet(path)
    assert blocks.count() > 20 and blocks.where("width <> 2").count() == 0
    whole = token_files.encode_documents(token_docs)
    assert sorted((r.start, r.n_tokens) for r in whole.collect()) == sorted((r.start, r.n_tokens) for r in got)


def test_keyed_access(spark, token_docs, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_ids(token_docs, path, block_ids=300)
    by_key = {}
    for r in token_files.read_ids(spark, path, keep_ids=True).collect():
        by_key.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    asked = [None, 5, 2**62, -(2**62), *[i for i, _ in token_rows() if i is not None], *range(-900, -880)]
    got = {}
    for r in token_files.find_documents(spark, path, spark.createDataFrame([(i,) for i in asked], "doc_id long")).collect():
        got.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in by_key.items() if k is not None}


def test_a_damaged_file_is_noticed(spark, token_docs, tmp_path):
    path, other = str(tmp_path / "ids"), str(tmp_path / "other")
    token_files.write_ids(token_docs, path)
    blocks = spark.read.parquet(path)
    blocks.withColumn("prints", F.expr("cast(repeat('x', length(prints)) as binary)")).write.parquet(other)
    with pytest.raises(Exception, match="not in its index"):
        token_files.read_ids(spark, other).count()


def test_no_documents(spark, token_docs, tmp_path):
    assert token_files.encode_documents(token_docs.where("false")).count() == 0
    nothing = token_files.encode_documents(spark.createDataFrame([(3, None)], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in nothing] == [(3, 0, 1, zlib.crc32(bytes(4)))]
