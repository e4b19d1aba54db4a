"""Near copies of the pipeline: every pair of the similarity counts."""

import random

import numpy as np

from kinlake.llm import simhash


def _pair(seed):
    """Two texts of 90 shingles each that differ in two words: similarity 0.8."""
    r = random.Random(seed)
    one = [f"w{r.randrange(10**6)}" for _ in range(94)]
    other = list(one)
    for k in (20, 50):
        other[k] = f"changed{seed}"
    return " ".join(one), " ".join(other)


def _kept(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {r.doc_id for r in simhash.drop_near_copies(df).collect()}


def _wanted(texts):
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) for w in (t.split() for t in texts)]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return {i for i in range(len(texts)) if top(i) == i}


def test_pairs_that_share_no_band_of_minima_are_found(spark):
    texts = [t for seed in (375, 2071, 4969) for t in _pair(seed)]
    assert _kept(spark, texts) == {0, 2, 4} == _wanted(texts)


def test_a_bucket_of_many_groups_is_compared_in_full(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(150)]
    texts = []
    for g in range(40):  # within a pair the texts are near copies, across pairs nearly so
        own = list(base)
        for k in rng.choice(150, 4, replace=False):
            own[k] = f"g{g}"
        other = list(own)
        other[int(rng.integers(150))] = f"h{g}"
        texts += [" ".join(own), " ".join(other)]
    want = _wanted(texts)
    assert 20 < len(want) < 60
    assert _kept(spark, texts) == want
    monkeypatch.setattr(simhash, "FEW", 3)
    monkeypatch.setattr(simhash, "LOOKED_AT", 1)
    monkeypatch.setattr(simhash, "SHARE", 8)
    assert _kept(spark, texts) == want


def test_parity_maps_and_sizes_rule_out_no_similar_pair(spark):
    texts = [t for seed in range(40) for t in _pair(seed)]
    df = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    rows = df.mapInArrow(simhash._firsts(np.array([], np.uint64)), "row long, size int, bits array<long>, keys array<long>")
    x, y = (rows.selectExpr(f"row as {c}_row", f"struct(size, bits) as {c}", f"keys as {c}_keys") for c in "xy")
    met = x.join(y, x["x_row"] + 1 == y["y_row"]).where("x_row % 2 = 0")
    assert met.where(simhash._may_be_similar("x", "y")).where("arrays_overlap(x_keys, y_keys)").count() == 40
