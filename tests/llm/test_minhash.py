"""Sketches, buckets and the near-duplicate join against all pairs."""

import random
import re

import numpy as np
import pytest

pytest.importorskip("folioforge.llm")
from folioforge.llm import minhash_dedup as M  # noqa: E402
from folioforge.llm.wordhash import mix  # noqa: E402


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return set(zip(w, w[1:])) if len(w) >= 2 else ({tuple(w)} if w else set())


def brute(rows):
    sets, label = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                label[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted((str(d), len(sets[i]), str(least.get(root(i))), d == least.get(root(i))) for i, (d, _) in enumerate(rows))


def check(docs, rows, **kw):
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in M.near_duplicates(docs, **kw).collect())
    assert got == brute(rows)
    return got


def test_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = check(docs, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert not all(kept for *_, kept in got)


def test_odd_rows_and_chains(spark):
    rng = random.Random(4)
    rows = [(None, None), (1, ""), (2, " \n"), (3, "one"), (4, "ONE"), (4, "one"), (None, "one"), (5, "é " * 30_000), (6, "é é"), (7, "İ ı"), (8, "a b"), (9, "b a")]
    base = []
    for i in range(160):
        if i % 20 == 0:
            base = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(2, 80))]
        base[rng.randrange(len(base))] = f"v{rng.randrange(300)}"
        rows.append((100 + rng.randrange(900), " ".join(base)))
    docs = spark.createDataFrame([(i, t, 0, "k") for i, t in rows], "doc_id long, text string, key int, sig string")
    check(docs, rows)
    assert M.near_duplicates(docs.limit(0)).count() == 0


def test_large_group_in_tiles(spark):
    rng = random.Random(6)
    base = [f"w{i}" for i in range(70)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.randrange(5)):
            words[rng.randrange(70)] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows, tile_rows=6)


@pytest.mark.parametrize("size", [1, 2, 7, 60, 5000])
def test_every_bin_fills_and_equal_bins_follow_similarity(size):
    rng = np.random.default_rng(size)
    some = mix(np.arange(size * 2, dtype=np.uint64) + np.uint64(rng.integers(1 << 40)))
    a, b = np.sort(some[: size + size // 2]), np.sort(some[size // 2 :])
    x, y = M.sketch(a), M.sketch(b)
    assert (x != np.iinfo(np.uint64).max).all() and (y != np.iinfo(np.uint64).max).all()
    truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((x == y).mean() - truth) < 0.15
    assert (M.sketch(a[::-1]) == x).all()


def test_sketch_is_the_smallest_value_of_all_rounds():
    grams = mix(np.arange(3, dtype=np.uint64))
    bins = 12
    out = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    for i in range(2 * bins):
        at, value = M._thrown(grams, np.array([i]), bins)
        for j, v in zip(at[0], value[0]):
            k = j if i < bins else i - bins
            out[k] = min(out[k], v)
    assert (M.sketch(grams, bins) == out).all()
