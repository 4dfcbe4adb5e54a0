"""The blocked product against all pairs."""

import random
import re

import pytest

pytest.importorskip("folioforge.llm")
from folioforge.llm import jaccard_join as J  # noqa: E402
from folioforge.llm.components import components  # noqa: E402


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            x, y = sets[i], sets[j]
            if x and y and 100 * min(len(x), len(y)) >= 80 * max(len(x), len(y)) and 100 * len(x & y) >= 80 * len(x | y):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted((str(d), len(sets[i]), str(least.get(root(i)))) for i, (d, _) in enumerate(rows))


def check(spark, docs):
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in J.jaccard_classes(docs).collect())
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    return got


def test_corpus(spark):
    got = check(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert any(a != c for a, _, c in got)


def test_near_copies_ties_and_odd_rows(spark):
    rng = random.Random(5)
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyz") + str(rng.randrange(4))
    base = [word() for _ in range(60)]
    rows = [(None, None), (1, ""), (2, " \n"), (3, "one two"), (4, "One\ttwo"), (4, "one two"), (None, "one two"), (6, "é " * 400), (7, "é " * 9)]
    for i in range(150):  # drifting copies: chains of links, and a passage shared by all
        if i % 15 == 0:
            base = [word() for _ in range(rng.randrange(6, 60))]
        base[rng.randrange(len(base))] = word()
        tail = ["common", "passage", "of", "several", "words", "in", "all"] if i % 2 else []
        rows.append((100 + rng.randrange(1000), " ".join(base + tail)))
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, sig string")
    check(spark, docs)
    check(spark, docs.limit(0))


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, j) for j in range(101, 160)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    got = {r["v"]: r["c"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {v: v for e in edges for v in e}
    for _ in range(100):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    alone = {v for v in label if all(v not in e or e[0] == e[1] for e in edges)}
    assert got == {v: c for v, c in label.items() if v not in alone}


def drifting(rng, count, shared):
    base = [f"w{rng.randrange(999)}" for _ in range(60)]
    rows = []
    for i in range(count):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(60)] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(words + shared)))
    return rows


@pytest.mark.parametrize("hot_rows, tile_rows", [(100_000, 4), (3, 5)])
def test_hot_columns_and_large_groups(spark, hot_rows, tile_rows):
    """Neither how columns are dealt nor the size of tiles changes a row."""
    rng = random.Random(9)
    rows = drifting(rng, 70, []) + [(1000 + i, t) for i, t in drifting(rng, 40, ["a", "shared", "passage", "of", "some", "words"] * 3)]
    rows += [(2000 + i, " ".join(["one", "long", "line", "that", "many", "rows", "hold"] * 3 + [f"x{i}{j}" for j in range(i % 9)])) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in J.jaccard_classes(docs, hot_rows=hot_rows, tile_rows=tile_rows).collect())
    assert got == brute(rows)
    assert len({c for _, _, c in got}) < len(got)


def test_overlaps_and_size_classes():
    rng = random.Random(3)
    sets = [J.np.array(sorted(rng.sample(range(90), rng.randrange(1, 60))), "<u8") for _ in range(30)]
    for left, right in ((sets, sets), (sets[:7], sets[5:]), (sets[:2], sets[4:6])):
        assert (J.overlaps(left, right) == [[len(set(a.tolist()) & set(b.tolist())) for b in right] for a in left]).all()
    bounds = J.size_bounds(80)
    size = lambda n: int(J.np.searchsorted(bounds, n, side="right"))
    assert all(0 <= size(m) - size(n) <= 1 for n in range(1, 700) for m in range(n, 125 * n // 100 + 1) if 100 * n >= 80 * m)
