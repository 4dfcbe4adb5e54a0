"""kd-tree filtering against plain rounds in Python's integers."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

pytest.importorskip("folioforge.llm")
from folioforge.llm import kdtree_clusters as K  # noqa: E402


def brute(rows, clusters, rounds, dimensions):
    kept = [(i, [math.floor(256 * x) if math.isfinite(256 * x) else 256 * int(x) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:clusters]
    centroids = [list(v) for _, v in start]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids)) for _, v in kept] if centroids else []

    for _ in range(rounds):
        got = assign()
        for k in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, got) if c == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own)]
    got = assign()
    long = lambda x: x if x is not None and x < 1 << 63 else None
    add = lambda xs: None if any(x is None for x in xs) else sum(xs)
    far = [long(d) for d, _ in got]
    own = [add([f for f, (_, c) in zip(far, got) if c == k]) for k in range(len(centroids))]
    all_ = add([o for k, o in enumerate(own) if any(c == k for _, c in got)]) if got else None
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((str(i), k, str(f), str(long(own[k])), str(long(all_)), digest[k]) for (i, _), (_, k), f in zip(kept, got, far))


def check(spark, rows, clusters=5, rounds=3, dimensions=4, **kw):
    df = spark.createDataFrame([(i, v, "x", 7) for i, v in rows], "vec_id long, embedding array<double>, cluster string, v int")
    got = K.clustered(df, clusters, rounds, dimensions, **kw).collect()
    got = sorted((str(r["vec_id"]), r["cluster"], str(r["distance"]), str(r["cluster_inertia"]), str(r["inertia"]), r["centroid_sha256"]) for r in got)
    assert got == brute(rows, clusters, rounds, dimensions)
    return got


def test_odd_rows_ties_and_copies(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)]) for i in range(60)] + [(100 + i, [0.25] * 4) for i in range(40)]
    rows += [(7, [0.5, 0.5, 0.5, 0.5]), (None, [1.0, 2.0, 3.0, 4.0]), (200, None), (201, []), (202, [1.0, 2.0, 3.0]), (203, [1.0, 2.0, 3.0, None]), (204, [math.nan, 0.0, 0.0, 0.0]), (205, [math.inf, 0.0, 0.0, 0.0])]
    check(spark, rows, tree_rows=16)
    check(spark, rows[:3])
    check(spark, rows[100:102] + rows[102:], clusters=2)
    check(spark, [])
    check(spark, [(None, [1.0, 2.0, 3.0, 4.0])])


def test_large_components_stay_exact(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(30)]
    check(spark, rows + [(50, [1e6, -3e5, 0.1, 0.2]), (51, [2e7, 1.0, 2.0, 3.0])])
    check(spark, rows + [(50, [1e300, 0.0, 0.0, -1e20]), (51, [1.7e308, 1.0, 2.0, 3.0])])


def test_filter_never_drops_a_nearest_centroid():
    rng = np.random.default_rng(3)
    for spread in (2, 40, 3000):
        points = rng.integers(-spread, spread, (900, 3)) + rng.integers(-4, 4, (900, 1)) * spread
        tree, order = K.Tree.build(points, leaf_rows=8)
        assert (tree.points == points[order]).all() and (tree.sums[0] == points.sum(0)).all()
        centroids = points[rng.integers(0, 900, 25)]
        got = np.full(900, -1)
        whole = lambda i, k: got.__setitem__(slice(*tree.spans[i, :2]), k)
        tree.assign(centroids, whole, lambda a, z, k: got.__setitem__(slice(a, z), k))
        far = ((tree.points[:, None] - centroids[None]) ** 2).sum(2)
        assert (got == far.argmin(1)).all()


def test_nodes_are_assigned_whole():
    """On separated clouds most vectors are never looked at one by one."""
    rng = np.random.default_rng(4)
    centres = np.array([[0, 0, 0], [10_000, 0, 0], [0, 10_000, 0]])
    tree, _ = K.Tree.build(np.concatenate([c + rng.integers(-50, 50, (400, 3)) for c in centres]), leaf_rows=10)
    single = []
    tree.assign(centres, lambda i, k: None, lambda a, z, k: single.append(z - a))
    assert sum(single) < 60


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.001/embeddings.parquet'")
    got = K.op12_clusters(spark, "/root/testdata/sf0.001").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(f"SELECT vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 FROM ({K.SQL})").fetchall())
