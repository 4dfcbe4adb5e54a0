"""Centroid clustering of integer vectors by kd-tree filtering.

Every partition turns its vectors into kd-trees of at most ``TREE_ROWS``
vectors, stored once in the shared folder: a node holds its vectors' count, their
integer sum and their bounding box.  A round walks each tree with the centroids
that may still be nearest to some point of the node's box.  A centroid is
dropped only if another one is strictly nearer to every point of the box, so
ties stay; a node with one centroid left, or with one distinct vector, is
assigned whole from its count and sum; leaves are resolved vector by vector.
Partitions send sums per centroid, and the driver sees one row per centroid.

Arithmetic is on integers throughout.  Vectors whose components reach ``NEAR``
are kept aside from the trees and handled with Python's integers, so that sums
and distances stay exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, read, stored

DIMENSIONS = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
SEED = 2
TREE_ROWS = 16_384
LEAF_ROWS = 128
NEAR = 1 << 25  # components below it: squared distances fit in 64 bits
FLOAT_SAFE = 1 << 22  # components below it: products of vectors are exact in floats
FAN_IN = 64

TREES = "ids binary, nulls binary, kind string, points binary, spans binary, low binary, high binary, sums binary"
PARTIAL = "part long, cluster int, n long, sums array<string>"
ASSIGNED = "vec_id long, cluster int, distance long"


def whole(x: float, scale: int = SCALE) -> int:
    """floor(scale * x), also where the product leaves the doubles."""
    y = scale * x
    return math.floor(y) if math.isfinite(y) else scale * int(x)


def kept_vectors(vectors: DataFrame, dimensions: int, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and v (doubles) of the rows with exactly ``dimensions`` components, all finite."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(math.inf)), F.lit(False)))
    return rows.filter((F.size("v") == dimensions) & finite)


class Tree:
    """A kd-tree over integer vectors: rows of the node i are points[spans[i, 0] : spans[i, 1]], its children spans[i, 2:]."""

    def __init__(self, points, spans, low, high, sums):
        self.points, self.spans, self.low, self.high, self.sums = points, spans, low, high, sums

    @classmethod
    def build(cls, points: np.ndarray, leaf_rows: int = LEAF_ROWS) -> tuple[Tree, np.ndarray]:
        """(the tree, the order its rows were put in)."""
        order, spans, low, high = np.arange(len(points)), [[0, len(points), 0, 0]], [], []
        at = 0
        while at < len(spans):
            a, z = spans[at][:2]
            own = points[order[a:z]]
            lo, hi = own.min(0), own.max(0)
            low.append(lo), high.append(hi)
            axis = int(np.argmax(hi - lo))
            if z - a > leaf_rows and hi[axis] > lo[axis]:
                middle = (z - a) // 2
                order[a:z] = order[a:z][np.argpartition(own[:, axis], middle)]
                spans[at][2:] = [len(spans), len(spans) + 1]
                spans += [[a, a + middle, 0, 0], [a + middle, z, 0, 0]]
            at += 1
        points = points[order]
        spans = np.array(spans, np.int64)
        sums = np.zeros((len(spans), points.shape[1]), np.int64)
        for i in range(len(spans) - 1, -1, -1):  # children stand after their node
            a, z, left, right = spans[i]
            sums[i] = sums[left] + sums[right] if left else points[a:z].sum(0)
        return cls(points, spans, np.array(low), np.array(high), sums), order

    def assign(self, centroids: np.ndarray, whole_node: Callable, each: Callable) -> None:
        """Calls whole_node(i, cluster) for nodes that go to one centroid, each(a, z, clusters) for rows resolved one by one."""
        stack = [(0, np.arange(len(centroids)))]
        while stack:
            i, active = stack.pop()
            a, z, left, right = self.spans[i]
            low, high = self.low[i], self.high[i]
            if len(active) > 1 and not (low == high).all():
                active = undominated(centroids, active, low, high)
            if len(active) == 1:
                whole_node(i, int(active[0]))
            elif (low == high).all():
                whole_node(i, int(active[nearest(low[None, :], centroids[active])[0][0]]))
            elif left:
                stack += [(left, active), (right, active)]
            else:
                each(a, z, active[nearest(self.points[a:z], centroids[active])[0]])


def undominated(centroids: np.ndarray, active: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The active centroids to which the one nearest to the box's middle is not strictly nearer everywhere in the box.

    The difference of two squared distances is linear over the box, so it is
    enough to look at the corner that lies farthest towards the other centroid.
    """
    own = centroids[active]
    best = own[int(np.argmin(((2 * own - (low + high)) ** 2).sum(1)))]
    corner = np.where(own > best, high, low)
    return active[((own - corner) ** 2).sum(1) <= ((best - corner) ** 2).sum(1)]


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per point (position of the nearest centroid, squared distance); of equally near ones the first."""
    if points.dtype == object or centroids.dtype == object:
        pairs = [min((sum((int(x) - int(y)) ** 2 for x, y in zip(p, c, strict=True)), k) for k, c in enumerate(centroids)) for p in points]
        return np.array([k for _, k in pairs], np.int64), np.array([d for d, _ in pairs], object)
    if max(np.abs(points).max(initial=0), np.abs(centroids).max(initial=0)) < FLOAT_SAFE:
        p, c = points.astype(np.float64), centroids.astype(np.float64)
        far = (c * c).sum(1)[None, :] - 2 * (p @ c.T)
        at = far.argmin(1)
        return at, (far[np.arange(len(p)), at] + (p * p).sum(1)).astype(np.int64)
    far = np.stack([((points - c) ** 2).sum(1) for c in centroids], 1)
    at = far.argmin(1)
    return at, far[np.arange(len(points)), at]


def _narrow(points: np.ndarray) -> np.ndarray:
    most = np.abs(points).max(initial=0)
    return points.astype(np.int16 if most < 1 << 15 else np.int32)


def _trees(dimensions: int, scale: int, tree_rows: int):
    """Vectors as trees; those with large components as rows of kind 'far', decimal numbers joined by commas."""

    def packed(ids: list[int | None], points: np.ndarray):
        tree, order = Tree.build(points)
        ids = np.array([0 if ids[i] is None else ids[i] for i in order], np.int64), np.array([ids[i] is None for i in order], bool)
        narrow, boxes = _narrow(tree.points), (tree.low.astype(np.int32), tree.high.astype(np.int32))
        row = [ids[0].tobytes(), ids[1].tobytes(), str(narrow.dtype), narrow.tobytes(), tree.spans.astype(np.int32).tobytes(), *(b.tobytes() for b in boxes), tree.sums.tobytes()]
        return batch([row])

    def batch(rows):
        kinds = [pa.binary(), pa.binary(), pa.string(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["ids", "nulls", "kind", "points", "spans", "low", "high", "sums"])

    def run(batches):
        ids, held = [], []
        for b in batches:
            values = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
            with np.errstate(over="ignore"):
                points = np.floor(scale * values)
            far = ~(np.abs(points) < NEAR).all(1)
            names = b.column(0).to_pylist()
            if far.any():
                rows = [[np.array([names[i] or 0], np.int64).tobytes(), np.array([names[i] is None]).tobytes(), "far", ",".join(str(whole(float(x), scale)) for x in values[i]).encode(), *[None] * 4] for i in np.flatnonzero(far)]
                yield batch(rows)
            ids += [names[i] for i in np.flatnonzero(~far)]
            held.append(points[~far].astype(np.int32))
            while len(ids) >= tree_rows:
                points = np.concatenate(held)
                yield packed(ids[:tree_rows], points[:tree_rows].astype(np.int64))
                ids, held = ids[tree_rows:], [points[tree_rows:]]
        if ids:
            yield packed(ids, np.concatenate(held).astype(np.int64))

    return run


def _loaded(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[tuple[list[int | None], Tree | np.ndarray]]:
    """(ids, tree) of every row, or (ids, its one vector of Python's integers)."""
    for batch in batches:
        for row in range(len(batch)):
            ids, nulls, kind, points, *rest = (c[row].as_py() for c in batch.columns)
            ids = [None if gone else int(i) for i, gone in zip(np.frombuffer(ids, np.int64), np.frombuffer(nulls, bool), strict=True)]
            if kind == "far":
                yield ids, np.array([[int(x) for x in points.decode().split(",")]], object)
            else:
                shaped = [np.frombuffer(x, t).astype(np.int64).reshape(-1, w) for x, t, w in zip((points, *rest), (kind, "i4", "i4", "i4", "i8"), (dimensions, 4, *[dimensions] * 3), strict=True)]
                yield ids, Tree(*shaped)


def _as_array(centroids: list[list[int]]) -> np.ndarray:
    near = all(abs(x) < NEAR for c in centroids for x in c)
    return np.array(centroids, np.int64 if near else object)


def _sums(centroids: list[list[int]], dimensions: int):
    """Per task and centroid: how many vectors, and their sum."""

    def run(batches):
        table, count = _as_array(centroids), [0] * len(centroids)
        total = np.zeros((len(centroids), dimensions), object)
        for _, tree in _loaded(batches, dimensions):
            if isinstance(tree, np.ndarray) or table.dtype == object:
                points = tree if isinstance(tree, np.ndarray) else tree.points
                for p, k in zip(points, nearest(points, table)[0], strict=True):
                    count[k] += 1
                    total[k] += np.array([int(x) for x in p], object)
                continue
            some, n = np.zeros((len(centroids), dimensions), np.int64), np.zeros(len(centroids), np.int64)

            def node(i, k, tree=tree, some=some, n=n):
                some[k] += tree.sums[i]
                n[k] += tree.spans[i, 1] - tree.spans[i, 0]

            def each(a, z, k, tree=tree, some=some, n=n):
                np.add.at(some, k, tree.points[a:z])
                np.add.at(n, k, 1)

            tree.assign(table, node, each)
            for k in np.flatnonzero(n):
                count[k] += int(n[k])
                total[k] += some[k].astype(object)
        part, held = TaskContext.get().partitionId() % FAN_IN, [k for k in range(len(centroids)) if count[k]]
        yield pa.RecordBatch.from_arrays([pa.array([part] * len(held), pa.int64()), pa.array(held, pa.int32()), pa.array([count[k] for k in held], pa.int64()), pa.array([[str(x) for x in total[k]] for k in held], pa.list_(pa.string()))], ["part", "cluster", "n", "sums"])

    return run


def _added(rows: pa.Table) -> pa.Table:
    columns = zip(*rows.column("sums").to_pylist(), strict=True)
    sums = [str(sum(map(int, c))) for c in columns]
    return pa.Table.from_arrays([rows.column("part")[:1], rows.column("cluster")[:1], pa.array([sum(rows.column("n").to_pylist())], pa.int64()), pa.array([sums], pa.list_(pa.string()))], ["part", "cluster", "n", "sums"])


def _labels(centroids: list[list[int]], dimensions: int):
    """Every vector's centroid and squared distance; one that does not fit in a long is null."""

    def run(batches):
        table = _as_array(centroids)
        for ids, tree in _loaded(batches, dimensions):
            if isinstance(tree, np.ndarray) or table.dtype == object:
                cluster, far = nearest(tree if isinstance(tree, np.ndarray) else tree.points, table)
            else:
                cluster, far = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)

                def put(a, z, k, tree=tree, cluster=cluster):
                    cluster[a:z] = k

                tree.assign(table, lambda i, k, put=put, tree=tree: put(*tree.spans[i, :2], k), put)
                far = ((tree.points - table[cluster]) ** 2).sum(1)
            distance = [int(d) if d < 1 << 63 else None for d in far]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    return run


def first_centroids(kept: DataFrame, clusters: int, seed: int, scale: int) -> list[list[int]]:
    """The vectors whose ids have the smallest hashes; of repeated ids the smaller vector first, null ids never."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.filter("vec_id is not null").select(name.alias("h"), "v").orderBy("h", "v").limit(clusters).collect()
    return [[whole(x, scale) for x in r["v"]] for r in rows]


def clustered(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED, id_col: str = "vec_id", vector_col: str = "embedding", tree_rows: int = TREE_ROWS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector with ``dimensions`` finite components.

    Null vectors, other lengths and null or non-finite components leave their
    row out.  Repeated ids and vectors are rows of their own; null ids are
    clustered but no centroid starts from them.  With fewer vectors than
    clusters there are as many centroids as vectors with an id; without any,
    the result is empty.  A distance beyond a long is null, and so is an inertia
    that holds it or is itself too large.  Other columns are ignored, whatever their names.
    tree_rows changes no result.
    """
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, dimensions, id_col, vector_col)
    centroids = first_centroids(kept, clusters, seed, scale)
    trees = stored((kept if centroids else kept.limit(0)).mapInArrow(lean(_trees(dimensions, scale, tree_rows)), TREES), "trees")
    for _ in range(rounds if centroids else 0):
        sums = trees.mapInArrow(lean(_sums(centroids, dimensions)), PARTIAL)
        sums = sums.groupBy("cluster", "part").applyInArrow(_added, PARTIAL).groupBy("cluster").applyInArrow(_added, PARTIAL)
        for r in sums.collect():  # a row per centroid
            centroids[r["cluster"]] = [int(x) // r["n"] for x in r["sums"]]
    rows = stored(trees.mapInArrow(lean(_labels(centroids, dimensions)), ASSIGNED), "assigned")
    exact = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)")))
    each = rows.groupBy("cluster").agg(exact.alias("own"))
    all_ = each.agg(F.when(F.count("own") == F.count(F.lit(1)), F.sum("own")).alias("all"))
    digest = [(k, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for k, c in enumerate(centroids)]
    names = spark.createDataFrame(digest, "cluster int, centroid_sha256 string")
    # a row per centroid
    side = F.broadcast(stored(each.crossJoin(all_).join(names, "cluster").select("cluster", F.expr("try_cast(own as bigint)").alias("cluster_inertia"), F.expr("try_cast(`all` as bigint)").alias("inertia"), "centroid_sha256"), "inertia"))
    return rows.join(side, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(read(spark, sf_dir, "embeddings"))


def _sql() -> str:
    steps = []
    for i in range(ROUNDS + 1):
        steps.append(f"""
d{i} AS MATERIALIZED (
  SELECT r, k, d FROM (SELECT x.r, c.k, sum((x.x - c.x) * (x.x - c.x)) AS d FROM x JOIN c{i} c USING (i) GROUP BY x.r, c.k)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)""")
        if i < ROUNDS:
            steps.append(f"""
m{i} AS (SELECT d.k, x.i, sum(x.x)::HUGEINT AS s, count(*) AS n FROM d{i} d JOIN x USING (r) GROUP BY d.k, x.i),
c{i + 1} AS MATERIALIZED (SELECT c.k, c.i, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, c.x) AS x FROM c{i} c LEFT JOIN m{i} m USING (k, i))""")
    return f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = {DIMENSIONS}),
x AS MATERIALIZED (SELECT r, i, floor({SCALE} * embedding[i]::DOUBLE)::HUGEINT AS x FROM e, range(1, {DIMENSIONS + 1}) t(i)),
s AS (SELECT r, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS k FROM e WHERE vec_id IS NOT NULL QUALIFY k < {CLUSTERS}),
c0 AS MATERIALIZED (SELECT s.k, x.i, x.x FROM s JOIN x USING (r)),{",".join(steps)},
h AS (SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS h FROM c{ROUNDS} GROUP BY k)
SELECT e.vec_id, d.k::INTEGER AS cluster, d.d::BIGINT AS distance, (sum(d.d) OVER (PARTITION BY d.k))::BIGINT AS cluster_inertia,
  (sum(d.d) OVER ())::BIGINT AS inertia, h.h AS centroid_sha256
FROM d{ROUNDS} d JOIN e USING (r) JOIN h USING (k)
"""


SQL = _sql()
