"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, stored

CHUNK = 1_000_000  # edges a task merges at once


def least_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertices, the smallest vertex each is connected to), without those that are their own."""
    names, ends = np.unique(np.r_[a, b], return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for x in (a, b, label[a], label[b]):
            np.minimum.at(new, x, low)
        new = new[new]
        if (new == label).all():
            moved = label != np.arange(len(names))
            return names[moved], names[label[moved]]
        label = new


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (v, c) as stars around the smallest vertices, by chunks of a partition."""
    held, size = [], 0

    def flush():
        v, c = least_labels(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
        return pa.RecordBatch.from_arrays([pa.array(v), pa.array(c)], ["v", "c"])

    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        size += len(batch)
        if size >= CHUNK:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def components(edges: DataFrame) -> DataFrame:
    """(v, c): every vertex of edges (a, b) with the smallest vertex it is connected to; vertices with no edge to another may be missing.

    Every task replaces its edges by stars around their smallest vertices, so a
    vertex of any degree leaves it once; edges of one vertex then meet, and
    labels jump to their label's label, until nothing changes.
    """
    stars = edges.select("a", "b").mapInArrow(lean(_stars), "v long, c long")
    while True:
        stars = stored(stars.repartition("v").mapInArrow(lean(_stars), "v long, c long").distinct(), "stars")
        onward = stars.select(F.col("v").alias("c"), F.col("c").alias("further"))
        stars = stored(stars.join(onward, "c", "left").select("v", F.coalesce("further", "c").alias("c"), F.col("further").isNotNull().alias("moved")), "labels")
        several = stars.groupBy("v").agg((F.min("c") < F.max("c")).alias("several"), F.max("moved").alias("moved")).filter("several or moved")
        open_ = several.limit(1).count()
        stars = stars.select("v", "c")
        if not open_:
            stars = stars.distinct()
            return stored(stars.union(stars.select("c", "c").distinct()), "components")
