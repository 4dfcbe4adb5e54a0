"""Near duplicates by fast similarity sketches, banding and exact verification.

A sketch has ``COORDINATES`` bins.  In the first as many rounds, every n-gram of
a set is hashed into a bin with a value that grows with the round; in the
second as many, round by round, all n-grams go to one given bin.  A bin keeps
its smallest value, so once no bin is empty later rounds cannot change anything
and the sketch is finished: after the last round every bin is filled, for a
small set too, and the share of equal bins concentrates around the Jaccard
similarity as with independent hashes.

``BANDS`` bands of ``ROWS`` bins name the buckets a set is in.  Only buckets of
two sets or more go on; within one, sets of a size class and the next form a
group named by its smallest set, and every pair of a group is compared on the
full sets, in tiles.  A pair at the threshold of 0.8 shares no bucket with a chance of
(1 - 0.8**5)**48 = 5e-9, one at 0.9 with 1e-19; nothing else is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import filter_bits, lean, member_filter, probe, read, stored
from .jaccard_join import _rows_of, _Seen, _signature, grouped, hub_members, resolved, size_bounds
from .wordhash import mix

NGRAM = 2
PERCENT = 80
BANDS, ROWS = 48, 5
COORDINATES = BANDS * ROWS
BLOCK_ENTRIES = 500_000
VALUE = np.uint64((1 << 48) - 1)
SKETCH = "doc_id long, n long, sig long, size long, keys array<long>"
BUCKET = np.dtype([("key", "<u8"), ("tag", "<u4")])


def _thrown(grams: np.ndarray, rounds: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, value) of every n-gram in every round."""
    h = mix(grams[None, :] ^ mix(rounds.astype(np.uint64) + np.uint64(0x2545F4914F6CDD1D))[:, None])
    at = ((h >> np.uint64(48)) * np.uint64(bins)) >> np.uint64(16)
    return at.astype(np.int64), (rounds.astype(np.uint64)[:, None] << np.uint64(48)) | (h & VALUE)


def sketch(grams: np.ndarray, bins: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketch of a nonempty set of 64-bit hashes."""
    out, start = np.full(bins, np.iinfo(np.uint64).max, np.uint64), 0
    step = math.ceil(bins * (math.log(bins) + 1) / len(grams))  # fills all bins more often than not
    empty = np.arange(bins)
    while start < bins and len(empty):
        rounds = np.arange(start, min(bins, start + step))
        at, value = _thrown(grams, rounds, bins)
        np.minimum.at(out, at.ravel(), value.ravel())
        start, step, empty = rounds[-1] + 1, math.ceil(step / 4), np.flatnonzero(out == np.iinfo(np.uint64).max)
    if len(empty):  # the second rounds: everything into the bin of the round
        for some in np.array_split(empty, max(1, len(empty) * len(grams) >> 20)):
            out[some] = _thrown(grams, some + bins, bins)[1].min(1)
    return out


def band_keys(values: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = values.reshape(bands, -1)
    key = mix(np.arange(bands, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D))
    for c in range(rows.shape[1]):
        key = mix(key * np.uint64(0xC6A4A7935BD1E995) + rows[:, c])
    return key


def _sketches(n: int, percent: int, bands: int, rows: int):
    """Per row of (id, text): id, set size, signature, size class, and its buckets where this task meets the set first."""

    def run(batches):
        seen, bounds = _Seen(), size_bounds(percent)

        def out(held):
            ids, sizes, sigs, classes, keys = zip(*held, strict=True)
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip((ids, sizes, sigs, classes, keys), kinds, strict=True)], ["doc_id", "n", "sig", "size", "keys"])

        held = []
        for i, grams in _rows_of(batches, n):
            sig = _signature(grams) if len(grams) else None
            keys = band_keys(sketch(grams, bands * rows), bands).view(np.int64) if sig is not None and seen.first(sig) else None
            held.append((i, len(grams), sig, int(np.searchsorted(bounds, len(grams), side="right")), keys))
            if len(held) >= 5_000:
                yield out(held)
                held = []
        if held:
            yield out(held)

    return run


def _at_most_two(entries: np.ndarray) -> np.ndarray:
    """Of every key the entries with the smallest and the largest tag."""
    entries = entries[np.lexsort((entries["tag"], entries["key"]))]
    new = np.r_[True, entries["key"][1:] != entries["key"][:-1]] if len(entries) else np.zeros(0, bool)
    last = np.r_[new[1:], True] if len(entries) else new
    return entries[new | last]


def _bucketed(blocks: int):
    """Buckets of the sets as packets of (key, tag of the set), by blocks of keys."""

    def run(batches):
        held, size = [], 0

        def flush():
            entries = _at_most_two(np.concatenate(held))
            order = np.argsort(entries["key"] & np.uint64(blocks - 1), kind="stable")
            entries = entries[order]
            block = (entries["key"] & np.uint64(blocks - 1)).astype(np.int64)
            cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True])
            return pa.RecordBatch.from_arrays([pa.array(block[cuts[:-1]]), pa.array([entries[a:z].tobytes() for a, z in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())], ["block", "entries"])

        for batch in batches:
            keys = batch.column(1)
            entries = np.empty(len(keys.flatten()), BUCKET)
            entries["key"] = keys.flatten().to_numpy().view(np.uint64)
            entries["tag"] = np.repeat((batch.column(0).to_numpy().view(np.uint64) & np.uint64(0xFFFFFFFF)).astype(np.uint32), keys.value_lengths().to_numpy())
            held.append(entries)
            size += len(entries)
            if size >= 2_000_000:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return run


def _shared(block: pa.Table) -> pa.Table:
    """Keys of one block that two sets have."""
    entries = _at_most_two(np.concatenate([np.frombuffer(x, BUCKET) for x in block.column("entries").to_pylist()]))
    twice = entries["key"][1:][(entries["key"][1:] == entries["key"][:-1]) & (entries["tag"][1:] != entries["tag"][:-1])]
    return pa.table({"key": np.unique(twice).view(np.int64)})


def near_duplicates(docs: DataFrame, n: int = NGRAM, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text", tile_rows: int = 512, tile_grams: int = 2_000_000) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Candidates are documents that share a bucket; links are those of them with
    100 |x & y| >= percent |x | y|, counted on the whole sets of word n-grams.
    component_id is the smallest doc_id reachable by links, kept whether it is
    the row's own.  A text without words, or null, has no n-grams, is linked
    with nothing and kept.  Equal sets are one row of the join.  Rows repeating
    an id are linked like any others and share the id, so either all or none of
    them is kept.  Null ids come last: a component of null ids only has a null
    id, and its rows are kept.  An empty table gives no rows; other columns of
    docs are ignored, whatever their names.

    tile_rows, tile_grams: what one side of a tile holds, about.  They change
    no result; bands and rows change only the chance of missing a link.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sketches = stored(docs.mapInArrow(lean(_sketches(n, percent, bands, rows)), SKETCH), "sketches")
    own = sketches.select("doc_id", "n", "sig")
    classes = stored(own.filter("sig is not null").groupBy("sig").agg(F.min("n").alias("n"), F.min("doc_id").alias("rep")), "classes")
    blocks = 1 << max(4, math.ceil(math.log2(max(1, bands * classes.count() / BLOCK_ENTRIES))))
    keyed = sketches.filter("keys is not null").select(F.col("sig").alias("x"), "n", "size", "keys")
    packets = keyed.select("x", "keys").mapInArrow(lean(_bucketed(blocks)), "block long, entries binary")
    shared = stored(packets.groupBy("block").applyInArrow(_shared, "key long"), "buckets")
    bits = filter_bits(shared)
    met = probe(keyed.select("x", "n", "size", F.explode("keys").alias("key")), "key", member_filter(shared, "key", bits), "_in", bits)
    met = stored(met.filter("_in").select("key", "size", "x", "n", F.lit(True).alias("early")), "bucketed")
    members = grouped(stored(hub_members(met), "members"), tile_rows, tile_grams)
    mass = classes.select(F.col("sig").alias("x"), F.col("n").cast("double").alias("mass"))
    out = resolved(docs, own, classes, members, mass, n, percent, tile_rows)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
