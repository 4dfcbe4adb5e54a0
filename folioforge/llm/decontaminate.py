"""Benchmark decontamination by winnowing.

The words of every text are hashed; of each run of ``WINDOW`` words the
smallest ``K``-gram hash is its fingerprint, so any shared run of WINDOW words
has the same fingerprint on both sides.  Corpus fingerprints are joined with
the benchmark's, and every hit is extended to the whole window before it
counts.  The benchmark is the small side: its windows go to the executors in
blocks of at most ``BLOCK_WINDOWS`` hashes each, one pass over the corpus per
block; nothing about the corpus is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, read, salted, spread, stored
from .wordhash import ALNUM, ngrams, portions, utf8, word_hashes

WINDOW = 10
K = 5
BLOCK_WINDOWS = 4_000_000  # 64 MB of hashes and item numbers in a worker at once


class Index:
    """Windows of some benchmark items: per length, sorted hashes and who holds them."""

    def __init__(self, items: list[tuple[str, np.ndarray]]):
        """items: (name, word hashes), none empty."""
        self.names = [name for name, _ in items]
        by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
        prints = []
        for i, (_, words) in enumerate(items):
            n = min(WINDOW, len(words))
            by_length.setdefault(n, []).append((ngrams(words, n), i))
            if n == WINDOW:
                prints.append(fingerprints(words))
        self.lengths = {}
        for n, parts in by_length.items():
            hashes = np.concatenate([h for h, _ in parts])
            owner = np.concatenate([np.full(len(h), i, np.int32) for h, i in parts])
            order = np.argsort(hashes, kind="stable")
            self.lengths[n] = (hashes[order], owner[order])
        self.prints = np.unique(np.concatenate(prints)) if prints else np.zeros(0, np.uint64)
        self.mask = Members(self.prints)
        self.short = {n: Members(np.unique(h)) for n, (h, _) in self.lengths.items() if n < WINDOW}


class Members:
    """Which of many hashes are in a sorted set: a bit table first, a search for the rest."""

    def __init__(self, values: np.ndarray):
        self.values = values
        bits = max(16, int(np.ceil(np.log2(max(1, len(values))))) + 6)
        self.shift = np.uint64(64 - min(bits, 26))
        self.table = np.zeros(1 << (64 - int(self.shift)), bool)
        self.table[values >> self.shift] = True

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Positions in hashes of the members."""
        at = np.flatnonzero(self.table[hashes >> self.shift])
        if len(at) and len(self.values):
            place = np.minimum(np.searchsorted(self.values, hashes[at]), len(self.values) - 1)
            return at[self.values[place] == hashes[at]]
        return at[:0]


def fingerprints(words: np.ndarray) -> np.ndarray:
    """The smallest K-gram hash of every window of WINDOW words."""
    grams = ngrams(words, K)
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    span = WINDOW - K + 1
    low = np.minimum(grams[:-1], grams[1:])  # of 2 grams
    width = 2
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = span - width
    return np.minimum(low[: len(low) - rest], low[rest:])[:n] if rest else low[:n]


def find_windows(words: np.ndarray, first: np.ndarray, index: Index) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, start word, place of the first and one past the last owner) of every hit inside one row."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for n, (hashes, _) in index.lengths.items():
        if len(words) < n:
            continue
        if n == WINDOW:
            starts = index.mask.find(fingerprints(words))
        else:
            starts = index.short[n].find(ngrams(words, n))
        starts = starts[row[starts] == row[starts + n - 1]]
        if not len(starts):
            continue
        if n == WINDOW:  # extend the hit to the whole window
            whole = np.fromiter((ngrams(words[s : s + n], n)[0] for s in starts), np.uint64, len(starts)) if len(starts) < 64 else ngrams(words, n)[starts]
        else:
            whole = ngrams(words, n)[starts]
        low, high = np.searchsorted(hashes, whole, "left"), np.searchsorted(hashes, whole, "right")
        fits = high > low
        yield n, starts[fits], low[fits], high[fits]


def scan_batch(column: pa.Array, index: Index) -> tuple[list[int], list[list[int]], list[list[str]]]:
    """Per row: words, covered stretches as start, end, start, end ... in words, names of the items found."""
    raw, offsets = utf8(column)
    counts, covered, found = [], [], []
    for a, z in portions(offsets):
        words, first = word_hashes(raw[offsets[a] : offsets[z]], offsets[a : z + 1] - offsets[a], ALNUM)
        change = np.zeros(len(words) + 1, np.int32)
        names: dict[int, set[str]] = {}
        for n, starts, low, high in find_windows(words, first, index):
            np.add.at(change, starts, 1)
            np.add.at(change, starts + n, -1)
            owner = index.lengths[n][1]
            rows = np.searchsorted(first, starts, "right") - 1
            for r, lo, hi in zip(rows.tolist(), low.tolist(), high.tolist(), strict=True):
                names.setdefault(r, set()).update(index.names[i] for i in owner[lo:hi].tolist())
        counts += np.diff(first).tolist()
        covered += [[] for _ in range(z - a)]
        found += [[] for _ in range(z - a)]
        inside = np.concatenate([[False], np.cumsum(change[:-1]) > 0, [False]])
        for r in names:
            lo, hi = int(first[r]), int(first[r + 1])
            mine = np.concatenate([[False], inside[lo + 1 : hi + 1], [False]])
            covered[len(covered) - (z - a) + r] = np.flatnonzero(mine[1:] != mine[:-1]).tolist()
            found[len(found) - (z - a) + r] = sorted(names[r])
    return counts, covered, found


RESULT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.LongType())), T.StructField("items", T.ArrayType(T.StringType()))])


def _pieces(words: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """Words in stretches of at most ``limit`` windows that together hold every window once."""
    for at in range(0, max(1, len(words) - WINDOW + 1), limit):
        yield words[at : at + limit + WINDOW - 1]


def item_blocks(benchmark: DataFrame, limit: int = BLOCK_WINDOWS) -> Iterator[Index]:
    """The benchmark's windows in blocks of fewer than 2 * ``limit``, built one at a time; items without words or id are left out, long ones go in pieces."""
    items, size, none = [], 0, True
    for r in benchmark.select("item_id", "text").filter("item_id is not null and text is not null").toLocalIterator():
        raw, offsets = utf8(pa.array([r["text"]]))
        words, _ = word_hashes(raw, offsets, ALNUM)
        for piece in _pieces(words, limit) if len(words) else ():
            items.append((str(r["item_id"]), piece))
            size += max(1, len(piece) - WINDOW + 1)
            if size >= limit:
                yield Index(items)
                items, size, none = [], 0, False
    if items or none:
        yield Index(items)


def hits_of(spark: SparkSession, block: Index):
    """A column function text -> RESULT."""
    held = spark.sparkContext.broadcast(block)

    @F.arrow_udf(returnType=RESULT)
    def scan(text: pa.Array) -> pa.Array:
        counts, spans, found = scan_batch(text, held.value)
        give_back()
        return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(found, pa.list_(pa.string()))], ["n_words", "spans", "items"])

    return scan


@F.arrow_udf(returnType=T.LongType())
def covered_words(spans: pa.Array) -> pa.Array:
    """Words under start, end, start, end ... stretches that may overlap."""
    out = []
    for flat in spans.to_pylist():
        end = total = 0
        for s, e in sorted(zip(flat[::2], flat[1::2], strict=True)):
            total += max(0, e - max(s, end))
            end = max(end, e)
        out.append(total)
    return pa.array(out, pa.int64())


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (sorted names), contaminated.

    A null text has no words.  Items without words, and null item ids, cannot
    occur; rows repeating an item id are one item.  Null and repeated doc ids
    are kept row by row, other columns of docs are ignored.  A benchmark of
    more than ``limit`` windows takes one pass over docs per block; only rows
    with hits are then put together, by id and text digest.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    blocks = item_blocks(benchmark, limit)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        out = rows.select("doc_id", hits_of(docs.sparkSession, first)("text").alias("r")).select("doc_id", "r.*")
        out = out.withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: x - n))  # ends less starts
    else:
        key = F.struct("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text")).alias("key")
        passes = [stored(rows.select(key, hits_of(docs.sparkSession, b)("text").alias("r")).select("key", "r.*"), "decontaminate") for b in chain([first, second], blocks)]
        some = reduce(DataFrame.unionByName, [p.filter(F.size("items") > 0).dropDuplicates(["key"]) for p in passes])
        some = some.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        some = spread(some.withColumn("n_hit", covered_words("spans")))
        out = salted(passes[0].select("key", "n_words"), F.monotonically_increasing_id()).join(some, ["key", "_salt"], "left").withColumn("doc_id", F.col("key.doc_id"))
    none = F.array().cast("array<string>")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
