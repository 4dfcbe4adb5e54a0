"""Pieces shared by the corpus operators: shared storage, bounded filters, salting."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28  # of a filter: the largest is broadcast as 4 million words of 16 bytes
SALTS = 16


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of a data folder; any path that Spark's readers can open."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir; only where that is unset on one machine, as in tests, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = getattr(spark, "_folioforge_folder", None) or tempfile.mkdtemp(prefix="folioforge-")
        spark._folioforge_folder = folder
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/folioforge/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: lineage ends here, and a lost executor costs no rework before it."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Returns freed memory to the machine: Python workers outlive their tasks, and what they keep counts against their executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library has it
    if trim is not None:
        trim(0)


def lean(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A function for mapInArrow that gives memory back when its task ends."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def filter_bits(keys: DataFrame) -> int:
    """Bits of a filter for the rows of keys, which should be cheap to count: 16 a row, as a power of two.

    Beyond ``MOST_BITS`` / 16 rows (16 million) more and more rows that occur
    once count as possibly repeated; results stay the same, and in the end all
    rows take the shuffled way.
    """
    return min(max(1 << (16 * max(keys.count(), 1) - 1).bit_length(), LEAST_BITS), MOST_BITS)


def _position(key: Column, seed: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(bits))


def _as_words(positions: DataFrame) -> DataFrame:
    """Set bits of column p as 64-bit words: at most bits / 64 rows, however many positions."""
    return positions.groupBy(F.expr("shiftright(p, 6)").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("m"))


def repeated_filter(keys: DataFrame, column: str, bits: int) -> DataFrame:
    """First pass: filter words in which both positions of every key that occurs twice are set.

    Each key has two positions of ``bits``; a position hit twice or more stays
    set.  Counting them shuffles partial counts of positions, never rows.
    """
    both = keys.select(F.explode(F.array(_position(F.col(column), 1, bits), _position(F.col(column), 2, bits))).alias("p"))
    return _as_words(both.groupBy("p").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("p"))


def member_filter(keys: DataFrame, column: str, bits: int) -> DataFrame:
    """Filter words in which both positions of every key are set."""
    both = keys.select(F.explode(F.array(_position(F.col(column), 1, bits), _position(F.col(column), 2, bits))).alias("p"))
    return _as_words(both)


def probe(rows: DataFrame, column: str, words: DataFrame, flag: str, bits: int) -> DataFrame:
    """Second pass: rows with boolean ``flag``, false only if the key is surely not in the filter.

    The filter is broadcast: it has at most bits / 64 rows of 16 bytes (64 MiB
    at ``MOST_BITS``), whatever the input.
    """
    small = F.broadcast(words)
    out = rows
    for seed in (1, 2):
        side = small.select(F.col("w").alias(f"_w{seed}"), F.col("m").alias(f"_m{seed}"))
        out = out.withColumn(f"_p{seed}", _position(F.col(column), seed, bits))
        out = out.join(side, F.expr(f"shiftright(_p{seed}, 6) = _w{seed}"), "left")
    hit = F.expr(" and ".join(f"coalesce(shiftright(_m{s}, cast(_p{s} & 63 as int)) & 1L, 0L) = 1L" for s in (1, 2)))
    return out.withColumn(flag, hit).drop("_p1", "_p2", "_w1", "_w2", "_m1", "_m2")


def salted(rows: DataFrame, by: Column, salts: int = SALTS) -> DataFrame:
    """The big side of a join whose key may be hot: column _salt spreads one key over ``salts`` tasks."""
    return rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))


def spread(small: DataFrame, salts: int = SALTS) -> DataFrame:
    """The other side: each row once per salt."""
    return small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def drop_ids(docs: DataFrame, ids: DataFrame, id_col: str, broadcast_rows: int = 2_000_000) -> DataFrame:
    """docs without the rows whose id is in ids (one long column, distinct).

    Up to ``broadcast_rows`` ids (16 MB) are broadcast after counting them;
    more are left to a shuffled anti join.
    """
    ids = ids.toDF("_ff_gone")
    if ids.limit(broadcast_rows + 1).count() <= broadcast_rows:
        ids = F.broadcast(ids)
    return docs.join(ids, F.col(id_col) == F.col("_ff_gone"), "left_anti")


Query = Callable[[SparkSession, str], DataFrame]
