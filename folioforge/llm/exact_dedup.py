"""Exact dedup by two-pass Bloom filtering, in DataFrame functions only.

Pass one counts how often each filter position is hit; pass two probes every
row.  Rows that surely occur once pass straight through; only the rest, as
(id, digest) pairs and never as texts, are shuffled to find groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SALTS, filter_bits, probe, read, repeated_filter, salted, spread, stored


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def keep_first(hashed: DataFrame, id_col: str, key_col: str, row_col: str, bits: int | None = None, salts: int = SALTS) -> DataFrame:
    """hashed with keep_id, group_size and kept; hashed must be cheap to read several times. bits: of the filter, by the number of rows unless given.

    row_col tells the rows apart, whatever their ids.

    The smallest id of a key stays.  Null ids come after all others.  Rows that
    repeat both id and key are one group member each; the first by row_col stays.
    A group of any size is aggregated before the shuffle and joined back over
    ``salts`` tasks.
    """
    bits = bits or filter_bits(hashed)
    probed = probe(hashed, key_col, repeated_filter(hashed, key_col, bits), "_maybe", bits)
    alone = probed.filter("not _maybe").drop("_maybe").withColumns({"keep_id": F.col(id_col), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})
    some = salted(probed.filter("_maybe").drop("_maybe"), F.col(row_col), salts)
    first = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("keep_id"), F.col(row_col).alias("row"))
    groups = some.groupBy(F.col(key_col).alias("_key")).agg(F.min(first).alias("_first"), F.count(F.lit(1)).alias("group_size"))
    groups = spread(groups.select("_key", "_first.keep_id", F.col("_first.row").alias("_row"), "group_size"), salts).withColumnRenamed("_salt", "_salt2")
    found = some.join(groups, (F.col(key_col) == F.col("_key")) & (F.col("_salt") == F.col("_salt2")))
    found = found.withColumn("kept", F.col(row_col) == F.col("_row"))
    return alone.unionByName(found.select(*alone.columns))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty; empty texts are equal to each other, and a text
    of white space only equals a single space, not the empty text.  Other
    columns of docs are ignored, whatever their names.  An empty table gives an
    empty result.  Null and repeated ids: see ``keep_first``.
    """
    hashed = docs.select(F.col(id_col).alias("doc_id"), F.sha2(normalised(F.col(text_col)), 256).alias("text_sha256"), F.monotonically_increasing_id().alias("row"))
    return keep_first(stored(hashed, "digests"), "doc_id", "text_sha256", "row", bits).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


SQL = r"""
WITH h AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM h
"""
