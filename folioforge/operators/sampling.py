"""Limits and samples in listing order without one global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(seed: int, *parts: Column) -> Column:
    """A reproducible draw: the SHA-256 of the seed and the parts, as hexadecimal text."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *(p.cast("string") for p in parts)), 256)


def until_produced(rows: DataFrame, order: str, produced: Column, limit: int) -> DataFrame:
    """rows up to and with the one that is the limit-th for which ``produced`` is true, in the order of a unique column.

    Rows for which it is false or null do not count, but are kept where a scan
    that stops at the limit would have seen them.  With fewer produced rows all
    rows stay; a limit of 0 keeps none.

    Rows are dealt over ranges of the order; counts of ranges, one row each, say
    which range holds the last row, and only that range is counted row by row.
    """
    if limit < 0:
        raise ValueError("limit must not be negative")
    if limit == 0:
        return rows.limit(0)
    ok = F.coalesce(produced, F.lit(False))
    keys = rows.select(F.col(order).alias("_o"), ok.alias("_ok")).repartitionByRange("_o").withColumn("_part", F.spark_partition_id())
    ranges = keys.groupBy("_part").agg(F.count_if("_ok").alias("n"), F.min("_o").alias("low"), F.max("_o").alias("high"))
    # a row per range, in the order of ranges
    so_far = F.coalesce(F.sum("n").over(Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = ranges.withColumn("before", so_far).filter((F.col("before") < limit) & (F.col("before") + F.col("n") >= limit)).select("low", "high", "before").first()
    if at is None:
        return rows
    inside = rows.filter(ok & F.col(order).between(F.lit(at["low"]), F.lit(at["high"])))
    last = inside.select(F.col(order).alias("_o")).orderBy("_o").offset(limit - at["before"] - 1).limit(1).first()["_o"]
    return rows.filter(F.col(order) <= F.lit(last))


def first_produced(rows: DataFrame, order: str, produced: Column, limit: int) -> DataFrame:
    """The first ``limit`` rows for which ``produced`` is true, in the order of a unique column."""
    return until_produced(rows, order, produced, limit).filter(F.coalesce(produced, F.lit(False)))


def page_sample(rows: DataFrame, page: str, key: str, pages: int, a_page: int, size: int, seed: int) -> DataFrame:
    """A two-stage sample: ``pages`` pages by the draw of their number, ``a_page`` rows of each by the draw of page and key, ``size`` of these by the draw of the key.

    Every stage keeps the smallest draws, so partial results merge and the
    sample does not depend on partitions or order; key must be unique and not
    null, null pages are left out.  It is a cluster sample: rows of one page
    come together.
    """
    numbers = rows.filter(F.col(page).isNotNull()).select(page).distinct()
    drawn = numbers.orderBy(draw(seed, F.col(page)), page).limit(pages)
    inside = rows.join(F.broadcast(drawn), page, "left_semi")  # ``pages`` numbers
    turn = F.row_number().over(Window.partitionBy(page).orderBy(draw(seed, F.col(page), F.col(key)), key))
    kept = inside.withColumn("_ff_turn", turn).filter(F.col("_ff_turn") <= a_page).drop("_ff_turn")
    return kept.orderBy(draw(seed, F.col(key)), key).limit(size)
