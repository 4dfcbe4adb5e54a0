"""Reports on batches of files read page by page, plans of fixed segments, durations and notes for windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clock

MIB = 1024 * 1024


def file_results(pages: DataFrame) -> DataFrame:
    """pages (batch, file, page, ok, bytes, written): one row per file.

    pages, successful, failed (page numbers in order), success (per cent), ok:
    at least one page was read and the file's text was written.  A null ok is a
    failed page, a null written means not written.
    """
    good = F.coalesce(F.col("ok"), F.lit(False))
    out = pages.groupBy("batch", "file").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(good).alias("successful"),
        F.array_sort(F.collect_list(F.when(~good, F.col("page")))).alias("failed"),
        F.max("bytes").alias("bytes"),
        F.max(F.coalesce("written", F.lit(False))).alias("written"),
    )
    return out.withColumn("success", 100.0 * F.col("successful") / F.col("pages")).withColumn("ok", (F.col("successful") > 0) & F.col("written")).drop("written")


def batch_report(files: DataFrame) -> DataFrame:
    """file_results by batch: files, processed, failed, success (per cent of pages), mb of the processed files."""
    return files.groupBy("batch").agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if("ok").alias("processed"),
        F.count_if(~F.col("ok")).alias("failed"),
        (100.0 * F.sum("successful") / F.sum("pages")).alias("success"),
        (F.coalesce(F.sum(F.when(F.col("ok"), F.col("bytes"))), F.lit(0)) / MIB).alias("mb"),
    )


def segment_plan(length: Column, segment: Column) -> Column:
    """Array of (number from 1, start, stop) of fixed segments, the last one short; one whole where nothing is to be cut, none for nulls."""
    count = F.greatest(F.ceil(length / segment), F.lit(1)).cast("int")
    plan = F.transform(F.sequence(F.lit(1), count), lambda i: F.struct(i.alias("number"), ((i - 1) * segment).cast("long").alias("start"), F.least(i * segment, length).cast("long").alias("stop")))
    return F.when(length.isNotNull() & (segment > 0), plan)


def rough_duration(seconds: Column) -> Column:
    """~3d 4h, ~5h 6m or ~7m, whatever is left over cut off."""
    s = seconds.cast("long")
    hours, minutes = F.floor(s / 3600), F.floor(s % 3600 / 60)
    return F.when(hours >= 24, F.format_string("~%dd %dh", F.floor(hours / 24), hours % 24)).when(hours > 0, F.format_string("~%dh %dm", hours, minutes)).otherwise(F.format_string("~%dm", minutes))


def window_note(number: Column, total: Column, start: Column, stop: Column, new_from: Column) -> Column:
    """What a model is told about one window of a recording; empty where the window is all of it.

    Times count from the recording's start, and what lies before ``new_from``
    was written down with the window before.
    """
    head = F.format_string("\n## Part %d of %d\n- This part runs from %s to %s; give times counted from the start of the whole recording.", number.cast("long"), total.cast("long"), clock(start), clock(stop))
    skip = F.when(new_from > start, F.concat(F.lit("\n- Leave out what begins before "), clock(new_from), F.lit(": it is in the part before.")))
    return F.when(total > 1, F.concat(head, F.coalesce(skip, F.lit("")), F.lit("\n- Write the transcript only."))).otherwise("")


def instructions(template: str, place: str = "{text}", closing: tuple[str, ...] = ("**Texte:**", "---")) -> str:
    """A prompt's part before the place of its text, without the marks that lead up to that place."""
    said = template.partition(place)[0].rstrip()
    for mark in closing:
        said = said.removesuffix(mark).rstrip()
    return said
