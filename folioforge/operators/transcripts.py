"""Segments and transcripts: marks, retries, joins of parts, the gate before an upload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clock_of_minutes, strip
from ..sources.files import RULE
from .documents import LOOP_WORDS, looping, most_repeated, ordered_concat

FAILED = "TRANSCRIPTION FAILED"


def segment_mark(number: Column, total: Column, minutes: Column) -> Column:
    """[Segment n/total | start–end], the last one open."""
    end = F.when(number < total, clock_of_minutes(number * minutes)).otherwise("end")
    return F.format_string("[Segment %d/%d | %s–%s]", number.cast("long"), total.cast("long"), clock_of_minutes((number - 1) * minutes), end)


def failed_mark(number: Column, mark: Column, reason: Column) -> Column:
    plain = F.coalesce(F.nullif(mark, F.lit("")), F.format_string("[Segment %d]", number.cast("long")))
    return F.concat(plain, F.lit(f" {FAILED}"), F.coalesce(F.concat(F.lit(" ("), reason, F.lit(")")), F.lit("")))


def segment_facts(text: Column) -> list[Column]:
    """failed (numbers, in order), segments (how many), minutes (from the header above the rule only)."""
    numbers = lambda pattern: F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda x: x.cast("int"))
    head = F.substring_index(text, RULE, 1)
    minutes = F.regexp_extract(head, r"(?m)^Segment length: ([0-9]+) minutes?$", 1)
    return [numbers(rf"\[Segment ([0-9]+)[^\]]*\] {FAILED}").alias("failed"), F.size(F.array_distinct(numbers(r"\[Segment ([0-9]+)[^\]]*\]"))).alias("segments"), F.nullif(minutes, F.lit("")).cast("int").alias("minutes")]


def file_state(text: Column) -> Column:
    """new without a text, retry with failed segments, else complete."""
    return F.when(strip(F.coalesce(text, F.lit(""))) == "", "new").when(text.rlike(rf"\[Segment [0-9]+[^\]]*\] {FAILED}"), "retry").otherwise("complete")


def spliced(text: Column, number: Column, new: Column) -> Column:
    """The failed mark of one segment replaced by its mark and the new text; segment 2 is not segment 20."""
    pattern = F.concat(F.lit(r"(\[Segment "), number.cast("string"), F.lit(rf"(?![0-9])[^\]]*\]) {FAILED}(?: \([^)]*\))?"))
    safe = F.regexp_replace(new, r"([\\$])", r"\\$1")
    return F.regexp_replace(text, pattern, F.concat(F.lit("$1\n"), safe))


def retries(states: DataFrame, files: DataFrame, minutes: int) -> DataFrame:
    """states (id, failed, minutes) and files (id, pos from 1, path): one row per failed segment, with the file at its place.

    status: refused where the transcript was cut at another length, failed
    where no file stands at the place, else ready.
    """
    asked = states.select("id", "minutes", F.explode("failed").alias("pos"))
    out = asked.join(files, ["id", "pos"], "left")
    wrong = F.col("minutes").isNotNull() & (F.col("minutes") != minutes)
    return out.select("id", "pos", "path", F.when(wrong, "refused").when(F.col("path").isNull(), "failed").otherwise("ready").alias("status"))


def name_parts(name: Column) -> list[Column]:
    """identifier and segment of <identifier>[-<segment>]_transcription.txt; nulls for other names."""
    whole = F.regexp_extract(name, r"^(.+?)_transcription\.txt$", 1)
    cut = F.regexp_extract(name, r"^(.+?)-([0-9]+)_transcription\.txt$", 1)
    segment = F.nullif(F.regexp_extract(name, r"^.+?-([0-9]+)_transcription\.txt$", 1), F.lit("")).cast("int")
    return [F.coalesce(F.nullif(cut, F.lit("")), F.nullif(whole, F.lit(""))).alias("identifier"), segment.alias("segment")]


def joined_parts(files: DataFrame) -> DataFrame:
    """files (identifier, segment, name, text): one text each, by segment; parts of several numbered files stand under a banner, blank ones are left out."""
    bar = "=" * 60
    full = F.filter(F.array_sort(F.collect_list(F.struct(F.coalesce("segment", F.lit(0)).alias("o"), "name", "segment", strip(F.col("text")).alias("t")))), lambda x: x["t"] != "")
    out = files.groupBy("identifier").agg(full.alias("x"), F.count(F.lit(1)).alias("files"))
    part = lambda x: F.when((F.col("files") > 1) & x["segment"].isNotNull(), F.concat(F.lit(f"\n{bar}\n[Part "), x["segment"].cast("string"), F.lit(f"]\n{bar}\n\n"), x["t"])).otherwise(x["t"])
    return out.select("identifier", "files", strip(F.array_join(F.transform("x", part), "\n")).alias("text"))


def joined_chunks(chunks: DataFrame, key: str, pos: str, label: str, text: str) -> DataFrame:
    """Transcribed windows in order; every seam but the first carries its window's label, failed windows are simply absent."""
    first = F.min(pos).alias("_first")
    both = chunks.filter(F.col(text).isNotNull()).join(chunks.filter(F.col(text).isNotNull()).groupBy(key).agg(first), key)
    block = F.when(F.col(pos) == F.col("_first"), strip(F.col(text))).otherwise(F.concat(F.lit("--- "), F.col(label), F.lit(" ---\n\n"), strip(F.col(text))))
    return ordered_concat(both, [key], pos, block, "\n\n")


def chunk_counts(header: Column) -> list[Column]:
    """done and total of the field Chunks: done/total; nulls without it."""
    said = F.coalesce(header["Chunks"], F.lit(""))
    number = lambda i: F.nullif(F.regexp_extract(said, r"^\s*([0-9]+)\s*/\s*([0-9]+)", i), F.lit("")).cast("int")
    return [number(1).alias("done"), number(2).alias("total")]


def upload_gate(transcripts: DataFrame, include_incomplete: bool = False) -> DataFrame:
    """transcripts (id, header, body) with status: ready, or why it is held back.

    The first reason counts: an empty body, then a looping one (which nothing
    lets through), then windows that lack.
    """
    loops = most_repeated(transcripts.select(F.col("id").alias("doc_id"), F.coalesce("body", F.lit("")).alias("text")), LOOP_WORDS)
    loops = loops.select(F.col("doc_id").alias("id"), looping(loops).alias("_loop"))
    done, total = chunk_counts(F.col("header"))
    short = F.when(done.isNotNull() & (done != total) & F.lit(not include_incomplete), F.format_string("incomplete (%d/%d windows)", done, total))
    empty = F.when(strip(F.coalesce("body", F.lit(""))) == "", F.lit("empty transcript"))
    out = transcripts.join(loops, "id", "left")
    reason = F.coalesce(empty, F.concat(F.lit("degenerate repeating output ("), "_loop", F.lit(")")), short, F.lit("ready"))
    return out.withColumn("status", reason).drop("_loop")


def matched_items(groups: DataFrame, items: DataFrame) -> DataFrame:
    """groups (identifier, ...) with item_id, the smallest of the items of that identifier; groups without one are kept as not_found."""
    first = items.groupBy("identifier").agg(F.min("item_id").alias("item_id"))
    out = groups.join(first, "identifier", "left")
    return out.withColumn("match", F.when(F.col("item_id").isNull(), "not_found").otherwise("found"))


def generators(batch: DataFrame) -> DataFrame:
    """How many transcripts each generator made, and whether the batch mixes several."""
    n = batch.groupBy("generator").agg(F.count(F.lit(1)).alias("n"))
    return n.crossJoin(n.agg((F.count(F.lit(1)) > 1).alias("mixed")))
