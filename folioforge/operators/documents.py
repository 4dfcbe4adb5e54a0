"""Document text: loops, joins of pages and turns, chunks, token corrections, exports."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import WORD, entity_cleaner

#: fixed values: words of a window, and repeats from which a text loops
LOOP_WORDS, LOOP_REPEATS = 12, 20


def _top_window(n: int):
    """A column function hashes of words (array) -> how often the n-word window that comes most often does, and where it first begins (from 1); null below 2 n words."""

    @F.arrow_udf(returnType="struct<n: bigint, first: int>")
    def top(words: pa.Array) -> pa.Array:
        every, out = words.flatten().to_numpy(zero_copy_only=False).view(np.uint64), []
        windows = np.zeros(max(0, len(every) - n + 1), np.uint64)
        for k in range(n):  # windows over row ends are never looked at
            windows = windows * np.uint64(0x9E3779B97F4A7C15) + every[k : k + len(windows)]
        end = 0
        for size in words.value_lengths().fill_null(0).to_pylist():
            start, end = end, end + size
            if size < 2 * n:
                out.append(None)
                continue
            _, first, count = np.unique(windows[start : end - n + 1], return_index=True, return_counts=True)
            most = count.max()
            out.append({"n": int(most), "first": int(first[count == most].min()) + 1})
        return pa.array(out, pa.struct([("n", pa.int64()), ("first", pa.int32())]))

    return top


def most_repeated(docs: DataFrame, n: int = LOOP_WORDS) -> DataFrame:
    """docs (doc_id, text): the n-word window that occurs most often, first occurrence on ties; (0, '') below 2 n words.

    Words are hashed once; a rolling 64-bit hash stands for a window, and every
    row sorts its own, so nothing leaves the row and there is no shuffle.
    """
    out = docs.select("doc_id", F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)).alias("w"), F.size(F.filter(F.split("text", r"\s+"), lambda x: x != "")).alias("n_words"))
    out = out.withColumn("top", _top_window(n)(F.transform("w", lambda x: F.xxhash64(x))))
    gram = F.array_join(F.slice("w", F.col("top.first"), n), " ")
    return out.select("doc_id", "n_words", F.coalesce("top.n", F.lit(0).cast("long")).alias("repeats"), F.coalesce(gram, F.lit("")).alias("gram"))


def looping(repeated: DataFrame) -> Column:
    """looping-{n}x, or null for short and sound texts."""
    return F.when((F.col("n_words") >= 3 * LOOP_WORDS) & (F.col("repeats") >= LOOP_REPEATS), F.concat(F.lit("looping-"), F.col("repeats").cast("string"), F.lit("x")))


def ordered_concat(rows: DataFrame, keys: list[str], order: str, text: Column, sep: str) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("t"))))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda p: p["t"]), sep).alias("text"), F.count(F.lit(1)).alias("n_parts"))


def join_pages(pages: DataFrame, key: str, page: str, text: str) -> DataFrame:
    """The document's first page bare, later ones under their number; gaps keep their numbers."""
    first = F.min(page).over(Window.partitionBy(key))
    marked = pages.withColumn("_t", F.when(F.col(page) == first, F.col(text)).otherwise(F.concat(F.lit("--- Page "), F.col(page).cast("string"), F.lit(" ---\n\n"), F.col(text))))
    return ordered_concat(marked, [key], page, F.col("_t"), "\n\n")


def speaker_turns(rows: DataFrame, key: str, order: list, speaker: str, text: str) -> DataFrame:
    """Runs of one speaker; a null speaker joins the running turn, leading nulls form one without a speaker."""
    w = Window.partitionBy(key).orderBy(*order)
    said = rows.filter(F.trim(text) != "").withColumn("_s", F.last(speaker, ignorenulls=True).over(w))
    said = said.withColumn("_new", (~F.col("_s").eqNullSafe(F.lag("_s").over(w)) | (F.row_number().over(w) == 1)).cast("int"))
    said = said.withColumn("turn", F.sum("_new").over(w)).withColumn("_o", F.row_number().over(w))
    parts = F.array_sort(F.collect_list(F.struct(F.col("_o").alias("o"), F.col(text).alias("t"))))
    return said.groupBy(key, "turn").agg(F.first("_s").alias("speaker"), F.array_join(F.transform(parts, lambda p: p["t"]), " ").alias("text"))


def chunk_plan(duration: Column, chunk: int, overlap: int) -> Column:
    """array of (i, start, end): windows of chunk seconds that begin overlap seconds early; one open window where nothing is to cut."""
    if chunk <= 0 or overlap < 0 or overlap >= chunk:
        raise ValueError("chunk must be positive and overlap smaller than it")
    d = duration.cast("long")
    one = F.array(F.struct(F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("start"), F.lit(None).cast("long").alias("end")))
    last = F.ceil(d / chunk).cast("long") - 1
    many = F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(last, F.lit(0).cast("long"))), lambda i: F.struct(i.alias("i"), F.when(i > 0, i * chunk - overlap).otherwise(F.lit(0)).cast("long").alias("start"), F.least((i + 1) * chunk, d).cast("long").alias("end")))
    return F.when(d.isNull() | (d <= chunk), one).otherwise(many)


#: fixed values: where samples begin, as shares of the duration, in this order
ANCHORS = (0.10, 0.55, 0.85, 0.30, 0.70)


def sample_windows(duration: Column, seconds: int, count: int) -> Column:
    """array of (i, start, end): windows at fixed shares of the duration; short ones are taken whole."""
    d = duration.cast("long")
    struct = lambda i, s, e: F.struct(F.lit(i).cast("long").alias("i"), s.cast("long").alias("start"), e.cast("long").alias("end"))
    none = F.lit(None).cast("long")
    many = [struct(i, F.floor(d * F.lit(a).cast("double")), F.floor(d * F.lit(a).cast("double")) + seconds) for i, a in enumerate(ANCHORS[:count])]
    return F.when(d.isNull(), F.array(struct(0, F.lit(0), F.lit(seconds)))).when(d <= seconds * count, F.array(struct(0, F.lit(0), none))).otherwise(F.array(*many))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """rows with place (from 1, within the group) and of (the group's rows); order must be unique within a group.

    Keys alone are sorted over ranges; a range's place in a group follows from
    the counts of the ranges before it, so a group of any size is spread over
    tasks, and the other columns travel once, by their whole key.
    """
    keys = [group, *order]
    sorted_ = rows.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_i", F.monotonically_increasing_id())
    sorted_ = sorted_.withColumn("_part", F.shiftright("_i", 33))
    ranges = sorted_.groupBy(group, "_part").agg(F.min("_i").alias("_low"), F.count(F.lit(1)).alias("_n"))  # at most groups + ranges rows
    w = Window.partitionBy(group)
    before = F.coalesce(F.sum("_n").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), (before - F.col("_low") + 1).alias("_shift"), F.sum("_n").over(w).alias("of"))
    placed = sorted_.join(ranges, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p"))).select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), (F.col("_i") + F.col("_shift")).alias("place"), "of")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return rows.join(placed, same).select(*rows.columns, "place", "of")


def numbered_parts(docs: DataFrame, group: str, order: list[str], size: int) -> DataFrame:
    """Part number per group of size documents; null where a group fits in one part."""
    part = (F.floor((F.col("place") - 1) / size) + 1).cast("long")
    return numbered(docs, group, order).withColumn("part", F.when(F.col("of") > size, part)).drop("place", "of")


def apply_corrections(lines: DataFrame, fixes: DataFrame, keys: list[str]) -> DataFrame:
    """lines (keys, tokens); fixes (keys, seq, tokens): the last fix with as many tokens replaces them; changed tokens are counted."""
    sound = fixes.join(lines.select(*keys, F.size("tokens").alias("_n")), keys).filter(F.size("tokens") == F.col("_n"))
    last = sound.groupBy(*keys).agg(F.max_by("tokens", "seq").alias("_fix"))
    return _applied(lines.join(last, keys, "left"), keys)


def apply_own_corrections(lines: DataFrame, keys: list[str]) -> DataFrame:
    """apply_corrections where every line's keys are its own and its fixes stand beside it (fixes: array of (seq, tokens)); nothing is shuffled."""
    sound = F.filter("fixes", lambda x: F.size(x["tokens"]) == F.size("tokens"))
    return _applied(lines.withColumn("_fix", F.array_max(sound)["tokens"]), keys)


def _applied(lines: DataFrame, keys: list[str]) -> DataFrame:
    """lines (keys, tokens, _fix: their replacement or null) as text, with the number of changed tokens."""
    out = lines.withColumn("_fix", F.coalesce("_fix", "tokens"))
    changed = F.size(F.filter(F.arrays_zip(F.col("tokens").alias("a"), F.col("_fix").alias("b")), lambda x: x["a"] != x["b"]))
    return out.select(*keys, F.array_join("_fix", " ").alias("text"), changed.cast("long").alias("changed"))


def first_entities(names: DataFrame, key: str, pos: str, name: str) -> DataFrame:
    """Of names equal but for case the first of each key; a name cleaned to nothing counts as one."""
    first = F.min_by(name, pos)
    return names.groupBy(key, F.lower(name).alias("_low")).agg(first.alias(name), F.min(pos).alias(pos)).select(key, name, pos)


def by_repeats(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key no other row has, the others and those without a key): only keys are shuffled; repeated ones go to all tasks."""
    again = rows.groupBy(F.col(key).alias("_again")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1 and _again is not null").select("_again")
    same = rows.select(*rows.columns).join(F.broadcast(again), F.col(key) == F.col("_again"), "left_semi")
    once = rows.filter(F.col(key).isNotNull()).join(F.broadcast(again), F.col(key) == F.col("_again"), "left_anti")
    return once, same.unionAll(rows.filter(F.col(key).isNull()))


def cleaned_names(rows: DataFrame, key: str, names: str) -> DataFrame:
    """key, pos (from 1), clean: of names (array of strings) of a row that are equal but for case when cleaned, the first; null and empty names are left out."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clean = entity_cleaner()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                row, pos, out = [], [], []
                for i, texts in enumerate(part.column(1).to_pylist()):
                    seen = set()
                    for p, name in enumerate(texts or [], 1):
                        if name and name not in seen:
                            seen.add(name)
                            c = clean(name)
                            low = (c.lower(),)
                            if low not in seen:
                                seen.add(low)
                                row.append(i)
                                pos.append(p)
                                out.append(c)
                yield pa.record_batch([part.column(0).take(pa.array(row, pa.int64())), pa.array(pos, pa.int64()), pa.array(out, pa.string())], ["key", "pos", "clean"])

    typed = rows.select(F.col(key).alias("key"), F.col(names).alias("names"))
    return typed.mapInArrow(first, T.StructType([T.StructField("key", typed.schema["key"].dataType), T.StructField("pos", T.LongType()), T.StructField("clean", T.StringType())])).withColumnRenamed("key", key)


def cut_text(text: str, most: int) -> list[str]:
    """Pieces of at most ``most`` characters that end at paragraph breaks, else at spaces, else anywhere; spaces after a cut are dropped."""
    if len(text) <= most:
        return [text]
    ends = [i for m in re.finditer(r"\n{2,}", text) for i in m.span()] + [len(text)]
    out, start, kept = [], 0, 0  # text[start:kept] waits to be sent
    for end in ends:
        if end - start > most:
            if kept > start:
                out.append(text[start:kept])
            start = kept
            while end - start > most:
                cut = text.rfind(" ", start, start + most)
                cut = cut if cut > start else start + most
                out.append(text[start:cut])
                start = next((i for i in range(cut, end) if text[i] != " "), end)
        kept = end
    return [*out, text[start:]] if start < len(text) else out


def chunk_text(docs: DataFrame, key: str, text: str, most: int) -> DataFrame:
    """One row per piece of each text: key, i (from 0), piece. Null and empty texts give one empty piece."""
    if most < 1:
        raise ValueError("most must be positive")

    @F.arrow_udf(returnType=T.ArrayType(T.StringType()))
    def cut(column: pa.Array) -> pa.Array:
        return pa.array([cut_text(t or "", most) for t in column.to_pylist()], pa.list_(pa.string()))

    return docs.select(key, F.posexplode(cut(text)).alias("i", "piece"))


def rejoined(pieces: DataFrame, key: str) -> DataFrame:
    """Corrected pieces in order, without line ends at their ends, joined by a blank line."""
    return ordered_concat(pieces, [key], "i", F.regexp_replace("piece", r"^\n+|\n+$", ""), "\n\n")
