"""Sinks: validity-gated appends, reports, pre-images, part files, keyed merges, transcripts, corrected pages. Tables replaced whole are in ``commit``."""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import RULE


def append_valid(rows: DataFrame, path: str, valid: Column, fmt: str = "json") -> DataFrame:
    """Appends the valid rows, one commit for all; returns the others."""
    valid = F.coalesce(valid, F.lit(False))
    rows.filter(valid).write.mode("append").format(fmt).save(path)
    return rows.filter(~valid)


def append_csv(rows: DataFrame, path: str) -> None:
    """Appends CSV with a header in every file, quotes doubled."""
    rows.write.mode("append").csv(path, header=True, quote='"', escape='"')


def change_set(updates: DataFrame) -> DataFrame:
    """updates (item_id, before, after, status): the records to send, one per changed item."""
    return updates.filter(F.col("status").isin("updated", "would_update")).select("item_id", F.col("after").alias("record"))


def pre_image(updates: DataFrame, path: str, dry_run: bool) -> None:
    """Keeps what changed items held before, as JSON lines; a dry run keeps nothing."""
    if not dry_run:
        updates.filter("status = 'updated'").select("item_id", F.to_json("before").alias("before")).write.mode("append").json(path)


def merge_keyed(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both by key; where both have one the new one wins whole."""
    return new.unionByName(old.join(new.select(*keys), keys, "left_anti"))


def file_stub(name: Column, most: int = 180) -> Column:
    """A name that any file system takes: illegal characters as _, white space as one space, at most ``most`` characters, never empty."""
    safe = F.regexp_replace(F.regexp_replace(F.regexp_replace(name, r"^\s+|\s+$", ""), r'[\\/:*?"<>|]', "_"), r"\s+", " ")
    return F.coalesce(F.nullif(F.substring(safe, 1, most), F.lit("")), F.lit("untitled"))


def media_name(name: Column, most: int = 200) -> Column:
    """Illegal characters as _, no spaces and dots at the ends; a longer name is cut before its ending."""
    safe = F.regexp_replace(F.regexp_replace(name, r'[<>:"/\\|?*]', "_"), r"^[ .]+|[ .]+$", "")
    end = F.regexp_extract(safe, r"^.*[^.].*?(\.[^.]*)$", 1)
    return F.when(F.length(safe) > most, F.concat(F.substring(safe, F.lit(1), F.lit(most) - F.length(end)), end)).otherwise(safe)


def plain_stem(name: Column) -> Column:
    """Without quotes and the characters that shells take for their own."""
    return F.translate(name, "'\"<>|*?", "")


def write_parts(parts: DataFrame, path: str, folders: list[str], text: str = "text") -> None:
    """One text file per row, in folders named by columns, which must differ from row to row."""
    parts.select(*folders, text).repartition(*folders).write.partitionBy(*folders).option("lineSep", "\n").text(path)


def with_header(header: dict[str, Column], body: Column) -> Column:
    """A transcript: 'name: value' lines of the values that are not null, the rule, the body."""
    lines = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v.cast("string"))) for k, v in header.items()]
    return F.concat(F.concat_ws("\n", *lines), F.lit(f"\n{RULE}\n\n"), F.coalesce(body, F.lit("")), F.lit("\n"))


def turtle(rows: DataFrame, prefix: str) -> DataFrame:
    """rows (term, label, lang, comment) as one Turtle statement each, column text; quotes and backslashes escaped."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.replace(F.col(c), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    return rows.select("term", F.concat(F.lit(f"{prefix}:"), "term", F.lit(" a rdf:Property ;\n  rdfs:label "), quoted("label"), F.lit("@"), "lang", F.lit(" ;\n  rdfs:comment "), quoted("comment"), F.lit("@"), "lang", F.lit(" .")).alias("text"))


@F.arrow_udf(returnType=T.StringType())
def _rewritten(page: pa.Array, lines: pa.Array) -> pa.Array:
    out = []
    for xml, fixes in zip(page.to_pylist(), lines.to_pylist(), strict=True):
        root = ET.fromstring(xml)
        space = root.tag.partition("}")[0] + "}" if root.tag.startswith("{") else ""
        if space:
            ET.register_namespace("", space[1:-1])
        new = {(x["block"], x["line"]): x["tokens"] for x in fixes or []}
        for b, block in enumerate(root.iter(f"{space}TextBlock")):
            for i, line in enumerate(block.iter(f"{space}TextLine")):
                words = list(line.iter(f"{space}String"))
                if len(new.get((b, i), ())) == len(words):
                    for word, token in zip(words, new[b, i], strict=True):
                        word.set("CONTENT", token)
        out.append(ET.tostring(root, encoding="unicode"))
    return pa.array(out, pa.string())


def corrected_pages(pages: DataFrame, lines: DataFrame) -> DataFrame:
    """pages (file, text: ALTO XML) with tokens replaced by place; lines (file, block, line, tokens) with another count of tokens change nothing."""
    by_file = lines.groupBy("file").agg(F.collect_list(F.struct("block", "line", "tokens")).alias("_l"))
    return pages.join(by_file, "file", "left").select("file", _rewritten("text", "_l").alias("text"))


def write_report(spark: SparkSession, rows: DataFrame, path: str, version: int = 1) -> None:
    """A versioned list {version, items} that ``work_list`` reads again; for reports that one machine can hold."""
    items = F.array_sort(F.collect_list(F.struct(*rows.columns)))
    rows.agg(items.alias("items")).select(F.lit(version).alias("version"), "items").coalesce(1).write.mode("overwrite").json(path)
