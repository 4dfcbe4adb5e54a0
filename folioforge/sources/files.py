"""File sources: texts named by id, checked CSV, logs, XML pages, transcripts, prompts, media listings.

All of them read through Spark's readers, so a path may lie in any store that
Spark reaches, and files are split over tasks.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import is_json, strip

RULE = "=" * 50  # fixed value: the line between a transcript's header and body


def whole_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """file (name), folder (name of the one it lies in), text; one row per file below path."""
    read = spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
    parts = F.split("_metadata.file_path", "/")
    return read.select(F.col("_metadata.file_name").alias("file"), F.get(parts, F.size(parts) - 2).alias("folder"), F.col("value").alias("text"))


def numbered_texts(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """id and text of files named <number>.txt; others are left out."""
    files = whole_files(spark, path, glob)
    number = F.regexp_extract("file", r"^([0-9]+)\.[^.]*$", 1)
    return files.filter(number != "").select(number.cast("long").alias("id"), "text")


def checked_csv(spark: SparkSession, path: str, required: list[str], optional: list[str] | None = None) -> DataFrame:
    """A CSV with a header, quoted line ends and cells of any length; a required column that lacks raises, an optional one is blank."""
    rows = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', maxCharsPerColumn=-1)
    lacking = [c for c in required if c not in rows.columns]
    if lacking:
        raise ValueError(f"{path} lacks the columns {', '.join(lacking)}")
    return rows.withColumns({c: F.lit("") for c in optional or [] if c not in rows.columns})


def completed_ids(rows: DataFrame, column: str) -> DataFrame:
    """Distinct trimmed ids; blank ones are none."""
    return rows.select(strip(F.col(column)).alias(column)).filter(f"`{column}` <> ''").distinct()


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """seq (orders lines as the files have them) and line, of logs of any size; blank lines are left out."""
    read = spark.read.text(path)
    seq = F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return read.select(seq.alias("seq"), F.col("value").alias("line")).filter(strip(F.col("line")) != "")


def log_records(lines: DataFrame, schema: str, version: str | None = None) -> DataFrame:
    """Records of JSON lines; torn lines and other versions (field v) are left out, a later complete line still counts."""
    out = lines.select("seq", F.from_json("line", schema).alias("r"), is_json(F.col("line")).alias("ok")).filter("ok and r is not null").select("seq", "r.*")
    return out if version is None else out.filter(F.col("v") == version).drop("v")


def work_list(spark: SparkSession, path: str, items: str, version: int = 1) -> DataFrame:
    """Entries of a versioned JSON list {version, items}; another version raises."""
    read = spark.read.schema(f"version int, items array<{items}>").json(path, multiLine=True)
    if read.filter(~F.col("version").eqNullSafe(F.lit(version))).limit(1).count():
        raise ValueError(f"{path} is not of version {version}")
    return read.select(F.inline("items"))


def kept_shares(report: DataFrame, column: str, shares: list[str]) -> DataFrame:
    """report with the array's entries of some shares only; rows with nothing left are dropped."""
    return report.withColumn(column, F.filter(column, lambda x: x["share"].isin(*shares))).filter(F.size(column) > 0)


def index_files(spark: SparkSession, path: str, pattern: str = r"index.*\.json$") -> DataFrame:
    """id, file and text of the first matching, non-blank file of every folder named by a number."""
    files = whole_files(spark, path, "*.json").filter(F.col("file").rlike(pattern) & F.col("folder").rlike("^[0-9]+$") & (strip(F.col("text")) != ""))
    return files.groupBy(F.col("folder").cast("long").alias("id")).agg(F.min_by(F.struct("file", "text"), "file").alias("x")).select("id", "x.*")


_TOKEN = T.StructType([T.StructField(c, T.IntegerType()) for c in ("block", "line", "tok")] + [T.StructField(c, T.StringType()) for c in ("content", "hpos", "vpos", "width", "height")])


@F.arrow_udf(returnType=T.ArrayType(_TOKEN))
def _alto(pages: pa.Array) -> pa.Array:
    out = []
    for xml in pages.to_pylist():
        parts = lambda node, name: (x for x in node.iter() if isinstance(x.tag, str) and x.tag.rpartition("}")[2] == name)
        try:
            root = ET.fromstring(xml or "<none/>")
        except ET.ParseError:
            out.append(None)
            continue
        out.append([{"block": b, "line": i, "tok": k, **{c: word.get(c.upper()) for c in ("content", "hpos", "vpos", "width", "height")}} for b, block in enumerate(parts(root, "TextBlock")) for i, line in enumerate(parts(block, "TextLine")) for k, word in enumerate(parts(line, "String"))])
    return pa.array(out, pa.list_(pa.struct([*((c, pa.int32()) for c in ("block", "line", "tok")), *((c, pa.string()) for c in ("content", "hpos", "vpos", "width", "height"))])))


def page_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Tokens of ALTO pages by place: path, file, block, line, tok (from 0), content, hpos, vpos, width, height; a coordinate that is no number is null.

    A file is parsed whole, in any namespace, so a block's place is its place in
    the file, however files are split; a file that is no XML has no tokens.
    """
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=False)
    tokens = files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"), F.explode(_alto("value")).alias("_t"))
    number = lambda c: F.col(f"_t.{c}").try_cast("double").alias(c)
    return tokens.select("path", "file", "_t.block", "_t.line", "_t.tok", "_t.content", *map(number, ("hpos", "vpos", "width", "height")))


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """id, header (map), body of <number>.txt files; a file without the separating line is all body."""
    return numbered_texts(spark, path).select("id", *header_and_body(F.col("text")))


def header_and_body(text: Column) -> list[Column]:
    """Columns header (map of the 'name: value' lines before the rule) and body."""
    at = F.instr(text, RULE)
    lines = F.filter(F.split(F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(""), "\n"), lambda x: x.contains(":"))
    pairs = F.transform(lines, lambda x: F.struct(strip(F.regexp_extract(x, "^([^:]*):", 1)).alias("k"), strip(F.regexp_extract(x, "^[^:]*:(.*)$", 1)).alias("v")))
    last = F.filter(pairs, lambda p, i: F.size(F.filter(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda q: q["k"] == p["k"])) == 0)
    body = F.when(at > 0, F.substring(text, at + len(RULE), F.length(text))).otherwise(text)
    return [F.map_from_entries(last).alias("header"), strip(body).alias("body")]


def vocabulary_terms(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """Distinct subjects prefix:name that begin a statement of Turtle files."""
    found = F.regexp_extract_all("text", F.lit(rf"(?m)^{prefix}:([A-Za-z_][\w-]*)\s+a\s"), F.lit(1))
    return whole_files(spark, path, "*.ttl").select(F.explode(found).alias("term")).distinct()


def prompts(spark: SparkSession, path: str) -> DataFrame:
    """number, title and body of files NN_name.md; the body begins after the first heading, if there is one."""
    files = whole_files(spark, path, "*.md").withColumn("n", F.regexp_extract("file", r"^([0-9]+)_.+\.md$", 1)).filter("n <> ''")
    title = F.initcap(F.replace(F.regexp_extract("file", r"^[0-9]+_(.+)\.md$", 1), F.lit("_"), F.lit(" ")))
    body = F.coalesce(F.nullif(F.regexp_extract("text", r"(?s)^(?:.*?\n)??#\s[^\n]*\n(.*)$", 1), F.lit("")), F.col("text"))
    return files.select(F.col("n").cast("int").alias("number"), title.alias("title"), strip(body).alias("body"))


#: fixed values: file endings by kind of medium
AUDIO = ("mp3", "wav", "m4a", "flac", "ogg", "aac", "wma")
VIDEO = ("mp4", "avi", "mov", "mkv", "webm", "flv", "wmv", "m4v")


def ending(name: Column) -> Column:
    return F.lower(F.regexp_extract(F.regexp_replace(name, r"[?#].*$", ""), r"\.([^./]+)$", 1))


def media_kind(name: Column) -> Column:
    return F.when(ending(name).isin(*AUDIO), "audio").when(ending(name).isin(*VIDEO), "video").otherwise("unknown")


def media_files(spark: SparkSession, path: str, kinds: tuple[str, ...] = ("audio", "video")) -> DataFrame:
    """path, name, kind, bytes, modified of media files; names with quotes or shell characters are left out. No content is read."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    out = read.select("path", F.regexp_extract("path", "([^/]+)$", 1).alias("name"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    return out.withColumn("kind", media_kind(F.col("name"))).filter(F.col("kind").isin(*kinds) & ~F.col("name").rlike(r"""['"<>|*?]"""))


def newest(files: DataFrame, path: str = "path", modified: str = "modified") -> DataFrame:
    """The path changed last; of several the last by name."""
    return files.agg(F.max_by(path, F.struct(modified, path)).alias(path))


def attached_media(items: DataFrame, media: DataFrame, endings: tuple[str, ...]) -> DataFrame:
    """item_id, pos, media_id, url of items' (item_id, media array<bigint>) files (media_id, url) with one of the endings."""
    links = items.select("item_id", F.posexplode("media").alias("pos", "media_id"))
    return links.join(media, "media_id").filter(ending(F.col("url")).isin(*endings)).select("item_id", "pos", "media_id", "url")
