"""WARC archives with content-addressed payloads.

``write_archive`` stores each distinct payload once under its SHA-256 and the
exact header block of every record beside it; ``read_archive`` joins them back
and recomputes the digests; ``records`` rebuilds the original record bytes.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import filter_bits, fresh_path, probe, read, repeated_filter, salted, spread, stored
from .exact_dedup import keep_first

LEAST_BYTES = 100
CRLF = "\r\n"


def _field(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))).otherwise(F.lit(""))


def _one_line(value: Column) -> Column:
    """Header values are one line: line ends become percent codes, all else stays."""
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record_id(page_id: Column, serial: Column | None = None) -> Column:
    parts = [F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(":"), F.substring("digest", 1, 16)]
    return F.concat(*parts, *([F.lit(":"), serial.cast("string")] if serial is not None else []), F.lit(">"))


def _header(date: str) -> Column:
    """The one response that others may refer to is named by its page and digest, every other record by its row's number too."""
    revisit = F.col("record_type") == "revisit"
    own = F.when(F.col("kept") & F.col("shared"), _record_id(F.col("page_id"))).otherwise(_record_id(F.col("page_id"), F.col("serial")))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _field("WARC-Type", F.col("record_type")),
        _field("WARC-Record-ID", own),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", _one_line(F.col("url"))),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _field("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _field("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to")))),
        _field("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
        F.lit(CRLF),
    )


def write_archive(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, bits: int | None = None, date: str | None = None) -> None:
    """Writes path/headers (page_id, digest, header) and path/payloads (digest, payload).

    date is every record's WARC-Date, the time of writing unless given.
    Null html is an empty payload, null url leaves the target field out.  Of
    equal payloads of at least ``least_bytes`` the record with the smallest
    page_id is a response and the others revisit it; smaller payloads are all
    responses, though their bytes too are stored once.  Payload rows that
    surely occur once are written where they are; only possibly repeated ones
    are shuffled.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    meta = stored(rows.drop("payload").withColumn("serial", F.monotonically_increasing_id()), "warc-meta")
    bits = bits or filter_bits(meta)
    large = keep_first(meta.filter(F.col("payload_bytes") >= least_bytes), "page_id", "digest", "serial", bits).withColumn("shared", F.lit(True))
    small = meta.filter(F.col("payload_bytes") < least_bytes).withColumns({"keep_id": F.col("page_id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True), "shared": F.lit(False)})
    typed = large.unionByName(small).withColumns({"record_type": F.when(F.col("kept"), "response").otherwise("revisit"), "refers_to": F.when(~F.col("kept"), F.col("keep_id"))})
    typed.select("page_id", "digest", _header(date).alias("header")).write.option("compression", "zstd").parquet(f"{path}/headers")
    probed = probe(rows.select("digest", "payload"), "digest", repeated_filter(meta, "digest", bits), "_maybe", bits)
    once = probed.filter("not _maybe").select("digest", "payload")
    shared = probed.filter("_maybe").groupBy("digest").agg(F.first("payload").alias("payload"))
    once.unionByName(shared).write.option("compression", "zstd").parquet(f"{path}/payloads")


def _missing() -> Column:
    return F.raise_error(F.concat(F.lit("payload missing: "), F.col("digest"))).cast("string")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Digest and length are recomputed from the stored bytes and the rest is
    parsed from the stored header; a payload that is missing or does not match
    its address raises.  Payload bytes are not shuffled.
    """
    schema = "page_id long, digest string, header string"
    headers = spark.read.schema(schema).parquet(f"{path}/headers")
    payloads = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    bytes_of = payloads.select("digest", F.sha2("payload", 256).alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"))
    bytes_of = bytes_of.withColumn("payload_digest", F.when(F.col("payload_digest") == F.col("digest"), F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("payload damaged: "), F.col("digest")))))
    both = salted(headers, F.col("page_id")).join(spread(bytes_of), ["digest", "_salt"], "left")
    both = both.withColumn("payload_digest", F.coalesce("payload_digest", _missing()))
    said = lambda name: F.nullif(F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1), F.lit(""))
    refers = F.expr("try_cast(nullif(regexp_extract(header, '\\r\\nWARC-Refers-To: <urn:page:(-?[0-9]+):', 1), '') as bigint)")
    return both.select("page_id", "payload_bytes", "payload_digest", said("WARC-Type").alias("record_type"), refers.alias("refers_to"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """page_id and the exact record bytes: header block, payload unless a revisit, two line ends."""
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads")
    both = salted(headers, F.col("page_id")).join(spread(payloads), ["digest", "_salt"], "left").withColumn("payload", F.coalesce("payload", _missing().cast("binary")))
    body = F.when(F.col("header").contains(f"WARC-Type: revisit{CRLF}"), F.lit("").cast("binary")).otherwise(F.col("payload"))
    return both.select("page_id", F.concat(F.col("header").cast("binary"), body, F.lit(CRLF * 2).cast("binary")).alias("record"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    write_archive(read(spark, sf_dir, "pages"), path)
    return read_archive(spark, path)


SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
     k AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM k
"""
