"""Selections, file round trips, names, languages, answers and transcripts over the driver tables, with SQL twins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks as K
from ..functions import text as X
from ..operators import contents as N
from ..operators import documents as D
from ..operators import language as L
from ..operators import runtime as U
from ..operators import sampling as M
from ..operators import transcripts as T
from ..operators import upsert as P
from ..session import scratch
from ..sinks.commit import commit, current
from ..sources import catalogue as C
from ..sources import files as S
from ..sources.listing import read_listing, record_pages
from .base import ORACLES, QUERIES, derive, query

# links in every form that is taken and some that are not
_LINK = """CASE CAST(doc_id % 10 AS INT) WHEN 0 THEN concat('https://www.youtube.com/watch?v=', k) WHEN 1 THEN concat(' http://youtu.be/', k, '?t=3 ') WHEN 2 THEN concat('https://m.youtube.com/watch?t=1&v=', k, '#x')
 WHEN 3 THEN concat('https://youtube.com/shorts/', k) WHEN 4 THEN concat('https://www.youtube.com/embed/', k) WHEN 5 THEN concat('ftp://youtu.be/', k) WHEN 6 THEN concat('https://youtu.be/', k, 'x')
 WHEN 7 THEN concat('https://music.youtube.com/watch/?v=', k) WHEN 8 THEN concat('https://example.com/watch?v=', k) ELSE NULL END"""


@query("video_ids", "SELECT doc_id, CASE WHEN doc_id % 10 IN (0, 1, 2, 7) THEN k END AS video FROM links", links=f"SELECT doc_id, k, {_LINK} AS url FROM (SELECT doc_id, lpad(CAST(doc_id AS VARCHAR(20)), 11, 'aZ_-9') AS k FROM {{documents}}) x")
def video_ids(links: DataFrame) -> DataFrame:
    return links.select("doc_id", X.video_id(F.col("url")).alias("video"))


@query("clocks", "SELECT event_id, CASE WHEN s IS NULL THEN '??:??:??' ELSE printf('%02d:%02d:%02d', CAST(r // 3600 AS BIGINT), CAST(r // 60 % 60 AS BIGINT), CAST(r % 60 AS BIGINT)) END AS clock FROM (SELECT *, CAST(round_even(s, 0) AS BIGINT) AS r FROM spans)", spans="SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(event_id AS DOUBLE) * 0.5 END AS s FROM {events}")
def clocks(spans: DataFrame) -> DataFrame:
    return spans.select("event_id", X.clock(F.col("s")).alias("clock"))


@query("explicit_items", "SELECT doc_id, 'found' AS status FROM docs WHERE doc_id IN (SELECT doc_id FROM asked) UNION ALL SELECT doc_id, 'missing' FROM asked WHERE doc_id NOT IN (SELECT doc_id FROM docs)", docs="SELECT doc_id FROM {documents}", asked="SELECT DISTINCT o_orderkey AS doc_id FROM {orders} WHERE o_orderkey % 7 = 0")
def explicit_items(docs: DataFrame, asked: DataFrame) -> DataFrame:
    found, lacking = C.by_ids(docs.withColumnRenamed("doc_id", "item_id"), asked.withColumnRenamed("doc_id", "item_id"))
    return found.withColumn("status", F.lit("found")).unionByName(lacking.withColumn("status", F.lit("missing"))).withColumnRenamed("item_id", "doc_id")


_RECORD = """concat('{{"o:id": ', CAST(o_orderkey AS VARCHAR(20)), ', "@type": ["o:Item"', CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE ', "bibo:Article"' END, '], "o:item_set": [{{"o:id": ', CAST(o_custkey % 5 AS VARCHAR(20)),
 '}}, {{"@id": "http://h/items/', CAST(o_custkey % 7 AS VARCHAR(20)), '"}}], "dcterms:date": [{{"type": "literal", "property_id": 7, "@value": "', CAST(CAST(o_orderdate AS DATE) AS VARCHAR(20)), '"}}, 5, {{"type": "uri", "property_id": 7, "@id": "u:', o_orderstatus, '"}}]}}')""".replace("{{", "' || chr(123) || '").replace("}}", "' || chr(125) || '")
RECORDS = f"SELECT o_orderkey AS item_id, {_RECORD} AS raw FROM {{orders}}"


@query("catalogue_values", "SELECT o_orderkey AS item_id, p.pos, CASE p.pos WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS value, CASE p.pos WHEN 2 THEN 'u:' || o_orderstatus END AS uri FROM orders, (SELECT unnest([0, 2]) AS pos) p", items=RECORDS)
def catalogue_values(items: DataFrame) -> DataFrame:
    return C.long_values(items).filter("term = 'dcterms:date'").select("item_id", "pos", "value", "uri")


@query("multi_set_union", "SELECT o_orderkey AS item_id, o_custkey % 5 AS set_id FROM orders WHERE o_custkey % 5 IN (1, 6) AND o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, o_custkey % 7 FROM orders WHERE o_custkey % 7 IN (1, 6) AND o_orderkey % 3 <> 0", items=RECORDS)
def multi_set_union(items: DataFrame) -> DataFrame:
    return C.of_sets(C.of_class(C.with_facets(items), "bibo:Article"), [1, 6]).select("item_id", "set_id")


@query("property_counts", "SELECT 'dcterms:date' AS term, count(*) AS items, 2 * count(*) AS \"values\" FROM orders", items=RECORDS)
def property_counts(items: DataFrame) -> DataFrame:
    return C.property_counts(C.long_values(items)).filter("term = 'dcterms:date'")


@query("set_country", "SELECT item_id, coalesce(nullif(i.country, ''), s.country) AS country FROM items i LEFT JOIN places s ON i.first_set = s.set_id", items="SELECT o_orderkey AS item_id, o_custkey % 40 AS first_set, CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'OWN' WHEN 1 THEN '' END AS country FROM {orders}", places="SELECT n_nationkey AS set_id, n_name AS country FROM {nation}")
def set_country(items: DataFrame, places: DataFrame) -> DataFrame:
    return C.set_country(items.withColumn("sets", F.array("first_set")), places).select("item_id", "country")


@query("file_stubs", r"""SELECT doc_id, coalesce(nullif(substr(regexp_replace(regexp_replace(regexp_replace(title, '^\s+|\s+$', '', 'g'), '[\\/:*?"<>|]', '_', 'g'), '\s+', ' ', 'g'), 1, 180), ''), 'untitled') AS stub FROM docs""", docs="SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN '  ' ELSE concat(' a/b:', text, '? ') END AS title FROM {documents}")
def file_stubs(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", K.file_stub(F.col("title")).alias("stub"))


@query("fingerprints", "SELECT doc_id, substr(sha256(text || 'v3'), 1, 12) AS fingerprint FROM documents", docs="SELECT doc_id, text FROM {documents}")
def fingerprints(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", U.fingerprint(F.col("text"), F.lit("v3")).alias("fingerprint"))


@query("merge_reports", "SELECT coalesce(n.doc_id, o.doc_id) AS doc_id, CASE WHEN n.doc_id IS NOT NULL THEN n.text ELSE o.text END AS text FROM old_ o FULL JOIN new_ n ON o.doc_id = n.doc_id", old_="SELECT doc_id, text FROM {documents} WHERE doc_id % 3 <> 0", new_="SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE concat('new ', lang) END AS text FROM {documents} WHERE doc_id % 2 = 0")
def merge_reports(old_: DataFrame, new_: DataFrame) -> DataFrame:
    return K.merge_keyed(old_, new_, ["doc_id"])


@query("round_robin_shards", "SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) % 7 AS BIGINT) AS shard FROM docs", docs="SELECT doc_id FROM {documents}")
def round_robin_shards(docs: DataFrame) -> DataFrame:
    return D.numbered(docs.withColumn("all", F.lit(1)), "all", ["doc_id"]).select("doc_id", ((F.col("place") - 1) % 7).cast("long").alias("shard"))


@query("line_batches", "SELECT doc_id, i // 20 AS batch, count(*) AS lines FROM (SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM docs) GROUP BY 1, 2", docs="SELECT doc_id, text FROM {documents}")
def line_batches(docs: DataFrame) -> DataFrame:
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    return lines.groupBy("doc_id", F.floor(F.col("i") / 20).cast("long").alias("batch")).agg(F.count(F.lit(1)).alias("lines"))


@query("ladder_separation", "SELECT count(*) AS levels, CASE WHEN count(*) >= 2 THEN max(m) - min(m) >= 0.25 * greatest(1.0, min(m)) END AS separates FROM (SELECT event_type, median(v) AS m FROM runs GROUP BY 1) WHERE m IS NOT NULL", runs="SELECT event_type, CASE WHEN event_type <> 'error' THEN CAST(value AS DOUBLE) END AS v FROM {events}")
def ladder_separation(runs: DataFrame) -> DataFrame:
    return U.ladder_separates(runs.groupBy("event_type").agg(F.median("v").alias("m")), "m")


@query("throughput", "SELECT user_id, count(*) AS items, count(*) FILTER (WHERE event_type <> 'error') AS succeeded, round(100.0::DOUBLE * count(*) FILTER (WHERE event_type <> 'error') / count(*), 6) AS success, round(sum(s)::DOUBLE / count(*), 6) AS seconds_each, round(3600.0::DOUBLE * count(*) / sum(s), 6) AS an_hour FROM runs GROUP BY 1", runs="SELECT user_id, event_type, CAST(1 + event_id % 13 AS BIGINT) AS s FROM {events}")
def throughput(runs: DataFrame) -> DataFrame:
    return U.throughput(runs, ["user_id"], "s", F.col("event_type") != "error")


_DETECTED = """concat(chr(123), '"languages": ["junk", ', chr(123), '"name_en": "', CASE WHEN doc_id % 5 = 0 THEN 'Klingon' ELSE lang END, '", "bcp47": "', CASE WHEN doc_id % 4 = 0 THEN concat('xx-', lang) ELSE concat(lang, '-FR') END,
 '", "share": "', CASE WHEN doc_id % 3 = 0 THEN 'secondary' ELSE 'Dominant ' END, '"', chr(125), ', ', chr(123), '"name_en": "", "bcp47": "de", "share": "dominant"', chr(125), ', ', chr(123), chr(125), ']', chr(125))"""


@query(
    "language_matches",
    """SELECT doc_id, CASE WHEN label IS NULL THEN true WHEN code IS NOT NULL THEN (heard = code AND doc_id % 3 <> 0) OR code = 'de' ELSE strpos(label, 'de') > 0 OR strpos('de', label) > 0 OR (doc_id % 3 <> 0 AND (strpos(label, name) > 0 OR strpos(name, label) > 0)) END AS agrees FROM (SELECT *,
    CASE label WHEN 'français' THEN 'fr' WHEN 'anglais' THEN 'en' WHEN 'allemand' THEN 'de' END AS code, CASE WHEN doc_id % 4 = 0 THEN 'xx' ELSE lang END AS heard, CASE WHEN doc_id % 5 = 0 THEN 'klingon' ELSE lang END AS name FROM docs)""",
    docs=f"SELECT doc_id, lang, CASE lang WHEN 'fr' THEN 'français' WHEN 'en' THEN 'anglais' WHEN 'de' THEN 'allemand' WHEN 'es' THEN CASE WHEN doc_id % 2 = 0 THEN 'es' END END AS label, {_DETECTED} AS payload FROM {{documents}}",
)
def language_matches(docs: DataFrame) -> DataFrame:
    parsed = docs.withColumn("heard", L.parse_detected(F.col("payload")))
    return parsed.select("doc_id", L.agrees(F.col("label"), F.col("heard"), {"francais": "fr", "anglais": "en", "allemand": "de"}).alias("agrees"))


@query("allowed_languages", "SELECT lower(lang) IN ('fr', 'en') OR lower(source) IN ('fr', 'en') AS kept, count(*) AS n FROM docs GROUP BY 1", docs="SELECT upper(lang) AS lang, source FROM {documents}")
def allowed_languages(docs: DataFrame) -> DataFrame:
    return docs.groupBy(L.allowed(F.array("lang", "source"), ["Fr", "EN"]).alias("kept")).agg(F.count(F.lit(1)).alias("n"))


@query("json_payloads", "SELECT id, CASE WHEN id % 6 = 5 THEN said ELSE doc END AS payload FROM answers", answers="""SELECT event_id AS id, doc, CASE CAST(event_id % 6 AS INT) WHEN 0 THEN concat(' ', doc, ' ') WHEN 1 THEN concat('Here:', chr(10), '```json', chr(10), doc, chr(10), '```') WHEN 2 THEN concat('```', doc, '``` done') WHEN 3 THEN concat('Sure, ', doc, ' is it')
 WHEN 4 THEN concat(doc, ' ]') ELSE concat('no ', chr(123), 'json', chr(125)) END AS said FROM (SELECT event_id, concat(chr(123), '"a": [', CAST(user_id AS VARCHAR(20)), ', "x"]', chr(125)) AS doc FROM {events}) x""")
def json_payloads(answers: DataFrame) -> DataFrame:
    return answers.select("id", U.json_payload(F.col("said")).alias("payload"))


@query("finish_kinds", "SELECT event_id, CASE WHEN n = 0 THEN 'retry' WHEN reason = 'RECITATION' THEN 'skip' WHEN reason = 'MAX_TOKENS' THEN CASE WHEN text <> '' THEN 'keep_partial' ELSE 'skip' END WHEN text <> '' THEN 'keep' ELSE 'retry' END AS kind FROM answers", answers="SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 0 ELSE 1 END AS n, CASE CAST(event_id % 3 AS INT) WHEN 0 THEN 'STOP' WHEN 1 THEN 'MAX_TOKENS' ELSE 'RECITATION' END AS reason, CASE WHEN event_id % 5 = 0 THEN '' ELSE event_type END AS text FROM {events}")
def finish_kinds(answers: DataFrame) -> DataFrame:
    return answers.select("event_id", U.finish_kind(F.col("reason"), F.col("n"), F.col("text")).alias("kind"))


@query("clamped_levels", "SELECT event_id, CASE CAST(event_id % 5 AS INT) WHEN 0 THEN 'medium' WHEN 1 THEN CASE WHEN event_id % 2 = 0 THEN 'high' ELSE 'low' END WHEN 2 THEN CASE WHEN event_id % 2 = 0 THEN 'high' ELSE 'low' END WHEN 3 THEN 'odd' END AS level FROM asked", asked="SELECT event_id, CASE CAST(event_id % 5 AS INT) WHEN 0 THEN ' Medium' WHEN 1 THEN 'medium' WHEN 2 THEN 'minimal' WHEN 3 THEN 'odd' END AS level, CASE WHEN event_id % 5 = 0 THEN 'all' WHEN event_id % 2 = 0 THEN 'two' ELSE 'three' END AS kind FROM {events}")
def clamped_levels(asked: DataFrame) -> DataFrame:
    ladders = {"all": ["low", "medium", "high"], "two": ["high", "max"], "three": ["none", "low", "max"]}
    supported = F.when(F.col("kind") == "all", F.array(*map(F.lit, ladders["all"]))).when(F.col("kind") == "two", F.array(*map(F.lit, ladders["two"]))).otherwise(F.array(*map(F.lit, ladders["three"])))
    return asked.select("event_id", U.clamped(F.col("level"), supported).alias("level"))


@query("segment_marks", "SELECT doc_id, list_transform(range(0, n), lambda i: i + 1) AS failed, n AS segments, 20 AS minutes, '[Segment 2/3 | 00:20:00–00:40:00]' || chr(10) || 'a$1' AS spliced FROM (SELECT doc_id, CAST(1 + doc_id % 3 AS INT) AS n FROM docs)", docs="SELECT doc_id FROM {documents}")
def segment_marks(docs: DataFrame) -> DataFrame:
    n = (F.col("doc_id") % 3 + 1).cast("int")
    mark = lambda i: T.failed_mark(i, T.segment_mark(i, F.lit(3), F.lit(20)), F.lit("API-503"))
    text = F.concat(F.lit(f"Segment length: 20 minutes\n{S.RULE}\nSegment length: 99 minutes\n"), F.array_join(F.transform(F.sequence(F.lit(1), n), mark), "\n"))
    made = docs.withColumn("text", text)
    two = T.spliced(T.failed_mark(F.lit(2), T.segment_mark(F.lit(2), F.lit(3), F.lit(20)), F.lit("API-503")), F.lit(2), F.lit("a$1"))
    return made.select("doc_id", *T.segment_facts(F.col("text")), two.alias("spliced"))


@query("transcription_parts", """+ p AS (SELECT conv_id, count(*) AS files, string_agg(CASE WHEN t = '' THEN NULL WHEN n > 1 THEN chr(10) || repeat('=', 60) || chr(10) || '[Part ' || CAST(turn AS VARCHAR) || ']' || chr(10) || repeat('=', 60) || chr(10) || chr(10) || t ELSE t END, chr(10) ORDER BY turn) AS text FROM (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS t FROM said) GROUP BY 1)
 SELECT 'c' || CAST(conv_id AS VARCHAR) AS identifier, files, regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g') AS text FROM p""", said="SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 6 = 0 THEN ' ' ELSE concat(text, ' ') END AS text FROM {conversations}")
def transcription_parts(said: DataFrame) -> DataFrame:
    name = F.format_string("c%d-%02d_transcription.txt", "conv_id", "turn")
    return T.joined_parts(said.withColumn("name", name).select("name", "text", *T.name_parts(name)))


@query("review_partition", "SELECT CASE WHEN lower(trim(action)) IN ('create', 'skip') THEN lower(trim(action)) END AS action, count(*) AS n FROM rows_ GROUP BY 1", rows_="SELECT CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN ' Create' WHEN 1 THEN 'SKIP ' WHEN 2 THEN 'later' END AS action FROM {orders}")
def review_partition(rows_: DataFrame) -> DataFrame:
    return rows_.groupBy(P.review_action(F.col("action")).alias("action")).agg(F.count(F.lit(1)).alias("n"))


@query("spatial_self_filter", "SELECT doc_id, array_to_string(list_filter([lang, upper(source), 'Togo'], lambda x: own IS NULL OR lower(x) <> lower(own)), '|') AS places FROM docs", docs="SELECT doc_id, lang, source, CASE CAST(doc_id % 3 AS INT) WHEN 0 THEN source WHEN 1 THEN 'TOGO' END AS own FROM {documents}")
def spatial_self_filter(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.array_join(P.without_own_place(F.array("lang", F.upper("source"), F.lit("Togo")), F.col("own")), "|").alias("places"))


@query("links_added", "SELECT status, count(*) AS items, CAST(sum(CASE WHEN status = 'would_update' THEN added ELSE 0 END) AS BIGINT) AS links FROM (SELECT k, CASE WHEN added = 0 THEN 'unchanged' ELSE 'would_update' END AS status, added FROM (SELECT l_orderkey AS k, count(DISTINCT CASE WHEN l_partkey % 2 = 0 THEN l_partkey END) - count(DISTINCT CASE WHEN l_partkey % 2 = 0 AND l_partkey % 3 = 0 THEN l_partkey END) AS added FROM lines GROUP BY 1)) GROUP BY 1", lines="SELECT l_orderkey, l_partkey FROM {lineitem}")
def links_added(lines: DataFrame) -> DataFrame:
    both = lines.groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_set(F.when(F.col("l_partkey") % 3 == 0, F.col("l_partkey").cast("long"))).alias("have"), F.collect_set(F.when(F.col("l_partkey") % 2 == 0, F.col("l_partkey").cast("long"))).alias("new"))
    both = both.withColumn("after", P.append_links(F.col("have"), F.col("new"))).withColumn("added", F.size("after") - F.size("have"))
    status = F.when(F.col("added") == 0, "unchanged").otherwise("would_update")
    return both.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("items"), F.sum(F.when(F.col("added") > 0, F.col("added")).otherwise(0)).alias("links"))


CHUNK = 2000


@query("chunk_text", docs="SELECT doc_id, replace(text, '. ', concat('.', chr(10), chr(10))) AS text FROM {documents}")
def chunk_text(docs: DataFrame) -> DataFrame:
    return D.chunk_text(docs, "doc_id", "text", CHUNK)


def round_trip(name: str, oracle: str, **inputs: str):
    """Registers a query that writes its input to a fresh shared folder and reads it again."""

    def put(operator):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return operator(spark, scratch(spark, name), **{k: derive(spark, sf_dir, v) for k, v in inputs.items()})

        QUERIES[name], ORACLES[name] = run, oracle
        return operator

    return put


@round_trip("csv_round_trip", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name || ' \"x\"' || chr(10) || c_mktsegment || ',' AS note FROM customer", rows="SELECT CAST(c_custkey AS STRING) AS id, concat(c_name, ' \"x\"', chr(10), c_mktsegment, ',') AS note FROM {customer}")
def csv_round_trip(spark, path, rows):
    K.append_csv(rows, path)
    return S.checked_csv(spark, path, ["id", "note"])


@round_trip("jsonl_round_trip", "SELECT event_id, event_type FROM events WHERE event_type <> 'error' AND event_id % 3 <> 0", rows="SELECT event_id, event_type, CAST(event_id % 3 AS STRING) AS v FROM {events}")
def jsonl_round_trip(spark, path, rows):
    K.append_valid(rows, path, F.col("event_type") != "error")
    lines = S.log_lines(spark, path).withColumn("line", F.when(F.col("line").contains('"v":"0"'), F.lit('{"event_id": 1, "ev')).otherwise(F.col("line")))
    return S.log_records(lines, "event_id long, event_type string").select("event_id", "event_type")


@round_trip("text_round_trip", "SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS title, r_name || chr(10) || chr(10) || 'text: x' AS body FROM region", rows="SELECT r_regionkey AS id, r_name, concat(r_name, chr(10), chr(10), 'text: x') AS r_comment FROM {region}")
def text_round_trip(spark, path, rows):
    K.write_parts(rows.select("id", K.with_header({"Title": F.col("r_name"), "None": F.lit(None).cast("string")}, F.col("r_comment")).alias("text")), path, ["id"])
    files = S.whole_files(spark, path, "part-*").select(F.regexp_extract("folder", "^id=([0-9]+)$", 1).cast("long").alias("id"), "text")
    read = files.select("id", *S.header_and_body(F.col("text")))
    return read.select("id", F.col("header")["Title"].alias("title"), "body")


@round_trip(
    "page_round_trip",
    "SELECT s_suppkey % 8 AS page, CAST((dense_rank() OVER (PARTITION BY s_suppkey % 8 ORDER BY s_suppkey) - 1) AS INTEGER) AS block, l.line, p.tok, CASE p.tok WHEN 0 THEN s_name ELSE 'k' || CAST(s_nationkey + l.line AS VARCHAR) END AS content, CASE p.tok WHEN 0 THEN CAST(s_suppkey AS DOUBLE) END AS hpos FROM supplier, (SELECT unnest([0, 1]) AS tok) p, (SELECT unnest([0, 1]) AS line) l",
    rows="SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey FROM {supplier}",
)
def page_round_trip(spark, path, rows):
    line = '<TextLine><String CONTENT="%s" HPOS="%d"/><String CONTENT="k%d" HPOS="none"/></TextLine>'
    xml = F.format_string(f"<PrintSpace><TextBlock>{line}{line}</TextBlock></PrintSpace>", "s_name", "s_suppkey", "s_nationkey", "s_name", "s_suppkey", F.col("s_nationkey") + 1)
    blocks = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", xml.alias("x")))), lambda b: b["x"]), "\n")
    K.write_parts(rows.groupBy((F.col("s_suppkey") % 8).alias("page")).agg(F.concat(F.lit('<alto xmlns="http://a/b">'), blocks, F.lit("</alto>")).alias("text")), path, ["page"])
    read = S.page_tokens(spark, path)
    return read.select(F.regexp_extract("path", "page=([0-9]+)/", 1).cast("long").alias("page"), "block", "line", "tok", "content", "hpos")


def _listing(spark: SparkSession, path: str, items: DataFrame) -> DataFrame:
    record_pages(items, path, 50)
    return read_listing(spark, path, 50)


LISTED = f"SELECT item_id % 4 AS set_id, item_id, raw FROM ({RECORDS}) r"


@round_trip("listed_items", "SELECT * FROM (SELECT o_orderkey % 4 AS set_id, CAST((row_number() OVER (PARTITION BY o_orderkey % 4 ORDER BY o_orderkey) - 1) // 50 + 1 AS INTEGER) AS page, CAST((row_number() OVER (PARTITION BY o_orderkey % 4 ORDER BY o_orderkey) - 1) % 50 AS INTEGER) AS pos, o_orderkey AS item_id, 2 AS classes FROM orders) WHERE set_id IN (1, 3) AND item_id % 3 <> 0", items=LISTED)
def listed_items(spark, path, items):
    listed = _listing(spark, path, items).filter(F.col("set_id").isin(1, 3))
    return C.of_class(C.with_facets(listed), "bibo:Article").select("set_id", "page", "pos", "item_id", F.size("classes").alias("classes"))


@round_trip("listed_pages", "SELECT o_orderkey AS item_id FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderkey % 4 ORDER BY o_orderkey) AS n FROM orders) WHERE o_orderkey % 4 = 2 AND n BETWEEN 51 AND 150", items=LISTED)
def listed_pages(spark, path, items):
    return _listing(spark, path, items).filter("set_id = 2 and page in (2, 3)").select("item_id")


_ARTICLE = "named_struct('titre', concat(role, ' ', CAST(turn AS STRING)), 'auteurs', CASE WHEN turn % 2 = 1 THEN array(role, 'x') ELSE array() END, 'pages', CAST(turn AS STRING), 'resume', text)"


@round_trip(
    "index_rollup",
    """SELECT conv_id AS doc_id, CAST(count(*) AS INTEGER) AS articles,
    string_agg('p. ' || CAST(turn AS VARCHAR) || ' : ' || role || ' ' || CAST(turn AS VARCHAR) || CASE WHEN turn % 2 = 1 THEN ' (' || role || ', x)' ELSE '' END || chr(10) || text, chr(10) || chr(10) ORDER BY turn) AS contents,
    '# Index des articles du magazine' || chr(10) || chr(10) || string_agg(chr(10) || '## ' || role || ' ' || CAST(turn AS VARCHAR) || chr(10) || CASE WHEN turn % 2 = 1 THEN '- Auteur(s) : ' || role || ', x' || chr(10) ELSE '' END || '- Pages : ' || CAST(turn AS VARCHAR) || chr(10) || '- Résumé :' || chr(10) || '  ' || text, chr(10) ORDER BY turn) AS markdown
    FROM conversations GROUP BY 1""",
    pages=f"SELECT conv_id AS doc_id, turn AS page, array({_ARTICLE}) AS articles FROM {{conversations}}",
)
def index_rollup(spark, path, pages):
    N.write_indexes(N.rolled_up(pages), path)
    read = N.read_indexes(spark, path)
    return read.select("doc_id", F.size("articles").alias("articles"), N.contents(F.col("articles")).alias("contents"), "markdown")


@query(
    "produced_limit",
    """SELECT n.n, count(*) AS seen, count(*) FILTER (WHERE ok) AS produced, max(doc_id) AS last FROM (SELECT unnest([1, 7, 400, 100000]) AS n) n,
    (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (ORDER BY doc_id) AS c FROM docs) d WHERE c < n.n OR (c = n.n AND ok) GROUP BY 1""",
    docs="SELECT doc_id, n_chars > 500 AND lang IN ('fr', 'en') AS ok FROM {documents}",
)
def produced_limit(docs: DataFrame) -> DataFrame:
    one = lambda n: M.until_produced(docs, "doc_id", F.col("ok"), n).agg(F.lit(n).alias("n"), F.count(F.lit(1)).alias("seen"), F.count_if("ok").alias("produced"), F.max("doc_id").alias("last"))
    return reduce(DataFrame.unionAll, map(one, (1, 7, 400, 100_000)))


@query(
    "two_stage_sample",
    """+ p AS (SELECT page FROM (SELECT DISTINCT page FROM docs) ORDER BY sha256('42:' || page), page LIMIT 8),
    i AS (SELECT * FROM docs SEMI JOIN p USING (page) QUALIFY row_number() OVER (PARTITION BY page ORDER BY sha256('42:' || page || ':' || doc_id), doc_id) <= 6)
    SELECT doc_id, page FROM i ORDER BY sha256('42:' || doc_id), doc_id LIMIT 40""",
    docs="SELECT doc_id, CAST(floor(doc_id / 10) AS BIGINT) AS page FROM {documents}",
)
def two_stage_sample(docs: DataFrame) -> DataFrame:
    return M.page_sample(docs, "page", "doc_id", 8, 6, 40, 42).select("doc_id", "page")


@query("items_having", "SELECT o_orderkey AS item_id, 'any' AS asked FROM orders UNION ALL SELECT o_orderkey, 'one' FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1995-03-05'", items=RECORDS)
def items_having(items: DataFrame) -> DataFrame:
    values = C.long_values(items)
    one = lambda found, name: found.select("item_id", F.lit(name).alias("asked"))
    return one(C.having(items, values, 7), "any").unionAll(one(C.having(items, values, 7, "1995-03-05"), "one"))


_REVERSE = """concat(chr(123), '"@reverse": ', chr(123), '"dcterms:subject": [', chr(123), '"@id": "http://h/api/resources/', CAST(o_custkey AS VARCHAR(20)), '"', chr(125), ', 5, "', CAST(o_orderkey AS VARCHAR(20)), '", ', chr(123), '"x": 1', chr(125), ']', chr(125), chr(125))"""


@query("back_link_ids", "SELECT o_orderkey AS item_id, p.pos, CASE p.pos WHEN 0 THEN CAST(o_custkey AS BIGINT) WHEN 1 THEN 5 WHEN 2 THEN CAST(o_orderkey AS BIGINT) END AS ref_id FROM orders, (SELECT unnest([0, 1, 2, 3]) AS pos) p", items=f"SELECT o_orderkey AS item_id, {_REVERSE} AS raw FROM {{orders}}")
def back_link_ids(items: DataFrame) -> DataFrame:
    return C.back_links(items, "dcterms:subject").select("item_id", "pos", "ref_id")


@round_trip("work_list_round_trip", "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation", rows="SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM {nation}")
def work_list_round_trip(spark, path, rows):
    K.write_report(spark, rows, path)
    return S.work_list(spark, path, "struct<id: bigint, name: string>")


@round_trip("versions_round_trip", "SELECT c_custkey, c_name FROM customer WHERE c_custkey % 2 = 0", rows="SELECT c_custkey, c_name FROM {customer}")
def versions_round_trip(spark, path, rows):
    commit(rows, path)
    commit(current(spark, path).filter("c_custkey % 2 = 0"), path)
    return current(spark, path)
