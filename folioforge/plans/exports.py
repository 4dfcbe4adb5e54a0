"""Article blocks, vocabularies, batch reports, transcripts and settings over the driver tables, with SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import sinks as K
from ..functions import values as V
from ..operators import batches as B
from ..operators import exports as E
from ..operators import language as L
from ..operators import ontology as O
from ..operators import runtime as U
from ..operators import transcripts as T
from ..operators import upsert as P
from ..sources import files as S
from .base import query
from .documents import GRAMS, TIDIED
from .sources import round_trip


@query(
    "article_blocks",
    f"""+{TIDIED} SELECT d.doc_id, '## ' || CASE WHEN title <> '' THEN title ELSE 'No title' END || chr(10) || '**Journal :** ' || CASE WHEN doc_id % 7 = 0 THEN 'Inconnu' ELSE source || '; ' || lang END
    || ' | **Date :** ' || coalesce(nullif(date, ''), 'Inconnu') || CASE WHEN country <> '' THEN ' | **Pays :** ' || country ELSE '' END || ' | **Item :** [' || doc_id || '](http://h/s/fr/item/' || doc_id || ')'
    || chr(10) || chr(10) || CASE WHEN summary IS NOT NULL THEN '**Résumé (IA) :** ' || summary || chr(10) || chr(10) ELSE '' END || CASE WHEN t.text <> '' THEN t.text || chr(10) || chr(10) ELSE '' END || '---' || chr(10) AS block
    FROM docs d JOIN tidied t USING (doc_id) WHERE doc_id <> 0
    UNION ALL SELECT doc_id, '## No title' || chr(10) || '**Journal :** Inconnu | **Date :** Inconnu' || chr(10) || chr(10) || CASE WHEN t.text <> '' THEN t.text || chr(10) || chr(10) ELSE '' END || '---' || chr(10) FROM docs d JOIN tidied t USING (doc_id) WHERE doc_id = 0""",
    docs="""SELECT doc_id, source, lang, text, CASE WHEN doc_id % 5 = 0 THEN '' ELSE concat('T ', CAST(doc_id AS VARCHAR(20))) END AS title, CASE CAST(doc_id % 3 AS INT) WHEN 0 THEN NULL WHEN 1 THEN '' ELSE '1998-02-16' END AS date,
    CASE WHEN doc_id % 4 = 1 THEN 'Togo' WHEN doc_id % 4 = 2 THEN '' END AS country, CASE WHEN doc_id % 6 = 1 THEN concat('R ', lang) END AS summary FROM {documents}""",
)
def article_blocks(docs: DataFrame) -> DataFrame:
    publishers = F.when(F.col("doc_id") % 7 == 0, F.array().cast("array<string>")).otherwise(F.array("source", "lang"))
    url = E.page_url(F.lit("http://h/api/"), F.col("doc_id"), "fr")
    return docs.select("doc_id", E.article_block(F.col("title"), F.col("date"), publishers, F.col("country"), F.col("doc_id"), F.col("text"), F.col("summary"), url).alias("block"))


@query("item_urls", "SELECT o_orderkey AS item_id, CASE WHEN o_custkey % 2 = 0 THEN 'http://h/api/items/' ELSE 'http://h/items/' END || o_orderkey AS api, 'http://h/s/en/item/' || o_orderkey AS page FROM orders", items="SELECT o_orderkey AS item_id, CASE CAST(o_custkey % 4 AS INT) WHEN 0 THEN 'http://h/api' WHEN 1 THEN 'http://h' WHEN 2 THEN 'http://h/api//' ELSE 'http://h/' END AS base FROM {orders}")
def item_urls(items: DataFrame) -> DataFrame:
    base, item = F.col("base"), F.col("item_id")
    return items.select("item_id", E.api_url(base, item).alias("api"), E.page_url(base, item, "en").alias("page"))


FIELDS = (
    O.FieldTemplate("Tone", {"en": "{label} - Tone", "fr": "{label} - Ton"}, {"en": "Tone as {label} ({model_id}) sees it", "fr": "Ton selon {label} ({model_id})"}),
    O.FieldTemplate("Reason", {"en": "{label} - Reason", "fr": "{label} - Motif"}, {"en": "Why {label} says so", "fr": "Pourquoi, selon {label} {autre}"}, "owl:DatatypeProperty", "xsd:string"),
)


@query(
    "model_terms",
    """SELECT prefix || f.suffix AS term, f.place, f.lang, label || ' - ' || f.word AS label, CASE f.place * 2 + CAST(f.lang = 'fr' AS INTEGER) WHEN 0 THEN 'Tone as ' || label || ' (' || model_id || ') sees it' WHEN 1 THEN 'Ton selon ' || label || ' (' || model_id || ')'
    WHEN 2 THEN 'Why ' || label || ' says so' ELSE 'Pourquoi, selon ' || label || ' ' || chr(123) || 'autre' || chr(125) END AS comment, CASE f.place WHEN 0 THEN 'owl:ObjectProperty' ELSE 'owl:DatatypeProperty' END AS kind, CASE f.place WHEN 1 THEN 'xsd:string' END AS "values"
    FROM members, (VALUES ('Tone', 0, 'en', 'Tone'), ('Tone', 0, 'fr', 'Ton'), ('Reason', 1, 'en', 'Reason'), ('Reason', 1, 'fr', 'Motif')) f(suffix, place, lang, word)""",
    members="SELECT concat('m', CAST(s_suppkey AS VARCHAR(20))) AS prefix, s_name AS label, concat('id/', CAST(s_nationkey AS VARCHAR(20))) AS model_id FROM {supplier}",
)
def model_terms(members: DataFrame) -> DataFrame:
    return O.definitions(members, FIELDS)


@query("turtle_statements", "SELECT n_name AS term, 'x:' || n_name || ' a rdf:Property ;' || chr(10) || '  rdfs:label \"a \\\"' || n_name || '\\\"\"@fr ;' || chr(10) || '  rdfs:comment \"b\\\\c\"@fr .' AS text FROM nation", rows="SELECT n_name AS term, concat('a \"', n_name, '\"') AS label, 'fr' AS lang, concat('b', chr(92), 'c') AS comment FROM {nation}")
def turtle_statements(rows: DataFrame) -> DataFrame:
    return K.turtle(rows, "x")


@query(
    "vocabulary_replacement",
    """SELECT name, 'would_delete' AS change, coalesce(n, 0) AS items FROM installed LEFT JOIN (SELECT property_id, count(DISTINCT item_id) AS n FROM values_ GROUP BY 1) USING (property_id) WHERE name NOT IN (SELECT name FROM declared)
    UNION ALL SELECT DISTINCT name, 'would_add', 0 FROM declared WHERE name NOT IN (SELECT name FROM installed)""",
    installed="SELECT p_brand AS name, min(p_partkey) AS property_id FROM {part} GROUP BY p_brand UNION ALL SELECT 'never used', -1 UNION ALL SELECT 'kept', -2",
    declared="SELECT 'kept' AS name UNION ALL SELECT concat(p_brand, CASE WHEN p_partkey % 2 = 0 THEN '' ELSE '+' END) FROM {part} WHERE p_partkey % 7 < 2",
    values_="SELECT l_partkey AS property_id, l_orderkey AS item_id FROM {lineitem}",
)
def vocabulary_replacement(installed: DataFrame, declared: DataFrame, values_: DataFrame) -> DataFrame:
    return O.replacement(installed, declared, values_)


_PAGES = "SELECT CAST(l_orderkey % 50 AS BIGINT) AS batch, CAST(l_orderkey AS BIGINT) AS file, CAST(l_linenumber AS BIGINT) AS page, l_partkey % 3 <> 1 AS ok, CAST(l_orderkey AS BIGINT) * 1000 AS bytes, l_orderkey % 11 <> 0 AS written FROM {lineitem}"


@query("file_results", "SELECT batch, file, count(*) AS pages, count(*) FILTER (WHERE ok) AS successful, coalesce(string_agg(page, ',' ORDER BY page) FILTER (WHERE NOT ok), '') AS failed, round(100.0::DOUBLE * count(*) FILTER (WHERE ok) / count(*), 6) AS success, max(bytes) AS bytes, count(*) FILTER (WHERE ok) > 0 AND bool_or(written) AS ok FROM pages_ GROUP BY 1, 2", pages_=_PAGES)
def file_results(pages_: DataFrame) -> DataFrame:
    return B.file_results(pages_).withColumn("failed", F.array_join(F.col("failed").cast("array<string>"), ",")).withColumn("success", F.round("success", 6))


@query("batch_report", "+ f AS (SELECT batch, file, count(*) AS n, count(*) FILTER (WHERE ok) AS s, max(bytes) AS b, bool_or(written) AS w FROM pages_ GROUP BY 1, 2) SELECT batch, count(*) AS files, count(*) FILTER (WHERE s > 0 AND w) AS processed, count(*) FILTER (WHERE NOT (s > 0 AND w)) AS failed, round(100.0::DOUBLE * sum(s) / sum(n), 6) AS success, round(coalesce(sum(b) FILTER (WHERE s > 0 AND w), 0)::DOUBLE / 1048576, 6) AS mb FROM f GROUP BY 1", pages_=_PAGES)
def batch_report(pages_: DataFrame) -> DataFrame:
    return B.batch_report(B.file_results(pages_)).withColumn("success", F.round("success", 6)).withColumn("mb", F.round("mb", 6))


@query("audio_segments", "SELECT doc_id, i AS number, (i - 1) * 600 AS start, least(i * 600, d) AS stop FROM (SELECT doc_id, d, CAST(unnest(range(1, greatest(CAST(ceil(d / 600.0) AS BIGINT), 1) + 1)) AS INTEGER) AS i FROM docs WHERE d IS NOT NULL)", docs="SELECT doc_id, CASE WHEN doc_id % 40 = 0 THEN NULL WHEN doc_id % 40 = 1 THEN 600 ELSE CAST(n_chars AS BIGINT) END AS d FROM {documents}")
def audio_segments(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.explode(B.segment_plan(F.col("d"), F.lit(600))).alias("s")).select("doc_id", "s.*")


@query("rough_durations", "SELECT event_id, CASE WHEN s >= 86400 THEN '~' || s // 86400 || 'd ' || s % 86400 // 3600 || 'h' WHEN s >= 3600 THEN '~' || s // 3600 || 'h ' || s % 3600 // 60 || 'm' ELSE '~' || s // 60 || 'm' END AS said FROM spans", spans="SELECT event_id, CAST(event_id * 977 % 400000 AS BIGINT) AS s FROM {events}")
def rough_durations(spans: DataFrame) -> DataFrame:
    return spans.select("event_id", B.rough_duration(F.col("s")).alias("said"))


@query("window_notes", "SELECT doc_id, n, CASE WHEN n = 1 THEN '' ELSE chr(10) || '## Part 2 of ' || n || chr(10) || '- This part runs from 00:59:45 to 02:00:00; give times counted from the start of the whole recording.' || CASE WHEN doc_id % 2 = 0 THEN chr(10) || '- Leave out what begins before 01:00:00: it is in the part before.' ELSE '' END || chr(10) || '- Write the transcript only.' END AS note FROM docs", docs="SELECT doc_id, 1 + n_chars % 3 AS n FROM {documents}")
def window_notes(docs: DataFrame) -> DataFrame:
    new_from = F.when(F.col("doc_id") % 2 == 0, 3600).otherwise(3585)
    return docs.select("doc_id", "n", B.window_note(F.lit(2), F.col("n"), F.lit(3585), F.lit(7200), new_from).alias("note"))


@query(
    "media_file_names",
    """SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'a_b_' || page_id || '.MP3' ELSE page_id || '-' || (page_id + 1) || CASE CAST(page_id % 4 AS INTEGER) WHEN 1 THEN '.mp4' WHEN 2 THEN CASE WHEN page_id % 3 = 0 THEN '.mp4' WHEN page_id % 3 = 1 THEN '.mp3' ELSE '' END ELSE '' END END AS name,
    CASE CAST(page_id % 4 AS INTEGER) WHEN 0 THEN 'audio' WHEN 1 THEN 'video' ELSE 'unknown' END AS kind FROM media""",
    media="SELECT page_id, CASE CAST(page_id % 4 AS INT) WHEN 0 THEN concat(' a/b:', CAST(page_id AS VARCHAR(20)), '.MP3. ') WHEN 1 THEN '' END AS source, CASE CAST(page_id % 4 AS INT) WHEN 0 THEN 'http://h/x.mp3?a=b/c' WHEN 1 THEN 'http://h/x.y/film.v2.MP4' ELSE concat('http://h.x/', CAST(page_id AS VARCHAR(20))) END AS url, CASE WHEN page_id % 4 = 3 THEN NULL WHEN page_id % 3 = 0 THEN 'video/mpeg' WHEN page_id % 3 = 1 THEN 'audio/ogg' ELSE 'image/png' END AS type FROM {pages}",
)
def media_file_names(media: DataFrame) -> DataFrame:
    name = E.media_file_name(F.col("source"), F.col("page_id"), F.col("page_id") + 1, F.col("url"), F.col("type"))
    return media.select("page_id", name.alias("name"), S.media_kind(F.col("url")).alias("kind"))


@query(
    "upload_gate",
    f"""+{GRAMS} SELECT doc_id AS id, CASE WHEN regexp_matches(text, '^\\s*$') THEN 'empty transcript' WHEN n_words >= 36 AND n >= 20 THEN 'degenerate repeating output (looping-' || n || 'x)' WHEN doc_id % 3 = 1 THEN 'incomplete (3/5 windows)' ELSE 'ready' END AS status FROM docs JOIN w USING (doc_id) LEFT JOIN b USING (doc_id)""",
    docs="SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN concat(' ', chr(10)) ELSE text END AS text FROM {documents}",
)
def upload_gate(docs: DataFrame) -> DataFrame:
    chunks = F.when(F.col("doc_id") % 3 == 0, "5/5").when(F.col("doc_id") % 3 == 1, " 3 / 5")
    rows = docs.select(F.col("doc_id").alias("id"), F.map_filter(F.create_map(F.lit("Chunks"), chunks), lambda k, v: v.isNotNull()).alias("header"), F.col("text").alias("body"))
    return T.upload_gate(rows).select("id", "status")


@query("matched_transcripts", "SELECT g.identifier, min(o.item_id) AS item_id, CASE WHEN min(o.item_id) IS NULL THEN 'not_found' ELSE 'found' END AS \"match\" FROM groups_ g LEFT JOIN items o USING (identifier) GROUP BY 1", groups_="SELECT DISTINCT concat('c', CAST(conv_id AS VARCHAR(20))) AS identifier FROM {conversations}", items="SELECT concat('c', CAST(o_custkey AS VARCHAR(20))) AS identifier, o_orderkey AS item_id FROM {orders}")
def matched_transcripts(groups_: DataFrame, items: DataFrame) -> DataFrame:
    return T.matched_items(groups_, items)


@query(
    "linked_languages",
    "SELECT item_id, name, code, coalesce(l.label, name || ' (' || code || ')') AS label, r.id AS record_id FROM detected d LEFT JOIN (SELECT code AS c, min(label) AS label FROM labels_ GROUP BY 1) l ON lower(split_part(d.code, '-', 1)) = l.c LEFT JOIN (SELECT lower(title) AS t, min(id) AS id FROM authority GROUP BY 1) r ON lower(l.label) = r.t",
    detected="SELECT doc_id AS item_id, source AS name, concat(upper(lang), '-FR') AS code FROM {documents}",
    labels_="SELECT DISTINCT lang AS code, concat('L ', lang) AS label FROM {documents} WHERE lang <> 'es' UNION ALL SELECT 'fr', 'Z'",
    authority="SELECT CAST(n_nationkey AS BIGINT) AS id, CASE WHEN n_nationkey % 2 = 0 THEN 'l FR' ELSE 'L en' END AS title FROM {nation}",
)
def linked_languages(detected: DataFrame, labels_: DataFrame, authority: DataFrame) -> DataFrame:
    return L.linked(detected, labels_, authority)


@query(
    "segment_retries",
    "SELECT s.id, s.pos, f.path, CASE WHEN s.id % 3 = 0 THEN 'refused' WHEN f.path IS NULL THEN 'failed' ELSE 'ready' END AS status FROM states s LEFT JOIN files f ON s.id = f.id AND s.pos = f.pos",
    states="SELECT conv_id AS id, CAST(turn AS INT) AS pos FROM {conversations} WHERE turn % 2 = 0",
    files="SELECT conv_id AS id, CAST(turn AS INT) AS pos, concat('f', CAST(turn AS VARCHAR(20))) AS path FROM {conversations} WHERE turn % 4 <> 0",
)
def segment_retries(states: DataFrame, files: DataFrame) -> DataFrame:
    cut = F.when(F.col("id") % 3 == 0, 20).when(F.col("id") % 3 == 1, 10)
    return T.retries(states.groupBy("id").agg(F.collect_list("pos").alias("failed")).withColumn("minutes", cut), files, 10)


@query("generator_counts", "SELECT source AS generator, count(*) AS n, (SELECT count(DISTINCT source) > 1 FROM docs) AS mixed FROM docs GROUP BY 1", docs="SELECT source FROM {documents}")
def generator_counts(docs: DataFrame) -> DataFrame:
    return T.generators(docs.select(F.col("source").alias("generator")))


@query("chunk_join", "SELECT conv_id, string_agg(CASE WHEN turn = first THEN t ELSE '--- w' || turn || ' ---' || chr(10) || chr(10) || t END, chr(10) || chr(10) ORDER BY turn) AS text, count(*) AS n_parts FROM (SELECT *, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS t, min(turn) OVER (PARTITION BY conv_id) AS first FROM said WHERE text IS NOT NULL) GROUP BY 1", said="SELECT conv_id, turn, concat('w', CAST(turn AS VARCHAR(20))) AS label, CASE WHEN (conv_id + turn) % 5 = 0 THEN NULL ELSE concat(' ', text, chr(10)) END AS text FROM {conversations}")
def chunk_join(said: DataFrame) -> DataFrame:
    return T.joined_chunks(said, "conv_id", "turn", "label", "text")


@query("file_states", "SELECT doc_id, CASE CAST(doc_id % 4 AS INTEGER) WHEN 0 THEN 'new' WHEN 1 THEN 'new' WHEN 2 THEN 'retry' ELSE CASE WHEN regexp_matches(text, '^\\s*$') THEN 'new' ELSE 'complete' END END AS state FROM docs", docs="SELECT doc_id, CASE CAST(doc_id % 4 AS INT) WHEN 0 THEN NULL WHEN 1 THEN concat(' ', chr(10)) WHEN 2 THEN concat(text, ' [Segment 2/3 | 00:20:00] TRANSCRIPTION FAILED (503)') ELSE text END AS text FROM {documents}")
def file_states(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", T.file_state(F.col("text")).alias("state"))


@query("attached_media", "SELECT item_id, p.pos, k.media_id, k.url FROM items i, (VALUES (0), (1)) p(pos) JOIN media k ON k.media_id = CASE p.pos WHEN 0 THEN i.a ELSE i.b END WHERE k.media_id % 3 <> 2", items="SELECT o_orderkey AS item_id, CAST(o_custkey AS BIGINT) AS a, CAST(o_custkey + 1 AS BIGINT) AS b FROM {orders}", media="SELECT CAST(c_custkey AS BIGINT) AS media_id, concat('http://h/', CAST(c_custkey AS VARCHAR(20)), CASE CAST(c_custkey % 3 AS INT) WHEN 0 THEN '.PDF?x=1.txt' WHEN 1 THEN '.mp3' ELSE '.txt' END) AS url FROM {customer}")
def attached_media(items: DataFrame, media: DataFrame) -> DataFrame:
    return S.attached_media(items.select("item_id", F.array("a", "b").alias("media")), media, ("pdf", "mp3"))


@query("newest_order_file", "SELECT max_by(path, (modified, path)) AS path FROM files", files="SELECT concat('f', CAST(o_orderkey AS VARCHAR(20))) AS path, CAST(o_orderdate AS DATE) AS modified FROM {orders}")
def newest_order_file(files: DataFrame) -> DataFrame:
    return S.newest(files)


@query("linked_values", "SELECT l_orderkey AS item_id, string_agg(l_partkey, '|' ORDER BY l_linenumber, l_partkey) FILTER (WHERE l_partkey % 3 <> 0) AS ids, bool_or(l_suppkey % 20 = 7) AS written FROM lines GROUP BY 1", lines="SELECT l_orderkey, l_linenumber, CAST(l_partkey AS BIGINT) AS l_partkey, CAST(l_suppkey AS BIGINT) AS l_suppkey FROM {lineitem}")
def linked_values(lines: DataFrame) -> DataFrame:
    one = F.struct("l_linenumber", F.when(F.col("l_partkey") % 3 != 0, F.col("l_partkey")).alias("id"), (F.col("l_suppkey") % 20).alias("property_id"))
    items = lines.groupBy(F.col("l_orderkey").alias("item_id")).agg(F.array_sort(F.collect_list(one)).alias("values"))
    return items.select("item_id", F.nullif(V.linked_ids(F.col("values")), F.lit("")).alias("ids"), P.already_written(F.col("values"), 7).alias("written"))


@query("vocabulary_ids", "SELECT item_id, term, value_id FROM ratings JOIN vocabulary USING (term, label) WHERE trim(label) <> ''", ratings="SELECT event_id AS item_id, event_type AS term, CASE CAST(user_id % 4 AS INT) WHEN 0 THEN ' ' WHEN 1 THEN 'low' WHEN 2 THEN 'high' ELSE 'odd' END AS label FROM {events}", vocabulary="SELECT DISTINCT event_type AS term, 'low' AS label, 1 AS value_id FROM {events} UNION ALL SELECT DISTINCT event_type, 'high', 2 FROM {events} WHERE event_type <> 'error' UNION ALL SELECT 'error', ' ', 3")
def vocabulary_ids(ratings: DataFrame, vocabulary: DataFrame) -> DataFrame:
    return P.label_ids(ratings, vocabulary)


@query(
    "model_settings",
    """SELECT event_id, CASE CAST(event_id % 3 AS INTEGER) WHEN 0 THEN CASE WHEN asked IN ('low', 'high') THEN asked ELSE 'low' END WHEN 1 THEN CASE WHEN asked IN ('medium', 'high', 'max') THEN 'high' ELSE 'none' END ELSE asked END AS effort, CASE WHEN lower(trim(model)) = 'view' THEN 'm/view-1' WHEN lower(trim(model)) = 'click' THEN 'm/click-2' ELSE lower(trim(model)) END AS model_key
    FROM (SELECT *, lower(trim(level)) AS asked FROM calls)""",
    calls="SELECT event_id, CASE CAST(event_id % 3 AS INT) WHEN 0 THEN 'openrouter' WHEN 1 THEN 'mistral' ELSE 'own' END AS provider, CASE CAST(user_id % 5 AS INT) WHEN 0 THEN ' High' WHEN 1 THEN 'medium' WHEN 2 THEN 'LOW ' WHEN 3 THEN 'max' ELSE 'odd' END AS level, concat(' ', upper(event_type), ' ') AS model FROM {events}",
    aliases="SELECT DISTINCT CASE event_type WHEN 'view' THEN 'View' ELSE event_type END AS alias, CASE event_type WHEN 'view' THEN 'm/view-1' ELSE 'm/click-2' END AS key FROM {events} WHERE event_type IN ('view', 'click')",
)
def model_settings(calls: DataFrame, aliases: DataFrame) -> DataFrame:
    declared = F.array(F.lit("low"), F.lit("high"))
    rows = U.model_key(F.col("model"), aliases, calls)
    return rows.select("event_id", U.effort(F.col("provider"), F.col("level"), declared, F.lit("low")).alias("effort"), "model_key")


@query("panel_labels", "SELECT event_id, CASE WHEN event_id % 4 = 0 OR event_type IN ('error', '') THEN NULL ELSE event_type END AS label, CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'x ' || event_type END AS summary FROM rows_", rows_="SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '' ELSE event_type END AS event_type FROM {events}")
def panel_labels(rows_: DataFrame) -> DataFrame:
    failed = F.when(F.col("event_id") % 4 == 0, "timeout")
    said = F.when(F.col("event_id") % 5 == 0, " ** ").otherwise(F.concat(F.lit("*x "), "event_type", F.lit("*")))
    summary = F.when(F.col("event_type") == "", F.when(F.col("event_id") % 5 != 0, "x ")).otherwise(U.tidy_summary(said))
    return rows_.select("event_id", U.label_or_null(F.col("event_type"), failed, "error").alias("label"), summary.alias("summary"))


@query("annotation_checks", "SELECT event_id, CASE CAST(event_id % 5 AS INTEGER) WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN false ELSE true END AS same FROM rows_", rows_="SELECT event_id, event_type FROM {events}")
def annotation_checks(rows_: DataFrame) -> DataFrame:
    one = F.create_map(F.lit("id"), F.col("event_type"))
    served = F.create_map(F.lit("id"), F.col("event_type"), F.lit("seen"), F.lit("1"))
    other = F.create_map(F.lit("id"), F.concat(F.col("event_type"), F.lit("!")))
    kind = F.col("event_id") % 5
    stored = F.when(kind == 4, F.lit(None)).otherwise(F.create_map(F.lit("by"), F.when(kind == 1, F.array(served)).when(kind == 2, F.array(other)).when(kind == 3, F.array(one, one)).otherwise(F.array(one))))
    wanted = F.when(kind == 4, F.lit(None)).otherwise(F.create_map(F.lit("by"), F.array(one)))
    return rows_.select("event_id", P.annotation_matches(stored, wanted).alias("same"))


@query("corrected_pages", "SELECT s_suppkey AS file, CASE WHEN s_suppkey % 3 = 0 THEN 'new' ELSE s_name END || '|' || CASE WHEN s_suppkey % 3 = 0 THEN 'too' ELSE 'b' END || '|c' AS words FROM pages_", pages_="SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name FROM {supplier}")
def corrected_pages(pages_: DataFrame) -> DataFrame:
    xml = '<alto xmlns="http://a/b"><TextBlock><TextLine><String CONTENT="%s"/><SP/><String CONTENT="b"/></TextLine></TextBlock><TextBlock><TextLine><String CONTENT="c"/></TextLine></TextBlock></alto>'
    files = pages_.select(F.col("s_suppkey").alias("file"), F.format_string(xml, "s_name").alias("text"))
    fix = F.when(F.col("s_suppkey") % 3 == 0, F.array(F.lit("new"), F.lit("too"))).otherwise(F.array(F.lit("one")))
    lines = pages_.filter("s_suppkey % 3 <> 2").select(F.col("s_suppkey").alias("file"), F.lit(0).alias("block"), F.lit(0).alias("line"), fix.alias("tokens"))
    return K.corrected_pages(files, lines).select("file", F.array_join(F.regexp_extract_all("text", F.lit('CONTENT="([^"]*)"')), "|").alias("words"))


@round_trip("pre_image_round_trip", "SELECT o_orderkey AS item_id, o_orderpriority AS clerk FROM orders WHERE o_orderkey % 3 = 0", updates="SELECT o_orderkey AS item_id, o_orderpriority AS clerk, CASE CAST(o_orderkey % 3 AS INT) WHEN 0 THEN 'updated' WHEN 1 THEN 'unchanged' ELSE 'would_update' END AS status FROM {orders}")
def pre_image_round_trip(spark, path, updates):
    rows = updates.select("item_id", F.struct("clerk").alias("before"), "status")
    K.pre_image(rows, path, dry_run=True)
    K.pre_image(rows, path, dry_run=False)
    read = spark.read.schema("item_id long, before string").json(path)
    return read.select("item_id", F.get_json_object("before", "$.clerk").alias("clerk"))
