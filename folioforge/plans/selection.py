"""Gates, counts, samples and comparisons over catalogue-like rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import values as V
from ..operators.annotate import status_counts
from .base import query

#: fixed values: language labels and codes
LABELS = {"francais": "fr", "anglais": "en", "allemand": "de", "espagnol": "es"}


@query(
    "value_select_fr_first",
    "SELECT source, CASE WHEN bool_or(lang = 'fr') THEN arg_min(value, pos) FILTER (WHERE lang = 'fr') ELSE coalesce(arg_min(value, pos), '') END AS chosen, trim(arg_min(value, pos) FILTER (WHERE value IS NOT NULL)) AS first_literal, count(*) AS n FROM vals GROUP BY source",
    vals="SELECT concat(source, '-', CAST(doc_id % 40 AS VARCHAR(20))) AS source, doc_id AS pos, lang, text AS value FROM {documents}",
)
def value_select(vals):
    # the entries that the rules may choose, not a group's whole texts: first of all, first in French, first with a value
    one = F.struct("pos", "lang", "value")
    first = [F.min(x) for x in (one, F.when(F.col("lang") == "fr", one), F.when(F.col("value").isNotNull(), one))]
    arr = F.transform(F.array_sort(F.array_compact(F.array(*first))), lambda x: F.struct(x["value"].alias("value"), x["lang"].alias("lang")))
    out = vals.groupBy("source").agg(arr.alias("v"), F.count(F.lit(1)).alias("n"))
    return out.select("source", V.french_or_first(F.col("v")).alias("chosen"), V.first_literal(F.col("v")).alias("first_literal"), "n")


@query(
    "language_gate_counts",
    "SELECT CASE WHEN label IS NULL THEN 'language_unknown' WHEN label IN ('Français', 'Anglais') THEN 'passed' ELSE 'language_skipped' END AS status, coalesce(label, '') AS label, count(*) AS n FROM items GROUP BY ALL",
    items="SELECT doc_id, CASE lang WHEN 'fr' THEN 'Français' WHEN 'en' THEN 'Anglais' WHEN 'es' THEN 'Espagnol' END AS label FROM {documents}",
)
def language_gate(items):
    status = F.when(F.col("label").isNull(), "language_unknown").when(F.col("label").isin("Français", "Anglais"), "passed").otherwise("language_skipped")
    return items.groupBy(status.alias("status"), F.coalesce("label", F.lit("")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("publisher_counts", "SELECT coalesce(publisher, 'Unknown') AS publisher, count(*) AS n FROM items GROUP BY 1", items="SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN NULL ELSE source END AS publisher FROM {documents}")
def publisher_counts(items):
    return items.groupBy(F.coalesce("publisher", F.lit("Unknown")).alias("publisher")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "reverse_ref_status",
    """+ r AS (SELECT *, CASE WHEN kind = 'junk' THEN 'invalid' WHEN kind = 'page' THEN 'non_article' WHEN ref IS NULL THEN 'invalid' END AS early FROM refs),
    n AS (SELECT *, CASE WHEN early IS NULL THEN row_number() OVER (PARTITION BY ref, early ORDER BY pos) END AS turn FROM r)
    SELECT status, count(*) AS n FROM (SELECT CASE WHEN early IS NOT NULL THEN early WHEN turn > 1 THEN 'duplicate' WHEN i.id IS NULL THEN 'fetch_error' WHEN i.type <> 'article' THEN 'non_article' ELSE 'article' END AS status FROM n LEFT JOIN items i ON n.ref = i.id) GROUP BY 1""",
    refs="SELECT l_orderkey * 10 + l_linenumber AS pos, CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE l_partkey END AS ref, CASE WHEN l_orderkey % 23 = 0 THEN 'junk' WHEN l_orderkey % 29 = 0 THEN 'page' ELSE 'article' END AS kind FROM {lineitem}",
    items="SELECT p_partkey AS id, CASE WHEN p_size % 5 = 0 THEN 'page' ELSE 'article' END AS type FROM {part} WHERE p_partkey % 7 <> 0",
)
def reverse_refs(refs, items):
    early = F.when(F.col("kind") == "junk", "invalid").when(F.col("kind") == "page", "non_article").when(F.col("ref").isNull(), "invalid")
    # of the rows of a reference one comes first, though several may share the least position, and all others repeat it
    groups = refs.groupBy(early.alias("early"), "ref").agg(F.count(F.lit(1)).alias("of")).join(items, F.col("ref") == F.col("id"), "left")
    part = lambda status, n: F.struct(status.alias("status"), n.alias("n"))
    first = F.when(F.col("id").isNull(), "fetch_error").when(F.col("type") != "article", "non_article").otherwise("article")
    parts = F.when(F.col("early").isNotNull(), F.array(part(F.col("early"), F.col("of")))).otherwise(F.array(part(first, F.lit(1).cast("long")), part(F.lit("duplicate"), F.col("of") - 1)))
    return groups.select(F.inline(parts)).filter("n > 0").groupBy("status").agg(F.sum("n").alias("n"))


@query(
    "schema_drift",
    "SELECT name, 'would_delete' AS change, n FROM have WHERE name NOT IN (SELECT name FROM want) UNION ALL SELECT name, 'would_add', 0 FROM want WHERE name NOT IN (SELECT name FROM have)",
    have="SELECT DISTINCT event_type AS name, count(*) AS n FROM {events} GROUP BY event_type",
    want="SELECT DISTINCT concat(event_type, CASE WHEN event_type > 'd' THEN '' ELSE '2' END) AS name FROM {events}",
)
def schema_drift(have, want):
    gone = have.join(want, "name", "left_anti").select("name", F.lit("would_delete").alias("change"), "n")
    return gone.unionByName(want.join(have, "name", "left_anti").select("name", F.lit("would_add").alias("change"), F.lit(0).cast("long").alias("n")))


@query("reasoning_ladder", "SELECT level, round(median(value), 6) AS mid, count(*) FILTER (WHERE bad) AS invalid, string_agg(DISTINCT err, ',' ORDER BY err) AS errors FROM probes GROUP BY level", probes="SELECT event_type AS level, value, event_id % 9 = 0 AS bad, CASE WHEN event_id % 9 = 0 THEN concat('e', CAST(event_id % 4 AS VARCHAR(20))) END AS err FROM {events}")
def reasoning_ladder(probes):
    return probes.groupBy("level").agg(F.round(F.median("value"), 6).alias("mid"), F.count_if("bad").alias("invalid"), F.array_join(F.array_sort(F.collect_set("err")), ",").alias("errors"))


@query("error_rate_gate", "SELECT source, count(*) AS pages, CASE WHEN avg(CAST(failed AS INT)) > 0.2 THEN 'stopped' ELSE 'consolidated' END AS status FROM pages_ GROUP BY source", pages_="SELECT concat(source, '/', CAST(doc_id % 7 AS VARCHAR(20))) AS source, doc_id % 7 = 3 AND doc_id % 2 = 0 OR doc_id % 11 = 0 AS failed FROM {documents}")
def error_rate_gate(pages_):
    return pages_.groupBy("source").agg(F.count(F.lit(1)).alias("pages"), F.when(F.avg(F.col("failed").cast("int")) > 0.2, "stopped").otherwise("consolidated").alias("status"))


@query(
    "language_agreement",
    f"+ c AS (SELECT doc_id, CASE translate(lower(trim(label)), '{X.ACCENTED}', '{X.PLAIN}') WHEN 'francais' THEN 'fr' WHEN 'anglais' THEN 'en' WHEN 'allemand' THEN 'de' WHEN 'espagnol' THEN 'es' END AS code, found FROM items) SELECT doc_id, code, code IS NULL OR found IS NULL OR code = found AS agrees FROM c",
    items="SELECT doc_id, CASE lang WHEN 'fr' THEN ' FRANÇAIS' WHEN 'en' THEN 'Anglais' WHEN 'de' THEN 'allemand ' ELSE 'Mooré' END AS label, CASE WHEN doc_id % 10 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN 'en' ELSE lang END AS found FROM {documents}",
)
def language_agreement(items):
    code = X.language_code(F.col("label"), LABELS)
    return items.select("doc_id", code.alias("code"), (code.isNull() | F.col("found").isNull() | F.coalesce(code == F.col("found"), F.lit(False))).alias("agrees"))


@query("missing_label_counts", "SELECT label, count(DISTINCT item) AS n FROM labels_ WHERE label NOT IN (SELECT name FROM known) GROUP BY 1", labels_="SELECT user_id AS item, event_type AS label FROM {events}", known="SELECT DISTINCT event_type AS name FROM {events} WHERE event_type < 'd'")
def missing_labels(labels_, known):
    return labels_.distinct().join(known, F.col("label") == F.col("name"), "left_anti").groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "systematic_sample",
    "+ n AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS pos, count(*) OVER () AS n FROM docs) SELECT doc_id FROM n WHERE pos IN (SELECT CAST(floor(i * (n / 100.0::DOUBLE)) AS BIGINT) FROM range(100) t(i))",
    docs="SELECT doc_id FROM {documents}",
)
def systematic_sample(docs, k: int = 100):
    """Every n/k-th document by id: places within range partitions plus the partitions' offsets, no global window over rows."""
    parts = docs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranged = docs.repartitionByRange(int(parts), "doc_id").withColumn("_p", F.spark_partition_id())
    local = ranged.withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy("doc_id")) - 1)
    sizes = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))
    placed = local.join(F.broadcast(offsets), "_p").select("doc_id", (F.col("_i") + F.col("_o")).alias("pos"))
    total = docs.agg(F.count(F.lit(1)).alias("n"))
    picks = docs.sparkSession.range(k).crossJoin(F.broadcast(total)).select(F.when(F.col("n") > k, F.floor(F.col("id") * (F.col("n") / F.lit(float(k))))).otherwise(F.col("id")).alias("pos"))
    return placed.join(F.broadcast(picks), "pos").select("doc_id")


@query(
    "quota_classify",
    "SELECT kind, count(*) AS n FROM (SELECT CASE WHEN code = 402 THEN 'terminal' WHEN code = 429 AND regexp_matches(lower(message), 'exceeded your current quota|requests_per_model_per_day|per_day|billing|insufficient credits') THEN 'terminal' ELSE 'transient' END AS kind FROM errors) GROUP BY 1",
    errors="SELECT CASE CAST(event_id % 4 AS INT) WHEN 0 THEN 402 WHEN 1 THEN 429 WHEN 2 THEN 500 ELSE 429 END AS code, CASE WHEN event_id % 3 = 0 THEN 'You exceeded your current quota' ELSE 'Too many requests' END AS message FROM {events}",
)
def quota_classify(errors):
    return errors.groupBy(X.quota_kind(F.col("code"), F.col("message")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "quota_classify_strictly",
    "SELECT kind, count(*) AS n FROM (SELECT CASE WHEN code = 429 AND regexp_matches(lower(message), 'exceeded your current quota|quota exceeded|per_day|billing|insufficient credits') THEN 'terminal' ELSE 'transient' END AS kind FROM errors) GROUP BY 1",
    errors="SELECT CASE CAST(event_id % 4 AS INT) WHEN 0 THEN 402 WHEN 1 THEN 429 WHEN 2 THEN NULL ELSE 429 END AS code, CASE CAST(event_id % 5 AS INT) WHEN 0 THEN 'Quota exceeded' WHEN 1 THEN 'requests_per_model_per_DAY' WHEN 2 THEN 'Rate limit exceeded' WHEN 3 THEN 'see billing' END AS message FROM {events}",
)
def quota_classify_strictly(errors):
    return errors.groupBy(X.quota_kind(F.col("code"), F.col("message"), strict=True).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("status_buckets", "SELECT s.status, count(o.o_orderstatus) AS n FROM (SELECT unnest(['F', 'O', 'P', 'X']) AS status) s LEFT JOIN orders_ o ON o.o_orderstatus = s.status GROUP BY 1", orders_="SELECT o_orderstatus FROM {orders}")
def status_buckets(orders_):
    return status_counts(orders_, "o_orderstatus", ["F", "O", "P", "X"])
