"""Links, literals and value maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import values as V
from ..operators import upsert as U
from .base import query


@query(
    "link_append",
    """+ h AS (SELECT k, list(v ORDER BY pos, v) AS h FROM have GROUP BY 1), n AS (SELECT k, list(v ORDER BY first, v) AS n FROM (SELECT k, v, min(pos) AS first FROM fresh GROUP BY ALL) GROUP BY 1),
    m AS (SELECT coalesce(h.k, n.k) AS k, coalesce(h, []) AS h, list_filter(coalesce(n, []), lambda x: NOT list_contains(coalesce(h, []), x)) AS added FROM h FULL JOIN n ON h.k = n.k)
    SELECT k, array_to_string(list_concat(h, added), '|') AS links, CAST(len(added) AS BIGINT) AS added, CASE WHEN len(added) = 0 THEN 'unchanged' ELSE 'would_update' END AS status FROM m""",
    have="SELECT l_orderkey AS k, l_linenumber AS pos, l_partkey AS v FROM {lineitem} WHERE l_linenumber <= 3",
    fresh="SELECT l_orderkey AS k, l_linenumber AS pos, CASE WHEN l_linenumber % 2 = 0 THEN l_partkey ELSE l_suppkey END AS v FROM {lineitem} WHERE l_orderkey % 3 <> 0",
)
def link_append(have, fresh):
    ordered = lambda df, name: df.groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda x: x["v"]).alias(name))
    both = ordered(have, "h").join(ordered(fresh, "n"), "k", "full")
    out = both.withColumn("after", U.append_links(F.col("h"), F.array_distinct("n"))).withColumn("added", (F.size("after") - F.coalesce(F.when(F.col("h").isNotNull(), F.size("h")), F.lit(0))).cast("long"))
    return out.select("k", F.array_join("after", "|").alias("links"), "added", F.when(F.col("added") == 0, "unchanged").otherwise("would_update").alias("status"))


@query(
    "literal_upsert_status",
    """SELECT status, count(*) AS n FROM (SELECT CASE WHEN i.doc_id IS NULL THEN 'not_found' WHEN trim(u.text) = '' THEN 'empty' WHEN i.lang = u.lang AND i.value = u.text THEN 'unchanged' ELSE 'would_update' END AS status FROM updates u LEFT JOIN items i USING (doc_id)) GROUP BY 1""",
    items="SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE lang END AS lang, text AS value FROM {documents} WHERE doc_id % 9 <> 0",
    updates="SELECT doc_id, lang, CASE CAST(doc_id % 5 AS INT) WHEN 0 THEN ' ' WHEN 1 THEN concat(text, 'x') ELSE text END AS text FROM {documents}",
)
def literal_status(items, updates):
    before = items.select("doc_id", F.array(F.struct("value", "lang")).alias("before"))
    rows = updates.join(before, "doc_id", "left")
    after = U.upsert_literal(F.col("before"), F.col("text"), F.col("lang"), adopt_untagged=True)
    status = U.literal_status(F.col("before"), after, F.col("text"), F.col("before").isNotNull(), dry_run=True)
    return rows.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "sentiment_values_unpivot",
    "SELECT r.item_id, r.term, v.value_id FROM ratings r JOIN vocabulary v USING (term, label)",
    ratings="SELECT o_orderkey AS item_id, 'status' AS term, o_orderstatus AS label FROM {orders} UNION ALL SELECT o_orderkey, 'priority', o_orderpriority FROM {orders}",
    vocabulary="SELECT DISTINCT 'priority' AS term, o_orderpriority AS label, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS value_id FROM {orders} WHERE substr(o_orderpriority, 1, 1) < '4' UNION SELECT DISTINCT 'status', o_orderstatus, CAST(length(o_orderstatus) AS BIGINT) FROM {orders} WHERE o_orderstatus <> 'P'",
)
def sentiment_values(ratings, vocabulary):
    return U.label_ids(ratings, vocabulary)


@query(
    "new_term_ids",
    "SELECT t.k, string_agg(CAST(m.id AS VARCHAR), '|' ORDER BY t.pos, m.id) AS ids FROM terms t JOIN (SELECT key, max_by(id, pos) AS id FROM map_ GROUP BY key) m ON lower(trim(t.term)) = m.key GROUP BY 1",
    terms="SELECT l_orderkey AS k, l_linenumber AS pos, concat(' ', upper(p_name), ' ') AS term FROM {lineitem} JOIN {part} ON l_partkey = p_partkey",
    map_="SELECT lower(p_name) AS key, p_partkey AS pos, p_partkey AS id FROM {part} WHERE p_size % 2 = 0",
)
def new_term_ids(terms, map_):
    last = map_.groupBy("key").agg(F.max_by("id", "pos").alias("id"))
    hits = terms.join(last, F.lower(F.trim("term")) == F.col("key"))
    parts = F.array_sort(F.collect_list(F.struct("pos", "id")))
    return hits.groupBy("k").agg(F.array_join(F.transform(parts, lambda x: x["id"].cast("string")), "|").alias("ids"))


@query(
    "bilingual_pair_status",
    "SELECT coalesce(f.k, e.k) AS k, CASE WHEN f.k IS NOT NULL AND e.k IS NOT NULL THEN 'both' WHEN f.k IS NOT NULL THEN 'first_only' ELSE 'second_only' END AS status FROM fr f FULL JOIN en e ON f.k = e.k",
    fr="SELECT doc_id AS k FROM {documents} WHERE doc_id % 3 <> 0",
    en="SELECT doc_id AS k FROM {documents} WHERE doc_id % 4 <> 1",
)
def bilingual_pairs(fr, en):
    return U.pair_status(fr, en, "k")


@query(
    "link_sums_by_term",
    """+ f AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN 'invalid_id' WHEN o_orderkey % 7 = 0 THEN 'not_found' END AS bad, CASE WHEN o_custkey % 50 <> o_orderkey % 6 THEN 1 ELSE 0 END AS s, CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE 1 END AS p FROM orders),
    g AS (SELECT *, coalesce(bad, CASE WHEN s + p = 0 THEN 'unchanged' WHEN k % 13 = 0 THEN 'failed' ELSE 'updated' END) AS status FROM f)
    SELECT 'subject' AS term, CAST(sum(s) FILTER (WHERE status = 'updated') AS BIGINT) AS n FROM g UNION ALL SELECT 'spatial', CAST(sum(p) FILTER (WHERE status = 'updated') AS BIGINT) FROM g UNION ALL SELECT status, CAST(count(*) AS BIGINT) FROM g GROUP BY 1""",
    updates="SELECT CASE WHEN o_orderkey % 11 = 0 THEN concat('x', CAST(o_orderkey AS VARCHAR(20))) ELSE concat(' ', CAST(o_orderkey AS VARCHAR(20))) END AS item_id, 'subject' AS term, concat(CAST(o_custkey % 50 AS VARCHAR(20)), '| ', CAST(o_orderkey % 6 AS VARCHAR(20)), '|junk||1.5|', CAST(o_custkey % 50 AS VARCHAR(20))) AS ids FROM {orders} UNION ALL SELECT CASE WHEN o_orderkey % 11 = 0 THEN concat('x', CAST(o_orderkey AS VARCHAR(20))) ELSE concat(' ', CAST(o_orderkey AS VARCHAR(20))) END, 'spatial', CAST(o_orderkey % 4 AS VARCHAR(20)) FROM {orders}",
    links="SELECT o_orderkey AS item_id, 'subject' AS term, o_orderkey % 6 AS link FROM {orders} UNION ALL SELECT o_orderkey, 'spatial', o_orderkey % 4 FROM {orders} WHERE o_orderkey % 5 = 0",
    items="SELECT o_orderkey AS item_id FROM {orders} WHERE o_orderkey % 7 <> 0",
    sent="SELECT o_orderkey AS item_id FROM {orders} WHERE o_orderkey % 13 <> 0",
)
def link_sums(updates, links, items, sent):
    held = links.groupBy("item_id", "term").agg(F.collect_list(F.col("link").cast("long")).alias("links"))
    done = U.link_updates(updates, held, items, dry_run=False, sent=sent)
    per_status = done.filter("term = 'subject'").groupBy(F.col("status").alias("term")).agg(F.count(F.lit(1)).alias("added"))
    return U.links_by_term(done).unionAll(per_status).withColumnRenamed("added", "n")


@query(
    "shown_values",
    """SELECT doc_id, coalesce(nullif(t1, ''), nullif(v1, ''), nullif(u1, ''), nullif(t2, ''), nullif(v2, ''), nullif(u2, '')) AS shown,
    coalesce(nullif(trim(coalesce(nullif(t1, ''), v1)), ''), nullif(trim(coalesce(nullif(t2, ''), v2)), '')) AS label FROM docs""",
    docs="SELECT doc_id, CASE CAST(doc_id % 3 AS INT) WHEN 0 THEN '' WHEN 1 THEN lang END AS t1, CASE CAST(doc_id % 5 AS INT) WHEN 0 THEN ' ' WHEN 1 THEN concat(' ', source, ' ') WHEN 2 THEN '' END AS v1, CASE WHEN doc_id % 2 = 0 THEN concat('u:', source) END AS u1, CASE WHEN doc_id % 7 = 0 THEN source END AS t2, CASE WHEN doc_id % 4 = 0 THEN text END AS v2, CASE WHEN doc_id % 9 = 0 THEN 'u:2' END AS u2 FROM {documents}",
)
def shown_values(docs):
    entries = F.array(*(F.struct(F.col(f"t{i}").alias("title"), F.col(f"v{i}").alias("value"), F.col(f"u{i}").alias("uri")) for i in (1, 2)))
    return docs.select("doc_id", V.shown_first(entries).alias("shown"), V.label_of_language(entries).alias("label"))
