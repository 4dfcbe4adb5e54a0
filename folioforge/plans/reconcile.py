"""Authority reconciliation over names of parts, nations, regions and suppliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import ACCENTED, CURLY, PLAIN, STRAIGHT
from ..operators import reconcile as R
from ..operators.setjoin import similar_sets, word_set
from .base import query

NAMES = """
SELECT concat('p', CAST(p_partkey AS VARCHAR(20))) AS id, p_name AS name FROM {part}
UNION ALL SELECT concat('n', CAST(n_nationkey AS VARCHAR(20))), n_name FROM {nation}
UNION ALL SELECT concat('r', CAST(r_regionkey AS VARCHAR(20))), r_name FROM {region}
UNION ALL SELECT concat('s', CAST(s_suppkey AS VARCHAR(20))), s_name FROM {supplier}
"""
# per line item: a part name, then a nation or supplier name in another spelling, a blank, or junk
ROWS = """
SELECT l_orderkey * 10 + l_linenumber AS row_id,
       concat(p_name, '|', CASE CAST(l_orderkey % 5 AS INT)
           WHEN 0 THEN concat(' ', lower(n_name), ' ') WHEN 1 THEN concat('Zz-', n_name) WHEN 2 THEN '' WHEN 3 THEN replace(s_name, '#', ' -') ELSE s_name END) AS vals
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey
"""
_COMPACT = f"regexp_replace(translate(translate(lower(trim({{0}})), '{CURLY}', '''''''------'), '{ACCENTED}', '{PLAIN}'), '[-\\s]+', '', 'g')"
assert len(CURLY) == len(STRAIGHT)
_VARIANTS = f"[lower({{0}}), {_COMPACT}, translate(lower({{0}}), '{ACCENTED}', '{PLAIN}')]"
_INDEX = f"""
keyed AS (SELECT DISTINCT id, unnest({_VARIANTS.format('trim(name)')}) AS key FROM names),
idx AS (SELECT key, string_agg(id, '|' ORDER BY id) AS ids, count(*) AS n_ids, count(*) > 1 AS ambiguous FROM keyed WHERE key <> '' GROUP BY key)
"""
_FOUND = f"""
parts AS (SELECT row_id, p.pos - 1 AS pos, trim(split_part(vals, '|', CAST(p.pos AS INT))) AS value FROM raw, (SELECT unnest(range(1, 3)) AS pos) p WHERE vals <> ''),
vals AS (SELECT DISTINCT value FROM parts WHERE value <> ''),
tried AS (SELECT value, unnest([0, 1, 2]) AS prio, unnest({_VARIANTS.format('value')}) AS key FROM vals),
best AS (SELECT value, bool_or(ambiguous) AS vague, min_by(ids, prio) FILTER (WHERE NOT ambiguous) AS ids FROM tried JOIN idx USING (key) GROUP BY value),
found AS (SELECT row_id, pos, value, CASE WHEN value = '' THEN 'blank' WHEN vague THEN 'ambiguous' WHEN ids IS NOT NULL THEN 'matched' ELSE 'unreconciled' END AS status,
                 CASE WHEN value <> '' AND NOT vague THEN ids END AS authority_id FROM parts LEFT JOIN best USING (value))
"""


@query("authority_index", f"+{_INDEX} SELECT * FROM idx", names=NAMES)
def authority_index(names):
    return R.authority_index(names)


@query("authority_ambiguous_terms", f"+{_INDEX} SELECT key, ids FROM idx WHERE ambiguous", names=NAMES)
def ambiguous_terms(names):
    return R.authority_index(names).filter("ambiguous").select("key", "ids")


def _found(names, raw):
    return R.lookup(R.tokens(raw, "row_id", "vals"), R.authority_index(names))


@query("reconcile_exact", f"+{_INDEX}, {_FOUND} SELECT row_id, coalesce(string_agg(authority_id, '|' ORDER BY pos, authority_id) FILTER (WHERE authority_id IS NOT NULL), '') AS authority_ids FROM found GROUP BY row_id", names=NAMES, raw=ROWS)
def reconcile_exact(names, raw):
    return R.reconciled_rows(_found(names, raw))


@query("reconcile_stats", f"+{_INDEX}, {_FOUND} SELECT count(*) AS total, count(*) FILTER (WHERE status = 'matched') AS matched, count(DISTINCT CASE status WHEN 'ambiguous' THEN value || ' (Ambiguous)' WHEN 'unreconciled' THEN value END) AS distinct_unreconciled, round(count(*) FILTER (WHERE status = 'matched') * CAST(100 AS DOUBLE) / count(*), 6) AS rate FROM found", names=NAMES, raw=ROWS)
def reconcile_stats(names, raw):
    return R.statistics(_found(names, raw))


@query("unreconciled_counts", f"+{_INDEX}, {_FOUND} SELECT CASE status WHEN 'ambiguous' THEN value || ' (Ambiguous)' ELSE value END AS value, count(*) AS n, min(row_id) AS first_row, CAST(arg_min(pos, row_id * 10 + pos) AS INTEGER) AS first_pos FROM found WHERE status IN ('ambiguous', 'unreconciled') GROUP BY 1", names=NAMES, raw=ROWS)
def unreconciled_counts(names, raw):
    return R.unreconciled(_found(names, raw))


@query("title_fold", f"SELECT doc_id, {_COMPACT.format('title')} AS compact, translate(lower(title), '{ACCENTED}', '{PLAIN}') AS plain FROM titles", titles="SELECT doc_id, text AS title FROM {documents}")
def title_fold(titles):
    from ..functions.text import compact_key, strip_accents

    return titles.select("doc_id", compact_key(F.col("title")).alias("compact"), strip_accents(F.lower("title")).alias("plain"))


VALUES = "SELECT DISTINCT concat(p_type, ' de ', p_name) AS value FROM {part} UNION SELECT DISTINCT concat(p_name, ' ', p_brand) FROM {part}"
FUZZY_NAMES = "SELECT concat('p', CAST(min(p_partkey) AS VARCHAR(20))) AS id, concat(p_type, ' ', p_name) AS name, 0 AS variant, min(p_partkey) AS place FROM {part} GROUP BY 2 UNION ALL SELECT concat('b', CAST(min(p_partkey) AS VARCHAR(20))), concat(p_brand, ' ', p_name), 1, min(p_partkey) FROM {part} GROUP BY 2"


@query("fuzzy_candidates", vals=VALUES, names=FUZZY_NAMES)
def fuzzy(vals, names):
    return R.fuzzy_candidates(vals, names)


# sets of the first words of texts, of 1 to about 24 words, so that both kinds of prefix are used
WORD_SETS = "SELECT doc_id, lower(text) AS t FROM {documents} WHERE text IS NOT NULL"


@query(
    "similar_word_sets",
    r"""+ w AS (SELECT DISTINCT list_sort(list_distinct(regexp_extract_all(line, '[a-z]+'))) AS words FROM (SELECT unnest(string_split(t, '.')) AS line FROM texts)),
    s AS (SELECT row_number() OVER () AS i, words, len(words) AS n FROM w WHERE len(words) BETWEEN 1 AND 24),
    e AS (SELECT i, n, unnest(words) AS word FROM s),
    p AS (SELECT a.i AS i, b.i AS j, a.n AS n, b.n AS m, count(*) AS shared FROM e a JOIN e b ON a.word = b.word AND a.n * 10 >= b.n * 7 AND b.n * 10 >= a.n * 7 GROUP BY ALL)
    SELECT array_to_string(x.words, ' ') AS left_words, array_to_string(y.words, ' ') AS right_words, CAST(p.shared AS INTEGER) AS shared, CAST(p.n + p.m - p.shared AS INTEGER) AS "both"
    FROM p JOIN s x ON x.i = p.i JOIN s y ON y.i = p.j WHERE p.shared * 10 >= 7 * (p.n + p.m - p.shared)""",
    texts=WORD_SETS,
)
def similar_word_sets(texts):
    words = texts.select(F.explode(F.split("t", "[.]", -1)).alias("line")).select(word_set(F.regexp_extract_all("line", F.lit("[a-z]+"), F.lit(0))).alias("words")).filter(F.size("words").between(1, 24))
    near = similar_sets(words, words.select("words"), 0.7)
    return near.select(F.array_join("left_words", " ").alias("left_words"), F.array_join("right_words", " ").alias("right_words"), "shared", "both")
