"""Agreement of four raters derived from document lengths."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import agreement as A
from ..operators import annotate as N
from .base import query

# four raters quantise a length in different ways and sometimes abstain
RATINGS = """
SELECT d.dimension, CAST(doc_id AS VARCHAR(20)) AS item_id, m.model,
       CASE WHEN (doc_id + m.k) % 11 = 0 THEN NULL ELSE concat('c', CAST(CAST(floor((n_chars + doc_id % (7 + m.k) * 100 * m.k) / (d.width + 150 * m.k)) AS BIGINT) % 4 AS VARCHAR(20))) END AS label
FROM {documents}
CROSS JOIN (SELECT 'm0' AS model, 0 AS k UNION ALL SELECT 'm1', 1 UNION ALL SELECT 'm2', 2 UNION ALL SELECT 'm3', 3) m
CROSS JOIN (SELECT 'near' AS dimension, 900 AS width UNION ALL SELECT 'far', 2500) d
"""
_MAJ = "CASE WHEN voters >= 2 AND most * 2 > voters THEN top END AS label"
_PAIRS = "pairs AS (SELECT a.dimension, a.item_id, a.model AS model_a, b.model AS model_b, a.label AS a, b.label AS b FROM ratings a JOIN ratings b ON a.dimension = b.dimension AND a.item_id = b.item_id AND a.model < b.model WHERE a.label IS NOT NULL AND b.label IS NOT NULL)"
_LOO = f"""
votes AS (SELECT a.dimension, a.item_id, a.model, b.label, count(*) AS n FROM ratings a JOIN ratings b ON a.dimension = b.dimension AND a.item_id = b.item_id AND a.model <> b.model WHERE b.label IS NOT NULL GROUP BY ALL),
per AS (SELECT dimension, item_id, model, sum(n) AS voters, max(n) AS most, arg_max(label, n) AS top FROM votes GROUP BY ALL),
loo AS (SELECT r.dimension, r.item_id, r.model, {_MAJ} FROM ratings r LEFT JOIN per USING (dimension, item_id, model))
"""


def _kappa(keys: str, source: str) -> str:
    on = " AND ".join(f"l.{k} = r.{k}" for k in keys.split(", "))
    return f"""
cells AS (SELECT {keys}, a, b, count(*) AS n FROM {source} GROUP BY ALL),
total AS (SELECT {keys}, sum(n) AS n, sum(CASE WHEN a = b THEN n ELSE 0 END) AS same FROM cells GROUP BY ALL),
l AS (SELECT {keys}, a AS label, sum(n) AS na FROM cells GROUP BY ALL), r AS (SELECT {keys}, b AS label, sum(n) AS nb FROM cells GROUP BY ALL),
chance AS (SELECT {', '.join('l.' + k for k in keys.split(', '))}, sum(na * nb) AS chance FROM l JOIN r ON {on} AND l.label = r.label GROUP BY ALL)
SELECT {keys}, CAST(n AS BIGINT) AS n, CASE WHEN n >= 2 AND coalesce(chance, 0) < n * n THEN round((CAST(same AS DOUBLE) / n - CAST(coalesce(chance, 0) AS DOUBLE) / (n * n)) / (1 - CAST(coalesce(chance, 0) AS DOUBLE) / (n * n)), 9) END AS kappa
FROM total LEFT JOIN chance USING ({keys})
"""


@query("panel_majority", f"+ n AS (SELECT dimension, item_id, label, count(*) AS n FROM ratings WHERE label IS NOT NULL GROUP BY ALL), per AS (SELECT dimension, item_id, sum(n) AS voters, max(n) AS most, arg_max(label, n) AS top FROM n GROUP BY ALL) SELECT i.dimension, i.item_id, {_MAJ} FROM (SELECT DISTINCT dimension, item_id FROM ratings) i LEFT JOIN per USING (dimension, item_id)", ratings=RATINGS)
def panel_majority(ratings):
    return A.majority(ratings)


@query("panel_loo_majority", f"+{_LOO} SELECT * FROM loo", ratings=RATINGS)
def panel_loo(ratings):
    return A.loo_majority(ratings)


@query("panel_pairwise_agreement", f"+{_PAIRS} SELECT dimension, model_a, model_b, count(*) AS n, round(avg(CAST(a = b AS DOUBLE)), 9) AS agreement FROM pairs GROUP BY ALL", ratings=RATINGS)
def pairwise_agreement(ratings):
    return A.exact_agreement(A.paired(ratings), ["dimension", "model_a", "model_b"])


@query("panel_pairwise_kappa", f"+{_PAIRS}, {_kappa('dimension, model_a, model_b', 'pairs')}", ratings=RATINGS)
def pairwise_kappa(ratings):
    return A.kappa(A.paired(ratings), ["dimension", "model_a", "model_b"])


@query("panel_loo_kappa", f"+{_LOO}, lp AS (SELECT r.dimension, r.model, r.label AS a, loo.label AS b FROM ratings r JOIN loo USING (dimension, item_id, model) WHERE r.label IS NOT NULL AND loo.label IS NOT NULL), {_kappa('dimension, model', 'lp')}", ratings=RATINGS)
def loo_kappa(ratings):
    loo = A.loo_majority(ratings).filter("label is not null").withColumnRenamed("label", "b")
    pairs = ratings.filter("label is not null").withColumnRenamed("label", "a").join(loo, ["dimension", "item_id", "model"])
    return A.kappa(pairs, ["dimension", "model"])


@query(
    "panel_self_consistency",
    "+ per AS (SELECT dimension, model, item_id, count(*) AS n, count(DISTINCT label) AS k FROM runs WHERE label IS NOT NULL GROUP BY ALL) SELECT dimension, model, count(*) AS items, round(avg(CAST(k = 1 AS DOUBLE)), 9) AS consistency FROM per WHERE n >= 2 GROUP BY ALL",
    runs="SELECT 'len' AS dimension, doc_id AS item_id, concat('m', CAST(doc_id % 3 AS VARCHAR(20))) AS model, r.run, CASE WHEN (doc_id + r.run) % 7 = 0 THEN NULL ELSE CAST(floor((n_chars + r.run * (doc_id % 5) * 60) / 1000) AS BIGINT) END AS label FROM {documents} CROSS JOIN (SELECT 0 AS run UNION ALL SELECT 1 UNION ALL SELECT 2) r",
)
def self_consistency(runs):
    return A.self_consistency(runs)


@query(
    "validation_split",
    "SELECT label, CASE WHEN err IS NULL AND (score IS NOT NULL OR label = 'none') THEN 'valid' ELSE 'rejected' END AS status, count(*) AS n FROM results GROUP BY ALL",
    results="SELECT CASE WHEN doc_id % 4 = 0 THEN 'none' ELSE 'some' END AS label, CASE WHEN doc_id % 6 = 0 THEN NULL ELSE n_chars END AS score, CASE WHEN doc_id % 17 = 0 THEN 'failed' END AS err FROM {documents}",
)
def validation_split(results):
    ok = N.valid(F.col("err"), F.col("label"), F.col("score"), "none")
    return results.groupBy("label", F.when(ok, "valid").otherwise("rejected").alias("status")).agg(F.count(F.lit(1)).alias("n"))
