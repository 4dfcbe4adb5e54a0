"""The corpus operators' queries and their SQL."""

from __future__ import annotations

import corpus_pipeline

from . import attention_mil, decontaminate, divergence_audit, exact_dedup, jaccard_join, kdtree_clusters, license_join, minhash_dedup, secret_ledger, soft_mixing, token_store, url_templates, warc_store

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_quality": attention_mil.op3_quality,
    "op4_secrets": secret_ledger.op4_secrets,
    "op5_jaccard": jaccard_join.op5_jaccard,
    "op6_url_filter": url_templates.op6_url_filter,
    "op7_mixing": soft_mixing.op7_mixing,
    "op8_tokens": token_store.op8_tokens,
    "op9_warc": warc_store.op9_warc,
    "op10_licenses": license_join.op10_licenses,
    "op11_minhash": minhash_dedup.op11_minhash,
    "op12_clusters": kdtree_clusters.op12_clusters,
    "op13_divergence": divergence_audit.op13_divergence,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {"op1_exact_dedup": exact_dedup.SQL, "op9_warc": warc_store.SQL, "op12_clusters": kdtree_clusters.SQL, "op13_divergence": divergence_audit.SQL}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
