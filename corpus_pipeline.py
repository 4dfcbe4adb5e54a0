"""The corpus pipeline: four filtering stages and the token store.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and returns a DataFrame; ``run`` writes each as Parquet in the shared
folder and reads it again as the next one's docs.  All stages but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import attention_mil, decontaminate, jaccard_join, soft_mixing, token_store
from folioforge.llm.common import drop_ids, read, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Rows are judged one by one by their text alone; null, empty and blank texts
    have the score of an empty document.  Null and repeated ids and labels, very
    long texts, an empty table and other columns are as in ``attention_mil``.
    """
    model = attention_mil.train(docs, read(spark, sf_dir, "labels"))
    score = attention_mil.scorer(spark, model)
    return docs.withColumn("_ff_score", score("text")).filter(F.col("_ff_score") >= attention_mil.THRESHOLD).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of the n-gram Jaccard join the row with the smallest doc_id, null ids last; repeated ids are rows of their own."""
    rows = stored(docs.withColumn("_ff_row", F.monotonically_increasing_id()), "rows")  # stored: row numbers must not change between scans
    classes = jaccard_join.jaccard_classes(rows, id_col="_ff_row").select(F.col("doc_id").alias("_ff_row"), "component_id")
    named = classes.join(rows.select("_ff_row", "doc_id"), "_ff_row")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_ff_row")).alias("kept")
    kept = named.groupBy("component_id").agg(least).select("kept._ff_row")
    gone = rows.select("_ff_row").join(kept, "_ff_row", "left_anti")
    return drop_ids(rows, stored(gone, "near-copies"), "_ff_row").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window.

    Rows are judged one by one: null and empty texts stay, repeated rows and
    ids stay or go alike.  The benchmark comes in bounded blocks; each is held
    against what the blocks before it left, which is stored in between, so a
    worker holds one block, however large the benchmark.
    """
    blocks = decontaminate.item_blocks(read(spark, sf_dir, "benchmark"))
    block = next(blocks)
    while True:
        found = decontaminate.hits_of(spark, block)
        left = docs.withColumn("_ff_hits", found("text")).filter(F.size("_ff_hits.items") == 0).select(*docs.columns)
        block = next(blocks, None)
        if block is None:
            return left
        docs = stored(left, "clean")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at the rates that meet the domains' target weights, each once at most.

    Whether a row stays depends on its features and its id, so rows repeating
    an id and a text stay or go together; null ids share one draw, null texts
    count as empty.  An empty table stays empty.
    """
    return soft_mixing.mixed(docs, soft_mixing.domain_labels(read(spark, sf_dir, "labels")), max_rate=1.0)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token store's read-back: doc_id, start, n_tokens, ids_crc32; null texts are empty ones, rows repeating an id are documents of their own."""
    return token_store.tokenise(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
    ("token-ID / binary output", tokens),
]

#: the trained stages cannot be said in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").replace("/", ""))
    return docs
