"""Agreement of several annotators over (item, model, dimension, label) ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ITEM = ["dimension", "item_id"]


def majority(ratings: DataFrame) -> DataFrame:
    """Strict majority label per item among at least two non-null ratings; else null."""
    n = ratings.groupBy(*ITEM, "label").agg(F.count(F.lit(1)).alias("n"))
    per = n.groupBy(*ITEM).agg(F.sum(F.when(F.col("label").isNotNull(), F.col("n")).otherwise(0)).alias("voters"), F.max_by("label", F.when(F.col("label").isNotNull(), F.col("n"))).alias("top"), F.max(F.when(F.col("label").isNotNull(), F.col("n"))).alias("most"))
    wins = (F.col("voters") >= 2) & (F.col("most") * 2 > F.col("voters"))
    return per.select(*ITEM, F.when(wins, F.col("top")).alias("label"))


def loo_majority(ratings: DataFrame) -> DataFrame:
    """Per item and model the majority of all other models."""
    others = ratings.select(*ITEM, F.col("model").alias("other"), "label")
    pairs = ratings.select(*ITEM, "model").join(others, ITEM).filter("model <> other")
    n = pairs.filter("label is not null").groupBy(*ITEM, "model", "label").agg(F.count(F.lit(1)).alias("n"))
    per = n.groupBy(*ITEM, "model").agg(F.sum("n").alias("voters"), F.max_by("label", "n").alias("top"), F.max("n").alias("most"))
    wins = (F.col("voters") >= 2) & (F.col("most") * 2 > F.col("voters"))
    return ratings.select(*ITEM, "model").distinct().join(per.filter(wins).select(*ITEM, "model", F.col("top").alias("label")), [*ITEM, "model"], "left")


def paired(ratings: DataFrame) -> DataFrame:
    """Non-null labels of every two models on the same item: dimension, model_a < model_b, a, b."""
    a = ratings.filter("label is not null").select(*ITEM, F.col("model").alias("model_a"), F.col("label").alias("a"))
    b = ratings.filter("label is not null").select(*ITEM, F.col("model").alias("model_b"), F.col("label").alias("b"))
    return a.join(b, ITEM).filter("model_a < model_b")


def exact_agreement(pairs: DataFrame, keys: list[str]) -> DataFrame:
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("a") == F.col("b")).cast("double")), 9).alias("agreement"))


def kappa(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Unweighted Cohen's kappa per group; null for fewer than two pairs or where chance alone agrees fully."""
    cells = pairs.groupBy(*keys, "a", "b").agg(F.count(F.lit(1)).alias("n"))
    total = cells.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("same"))
    left = cells.groupBy(*keys, F.col("a").alias("label")).agg(F.sum("n").alias("na"))
    right = cells.groupBy(*keys, F.col("b").alias("label")).agg(F.sum("n").alias("nb"))
    chance = left.join(right, [*keys, "label"]).groupBy(*keys).agg(F.sum(F.col("na") * F.col("nb")).alias("chance"))
    out = total.join(chance, keys, "left")
    observed, expected = F.col("same") / F.col("n"), F.coalesce("chance", F.lit(0)) / (F.col("n") * F.col("n"))
    sound = (F.col("n") >= 2) & (F.coalesce("chance", F.lit(0)) < F.col("n") * F.col("n"))
    return out.select(*keys, "n", F.when(sound, F.round((observed - expected) / (1 - expected), 9)).alias("kappa"))


def self_consistency(runs: DataFrame) -> DataFrame:
    """runs (dimension, item_id, model, run, label): share of items rated twice or more with one label only."""
    per = runs.filter("label is not null").groupBy("dimension", "model", "item_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("label").alias("k"))
    return per.filter("n >= 2").groupBy("dimension", "model").agg(F.count(F.lit(1)).alias("items"), F.round(F.avg((F.col("k") == 1).cast("double")), 9).alias("consistency"))
