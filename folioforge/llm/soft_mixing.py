"""Mixing sources to target weights by soft membership, in DataFrame functions only.

A naive Bayes classifier over binned text features, fitted on a table of
labelled documents, gives every document a posterior over domains.  Projected
gradient descent then fits a nonnegative rate per document such that the
expected tokens of each domain meet their targets.  A rate depends on the
document's feature bins alone, so the descent runs on partial sums per bin
profile: one small aggregation per step, whatever the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, stored

TRAIN_ROWS = 4000  # the labelled sample's bound
LEXICON = 32  # words per domain
BINS = 8
TARGETS = {"clean": 0.95, "toxic": 0.03, "junk": 0.02}


@dataclass
class Domains:
    """A fitted classifier: per domain a log prior, per feature and bin a log likelihood, and the lexicons."""

    names: list[str]
    prior: list[float]
    lexicons: dict[str, list[str]]
    table: dict[str, list[list[float]]]  # feature -> domain -> bin


def _binned(share: Column, scale: float = 1000.0) -> Column:
    return F.least(F.floor(F.log2(1 + scale * share)), F.lit(BINS - 1)).cast("int")


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def feature_bins(text: Column, words: Column, lexicons: Mapping[str, list[str]]) -> dict[str, Column]:
    """Bins from a text and its words; both should be plain columns, as words is used several times."""
    chars, count = F.greatest(F.length(text), F.lit(1)), F.greatest(F.size(words), F.lit(1))
    out = {
        "upper": _binned(F.regexp_count(text, F.lit(r"\p{Lu}")) / chars),
        "symbol": _binned(F.regexp_count(text, F.lit(r"[!%$*&#|@^~]")) / chars),
        "repeat": _binned(F.size(F.filter(words, lambda w, i: (i > 0) & (w == F.get(words, i - 1)))) / count),
    }
    for name, lexicon in lexicons.items():
        if lexicon:
            out[f"words_{name}"] = _binned(F.size(F.array_intersect(words, F.array(*map(F.lit, lexicon)))), 1.0)
    return out


def fit_domains(docs: DataFrame, labels: DataFrame, names: list[str], rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Domains:
    """labels: doc_id, domain.  At most ``rows`` labelled documents, picked by a hash of their ids, are used.

    Of conflicting labels the smallest counts, of several texts of one id the
    smallest.  Domains that are not in ``names`` and null labels are left out.
    """
    known = labels.select(F.col("doc_id").alias("_ff_id"), F.col("domain").alias("_ff_y")).filter(F.col("_ff_id").isNotNull() & F.col("_ff_y").isin(names))
    known = known.groupBy("_ff_id").agg(F.min("_ff_y").alias("_ff_y")).orderBy(F.xxhash64("_ff_id"), "_ff_id").limit(rows)
    texts = docs.select(F.col(id_col).alias("_ff_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_ff_text"))
    sample = texts.join(F.broadcast(known), "_ff_id").groupBy("_ff_id").agg(F.min("_ff_text").alias("_ff_text"), F.min("_ff_y").alias("_ff_y"))
    sample = stored(sample.withColumn("_ff_words", words_of(F.col("_ff_text"))), "mix-sample")
    size = {r["_ff_y"]: r["n"] for r in sample.groupBy("_ff_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(size.values())
    each = sample.select("_ff_y", F.explode(F.array_distinct("_ff_words")).alias("w")).groupBy("w").pivot("_ff_y", names).agg(F.count(F.lit(1))).fillna(0)
    each = stored(each, "mix-words")
    lexicons = {}
    for name in names:
        own, others = size.get(name, 0), total - size.get(name, 0)
        inside, outside = F.col(f"`{name}`"), sum((F.col(f"`{o}`") for o in names if o != name), F.lit(0))
        ratio = (inside + 0.5) / (own + 1) / ((outside + 0.5) / (others + 1))
        top = each.filter((inside >= 5) & (ratio > 4)).orderBy(ratio.desc(), "w").limit(LEXICON)
        lexicons[name] = [r["w"] for r in top.select("w").collect()] if name != max(names, key=lambda n: size.get(n, 0)) else []
    bins = feature_bins(F.col("_ff_text"), F.col("_ff_words"), lexicons)
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("f"), b.alias("b")) for f, b in bins.items())))
    counts = {(r["_ff_y"], r["f"], r["b"]): r["n"] for r in sample.select("_ff_y", pairs.alias("x")).groupBy("_ff_y", "x.f", "x.b").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = {f: [[math.log((counts.get((k, f, b), 0) + 0.5) / (size.get(k, 0) + 0.5 * BINS)) for b in range(BINS)] for k in names] for f in bins}
    return Domains(names, [math.log((size.get(k, 0) + 1) / (total + len(names))) for k in names], lexicons, table)


def posteriors(model: Domains, bins: Mapping[str, Column]) -> list[Column]:
    """P(domain | bins), per domain."""
    logs = []
    for k in range(len(model.names)):
        terms = [F.get(F.array(*map(F.lit, model.table[f][k])), b) for f, b in bins.items()]
        logs.append(sum(terms, F.lit(model.prior[k])))
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    parts = [F.exp(x - top) for x in logs]
    whole = sum(parts[1:], parts[0])
    return [p / whole for p in parts]


def fit_rates(profiles: DataFrame, names: list[str], targets: Mapping[str, float], budget: float | None = None, max_rate: float | None = None, steps: int = 40, tolerance: float = 1e-4) -> tuple[DataFrame, dict[str, float]]:
    """(profiles with a column rate, expected share of each domain).

    profiles: tokens and p_<domain> per group of documents.  Minimises the
    squared distance of expected domain totals to budget * weight from rates of
    1 by projected gradient, each domain scaled by what it holds; stops when no
    total moves any more.  Without a budget the total is such that the domain
    of the largest weight is kept whole; scarcer ones are repeated to reach
    their weights, or kept whole too under ``max_rate`` 1.  Rates are written every few steps, so
    plans stay small.
    """
    clean = {k: max(0.0, targets.get(k, 0.0)) for k in names}
    scale = sum(clean.values()) or 1.0

    def totals(df: DataFrame) -> dict[str, float]:
        got = df.agg(*(F.sum(F.col("tokens") * F.col(f"p_{k}") * F.col("rate")).alias(k) for k in names)).first()
        return {k: float(got[k] or 0) for k in names}

    now = profiles.withColumn("rate", F.lit(1.0))
    held = got = totals(now)
    weight = {k: v / scale for k, v in clean.items()}
    if budget is None:
        budget = max(((weight[k], held[k] / weight[k]) for k in names if weight[k] > 0), default=(0.0, 0.0))[1]
    for step in range(1, steps + 1):
        push = {k: (got[k] - weight[k] * budget) / held[k] for k in names if held[k] > 0}
        if not push or max(map(abs, push.values())) < tolerance:
            break
        rate = F.greatest(F.col("rate") - sum((F.col(f"p_{k}") * g for k, g in push.items()), F.lit(0.0)), F.lit(0.0))
        now = now.withColumn("rate", rate if max_rate is None else F.least(rate, F.lit(float(max_rate))))
        if step % 4 == 0:
            now = stored(now, "mix-rates")
        was, got = got, totals(now)
        if max(abs(got[k] - was[k]) / held[k] for k in push) < tolerance:
            break
    total = sum(got.values()) or 1.0
    return now, {k: got[k] / total for k in names}


def _copies(rate: Column, key: Column) -> Column:
    """Whole copies plus one more with the rate's fraction as its chance, by a hash of the id."""
    chance = F.pmod(F.xxhash64(key, F.lit("mix")), F.lit(1_000_000)) / 1_000_000.0
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("int")).cast("int")


def featured(docs: DataFrame, model: Domains, id_col: str, text_col: str) -> DataFrame:
    """docs with _tokens (words of letters and digits) and one _ff_b_ column per feature."""
    out = docs.withColumn("_ff_text", F.coalesce(F.col(text_col), F.lit(""))).withColumn("_ff_words", words_of(F.col("_ff_text")))
    bins = {f"_ff_b_{f}": b for f, b in feature_bins(F.col("_ff_text"), F.col("_ff_words"), model.lexicons).items()}
    return out.withColumns({"_ff_tokens": F.size("_ff_words").cast("long"), **bins}).drop("_ff_text", "_ff_words")


def _rated(rows: DataFrame, profiles: DataFrame, model: Domains, targets: Mapping[str, float], budget: float | None, max_rate: float | None, id_col: str) -> DataFrame:
    """rows of ``featured`` with posteriors, rates and copies; profiles: tokens per combination of bins."""
    names, bins = model.names, [f"_ff_b_{f}" for f in model.table]
    named = [p.alias(f"p_{k}") for k, p in zip(names, posteriors(model, {f: F.col(f"_ff_b_{f}") for f in model.table}), strict=True)]
    rates, reached = fit_rates(stored(profiles.coalesce(1).select("*", *named), "mix-profiles"), names, targets, budget, max_rate)
    # at most BINS ** features rows of a few numbers: 2 MB for five features
    side = F.broadcast(stored(rates.select(*(F.col(k).alias(f"{k}_") for k in bins), *(F.col(f"p_{k}").alias(f"_ff_p_{k}") for k in names), F.col("rate").alias("_ff_rate"), *(F.lit(reached[k]).alias(f"_ff_share_{k}") for k in names)), "mix-rates"))
    out = rows.join(side, [F.col(k) == F.col(f"{k}_") for k in bins]).drop(*bins, *(f"{k}_" for k in bins))
    return out.withColumn("_ff_copies", _copies(F.col("_ff_rate"), F.col(id_col)))


def mix(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS, budget: float | None = None, max_rate: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of docs with _ff_tokens, _ff_p_<domain>, _ff_rate, _ff_copies and _ff_share_<domain>.

    The shares, the same in every row, are what the domains' expected tokens
    come to under the fitted rates, to be held against the targets.

    Tokens are words of letters and digits.  A null text counts as empty and
    has no tokens, but a rate like any other.  Null ids share one draw;
    repeated ids too.  Without labels every document has the prior's posterior.
    Features are worked out twice, so that no text is written or shuffled.
    """
    model = fit_domains(docs, labels, sorted(targets), id_col=id_col, text_col=text_col)
    rows = featured(docs, model, id_col, text_col)
    profiles = stored(rows.groupBy(*(f"_ff_b_{f}" for f in model.table)).agg(F.sum("_ff_tokens").alias("tokens")), "mix-profiles")
    return _rated(rows, profiles, model, targets, budget, max_rate, id_col)


def mixed(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS, max_rate: float | None = None, **kw) -> DataFrame:
    """docs with every row as often as its copies say, and the columns of docs."""
    out = mix(docs, labels, targets, max_rate=max_rate, **kw)
    out = out.filter("_ff_copies > 0").withColumn("_ff_copy", F.explode(F.sequence(F.lit(1), F.col("_ff_copies"))))
    return out.select(*docs.columns)


def domain_labels(labels: DataFrame) -> DataFrame:
    """The labels table as domains: junk where quality is 0, else toxic or clean."""
    domain = F.when(F.col("quality") == 0, "junk").when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean")
    return labels.select("doc_id", domain.alias("domain"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = sorted(TARGETS)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_domains(docs, domain_labels(read(spark, sf_dir, "labels")), names)
    rows = stored(featured(docs, model, "doc_id", "text").drop("text"), "mix-features")
    profiles = rows.groupBy(*(f"_ff_b_{f}" for f in model.table)).agg(F.sum("_ff_tokens").alias("tokens"))
    out = _rated(rows, profiles, model, TARGETS, None, None, "doc_id")
    return out.select("doc_id", F.col("_ff_tokens").alias("tokens"), *(F.col(f"_ff_p_{k}").alias(f"p_{k}") for k in names), F.col("_ff_rate").alias("rate"), F.col("_ff_copies").alias("copies"), *(F.col(f"_ff_share_{k}").alias(f"share_{k}") for k in names))
