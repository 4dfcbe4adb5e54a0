"""Posteriors on held-out labels, targets met, and the descent against a direct solution."""

import numpy as np
import pytest

pytest.importorskip("folioforge.llm")
from pyspark.sql import functions as F  # noqa: E402

from folioforge.llm import soft_mixing as M  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_targets_are_met_and_domains_found(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    domains = M.domain_labels(labels)
    train, held = domains.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0), domains.filter(F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    out = M.mix(docs, train).cache()
    got = out.join(held, "doc_id").select("domain", *(f"_ff_p_{k}" for k in sorted(M.TARGETS))).toPandas()
    best = got[[f"_ff_p_{k}" for k in sorted(M.TARGETS)]].to_numpy().argmax(1)
    assert np.mean([sorted(M.TARGETS)[i] == d for i, d in zip(best, got.domain, strict=True)]) > 0.85
    sums = out.agg(*(F.sum(F.col("_ff_tokens") * F.col(f"_ff_p_{k}") * F.col("_ff_rate")).alias(k) for k in M.TARGETS), F.min("_ff_rate").alias("low")).first()
    total = sum(sums[k] for k in M.TARGETS)
    for k, w in M.TARGETS.items():
        assert sums[k] / total == pytest.approx(w, abs=0.01)
        assert out.first()[f"_ff_share_{k}"] == pytest.approx(sums[k] / total, rel=1e-6)
    assert sums["low"] >= 0
    clean = out.filter("_ff_p_clean > 0.95")
    assert clean.filter("_ff_copies = 0").count() == 0
    rows = M.mixed(docs, train)
    assert rows.columns == docs.columns and rows.count() == out.agg(F.sum("_ff_copies")).first()[0]


def test_descent_reaches_feasible_targets(spark):
    rng = np.random.default_rng(0)
    p = rng.dirichlet([0.3, 0.3, 0.3], 50)
    rows = [(int(t), *map(float, x)) for t, x in zip(rng.integers(1, 1000, 50), p, strict=True)]
    profiles = spark.createDataFrame(rows, "tokens long, p_a double, p_b double, p_c double").coalesce(1)
    _, share = M.fit_rates(profiles, ["a", "b", "c"], {"a": 0.5, "b": 0.3, "c": 0.2}, steps=200, tolerance=1e-7)
    assert share["a"] == pytest.approx(0.5, abs=1e-3) and share["c"] == pytest.approx(0.2, abs=1e-3)


def test_odd_rows(spark):
    rows = [(None, None, 1.0, "k"), (1, "", 2.0, "k"), (1, "HELLO!! WORLD!!", 3.0, "k"), (2, "word " * 50_000, 4.0, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, p_clean double, domain string")
    none = spark.createDataFrame([], "doc_id long, domain string")
    out = M.mix(docs, none).collect()
    assert len(out) == 4 and sorted(r["p_clean"] for r in out) == [1, 2, 3, 4] and all(r["_ff_rate"] >= 0 for r in out)
    assert M.mix(docs.limit(0), none).count() == 0
    odd = spark.createDataFrame([(1, "clean"), (1, "junk"), (2, None), (None, "toxic"), (2, "other")], "doc_id long, domain string")
    assert M.mix(docs, odd).count() == 4
    assert M.mixed(docs, odd, max_rate=1.0).columns == docs.columns


def test_names_that_stages_use_inside(spark):
    docs = spark.createDataFrame([(1, "one two", "a", "b", 1.5, 2), (2, None, "c", None, 2.5, 3)], "doc_id long, text string, _text string, _words string, _rate double, _copies int")
    out = M.mixed(docs, spark.createDataFrame([(1, "clean")], "doc_id long, domain string"), max_rate=1.0)
    assert out.columns == docs.columns and {r["_text"] for r in out.collect()} <= {"a", "c"}
