"""Gradients, held-out accuracy and odd rows of the quality classifier."""

import numpy as np
import pytest

pytest.importorskip("folioforge.llm")
import pyarrow as pa  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from folioforge.llm import attention_mil as A  # noqa: E402
from folioforge.llm.wordhash import utf8  # noqa: E402


def test_gradient_matches_differences():
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(n, A.WIDTH)).astype(np.float32) for n in (1, 3, 2, 5)]
    y = np.array([0.0, 1.0, 1.0, 0.0])
    model = A.fit(bags, y, epochs=3)
    x, start = np.concatenate(bags).astype(np.float64), np.array([0, 1, 4, 6, 11])
    grads, _ = model.gradient(x, start, y)
    for k in ("w", "v", "u", "a", "c", "b"):
        at = np.unravel_index(np.argmax(np.abs(grads[k])), grads[k].shape)
        keep, losses = model.weights[k][at], []
        for eps in (1e-5, -1e-5):
            model.weights[k] = model.weights[k].copy()
            model.weights[k][at] = keep + eps
            losses.append(model.gradient(x, start, y)[1])
        model.weights[k][at] = keep
        assert (losses[0] - losses[1]) / 2e-5 == pytest.approx(grads[k][at], rel=1e-3, abs=1e-8)


def test_encode_by_hand():
    raw, offsets = utf8(pa.array(["a bb bb\tA!", None, "  ", "é " * 130]))
    x, start = A.encode(raw, offsets)
    assert start.tolist() == [0, 1, 1, 1, 4]
    assert x[0, A.BINS + 1] == pytest.approx(0.25) and x[0, A.BINS + 2] == pytest.approx(0.75)
    assert x[0, ord("b")] == pytest.approx((4 / 7) ** 0.5) and x[0, ord("A")] == pytest.approx((1 / 7) ** 0.5)
    assert x[1, A.BINS - 1] == pytest.approx(1)


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = A.train(docs, labels)
    got = A.classify(docs, labels, model=model).join(labels, "doc_id").filter("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.95
    assert np.mean([a > b for a in got.score[got.quality == 1] for b in got.score[got.quality == 0]]) > 0.98
    odd = spark.createDataFrame([(None, None, "s"), (1, "", "s"), (1, " \n", "s"), (2, "word " * 50_000, "s"), (2, "x", "s")], "doc_id long, text string, score string")
    rows = A.classify(odd, labels, model=model).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows[:3]}) == 1
    assert A.classify(odd.limit(0), labels.limit(0)).count() == 0
    assert A.classify(odd, labels.limit(0)).count() == 5


def test_texts_train_with_all_their_passages(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(64 * 40))
    docs = spark.createDataFrame([(1, text), (2, "a b"), (3, "c"), (4, None), (6, "d e " * 500)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 7)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(A, "fit", lambda bags, y: seen.append((sorted(map(len, bags)), len(y))))
    A.train(docs, labels)
    held = {r[0] for r in labels.filter(A.held_out(F.col("doc_id"))).select("doc_id").collect()}
    sizes = {1: 40, 2: 1, 3: 1, 6: 16}
    want = sorted(n for i, n in sizes.items() if i not in held)
    assert seen[0] == (want, len(want))
    A.train(docs, labels, passages=max(want) - 1)
    assert sum(seen[1][0]) <= max(want) - 1 and set(seen[1][0]) <= set(want)  # whole rows, fewer of them


def test_attention_and_ranking_on_held_out_rows(spark):
    """Attention is told apart from the mean of passages where one passage of many spoils a text."""
    rng = np.random.default_rng(5)
    good, bad = rng.normal(size=(2, A.WIDTH)).astype(np.float32)
    bags, y = [], []
    for i in range(600):
        bag = good + rng.normal(scale=0.7, size=(rng.integers(4, 40), A.WIDTH)).astype(np.float32)
        if i % 3 == 0:
            bag[rng.integers(len(bag))] = bad + rng.normal(scale=0.3, size=A.WIDTH)
        bags.append(bag), y.append(float(i % 3 != 0))
    y = np.array(y)
    model = A.fit(bags[:450], y[:450])

    def auc(m):
        x, start = np.concatenate(bags[450:]).astype(np.float64), np.concatenate([[0], np.cumsum([len(b) for b in bags[450:]])])
        score = m.score(x, start)
        return np.mean([a > b for a in score[y[450:] == 1] for b in score[y[450:] == 0]])

    with_attention = auc(model)
    model.weights["a"] = np.zeros_like(model.weights["a"])
    assert with_attention > 0.95 and with_attention > auc(model) + 0.02
