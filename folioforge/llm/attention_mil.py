"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words.  Each passage is encoded
by its byte histogram and word statistics and one hidden layer; gated attention
weights, learned from document labels alone, make one representation of the
bag, which a logistic unit scores.  Training runs on the driver over a bounded
sample of labelled rows; scoring runs over every whole text in Arrow batches.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, read, stored
from .wordhash import SPACED, mix, portions, utf8, word_hashes

PASSAGE = 64
THRESHOLD = 0.3
TRAIN_ROWS = 6000  # the labelled sample's bound
TRAIN_PASSAGES = 1_000_000  # the same sample's bound by passages, of all rows together: rows beyond it are left out, texts are never cut
HIDDEN = 24
BINS = 128
WIDTH = BINS + 6


def encode(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(passages x WIDTH features, first passage per row with the total last)."""
    rows = len(offsets) - 1
    words, first = word_hashes(raw, offsets, SPACED)
    per_row = np.diff(first)
    bags = -(-per_row // PASSAGE)
    start = np.concatenate([[0], np.cumsum(bags)])
    n = int(start[-1])
    if n == 0:
        return np.zeros((0, WIDTH), np.float32), start
    row_of = np.repeat(np.arange(rows), per_row)
    within = np.arange(len(words)) - first[row_of]
    passage = start[row_of] + within // PASSAGE
    is_word = SPACED[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    begins = is_word.copy()
    begins[1:] &= ~is_word[:-1] | edge[1:-1]
    at = np.cumsum(begins) - 1  # the word that each byte belongs to or follows
    word_len = np.bincount(at[is_word], minlength=len(words))
    kind = np.minimum(raw, BINS - 1)[is_word].astype(np.int64)
    grams = np.bincount(passage[at[is_word]] * BINS + kind, minlength=n * BINS).reshape(n, BINS)
    size = np.maximum(grams.sum(1, keepdims=True), 1)
    count = np.bincount(passage, minlength=n)
    same = np.zeros(len(words))
    same[1:] = (words[1:] == words[:-1]) & (passage[1:] == passage[:-1])
    keys = np.unique(mix(words ^ mix(passage.astype(np.uint64))), return_index=True)[1]
    out = np.empty((n, WIDTH), np.float32)
    out[:, :BINS] = np.sqrt(grams / size)
    mean = lambda x: np.bincount(passage, x, minlength=n) / count
    out[:, BINS] = mean(word_len) / 10
    out[:, BINS + 1] = mean(same)
    out[:, BINS + 2] = np.bincount(passage[keys], minlength=n) / count
    out[:, BINS + 3] = mean(word_len >= 20)
    out[:, BINS + 4] = np.log1p(count) / 4
    out[:, BINS + 5] = mean(word_len == 1)
    return out, start


@dataclass
class Model:
    """Weights of the encoder (w, b), the gates (v, u, a) and the scorer (c, c0)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict = field(default_factory=dict)

    def forward(self, x: np.ndarray, start: np.ndarray) -> dict:
        p = self.weights
        h = np.tanh((x - self.mean) / self.scale @ p["w"] + p["b"])
        t, u = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        s = (t * u) @ p["a"]
        rows = len(start) - 1
        row = np.repeat(np.arange(rows), np.diff(start))
        top = np.full(rows, -np.inf)
        np.maximum.at(top, row, s)
        e = np.exp(s - top[row])
        a = e / np.bincount(row, e, minlength=rows)[row]
        z = np.zeros((rows, h.shape[1]))
        full = np.flatnonzero(np.diff(start))
        if len(full):
            z[full] = np.add.reduceat(a[:, None] * h, start[full], axis=0)
        score = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["c0"], -30, 30)))
        return {"h": h, "t": t, "u": u, "a": a, "z": z, "row": row, "score": score}

    def gradient(self, x: np.ndarray, start: np.ndarray, y: np.ndarray) -> tuple[dict, float]:
        p, f = self.weights, self.forward(x, start)
        h, t, u, a, row = f["h"], f["t"], f["u"], f["a"], f["row"]
        d = (f["score"] - y) / len(y)
        dz = d[:, None] * p["c"][None, :]
        back = dz[row]
        da = (back * h).sum(1)
        ds = a * (da - np.bincount(row, a * da, minlength=len(y))[row])
        dg = ds[:, None] * p["a"][None, :]
        dt, du = dg * u * (1 - t * t), dg * t * u * (1 - u)
        dh = a[:, None] * back + dt @ p["v"].T + du @ p["u"].T
        pre = dh * (1 - h * h)
        grads = {"w": ((x - self.mean) / self.scale).T @ pre, "b": pre.sum(0), "v": h.T @ dt, "u": h.T @ du, "a": (t * u).T @ ds, "c": f["z"].T @ d, "c0": d.sum()}
        return grads, float(-np.mean(y * np.log(f["score"]) + (1 - y) * np.log(1 - f["score"])))

    def score(self, x: np.ndarray, start: np.ndarray) -> np.ndarray:
        return self.forward(x, start)["score"]


def fit(bags: list[np.ndarray], y: np.ndarray, epochs: int = 40, batch: int = 256, rate: float = 0.01, seed: int = 0) -> Model:
    """Adam over shuffled batches of bags; the same bags and seed give the same model.

    Without bags, or with one class only, the model scores the prior alone.
    """
    rng = np.random.default_rng(seed)
    each = lambda: (np.concatenate(bags[i : i + batch]).astype(np.float64) for i in range(0, len(bags), batch))
    count = max(1, sum(map(len, bags)))
    mean = sum((x.sum(0) for x in each()), np.zeros(WIDTH)) / count
    model = Model(mean, np.sqrt(sum((((x - mean) ** 2).sum(0) for x in each()), np.zeros(WIDTH)) / count) + 0.02)
    p = {"w": rng.normal(0, WIDTH**-0.5, (WIDTH, HIDDEN)), "b": np.zeros(HIDDEN), "v": rng.normal(0, 0.2, (HIDDEN, HIDDEN)), "u": rng.normal(0, 0.2, (HIDDEN, HIDDEN)), "a": np.zeros(HIDDEN), "c": np.zeros(HIDDEN), "c0": np.zeros(())}
    prior = (y.sum() + 1) / (len(y) + 2)
    p["c0"] = np.array(np.log(prior / (1 - prior)))
    model.weights = p
    if len(y) == 0 or y.min() == y.max():
        return model
    m1, m2, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        now = rate * (1 - epoch / epochs)
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            x = np.concatenate([bags[i] for i in pick]).astype(np.float64)
            start = np.concatenate([[0], np.cumsum([len(bags[i]) for i in pick])])
            grads, _ = model.gradient(x, start, y[pick])
            step += 1
            for k, g in grads.items():
                g = g + 1e-4 * p[k] * (k not in ("b", "c0"))
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.999 * m2[k] + 0.001 * g * g
                p[k] = p[k] - now * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    return model


@F.arrow_udf(returnType=T.BinaryType())
def encoded(text: pa.Array) -> pa.Array:
    """Every passage of a text, as halves."""
    raw, offsets = utf8(text)
    out = []
    for s, e in portions(offsets):
        x, start = encode(raw[offsets[s] : offsets[e]], offsets[s : e + 1] - offsets[s])
        out += [x[a:z].astype(np.float16).tobytes() for a, z in zip(start[:-1].tolist(), start[1:].tolist(), strict=True)]
    return pa.array(out, pa.binary())


def held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS, passages: int = TRAIN_PASSAGES, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fits on at most ``rows`` labelled documents outside the held-out fifth, picked by a hash of their ids.

    Of conflicting labels the smallest counts, of several texts of one id the
    one with the smallest encoding; null labels and ids are left out.  Texts
    train with all their passages; rows are taken in the order of the hash as
    long as they have at most ``passages`` together, so the driver holds 270 MB
    of halves, and one batch of doubles.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("double").alias("_y")).filter(F.col("_id").isNotNull() & F.col("_y").isNotNull() & ~held_out(F.col("_id")))
    known = known.groupBy("_id").agg(F.min("_y").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(rows)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).filter(F.col("_text").isNotNull())
    sample = texts.join(F.broadcast(known), "_id").select("_id", "_y", encoded("_text").alias("bag"))
    sample = stored(sample.groupBy("_id").agg(F.min("bag").alias("bag"), F.min("_y").alias("_y")), "labelled-bags")
    sizes = sample.select("_id", F.xxhash64("_id").alias("h"), (F.length("bag") / (2 * WIDTH)).cast("long").alias("n")).toArrow().sort_by([("h", "ascending"), ("_id", "ascending")])
    fits = int(np.searchsorted(np.cumsum(sizes["n"].to_numpy()), passages, side="right"))
    if fits < len(sizes):
        sample = sample.join(F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in sizes["_id"].to_pylist()[:fits]], sample.select("_id").schema)), "_id")
    got = sample.toArrow().sort_by("_id")
    bags = [np.frombuffer(b, np.float16).reshape(-1, WIDTH) for b in got["bag"].to_pylist()]
    y = got["_y"].to_numpy()
    full = [i for i, b in enumerate(bags) if len(b)]
    return fit([bags[i] for i in full], y[full])


def scorer(spark: SparkSession, model: Model):
    """A column function text -> score from 0 to 1."""
    held = spark.sparkContext.broadcast(model)

    @F.arrow_udf(returnType=T.DoubleType())
    def score(text: pa.Array) -> pa.Array:
        raw, offsets = utf8(text)
        out = [held.value.score(*encode(raw[offsets[s] : offsets[e]], offsets[s : e + 1] - offsets[s])) for s, e in portions(offsets)]
        give_back()
        return pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    return score


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Only the text enters the score.  A null, empty or blank text has no passage
    and gets the score of the zero representation.  Null and repeated ids are
    scored row by row; other columns of docs are ignored.
    """
    model = model or train(docs, labels, id_col=id_col, text_col=text_col)
    score = scorer(docs.sparkSession, model)
    out = docs.select(F.col(id_col).alias("doc_id"), score(F.col(text_col)).alias("score"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
