"""Winnowing against a search for every window."""

import random
import re

import pytest

pytest.importorskip("folioforge.llm")
import pyarrow as pa  # noqa: E402

from folioforge.llm import decontaminate as D  # noqa: E402
from folioforge.llm.wordhash import ALNUM, SPACED, ngrams, utf8, word_hashes  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n_hit string, items int"


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for name, text in items:
        w = words_of(text)
        if w and name is not None:
            n = min(10, len(w))
            for i in range(len(w) - n + 1):
                windows.setdefault(tuple(w[i : i + n]), set()).add(str(name))
    lengths = {len(k) for k in windows}
    for doc_id, text in docs:
        w, hit, names = words_of(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if got := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    names |= got
        yield (str(doc_id), len(w), len(hit), sorted(names), bool(hit))


def check(spark, docs, bench, **kw):
    got = [(str(r["doc_id"]), r["n_words"], r["n_hit"], list(r["items"]), r["contaminated"]) for r in D.contamination(docs, bench, **kw).collect()]
    want = list(brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in bench.collect()]))
    assert sorted(got) == sorted(want)
    return want


def test_corpus(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    assert any(x[4] for x in check(spark, docs, bench))
    check(spark, docs, bench, limit=100)


def test_odd_rows(spark):
    rng = random.Random(7)
    vocab = ["a", "B", "é", "x1", "Zz", "c", "d"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    bench = spark.createDataFrame([(1, text(30)), (1, text(12)), (2, text(10)), (3, text(4)), (4, "é"), (5, ""), (6, None), (None, text(11)), (10, "one")], "item_id long, text string")
    docs = [(i, text(rng.randrange(0, 60)), "n", 0) for i in range(60)] + [(None, None, "n", 0), (5, "", "n", 0), (5, "one", "n", 0), (6, " one\none-ONE ", "n", 0), (7, text(60_000), "n", 0)]
    docs = spark.createDataFrame(docs, DOCS)
    check(spark, docs, bench)
    check(spark, docs, bench.limit(0))
    check(spark, docs.limit(0), bench)


def test_hashes_follow_words_and_rows():
    rng = random.Random(3)
    texts = ["".join(rng.choice("aAbÉé 😀,9\n\t") for _ in range(rng.randrange(0, 40))) for _ in range(300)] + [None, "", "x" * 400_000 + " y", "q w " * 90_000]
    for table, pattern in ((ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (SPACED, r"[^\x20\x09-\x0D]+")):
        raw, offsets = utf8(pa.array(texts))
        got, first = word_hashes(raw, offsets, table)
        words = [re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
        assert first.tolist() == [sum(map(len, words[:i])) for i in range(len(texts) + 1)]
        flat = [w for ws in words for w in ws]
        seen = dict(zip(flat, got.tolist(), strict=True))
        assert [seen[w] for w in flat] == got.tolist() and len(set(seen.values())) == len(seen)
    assert ngrams(got[:5], 5)[0] != ngrams(got[:4], 4)[0]


def test_long_items_go_in_pieces(spark):
    rng = random.Random(11)
    text = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    long, short = text(137), text(25)
    words = long.split(" ")
    bench = spark.createDataFrame([(1, long), (2, short), (3, "w1 w2")], "item_id long, text string")
    assert max(sum(len(h) for h, _ in b.lengths.values()) for b in D.item_blocks(bench, 20)) < 40
    docs = [(i, " ".join(["x", *words[i : i + 10], "y"]), "n", 0) for i in range(128)] + [(200, long, "n", 0), (201, short, "n", 0), (None, short, "n", 0), (None, None, "n", 0), (201, "q", "n", 0)]
    docs = spark.createDataFrame(docs, DOCS)
    assert sum(x[4] for x in check(spark, docs, bench, limit=20)) >= 131
    check(spark, docs, bench, limit=1_000_000)
