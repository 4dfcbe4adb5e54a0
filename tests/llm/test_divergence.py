"""The divergence audit against plain counting, and its SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

pytest.importorskip("folioforge.llm")
from folioforge.llm import divergence_audit as D  # noqa: E402


def brute(rows, least, top):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        docs[lang].update(set(words))
        counts[lang, source].update(words)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        total = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: 1 + 10**9 * (counts[lang, s][t] + 5) // (total[s] + 5 * len(kept)) for t in kept} for s in sources}
        q = {t: 1 + 10**9 * (sum(counts[lang, s][t] for s in sources) + 5) // (sum(total.values()) + 5 * len(kept)) for t in kept}
        for s in sources:
            pair = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            term = [(q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", i.decode(), -v, r) for r, (v, i) in enumerate(sorted(pair), 1)]
            out += [(lang, s, "term", i.decode(), -v, r) for r, (v, i) in enumerate(sorted(term)[:top], 1)]
    return sorted(out)


def check(spark, rows, least=3, top=4, **kw):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, n long, term string")
    got = sorted(map(tuple, D.divergence(docs, least, top, **kw).collect()))
    assert got == brute(rows, least, top)
    return got


@pytest.mark.parametrize("chunk_rows", [5, 100_000])
def test_odd_rows_and_ties(spark, chunk_rows):
    rng = random.Random(1)
    words = ["é", "Zebra", "zebra", "A", "b", "ß", "İ", "x1y", "under_score", "日本", "\U0001f600", "don't", "\x00q\x7f", "rare"]
    rows = [(rng.choice(["en", "fr", None, ""]), rng.choice(["s1", "S1", None, "é", "z"]), " ".join(rng.choices(words, k=rng.randrange(9)))) for _ in range(120)]
    rows += [("de", "only", "ein wort"), ("it", "a", None), ("it", "b", ""), ("it", "c", "12 34 !!"), ("en", "wordless", ""), ("fr", "long", "é A b " * 50_000)]
    got = check(spark, rows + rows[:10], chunk_rows=chunk_rows)
    assert {g[2] for g in got} == {"pair", "term"} and any(g[:2] == ("it", "a") and g[4] == 0 for g in got)


def test_empty_table(spark):
    check(spark, [])


def test_shares_are_exact():
    rng = random.Random(2)
    for _ in range(300):
        whole = rng.randrange(5, 1 << rng.randrange(4, 53))
        n = rng.randrange(0, whole - 4)
        assert D.shares(np.array([n]), np.array([whole])).tolist() == [1 + 10**9 * (n + 5) // whole]


def test_dense_blocks_change_nothing(spark, monkeypatch):
    rows = [("en", f"s{i % 11}", " ".join(f"w{chr(97 + (i * j) % 23)}" for j in range(12))) for i in range(90)]
    monkeypatch.setattr(D, "DENSE", 30)
    check(spark, rows)


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    got = D.op13_divergence(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(f"SELECT lang, source, part, item, value, rank FROM ({D.SQL})").fetchall())
