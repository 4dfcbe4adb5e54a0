"""Hand-computed cases of the engine's own operators."""

import random
import re

import pytest
from pyspark.sql import functions as F

from folioforge.functions import markup as M
from folioforge.functions import secrets as S
from folioforge.functions import text as X
from folioforge.functions import values as V
from folioforge.operators import agreement as A
from folioforge.operators import annotate as N
from folioforge.operators import documents as D
from folioforge.operators import reconcile as R
from folioforge.operators import runtime as T
from folioforge.operators import upsert as U
from folioforge.plans.base import derive


def one(spark, column, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("value, name, score", [("Bamako", "Bamako", 1.0), ("Bamako", "Cotonou", 0.0), ("Lemaire Hélène", "Hélène Lemaire", 0.92), ("Côte d'Ivoire", "Cote d’Ivoire", 0.92), ("Union Musulmane du Togo", "Union Musulmane Togo", 0.963158), ("Grande mosquee Cotonou", "Grande mosquée de Cotonou", 0.966667), ("Union Musulmane du Togo", "Union Musulmanes du Togo", 0.0), ("Ouagadougou", "Ouagadogou", 0.0), ("Mali", "Malia", 0.0), ("Grande Mosquée de Porto-Novo", "Mosquée Grande de Porto-Novo", 0.0), ("pour les", "pour le", 0.653333)])
def test_similarity(spark, value, name, score):
    assert R.scored(spark.createDataFrame([(value, name)], "value string, name string")).first()["score"] == pytest.approx(score, abs=1e-6)


def test_marks_of_any_letter(spark):
    values = spark.createDataFrame([("Ḥajj Ṣāliḥ mosque",), ("Ha\u0323jj S\u0323a\u0304lih\u0323 mosque",)], "value string")
    names = spark.createDataFrame([("1", "Hajj Salih mosque", 0)], "id string, name string, variant int")
    assert [(r["id"], r["score"]) for r in R.fuzzy_candidates(values, names).collect()] == [("1", 0.92)] * 2


def test_reconcile_ambiguity_and_blanks(spark):
    names = spark.createDataFrame([("10", "Bamako"), ("20", "Union"), ("30", "Union")], "id string, name string")
    rows = spark.createDataFrame([(1, "Bamako|Union|Unknown"), (2, "A||B")], "id long, v string")
    found = R.lookup(R.tokens(rows, "id", "v"), R.authority_index(names))
    by = {r["row_id"]: r["authority_ids"] for r in R.reconciled_rows(found).collect()}
    assert by == {1: "10", 2: ""}
    stats = R.statistics(found).first()
    assert (stats["total"], stats["matched"], stats["distinct_unreconciled"]) == (6, 1, 4)
    assert {r["value"]: r["n"] for r in R.unreconciled(found).collect()} == {"Union (Ambiguous)": 1, "Unknown": 1, "A": 1, "B": 1}


def test_fuzzy_join_loses_nothing(spark):
    values = ["Grande mosquee Cotonou", "Union Musulmane Togo", "pour le", "Bamako", "Lemaire Hélène", "islam"]
    names = [("1", "Grande mosquée de Cotonou", 0), ("2", "Union Musulmane du Togo", 0), ("3", "Ville de Bamako", 1), ("3", "Bamako", 0), ("4", "Hélène Lemaire", 0), ("5", "Islam", 0)]
    every = spark.createDataFrame([(v, n) for v in values for _, n, _ in names], "value string, name string")
    all_scores = {(r["value"], r["name"]): r["score"] for r in R.scored(every).collect()}
    got = {(r["value"], r["id"]) for r in R.fuzzy_candidates(spark.createDataFrame([(v,) for v in values], "value string"), spark.createDataFrame(names, "id string, name string, variant int"), k=9).collect()}
    assert got == {(v, i) for v in values for i, n, _ in names if all_scores[v, n] >= 0.88}


@pytest.mark.parametrize("duration, seconds", [("PT6M51S", 411), ("PT33M36S", 2016), ("PT1H2M3S", 3723), ("PT571M", 34260), ("P1DT2H", 93600), ("PT30.5S", 31), ("", None), (None, None), ("33M36S", None), ("P", None), ("PT", None), ("P1M", None), ("PT0S", None), (" PT5S ", 5), ("nonsense", None)])
def test_durations(spark, duration, seconds):
    assert spark.createDataFrame([(duration,)], "d string").select(X.iso_seconds(F.col("d"))).first()[0] == seconds


def test_clock_and_keys(spark):
    rows = spark.createDataFrame([(0.0,), (497.6,), (3723.0,), (None,)], "s double").select(X.clock(F.col("s")).alias("t")).collect()
    assert [r["t"] for r in rows] == ["00:00:00", "00:08:18", "01:02:03", "??:??:??"]
    assert one(spark, X.compact_key(F.col("a")), a="Ouaga-dougou") == one(spark, X.compact_key(F.col("a")), a="Ouagadougou")
    assert one(spark, X.compact_key(F.col("a")), a=" Côte  d’Ivoire") == "coted'ivoire"
    assert one(spark, X.clean_entity(F.col("a")), a=" union DE l'ÉGLISE  jean-paul ") == "Union de L'Église Jean-paul"
    assert one(spark, X.tidy_whitespace(F.col("a")), a="\n a \r\n\n\n\n b \tc  ") == "a\n\n b \tc".replace(" b", "b", 1)


@pytest.mark.parametrize("url, video", [("https://www.youtube.com/watch?v=abcdefghijk&t=1", "abcdefghijk"), ("https://youtu.be/abcdefghijk?x=1", "abcdefghijk"), ("http://m.youtube.com/shorts/abcdefghijk", None), (" https://m.youtube.com/watch?a=b&v=abcdefghijk#t ", "abcdefghijk"), ("https://youtube.com/embed/abcdefghijk", None), ("https://www.youtube-nocookie.com/watch?v=abcdefghijk", None), ("https://youtu.be/short", None), ("https://example.com/watch?v=abcdefghijk", None), (None, None)])
def test_video_ids(spark, url, video):
    assert spark.createDataFrame([(url,)], "u string").select(X.video_id(F.col("u"))).first()[0] == video


def test_majority_kappa_consistency(spark):
    rate = lambda labels: spark.createDataFrame([("d", "1", f"m{i}", x) for i, x in enumerate(labels)], "dimension string, item_id string, model string, label string")
    for labels, want in ((["p", "p", "n"], "p"), (["p", "n"], None), (["p", None], None)):
        assert A.majority(rate(labels)).first()["label"] == want
    for a, b, want in (("AABBC", "AABCC", 0.705882353), ("AAB", "ABB", 0.4), ("AABB", "BBAA", -1.0), ("AAA", "AAA", None), ("A", "A", None)):
        pairs = spark.createDataFrame([("d", x, y) for x, y in zip(a, b, strict=True)], "k string, a string, b string")
        assert A.kappa(pairs, ["k"]).first()["kappa"] == (None if want is None else pytest.approx(want))


def test_log_rules_differ(spark):
    log = spark.createDataFrame([(1, 1, "p1", None), (1, 2, "p2", None), (2, 3, "p1", "bad"), (2, 4, "p1", None), (2, 5, "p1", "bad")], "item long, seq long, prompt string, err string")
    p1 = F.col("prompt") == "p1"
    assert [r["item"] for r in N.cached(log, ["item"], "seq", p1).collect()] == [2]
    assert sorted(r["item"] for r in N.latest_of(log, ["item"], "seq", p1).collect()) == [1, 2]
    assert sorted(r["item"] for r in N.done(log, ["item"], p1 & F.col("err").isNull()).collect()) == [1, 2]


def test_model_map_keeps_errors_as_rows(spark):
    rows = spark.createDataFrame([(1, "abc", "ok"), (2, " ", "ok"), (3, "abc", "broken")], "item_id long, text string, model string")

    def client(model, text):
        if model == "broken":
            raise RuntimeError("no")
        return text.upper()

    got = {r["item_id"]: (r["result"], r["error"]) for r in N.map_over_models(rows, client).collect()}
    assert got == {1: ("ABC", None), 2: (None, "empty text"), 3: (None, "no")}


def test_turns_chunks_windows(spark):
    said = spark.createDataFrame([(1, 1, None, "a"), (1, 2, "A", "b"), (1, 3, "A", "c"), (1, 4, "B", "d"), (1, 5, None, "e"), (1, 6, "B", " ")], "k long, o long, s string, t string")
    got = [(r["speaker"], r["text"]) for r in D.speaker_turns(said, "k", ["o"], "s", "t").orderBy("turn").collect()]
    assert got == [(None, "a"), ("A", "b c"), ("B", "d e")]
    plan = spark.range(1).select(D.chunk_plan(F.lit(5000), 2000, 15).alias("c")).first()["c"]
    assert [(x["start"], x["end"]) for x in plan] == [(0, 2000), (1985, 4000), (3985, 5000)]
    assert [tuple(x) for x in spark.range(1).select(D.chunk_plan(F.lit(2700), 2700, 15).alias("c")).first()["c"]] == [(0, 0, None)]
    with pytest.raises(ValueError):
        D.chunk_plan(F.lit(1), 10, 10)
    windows = spark.range(1).select(D.sample_windows(F.lit(2000), 45, 2).alias("c")).first()["c"]
    assert [(x["start"], x["end"]) for x in windows] == [(200, 245), (1100, 1145)]


def test_upserts(spark):
    schema = "v array<struct<value:string,lang:string>>, t string"
    rows = spark.createDataFrame([([("a", None)], "a"), ([("a", None), ("b", "fr")], "c"), ([("x", "en")], "c"), ([("x", "en")], " "), (None, "c")], schema)
    got = [[tuple(x) for x in r["x"]] for r in rows.select(U.upsert_literal(F.col("v"), F.col("t"), F.lit("fr"), adopt_untagged=True).alias("x")).collect()]
    assert got == [[("a", "fr")], [("a", None), ("c", "fr")], [("x", "en"), ("c", "fr")], [("x", "en")], [("c", "fr")]]
    links = spark.createDataFrame([([1, 2], [2, 3, 3])], "a array<long>, b array<long>").select(U.append_links(F.col("a"), F.col("b")).alias("x")).first()["x"]
    assert links == [1, 2, 3]


def test_value_selection(spark):
    schema = "v array<struct<value:string,lang:string,id:long>>"
    rows = spark.createDataFrame([([(None, None, 5), ("en", "en", None), ("", "fr", None)],), ([(None, None, 5), ("t ", None, None)],)], schema)
    got = rows.select(V.french_or_first(F.col("v")).alias("a"), V.first_literal(F.col("v")).alias("b"), V.linked_ids(F.col("v")).alias("c"), V.summary_in(F.col("v"), "fr").alias("d")).collect()
    assert [tuple(r) for r in got] == [("", "en", "5", None), ("", "t", "5", "t ")]


def test_redaction(spark):
    assert one(spark, X.redact(F.col("a")), a="u?api_key=abc&page=19 token = kept Authorization: x sk-abcdefghijklmnopqrs") == "u?api_key=<redacted>&page=19 token = kept Authorization: <redacted> <redacted>"


@pytest.mark.parametrize("size", [12, 40, 200])
def test_scrub_against_all_pieces(spark, size):
    """Every piece of at least 12 characters, the longest first, by one search each."""
    rng = random.Random(size)
    secret = "".join(rng.choice("abAB12-_+" if size < 200 else "ab1") for _ in range(size))

    def brute(text):
        for n in range(size, 11, -1):
            for a in range(size - n + 1):
                text = re.sub(r"\s*".join(map(re.escape, secret[a : a + n])), "<redacted>", text)
        return text

    texts = [secret, f"k={secret}!", secret[:11], secret[1:] + secret, secret[: size - 3] + "\n   " + secret[size - 3 :], "".join(c + " " for c in secret), "", "no secret here"]
    for _ in range(12):
        cut = sorted(rng.sample(range(size + 1), 2))
        texts.append("x" + secret[cut[0] : cut[1]] + rng.choice(["", " ", "y"]) + secret[rng.randrange(size) :])
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string")
    got = {r["i"]: r["x"] for r in rows.select("i", S.scrub(F.col("t"), [secret, "short", None]).alias("x")).collect()}
    assert got == {**{i: brute(t) for i, t in enumerate(texts)}, len(texts): None}


def test_scrub_refuses_white_space():
    with pytest.raises(ValueError):
        S.scrub(F.lit("x"), ["a secret of words"])


def test_load_report_reads_whole_lines(spark):
    sound = '{"v": "1", "item_id": "%s", "model": "m", "result": {}}'
    lines = [sound % "a", sound % "a", sound % "b" + " }", sound % "c" + "garbage", sound % "d" + ", " + sound % "e", '{"v": "1", "item', "", " \t", "[1]", "7", '{"v": "2"}', '{"item_id": "x"}', sound % "", '{"v": "1", "item_id": "f", "result": {}}', '{"v": "1", "item_id": "f", "model": "m", "result": []}', '{"v": "1", "item_id": "f", "model": null, "result": {}}', sound % "g \u241e", '1,"\u241e"],[2', "  " + sound % 5]
    report = N.load_report(spark.createDataFrame(list(enumerate(lines)), "pos long, line string"), "1").first()
    assert tuple(report) == (4, 3, 11, 2, 2)
    assert tuple(N.load_report(spark.createDataFrame([], "pos long, line string"), "1").first()) == (0, 0, 0, 0, None)


def test_a_spent_quota_is_terminal():
    calls = []

    def call():
        calls.append(1)
        raise N.QuotaStop("spent")

    with pytest.raises(T.Terminal):
        T.retried(call, sleep=lambda s: None)()
    assert len(calls) == 1


def test_unknown_braces_raise(spark):
    with pytest.raises(ValueError):
        derive(spark, "/root/testdata/sf0.001", "SELECT '$x^{2}$' AS t FROM {region}")


def test_loops(spark):
    docs = spark.createDataFrame([(1, "la la " * 300), (2, " ".join(f"w{i}" for i in range(60))), (3, "short text")], "doc_id long, text string")
    out = D.most_repeated(docs)
    got = {r["doc_id"]: r["r"] for r in out.select("doc_id", D.looping(out).alias("r")).collect()}
    assert got == {1: "looping-589x", 2: None, 3: None}


@pytest.mark.parametrize("md, text", [("![alt](a.png) __b__ **c** `d` [e](f) <https://g.h>", " b c d e https://g.h".strip()), ("# T\n---\n> q\n```x\ncode\n```", "T\nq\ncode"), ("| a | b |\n|---|:-:|\n|c|d|", "a\tb\nc\td"), ("x$^{7}$ $_{2}$ $5 \\\\mathrm{e}_n$ $9", "x⁷ ₂ 5 en $9"), ("*it* a*b*c * no *", "it a*b*c * no *"), ("a  \n\n\n\n b", "a\n\n b"), (None, ""), ("[a](b", "[a](b"), ("[x [y](z) *a* **b", "x [y a **b"), ("**a *b* c** __d\ne__", "a b c __d\ne__"), ("`` `x` <ftp://a> <http://a b>", "` x` <ftp://a> <http://a b>"), ("####### no\n   ## yes\n    # no", "####### no\nyes\n    # no"), ("|-|\n-\n:-:\n| a |\n||\n|", "a\n\n|"), ("![a][b](c)![d](e", "![a]b![d](e"), ("$a_b\n_c$ $x^{a1}_{2}$", "$a_b\n_c$ xa¹₂")])
def test_markdown(spark, md, text):
    assert spark.createDataFrame([(md.replace("\\\\", "\\") if md else md,)], "t string").select(M.strip_line_markup(F.col("t"))).first()[0] == text


def test_numbering_over_ranges(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 10 else None if i % 20 else "cold", f"t{i}") for i in range(500)], "id long, g string, t string")
    got = D.numbered(rows.repartition(7), "g", ["id"]).collect()
    for g in ("hot", "cold", None):
        mine = sorted((r["id"], r["place"], r["of"], r["t"]) for r in got if r["g"] == g)
        assert [(p, n, t) for _, p, n, t in mine] == [(k + 1, len(mine), f"t{i}") for k, (i, *_) in enumerate(mine)]
    assert len(got) == 500


def test_loops_stay_in_their_row(spark):
    docs = spark.createDataFrame([(1, "a b " * 40)], "doc_id long, text string")
    assert "Exchange" not in D.most_repeated(docs)._jdf.queryExecution().executedPlan().toString()


def test_scrub_and_entities(spark):
    assert one(spark, S.scrub(F.col("a"), ["wP9Yabcdefgh12345", "short"]), a="k=wP9Y\n  abcdefgh12345 then abcdefgh1234 and short") == "k=<redacted> then <redacted> and short"
    names = spark.createDataFrame([(1, 0, "Abc"), (1, 1, "abC"), (1, 2, ""), (1, 3, "")], "k long, pos long, n string")
    assert sorted((r["n"], r["pos"]) for r in D.first_entities(names, "k", "pos", "n").collect()) == [("", 2), ("Abc", 0)]


def test_link_updates_and_sums(spark):
    updates = spark.createDataFrame([(" 9", "a", "3| 3|junk||1.5|0"), (" 9", "b", "1"), ("12", "a", "0"), ("x", "a", "1"), (None, "a", "1"), ("77", "a", "1"), ("13", "a", None)], "item_id string, term string, ids string")
    links = spark.createDataFrame([(9, "a", [3]), (12, "a", [0])], "item_id long, term string, links array<long>")
    items = spark.createDataFrame([(9,), (12,), (13,), (13,)], "item_id long")
    dry = {(r["item_id"], r["term"]): (r["after"], r["added"], r["status"]) for r in U.link_updates(updates, links, items, True).collect()}
    assert dry == {(" 9", "a"): ([3, 0], 1, "would_update"), (" 9", "b"): ([1], 1, "would_update"), ("12", "a"): ([0], 0, "unchanged"), ("x", "a"): ([1], 1, "invalid_id"), (None, "a"): ([1], 1, "invalid_id"), ("77", "a"): ([1], 1, "not_found"), ("13", "a"): ([], 0, "unchanged")}
    live = U.link_updates(updates, links, items, False, sent=items.filter("item_id <> 9"))
    assert {r["status"] for r in live.filter("item_id = ' 9'").collect()} == {"failed"}
    assert {r["term"]: r["added"] for r in U.links_by_term(U.link_updates(updates, links, items, True)).collect()} == {"a": 1, "b": 1}
    assert {r["term"]: r["added"] for r in U.links_by_term(live).collect()} == {"a": 0, "b": 0}


def test_shown_values(spark):
    schema = "v array<struct<title:string,value:string,uri:string>>"
    rows = spark.createDataFrame([([("", None, None), (None, "b", "u")],), ([("", " ", "u")],), ([],), (None,), ([(None, "", "u")],)], schema)
    assert [tuple(r) for r in rows.select(V.shown_first(F.col("v")), V.label_of_language(F.col("v"))).collect()] == [("b", "b"), (" ", None), (None, None), (None, None), ("u", None)]


def test_most_repeated_window_against_counting(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["a", "B", "é", "c2"][: rng.randrange(1, 5)]) for _ in range(rng.randrange(0, 90))) for _ in range(40)] + ["", None, "x " * 23, "x " * 24]

    def brute(text):
        w = (text or "").lower().split()
        grams = [tuple(w[i : i + 12]) for i in range(len(w) - 11)] if len(w) >= 24 else []
        best = max(grams, key=lambda g: (grams.count(g), -grams.index(g)), default=())
        return grams.count(best) if grams else 0, " ".join(best)

    out = D.most_repeated(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1))
    assert {r["doc_id"]: (r["repeats"], r["gram"]) for r in out.collect()} == {i: brute(t) for i, t in enumerate(texts)}
