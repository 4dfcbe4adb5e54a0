"""Languages, transcripts, model calls, chunks and upserts by hand."""

import pytest
from pyspark.sql import functions as F

from folioforge.functions.text import is_json
from folioforge.operators import documents as D
from folioforge.operators import language as L
from folioforge.operators import runtime as U
from folioforge.operators import transcripts as T
from folioforge.operators import upsert as P

LABELS = {"francais": "fr", "moore": "mos"}


def test_detected_languages(spark):
    good = '{"languages": [{"name_en": "English", "bcp47": "en", "share": "Secondary"}, "junk", {}, {"name_en": "French", "bcp47": "fr-FR"}, {"bcp47": "mos", "share": "odd"}]}'
    rows = spark.createDataFrame([(good,), (None,), ("{}",), ("text",), ('{"languages": 5}',), ("[1]",)], "p string")
    got = [[(x["name"], x["code"], x["share"]) for x in r["l"]] for r in rows.select(L.parse_detected(F.col("p")).alias("l")).collect()]
    assert got == [[("French", "fr-FR", "dominant"), ("mos", "mos", "dominant"), ("English", "en", "secondary")], [], [], [], [], []]
    heard = lambda *x: '{"languages": [' + ",".join(f'{{"name_en": "{n}", "bcp47": "{c}", "share": "{s}"}}' for n, c, s in x) + "]}"
    french, moore = ("French", "fr", "dominant"), ("Mooré", "mos", "dominant")
    cases = [("Français", heard(french), True), ("Français", heard(moore), False), ("Français", heard(moore, ("French", "fr", "secondary")), False), ("", heard(french), True), ("Français", None, True), ("Haoussa", heard(("Haoussa", "ha", "dominant")), True), ("Haoussa", heard(french), False), ("Français", heard(("French", "fr", "occasional")), True)]
    got = spark.createDataFrame([c[:2] for c in cases], "l string, p string").select(L.agrees(F.col("l"), L.parse_detected(F.col("p")), LABELS).alias("x")).collect()
    assert [r["x"] for r in got] == [c[2] for c in cases]


def test_linked_languages(spark):
    found = spark.createDataFrame([(1, "French", "fr-FR"), (1, "Klingon", "tlh"), (2, "Hausa", "ha")], "item_id int, name string, code string")
    out = L.linked(found, spark.createDataFrame([("fr", "Français"), ("ha", "Haoussa")], "code string, label string"), spark.createDataFrame([(7, "FRANÇAIS"), (6, "français")], "id int, title string"))
    assert sorted(((r["item_id"], r["label"], r["record_id"]) for r in out.collect()), key=str) == [(1, "Français", 6), (1, "Klingon (tlh)", None), (2, "Haoussa", None)]


def test_transcript_gate_and_joins(spark):
    loop = "la la " * 300
    rows = spark.createDataFrame([(1, {"Chunks": "1/2"}, "a"), (2, {}, " "), (3, {"Chunks": "2/2"}, loop), (4, {}, "fine"), (5, {"Chunks": "2/2"}, "ok"), (6, None, None)], "id long, header map<string,string>, body string")
    got = {r["id"]: r["status"] for r in T.upload_gate(rows).collect()}
    assert got == {1: "incomplete (1/2 windows)", 2: "empty transcript", 3: "degenerate repeating output (looping-589x)", 4: "ready", 5: "ready", 6: "empty transcript"}
    assert {r["id"]: r["status"] for r in T.upload_gate(rows, include_incomplete=True).collect()}[1] == "ready"
    chunks = spark.createDataFrame([(1, 0, "w0", None), (1, 1, "w1", " a "), (1, 2, "w2", "b")], "k int, p int, l string, t string")
    assert T.joined_chunks(chunks, "k", "p", "l", "t").first()["text"] == "a\n\n--- w2 ---\n\nb"
    names = spark.createDataFrame([("it-1-02_transcription.txt",), ("it_transcription.txt",), ("x.txt",)], "n string").select(*T.name_parts(F.col("n"))).collect()
    assert [tuple(r) for r in names] == [("it-1", 2), ("it", None), (None, None)]
    text = "[Segment 2/30 | a] TRANSCRIPTION FAILED (X)\n[Segment 20/30 | b] TRANSCRIPTION FAILED\n[Segment 20/30 | b]"
    out = spark.range(1).select(T.spliced(F.lit(text), F.lit(2), F.lit("c\\d $1")).alias("s"), *T.segment_facts(F.lit(text)), T.file_state(F.lit(text)).alias("state"), T.file_state(F.lit(" ")).alias("none")).first()
    assert out["s"].startswith("[Segment 2/30 | a]\nc\\d $1\n[Segment 20/30 | b] TRANSCRIPTION FAILED\n")
    assert (out["failed"], out["segments"], out["minutes"], out["state"], out["none"]) == ([2, 20], 2, None, "retry", "new")
    states = spark.createDataFrame([("a", [1, 9], 20), ("b", [1], 10)], "id string, failed array<int>, minutes int")
    files = spark.createDataFrame([("a", 1, "p"), ("b", 1, "q")], "id string, pos int, path string")
    assert sorted((r["id"], r["pos"], r["status"]) for r in T.retries(states, files, 20).collect()) == [("a", 1, "ready"), ("a", 9, "failed"), ("b", 1, "refused")]
    match = T.matched_items(spark.createDataFrame([("a",), ("z",)], "identifier string"), spark.createDataFrame([("a", 5), ("a", 4)], "identifier string, item_id int"))
    assert sorted((r["identifier"], r["item_id"], r["match"]) for r in match.collect()) == [("a", 4, "found"), ("z", None, "not_found")]
    assert {r["mixed"] for r in T.generators(spark.createDataFrame([("g",), ("h",)], "generator string")).collect()} == {True}


def test_retry_pace_budget():
    calls, pauses = [], []

    def fails(n, error=RuntimeError):
        def call():
            calls.append(1)
            if len(calls) <= n:
                raise error("no")
            return "ok"

        return U.retried(call, sleep=pauses.append, jitter=0)

    assert fails(2)() == "ok" and pauses == [1.0, 2.0]
    calls.clear()
    with pytest.raises(RuntimeError):
        fails(9)()
    assert len(calls) == 3
    calls.clear()
    with pytest.raises(U.Terminal):
        fails(1, U.Terminal)()
    assert len(calls) == 1
    now, slept = [0.0], []
    pace = U.Pace(60, clock=lambda: now[0], sleep=slept.append)
    pace.wait(), pace.wait()
    now[0] = 10.0
    pace.wait()
    assert slept == [1.0]
    assert U.call_budget(120, [1, 2], 3) == pytest.approx(112 / 3) and U.call_budget(1, [], 3) == 1.0


def test_mapped_calls(spark):
    def make():
        def client(row):
            if row["t"] == "stop":
                raise U.Terminal("spent")
            if row["t"] == "bad":
                raise ValueError("no")
            return row["t"].upper()

        return client

    rows = spark.createDataFrame([(1, "a"), (2, "bad")], "id int, t string")
    assert sorted(map(str, U.mapped(rows, make, ["t"]).collect())) == ["Row(id=1, t='a', result='A', error=None)", "Row(id=2, t='bad', result=None, error='no')"]
    with pytest.raises(Exception, match="spent"):
        U.mapped(spark.createDataFrame([(1, "stop")], "id int, t string"), make, ["t"]).collect()


def test_answers_and_models(spark):
    texts = ['{"a": 1} ]', '{"a": 1} }', "1, 2", ' [1] ', "```json\n{\"a\": 1}\n```", 'so {"a": {"b": 2}} it', "none", '{"a": 1}']
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in rows.select(is_json(F.col("t"))).collect()] == [False, False, False, True, False, False, False, True]
    assert [r[0] for r in rows.select(U.json_payload(F.col("t"))).collect()] == ['{"a": 1}', '{"a": 1} }', "1, 2", "[1]", '{"a": 1}', '{"a": {"b": 2}}', "none", '{"a": 1}']
    ladder = F.array(F.lit("minimal"), F.lit("high"))
    got = spark.range(1).select(U.clamped(F.lit("LOW"), ladder), U.clamped(F.lit("medium"), F.array(F.lit("low"), F.lit("high"))), U.clamped(F.lit("odd"), ladder), U.clamped(F.lit(None).cast("string"), ladder), U.clamped(F.lit("low"), F.lit(None).cast("array<string>"))).first()
    assert list(got) == ["minimal", "high", "odd", None, "low"]
    sent = spark.range(1).select(U.effort(F.lit("openrouter"), F.lit("low"), F.array(F.lit("high")), F.lit("high")), U.effort(F.lit("mistral"), F.lit("xhigh"), F.array(F.lit("x")), F.lit("x")), U.effort(F.lit("mistral"), F.lit("low"), F.array(F.lit("x")), F.lit("x"))).first()
    assert list(sent) == ["high", "high", "none"]
    keyed = U.model_key(F.col("m"), spark.createDataFrame([("GPT", "big")], "alias string, key string"), spark.createDataFrame([(" gpt ",), ("Other",)], "m string"))
    assert sorted(r["model_key"] for r in keyed.collect()) == ["big", "other"]
    one = spark.range(1).select(U.overlaid(F.struct(F.lit(1).alias("a"), F.lit(2).alias("b")), F.struct(F.lit(None).cast("int").alias("a"), F.lit(5).alias("b")), ["a", "b"]).alias("o"), U.tidy_summary(F.lit(" **a** ")).alias("s"), U.label_or_null(F.lit("ERR"), F.lit(None).cast("string"), "ERR").alias("l"), U.filled("{a}-{b}", {"a": F.lit(1), "b": F.lit(None).cast("string")}).alias("f")).first()
    assert (tuple(one["o"]), one["s"], one["l"], one["f"]) == ((1, 5), "a", None, "1-")


@pytest.mark.parametrize("text, most, want", [("aa bb\n\ncc", 5, ["aa bb", "\n\ncc"]), ("aa bb\n\ncc", 7, ["aa bb\n\n", "cc"]), ("one two  three", 8, ["one two", "three"]), ("abcdefgh", 3, ["abc", "def", "gh"]), ("a\n\nbcdef g", 4, ["a\n\n", "bcde", "f g"]), ("short", 9, ["short"]), ("", 3, [""])])
def test_cuts(text, most, want):
    assert D.cut_text(text, most) == want


def test_chunks(spark):
    import random

    rng = random.Random(4)
    for _ in range(400):
        text = "".join(rng.choice(["ab", "c ", " ", "\n", "\n\n", "long" * 3]) for _ in range(rng.randrange(60)))
        most = rng.randrange(1, 40)
        got = D.cut_text(text, most)
        assert all(len(x) <= most for x in got) and "".join(got).replace(" ", "") == text.replace(" ", "")
        if all(len(x) <= most for x in text.split("\n\n")) and "\n\n\n" not in text and most > 2:
            assert "".join(got) == text
    rows = D.chunk_text(spark.createDataFrame([(1, "aa bb\n\ncc"), (2, None)], "k int, t string"), "k", "t", 5)
    assert sorted(map(tuple, rows.collect())) == [(1, 0, "aa bb"), (1, 1, "\n\ncc"), (2, 0, "")]
    assert {r["k"]: r["text"] for r in D.rejoined(rows, "k").collect()} == {1: "aa bb\n\ncc", 2: ""}


def test_annotated_upserts(spark):
    lit = lambda v, lang=None, p=1, note=None, kind="literal": (p, kind, v, lang, note)
    note, server = {"t": [{"id": "5"}]}, {"t": [{"id": "5", "url": None}], "more": []}
    cases = [([lit("a", "fr", note=server)], "a", True), ([lit("a", "fr", note={"t": []})], "a", False), ([lit("a", "fr", 2), lit("x", None), lit("y", "en")], "new", False), ([lit("z", "fr", kind="uri")], "new", False), ([lit("a", "fr")], " ", True)]
    rows = spark.createDataFrame([(v, t) for v, t, _ in cases], f"v {P.LITERAL}, t string")
    wanted = F.from_json(F.lit('{"t": [{"id": "5"}]}'), P.ANNOTATION)
    out = rows.select("v", P.write_literal(F.col("v"), F.lit(1), F.col("t"), F.lit("fr"), adopt_untagged=True, annotation=wanted).alias("w")).collect()
    assert [r["v"] == r["w"] for r in out] == [c[2] for c in cases]
    assert out[1]["w"][0]["annotation"] == note and [x["value"] for x in out[2]["w"]] == ["a", "new", "y"] and out[2]["w"][1]["lang"] == "fr"
    assert [x["value"] for x in out[3]["w"]] == ["z", "new"]
    blind = rows.select(P.write_literal(F.col("v"), F.lit(1), F.lit("n")).alias("w")).collect()
    assert [[x["value"] for x in r["w"]] for r in blind] == [["n"], ["n"], ["a", "n", "y"], ["z", "n"], ["n"]] and blind[2]["w"][1]["lang"] is None
    swapped = rows.limit(1).select(P.replace_property(F.col("v"), F.lit(1), F.col("v")).alias("same"), F.size(P.replace_property(F.col("v"), F.lit(1), F.array().cast(P.LITERAL))).alias("n"), P.already_written(F.col("v"), 1).alias("has"), F.col("v")).first()
    assert swapped["same"] == swapped["v"] and swapped["n"] == 0 and swapped["has"]
    terms = spark.createDataFrame([("New", 5, 1), (" new ", 6, 2)], "label string, id long, seq int")
    merged = P.with_new_terms(F.col("ids"), spark.createDataFrame([(1, 0, "NEW "), (1, 1, "none")], "row_id int, pos int, label string"), spark.createDataFrame([(1, [4]), (2, [6])], "row_id int, ids array<long>"), terms)
    assert sorted((r["row_id"], r["ids"]) for r in merged.collect()) == [(1, [4, 6]), (2, [6])]
