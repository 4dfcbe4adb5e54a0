"""Article blocks, links, media names, vocabularies, batch reports: hand values and odd rows."""

import pytest
from pyspark.sql import functions as F

from folioforge.operators import batches as B
from folioforge.operators import exports as E
from folioforge.operators import ontology as O


def test_article_block(spark):
    schema = "title string, date string, pub array<string>, country string, id long, text string, summary string"
    rows = [
        ("T", "1998-02-16", ["A", "B"], "Togo", 7, " x  \n\n\n\ny ", "s"),
        (None, None, None, None, None, None, None),
        ("", "", [], "", 0, "  \n ", ""),
    ]
    df = spark.createDataFrame(rows, schema)
    url = E.page_url(F.lit("http://h/api/"), F.col("id"), "fr")
    got = [r[0] for r in df.select(E.article_block(*map(F.col, ("title", "date", "pub", "country", "id", "text", "summary")), url)).collect()]
    assert got[0] == "## T\n**Journal :** A; B | **Date :** 1998-02-16 | **Pays :** Togo | **Item :** [7](http://h/s/fr/item/7)\n\n**Résumé (IA) :** s\n\nx\n\ny\n\n---\n"
    assert got[1] == got[2] == "## No title\n**Journal :** Inconnu | **Date :** Inconnu\n\n---\n"
    bare = df.select(E.article_block(*map(F.col, ("title", "date", "pub", "country", "id", "text")))).first()[0]
    assert "**Item :** 7\n" in bare and "Résumé" not in bare


def test_urls_and_media_names(spark):
    rows = [("http://h/api//", "a/b?.mp3"), ("http://h", None), ("http://api/x/", "")]
    df = spark.createDataFrame(rows, "base string, source string")
    got = df.select(E.api_url(F.col("base"), F.lit(1)), E.page_url(F.col("base"), F.lit(1), "s")).collect()
    assert [tuple(r) for r in got] == [("http://h/api/items/1", "http://h/s/s/item/1"), ("http://h/items/1", "http://h/s/s/item/1"), ("http://api/x/items/1", "http://api/x/s/s/item/1")]
    cases = [("x:y.mp3", "u/z.wav", None, "x_y.mp3"), (None, "u/z.WAV", None, "1-2.wav"), ("", "u/.wav", "video/x", "1-2.mp4"), (None, None, "audio/x", "1-2.mp3"), (None, None, None, "1-2"), (None, "u.v/z", "image/x", "1-2")]
    df = spark.createDataFrame(cases, "source string, url string, type string, want string")
    for r in df.select(E.media_file_name(F.col("source"), F.lit(1), F.lit(2), F.col("url"), F.col("type")).alias("got"), "want").collect():
        assert r["got"] == r["want"]


def test_definitions_and_replacement(spark):
    members = spark.createDataFrame([("p", "M", "id"), ("q", None, None)], "prefix string, label string, model_id string")
    fields = [O.FieldTemplate("A", {"en": "{label}: {x}"}, {"en": "{model_id}"}), O.FieldTemplate("B", {"en": "b", "fr": "c"}, {"en": "", "fr": ""}, "k", "v")]
    got = [tuple(r) for r in O.definitions(members, fields).orderBy("term", "lang").collect()]
    assert got == [
        ("pA", 0, "en", "M: {x}", "id", "owl:ObjectProperty", None),
        ("pB", 1, "en", "b", "", "k", "v"),
        ("pB", 1, "fr", "c", "", "k", "v"),
        ("qA", 0, "en", ": {x}", "", "owl:ObjectProperty", None),
        ("qB", 1, "en", "b", "", "k", "v"),
        ("qB", 1, "fr", "c", "", "k", "v"),
    ]
    have = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("c", 3), (None, 4)], "name string, property_id int")
    want = spark.createDataFrame([("a",), ("n",), ("n",), (None,)], "name string")
    values = spark.createDataFrame([(3, 10), (3, 10), (3, 11), (1, 12), (4, 13)], "property_id int, item_id int")
    changes = O.replacement(have, want, values)
    assert sorted(map(tuple, changes.collect())) == [("b", "would_delete", 0), ("c", "would_delete", 2), ("n", "would_add", 0)]
    with pytest.raises(O.PopulatedTerms, match=r"1 terms .* c \(2 items\)"):
        O.refuse_populated(changes)
    O.refuse_populated(O.replacement(have, want, values.limit(0)))
    assert O.replacement(have.limit(0), want.limit(0), values).count() == 0


def test_batch_reports(spark):
    rows = [(1, "f", 1, True, 1048576, True), (1, "f", 3, None, 1048576, True), (1, "f", 2, False, 1048576, True), (1, "g", 1, True, 5, None), (2, "h", 1, False, 5, True)]
    files = B.file_results(spark.createDataFrame(rows, "batch int, file string, page int, ok boolean, bytes long, written boolean"))
    got = {r["file"]: (r["pages"], r["successful"], r["failed"], round(r["success"], 3), r["ok"]) for r in files.collect()}
    assert got == {"f": (3, 1, [2, 3], 33.333, True), "g": (1, 1, [], 100.0, False), "h": (1, 0, [1], 0.0, False)}
    report = {r["batch"]: (r["files"], r["processed"], r["failed"], r["success"], r["mb"]) for r in B.batch_report(files).collect()}
    assert report == {1: (2, 1, 1, 50.0, 1.0), 2: (1, 0, 1, 0.0, 0.0)}
    assert B.batch_report(files.limit(0)).count() == 0


def test_plans_durations_and_notes(spark):
    df = spark.createDataFrame([(0,), (600,), (601,), (None,)], "n long")
    got = [r[0] for r in df.select(B.segment_plan(F.col("n"), F.lit(600))).collect()]
    assert [[tuple(x) for x in g] if g is not None else None for g in got] == [[(1, 0, 0)], [(1, 0, 600)], [(1, 0, 600), (2, 600, 601)], None]
    df = spark.createDataFrame([(59,), (3600,), (86399,), (90000,), (None,)], "s long")
    assert [r[0] for r in df.select(B.rough_duration(F.col("s"))).collect()][:4] == ["~0m", "~1h 0m", "~23h 59m", "~1d 1h"]
    assert df.limit(1).select(B.window_note(F.lit(1), F.lit(1), F.lit(0), F.lit(9), F.lit(0))).first()[0] == ""
    assert B.instructions("Do it.\n\n---\n\n**Texte:**\n{text}\nmore") == "Do it."
    assert B.instructions("Do it.") == "Do it."
