"""File sources, sinks and streams: written, read back, compared by hand."""

import json

import pytest
from pyspark.sql import functions as F

from folioforge import sinks as K
from folioforge import streaming as S
from folioforge.sinks.commit import commit, current
from folioforge.sources import catalogue as C
from folioforge.sources import files as S_
from folioforge.operators import annotate as N


def put(folder, **texts):
    for name, text in texts.items():
        p = folder / name.replace("__", "/").replace("_dot_", ".")
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text, encoding="utf-8")


def test_texts_csv_ids(spark, tmp_path):
    put(tmp_path / "t", **{"12_dot_txt": "twelve\nlines", "x_dot_txt": "no", "7_dot_md": "no"})
    assert [(r["id"], r["text"]) for r in S_.numbered_texts(spark, str(tmp_path / "t")).collect()] == [(12, "twelve\nlines")]
    put(tmp_path, **{"a_dot_csv": 'o:id,Title\n1,"two\nlines ""x"""\n ,b\n1,c\n'})
    rows = S_.checked_csv(spark, str(tmp_path / "a.csv"), ["o:id"], ["Extra"])
    assert rows.columns == ["o:id", "Title", "Extra"] and rows.first()["Title"] == 'two\nlines "x"'
    assert [r[0] for r in S_.completed_ids(rows, "o:id").collect()] == ["1"]
    with pytest.raises(ValueError, match="lacks"):
        S_.checked_csv(spark, str(tmp_path / "a.csv"), ["Nope"])


def test_logs_and_work_lists(spark, tmp_path):
    lines = [{"v": "3", "item": "a", "x": 1}, {"v": "2", "item": "a", "x": 2}, {"v": "3", "item": "a", "x": 3}]
    put(tmp_path / "log", **{"l_dot_jsonl": "\n".join(map(json.dumps, lines)) + '\n\n{"v": "3", "item'})
    got = S_.log_records(S_.log_lines(spark, str(tmp_path / "log")), "v string, item string, x int", "3")
    assert [r["x"] for r in N.latest(got, ["item"], "seq").collect()] == [3] and got.count() == 2
    put(tmp_path, **{"w_dot_json": json.dumps({"version": 1, "items": [{"id": 1, "u": "a"}]}), "o_dot_json": json.dumps({"version": 2, "items": []})})
    assert [tuple(r) for r in S_.work_list(spark, str(tmp_path / "w.json"), "struct<id:int,u:string>").collect()] == [(1, "a")]
    with pytest.raises(ValueError, match="version"):
        S_.work_list(spark, str(tmp_path / "o.json"), "struct<id:int>")
    report = spark.createDataFrame([(1, [("fr", "dominant"), ("en", "occasional")]), (2, [("en", "occasional")])], "id int, l array<struct<code:string,share:string>>")
    assert [(r["id"], len(r["l"])) for r in S_.kept_shares(report, "l", ["dominant"]).collect()] == [(1, 1)]


def test_pages_written_back(spark, tmp_path):
    xml = '<alto xmlns="http://x/y"><TextBlock ID="b"><TextLine><String CONTENT="one" HPOS="1.5"/><String CONTENT="tvo" HPOS="x"/></TextLine></TextBlock><TextBlock ID="b"><TextLine><String CONTENT="three"/></TextLine></TextBlock></alto>'
    put(tmp_path / "p", **{"a_dot_xml": xml})
    got = sorted((r["block"], r["line"], r["tok"], r["content"], r["hpos"]) for r in S_.page_tokens(spark, str(tmp_path / "p")).collect())
    assert got == [(0, 0, 0, "one", 1.5), (0, 0, 1, "tvo", None), (1, 0, 0, "three", None)]
    fixes = spark.createDataFrame([("a.xml", 0, 0, ["one", "two"]), ("a.xml", 1, 0, ["too", "many"])], "file string, block int, line int, tokens array<string>")
    out = K.corrected_pages(spark.createDataFrame([("a.xml", xml), ("b.xml", xml)], "file string, text string"), fixes)
    texts = {r["file"]: r["text"] for r in out.collect()}
    assert 'CONTENT="two"' in texts["a.xml"] and "many" not in texts["a.xml"] and 'CONTENT="tvo"' in texts["b.xml"] and "ns0" not in texts["a.xml"]


def test_transcripts_prompts_terms_media(spark, tmp_path):
    row = spark.range(1).select(K.with_header({"Title": F.lit("a: b"), "None": F.lit(None).cast("string"), "Chunks": F.lit("1/2")}, F.lit("body\n\ntext")).alias("t")).first()["t"]
    put(tmp_path / "t", **{"5_dot_txt": row, "6_dot_txt": "only body", "report_dot_txt": "x"})
    got = {r["id"]: (r["header"], r["body"]) for r in S_.transcripts(spark, str(tmp_path / "t")).collect()}
    assert got == {5: ({"Title": "a: b", "Chunks": "1/2"}, "body\n\ntext"), 6: ({}, "only body")}
    put(tmp_path / "m", **{"01_short_name_dot_md": "note\n# Head\nDo this.\n", "02_x_dot_md": "Plain.", "readme_dot_md": "no"})
    assert sorted(tuple(r) for r in S_.prompts(spark, str(tmp_path / "m")).collect()) == [(1, "Short Name", "Do this."), (2, "X", "Plain.")]
    put(tmp_path / "v", **{"v_dot_ttl": "ex:one a rdf:Property ;\n  rdfs:label ex:no .\nex:two  a owl:Class .\n"})
    assert sorted(r[0] for r in S_.vocabulary_terms(spark, str(tmp_path / "v"), "ex").collect()) == ["one", "two"]
    put(tmp_path / "a", **{"x_dot_MP3": "1", "y_dot_mp4": "22", "it's_dot_mp3": "3", "z_dot_txt": "4"})
    media = S_.media_files(spark, str(tmp_path / "a"))
    assert sorted((r["name"], r["kind"], r["bytes"]) for r in media.collect()) == [("x.MP3", "audio", 1), ("y.mp4", "video", 2)]
    files = spark.createDataFrame([("a", 1), ("c", 2), ("b", 2)], "path string, modified int")
    assert S_.newest(files).first()[0] == "c"
    put(tmp_path / "i", **{"12__a_index_dot_json": "{}", "12__b_index_dot_json": "{1}", "x__index_dot_json": "{}", "13__index_dot_json": " "})
    assert [(r["id"], r["file"], r["text"]) for r in S_.index_files(spark, str(tmp_path / "i"), "index").collect()] == [(12, "a_index.json", "{}")]


ITEM = {"o:id": 1, "@type": ["o:Item", "bibo:Article"], "o:item_set": [{"o:id": 5}, {"@id": "http://h/api/items/6"}], "o:media": [{"o:id": 9}], "o:resource_template": {"o:id": 3}, "dcterms:title": [{"type": "literal", "property_id": 1, "@value": "T", "@language": "fr"}, "junk", {"type": "resource:item", "property_id": 1, "value_resource_id": 8, "display_title": "D"}], "@reverse": {"dcterms:subject": [{"@id": "http://h/api/resources/77"}, 5, "12", {"x": 1}]}}


def test_catalogue(spark):
    items = C.with_facets(spark.createDataFrame([(1, json.dumps(ITEM)), (2, json.dumps({"o:id": 2, "@type": "bibo:Article"}))], "item_id long, raw string"))
    values = C.long_values(items)
    got = [(r["term"], r["pos"], r["value"], r["lang"], r["link_id"]) for r in values.filter("term = 'dcterms:title'").orderBy("pos").collect()]
    assert got == [("dcterms:title", 0, "T", "fr", None), ("dcterms:title", 2, None, None, 8)]
    assert [(r["item_id"], r["set_id"]) for r in C.of_sets(items, [5, 6]).orderBy("set_id").collect()] == [(1, 5), (1, 6)]
    assert [r["item_id"] for r in C.of_class(items, "bibo:Article").collect()] == [1] and C.of_template(items, 3).count() == 1
    assert C.parse_ids("3, 1 3,2") == [3, 1, 2] and C.parse_ids("@f", ["4", "5,4"]) == [4, 5]
    for bad in ("", "1 x"):
        with pytest.raises(ValueError):
            C.parse_ids(bad)
    found, lacking = C.by_ids(items, spark.createDataFrame([(1,), (1,), (9,)], "item_id long"))
    assert found.count() == 1 and [r[0] for r in lacking.collect()] == [9]
    assert C.having(items, values, 1).count() == 1 and C.having(items, values, 1, "T").count() == 1 and C.having(items, values, 1, "U").count() == 0
    assert {r["term"]: (r["items"], r["values"]) for r in C.property_counts(values).collect()}["dcterms:title"] == (1, 2)
    vocabulary = spark.createDataFrame([("a", 1), ("b", 2)], "term string, id int")
    assert C.resolve_terms(vocabulary, ["b"]) == {"b": 2}
    with pytest.raises(ValueError, match="c"):
        C.resolve_terms(vocabulary, ["a", "c"])
    assert [r["ref_id"] for r in C.back_links(items, "dcterms:subject").orderBy("pos").collect()] == [77, 5, 12, None]
    places = items.withColumn("country", F.when(F.col("item_id") == 2, "own"))
    assert {r["item_id"]: r["country"] for r in C.set_country(places, spark.createDataFrame([(5, "five")], "set_id long, country string")).collect()} == {1: "five", 2: "own"}
    refs = spark.createDataFrame([(1,), (2,), (3,)], "item_id long")
    named = C.with_resource(refs, spark.createDataFrame([(1, None)], "item_id long, t string"), spark.createDataFrame([(1, "i"), (2, "i2")], "item_id long, t string"), ["t"])
    assert sorted(tuple(r) for r in named.collect()) == [(1, None), (2, "i2"), (3, None)]
    assert [(r["item_id"], r["url"]) for r in S_.attached_media(items, spark.createDataFrame([(9, "http://h/a.PDF?x=1")], "media_id long, url string"), ("pdf",)).collect()] == [(1, "http://h/a.PDF?x=1")]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id int, x string")
    assert [r["id"] for r in K.append_valid(rows, f"{tmp_path}/j", F.col("x") != "").collect()] == [2]
    assert spark.read.json(f"{tmp_path}/j").count() == 1
    commit(rows, f"{tmp_path}/w")
    commit(current(spark, f"{tmp_path}/w").filter("id = 2"), f"{tmp_path}/w")
    assert [r["id"] for r in current(spark, f"{tmp_path}/w").collect()] == [2]
    merged = K.merge_keyed(rows, spark.createDataFrame([(2, "new"), (3, "c")], "id int, x string"), ["id"])
    assert sorted(map(tuple, merged.collect())) == [(1, "a"), (2, "new"), (3, "c")]
    updates = spark.createDataFrame([(1, ["a"], ["b"], "updated"), (2, ["a"], ["a"], "unchanged")], "item_id int, before array<string>, after array<string>, status string")
    assert [r["item_id"] for r in K.change_set(updates).collect()] == [1]
    K.pre_image(updates, f"{tmp_path}/dry", True)
    K.pre_image(updates, f"{tmp_path}/pre", False)
    assert not (tmp_path / "dry").exists() and spark.read.json(f"{tmp_path}/pre").first()["before"] == '["a"]'
    names = spark.createDataFrame([(' a/b:  "c" ', " .x" + "y" * 300 + ".mp3. ", "it's <a>"), ("  ", "a?b.mp3", "b")], "a string, b string, c string")
    got = names.select(K.file_stub(F.col("a")), K.media_name(F.col("b")), K.plain_stem(F.col("c"))).collect()
    assert [tuple(r) for r in got] == [("a_b_ _c_", "x" + "y" * 195 + ".mp3", "its a"), ("untitled", "a_b.mp3", "b")]
    K.write_parts(spark.createDataFrame([("ci", 1, "one\n"), ("ci", 2, "two")], "c string, part int, text string"), f"{tmp_path}/parts", ["c", "part"])
    assert sorted(p.parent.name for p in tmp_path.glob("parts/c=ci/part=*/*.txt")) == ["part=1", "part=2"]
    ttl = K.turtle(spark.createDataFrame([("t", 'a "b"', "fr", "c\\d")], "term string, label string, lang string, comment string"), "ex").first()["text"]
    assert ttl == 'ex:t a rdf:Property ;\n  rdfs:label "a \\"b\\""@fr ;\n  rdfs:comment "c\\\\d"@fr .'
    K.write_report(spark, rows, f"{tmp_path}/r")
    assert S_.work_list(spark, f"{tmp_path}/r", "struct<id:int,x:string>").count() == 2


def test_streams_equal_batches(spark, tmp_path):
    schema = "item string, model string, seq long, kind string"
    batches = [[("a", "m", 1, "ok"), ("b", "m", 2, "ok")], [("a", "m", 3, "ok"), ("a", "n", 4, "ok")], [("a", "m", 0, "old")]]
    log, out = tmp_path / "log", str(tmp_path / "out")

    def run(guard=None):
        stream = S.folded(S.log_stream(spark, str(log), schema, files_a_batch=1), ["item", "model"], "seq")
        S.upsert_batches(stream, out, str(tmp_path / "cp"), guard).awaitTermination(120)

    every = []
    for i, rows in enumerate(batches):
        every += rows
        put(log, **{f"{i}_dot_jsonl": "\n".join(json.dumps(dict(zip(("item", "model", "seq", "kind"), r, strict=True))) for r in rows) + '\n{"item": "torn'})
        run()
    want = N.latest(spark.createDataFrame(every, schema), ["item", "model"], "seq")
    assert sorted(map(tuple, S.upserted(spark, out, ["item", "model"]).collect())) == sorted(map(tuple, want.select("item", "model", "seq", "kind").collect()))
    put(log, **{"9_dot_jsonl": json.dumps({"item": "c", "model": "m", "seq": 9, "kind": "terminal"})})
    with pytest.raises(Exception, match="terminal"):
        run(S.stop_on("kind"))
    assert "c" in {r["item"] for r in S.upserted(spark, out, ["item", "model"]).collect()}
