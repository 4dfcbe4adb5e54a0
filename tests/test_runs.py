"""Runs that stop and go on: versions, listings, model fan-out, document indexes, streams, limits and samples."""

import json
import random
import threading
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from folioforge.operators import fanout as O
from folioforge.operators import indexing as I
from folioforge.operators import sampling as S
from folioforge.operators.runtime import Terminal
from folioforge.sinks import commit as C
from folioforge.sources import listing as L
from folioforge.streaming import log_stream, upsert_batches
from folioforge.streaming import state as Z


def test_readers_never_miss_a_version(spark, tmp_path):
    path, seen, errors, stop = f"{tmp_path}/t", [], [], threading.Event()
    C.commit(spark.range(5), path)
    with pytest.raises(FileNotFoundError):
        C.current(spark, f"{tmp_path}/none")

    def look():
        while not stop.is_set():
            try:
                seen.append(C.current(spark, path).count())
            except Exception as e:  # noqa: BLE001
                errors.append(e)

    reader = threading.Thread(target=look)
    reader.start()
    for i in range(6):
        C.commit(C.current(spark, path).union(spark.range(5)), path)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        C.commit(spark.range(3).select(F.expr("1 / (id - 1)")), path)
    stop.set()
    reader.join()
    assert not errors
    assert C.current(spark, path).count() == 35 and set(seen) <= set(range(5, 36, 5)) and len(set(seen)) > 1
    assert seen == sorted(seen)


def test_listing_opens_only_wanted_pages(spark, tmp_path, monkeypatch):
    items = spark.range(230).select((F.col("id") % 2).alias("set_id"), F.col("id").alias("item_id"), F.format_string('{"o:id": %d, "t": "é\\n"}', "id").alias("raw"))
    path = f"{tmp_path}/r"
    L.record_pages(items.filter("item_id < 200 or set_id = 1"), path, 20)
    df = L.read_listing(spark, path, 20)
    rows = df.collect()
    assert sorted(r["item_id"] for r in rows) == sorted(i for i in range(230) if i < 200 or i % 2)
    assert {(r["set_id"], r["page"], r["pos"]) for r in rows} == {(i % 2, i // 2 // 20 + 1, i // 2 % 20) for i in range(230) if i < 200 or i % 2}
    assert json.loads(rows[0]["raw"])["t"] == "é\n"
    assert df.filter("set_id = 1 and page in (2, 5, 99) and pos < 3").count() == 6
    assert df.filter("set_id = 7").count() == 0

    def opened(*filters):
        reader, names = L._Reader(path, 20), []
        list(reader.pushFilters(list(filters)))
        real = L._records
        monkeypatch.setattr(L, "_records", lambda store, files: names.append(files) or real(store, files))
        parts = reader.partitions()
        monkeypatch.setattr(L, "_records", real)
        return [(p.set_id, p.page) for p in parts], len(names)

    assert opened(L.EqualTo(("set_id",), 1), L.In(("page",), (2, 5))) == ([(1, 2), (1, 5)], 5)
    assert list(L._Reader(path, 20).pushFilters([f := L.EqualTo(("pos",), 1)])) == [f]
    # a page that is not full ends the listing, whatever lies behind it
    (tmp_path / "r" / "set=1" / "page=9").mkdir()
    (tmp_path / "r" / "set=1" / "page=9" / "part-x.txt").write_text('[{"o:id": 999}]')
    assert df.filter("item_id = 999").count() == 0


def test_fan_out_keeps_order_and_gives_up_on_hanging_calls(spark):
    rows = spark.range(30).select("id", F.concat(F.lit("t"), F.col("id").cast("string")).alias("text")).coalesce(2)
    models = {
        "quick": lambda: lambda row: row["text"].upper(),
        "hangs": lambda: lambda row: time.sleep(60 if row["id"] % 10 == 3 else 0) or '{"a": 1, "b": "x"}',
        "broken": lambda: lambda row: (_ for _ in ()).throw(ValueError("no")),
    }
    start = time.time()
    out = O.fan_out(rows, models, ["id", "text"], timeout=1.0, width=4).collect()
    assert time.time() - start < 40
    assert [r["id"] for r in out] == list(range(30))
    for r in out:
        assert list(r["results"]) == ["quick", "hangs", "broken"] or set(r["results"]) == {"quick", "hangs", "broken"}
        assert tuple(r["results"]["quick"]) == (f"T{r['id']}", None) and tuple(r["results"]["broken"]) == (None, "ValueError: no")
        assert r["results"]["hangs"]["error"] == ("Timeout" if r["id"] % 10 == 3 else None)


def test_answers_as_structs(spark):
    rows = spark.createDataFrame([("m", '```json\n{"a": 1, "b": "x"}\n```', None), ("m", '{"b": "x"}', None), ("m", "no", None), ("m", None, "Timeout"), ("m", '{"a": "one"}', None)], "model string, result string, error string")
    got = [(r["answer"] and tuple(r["answer"]), r["error"]) for r in O.structured(rows, "a int, b string", ["a"]).collect()]
    assert got == [((1, "x"), None), (None, "invalid answer: a"), (None, "invalid answer: a"), (None, "Timeout"), (None, "invalid answer: a")]


def test_terminal_errors_drop_what_waits():
    calls, started = O.Calls(2, 5.0), []

    def call(i):
        started.append(i)
        if i == 1:
            raise Terminal("spent")
        time.sleep(0.2)

    for i in range(20):
        calls.submit(i, lambda i=i: call(i))
    with pytest.raises(Terminal):
        for i in range(20):
            calls.result(i)
    time.sleep(0.5)
    assert len(started) < 6 and not calls.waiting


PAGES = "doc_id long, page int, text string"


def extractor(log, bad=(), ends=()):
    def make():
        def client(row):
            with open(f"{log}/{row['doc_id']}-{row['page']}-{time.time_ns()}", "w"):
                pass
            if (row["doc_id"], row["page"]) in ends:
                raise Terminal("quota")
            if (row["doc_id"], row["page"]) in bad:
                raise ValueError("unreadable")
            return json.dumps({"page_number": row["page"], "text": row["text"]})

        return client

    return make


def joiner(broken=()):
    def make():
        def client(row):
            if row["doc_id"] in broken:
                return None
            return "|".join(str(p.get("text") or p["other_content"]) for p in json.loads(row["contents"]))

        return client

    return make


def test_index_run_resumes(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    path = f"{tmp_path}/run"
    rows = [(d, p, f"d{d}p{p}") for d in range(1, 6) for p in range(1, 6)]
    random.Random(1).shuffle(rows)
    pages = spark.createDataFrame(rows, PAGES)
    bad = {(1, 2), (2, 1), (2, 3)}  # one of five pages is not more than a fifth, two are
    report = {r["doc_id"]: tuple(r)[1:] for r in I.run_index(pages, extractor(log, bad), joiner({3}), path, rounds=2).collect()}
    assert report == {1: (5, 1, "indexed"), 2: (5, 2, "too_many_errors"), 3: (5, 0, "failed"), 4: (5, 0, "indexed"), 5: (5, 0, "indexed")}
    assert len(list(log.iterdir())) == 25
    done = {r["doc_id"]: (r["index"], r["extraction_errors"]) for r in I.indexes(spark, path).collect()}
    assert done[4] == ("|".join(f"d4p{p}" for p in range(1, 6)), 0) and done[1] == ("d1p1|Error: unreadable|d1p3|d1p4|d1p5", 1)
    assert {r["doc_id"] for r in I.kept_pages(spark, path).select("doc_id").collect()} == {2, 3}
    again = {r["doc_id"]: r["status"] for r in I.run_index(pages, extractor(log), joiner(), path).collect()}
    assert set(again.values()) == {"indexed"} and len(list(log.iterdir())) == 27  # only the two failed pages were read again
    assert I.kept_pages(spark, path).count() == 0


@pytest.mark.parametrize("stage", ["consolidate", "drop_indexed"])
def test_index_run_killed_between_stages(spark, tmp_path, monkeypatch, stage):
    log = tmp_path / "log"
    log.mkdir()
    path = f"{tmp_path}/run"
    pages = spark.createDataFrame([(d, p, "x") for d in (1, 2) for p in (1, 2)], PAGES)
    with monkeypatch.context() as m:
        m.setattr(I, stage, lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            I.run_index(pages, extractor(log), joiner(), path)
    assert I.kept_pages(spark, path).count() == 4
    assert {r["status"] for r in I.run_index(pages, extractor(log), joiner(), path).collect()} == {"indexed"}
    assert len(list(log.iterdir())) == 4 and I.indexes(spark, path).count() == 2 and I.kept_pages(spark, path).count() == 0


def test_index_run_keeps_pages_before_a_spent_quota(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    path = f"{tmp_path}/run"
    pages = spark.createDataFrame([(1, p, None) for p in range(1, 9)], PAGES).coalesce(1)
    with pytest.raises(Terminal, match="quota"):
        I.run_index(pages, extractor(log, ends={(1, 4)}), joiner(), path)
    kept = I.kept_pages(spark, path).count()
    assert 0 < kept < 8 and len(list(log.iterdir())) == kept + 1


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def test_keyed_state_resumes_and_refuses(spark, tmp_path):
    source, path, checkpoint = tmp_path / "in", f"{tmp_path}/out", f"{tmp_path}/cp"
    put(source, "a.json", [{"k": "x", "seq": 5, "v": "new"}, {"k": "y", "seq": 1, "v": "one"}, {"k": "x", "seq": 2, "v": "old"}])

    def run(context):
        Z.bind_context(spark, checkpoint, context)
        log = log_stream(spark, str(source), "k string, seq long, v string", 1)
        query = upsert_batches(Z.folded_state(log, ["k"], "seq"), path, checkpoint)
        query.awaitTermination()

    run({"model": "m", "prompt": [1, 2]})
    report = lambda: {r["k"]: (r["seq"], r["v"]) for r in Z.compacted(spark, path, ["k"]).collect()}
    assert report() == {"x": (5, "new"), "y": (1, "one")}
    put(source, "b.json", [{"k": "x", "seq": 3, "v": "late"}, {"k": "y", "seq": 2, "v": None}, {"k": None, "seq": 1, "v": "null"}, {"k": "z", "seq": None, "v": "none"}])
    run({"prompt": [1, 2], "model": "m"})
    want = {"x": (5, "new"), "y": (2, None), None: (1, "null")}
    assert report() == want
    with pytest.raises(Z.CheckpointMismatch):
        run({"model": "other", "prompt": [1, 2]})
    assert report() == want


def test_contexts(spark, tmp_path):
    path = f"{tmp_path}/c"
    Z.bind_context(spark, path, {"a": 1})
    Z.bind_context(spark, path, {"a": 1})
    Z.bind_context(spark, path, {"a": 2}, reset=True)
    with pytest.raises(Z.CheckpointMismatch):
        Z.bind_context(spark, path, {"a": 1})
    for broken in ("{", "[]", '{"version": 0, "context": {"a": 2}}'):
        C._Folder(spark, f"{path}.context").replace("context.json", broken)
        with pytest.raises(Z.CheckpointMismatch):
            Z.bind_context(spark, path, {"a": 2})


def test_batches_stay_bounded(spark, tmp_path):
    path = f"{tmp_path}/b"
    report = lambda: sorted((r["k"], r["v"], r["batch"]) for r in Z.compacted(spark, path, ["k"]).collect())
    with pytest.raises(FileNotFoundError):
        report()
    for n in range(9):
        spark.createDataFrame([(n % 4, n), (9, n)], "k int, v int").coalesce(1).write.parquet(f"{path}/batch={n}")
        before = report()
        if n % 3 == 2:
            assert Z.compact(spark, path, ["k"]) == 2
            assert report() == before
    assert report() == [(0, 8, 8), (1, 5, 5), (2, 6, 6), (3, 7, 7), (9, 8, 8)]
    assert len(Z._batches(spark, path)) == 2
    # a batch that had been merged, but not yet deleted, is not read again
    spark.createDataFrame([(0, -1)], "k int, v int").write.parquet(f"{path}/batch=1")
    assert (0, 8, 8) in report()


def test_limits_and_samples(spark):
    rng = random.Random(3)
    data = [(i * 3, rng.random() < 0.3 if rng.random() < 0.9 else None) for i in range(200)]
    rows = spark.createDataFrame(random.Random(4).sample(data, 200), "o long, ok boolean").repartition(7)
    good = [o for o, ok in data if ok]
    for n in (0, 1, 2, len(good) - 1, len(good), 500):
        got = sorted(r["o"] for r in S.first_produced(rows, "o", F.col("ok"), n).collect())
        seen = sorted(r["o"] for r in S.until_produced(rows, "o", F.col("ok"), n).collect())
        assert got == good[:n]
        assert seen == [o for o, _ in data if n and (n > len(good) or o <= good[n - 1])]
    assert S.first_produced(rows.limit(0), "o", F.col("ok"), 3).count() == 0
    with pytest.raises(ValueError):
        S.first_produced(rows, "o", F.col("ok"), -1)
    pages = rows.select("o", F.floor(F.col("o") / 60).cast("long").alias("page"), F.lit(1).alias("_p"))
    draw = lambda df: sorted((r["page"], r["o"]) for r in S.page_sample(df, "page", "o", 4, 3, 10, 7).collect())
    first = draw(pages)
    assert first == draw(pages.coalesce(1)) and len(first) == 10 and len({p for p, _ in first}) == 4
    assert draw(pages.filter("page < 2")) == draw(pages.filter("page < 2").repartition(3)) and len(draw(pages.limit(0))) == 0


def test_page_sample_sees_every_page(spark):
    rows = spark.range(2000).select("id", (F.col("id") % 20).alias("page"))
    hit = pd.Series([r["page"] for seed in range(12) for r in S.page_sample(rows, "page", "id", 5, 2, 10, seed).collect()])
    assert hit.nunique() > 15
