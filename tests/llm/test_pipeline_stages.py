"""Stages of the pipeline on odd rows, and decontamination by several blocks."""

import pytest

pytest.importorskip("folioforge.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")
from folioforge.llm import decontaminate  # noqa: E402


@pytest.fixture
def folder(spark, tmp_path):
    rows = [(i, f"question {i} " + " ".join(f"b{i}x{j}" for j in range(14))) for i in range(4)]
    spark.createDataFrame([*rows, (9, None), (None, "x")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, i % 4 > 0, 0) for i in range(40)], "doc_id long, quality boolean, toxic int").selectExpr("doc_id", "cast(quality as int) as quality", "toxic").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


ODD = [(None, None, 1, "k"), (1, "", 2, "k"), (1, "A�  b\n", 3, "k"), (2, "word " * 20_000, 4, None), (2, "word " * 20_000, 4, None), (3, "plain text of a few words", 5, "q")]
SCHEMA = "doc_id long, text string, items int, score string"


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_odd_rows_and_empty_tables(spark, folder, stage):
    docs = spark.createDataFrame(ODD, SCHEMA)
    out = stage(spark, docs, folder)
    if stage is not corpus_pipeline.STAGES[-1][1]:
        assert out.columns == docs.columns
        assert set(map(tuple, out.collect())) <= set(ODD)
    else:
        assert out.count() == len(ODD)
    assert stage(spark, docs.limit(0), folder).count() == 0


@pytest.mark.parametrize("limit", [2, 1_000])
def test_decontamination_block_by_block(spark, folder, monkeypatch, limit):
    real = decontaminate.item_blocks
    seen = []
    monkeypatch.setattr(decontaminate, "item_blocks", lambda b: (seen.append(1) or x for x in real(b, limit)))
    hit = [f"so " + " ".join(f"b{i}x{j}" for j in range(14)) + " end" for i in range(4)]
    docs = spark.createDataFrame([*ODD, *((10 + i, t, 0, None) for i, t in enumerate(hit)), (20, "b1x1 b1x2", 0, None)], SCHEMA)
    got = corpus_pipeline.decontaminated(spark, docs, folder)
    assert sorted(map(str, (r["doc_id"] for r in got.collect()))) == sorted(map(str, [*(r[0] for r in ODD), 20]))
    assert (len(seen) > 2) == (limit == 2)
