"""Near copies are dropped row by row, also where ids repeat or are missing."""

import pytest

pytest.importorskip("folioforge.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

A, B, C, D = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")


def test_one_row_of_each_component(spark, tmp_path):
    rows = [(5, B), (3, B), (5, A), (7, C), (7, C), (None, D), (None, D + " more"), (None, B), (8, ""), (8, ""), (9, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    got = corpus_pipeline.near_duplicates(spark, spark.read.parquet(f"{tmp_path}/docs"), "")
    assert got.columns == ["doc_id", "text"]
    got = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str)
    assert [x for x in got if x[0] is not None] == sorted([(3, B), (5, A), (7, C), (8, ""), (8, ""), (9, None)], key=str)
    assert len([x for x in got if x[0] is None]) == 1 and got[-1][1].startswith(D)
