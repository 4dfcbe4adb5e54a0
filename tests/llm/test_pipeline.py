"""Every stage of the pipeline on its own input, against brute force."""

import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

pytest.importorskip("folioforge.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")
sys.path.insert(0, str(Path(__file__).parent))
import test_decontaminate  # noqa: E402
import test_jaccard  # noqa: E402
import test_token_store  # noqa: E402

from folioforge.llm import attention_mil  # noqa: E402

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{i}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{i}")
        kept.append(docs.count())
        rows = before.select("doc_id", "text").collect()
        if i < 4:
            assert docs.columns == before.columns
            assert docs.join(before, before.columns, "left_anti").count() == 0
        if i == 0:
            scored = attention_mil.classify(before, spark.read.parquet(f"{SF}/labels.parquet"))
            assert ids(docs) == ids(scored.filter("predicted = 1"))
        if i == 1:
            assert ids(docs) == sorted({int(c) for _, _, c in test_jaccard.brute([(r["doc_id"], r["text"]) for r in rows])})
        if i == 2:
            bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert ids(docs) == sorted(int(x[0]) for x in test_decontaminate.brute([(r["doc_id"], r["text"]) for r in rows], bench) if not x[4])
        if i == 4:
            streams = {r["doc_id"]: np.array([*x, 2], "<u4") for r, x in zip(rows, test_token_store.direct([r["text"] for r in rows]), strict=True)}
            at = 0
            for r in docs.orderBy("doc_id").collect():
                x = streams[r["doc_id"]]
                assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(x), zlib.crc32(x.tobytes()))
                at += len(x)
    assert kept == sorted(kept, reverse=True) and kept[0] < 200 and kept[-1] > 50


def test_entry_without_the_subpackage(tmp_path):
    import shutil
    import subprocess

    repo = Path(__file__).resolve().parents[2]
    shutil.copytree(repo / "folioforge", tmp_path / "folioforge", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(repo / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert not [q for q in e.queries() if q.startswith('op')]"], cwd=tmp_path, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
