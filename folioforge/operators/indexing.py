"""Two-step indexes of documents: pages read one by one, then one index per document, as a run that can be resumed.

A run keeps two tables under its path.  ``pages`` holds what was read of pages
of documents that have no index yet, failures as placeholders; it is replaced
as a whole by each step (see ``sinks.commit``).  ``index`` holds the finished
indexes.  Documents are taken in rounds.  In a round pages without a result are
read and stored; then documents with at most a given share of failed pages are
consolidated and stored; only then are their pages dropped.  A run killed
anywhere is started again the same way: stored pages are not read again, and a
document with an index is left alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.commit import commit, current
from .runtime import Terminal

SHARE = 0.20  # fixed value: more failed pages than this share stop a document before its consolidation
PAGES = "doc_id long, page int, result string, error string"
INDEX = "doc_id long, index string, extraction_errors long"
NO_RESULT = "Error processing this page."  # fixed value: of a page whose call returned nothing


def _called(rows: DataFrame, make: Callable[[], Callable[[dict], str | None]], columns: list[str], out: str) -> DataFrame:
    """rows with ``out``, error and state (done, failed, ended, waiting): after a terminal error a task calls no more, and keeps what it has."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, over = make(), False
        for frame in frames:
            got = []
            for row in frame[columns].to_dict("records"):
                if over:
                    got.append((None, None, "waiting"))
                    continue
                try:
                    value = client(row)
                    got.append((value, None, "done") if value else (None, NO_RESULT, "failed"))
                except Terminal as e:
                    over = True
                    got.append((None, str(e), "ended"))
                except Exception as e:  # noqa: BLE001  a failed call is a placeholder
                    got.append((None, f"Error: {e}", "failed"))
            each = [pd.Series(list(c), dtype=object, index=frame.index) for c in zip(*got, strict=True)] if got else [pd.Series(dtype=object)] * 3
            yield frame.assign(**{out: each[0], "error": each[1], "state": each[2]})

    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + f", `{out}` string, error string, state string"
    return rows.mapInPandas(run, schema)


def _stop_if_ended(spark: SparkSession, ended: str | None) -> None:
    if ended is not None:
        raise Terminal(ended)


def kept_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages read so far of documents without an index: doc_id, page, result, error (of placeholders)."""
    return current(spark, f"{path}/pages", schema=PAGES)


def indexes(spark: SparkSession, path: str) -> DataFrame:
    """Finished indexes: doc_id, index, extraction_errors (failed pages)."""
    return current(spark, f"{path}/index", schema=INDEX)


def read_pages(pages: DataFrame, make: Callable, path: str) -> None:
    """Step one: reads the pages (doc_id, page, text) that have no stored result, and stores results and placeholders; ends with a terminal error, if one came, after storing."""
    spark = pages.sparkSession
    have = kept_pages(spark, path)
    done = have.filter("result is not null")
    todo = pages.select("doc_id", "page", "text").join(done.select("doc_id", "page"), ["doc_id", "page"], "left_anti")
    read = _called(todo, make, ["doc_id", "page", "text"], "result").drop("text").persist()  # calls are made once
    try:
        stored = read.filter("state in ('done', 'failed')").select("doc_id", "page", "result", "error")
        commit(have.join(stored.select("doc_id", "page"), ["doc_id", "page"], "left_anti").unionByName(stored), f"{path}/pages")
        ended = read.filter("state = 'ended'").select("error").head()
    finally:
        read.unpersist()
    _stop_if_ended(spark, ended and ended["error"])


def page_states(pages: DataFrame, have: DataFrame, share: float) -> DataFrame:
    """doc_id, pages, failed, ready: whether all pages were tried and at most ``share`` of them failed."""
    tried = pages.select("doc_id", "page").join(have, ["doc_id", "page"], "left")
    out = tried.groupBy("doc_id").agg(F.count(F.lit(1)).alias("pages"), F.count_if(F.col("error").isNotNull()).alias("failed"), F.count_if(F.col("error").isNull() & F.col("result").isNull()).alias("open"))
    return out.select("doc_id", "pages", "failed", ((F.col("open") == 0) & (F.col("failed") <= F.lit(share) * F.col("pages"))).alias("ready"))


def consolidate(pages: DataFrame, make: Callable, path: str, share: float = SHARE) -> None:
    """Step two: an index for every document whose pages are read; a client gets doc_id and contents, the pages' results in order as a JSON list."""
    spark = pages.sparkSession
    have = kept_pages(spark, path)
    ready = page_states(pages, have, share).filter("ready").select("doc_id", F.col("failed").alias("extraction_errors"))
    told = F.coalesce("result", F.to_json(F.struct(F.col("page").alias("page_number"), F.lit(False).alias("has_articles"), F.col("error").alias("other_content"))))
    contents = F.transform(F.array_sort(F.collect_list(F.struct("page", told.alias("told")))), lambda x: x["told"])
    docs = have.join(ready, "doc_id").groupBy("doc_id", "extraction_errors").agg(F.concat(F.lit("["), F.array_join(contents, ","), F.lit("]")).alias("contents"))
    made = _called(docs, make, ["doc_id", "contents"], "index").drop("contents").persist()
    try:
        commit(indexes(spark, path).unionByName(made.filter("state = 'done'").select("doc_id", "index", "extraction_errors")), f"{path}/index")
        ended = made.filter("state = 'ended'").select("error").head()
    finally:
        made.unpersist()
    _stop_if_ended(spark, ended and ended["error"])


def drop_indexed(spark: SparkSession, path: str) -> None:
    """Step three: pages of documents that have an index are dropped."""
    commit(kept_pages(spark, path).join(indexes(spark, path).select("doc_id"), "doc_id", "left_anti"), f"{path}/pages")


def run_index(pages: DataFrame, make_extract: Callable, make_consolidate: Callable, path: str, share: float = SHARE, rounds: int = 1) -> DataFrame:
    """Runs or resumes all steps over pages (doc_id, page, text), and returns doc_id, pages, failed, status per document.

    status: indexed, too_many_errors (no consolidation was tried), failed (its
    consolidation failed; its pages stay), or open.  make_extract and
    make_consolidate make one client a task; a page's client gets doc_id, page
    and text and returns a JSON object.  Null page texts are passed on.  (doc_id, page)
    must be unique and not null.  More rounds lose less when a run is killed.
    """
    spark = pages.sparkSession
    for i in range(rounds):
        mine = pages.filter(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == i).join(indexes(spark, path).select("doc_id"), "doc_id", "left_anti")
        read_pages(mine, make_extract, path)
        consolidate(mine, make_consolidate, path, share)
        drop_indexed(spark, path)
    done = indexes(spark, path).select("doc_id", F.col("extraction_errors").alias("_e"))
    counted = page_states(pages, kept_pages(spark, path), share).join(done, "doc_id", "left")
    status = F.when(F.col("_e").isNotNull(), "indexed").when(F.col("ready"), "failed").when(F.col("failed") > F.lit(share) * F.col("pages"), "too_many_errors").otherwise("open")
    return counted.select("doc_id", "pages", F.coalesce("_e", "failed").alias("failed"), status.alias("status"))
