"""Runs with clients and streams over the driver tables, with SQL twins: what a run leaves must equal what one pass would say."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import fanout as O
from ..operators import indexing as I
from ..operators import runtime as U
from ..sources import files as S
from ..streaming import folded, log_stream, upsert_batches, upserted
from ..streaming import state as Z
from .base import query
from .sources import round_trip


def _reader() -> Callable[[dict], str]:
    """A client that reads pages; it fails on every sixth number of document and page."""

    def client(row: dict) -> str:
        if (row["doc_id"] + row["page"]) % 6 == 0:
            raise ValueError("unreadable")
        return json.dumps({"page_number": row["page"], "has_articles": True})

    return client


def _joiner() -> Callable[[dict], str | None]:
    """A client that lists the pages it is given; it gives nothing for every ninth document."""

    def client(row: dict) -> str | None:
        pages = json.loads(row["contents"])
        return None if row["doc_id"] % 9 == 4 else ",".join(f"{p['page_number']}{'' if p['has_articles'] else '-'}" for p in pages)

    return client


@round_trip(
    "index_run",
    """SELECT p.doc_id, p.pages, p.failed, CASE WHEN p.failed * 5 > p.pages THEN 'too_many_errors' WHEN p.doc_id % 9 = 4 THEN 'failed' ELSE 'indexed' END AS status, CASE WHEN p.failed * 5 <= p.pages AND p.doc_id % 9 <> 4 THEN p.said END AS "index"
    FROM (SELECT doc_id, count(*) AS pages, count(*) FILTER (WHERE (doc_id + page) % 6 = 0) AS failed, string_agg(page || CASE WHEN (doc_id + page) % 6 = 0 THEN '-' ELSE '' END, ',' ORDER BY page) AS said FROM (SELECT DISTINCT conv_id AS doc_id, turn AS page FROM conversations) GROUP BY 1) p""",
    pages_="SELECT CAST(conv_id AS BIGINT) AS doc_id, CAST(turn AS INT) AS page, min(text) AS text FROM {conversations} GROUP BY conv_id, turn",
)
def index_run(spark, path, pages_):
    report = I.run_index(pages_, _reader, _joiner, path)
    return report.join(I.indexes(spark, path).select("doc_id", "index"), "doc_id", "left")


def _echo() -> Callable[[dict], str]:
    return lambda row: json.dumps({"lang": row["lang"], "n": row["doc_id"]})


def _moody() -> Callable[[dict], str]:
    """A client that fails, answers in prose, leaves a field out, or answers inside a fence."""

    def client(row: dict) -> str:
        kind = row["doc_id"] % 4
        if kind == 0:
            raise ValueError("no")
        return {1: "I would rather not", 2: '{"lang": "x"}', 3: f'```json\n{{"lang": "y", "n": {row["doc_id"]}}}\n```'}[kind]

    return client


@query(
    "panel_answers",
    """SELECT doc_id, 'echo' AS model, lang, doc_id AS n, NULL AS error FROM docs UNION ALL
    SELECT doc_id, 'moody', CASE WHEN doc_id % 4 = 3 THEN 'y' END, CASE WHEN doc_id % 4 = 3 THEN doc_id END, CASE CAST(doc_id % 4 AS INTEGER) WHEN 0 THEN 'ValueError: no' WHEN 1 THEN 'invalid answer: lang, n' WHEN 2 THEN 'invalid answer: n' END FROM docs""",
    docs="SELECT doc_id, lang FROM {documents}",
)
def panel_answers(docs: DataFrame) -> DataFrame:
    called = O.by_model(O.fan_out(docs, {"echo": _echo, "moody": _moody}, ["doc_id", "lang"]))
    out = O.structured(called, "lang string, n long", ["lang", "n"])
    return out.select("doc_id", "model", "answer.lang", "answer.n", "error")


_LOG = {"log": "SELECT user_id, event_id, event_type FROM {events}"}
_LAST = "SELECT user_id, max(event_id) AS event_id, max_by(event_type, event_id) AS event_type FROM events GROUP BY 1"


@round_trip("stream_last_records", _LAST, **_LOG)
def stream_last_records(spark, path, log):
    """The log arrives in files; the report of the batches equals one pass over all of it."""
    log.repartition(6, "event_id").write.json(f"{path}/in")
    stream = folded(log_stream(spark, f"{path}/in", "user_id long, event_id long, event_type string", 2), ["user_id"], "event_id")
    upsert_batches(stream, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return upserted(spark, f"{path}/out", ["user_id"])


@round_trip("stream_state_records", _LAST, **_LOG)
def stream_state_records(spark, path, log):
    """The same with keyed state, a checkpoint bound to its context, and batches compacted."""
    log.repartition(4, "event_id").write.json(f"{path}/in")
    Z.bind_context(spark, f"{path}/checkpoint", {"schema": 1})
    stream = Z.folded_state(log_stream(spark, f"{path}/in", "user_id long, event_id long, event_type string", 2), ["user_id"], "event_id")
    upsert_batches(stream, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    Z.compact(spark, f"{path}/out", ["user_id"], keep=1)
    return Z.compacted(spark, f"{path}/out", ["user_id"]).drop("batch")


@query("finished_ids", "SELECT DISTINCT trim(id) AS id FROM done WHERE trim(id) <> ''", done="SELECT CASE WHEN o_custkey % 5 = 0 THEN '  ' WHEN o_custkey % 5 = 1 THEN NULL ELSE concat(' ', CAST(o_custkey AS VARCHAR(20)), ' ') END AS id FROM {orders}")
def finished_ids(done: DataFrame) -> DataFrame:
    return S.completed_ids(done, "id")


@query("kept_language_shares", "SELECT doc_id, lang || CASE WHEN doc_id % 4 = 0 THEN '|' || source ELSE '' END AS langs FROM docs WHERE doc_id % 3 <> 0 UNION ALL SELECT doc_id, source FROM docs WHERE doc_id % 3 = 0 AND doc_id % 4 = 0", docs="SELECT doc_id, lang, source FROM {documents}")
def kept_language_shares(docs: DataFrame) -> DataFrame:
    one = lambda name, share: F.struct(F.col(name).alias("name"), share.alias("share"))
    heard = F.array(one("lang", F.when(F.col("doc_id") % 3 != 0, "dominant").otherwise("trace")), one("source", F.when(F.col("doc_id") % 4 == 0, "secondary")))
    kept = S.kept_shares(docs.select("doc_id", heard.alias("heard")), "heard", ["dominant", "secondary"])
    return kept.select("doc_id", F.array_join(F.transform("heard", lambda x: x["name"]), "|").alias("langs"))


@query("overlaid_settings", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'base' END AS model, CASE WHEN event_id % 3 = 0 THEN event_id ELSE 7 END AS budget FROM calls", calls="SELECT event_id, event_type FROM {events}")
def overlaid_settings(calls: DataFrame) -> DataFrame:
    base = F.struct(F.lit("base").alias("model"), F.lit(7).cast("long").alias("budget"))
    over = F.struct(F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("model"), F.when(F.col("event_id") % 3 == 0, F.col("event_id")).alias("budget"))
    return calls.select("event_id", U.overlaid(base, over, ["model", "budget"]).alias("s")).select("event_id", "s.*")
