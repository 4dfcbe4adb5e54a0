"""Annotation logs derived from the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import annotate as N
from .base import query

LOG = "SELECT user_id AS item_id, event_type AS model, event_id AS seq, event_id % 3 AS prompt, value, CASE WHEN event_id % 4 = 0 THEN 'bad' END AS err FROM {events}"
_LAST = "last AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY item_id, model ORDER BY seq DESC) = 1)"


@query("cache_last_wins", f"+{_LAST} SELECT item_id, model, seq, value FROM last WHERE prompt = 1", log=LOG)
def cache_last_wins(log):
    return N.cached(log, ["item_id", "model"], "seq", F.col("prompt") == 1).select("item_id", "model", "seq", "value")


@query("partial_last_wins", "SELECT item_id, model, seq, value FROM log WHERE prompt = 1 QUALIFY row_number() OVER (PARTITION BY item_id, model ORDER BY seq DESC) = 1", log=LOG)
def partial_last_wins(log):
    return N.latest_of(log, ["item_id", "model"], "seq", F.col("prompt") == 1).select("item_id", "model", "seq", "value")


@query("cache_pending", f"+{_LAST} SELECT i.item_id, m.model FROM (SELECT DISTINCT item_id FROM log) i CROSS JOIN (SELECT DISTINCT model FROM log) m ANTI JOIN (SELECT * FROM last WHERE prompt = 1) h USING (item_id, model)", log=LOG)
def cache_pending(log):
    have = N.cached(log, ["item_id", "model"], "seq", F.col("prompt") == 1)
    return N.pending(log.select("item_id").distinct(), log.select("model").distinct(), have, ["item_id", "model"])


@query("offline_done_set", "SELECT DISTINCT item_id FROM log WHERE prompt = 1 AND err IS NULL", log=LOG)
def offline_done(log):
    return N.done(log, ["item_id"], (F.col("prompt") == 1) & F.col("err").isNull())


@query(
    "cache_load_report",
    """+ t AS (SELECT pos, trim(line) AS line FROM lines WHERE trim(line) <> ''),
    f AS (SELECT pos, json_valid(line) AS ok, CASE WHEN json_valid(line) THEN line END AS line FROM t),
    x AS (SELECT pos, json_extract_string(line, '$.item_id') AS item, CASE WHEN NOT ok THEN 'torn' WHEN json_type(line) <> 'OBJECT' THEN 'malformed' WHEN coalesce(json_extract_string(line, '$.v'), '') <> '1' THEN 'other'
        WHEN coalesce(json_extract_string(line, '$.item_id'), '') = '' OR coalesce(json_extract_string(line, '$.model'), '') = '' OR coalesce(json_type(json_extract(line, '$.result')), '') <> 'OBJECT' THEN 'malformed' ELSE 'record' END AS kind FROM f)
    SELECT count(*) FILTER (WHERE kind = 'record') AS records, count(DISTINCT CASE WHEN kind = 'record' THEN item END) AS items, count(*) FILTER (WHERE kind IN ('torn', 'malformed')) AS malformed,
        count(*) FILTER (WHERE kind = 'other') AS other_version, min(pos) FILTER (WHERE kind = 'torn') AS first_torn FROM x""",
    lines="""SELECT event_id AS pos, CASE WHEN event_id % 97 = 5 THEN concat(chr(123), '"v": "1", "item') WHEN event_id % 89 = 3 THEN '[1]' WHEN event_id % 83 = 7 THEN '  ' WHEN event_id % 79 = 4 THEN concat(chr(123), '"item_id": "x"', chr(125))
             ELSE concat(chr(123), '"v": "', CAST(1 + event_id % 2 AS VARCHAR(20)), '", "item_id": "', CASE WHEN event_id % 73 = 2 THEN '' ELSE CAST(user_id AS VARCHAR(20)) END, '"', CASE WHEN event_id % 71 = 1 THEN '' ELSE ', "model": "m"' END, ', "result": ', CASE WHEN event_id % 67 = 9 THEN '[]' ELSE concat(chr(123), '"a": 1', chr(125)) END, chr(125), CASE WHEN event_id % 61 = 8 THEN concat(' ', chr(125)) WHEN event_id % 59 = 8 THEN ' rest' ELSE ' ' END) END AS line FROM {events}""",
)
def load_report(lines):
    return N.load_report(lines, "1")


@query(
    "eligibility_funnel",
    "SELECT status, n FROM (SELECT s.status, count(f.status) AS n FROM (SELECT unnest(['seen', 'language_unknown', 'language_skipped', 'short', 'eligible', 'failed']) AS status) s LEFT JOIN (SELECT CASE WHEN labelled THEN 'seen' WHEN label IS NULL THEN 'language_unknown' WHEN label NOT IN ('Français', 'Anglais') THEN 'language_skipped' WHEN n_chars < 500 THEN 'short' ELSE 'eligible' END AS status FROM items) f USING (status) GROUP BY 1)",
    items="SELECT d.doc_id, n_chars, l.doc_id IS NOT NULL AND quality = 1 AS labelled, CASE lang WHEN 'fr' THEN 'Français' WHEN 'en' THEN 'Anglais' WHEN 'es' THEN 'Espagnol' END AS label FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id",
)
def funnel(items):
    gates = [("language_unknown", F.col("label").isNull()), ("language_skipped", ~F.col("label").isin("Français", "Anglais")), ("short", F.col("n_chars") < 500)]
    status = N.funnel(F.coalesce("labelled", F.lit(False)), gates)
    return N.status_counts(items.select(status.alias("s")), "s", ["seen", "language_unknown", "language_skipped", "short", "eligible", "failed"])


@query("items_first_wins", "SELECT item_id, seq, value FROM log QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY seq) = 1", log=LOG)
def first_wins(log):
    return N.earliest(log, ["item_id"], "seq").select("item_id", "seq", "value")


@query("items_last_wins", "SELECT item_id, seq, value FROM log QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY seq DESC) = 1", log=LOG)
def last_wins(log):
    return N.latest(log, ["item_id"], "seq").select("item_id", "seq", "value")


def stub_client(model: str, text: str) -> str:
    """A deterministic stand-in for a remote model."""
    if model == "broken":
        raise RuntimeError("no answer")
    return f"{model}:{len(text)}"


@query(
    "annotate_stub",
    "SELECT item_id, model, CASE WHEN model = 'small' THEN 'small:' || CAST(length(text) AS VARCHAR) END AS result, CASE WHEN model = 'broken' THEN 'no answer' END AS error FROM items",
    items="SELECT doc_id AS item_id, text, m.model FROM {documents} CROSS JOIN (SELECT 'small' AS model UNION ALL SELECT 'broken') m",
)
def annotate_stub(items):
    return N.map_over_models(items, stub_client)
