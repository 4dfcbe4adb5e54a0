"""Append-only annotation logs: latest state, pending work, done sets, load reports."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip, whole_json
from .runtime import Terminal


def latest(log: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """The record with the highest seq per key: a map-side aggregate, no window over a key's whole history."""
    rest = [c for c in log.columns if c not in keys]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("_last"))
    return last.select(*keys, *(F.col(f"_last.{c}").alias(c) for c in rest))


def earliest(rows: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """The record with the lowest seq per key."""
    rest = [c for c in rows.columns if c not in keys]
    first = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), seq).alias("_first"))
    return first.select(*keys, *(F.col(f"_first.{c}").alias(c) for c in rest))


def cached(log: DataFrame, keys: Sequence[str], seq: str, provenance: Column) -> DataFrame:
    """Last record wins, then provenance is tested on it alone: an older match behind a newer mismatch is a miss."""
    return latest(log, keys, seq).filter(provenance)


def latest_of(log: DataFrame, keys: Sequence[str], seq: str, provenance: Column) -> DataFrame:
    """Provenance is tested first, then the last record wins."""
    return latest(log.filter(provenance), keys, seq)


def done(log: DataFrame, keys: Sequence[str], success: Column) -> DataFrame:
    """Keys with any success; a later failure does not undo it."""
    return log.filter(success).select(*keys).distinct()


def pending(items: DataFrame, models: DataFrame, have: DataFrame, keys: Sequence[str]) -> DataFrame:
    """items x models without what have holds; models is a configuration table of a few rows."""
    return items.crossJoin(F.broadcast(models)).join(have.select(*keys), list(keys), "left_anti")


def load_report(lines: DataFrame, version: str) -> DataFrame:
    """lines (pos, line): records of the version, distinct items, malformed lines, other versions, first torn line.

    Blank lines count nowhere.  A line that is not one whole JSON document is
    torn, and malformed; a document whose v is another one, or missing, is of
    another version; one of the version is malformed if it is no object, has no
    item_id or no model (missing, null or empty), or a result that is no object.
    """
    docs = lines.filter(strip(F.col("line")) != "").select("pos", whole_json(strip(F.col("line"))).alias("doc"))
    field = lambda name: F.coalesce(F.try_variant_get("doc", f"$.{name}", "string"), F.lit(""))
    kind = F.when(F.col("doc").isNull(), "torn").when(~F.schema_of_variant("doc").startswith("OBJECT"), "malformed").when(field("v") != version, "other")
    result = F.coalesce(F.schema_of_variant(F.try_variant_get("doc", "$.result", "variant")), F.lit("")).startswith("OBJECT")
    kind = kind.when((field("item_id") == "") | (field("model") == "") | ~result, "malformed").otherwise("record")
    parsed = docs.select("pos", kind.alias("kind"), field("item_id").alias("item"))
    is_ = lambda *kinds: F.col("kind").isin(*kinds)
    return parsed.agg(F.count_if(is_("record")).alias("records"), F.count_distinct(F.when(is_("record"), F.col("item"))).alias("items"), F.count_if(is_("torn", "malformed")).alias("malformed"), F.count_if(is_("other")).alias("other_version"), F.min(F.when(is_("torn"), F.col("pos"))).alias("first_torn"))


def valid(result_error: Column, label: Column, score: Column, absent: str) -> Column:
    """A result counts if it has no error and a missing score goes with the label for absence."""
    return result_error.isNull() & (score.isNotNull() | (label == absent))


def funnel(seen: Column, gates: Sequence[tuple[str, Column]], passed: str = "eligible") -> Column:
    """Name of the first gate that fails, in order; else passed."""
    out = F.when(seen, "seen") if seen is not None else None
    for name, fails in gates:
        out = F.when(fails, name) if out is None else out.when(fails, name)
    return out.otherwise(passed)


def status_counts(rows: DataFrame, column: str, statuses: Sequence[str]) -> DataFrame:
    """How often each status occurs; those that do not occur count 0."""
    all_of = rows.sparkSession.createDataFrame([(s,) for s in statuses], "status string")
    got = rows.groupBy(F.col(column).alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return all_of.join(got, "status", "left").select("status", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


class QuotaStop(Terminal):
    """A spent quota: every further call would fail the same way."""


def map_over_models(rows: DataFrame, client: Callable[[str, str], str], id_col: str = "item_id", text_col: str = "text", attempts: int = 3, delay: float = 0.0) -> DataFrame:
    """rows (id, text, model): one result or error row each.  client(model, text) is called as it is given.

    A blank text is an error row without a call; a failing call is tried again
    after a pause that grows from ``delay`` seconds, then becomes an error row; QuotaStop ends the job.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for item, model, text in zip(frame[id_col], frame["model"], frame[text_col], strict=True):
                result, error = None, "empty text" if not (text or "").strip() else None
                for turn in range(attempts if error is None else 0):
                    try:
                        time.sleep(delay * 2 ** (turn - 1) if turn else 0)
                        result, error = client(model, text), None
                        break
                    except QuotaStop:
                        raise
                    except Exception as e:  # noqa: BLE001 an error becomes a row
                        error = str(e)
                out.append((item, model, result, error))
            yield pd.DataFrame(out, columns=[id_col, "model", "result", "error"])

    kind = dict(rows.dtypes)[id_col]
    return rows.select(id_col, "model", text_col).mapInPandas(run, f"{id_col} {kind}, model string, result string, error string")


def numbered(rows: DataFrame, partition: Sequence[str], order: Sequence, name: str = "rn") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))
