"""Streams that resume: a checkpoint bound to its context, a log folded in keyed state, and batches compacted."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..sinks.commit import _Folder, commit, current, exists

FORMAT = 1


class CheckpointMismatch(RuntimeError):
    """What a checkpoint was made for differs from what is asked of it."""


def bind_context(spark: SparkSession, checkpoint: str, context: dict, reset: bool = False) -> None:
    """Ties a checkpoint to the settings its results depend on; a run with other ones, an unreadable record or another format raises.

    The record lies beside the checkpoint, as <checkpoint>.context/context.json,
    and is written in one step.  ``reset`` takes the new context over; the
    caller then also chooses fresh output.
    """
    folder = _Folder(spark, f"{checkpoint.rstrip('/')}.context")
    said = folder.read("context.json")
    if said is not None and not reset:
        try:
            was = json.loads(said)
        except ValueError as e:
            raise CheckpointMismatch(f"the context of {checkpoint} cannot be read") from e
        if not isinstance(was, dict) or was.get("version") != FORMAT:
            raise CheckpointMismatch(f"the context of {checkpoint} has another format")
        if was.get("context") != json.loads(json.dumps(context)):
            raise CheckpointMismatch(f"{checkpoint} belongs to {was.get('context')}, not to {context}")
        return
    folder.fs.mkdirs(folder.at(""))
    folder.replace("context.json", json.dumps({"version": FORMAT, "context": context}, sort_keys=True))


class _Latest(StatefulProcessor):
    """Per key the record with the highest seq, as JSON; a batch emits it only where it changed."""

    def __init__(self, keys: list[str]):
        self.keys = keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "seq long, record string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = self.last.get() if self.last.exists() else None
        new = best
        for frame in rows:
            if len(frame):
                row = frame.loc[frame["ff_seq"].idxmax()]
                if new is None or row["ff_seq"] >= new[0]:
                    new = (int(row["ff_seq"]), row["ff_record"])
        if new is not None and new is not best:
            self.last.update(new)
            yield pd.DataFrame([(*key, *new)], columns=[*self.keys, "ff_seq", "ff_record"])

    def close(self) -> None:
        pass


def folded_state(log: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The last record of each key so far, by a whole number seq, as keyed state that holds one record a key; older records that come late change nothing and send nothing.

    Works on streams whose session keeps state in RocksDB, which this sets.
    Rows without a seq are left out; null keys are a key.
    """
    spark = log.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rest = [c for c in log.columns if c not in keys]
    schema = log.select(*rest).schema
    packed = log.filter(F.col(seq).isNotNull()).select(*keys, F.col(seq).cast("long").alias("ff_seq"), F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}).alias("ff_record"))
    kinds = dict(log.dtypes)
    out = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", ff_seq long, ff_record string"
    kept = packed.groupBy(*keys).transformWithStateInPandas(statefulProcessor=_Latest(keys), outputStructType=out, outputMode="Update", timeMode="None")
    return kept.select(*keys, F.from_json("ff_record", schema).alias("_r")).select(*keys, "_r.*")


def _batches(spark: SparkSession, path: str) -> list[int]:
    folder = _Folder(spark, path)
    if not folder.fs.exists(folder.at("")):
        return []
    names = [s.getPath().getName() for s in folder.fs.listStatus(folder.at("")) if s.isDirectory()]
    return sorted(int(n[6:]) for n in names if n.startswith("batch=") and n[6:].isdecimal())


def _last_of_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_r")).select(*keys, "_r.*")


def compacted(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The report that batches under path make, with its column batch: the compacted base and all batches after it."""
    parts = []
    upto = -1
    if exists(spark, f"{path}/base"):
        base = current(spark, f"{path}/base")
        upto = base.agg(F.max("batch")).first()[0]
        parts.append(base)
    for n in _batches(spark, path):
        if n > (-1 if upto is None else upto):
            parts.append(spark.read.parquet(f"{path}/batch={n}").withColumn("batch", F.lit(n).cast("long")))
    if not parts:
        raise FileNotFoundError(f"no batches at {path}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return _last_of_keys(out, keys)


def compact(spark: SparkSession, path: str, keys: list[str], keep: int = 2) -> int:
    """Merges all batches but the last ``keep`` into the base, then deletes their folders; returns how many batches stay.

    The last batches stay because a stream may run them again.  Readers of
    ``compacted`` see the same report before and after: the base names the last
    batch in it, and folders up to that one are not read, deleted or not.
    """
    there = _batches(spark, path)
    old = there[: max(0, len(there) - keep)]
    if old:
        parts = [spark.read.parquet(f"{path}/batch={n}").withColumn("batch", F.lit(n).cast("long")) for n in old]
        rows = parts[0]
        if exists(spark, f"{path}/base"):
            base = current(spark, f"{path}/base")
            upto = base.agg(F.max("batch")).first()[0]
            parts = [p for p, n in zip(parts, old, strict=True) if n > upto]
            rows, parts = base, [base, *parts]
        for p in parts[1:]:
            rows = rows.unionByName(p, allowMissingColumns=True)
        commit(_last_of_keys(rows, keys), f"{path}/base")
        folder = _Folder(spark, path)
        for n in old:
            folder.fs.delete(folder.at(f"batch={n}"), True)
    return len(there) - len(old)
