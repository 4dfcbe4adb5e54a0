"""Structured Streaming forms: the log folded as it grows, reports upserted by key, a stop on terminal errors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import is_json


def log_stream(spark: SparkSession, path: str, schema: str, files_a_batch: int = 100) -> DataFrame:
    """JSON lines of a folder as they arrive, a bounded number of files at a time; torn lines are left out."""
    read = spark.readStream.option("maxFilesPerTrigger", files_a_batch).text(path)
    return read.select(F.from_json("value", schema).alias("r"), is_json(F.col("value")).alias("ok")).filter("ok and r is not null").select("r.*")


def folded(log: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The last record of each key so far; state holds one record a key."""
    rest = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("_r")).select(*keys, "_r.*")


def upsert_batches(stream: DataFrame, path: str, checkpoint: str, guard: Callable[[DataFrame], None] | None = None, mode: str = "update") -> StreamingQuery:
    """Every batch's changed rows under path/batch=N: a batch that runs again replaces its own rows.

    ``guard`` sees a batch after it has been kept and may raise to end the
    query; batches before it stay.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
        if guard is not None:
            guard(batch)
        batch.unpersist()

    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start()


def upserted(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The report that the batches make: of each key the row of its last batch."""
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in [*keys, "batch"]]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_r")).select(*keys, "_r.*")


def stop_on(kind: str, terminal: str = "terminal") -> Callable[[DataFrame], None]:
    """A guard that ends the query when a row's column ``kind`` says so."""

    def guard(batch: DataFrame) -> None:
        if batch.filter(F.col(kind) == terminal).limit(1).count():
            raise RuntimeError("a terminal error ends the run; what came before it is kept")

    return guard
