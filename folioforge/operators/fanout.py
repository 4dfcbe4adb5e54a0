"""Every row to several models at once, with a deadline for each call, and answers as typed columns."""

from __future__ import annotations

import queue
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import Terminal, json_payload

TIMEOUT = "Timeout"


class Calls:
    """At most ``width`` calls at a time, each on a thread of its own that cannot keep the process alive.

    A call that passes its deadline, counted from its start, is given up: its
    slot is free again and what it returns later is dropped.
    """

    def __init__(self, width: int, timeout: float, clock: Callable[[], float] = time.monotonic):
        self.width, self.timeout, self.clock = width, timeout, clock
        self.waiting, self.running, self.done, self.news = deque(), {}, {}, queue.SimpleQueue()

    def submit(self, key, call: Callable[[], object]) -> None:
        self.waiting.append((key, call))
        self._start()

    def _start(self) -> None:
        while self.waiting and len(self.running) < self.width:
            key, call = self.waiting.popleft()
            self.running[key] = self.clock() + self.timeout
            threading.Thread(target=self._run, args=(key, call), daemon=True).start()

    def _run(self, key, call) -> None:
        try:
            self.news.put((key, call(), None))
        except BaseException as e:  # noqa: BLE001  handed to whoever waits
            self.news.put((key, None, e))

    def result(self, key) -> tuple[object, BaseException | None]:
        """What a call returned or raised; a terminal error of any call drops all that wait, and is raised at once."""
        while key not in self.done:
            if self.running:
                least = min(self.running.values())
                try:
                    name, value, error = self.news.get(timeout=max(0.0, least - self.clock()))
                    if self.running.pop(name, None) is not None:
                        self.done[name] = value, error
                        if isinstance(error, Terminal):
                            self.waiting.clear()
                            raise error
                except queue.Empty:
                    for name in [n for n, end in self.running.items() if end <= self.clock()]:
                        del self.running[name]
                        self.done[name] = None, TimeoutError(TIMEOUT)
            self._start()
        return self.done.pop(key)


def fan_out(rows: DataFrame, models: dict[str, Callable[[], Callable[[dict], str]]], columns: list[str], timeout: float = 120.0, width: int = 6) -> DataFrame:
    """rows with a map ``results``: per model its result and error, in the order of ``models``.

    models: per name a function that makes a client, once a task; a client gets
    a dict of ``columns``.  A task has at most ``width`` calls open and twice as
    many rows in hand.  Rows keep their order.  A call that fails is an error
    'Kind: message', one that takes longer than ``timeout`` seconds is
    'Timeout'; a terminal error drops what waits and ends the job.
    """
    names = list(models)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        clients = {m: make() for m, make in models.items()}
        calls, serial = Calls(width, timeout), 0

        def gathered(number: int) -> dict:
            out = {}
            for m in names:
                value, error = calls.result((number, m))
                said = None if error is None else TIMEOUT if isinstance(error, TimeoutError) and str(error) == TIMEOUT else f"{type(error).__name__}: {error}"
                out[m] = {"result": value, "error": said}
            return out

        for frame in frames:
            hand, results = deque(), []
            for row in frame[columns].to_dict("records"):
                for m in names:
                    calls.submit((serial, m), lambda c=clients[m], r=row: c(r))
                hand.append(serial)
                serial += 1
                if len(hand) >= 2 * width:
                    results.append(gathered(hand.popleft()))
            results += [gathered(n) for n in hand]
            yield frame.assign(results=pd.Series(results, dtype=object, index=frame.index))

    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", results map<string, struct<result: string, error: string>>"
    return rows.mapInPandas(run, schema)


def by_model(rows: DataFrame) -> DataFrame:
    """Rows of ``fan_out`` as one row per model: model, result, error."""
    kept = [c for c in rows.columns if c != "results"]
    return rows.select(*kept, F.explode("results").alias("model", "_r")).select(*kept, "model", "_r.result", "_r.error")


def structured(rows: DataFrame, schema: str, required: list[str], result: str = "result", error: str = "error") -> DataFrame:
    """rows with ``answer``: the result's JSON document as a struct of the schema.

    An answer that holds no object, or lacks a required field, or has another
    type there, is null and its row gets an error; rows with an error keep it.
    """
    parsed = F.from_json(json_payload(F.col(result)), schema)
    out = rows.withColumn("answer", F.when(F.col(error).isNull(), parsed))
    lacks = F.filter(F.array(*(F.when(F.col(f"answer.`{f}`").isNull(), F.lit(f)) for f in required)), lambda x: x.isNotNull())
    bad: Column = F.when(F.col("answer").isNull() | (F.size(lacks) > 0), F.concat(F.lit("invalid answer: "), F.array_join(F.coalesce(lacks, F.array()), ", ")))
    out = out.withColumn("_bad", F.when(F.col(error).isNull(), bad))
    return out.withColumns({error: F.coalesce(error, "_bad"), "answer": F.when(F.col("_bad").isNull(), F.col("answer"))}).drop("_bad")
