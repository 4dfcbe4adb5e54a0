"""Around model calls: retries, rates, time budgets, levels, names of models, and what came back."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_json, strip

LEVELS = ("none", "minimal", "low", "medium", "high", "xhigh", "max")  # fixed values, least first


class Terminal(Exception):
    """An error after which no further call can succeed."""


def retried(call: Callable, attempts: int = 3, delay: float = 1.0, growth: float = 2.0, jitter: float = 0.25, sleep: Callable[[float], None] = time.sleep) -> Callable:
    """call, tried again after growing, slightly random pauses; terminal errors and the last one are raised."""

    def run(*args, **kw):
        for turn in range(attempts):
            try:
                return call(*args, **kw)
            except Terminal:
                raise
            except Exception:
                if turn == attempts - 1:
                    raise
                sleep(delay * growth**turn * (1 + jitter * random.random()))

    return run


class Pace:
    """At most ``a_minute`` calls a minute in this worker; give every task its share of the whole rate."""

    def __init__(self, a_minute: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.step, self.clock, self.sleep, self.next = 60.0 / a_minute, clock, sleep, 0.0

    def wait(self) -> None:
        now = self.clock()
        if now < self.next:
            self.sleep(self.next - now)
        self.next = max(now, self.next) + self.step


def call_budget(total: float, pauses: list[float], attempts: int, reserve: float = 5.0) -> float:
    """Seconds one attempt may take so that all attempts, pauses and a reserve fit into total; at least 1."""
    return max(1.0, (total - sum(pauses) - reserve) / attempts)


def mapped(rows: DataFrame, make: Callable[[], Callable[[dict], str]], columns: list[str]) -> DataFrame:
    """rows with result and error: ``make`` builds one client per task, each row calls it; terminal errors end the job, others become rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make()
        for frame in frames:
            result, error = [], []
            for row in frame[columns].to_dict("records"):
                try:
                    result.append(client(row))
                    error.append(None)
                except Terminal:
                    raise
                except Exception as e:  # noqa: BLE001  a failed call is a row of its own
                    result.append(None)
                    error.append(str(e))
            yield frame.assign(result=pd.Series(result, dtype=object, index=frame.index), error=pd.Series(error, dtype=object, index=frame.index))

    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", result string, error string"
    return rows.mapInPandas(run, schema)


def clamped(level: Column, supported: Column) -> Column:
    """The supported level (array) nearest to the one asked for, the higher of two equally near; unknown names, and models without levels, keep what was asked."""
    asked = F.lower(strip(level))
    place = lambda x: F.array_position(F.array(*map(F.lit, LEVELS)), x)
    near = F.array_min(F.transform(supported, lambda x: F.struct(F.abs(place(x) - place(asked)).alias("far"), (-place(x)).alias("down"), x.alias("level"))))
    keep = (F.coalesce(F.size(supported), F.lit(0)) < 1) | F.array_contains(supported, asked) | (place(asked) == 0)
    return F.when(level.isNull(), F.lit(None).cast("string")).when(F.coalesce(keep, F.lit(True)), asked).otherwise(near["level"])


def effort(provider: Column, asked: Column, declared: Column, default: Column) -> Column:
    """What a provider takes: one lets only declared efforts through, one knows high and none."""
    wanted = F.lower(strip(asked))
    return F.when(provider == "openrouter", F.when(F.array_contains(declared, wanted), wanted).otherwise(default)).when(provider == "mistral", F.when(wanted.isin("medium", "high", "xhigh", "max"), "high").otherwise("none")).otherwise(wanted)


def model_key(name: Column, aliases: DataFrame, rows: DataFrame, out: str = "model_key") -> DataFrame:
    """rows with the registry's key of a model's name: trimmed, lower case, aliases (alias, key) resolved, else the name itself."""
    keyed = rows.withColumn("_n", F.lower(strip(name)))
    return keyed.join(aliases.select(F.lower("alias").alias("_n"), F.col("key").alias("_k")), "_n", "left").withColumn(out, F.coalesce("_k", "_n")).drop("_n", "_k")


def overlaid(base: Column, over: Column, fields: list[str]) -> Column:
    """A struct of settings in which what ``over`` sets wins."""
    return F.struct(*(F.coalesce(over[f], base[f]).alias(f) for f in fields))


def json_payload(text: Column) -> Column:
    """The JSON document in an answer: all of it, a fenced block, the outermost braces or brackets; else the answer as it came."""
    whole = strip(text)
    parts = F.split(whole, "```", 3)  # before a fence, in it, behind it
    inner = F.when(F.size(parts) == 3, F.get(parts, F.lit(1)))
    fenced = strip(F.when(inner.startswith("json"), F.substring(inner, 5, 1 << 30)).otherwise(inner))
    inside = F.coalesce(F.nullif(fenced, F.lit("")), whole)

    def between(first: str, last: str) -> Column:
        a, z = F.instr(inside, first), F.length(inside) - F.instr(F.reverse(inside), last) + 1
        return F.when((a > 0) & F.contains(inside, F.lit(last)) & (z > a), F.substring(inside, a, z - a + 1))

    sound = [F.when((x != "") & is_json(x), x) for x in (whole, fenced, between("{", "}"), between("[", "]"))]
    return F.coalesce(*sound, text)


def fingerprint(*parts: Column, length: int = 12) -> Column:
    """The first hexadecimal digits of the parts' SHA-256."""
    return F.substring(F.sha2(F.concat(*parts), 256), 1, length)


def finish_kind(reason: Column, candidates: Column, text: Column) -> Column:
    """What to do with an answer: keep, keep_partial (cut, but with text), skip (blocked, or cut without text), retry."""
    some = F.coalesce(F.length(text), F.lit(0)) > 0
    return F.when(F.coalesce(candidates, F.lit(0)) < 1, "retry").when(reason == "RECITATION", "skip").when(reason == "MAX_TOKENS", F.when(some, "keep_partial").otherwise("skip")).when(some, "keep").otherwise("retry")


def ladder_separates(medians: DataFrame, value: str) -> DataFrame:
    """One row: levels measured, and whether their medians spread by a quarter of the least (of 1 at least); null below two."""
    seen = medians.filter(F.col(value).isNotNull()).agg(F.count(F.lit(1)).alias("levels"), F.min(value).alias("low"), F.max(value).alias("high"))
    spread = F.col("high") - F.col("low") >= 0.25 * F.greatest(F.lit(1.0), F.col("low"))
    return seen.select("levels", F.when(F.col("levels") >= 2, spread).alias("separates"))


def throughput(runs: DataFrame, by: list[str], seconds: str, ok: Column) -> DataFrame:
    """Per group: items, succeeded, success in percent, seconds an item, items an hour (nulls where no time passed)."""
    out = runs.groupBy(*by).agg(F.count(F.lit(1)).alias("items"), F.count_if(ok).alias("succeeded"), F.sum(seconds).alias("_s"))
    share = F.round(100.0 * F.col("succeeded") / F.col("items"), 6)
    return out.select(*by, "items", "succeeded", share.alias("success"), F.round(F.col("_s") / F.col("items"), 6).alias("seconds_each"), F.round(F.try_divide(3600.0 * F.col("items"), F.col("_s")), 6).alias("an_hour"))


def tidy_summary(text: Column) -> Column:
    """Without asterisks and outer white space; null where nothing is left."""
    return F.nullif(strip(F.replace(text, F.lit("*"), F.lit(""))), F.lit(""))


def label_or_null(label: Column, error: Column, failure: str) -> Column:
    """Null for rows with an error, the failure label and blank labels."""
    return F.when(error.isNull() & (label != failure), F.nullif(label, F.lit("")))


def filled(template: str, values: dict[str, Column]) -> Column:
    """A text template with {name} places filled from columns."""
    return reduce(lambda text, kv: F.replace(text, F.lit("{" + kv[0] + "}"), F.coalesce(kv[1].cast("string"), F.lit(""))), values.items(), F.lit(template))
