"""Registering queries: an input that Spark and DuckDB both derive, an operator, and its SQL twin."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Runs SQL in which {table} stands for a table of the folder; other braces of the SQL must be written chr(123) and chr(125)."""
    names = set(re.findall(r"\{(\w+)\}", sql))
    if unknown := [n for n in names if not re.fullmatch("[a-z_]+", n)]:
        raise ValueError(f"not names of tables: {unknown}")
    return spark.sql(sql, **{n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names})


def duck(sql: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def query(name: str, oracle: str | None = None, **inputs: str):
    """Registers operator(inputs as DataFrames by keyword); the oracle's CTEs are the inputs by name."""

    def put(operator: Callable[..., DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return operator(**{k: derive(spark, sf_dir, v) for k, v in inputs.items()})

        QUERIES[name] = run
        if oracle is not None:
            ctes = ", ".join(f"{k} AS ({duck(v)})" for k, v in inputs.items())
            ORACLES[name] = f"WITH {ctes}{',' if oracle.lstrip().startswith('+') else ''} {oracle.lstrip().lstrip('+')}"
        return operator

    return put
