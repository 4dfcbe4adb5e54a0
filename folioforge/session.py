"""A SparkSession with the settings the engine is tested under."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """UTC, adaptive execution and Arrow on; everything else as the cluster says."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
    }
    spark = SparkSession.builder.master(master).appName("folioforge").config(map={**settings, **conf}).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share (spark.checkpoint.dir); a temporary one only on one machine, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.gettempdir()
    return f"{folder.rstrip('/')}/folioforge/{name}-{uuid.uuid4().hex}"
