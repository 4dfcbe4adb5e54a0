"""Tables kept as versions: every write is a folder of its own, and a pointer file names the current one.

The pointer is replaced in one operation of the file system (a rename that
overwrites), so a reader resolves either the old version or the new one and
never a missing path; a failed write leaves the pointer as it was.  Versions
that a slow reader may still hold stay until ``keep`` newer ones are there.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"


class _Folder:
    """What is needed of a Hadoop file system, for one folder of a table."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark.sparkContext._jvm, path.rstrip("/")
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.at("").getFileSystem(self.conf)
        self.local = self.fs.getUri().getScheme() == "file"

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _own(self, name: str) -> str:
        """The path on this machine."""
        return self.at(name).toUri().getPath()

    def read(self, name: str) -> str | None:
        if self.local:
            try:
                with open(self._own(name), encoding="utf-8") as f:
                    return f.read()
            except FileNotFoundError:
                return None
        if not self.fs.exists(self.at(name)):
            return None
        stream = self.fs.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Writes a file beside and renames it over name, in one operation."""
        fresh = self.at(f"_{uuid.uuid4().hex}")
        if self.local:  # without checksum files, which would be replaced a moment apart from their files
            os.makedirs(self._own(""), exist_ok=True)
            with open(fresh.toUri().getPath(), "w", encoding="utf-8") as f:
                f.write(text)
            os.replace(fresh.toUri().getPath(), self._own(name))
            return
        stream = self.fs.create(fresh, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        over = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
        kinds = self.jvm.java.lang.reflect.Array.newInstance(over.getClass(), 1)
        kinds[0] = over
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf).rename(fresh, self.at(name), kinds)

    def versions(self) -> list[str]:
        """Folders of versions, the oldest first."""
        found = [s.getPath().getName() for s in self.fs.listStatus(self.at("")) if s.isDirectory()]
        return sorted(v for v in found if v.startswith("v"))


def commit(rows: DataFrame, path: str, keep: int = 2, fmt: str = "parquet") -> str:
    """Makes rows the table at path, and returns the version's name; rows may come from the table itself.

    One writer at a time: of two the one that replaces the pointer last wins
    whole.  Of the versions before it ``keep`` stay.
    """
    folder = _Folder(rows.sparkSession, path)
    now = folder.read(POINTER)
    number = int(now[1:9]) + 1 if now else 0
    name = f"v{number:08d}-{uuid.uuid4().hex[:8]}"
    rows.write.format(fmt).save(f"{folder.path}/{name}")
    folder.replace(POINTER, name)
    for old in [v for v in folder.versions() if int(v[1:9]) < number - keep]:
        folder.fs.delete(folder.at(old), True)
    return name


def exists(spark: SparkSession, path: str) -> bool:
    return _Folder(spark, path).read(POINTER) is not None


def current(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """The table's current version, fixed now; a table never written is empty if a schema is given, else it raises."""
    folder = _Folder(spark, path)
    name = folder.read(POINTER)
    if name is None:
        if schema is None:
            raise FileNotFoundError(f"no version at {path}")
        return spark.createDataFrame([], schema)
    read = spark.read.format(fmt)
    return (read.schema(schema) if schema else read).load(f"{folder.path}/{name}")
