"""Recorded listings: catalogue pages as files, read through a Python data source.

A recording holds pages set=<id>/page=<n>, each a JSON list of at most
``per_page`` records.  One partition reads one page, or a run of them where there
are more than ``TASKS``.  Filters on set_id and page choose the pages before any is opened; a listing ends at its first page that
is missing or not full, which the driver finds by doubling and bisection, so it
opens a handful of pages of a set, however long the listing.
"""

from __future__ import annotations

import json
import math
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from ..operators.documents import numbered

SCHEMA = "set_id long, page int, pos int, item_id long, raw string"
PER_PAGE = 100  # fixed value: records of a full page
#: fixed values: from so many pages on a partition reads a run of them, of so many at most
TASKS, RUN = 128, 500


@dataclass
class Page(InputPartition):
    set_id: int
    page: int
    files: list[str]
    then: list[Page] = field(default_factory=list)


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it; any store that Arrow knows by its scheme."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), re.sub("^file:", "", path))


def _records(store: fs.FileSystem, files: list[str]) -> list:
    out = []
    for name in files:
        with store.open_input_stream(name) as f:
            text = f.read().decode()
        for line in filter(str.strip, text.split("\n")):
            out += json.loads(line)
    return out


class _Reader(DataSourceReader):
    def __init__(self, path: str, per_page: int):
        self.path, self.per_page, self.wanted = path, per_page, {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality and membership of set_id and page choose pages; all else is left to Spark."""
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            name = getattr(f, "attribute", ())
            if values is None or name not in (("set_id",), ("page",)):
                yield f
                continue
            self.wanted[name[0]] = self.wanted.get(name[0], values) & values

    def partitions(self) -> list[InputPartition]:
        store, root = _store(self.path)
        pages: dict[int, dict[int, list[str]]] = {}
        sets = [(int(m[1]), d.path) for d in store.get_file_info(fs.FileSelector(root, recursive=False)) if (m := re.fullmatch(r"set=(\d+)", d.base_name))]
        for number, folder in sets:
            if number not in self.wanted.get("set_id", {number}):
                continue
            for info in store.get_file_info(fs.FileSelector(folder, recursive=True)):
                m = re.search(r"/page=(\d+)/[^/_.][^/]*$", info.path)
                if m and info.type == fs.FileType.File:
                    pages.setdefault(number, {}).setdefault(int(m[1]), []).append(info.path)
        out = []
        for number, found in sorted(pages.items()):
            last = self.last_page(store, found)
            out += [Page(number, p, sorted(found[p])) for p in range(1, last + 1) if p in self.wanted.get("page", {p})]
        run = min(RUN, math.ceil(len(out) / TASKS))
        return [Page(p.set_id, p.page, p.files, out[i + 1 : i + run]) for i, p in enumerate(out) if i % run == 0] if out else [Page(0, 0, [])]

    def last_page(self, store: fs.FileSystem, pages: dict[int, list[str]]) -> int:
        """The last page of a listing whose pages are full up to it."""
        full = lambda n: n in pages and len(_records(store, pages[n])) >= self.per_page
        low, high = 0, 1
        while full(high):
            low, high = high, 2 * high
        while high - low > 1:  # low is full, high is not
            middle = (low + high) // 2
            low, high = (middle, high) if full(middle) else (low, middle)
        return high if high in pages else low

    def read(self, partition: Page) -> Iterator[tuple]:
        store, _ = _store(self.path)
        for page in (partition, *partition.then):
            for pos, record in enumerate(_records(store, page.files)):
                own = record.get("o:id") if isinstance(record, dict) else None
                yield page.set_id, page.page, pos, own if isinstance(own, int) else None, json.dumps(record, ensure_ascii=False)


class RecordedListing(DataSource):
    """Format ``recorded_listing``; options path and per_page."""

    @classmethod
    def name(cls) -> str:
        return "recorded_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], int(self.options.get("per_page", PER_PAGE)))


def read_listing(spark: SparkSession, path: str, per_page: int = PER_PAGE) -> DataFrame:
    """set_id, page, pos, item_id, raw of a recording; turns filter pushdown of Python sources on in this session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RecordedListing)
    return spark.read.format("recorded_listing").option("path", path).option("per_page", per_page).load()


def record_pages(items: DataFrame, path: str, per_page: int = PER_PAGE) -> None:
    """Writes items (set_id, item_id, raw: a JSON object) as a recording, by item_id within a set; an item of two sets is in both.

    A page is a file, so there are very many: pages are dealt to all shuffle
    partitions, each task writes its own through Arrow's file system, and the
    folder gets its name when all are there.
    """
    placed = numbered(items.select("set_id", "item_id", "raw"), "set_id", ["item_id"])
    page = F.floor((F.col("place") - 1) / per_page).cast("int") + 1
    rows = F.array_sort(F.collect_list(F.struct("place", "raw")))
    text = F.concat(F.lit("["), F.array_join(F.transform(rows, lambda x: F.regexp_replace(x["raw"], "[\r\n]+", " ")), ","), F.lit("]"))
    dealt = placed.select(F.col("set_id").alias("set"), page.alias("page"), "place", "raw").repartition(int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")), "set", "page")
    pages = dealt.groupBy("set", "page").agg(text.alias("text"))
    store, root = _store(path)
    if store.get_file_info(root).type != fs.FileType.NotFound:
        raise FileExistsError(path)
    unnamed = f"{root.rstrip('/')}.{uuid.uuid4().hex}"

    def write(rows: Iterable) -> None:
        own, _ = _store(path)
        for r in rows:
            folder = f"{unnamed}/set={r['set']}/page={r['page']}"
            own.create_dir(folder)
            name = uuid.uuid4().hex  # a task may run twice: the page is whole under its name, whoever came last
            with own.open_output_stream(f"{folder}/_{name}") as f:
                f.write(r["text"].encode() + b"\n")
            own.move(f"{folder}/_{name}", f"{folder}/part-0.txt")

    store.create_dir(unnamed)
    try:
        pages.foreachPartition(write)
        store.move(unnamed, root)
    except BaseException:
        store.delete_dir(unnamed)
        raise
