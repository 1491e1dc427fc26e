"""Listings that no single task or frame has to hold.

A folder with more than ``range_names`` entries is cut into ranges of names: its names are
read once, a bounded random sample of them gives the bounds, and each range is listed in a
task of its own, a page of entries at a time.  ``walk_objects`` descends a tree level by level;
``ObjectListing`` is the same as a Spark data source, for batches and streams.
"""

from __future__ import annotations

import itertools
import random
import sys
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..session import cut_lineage
from .pyfs import folder_entries, open_filesystem

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LISTING_SCHEMA = "path string, is_file boolean, length long, modification_time timestamp"
PAGE = 1000
RANGE_NAMES = 20_000
SAMPLE = 4096
_ENTRY = pa.schema(
    [("path", pa.string()), ("is_file", pa.bool_()), ("length", pa.int64()), ("modification_time", pa.timestamp("us", "UTC"))]
)


def name_bounds(names: Iterator[str], range_names: int = RANGE_NAMES, seed: str = "") -> list[str]:
    """Ascending names that cut ``names`` into ranges of about ``range_names``, from a uniform sample of
    ``SAMPLE`` of them; memory does not grow with their number."""
    draws, sample, count = random.Random(seed), [], 0
    for name in names:
        count += 1
        if len(sample) < SAMPLE:
            sample.append(name)
        elif (place := draws.randrange(count)) < SAMPLE:
            sample[place] = name
    sample.sort()
    ranges = min(-(-count // range_names), len(sample))
    return sorted({sample[k * len(sample) // ranges] for k in range(1, ranges)})


def within(name: str, low: str | None, high: str | None) -> bool:
    return (low is None or name >= low) and (high is None or name < high)


def _located(folder: str):
    """(filesystem, inner path, what comes before it in the folder's URI)."""
    filesystem, inner = open_filesystem(folder)
    return filesystem, inner, folder[: len(folder) - len(inner)] if folder.endswith(inner) else ""


def _pages(entries: Iterator[tuple], size: int) -> Iterator[pa.RecordBatch]:
    while page := list(itertools.islice(entries, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*page), _ENTRY)], schema=_ENTRY)


def list_range(folder: str, low: str | None = None, high: str | None = None) -> Iterator[tuple]:
    """(path, is_file, length, modification_time) of a folder's entries with low <= name < high."""
    filesystem, inner, before = _located(folder)
    for name, details in folder_entries(filesystem, inner):
        if within(name, low, high):
            yield (f"{before}{inner.rstrip('/')}/{name}", *details())


def _first_pass(range_names: int, page: int):
    """Entries of small folders, and (folder, low, high) of the ranges of large ones."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                some = list(itertools.islice(list_range(folder), range_names + 1))
                if len(some) <= range_names:
                    for rows in _pages(iter(some), page):
                        extra = [pa.nulls(rows.num_rows, pa.string()) for _ in range(3)]
                        yield pa.RecordBatch.from_arrays([*rows.columns, *extra], names=_FIRST)
                    continue
                del some
                filesystem, inner, _ = _located(folder)
                bounds = name_bounds((name for name, _ in folder_entries(filesystem, inner)), range_names, folder)
                lows, highs = [None, *bounds], [*bounds, None]
                n = len(lows)
                made = [pa.nulls(n, f.type) for f in _ENTRY] + [pa.array(v, pa.string()) for v in ([folder] * n, lows, highs)]
                yield pa.RecordBatch.from_arrays(made, names=_FIRST)

    return work


_FIRST = [*_ENTRY.names, "folder", "low", "high"]


def _second_pass(page: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                yield from _pages(list_range(folder, low, high), page)

    return work


def walk_objects(spark: SparkSession, root: str, range_names: int = RANGE_NAMES, page: int = PAGE) -> DataFrame:
    """All files and folders below ``root``, listed level by level in tasks.

    Folders of a level are dealt out, large ones in ranges.  Only emptiness checks reach the
    driver.  Unlike ``objects.list_objects`` it sees hidden folders such as transaction logs.
    Objects that appear or go while it runs may be missed or listed; every other one is
    listed once.
    """
    width = spark.sparkContext.defaultParallelism
    frontier = spark.createDataFrame([(root.rstrip("/") or "/",)], "path string")
    found = []
    while True:
        level = cut_lineage(frontier.mapInArrow(_first_pass(range_names, page), f"{LISTING_SCHEMA}, folder string, low string, high string"))
        listed = [level.filter("folder IS NULL").select(*_ENTRY.names)]
        ranges = level.filter("folder IS NOT NULL").select("folder", "low", "high")
        if not ranges.isEmpty():
            listed.append(cut_lineage(ranges.repartition(width).mapInArrow(_second_pass(page), LISTING_SCHEMA)))
        found += listed
        folders = listed[0] if len(listed) == 1 else listed[0].unionByName(listed[1])
        folders = folders.filter(~F.col("is_file")).select("path")
        if folders.isEmpty():
            break
        # Round-robin so that folders beside each other are listed by different tasks.
        frontier = folders.repartition(width)
    everything = found[0]
    for level in found[1:]:
        everything = everything.unionByName(level)
    return everything


class NameRange(InputPartition):
    """The tree below the entries of ``root`` with low <= name < high, changed in [since, until) (microseconds)."""

    def __init__(self, root: str, low: str | None, high: str | None, since: int | None = None, until: int | None = None):
        super().__init__((root, low, high, since, until))
        self.root, self.low, self.high, self.since, self.until = root, low, high, since, until


class _Reading:
    """What batch and stream readers share: partitions by name ranges, files of a partition in pages."""

    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/") or "/"
        self.range_names = int(options.get("rangenames", RANGE_NAMES))
        self.page = int(options.get("page", PAGE))

    def ranges(self, since: int | None = None, until: int | None = None) -> list[NameRange]:
        filesystem, inner, _ = _located(self.root)
        bounds = name_bounds((name for name, _ in folder_entries(filesystem, inner)), self.range_names, self.root)
        return [NameRange(self.root, a, b, since, until) for a, b in zip([None, *bounds], [*bounds, None])]

    def read(self, partition: NameRange) -> Iterator[pa.RecordBatch]:
        def files() -> Iterator[tuple]:
            todo = [(partition.root, partition.low, partition.high)]
            while todo:
                for entry in list_range(*todo.pop()):
                    if not entry[1]:
                        todo.append((entry[0], None, None))
                    elif partition.since is None or partition.since <= int(entry[3].timestamp() * 1_000_000) < partition.until:
                        yield entry

        return _pages(files(), self.page)


class _BatchReader(_Reading, DataSourceReader):
    def partitions(self) -> list[NameRange]:
        return self.ranges()


class _StreamReader(_Reading, DataSourceStreamReader):
    """An offset is a time: all objects changed before it have been delivered.

    It lags ``settle`` seconds behind the clock, within which a store must show an object.
    An object that is written again later arrives again.
    """

    def __init__(self, options: dict):
        super().__init__(options)
        self.settle = float(options.get("settle", 5))

    def initialOffset(self) -> dict:
        return {"until": 0}

    def latestOffset(self) -> dict:
        return {"until": int((time.time() - self.settle) * 1_000_000)}

    def partitions(self, start: dict, end: dict) -> list[NameRange]:
        return self.ranges(start["until"], end["until"])

    def commit(self, end: dict) -> None:
        pass


class ObjectListing(DataSource):
    """``spark.read.format("objects")`` and ``spark.readStream.format("objects")``: the files below ``path``.

    Options: ``path``, ``rangeNames`` (entries of the top folder in a task), ``page``, ``settle``
    (stream: seconds by which it lags the clock).  Register with ``spark.dataSource.register``.
    """

    @classmethod
    def name(cls) -> str:
        return "objects"

    def schema(self) -> str:
        return LISTING_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader({k.lower(): v for k, v in self.options.items()})

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader({k.lower(): v for k, v in self.options.items()})
