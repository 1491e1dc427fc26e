"""Transaction-log discovery and reading.

A log is a ``_delta_log`` folder of JSON commits ``<20 digits>.json`` and optional
parquet checkpoints.  The files are found in an object listing and read in tasks, so no
list of log files passes through the driver.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths
from ..functions.text import allowed, with_once
from ..operators.joins import by_key
from ..session import cut_lineage
from .pyfs import open_filesystem

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COMMIT_FILE = r"^(.*)/_delta_log/(\d{20})\.json$"
# one file, part p of n, or a named file that may point to side files
CHECKPOINT_FILE = r"^(.*)/_delta_log/(\d{20})\.checkpoint(?:\.(\d+)\.(\d+)|\.([0-9a-f-]{36}))?\.(parquet|json)$"
LOG_FILE = r"^(.*)/_delta_log/\d{20}\.(?:json|checkpoint(?:\.\d+\.\d+|\.[0-9a-f-]{36})?\.(?:parquet|json))$"
SIDE_FOLDER = "_sidecars"
LINES = 10_000  # lines of a commit in one batch
SPREAD = 16  # parts in which a folder meets the roots below it

VECTOR = "struct<storageType:string,pathOrInlineDv:string,offset:int,cardinality:bigint>"
ADD = f"struct<path:string,size:bigint,modificationTime:bigint,stats:string,deletionVector:{VECTOR}>"
REMOVE = f"struct<path:string,deletionTimestamp:bigint,deletionVector:{VECTOR}>"
META = (
    "struct<id:string,name:string,description:string,partitionColumns:array<string>,"
    "configuration:map<string,string>,createdTime:bigint,schemaString:string>"
)
ACTION = f"struct<add:{ADD},remove:{REMOVE},metaData:{META}>"


def log_roots(objects: DataFrame) -> DataFrame:
    """Distinct table roots that have a commit or checkpoint in the listing."""
    path = F.col("path")
    is_log = F.contains(path, F.lit("/_delta_log/")) & path.rlike(LOG_FILE)
    return objects.filter(is_log).select(F.regexp_extract(path, LOG_FILE, 1).alias("root")).distinct()


def discover_tables(
    objects: DataFrame, start: str | None = None, include: list[str] | None = None, exclude: list[str] | None = None
) -> DataFrame:
    """Table roots, searched top-down from ``start``.

    A root below another root is part of that table, not a table.  The folder filter is
    applied to every sub-folder path on the way down, never to ``start`` itself.

    A folder that many roots share is a hot key, so it meets them in ``SPREAD`` parts: the
    folders above roots are made unique first, the few that are tables themselves are
    repeated for every part, and a root asks only in its own.
    """
    roots = log_roots(objects)
    root = F.col("root")
    above, is_allowed = paths.prefixes(root), lambda f: allowed(f, include, exclude)
    if start is not None:
        top = start.rstrip("/")
        roots = roots.filter((root == top) | F.startswith(root, F.lit(top + "/")))
        above = F.filter(above, lambda f: F.length(f) >= len(top))
        is_allowed = lambda f: allowed(f, include, exclude) | (F.length(f) == len(top))
    # listed and tested once: three joins read it
    found = cut_lineage(roots.filter(F.forall(F.array_append(above, root), is_allowed)))
    way = found.select("root", F.explode(above).alias("folder"))
    tables = way.select("folder").distinct().join(by_key(found.select(root.alias("folder"))), "folder", "left_semi")
    parts = tables.select("folder", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("part"))
    asked = way.withColumn("part", F.pmod(F.hash("root"), F.lit(SPREAD)))
    nested = asked.join(by_key(parts), ["folder", "part"], "left_semi").select("root").distinct()
    return found.join(by_key(nested), "root", "left_anti")


def commit_versions(objects: DataFrame) -> DataFrame:
    """(path, root, version) of the JSON commits in the listing."""
    path = F.col("path")
    return objects.filter(path.rlike(COMMIT_FILE)).select(
        path,
        F.regexp_extract(path, COMMIT_FILE, 1).alias("root"),
        F.regexp_extract(path, COMMIT_FILE, 2).cast("bigint").alias("version"),
    )


def commit_lines(objects: DataFrame, saved: DataFrame | None = None) -> DataFrame:
    """(root, version, value): the lines of the JSON commits in the listing, read in pieces.

    ``saved`` (root, saved_version) leaves out, before any file is opened, the commits a
    checkpoint covers.
    """

    def read_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io

        def piece(root: str, version: int, lines: list[str]) -> pa.RecordBatch:
            return pa.record_batch(
                [pa.array([root] * len(lines), pa.string()), pa.array([version] * len(lines), pa.int64()),
                 pa.array(lines, pa.string())],
                names=["root", "version", "value"],
            )

        for batch in batches:
            for path, root, version in zip(*[c.to_pylist() for c in batch.columns]):
                filesystem, inner = open_filesystem(path)
                lines: list[str] = []
                with filesystem.open_input_stream(inner) as stream, io.TextIOWrapper(stream, "utf-8", newline="\n") as text:
                    for line in text:
                        if line.strip():
                            lines.append(line.rstrip("\r\n"))
                        if len(lines) >= LINES:
                            yield piece(root, version, lines)
                            lines = []
                yield piece(root, version, lines)

    commits = commit_versions(objects)
    if saved is not None:
        commits = commits.join(saved, "root", "left").filter(
            F.col("saved_version").isNull() | (F.col("version") > F.col("saved_version"))
        )
    return commits.select("path", "root", "version").mapInArrow(read_lines, "root string, version long, value string")


def parse_actions(lines: DataFrame) -> DataFrame:
    """Typed actions from (root, version, value) lines."""
    parsed = with_once(lines, "a", F.from_json("value", ACTION))
    return parsed.select("root", "version", "a.add", "a.remove", "a.metaData")


def checkpoint_files(objects: DataFrame) -> DataFrame:
    """(path, root, version) of the newest complete checkpoint of every table.

    A checkpoint in parts counts when all parts are listed; otherwise an older one is taken.
    """
    path = F.col("path")
    part = lambda group: F.nullif(F.regexp_extract(path, CHECKPOINT_FILE, group), F.lit(""))
    files = objects.filter(path.rlike(CHECKPOINT_FILE)).select(
        path,
        part(1).alias("root"),
        part(2).cast("bigint").alias("version"),
        part(3).cast("int").alias("part"),
        F.coalesce(part(4).cast("int"), F.lit(1)).alias("parts"),
        F.coalesce(part(5), F.when(part(4).isNotNull(), F.lit("parts")), F.lit("")).alias("kind"),
    )
    made = ["root", "version", "parts", "kind"]
    complete = files.groupBy(*made).agg(F.count_distinct(F.coalesce("part", F.lit(1))).alias("have")).filter("have = parts")
    newest = complete.groupBy("root").agg(F.max(F.struct("version", "parts", "kind")).alias("m")).select("root", "m.*")
    return files.join(newest, made, "left_semi").select("path", "root", "version")


def _json_pieces(path: str) -> Iterator[list[dict]]:
    """The actions of a JSON file, ``LINES`` of them at a time."""
    import io
    import json

    filesystem, inner = open_filesystem(path)
    actions: list[dict] = []
    with filesystem.open_input_stream(inner) as stream, io.TextIOWrapper(stream, "utf-8", newline="\n") as text:
        for line in text:
            if line.strip():
                actions.append(json.loads(line))
            if len(actions) >= LINES:
                yield actions
                actions = []
    yield actions


def side_files(files: DataFrame) -> DataFrame:
    """(path, root, version) of the side files that checkpoint files name; nothing else of these is read."""

    def read_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        def names_in(path: str) -> Iterator[list[str]]:
            if path.endswith(".json"):
                for actions in _json_pieces(path):
                    yield [a["sidecar"]["path"] for a in actions if a.get("sidecar")]
                return
            filesystem, inner = open_filesystem(path)
            with filesystem.open_input_file(inner) as handle:
                parquet = pq.ParquetFile(handle)
                if "sidecar" in parquet.schema_arrow.names:
                    for rows in parquet.iter_batches(columns=["sidecar"]):
                        yield [s["path"] for s in rows.column("sidecar").to_pylist() if s]

        for batch in batches:
            for path, root, version in zip(*[c.to_pylist() for c in batch.columns]):
                folder = path.rsplit("/", 1)[0]
                for names in names_in(path):
                    found = [name if "/" in name else f"{folder}/{SIDE_FOLDER}/{name}" for name in names]
                    yield pa.record_batch(
                        [pa.array(found, pa.string()), pa.array([root] * len(found), pa.string()), pa.array([version] * len(found), pa.int64())],
                        names=["path", "root", "version"],
                    )

    return files.select("path", "root", "version").mapInArrow(read_names, "path string, root string, version long").distinct()


def checkpoint_actions(files: DataFrame) -> DataFrame:
    """Actions of the checkpoint files and of the side files they name.

    Names of side files are read first, as rows; then all files are dealt out, so that side
    files of one checkpoint are read by many tasks.  Every file is streamed: Parquet in
    Arrow batches, JSON in pieces.
    """

    def read_checkpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        text, whole = pa.string(), pa.int64()
        vector = pa.struct([("storageType", text), ("pathOrInlineDv", text), ("offset", pa.int32()), ("cardinality", whole)])
        wanted = {
            "add": pa.struct([("path", text), ("size", whole), ("modificationTime", whole), ("stats", text), ("deletionVector", vector)]),
            "remove": pa.struct([("path", text), ("deletionTimestamp", whole), ("deletionVector", vector)]),
            "metaData": pa.struct(
                [("id", text), ("name", text), ("description", text), ("partitionColumns", pa.list_(text)),
                 ("configuration", pa.map_(text, text)), ("createdTime", whole), ("schemaString", text)]
            ),
        }

        def shaped(column: pa.Array, target: pa.StructType) -> pa.Array:
            have = {f.name for f in column.type}
            children = [
                pa.nulls(len(column), f.type) if f.name not in have
                else shaped(column.field(f.name), f.type) if pa.types.is_struct(f.type)
                else column.field(f.name).cast(f.type)
                for f in target
            ]
            return pa.StructArray.from_arrays(children, fields=list(target), mask=column.is_null())

        def rows_of(root: str, version: int, n: int, columns: list[pa.Array]) -> pa.RecordBatch:
            return pa.record_batch(
                [pa.array([root] * n, text), pa.array([version] * n, whole), *columns], names=["root", "version", *wanted]
            )

        def parquet_rows(path: str, root: str, version: int) -> Iterator[pa.RecordBatch]:
            filesystem, inner = open_filesystem(path)
            with filesystem.open_input_file(inner) as handle:
                parquet = pq.ParquetFile(handle)
                present = [n for n in wanted if n in parquet.schema_arrow.names]
                for rows in parquet.iter_batches(columns=present):
                    n = rows.num_rows
                    columns = [shaped(rows.column(k), t) if k in present else pa.nulls(n, t) for k, t in wanted.items()]
                    yield rows_of(root, version, n, columns)

        def json_rows(path: str, root: str, version: int) -> Iterator[pa.RecordBatch]:
            for actions in _json_pieces(path):
                for a in actions:
                    if a.get("metaData"):
                        a["metaData"]["configuration"] = list((a["metaData"].get("configuration") or {}).items())
                columns = [pa.array([a.get(k) for a in actions], type=t) for k, t in wanted.items()]
                yield rows_of(root, version, len(actions), columns)

        for batch in batches:
            for path, root, version in zip(*[c.to_pylist() for c in batch.columns]):
                yield from (json_rows if path.endswith(".json") else parquet_rows)(path, root, version)

    every = files.select("path", "root", "version").unionByName(side_files(files))
    dealt = every.repartition(every.sparkSession.sparkContext.defaultParallelism)
    return dealt.mapInArrow(read_checkpoints, f"root string, version long, add {ADD}, remove {REMOVE}, metaData {META}")


def read_actions(objects: DataFrame) -> DataFrame:
    """Newest complete checkpoint of each table plus the commits after it; no other file is opened."""
    files = checkpoint_files(objects)
    saved = files.groupBy("root").agg(F.max("version").alias("saved_version"))
    return checkpoint_actions(files).unionByName(parse_actions(commit_lines(objects, saved)))


def record_count(stats: Column) -> Column:
    """``numRecords`` of a file's statistics JSON; null when absent."""
    return F.get_json_object(stats, "$.numRecords").cast("bigint")
