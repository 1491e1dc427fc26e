"""Opening object paths inside Python tasks (footer and log scans)."""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

from pyspark import cloudpickle

# Ship these helpers inside the task closure: executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def open_filesystem(path: str):
    """(filesystem, path inside it) for a Hadoop-style URI or a plain local path."""
    from pyarrow import fs

    local = re.match(r"^file:/*(/.*)$", path)
    if local:
        return fs.LocalFileSystem(), local.group(1)
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


def folder_entries(filesystem, folder: str) -> Iterator[tuple[str, Callable[[], tuple]]]:
    """(name, details) of a folder's entries in no order; ``details()`` gives (is_file, length or None, time).

    A local folder is read as it goes and an entry's details only when asked for; other
    stores list the folder in their own pages, whose entries come with details.
    """
    from pyarrow import fs

    if isinstance(filesystem, fs.LocalFileSystem):
        with os.scandir(folder) as entries:
            for entry in entries:
                yield entry.name, lambda entry=entry: _local_details(entry)
        return
    for info in filesystem.get_file_info(fs.FileSelector(folder)):
        is_file = info.type == fs.FileType.File
        yield info.base_name, lambda info=info, is_file=is_file: (is_file, info.size if is_file else None, info.mtime)


def _local_details(entry: os.DirEntry) -> tuple:
    facts = entry.stat()
    is_file = not entry.is_dir()
    when = datetime.fromtimestamp(facts.st_mtime_ns // 1000 / 1_000_000, timezone.utc)
    return is_file, facts.st_size if is_file else None, when
