"""``spark.read.format("landing_files")``: the files of a folder tree as a Spark source.

``load(folder)`` with options ``recursive`` (default true) and ``glob`` (on file names,
case-sensitive, default all) gives ``path, dir, name, mtime, length``. Every file is
listed: empty ones, and those whose names start with ``_`` or ``.``; names are taken
literally, whatever characters they hold.

A partition is a folder, or several where there are more than ``PARTITIONS``. The driver
opens the upper levels, folder by folder, until there are that many; below, a task walks its
folders' whole trees, one folder at a time. So the driver holds folder names of the upper
levels and no file. ``PARTITIONS`` is an option, too (``partitions``), for trees with few,
uneven branches.

Filters on ``name`` (equality, membership, prefix, suffix, substring) and ``dir``
(equality, membership, prefix) are pushed into the walk: names are dropped before rows
are made, and a branch that can't hold a wanted ``dir`` is not opened.
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringContains,
                                    StringEndsWith, StringStartsWith)

FORMAT = "landing_files"
PARTITIONS = 64
SCHEMA = "path string, dir string, name string, mtime timestamp, length long"
_ARROW = pa.schema([("path", pa.string()), ("dir", pa.string()), ("name", pa.string()),
                    ("mtime", pa.timestamp("us", "UTC")), ("length", pa.int64())])
_ROWS = 10_000


class FolderNotFound(Exception):
    """The target folder does not exist or is not a folder (reconciliation status 3)."""


def file_system(uri: str):
    """``(filesystem, path in it)`` of a path or URI."""
    from pyarrow import fs as pafs
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + re.sub(r"^file:/*", "", uri)
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def absolute(folder: str) -> str:
    """The folder as Spark's listings write it (``file:/…`` or its own scheme)."""
    import os
    folder = folder.rstrip("/") or "/"
    if folder.startswith("file:"):
        return "file:/" + re.sub(r"^file:/*", "", folder)
    return folder if "://" in folder else "file:" + os.path.abspath(folder)


@dataclass
class Wanted:
    """Conditions on one column: all of them have to hold. Plain values, so that tasks get them."""
    column: str
    kind: str
    value: object

    def holds(self, text: str) -> bool:
        if self.kind == "in":
            return text in self.value
        return {"prefix": text.startswith, "suffix": text.endswith, "part": text.__contains__}[self.kind](self.value)

    def below(self, folder: str) -> bool:
        """Whether ``folder`` or a folder below it can have a ``dir`` that holds."""
        reach = folder.rstrip("/") + "/"
        if self.kind == "in":
            return any(v == folder or v.startswith(reach) for v in self.value)
        if self.kind == "prefix":
            return reach.startswith(self.value) or folder.startswith(self.value) or self.value.startswith(reach)
        return True


def pushed(filter: Filter) -> Wanted | None:
    """The condition that a Spark filter stands for; None if the source can't apply it."""
    column = filter.attribute[0] if len(filter.attribute) == 1 else None
    kinds = {StringStartsWith: "prefix", StringEndsWith: "suffix", StringContains: "part"}
    if column not in ("name", "dir"):
        return None
    if isinstance(filter, EqualTo) and isinstance(filter.value, str):
        return Wanted(column, "in", (filter.value,))
    if isinstance(filter, In) and all(isinstance(v, str) for v in filter.value):
        return Wanted(column, "in", tuple(filter.value))
    if type(filter) in kinds:
        return Wanted(column, kinds[type(filter)], filter.value)
    return None


@dataclass
class Branches(InputPartition):
    """Folders, each with or without all that is below it."""
    folders: list[tuple[str, bool]]


class LandingReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = absolute(options["path"])
        self.recursive = str(options.get("recursive", "true")).lower() == "true"
        self.partitions_wanted = int(options.get("partitions", PARTITIONS))
        self.glob = options.get("glob")
        self.wanted: list[Wanted] = []

    def partitions(self) -> list[Branches]:
        open_, closed = [self.root], []
        while self.recursive and open_ and len(open_) + len(closed) < self.partitions_wanted:
            folder = open_.pop(0)
            closed.append((folder, False))
            below = [f"{folder.rstrip('/')}/{x.base_name}" for x in _children(folder) if _is_dir(x)]
            open_ += [f for f in below if self._opens(f)]
        branches = closed + [(f, self.recursive) for f in open_]
        n = min(len(branches), self.partitions_wanted)
        return [Branches(branches[i::n]) for i in range(n)]

    def _opens(self, folder: str) -> bool:
        return all(w.below(folder) for w in self.wanted if w.column == "dir")

    def read(self, partition: Branches) -> Iterator[pa.RecordBatch]:
        matches = _matcher(self.glob)
        names = [w for w in self.wanted if w.column == "name"]
        dirs = [w for w in self.wanted if w.column == "dir"]
        todo, rows = list(partition.folders), []
        while todo:
            folder, whole = todo.pop()
            here = all(w.holds(folder) for w in dirs)
            for x in _children(folder):
                path = f"{folder.rstrip('/')}/{x.base_name}"
                if _is_dir(x):
                    if whole and self._opens(path):
                        todo.append((path, True))
                elif here and matches(x.base_name) and all(w.holds(x.base_name) for w in names):
                    rows.append({"path": path, "dir": folder, "name": x.base_name, "mtime": x.mtime, "length": x.size or 0})
            if len(rows) >= _ROWS:
                yield pa.RecordBatch.from_pylist(rows, _ARROW)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)


class PushingReader(LandingReader):
    """A reader that takes filters over from Spark."""

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            condition = pushed(f)
            if condition is None:
                yield f
            else:
                self.wanted.append(condition)


def _children(folder: str) -> list:
    from pyarrow import fs as pafs
    fs, at = file_system(folder)
    return fs.get_file_info(pafs.FileSelector(at, recursive=False))


def _is_dir(info) -> bool:
    from pyarrow import fs as pafs
    return info.type == pafs.FileType.Directory


def _matcher(glob: str | None) -> Callable[[str], object]:
    return re.compile(fnmatch.translate(glob)).match if glob else lambda name: True


class LandingFiles(DataSource):
    """The source behind ``format("landing_files")``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LandingReader:
        options = dict(self.options)
        return (PushingReader if str(options.get("pushdown", "true")).lower() == "true" else LandingReader)(options)


def listing(spark: SparkSession, folder: str, recursive: bool = True, glob: str | None = None,
            partitions: int = PARTITIONS, pushdown: bool = True) -> DataFrame:
    """``path, dir, name, mtime, length`` of the files of ``folder``, listed whenever it is read.

    Registers the source with the session and, for ``pushdown``, lets Spark push filters into
    Python sources (``spark.sql.python.filterPushdown.enabled``)."""
    from pyarrow import fs as pafs
    fs, at = file_system(absolute(folder))
    if fs.get_file_info(at).type != pafs.FileType.Directory:
        raise FolderNotFound(folder)
    if pushdown:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LandingFiles)
    reader = spark.read.format(FORMAT).option("recursive", str(recursive).lower()).option("partitions", partitions).option("pushdown", str(pushdown).lower())
    return (reader.option("glob", glob) if glob else reader).load(folder)
