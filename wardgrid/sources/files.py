"""Files of a lake, listed, opened and removed by tasks instead of by the driver."""

from __future__ import annotations

import glob
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from .scratch import write_through

#: Entries one task lists before it hands the folders it has not seen to other tasks.
HANDFUL = 10_000
#: Schemes that pyarrow names differently.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}
_FOUND = "path string, folder boolean, size long, modified timestamp"


def filesystem(path: str) -> tuple[fs.FileSystem, str, str]:
    """The file system, the path inside it, and what stands before that in the path's full spelling."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path) if parts.scheme else path, "file:"
    system, inside = fs.FileSystem.from_uri(parts._replace(scheme=_SCHEMES.get(parts.scheme, parts.scheme)).geturl())
    return system, inside, f"{parts.scheme}://" + ("" if inside.startswith(parts.netloc) else parts.netloc)


def can_list(path: str) -> bool:
    """Whether Python reaches such paths."""
    try:
        system, inside, _ = filesystem(path)
        system.get_file_info(inside)
    except (OSError, ValueError, NotImplementedError):
        return False
    return True


def _full(prefix: str, inside: str) -> str:
    return prefix + (quote(inside, safe="/=:+,;@&$!'()*~") if prefix == "file:" else inside)


def _list(path: str) -> Iterator[tuple]:
    system, inside, prefix = filesystem(path)
    row = lambda i: (_full(prefix, i.path), i.type == fs.FileType.Directory, i.size, i.mtime)
    first = system.get_file_info(inside)
    if first.type == fs.FileType.File:
        yield row(first)
        return
    folders, seen = [inside] if first.type == fs.FileType.Directory else [], 0
    while folders and seen < HANDFUL:
        for entry in system.get_file_info(fs.FileSelector(folders.pop())):
            seen += 1
            if entry.base_name.startswith(("_", ".")):
                continue  # not data
            if entry.type == fs.FileType.Directory:
                folders.append(entry.path)
            else:
                yield row(entry)
    for folder in folders:
        yield _full(prefix, folder), True, None, None


def _list_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.bool_(), pa.int64(), pa.timestamp("us", "UTC")]
    names = ["path", "folder", "size", "modified"]
    for batch in batches:
        for path in batch["path"].to_pylist():
            rows = list(_list(path))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def list_files(spark: SparkSession, roots: list[str]) -> DataFrame:
    """path, size, modified of all files below ``roots`` (names that begin with ``_`` or ``.`` aside).

    A task lists folder by folder up to ``HANDFUL`` entries; folders left are dealt to other
    tasks in a further round, so that rounds follow the logarithm of the number of files.
    """
    level = spark.createDataFrame([(r,) for r in roots], "path string")
    rounds = []
    while True:
        found = write_through(level.repartition("path").mapInArrow(_list_all, _FOUND), "listing")
        rounds.append(found.where("not folder").drop("folder"))
        level = found.where("folder").select("path")
        if level.isEmpty():
            break
    files = rounds[0]
    for more in rounds[1:]:
        files = files.unionByName(more)
    return files


def expanded(paths: list[str]) -> list[str] | None:
    """Local patterns as the paths they match; null where a pattern stands elsewhere."""
    found: list[str] = []
    for path in paths:
        if not any(c in path for c in "*?[{"):
            found.append(path)
        elif urlsplit(path).scheme in ("", "file") and "{" not in path:
            found += glob.glob(filesystem(path)[1])
        else:
            return None
    return found


def _stat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, found = batch["path"].to_pylist(), []
        for path in paths:
            system, inside, _ = filesystem(path)
            found.append(system.get_file_info(inside))
        there = [i.type == fs.FileType.File for i in found]
        sizes = pa.array([i.size if t else None for i, t in zip(found, there, strict=True)], pa.int64())
        times = pa.array([i.mtime if t else None for i, t in zip(found, there, strict=True)], pa.timestamp("us", "UTC"))
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), sizes, times], names=["path", "size", "modified"])


def stat(paths: DataFrame) -> DataFrame:
    """path, size, modified of each file of ``paths`` as it is now; null where it is gone."""
    return paths.select("path").mapInArrow(_stat, "path string, size long, modified timestamp")


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, removed = batch["path"].to_pylist(), []
        for path in paths:
            system, inside, _ = filesystem(path)
            kind = system.get_file_info(inside).type
            if kind == fs.FileType.Directory:
                system.delete_dir(inside)
            elif kind == fs.FileType.File:
                system.delete_file(inside)
            removed.append(kind != fs.FileType.NotFound)
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(removed, pa.bool_())], names=["path", "removed"])


def remove(paths: DataFrame) -> DataFrame:
    """Remove the files and folders of ``paths`` (path), written so that it happens once; ``removed`` is false for what was gone already."""
    return write_through(paths.select("path").mapInArrow(_remove, "path string, removed boolean"), "removed")
