"""Tables whose days are replaced all at once or not at all.

A write goes to a folder of its own, ``_data/version=<id>/<day column>=<day>``, and becomes
visible by one small log entry, ``_log/<number>.json``, which names the version that each
day is read from. Entries are renamed into place and never overwritten. So

* a failing write leaves no entry, and every day as it was;
* a reader resolves one entry and reads the files it names, which later writes do not touch;
* of two writers one gets the next number; the other takes the new entry as its base, and is
  refused if that replaced one of its days;
* a requested day without rows just leaves the entry, without a job of its own.

An entry has one item per day. Folders that no recent entry names stay until ``remove_unused``.
A table of plain day folders is read as it is; its first entry takes them over.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..errors import PartitionError
from .files import remove

_DIGITS = 12
#: Rounds in which another writer may come first.
TRIES = 20


@dataclass(frozen=True)
class Entry:
    number: int
    column: str
    days: dict[str, str]  # day -> version; a plain day folder has none


class _Folder:
    """The few file operations a log needs, by the cluster's own file system."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._path, self._gateway = jvm.org.apache.hadoop.fs.Path, spark.sparkContext._gateway
        self.root, configuration = path.rstrip("/"), spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._path(path).getFileSystem(configuration)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), configuration)
        self._rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        self._streams = jvm.org.apache.commons.io.IOUtils

    def names(self, folder: str) -> list[str]:
        path = self._path(f"{self.root}/{folder}")
        return [s.getPath().getName() for s in self._files.listStatus(path)] if self._files.exists(path) else []

    def read(self, name: str) -> str:
        stream = self._files.open(self._path(f"{self.root}/{name}"))
        try:
            return self._streams.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> bool:
        """Whole or not at all; false if the name is taken."""
        aside = f"{self.root}/_log/.{uuid.uuid4().hex}"
        stream = self._files.create(self._path(aside))
        stream.write(text.encode())
        stream.close()
        options = self._gateway.new_array(self._rename, 1)
        options[0] = self._rename.NONE
        try:
            self._context.rename(self._path(aside), self._path(f"{self.root}/{name}"), options)
        except Py4JJavaError as error:
            self._files.delete(self._path(aside), False)
            if "FileAlreadyExistsException" in str(error.java_exception):
                return False
            raise
        return True

    def delete(self, folder: str) -> None:
        self._files.delete(self._path(f"{self.root}/{folder}"), True)


def _entries(folder: _Folder) -> list[int]:
    return sorted(int(n[:_DIGITS]) for n in folder.names("_log") if n.endswith(".json") and not n.startswith("."))


def _entry(folder: _Folder, number: int) -> Entry:
    held = json.loads(folder.read(f"_log/{number:0{_DIGITS}}.json"))
    return Entry(number, held["column"], held["days"])


def current(spark: SparkSession, table: str, column: str) -> Entry:
    """The newest entry; number 0 with the plain day folders, if any, where nothing was replaced yet."""
    folder = _Folder(spark, table)
    numbers = _entries(folder)
    if numbers:
        return _entry(folder, numbers[-1])
    return Entry(0, column, {n.split("=", 1)[1]: "" for n in folder.names("") if n.startswith(f"{column}=")})


def read(spark: SparkSession, table: str, column: str, schema: T.StructType | None = None, entry: Entry | None = None) -> DataFrame:
    """The table as the newest entry (or ``entry``) has it; later writes do not change what is read."""
    entry, root = entry or current(spark, table, column), table.rstrip("/")
    by_base: dict[str, list[str]] = {}
    for day, version in sorted(entry.days.items()):
        base = f"{root}/_data" if version else root
        by_base.setdefault(base, []).append(f"{base}/version={version}/{column}={day}" if version else f"{base}/{column}={day}")
    if not by_base:
        if schema is None:
            raise ValueError(f"{table} has no days; give a schema to read it")
        return spark.createDataFrame([], schema)
    found = None
    for base, folders in by_base.items():
        reader = spark.read if schema is None else spark.read.schema(schema)
        rows = reader.option("basePath", base).parquet(*folders).drop("version")
        found = rows if found is None else found.unionByName(rows)
    return found if schema is None else found.select(*schema.names)


def days_of(spark: SparkSession, table: str, column: str) -> DataFrame:
    """The days that the table has."""
    days = current(spark, table, column).days
    return spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], f"{column} date")


def replace_days(df: DataFrame, table: str, column: str, days: DataFrame) -> Entry:
    """Replace the days of ``days`` (in ``column``) by the rows of ``df``; without rows a day is emptied.

    One job writes all days. Rows of a day that was not requested abort, and nothing is replaced.
    """
    spark = df.sparkSession
    requested = {str(r[0]) for r in days.select(F.col(column).cast("date")).distinct().collect()}  # one item per day
    folder, before, version = _Folder(spark, table), current(spark, table, column), uuid.uuid4().hex
    target = f"{table.rstrip('/')}/_data/version={version}"
    df.hint("rebalance", column).write.partitionBy(column).parquet(target)
    written = {n.split("=", 1)[1] for n in folder.names(f"_data/version={version}") if n.startswith(f"{column}=")}
    if strays := written - requested:
        folder.delete(f"_data/version={version}")
        raise PartitionError(f"rows of {len(strays)} days that were not requested; nothing was replaced")
    new = {d: version for d in written}
    own = {d: before.days.get(d) for d in requested}
    base = before
    for _ in range(TRIES):
        kept = {d: v for d, v in base.days.items() if d not in requested}
        entry = Entry(base.number + 1, column, kept | new)
        if folder.write_new(f"_log/{entry.number:0{_DIGITS}}.json", json.dumps({"column": column, "days": entry.days})):
            return entry
        base = current(spark, table, column)
        if any(base.days.get(d) != v for d, v in own.items()):
            break
    folder.delete(f"_data/version={version}")
    raise PartitionError("another writer replaced one of these days meanwhile; nothing was replaced")


def remove_unused(spark: SparkSession, table: str, keep: int = 2) -> int:
    """Remove day folders that none of the newest ``keep`` entries names, by tasks; returns how many.

    Readers of older entries, and writes that have not ended, must not be under way.
    """
    folder = _Folder(spark, table)
    numbers = _entries(folder)
    entries = [_entry(folder, n) for n in numbers[-keep:]]
    used = {(v, d) for e in entries for d, v in e.days.items()}
    column = entries[-1].column if entries else ""
    unused = [(f"{folder.root}/{n}",) for n in folder.names("") if entries and n.startswith(f"{column}=") and ("", n.split("=", 1)[1]) not in used]
    for name in folder.names("_data"):
        for day in folder.names(f"_data/{name}"):
            if "=" in day and (name.split("=", 1)[1], day.split("=", 1)[1]) not in used:
                unused.append((f"{folder.root}/_data/{name}/{day}",))
    if unused:
        remove(spark.createDataFrame(unused, "path string")).count()
    for number in numbers[:-keep]:
        folder.delete(f"_log/{number:0{_DIGITS}}.json")
    return len(unused)
