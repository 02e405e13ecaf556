"""Days replaced all at once or not at all, and retention carried out."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from wardgrid.errors import PartitionError
from wardgrid.sources import daytable, lake

DAYS = [dt.date(2026, 1, 1) + dt.timedelta(i) for i in range(6)]
SCHEMA = "day date, n long"


def frame(spark, rows):
    return spark.createDataFrame([(DAYS[d], n) for d, n in rows], SCHEMA)


def days(spark, *wanted):
    return spark.createDataFrame([(DAYS[d],) for d in wanted], "day date")


def held(spark, table):
    return sorted((DAYS.index(r.day), r.n) for r in daytable.read(spark, table, "day", frame(spark, []).schema).collect())


def test_days_are_replaced_emptied_and_added(spark, tmp_path):
    table = str(tmp_path / "t")
    assert held(spark, table) == [] and daytable.days_of(spark, table, "day").collect() == []
    daytable.replace_days(frame(spark, [(0, 1), (0, 2), (1, 3)]), table, "day", days(spark, 0, 1, 2))
    assert held(spark, table) == [(0, 1), (0, 2), (1, 3)]
    entry = daytable.replace_days(frame(spark, [(2, 9)]), table, "day", days(spark, 1, 2))
    assert held(spark, table) == [(0, 1), (0, 2), (2, 9)] and entry.number == 2
    daytable.replace_days(frame(spark, []), table, "day", days(spark, 0, 2))
    assert held(spark, table) == []
    assert daytable.read(spark, table, "day", entry=entry).count() == 3  # an older entry is still whole


def test_a_reader_keeps_what_it_resolved(spark, tmp_path):
    table = str(tmp_path / "t")
    daytable.replace_days(frame(spark, [(0, 1), (1, 2)]), table, "day", days(spark, 0, 1))
    reader = daytable.read(spark, table, "day")
    daytable.replace_days(reader.withColumn("n", F.col("n") + 10), table, "day", days(spark, 0, 1))  # reads what it replaces
    assert sorted(r.n for r in reader.collect()) == [1, 2] and held(spark, table) == [(0, 11), (1, 12)]


def test_a_failing_write_changes_nothing(spark, tmp_path):
    table = str(tmp_path / "t")
    daytable.replace_days(frame(spark, [(0, 1), (1, 2)]), table, "day", days(spark, 0, 1))
    failing = frame(spark, [(0, 5), (1, 6)]).repartition(2).withColumn("n", F.when(F.col("n") == 6, F.raise_error(F.lit("lost"))).otherwise(F.col("n")))
    with pytest.raises(Exception, match="lost"):
        daytable.replace_days(failing, table, "day", days(spark, 0, 1))
    for rows in ([(0, 5), (3, 1)], [(4, 1)]):
        with pytest.raises(PartitionError, match="1 days that were not requested"):
            daytable.replace_days(frame(spark, rows), table, "day", days(spark, 0, 1))
    nameless = spark.createDataFrame([(None, 1)], SCHEMA)
    with pytest.raises(PartitionError, match="not requested"):
        daytable.replace_days(nameless, table, "day", days(spark, 0))
    assert held(spark, table) == [(0, 1), (1, 2)] and daytable.current(spark, table, "day").number == 1


def test_two_writers(spark, tmp_path, monkeypatch):
    """Another write that ends first is kept if it is of other days, and not overwritten if it is of the same."""
    table = str(tmp_path / "t")
    daytable.replace_days(frame(spark, [(0, 1), (1, 2)]), table, "day", days(spark, 0, 1))
    once = daytable._Folder.write_new

    def second(rows, wanted):
        def first_the_other(self, name, text):
            monkeypatch.setattr(daytable._Folder, "write_new", once)
            daytable.replace_days(frame(spark, rows), table, "day", days(spark, *wanted))
            return once(self, name, text)

        monkeypatch.setattr(daytable._Folder, "write_new", first_the_other)

    second([(3, 3)], (3,))
    daytable.replace_days(frame(spark, [(0, 7)]), table, "day", days(spark, 0))
    assert held(spark, table) == [(0, 7), (1, 2), (3, 3)]
    second([(0, 8)], (0,))
    with pytest.raises(PartitionError, match="another writer"):
        daytable.replace_days(frame(spark, [(0, 9)]), table, "day", days(spark, 0))
    assert held(spark, table) == [(0, 8), (1, 2), (3, 3)]


def test_plain_day_folders_are_taken_over(spark, tmp_path):
    table = str(tmp_path / "t")
    frame(spark, [(0, 1), (1, 2)]).write.partitionBy("day").parquet(table)
    assert held(spark, table) == [(0, 1), (1, 2)]
    daytable.replace_days(frame(spark, [(1, 5), (2, 6)]), table, "day", days(spark, 1, 2))
    assert held(spark, table) == [(0, 1), (1, 5), (2, 6)]
    assert sorted(r.day for r in daytable.days_of(spark, table, "day").collect()) == DAYS[:3]
    assert daytable.read(spark, table, "day").count() == 3


def test_unused_folders_are_removed(spark, tmp_path):
    table = str(tmp_path / "t")
    frame(spark, [(0, 1), (4, 2)]).write.partitionBy("day").parquet(table)
    for n in range(4):
        daytable.replace_days(frame(spark, [(0, n), (1, n)]), table, "day", days(spark, 0, 1))
    before = held(spark, table)
    assert daytable.remove_unused(spark, table, keep=1) == 7  # a plain folder, two days of three versions
    assert held(spark, table) == before == [(0, 3), (1, 3), (4, 2)]
    assert daytable.remove_unused(spark, table, keep=1) == 0
    daytable.replace_days(frame(spark, [(5, 1)]), table, "day", days(spark, 5))
    assert len(held(spark, table)) == 4


def test_expired_objects_are_removed_once(spark, tmp_path):
    root, journal, today = tmp_path / "lake", str(tmp_path / "journal"), dt.date(2026, 6, 1)
    ages = {"raw": 800, "staged": 200, "cuarentena": 100, "reportes": 5000}
    for layer, age in ages.items():
        for days_old in (age, 10):
            folder = root / layer / "visits" / f"fecha={today - dt.timedelta(days_old)}"
            folder.mkdir(parents=True)
            (folder / "x.csv").write_text("x")
            stamp = dt.datetime.combine(today - dt.timedelta(days_old), dt.time(12), dt.UTC).timestamp()
            os.utime(folder / "x.csv", (stamp, stamp))
    done = lake.expire(spark, str(root), today, journal).collect()
    assert sorted((r.capa, r.removed) for r in done) == [("cuarentena", True), ("raw", True), ("staged", True)]
    left = {(r.capa, r.fecha) for r in lake.list_objects(spark, str(root)).collect()}
    assert left == {(layer, today - dt.timedelta(10)) for layer in ages} | {("reportes", today - dt.timedelta(5000))}
    assert lake.expire(spark, str(root), today, journal).collect() == []
    assert len(list((tmp_path / "journal" / f"as_of={today}").iterdir())) == 4
