"""Tables of batches: merging, expiry, repeated batches, readers under way."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.streaming import levels

SCHEMA = "ts timestamp, name string, n long"
T0 = datetime(2024, 1, 1)


def batch(spark, number, days=2, rows=3):
    return spark.createDataFrame([
        (T0 + timedelta(days=d, seconds=number), f"b{number}", 1) for d in range(days) for _ in range(rows)
    ], SCHEMA)


def summed(rows):
    return rows.groupBy("day", "ts", "name").agg(F.sum("n").alias("n"))


def names(frame):
    return sorted((r.ts, r.name, r.n) for r in frame.collect())


def test_folders_of_a_day_grow_with_the_logarithm(spark, tmp_path):
    table = str(tmp_path / "t")
    for number in range(14):
        levels.add_batch(batch(spark, number, days=1, rows=1), table, number, fanout=2)
    now = levels.manifest(spark, table)
    assert now.last_batch == 13
    assert sorted(e.level for e in now.entries) == [1, 2, 3]  # 14 = 2 + 4 + 8
    assert sorted(r.name for r in levels.read_table(spark, table).collect()) == sorted(f"b{i}" for i in range(14))


def test_merging_combines_rows_and_changes_nothing(spark, tmp_path):
    table = str(tmp_path / "t")
    for number in range(9):
        levels.add_batch(batch(spark, 7), table, number, combine=summed, fanout=4)
    found = levels.read_table(spark, table)
    assert found.agg(F.sum("n")).first()[0] == 9 * 6
    assert found.count() < 9 * 6
    assert {r.day for r in found.collect()} == {date(2024, 1, 1), date(2024, 1, 2)}


def test_a_repeated_batch_counts_once(spark, tmp_path):
    table = str(tmp_path / "t")
    for number in (0, 0, 1, 0, 1, 2):
        levels.add_batch(batch(spark, number), table, number, fanout=2)
    assert levels.read_table(spark, table).count() == 18


def test_a_batch_that_died_before_its_manifest_is_not_read(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    levels.add_batch(batch(spark, 0), table, 0)
    with monkeypatch.context() as patched:
        patched.setattr(levels, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            levels.add_batch(batch(spark, 1), table, 1)
    assert levels.read_table(spark, table).count() == 6
    levels.add_batch(batch(spark, 1), table, 1)
    assert levels.read_table(spark, table).count() == 12


def test_a_reader_under_way_keeps_what_it_took(spark, tmp_path):
    table = str(tmp_path / "t")
    for number in range(3):
        levels.add_batch(batch(spark, number), table, number)
    before = levels.read_table(spark, table)
    want = names(before)
    assert levels.merge(spark, table, fanout=3) == 6
    levels.expire(spark, table, date(2024, 1, 2))
    assert names(before) == want
    assert levels.vacuum(spark, table, datetime(2000, 1, 1)) == 0
    assert names(before) == want
    assert {r.day for r in levels.read_table(spark, table).collect()} == {date(2024, 1, 2)}


def test_vacuum_removes_what_no_manifest_names(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    monkeypatch.setattr(levels, "VERSIONS_KEPT", 1)
    for number in range(3):
        levels.add_batch(batch(spark, number), table, number)
    levels.merge(spark, table, fanout=3)
    levels.expire(spark, table, date(2024, 1, 2))
    assert levels.vacuum(spark, table, datetime.now() + timedelta(days=1)) == 7
    assert levels.read_table(spark, table).count() == 9
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1


def test_a_second_writer_fails_instead_of_undoing_the_first(spark, tmp_path):
    table = str(tmp_path / "t")
    levels.add_batch(batch(spark, 0), table, 0)
    old = levels.manifest(spark, table)
    levels.add_batch(batch(spark, 1), table, 1)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        levels._commit(spark, table, old, old.entries, 1)
    assert levels.read_table(spark, table).count() == 12


def test_expired_and_unwanted_days_are_not_listed(spark, tmp_path):
    table = str(tmp_path / "t")
    for number in range(2):
        levels.add_batch(batch(spark, number, days=5), table, number)
    assert levels.expire(spark, table, date(2024, 1, 3)) == 4
    assert levels.expire(spark, table, date(2024, 1, 3)) == 0
    files = levels.read_table(spark, table).inputFiles()
    assert files and not any("day=2024-01-01" in f or "day=2024-01-02" in f for f in files)
    files = levels.read_table(spark, table, date(2024, 1, 4), date(2024, 1, 4)).inputFiles()
    assert files and all("day=2024-01-04" in f for f in files)


def test_no_rows_no_days_and_no_table(spark, tmp_path):
    table = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        levels.read_table(spark, table)
    assert levels.read_table(spark, table, schema=SCHEMA).count() == 0
    assert levels.merge(spark, table) == 0 and levels.expire(spark, table, T0.date()) == 0
    assert levels.vacuum(spark, table, T0) == 0
    levels.add_batch(spark.createDataFrame([], SCHEMA), table, 0)
    assert levels.manifest(spark, table).last_batch == 0
    levels.add_batch(spark.createDataFrame([(None, "x", 1), (T0, "y", 2)], SCHEMA), table, 1)
    levels.add_batch(spark.createDataFrame([(None, "z", 1)], SCHEMA), table, 2, fanout=2)
    assert sorted(r.name for r in levels.read_table(spark, table).collect()) == ["x", "y", "z"]
    assert levels.expire(spark, table, date(2025, 1, 1)) == 1
    assert sorted(r.name for r in levels.read_table(spark, table).collect()) == ["x", "z"]


def test_days_divided_further(spark, tmp_path):
    table = str(tmp_path / "t")
    for number in range(4):
        levels.add_batch(batch(spark, number), table, number, by=["name"], fanout=2)
    found = levels.read_table(spark, table)
    assert found.filter("name = 'b1'").count() == 6 and found.count() == 24
    plan = found.filter("name = 'b1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(name" in plan


def test_rows_are_made_more_after_the_shuffle(spark, tmp_path):
    table, given = str(tmp_path / "t"), []

    def expand(rows):
        given.append(rows)
        return rows.select("ts", F.explode(F.array("name", F.lit("x"), F.lit("y"))).alias("name"), "n")

    writers = spark.conf.get(levels._WRITERS)
    rows = batch(spark, 0, days=3).unionByName(spark.createDataFrame([(None, "none", 1)], SCHEMA))
    levels.add_batch(rows, table, 0, expand=expand)
    found = levels.read_table(spark, table)
    assert found.columns == ["ts", "name", "n", "day"] and found.count() == 30
    assert found.filter("day <=> to_date(ts)").groupBy("name").count().count() == 4
    assert given[0].columns == ["ts", "name", "n"]
    assert "RebalancePartitions" in given[0]._jdf.queryExecution().optimizedPlan().toString()
    assert spark.conf.get(levels._WRITERS) == writers
