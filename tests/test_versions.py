"""Versioned tables and safe replacement: a failure at any step leaves a readable table."""

from __future__ import annotations

import pytest
from helpers import bars, column
from pyspark.sql import functions as F

from tapeloom.sources import tables, versions
from tapeloom.sources.tables import read_table, replace_table, write_table
from tapeloom.sources.versions import VersionConflict, VersionedTable


class Crash(Exception):
    pass


def crash(*_, **__):
    raise Crash


def test_commits_and_older_versions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.current().number == 0 and not table.exists()
    with pytest.raises(ValueError, match="no frame"):
        table.read()
    assert table.commit(replace={"rows": bars(spark, AAA=[1.0])}).number == 1
    table.commit(append={"rows": bars(spark, BBB=[2.0])})
    # reads itself, changes and overwrites
    table.commit(replace={"rows": table.read().withColumn("adj_close", F.col("adj_close") * 10)})
    assert column(table.read(), "adj_close") == [10.0, 20.0]
    assert [column(table.read(version=n), "adj_close") for n in (1, 2)] == [[1.0], [1.0, 2.0]]
    assert table.vacuum(keep=2, older_than_seconds=-1) == 0
    table.commit(replace={"rows": table.read().limit(0)})
    assert table.read().count() == 0 and table.read().columns == bars(spark, AAA=[1.0]).columns
    assert table.vacuum(keep=1, older_than_seconds=3600) == 0
    assert table.vacuum(keep=1, older_than_seconds=-1) == 3 or table.read().count() == 0
    with pytest.raises(Exception):
        table.version(1)


def test_frames_change_together(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.commit(replace={"a": spark.range(1), "b": spark.range(2)})
    broken = spark.range(3).withColumn("id", F.raise_error(F.lit("vendor")).cast("long"))
    with pytest.raises(Exception, match="vendor"):
        table.commit(replace={"a": spark.range(5)}, append={"b": broken})
    assert (table.read("a").count(), table.read("b").count(), table.current().number) == (1, 2, 1)
    with pytest.raises(ValueError):
        table.commit(replace={"a": spark.range(1)}, append={"a": spark.range(1)})


def test_a_later_writer_fails(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.commit(replace={"rows": spark.range(1)})
    seen = table.current().number
    table.commit(append={"rows": spark.range(2)}, based_on=seen)
    with pytest.raises(VersionConflict):
        table.commit(append={"rows": spark.range(4)}, based_on=seen)
    assert table.read().count() == 3
    table.commit(append={"rows": spark.range(4)})
    assert table.read().count() == 7


def test_columns_may_join_but_not_change_type(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.commit(replace={"rows": spark.range(1)})
    table.commit(append={"rows": spark.range(1).selectExpr("id + 1 as id", "'x' as note")})
    assert [tuple(r) for r in table.read().orderBy("id").collect()] == [(0, None), (1, "x")]
    with pytest.raises(ValueError, match="stored as bigint"):
        table.commit(append={"rows": spark.range(1).selectExpr("cast(id as string) id")})
    assert table.current().number == 2


@pytest.mark.parametrize("step", ["_write", "_publish", "_rename"])
def test_failures_of_a_commit(spark, tmp_path, monkeypatch, step):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.commit(replace={"rows": spark.range(3)})
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, step, crash)
        with pytest.raises(Crash):
            table.commit(replace={"rows": table.read().where("id > 0")})
    assert table.read().count() == 3 and table.current().number == 1
    table.commit(replace={"rows": table.read().where("id > 0")})
    assert table.read().count() == 2


@pytest.mark.parametrize("failing", [0, 1])
def test_failures_of_a_path_switch(spark, tmp_path, monkeypatch, failing):
    """The first rename moves the old table aside, the second brings the new one in."""
    path = str(tmp_path / "dim")
    write_table(bars(spark, AAA=[1.0, 2.0]), path)
    real, calls = tables._rename, []

    def sometimes(*args):
        calls.append(args)
        if len(calls) - 1 == failing:
            raise Crash
        return real(*args)

    with monkeypatch.context() as m:
        m.setattr(tables, "_rename", sometimes)
        with pytest.raises(Crash):
            replace_table(read_table(spark, path).filter("adj_close > 1"), path)
    # before the switch the old rows, in its middle the complete new ones
    assert column(read_table(spark, path), "adj_close") == ([1.0, 2.0] if failing == 0 else [2.0])
    replace_table(read_table(spark, path).withColumn("adj_close", F.lit(5.0)), path)
    assert set(column(read_table(spark, path), "adj_close")) == {5.0}


def test_an_incomplete_successor_is_not_taken(spark, tmp_path):
    path = tmp_path / "dim"
    write_table(bars(spark, AAA=[1.0]), str(path))
    path.rename(tmp_path / "dim.old")
    (tmp_path / "dim.next").mkdir()
    assert column(read_table(spark, str(path)), "adj_close") == [1.0]


def test_named_tables_are_pointed_at_new_folders(spark, monkeypatch):
    spark.sql("create database if not exists safe")
    try:
        write_table(bars(spark, AAA=[1.0]), "safe.bars")
        for n in (2, 3):
            more = read_table(spark, "safe.bars").unionByName(bars(spark, BBB=[float(n)]))
            assert replace_table(more, "safe.bars") == n
        assert sorted(column(read_table(spark, "safe.bars"), "adj_close")) == [1.0, 2.0, 3.0]
        # fails after the new folder is written, before the catalog changes
        with monkeypatch.context() as m:
            m.setattr(tables, "write_table", crash)
            with pytest.raises(Crash):
                replace_table(read_table(spark, "safe.bars").limit(1), "safe.bars")
        assert read_table(spark, "safe.bars").count() == 3
        # other columns
        assert replace_table(read_table(spark, "safe.bars").select("ticker"), "safe.bars") == 3
        assert read_table(spark, "safe.bars").columns == ["ticker"]
    finally:
        spark.sql("drop table if exists safe.bars")
    assert versions.ROWS == "rows"
