import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import BAR_TYPE, bars, column, day
from tapeloom.operators.generic import first_rows, group_sum
from tapeloom.plans.staging import drop_staged, stage, staging_root
from tapeloom.sources.runs import log_run
from tapeloom.sources.tables import (
    append_table,
    read_landed,
    read_table,
    replace_table,
    use_namespace,
    write_table,
)


@pytest.mark.parametrize("format", ["parquet", "csv", "json", "orc"])
def test_landed_files_with_a_date_range(spark, tmp_path, format):
    path = str(tmp_path / format)
    write_table(bars(spark, AAA=[1.0, 2.0, 3.0, 4.0]), path, format=format)
    rows = read_landed(spark, path, BAR_TYPE, format, "trade_date", "2024-01-02", "2024-01-04")
    assert column(rows, "adj_close") == [2.0, 3.0]
    assert column(read_landed(spark, path, BAR_TYPE, format), "adj_close") == [1.0, 2.0, 3.0, 4.0]
    with pytest.raises(ValueError):
        read_landed(spark, path, BAR_TYPE, format, start_date="2024-01-02")


def test_date_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "bars")
    write_table(bars(spark, AAA=[1.0, 2.0]), path)
    rows = read_landed(spark, path, BAR_TYPE, day="trade_date", start_date="2024-01-02")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(trade_date,2024-01-02)" in plan


def test_write_counts_rows_and_appends(spark, tmp_path):
    path = str(tmp_path / "bars")
    assert write_table(bars(spark, AAA=[1.0, 2.0]), path) == 2
    assert append_table(bars(spark, BBB=[3.0]), path) == 1
    assert column(spark.read.parquet(path), "ticker") == ["AAA", "AAA", "BBB"]


def test_partitioned_write_prunes(spark, tmp_path):
    path = str(tmp_path / "fact")
    df = bars(spark, AAA=[1.0] * 400).withColumn("year", F.year("trade_date"))
    write_table(df, path, partition_by=["year"])
    assert sorted(n for n in os.listdir(path) if n.startswith("year")) == ["year=2024", "year=2025"]
    plan = spark.read.parquet(path).filter("year = 2025")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(year" in plan.toString()


def test_a_table_can_be_replaced_from_itself(spark, tmp_path):
    path = str(tmp_path / "dim")
    write_table(bars(spark, AAA=[1.0, 2.0]), path)
    grown = spark.read.parquet(path).unionByName(bars(spark, BBB=[3.0]))
    assert replace_table(grown, path) == 3
    assert column(spark.read.parquet(path), "adj_close") == [1.0, 2.0, 3.0]


def test_named_tables(spark):
    spark.sql("create database if not exists market")
    before = spark.catalog.currentDatabase()
    use_namespace(spark, "market", "spark_catalog")
    try:
        write_table(bars(spark, AAA=[1.0]), "bars")
        replace_table(read_table(spark, "market.bars").unionByName(bars(spark, BBB=[2.0])), "bars")
        assert column(read_table(spark, "bars"), "adj_close") == [1.0, 2.0]
    finally:
        spark.sql("drop table if exists market.bars")
        use_namespace(spark, before)


def test_new_columns_join_a_table_on_append(spark):
    spark.sql("create database if not exists market")
    try:
        write_table(bars(spark, AAA=[1.0]), "market.grown")
        fresh = bars(spark, BBB=[2.0]).drop("volume").withColumn("note", F.lit("x"))
        assert append_table(fresh, "market.grown", merge_schema=True) == 1
        rows = read_table(spark, "market.grown").orderBy("ticker").collect()
        assert [(r["ticker"], r["note"], r["volume"] is None) for r in rows] == [("AAA", None, False), ("BBB", "x", True)]
    finally:
        spark.sql("drop table if exists market.grown")


def test_new_columns_under_a_path_are_read_merged(spark, tmp_path):
    path = str(tmp_path / "bars")
    write_table(bars(spark, AAA=[1.0]), path)
    append_table(bars(spark, BBB=[2.0]).withColumn("note", F.lit("x")), path, merge_schema=True)
    rows = read_table(spark, path, mergeSchema="true").orderBy("ticker").collect()
    assert [(r["ticker"], r["note"]) for r in rows] == [("AAA", None), ("BBB", "x")]


def test_a_failed_replacement_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "dim")
    write_table(bars(spark, AAA=[1.0, 2.0]), path)
    broken = spark.read.parquet(path).withColumn("adj_close", F.raise_error(F.lit("vendor")).cast("double"))
    with pytest.raises(Exception, match="vendor"):
        replace_table(broken, path)
    assert column(spark.read.parquet(path), "adj_close") == [1.0, 2.0]
    assert replace_table(spark.read.parquet(path).filter("adj_close > 1"), path) == 1
    assert column(spark.read.parquet(path), "adj_close") == [2.0]


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    at = datetime(2024, 5, 1)
    assert log_run(spark, path, "kmeans_k4", at, {"k": 4, "features": ["a"]}, {"silhouette": 0.5}) == 3
    assert log_run(spark, path, "kmeans_k5", at, metrics={"silhouette": 0.4}) == 1
    rows = spark.read.parquet(path).orderBy("run_name", "kind", "key").collect()
    assert [(r["run_name"], r["kind"], r["key"], r["value_str"], r["value_num"]) for r in rows] == [
        ("kmeans_k4", "metric", "silhouette", None, 0.5),
        ("kmeans_k4", "param", "features", "['a']", None),
        ("kmeans_k4", "param", "k", "4", None),
        ("kmeans_k5", "metric", "silhouette", None, 0.4),
    ]


def test_stage_cuts_the_lineage(spark):
    staged = stage(bars(spark, AAA=[1.0, 2.0]).withColumn("n", F.monotonically_increasing_id()))
    assert column(staged, "adj_close") == [1.0, 2.0]
    plan = staged._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" in plan and "monotonically" not in plan


def test_staging_root_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert staging_root(spark) == configured.rstrip("/")
    else:
        assert os.path.isdir(staging_root(spark)) and staging_root(spark) == staging_root(spark)


def test_generic_operators(spark):
    df = bars(spark, AAA=[3.0, 1.0], BBB=[2.0])
    assert [r["adj_close"] for r in first_rows(df, [F.desc("adj_close")], 2).collect()] == [3.0, 2.0]
    total = group_sum(df, "ticker", "adj_close", "total")
    assert [tuple(r) for r in total.orderBy("ticker").collect()] == [("AAA", 4.0), ("BBB", 2.0)]
    assert day(0).isoformat() == "2024-01-01"


def test_zz_dropping_staged_data(spark):
    staged = stage(spark.range(3))
    path = staged.inputFiles()[0]
    drop_staged(spark)
    assert not os.path.exists(path.removeprefix("file://").removeprefix("file:"))
