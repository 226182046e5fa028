"""Facts stored by year and bucketed by ticker.

A year is a folder, so a read of some days opens the years it needs and a run over one year overwrites
that year alone. Inside a year the rows of a ticker are in one bucket, sorted by
day, so windows and joins by ticker need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

YEAR = "trade_year"


def write_years(
    df: DataFrame,
    table: str,
    day: str = "trade_date",
    key: str = "ticker",
    buckets: int = 64,
    path: str | None = None,
) -> None:
    """Write ``df`` to a named table; of an existing table only the years in ``df`` are replaced.

    ``buckets`` counts when the table is made; rows without a day are in a year of their own (NULL). The
    rows reach the writers by year and bucket, one file each; at one row per ticker and day a file holds at
    most a year's days for each of its tickers, however hot a ticker is. Do not pass a frame that
    reads the years it replaces: write it to another table first.
    """
    spark = df.sparkSession
    rows = df.withColumn(YEAR, F.year(day))
    exists = spark.catalog.tableExists(table)
    if exists:
        buckets = bucket_count(spark, table)
        rows = rows.select(*spark.read.table(table).columns)
    # the same hash as the writer's buckets
    dealt = rows.repartition(F.col(YEAR), F.pmod(F.hash(key), F.lit(buckets)))
    if exists:
        setting = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(setting)
        spark.conf.set(setting, "dynamic")
        try:
            dealt.write.mode("overwrite").insertInto(table)
        finally:
            spark.conf.set(setting, before)
        return
    writer = dealt.write.format("parquet").partitionBy(YEAR).bucketBy(buckets, key).sortBy(key, day)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def bucket_count(spark: SparkSession, table: str) -> int:
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"describe formatted {table}").collect()}
    return int(about["Num Buckets"])


def read_days(
    spark: SparkSession, table: str, start_date: str | None = None, end_date: str | None = None, day: str = "trade_date"
) -> DataFrame:
    """Rows of ``[start_date, end_date)`` from the years that can hold them."""
    rows = spark.read.table(table)
    if start_date is not None:
        first = F.lit(start_date).cast("date")
        rows = rows.where((F.col(YEAR) >= F.year(first)) & (F.col(day) >= first))
    if end_date is not None:
        end = F.lit(end_date).cast("date")
        rows = rows.where((F.col(YEAR) <= F.year(F.date_sub(end, 1))) & (F.col(day) < end))
    return rows.drop(YEAR)
