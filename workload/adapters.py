"""Test tables as market data.

No price table exists among the test tables, so ticks are derived from them:
``lineitem`` lines are trades (price per unit, quantity) of the part's brand or
of the part itself, ``orders`` are trades of the customer's market segment and
``events`` are trades of their event type.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators.bars import price_bars
from tapeloom.operators.features import FeatureConfig

# The place of a trade in its day as one long: order and line, then 20 mixed bits of part
# and supplier because (order, line) repeats. An aggregation ordered by a primitive is
# hash-based; ordered by a struct or a wide decimal it took 3.5 times as long on 12 million
# lines. Fits while order keys stay below 2^40 (ANSI arithmetic fails beyond).
LINE_PLACE = """
    (l_orderkey * 8 + l_linenumber) * 1048576 + (l_partkey * 1009 + l_suppkey) % 1048576
"""

BRAND_CONFIG = FeatureConfig(
    volume_exempt_tickers=("Brand#1",),
    illiquid_volume_threshold=20,
    reference_ticker="Brand#1",
)
EVENT_CONFIG = FeatureConfig(
    volume_exempt_tickers=("click",),
    illiquid_volume_threshold=1,
    reference_ticker="click",
    reference_name="click",
)
TICK_CONFIG = replace(EVENT_CONFIG, price_column="price")
ASOF_CONFIG = replace(TICK_CONFIG, reference_match="asof")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_partkey",
        F.expr(LINE_PLACE).alias("place"),
        F.col("l_shipdate").alias("ts"),
        F.try_divide("l_extendedprice", "l_quantity").alias("price"),
        F.col("l_quantity").alias("size"),
    )


def brand_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("ticker")
    )
    # unhinted: Catalyst broadcasts by file size, beyond that AQE splits hot parts
    return line_ticks(spark, sf_dir).join(brands, "l_partkey")


def brand_bars(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return price_bars(brand_ticks(spark, sf_dir), ["place"], **options)


def part_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = line_ticks(spark, sf_dir).withColumn("ticker", F.col("l_partkey").cast("string"))
    return price_bars(ticks, ["place"])


def segment_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("ticker")
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey",
        "o_orderkey",
        F.col("o_orderdate").alias("ts"),
        F.col("o_totalprice").alias("price"),
        F.lit(1).alias("size"),
    )
    return price_bars(orders.join(segments, "o_custkey"), ["o_orderkey"])


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("ticker"),
        "ts",
        "event_id",
        F.col("value").alias("price"),
        F.lit(1).alias("size"),
    )


def hourly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    # event ids ascend with time: they are the feed's sequence number
    return price_bars(event_ticks(spark, sf_dir), ["event_id"], order="bar_start", interval="1h")
