"""Bars that late ticks can still change: partial states that merge.

A state holds the first and last tick of a bar with their places, its extremes, and its sums. States of
disjoint sets of ticks merge into the state of their union in any order, so a batch of ticks (late
ones included) is reduced to its own states and appended; no stored tick is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.operators.bars import bar_start
from tapeloom.sources.versions import Version, VersionedTable

STATES = "states"


def bar_states(
    ticks: DataFrame,
    tick_order: Sequence[str],
    key: str = "ticker",
    ts: str = "ts",
    price: str = "price",
    size: str = "size",
    order: str = "trade_date",
    interval: str = "1d",
) -> DataFrame:
    """One state per key and bar of ``ticks``; see ``price_bars`` for the arguments."""
    place = F.col(tick_order[0]) if len(tick_order) == 1 else F.struct(*tick_order)
    return ticks.groupBy(key, bar_start(ts, interval).alias(order)).agg(
        F.min(place).alias("first_place"),
        F.min_by(price, place).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max(place).alias("last_place"),
        F.max_by(price, place).alias("close"),
        F.sum(size).alias("volume"),
        F.count(F.lit(1)).alias("ticks"),
    )


def merge_states(states: DataFrame, key: str = "ticker", order: str = "trade_date") -> DataFrame:
    """One state per key and bar from any number of them; combines map-side."""
    return states.groupBy(key, order).agg(
        F.min("first_place").alias("first_place"),
        F.min_by("open", "first_place").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max("last_place").alias("last_place"),
        F.max_by("close", "last_place").alias("close"),
        F.sum("volume").alias("volume"),
        F.sum("ticks").alias("ticks"),
    )


def bars_of_states(states: DataFrame, key: str = "ticker", order: str = "trade_date") -> DataFrame:
    """The bars that ``price_bars`` makes of all ticks behind ``states``."""
    whole = merge_states(states, key, order)
    total = F.col("volume")
    volume = total if isinstance(whole.schema["volume"].dataType, T.IntegralType) else F.round(total)
    return whole.select(
        key, order, "open", "high", "low", "close", F.col("close").alias("adj_close"), volume.cast("bigint").alias("volume")
    )


class BarStore:
    """States of all batches under one path. ``options`` are the arguments of ``bar_states``."""

    def __init__(self, spark: SparkSession, path: str, tick_order: Sequence[str], **options):
        self.table = VersionedTable(spark, path)
        self.tick_order, self.options = tick_order, options
        self.names = {k: options[k] for k in ("key", "order") if k in options}

    def append(self, ticks: DataFrame) -> Version:
        """Take in a batch of ticks, of whatever times; a batch that failed may be run again."""
        return self.table.commit(append={STATES: bar_states(ticks, self.tick_order, **self.options)})

    def read(self) -> DataFrame:
        """All bars as of the newest batch."""
        return bars_of_states(self.table.read(STATES), **self.names)

    def touched(self, since: int) -> DataFrame:
        """Keys and bars that batches after version ``since`` have added or changed.

        A compaction in between makes every bar count as touched.
        """
        now, then = self.table.current(), self.table.version(since)
        before = set(then.folders.get(STATES, []))
        fresh = [f for f in now.folders[STATES] if f not in before]
        names = [self.names.get("key", "ticker"), self.names.get("order", "trade_date")]
        rows = self.table.read(STATES)
        if not fresh:
            return rows.limit(0).select(*names)
        paths = [f"{self.table.path}/{folder}" for folder in fresh]
        return self.table.spark.read.schema(rows.schema).parquet(*paths).select(*names).distinct()

    def compact(self) -> Version:
        """Merge the stored states into one per bar; what is read stays the same."""
        base = self.table.current()
        merged = merge_states(self.table.read(STATES, base.number), **self.names)
        return self.table.commit(replace={STATES: merged}, based_on=base.number)
