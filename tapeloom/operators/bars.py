"""Bronze layer: bars from ticks, schema conformance, instrument universe."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.functions.filters import between
from tapeloom.plans.staging import stage

BAR_SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType(), False),
        T.StructField("trade_date", T.DateType(), False),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("adj_close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("ingestion_timestamp", T.TimestampType(), False),
    ]
)

# Vendor column name -> bar column name.
VENDOR_COLUMNS = {
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Adj Close": "adj_close",
    "Volume": "volume",
}

# Bar interval -> truncation unit, at DATE grain and below it.
_DATE_UNITS = {"1d": "day", "1wk": "week", "1mo": "month"}
_TIME_UNITS = {"1h": "hour", "1m": "minute"}


def bar_start(ts: str, interval: str) -> Column:
    """Start of the bar holding ``ts``: a DATE from one day up, else of the type of ``ts``."""
    if interval in _TIME_UNITS:
        # a tumbling window keeps the type and counts a zone-less time as it is written
        return F.window(ts, f"1 {_TIME_UNITS[interval]}")["start"]
    if interval not in _DATE_UNITS:
        raise ValueError(f"unknown interval {interval!r}")
    day = F.to_date(ts)
    return day if interval == "1d" else F.trunc(day, _DATE_UNITS[interval])


def _volume(ticks: DataFrame, size: str) -> Column:
    """Sum of sizes as a long, halves rounded away from zero; beyond a long the query fails."""
    total = F.sum(size)
    whole = isinstance(ticks.schema[size].dataType, T.IntegralType)
    return (total if whole else F.round(total)).cast("bigint")


def price_bars(
    ticks: DataFrame,
    tick_order: Sequence[str],
    key: str = "ticker",
    ts: str = "ts",
    price: str = "price",
    size: str = "size",
    order: str = "trade_date",
    interval: str = "1d",
    start_date: str | None = None,
    end_date: str | None = None,
) -> DataFrame:
    """Open/high/low/close/volume bars per key and interval, ``[start_date, end_date)``.

    One aggregation whose five measures all combine map-side, so a hot
    instrument reaches the shuffle as one row per bar and map task.
    ``tick_order`` must be total within a bar; a single primitive column keeps
    the aggregation hash-based, several are compared as a struct.
    """
    ticks = between(ticks, ts, start_date, end_date)
    place = F.col(tick_order[0]) if len(tick_order) == 1 else F.struct(*tick_order)
    last = F.max_by(price, place)
    return ticks.groupBy(key, bar_start(ts, interval).alias(order)).agg(
        F.min_by(price, place).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        last.alias("close"),
        last.alias("adj_close"),
        _volume(ticks, size).alias("volume"),
    )


def conform_bars(
    vendor: DataFrame,
    key: str = "ticker",
    day: str = "Date",
    ingested_at: datetime | Column | None = None,
    timezone: str | None = None,
) -> DataFrame:
    """Vendor-shaped rows in the fixed bar schema.

    ``timezone`` names the exchange's zone: the day of an instant is the day there,
    whatever the session's zone. Without it, and for days and zone-less times, the
    day is taken as written.

    Missing vendor columns become NULL, NaN prices are kept, and a volume that
    is not an integer (NaN) becomes NULL instead of failing the load.
    """
    local = F.col(day)
    if timezone is not None and isinstance(vendor.schema[day].dataType, T.TimestampType):
        local = F.convert_timezone(F.current_timezone(), F.lit(timezone), local.cast("timestamp_ntz"))
    stamp = F.current_timestamp() if ingested_at is None else F.lit(ingested_at)

    def measure(source: str, target: str) -> Column:
        kind = BAR_SCHEMA[target].dataType
        value = F.col(f"`{source}`") if source in vendor.columns else F.lit(None)
        return (value.try_cast(kind) if target == "volume" else value.cast(kind)).alias(target)

    return vendor.select(
        F.col(key).cast("string").alias("ticker"),
        F.to_date(local).alias("trade_date"),
        *(measure(source, target) for source, target in VENDOR_COLUMNS.items()),
        stamp.cast("timestamp").alias("ingestion_timestamp"),
    )


def universe_table(spark: SparkSession, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Configured groups as (group_name, ticker) rows, duplicates kept."""
    rows = [(group, ticker) for group, tickers in groups.items() for ticker in tickers]
    # through Arrow the rows become a local relation, whose size Catalyst knows
    columns = {
        "group_name": pa.array([group for group, _ in rows], pa.string()),
        "ticker": pa.array([ticker for _, ticker in rows], pa.string()),
    }
    return spark.createDataFrame(pa.table(columns))


def filter_universe(bars: DataFrame, universe: DataFrame, key: str = "ticker") -> DataFrame:
    """Rows of instruments that belong to any group of the universe."""
    members = universe.select(F.col("ticker").alias(key))
    return bars.join(members, key, "left_semi")


def missing_tickers(bars: DataFrame, universe: DataFrame, key: str = "ticker") -> DataFrame:
    """Universe members without a single row (one row per group entry).

    The bars are reduced to their distinct keys before the anti join, so the
    join never sees more than one row per instrument.
    """
    seen = bars.select(F.col(key).alias("ticker")).distinct()
    return universe.join(seen, "ticker", "left_anti").select("group_name", "ticker")


def require_universe(
    bars: DataFrame, universe: DataFrame, fail_on_missing: bool = False, key: str = "ticker"
) -> DataFrame:
    """The bars of the universe, or an error under the missing-ticker policy.

    Always fails when nothing at all was found; with ``fail_on_missing`` also
    when any member is absent. The found rows are staged, so the input is read once.
    """
    found = stage(filter_universe(bars, universe, key))
    if found.isEmpty():
        raise RuntimeError("no data for any ticker of the universe")
    if fail_on_missing:
        absent = missing_tickers(found, universe, key).take(1)
        if absent:
            raise RuntimeError(f"no data for required ticker {absent[0]['ticker']}")
    return found
