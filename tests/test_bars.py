import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import bars, column, day
from tapeloom.operators.bars import (
    BAR_SCHEMA,
    conform_bars,
    filter_universe,
    missing_tickers,
    price_bars,
    require_universe,
    universe_table,
)

GROUPS = {"focus": ["AAA", "BBB"], "reference": ["CCC", "AAA"]}


@pytest.fixture(scope="module")
def ticks(spark):
    rows = [
        ("AAA", datetime(2024, 1, 1, 9, 0), 2, 11.0, 5),
        ("AAA", datetime(2024, 1, 1, 9, 0), 1, 10.0, 1),
        ("AAA", datetime(2024, 1, 1, 15, 59), 3, 9.5, 2),
        ("AAA", datetime(2024, 1, 1, 12, 0), 4, 14.0, 7),
        ("AAA", datetime(2024, 1, 3, 10, 0), 5, 8.0, 4),
        ("AAA", datetime(2024, 1, 8, 10, 0), 6, 7.0, 3),
        ("BBB", datetime(2024, 1, 1, 10, 0), 7, 1.0, 1),
    ]
    return spark.createDataFrame(rows, "ticker string, ts timestamp, seq int, price double, size int")


def listed(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_daily_bars(ticks):
    assert listed(price_bars(ticks, ["ts", "seq"]), "ticker", "trade_date") == [
        ("AAA", date(2024, 1, 1), 10.0, 14.0, 9.5, 9.5, 9.5, 15),
        ("AAA", date(2024, 1, 3), 8.0, 8.0, 8.0, 8.0, 8.0, 4),
        ("AAA", date(2024, 1, 8), 7.0, 7.0, 7.0, 7.0, 7.0, 3),
        ("BBB", date(2024, 1, 1), 1.0, 1.0, 1.0, 1.0, 1.0, 1),
    ]


def test_weekly_and_hourly_bars(ticks):
    weekly = price_bars(ticks, ["ts", "seq"], interval="1wk").filter("ticker = 'AAA'")
    assert column(weekly, "trade_date") == [date(2024, 1, 1), date(2024, 1, 8)]
    assert column(weekly, "close") == [8.0, 7.0]
    hourly = price_bars(ticks, ["ts", "seq"], interval="1h").filter("ticker = 'AAA'")
    assert column(hourly, "trade_date")[:2] == [datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 12)]
    assert column(hourly, "open")[0] == 10.0
    with pytest.raises(ValueError):
        price_bars(ticks, ["seq"], interval="7d")


def test_date_range_is_half_open(ticks):
    ranged = price_bars(ticks, ["seq"], start_date="2024-01-03", end_date="2024-01-08")
    assert column(ranged, "trade_date") == [date(2024, 1, 3)]


def test_a_single_order_column_keeps_the_aggregation_hashed(ticks):
    plan = price_bars(ticks, ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_conform_renames_casts_and_fills(spark):
    vendor = spark.createDataFrame(
        [
            ("AAA", datetime(2024, 1, 2, 5), 1.0, 2.0, 0.5, float("nan"), 10.0),
            ("AAA", datetime(2024, 1, 3, 5), None, 2.0, 0.5, 1.5, float("nan")),
        ],
        "ticker string, Date timestamp, Open double, High double, Low double, Close double, Volume double",
    )
    out = conform_bars(vendor, ingested_at=datetime(2024, 2, 1))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in BAR_SCHEMA]
    first, second = out.orderBy("trade_date").collect()
    assert first["trade_date"] == date(2024, 1, 2) and first["volume"] == 10
    assert math.isnan(first["close"]) and first["adj_close"] is None
    assert second["open"] is None and second["volume"] is None
    assert second["ingestion_timestamp"] == datetime(2024, 2, 1)


def test_conform_reads_the_adjusted_close(spark):
    vendor = spark.createDataFrame(
        [("AAA", datetime(2024, 1, 2), 3.25)], "ticker string, Date timestamp, `Adj Close` double"
    )
    row = conform_bars(vendor).first()
    assert row["adj_close"] == 3.25 and row["open"] is None
    assert row["ingestion_timestamp"] is not None


def test_universe_keeps_every_group_entry(spark):
    rows = listed(universe_table(spark, GROUPS), "group_name", "ticker")
    assert rows == [("focus", "AAA"), ("focus", "BBB"), ("reference", "AAA"), ("reference", "CCC")]


def test_universe_filter_does_not_duplicate(spark):
    df = bars(spark, AAA=[1.0, 2.0], ZZZ=[3.0])
    kept = filter_universe(df, universe_table(spark, GROUPS))
    assert column(kept, "ticker") == ["AAA", "AAA"]


def test_missing_tickers_and_policy(spark):
    universe = universe_table(spark, GROUPS)
    df = bars(spark, AAA=[1.0], BBB=[1.0], ZZZ=[1.0])
    assert listed(missing_tickers(df, universe), "ticker") == [("reference", "CCC")]
    assert require_universe(df, universe).count() == 2
    with pytest.raises(RuntimeError, match="CCC"):
        require_universe(df, universe, fail_on_missing=True)
    with pytest.raises(RuntimeError, match="no data"):
        require_universe(df.filter("ticker = 'ZZZ'"), universe)
    assert require_universe(df, universe.filter("ticker <> 'CCC'"), True).count() == 2


def test_volume_beyond_a_long_fails_instead_of_vanishing(spark):
    ticks = spark.sql(
        "select * from values ('A', timestamp_ntz'2024-01-02 10:00:00', 1, 1.0D, 9223372036854775807L),"
        " ('A', timestamp_ntz'2024-01-02 11:00:00', 2, 1.0D, 1L) as t(ticker, ts, seq, price, size)"
    )
    with pytest.raises(Exception, match="OVERFLOW"):
        price_bars(ticks, ["seq"]).collect()
    parts = ticks.withColumn("size", F.lit(0.25)).select("ticker", "ts", "seq", "price", "size")
    assert price_bars(parts, ["seq"]).first()["volume"] == 1


@pytest.mark.parametrize("zone", ["Europe/Berlin", "Asia/Tokyo", "UTC"])
def test_bars_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        ticks = spark.sql(
            "select * from values ('A', timestamp_ntz'2024-03-31 02:30:00', 1, 1.0D, 1L),"
            " ('A', timestamp_ntz'2024-03-31 03:10:00', 2, 2.0D, 1L) as t(ticker, ts, seq, price, size)"
        )
        hours = price_bars(ticks, ["seq"], order="at", interval="1h").orderBy("at").collect()
        assert [r["at"].hour for r in hours] == [2, 3]
        vendor = spark.sql("select 'A' as ticker, timestamp'2024-01-02 00:00:00+09:00' as Date, 1.0D as Open")
        assert str(conform_bars(vendor, timezone="Asia/Tokyo").first()["trade_date"]) == "2024-01-02"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
