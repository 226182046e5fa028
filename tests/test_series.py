import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tapeloom.operators.classify import next_day_target
from tapeloom.operators.features import (
    FeatureConfig,
    log_returns,
    moving_averages,
    reference_correlation,
    relative_strength,
    rolling_volatility,
    silver_features,
)
from tapeloom.plans.ordering import with_dense_key, with_position
from tapeloom.plans.series import Series, lay_out

CONFIG = FeatureConfig(
    price_column="price",
    reference_ticker="HOT",
    volatility_windows=(3, 6),
    ma_windows=(2, 7),
    rsi_window=4,
    correlation_window=5,
)


@pytest.fixture(scope="module")
def ticks(spark):
    """One key owns most rows, several are shorter than a halo, timestamps tie."""
    rng = random.Random(11)
    rows = []
    sizes = {"HOT": 150, "MID": 40, "TWO": 2, "ONE": 1}
    for ticker, size in sizes.items():
        for n in range(size):
            ts = datetime(2024, 1, 1) + timedelta(minutes=n // 2)
            price = None if rng.random() < 0.05 else round(rng.uniform(1, 90), 2)
            rows.append((ticker, ts, n, price, rng.randint(0, 9)))
    rng.shuffle(rows)
    schema = "ticker string, ts timestamp, seq int, price double, volume int"
    return spark.createDataFrame(rows, schema).repartition(3).cache()


def result(df):
    return sorted(tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect())


# one chunk for everything is the plain layout; the small one cuts every series often
WHOLE = Series(order="ts", tie=("seq",), chunk_rows=10_000)
CUT = Series(order="ts", tie=("seq",), chunk_rows=8)


@pytest.mark.parametrize(
    "operator", [log_returns, moving_averages, relative_strength, silver_features]
)
def test_chunks_do_not_change_results(ticks, operator):
    assert result(operator(ticks, CONFIG, CUT)) == result(operator(ticks, CONFIG, WHOLE))


def test_chunks_do_not_change_return_windows(ticks):
    df = log_returns(ticks, CONFIG, WHOLE)
    assert result(rolling_volatility(df, CONFIG, CUT)) == result(rolling_volatility(df, CONFIG, WHOLE))
    unique = df.filter("seq % 2 = 0")  # one reference row per timestamp
    assert result(reference_correlation(unique, CONFIG, CUT)) == result(
        reference_correlation(unique, CONFIG, WHOLE)
    )


def test_chunked_layout_equals_calendar_layout(ticks):
    daily = ticks.withColumn("trade_date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("seq")))
    config = FeatureConfig(price_column="price", reference_ticker="HOT")
    # the default windows reach 200 rows back
    chunked = silver_features(daily, config, Series(chunk_rows=200))
    assert result(chunked) == result(silver_features(daily, config))


def test_look_ahead_over_a_cut(ticks):
    labelled = ticks.withColumn("regime_label", F.concat(F.lit("r"), F.col("seq")))
    cut = next_day_target(labelled, ["volume"], CUT)
    assert result(cut) == result(next_day_target(labelled, ["volume"], WHOLE))
    assert cut.count() == ticks.count() - 4
    assert cut.filter("next_day_regime <> concat('r', seq + 1)").isEmpty()


def test_layout_is_chosen_by_the_grain(ticks):
    daily = ticks.select("ticker", F.to_date("ts").alias("trade_date"))
    assert not lay_out(daily, Series(), before=3).chunked
    assert lay_out(ticks, Series(order="ts"), before=3).chunked
    assert lay_out(daily, Series(chunk_rows=50), before=3).chunked


def test_a_chunk_must_hold_the_reach(ticks):
    with pytest.raises(ValueError):
        lay_out(ticks, CUT, before=9)


def test_hot_key_is_spread_over_chunks(ticks):
    layout = lay_out(ticks, CUT, before=5)
    sizes = [r["count"] for r in layout.frame.groupBy("ticker", "_chunk").count().collect()]
    assert max(sizes) <= 8 + 5
    assert layout.close(layout.frame).count() == ticks.count()


def test_positions_are_dense_and_ordered(ticks):
    placed = with_position(ticks, ["ticker", "ts", "seq"], "place").orderBy("place").collect()
    assert [r["place"] for r in placed] == list(range(len(placed)))
    keys = [(r["ticker"], r["ts"], r["seq"]) for r in placed]
    assert keys == sorted(keys)


def test_dense_keys_continue_after_an_offset(spark):
    df = spark.range(50).select(F.format_string("m%02d", 49 - F.col("id")).alias("name"))
    keyed = with_dense_key(df, ["name"], "sk", after=7)
    assert keyed.schema["sk"].dataType.simpleString() == "int"
    rows = keyed.orderBy("sk").collect()
    assert [r["sk"] for r in rows] == list(range(8, 58))
    assert [r["name"] for r in rows] == sorted(r["name"] for r in rows)


def test_empty_input(spark, ticks):
    empty = ticks.filter("false")
    assert with_dense_key(empty, ["ticker"], "sk").count() == 0
    assert silver_features(empty, CONFIG, CUT).count() == 0
