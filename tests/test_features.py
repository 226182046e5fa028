import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import (
    average,
    bars,
    close_to,
    column,
    day,
    deviation,
    pearson,
    returns,
    rolling,
    rsi,
)
from tapeloom.operators.features import (
    FeatureConfig,
    clean_nan,
    illiquid_flag,
    log_returns,
    moving_averages,
    reference_correlation,
    relative_strength,
    rolling_volatility,
    silver_features,
)

NAN = float("nan")
SMALL = FeatureConfig(
    reference_ticker="REF",
    volatility_windows=(3, 5),
    ma_windows=(2, 4),
    rsi_window=3,
    correlation_window=4,
)


def walk(seed, length):
    rng = random.Random(seed)
    price, out = 50.0, []
    for _ in range(length):
        price *= math.exp(rng.gauss(0, 0.05))
        out.append(price)
    return out


def test_zero_volume_is_flagged_unless_exempt(spark):
    df = bars(spark, **{"AAA": [(1.0, 0), (1.0, 5)], "^VIX": [(1.0, 0), (1.0, 3)]})
    assert column(illiquid_flag(df), "is_illiquid") == [True, False, False, False]


def test_threshold_is_inclusive(spark):
    df = bars(spark, AAA=[(1.0, 10), (1.0, 11)])
    config = FeatureConfig(illiquid_volume_threshold=10)
    assert column(illiquid_flag(df, config), "is_illiquid") == [True, False]


def test_null_volume_gives_null_flag(spark):
    df = bars(spark, **{"AAA": [(1.0, None)], "^VIX": [(1.0, None)]})
    assert column(illiquid_flag(df), "is_illiquid") == [None, False]


def test_first_return_is_null(spark):
    assert column(log_returns(bars(spark, AAA=[10.0])), "log_return") == [None]


def test_known_and_falling_returns(spark):
    values = column(log_returns(bars(spark, AAA=[100.0, 110.0, 99.0])), "log_return")
    close_to(values, [None, math.log(1.1), math.log(0.9)])
    assert values[2] < 0


def test_tickers_do_not_mix(spark):
    df = bars(spark, AAA=[10.0, 20.0], BBB=[100.0, 50.0])
    close_to(column(log_returns(df), "log_return"), [None, math.log(2), None, math.log(0.5)])


@pytest.mark.parametrize("broken", [None, 0.0, -4.0])
def test_unusable_price_breaks_two_returns(spark, broken):
    values = column(log_returns(bars(spark, AAA=[10.0, broken, 10.0, 20.0])), "log_return")
    close_to(values, [None, None, None, math.log(2)])


def test_nan_price_gives_nan_returns_until_cleaned(spark):
    df = log_returns(bars(spark, AAA=[10.0, NAN, 10.0, 20.0]))
    raw = column(df, "log_return")
    assert math.isnan(raw[1]) and math.isnan(raw[2])
    close_to(column(clean_nan(df), "log_return"), [None, None, None, math.log(2)])


def test_rolling_features_match_plain_python(spark):
    prices = {"AAA": walk(1, 30), "BBB": walk(2, 17), "ONE": [7.0]}
    df = log_returns(bars(spark, **prices), SMALL)
    df = rolling_volatility(moving_averages(relative_strength(df, SMALL), SMALL), SMALL)
    for name, model in {
        "volatility_3d": lambda p: rolling(returns(p), 3, deviation),
        "volatility_5d": lambda p: rolling(returns(p), 5, deviation),
        "ma_2": lambda p: rolling(p, 2, average),
        "ma_4": lambda p: rolling(p, 4, average),
        "rsi": lambda p: rsi(p, 3),
    }.items():
        close_to(column(df, name), [v for t in sorted(prices) for v in model(prices[t])])


def test_nulls_are_skipped_by_averages(spark):
    close_to(column(moving_averages(bars(spark, AAA=[None, 2.0, 4.0]), SMALL), "ma_2"), [None, 2.0, 3.0])


def test_rsi_is_100_without_losses(spark):
    df = relative_strength(bars(spark, UP=[1.0, 2.0, 3.0], FLAT=[5.0, 5.0, 5.0]), SMALL)
    assert column(df, "rsi") == [100.0] * 6


def test_rsi_with_nan_change(spark):
    """A NaN change counts as gain: NaN after a loss in the frame, else 100."""
    df = relative_strength(bars(spark, AAA=[10.0, NAN, 12.0], BBB=[10.0, 9.0, NAN]), SMALL)
    values = column(df, "rsi")
    assert values[:3] == [100.0, 100.0, 100.0]
    assert values[4] == 0.0 and math.isnan(values[5])
    assert column(clean_nan(df), "rsi")[5] is None


def test_long_windows_from_blocks_match_plain_python(spark):
    """60 rows are pooled from blocks of 20; the series starts, gaps and ends mid-block."""
    config = FeatureConfig(reference_ticker="REF", correlation_window=60)
    ref, other = walk(21, 150), walk(22, 133)
    other[40] = None
    silver = silver_features(bars(spark, REF=ref, AAA=other), config).filter("ticker = 'AAA'")
    mine, theirs = returns(other), returns(ref)
    close_to(column(silver, "volatility_20d"), rolling(mine, 20, deviation))
    close_to(column(silver, "volatility_60d"), rolling(mine, 60, deviation))
    pairs = rolling(list(zip(mine, theirs)), 60, pearson)
    close_to(column(silver, "corr_vix_60d"), pairs)
    close_to(column(silver, "ma_200"), rolling(other, 200, average))


def test_long_constant_windows_stay_null(spark):
    """Block means of a constant differ in the last bit; that must not count as spread."""
    config = FeatureConfig(reference_ticker="REF")
    doubling = [2.0**n for n in range(90)]
    df = bars(spark, REF=walk(23, 90), FLAT=[0.1] * 90, DOUBLING=doubling)
    silver = silver_features(df, config).filter("ticker <> 'REF'")
    assert column(silver, "corr_vix_60d") == [None] * 180
    assert set(column(silver, "volatility_60d")) == {None, 0.0}


def test_correlation_matches_plain_python_and_survives_missing_days(spark):
    ref, other = walk(3, 20), walk(4, 20)
    df = bars(spark, REF=ref, AAA=other).filter(
        ~((F.col("ticker") == "REF") & (F.col("trade_date") == F.lit(day(7))))
    )
    df = reference_correlation(log_returns(df, SMALL), SMALL)
    kept = ref[:7] + ref[8:]
    ref_returns = returns(kept)
    by_day = ref_returns[:7] + [None] + ref_returns[7:]
    expected = rolling(list(zip(returns(other), by_day)), 4, pearson)
    own = rolling(list(zip(ref_returns, ref_returns)), 4, pearson)
    close_to(column(df, "corr_vix_4d"), expected + own)


def test_constant_side_gives_null_not_an_error(spark):
    df = bars(spark, REF=walk(5, 8), FLAT=[3.0] * 8, DOUBLING=[2.0**n for n in range(8)])
    df = reference_correlation(log_returns(df, SMALL), SMALL).filter("ticker <> 'REF'")
    assert column(df, "corr_vix_4d") == [None] * 16


def test_reference_without_rows_gives_null(spark):
    df = reference_correlation(log_returns(bars(spark, AAA=walk(6, 6)), SMALL), SMALL)
    assert column(df, "corr_vix_4d") == [None] * 6


def test_clean_nan_leaves_prices_and_other_rows(spark):
    df = spark.createDataFrame(
        [("A", day(0), 0.5, NAN, NAN), ("A", day(1), 0.25, 40.0, 3.0)],
        "ticker string, trade_date date, log_return double, rsi double, adj_close double",
    )
    cleaned = clean_nan(df)
    assert column(cleaned, "log_return") == [0.5, 0.25]
    assert column(cleaned, "rsi") == [None, 40.0]
    assert math.isnan(column(cleaned, "adj_close")[0])
    assert column(clean_nan(df, ["adj_close", "absent"]), "adj_close") == [None, 3.0]


def test_silver_equals_the_single_operators(spark):
    df = bars(spark, REF=walk(7, 40), AAA=walk(8, 40), BBB=[5.0, NAN, None, 6.0] * 5)
    steps = illiquid_flag(df, SMALL)
    for operator in (
        log_returns,
        rolling_volatility,
        moving_averages,
        relative_strength,
        reference_correlation,
    ):
        steps = operator(steps, SMALL)
    steps = clean_nan(steps, config=SMALL)
    silver = silver_features(df, SMALL)
    assert silver.columns == [*df.columns, "is_illiquid", *SMALL.derived_columns]
    names = ["is_illiquid", *SMALL.derived_columns]
    for name in names:
        if name == "is_illiquid":
            assert column(silver, name) == column(steps, name)
        else:
            close_to(column(silver, name), column(steps, name))


def test_each_feature_takes_its_own_price(spark):
    df = bars(spark, AAA=[1.0, 2.0, 4.0]).withColumns({"open": F.lit(5.0), "close": F.col("adj_close") * -1 + 9})
    config = FeatureConfig(return_column="adj_close", ma_column="open", rsi_column="close", rsi_window=1, ma_windows=(2,))
    rows = silver_features(df, config).orderBy("trade_date").collect()
    assert [r["ma_2"] for r in rows] == [5.0, 5.0, 5.0]
    assert rows[2]["log_return"] == pytest.approx(math.log(2))
    # falling closes: no gain at all
    assert rows[2]["rsi"] == 0.0
    single = relative_strength(df, config).orderBy("trade_date").collect()
    assert [r["rsi"] for r in single] == [r["rsi"] for r in rows]


def test_default_columns_are_the_published_ones():
    assert FeatureConfig().derived_columns == [
        "log_return",
        "volatility_20d",
        "volatility_60d",
        "ma_20",
        "ma_50",
        "ma_200",
        "rsi",
        "corr_vix_60d",
    ]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.floats(0.5, 500), min_size=4, max_size=25),
    st.lists(st.floats(0.5, 500), min_size=1, max_size=10),
    st.integers(1, 3),
)
def test_future_rows_never_change_the_past(spark, prices, future, cut):
    cut = min(cut, len(prices) - 1)
    known, changed = prices[:-cut], prices[:-cut] + future

    def past(series):
        df = silver_features(bars(spark, AAA=series, REF=walk(9, 40)), SMALL)
        df = df.filter((F.col("ticker") == "AAA") & (F.col("trade_date") < F.lit(day(len(known)))))
        return [tuple(r) for r in df.orderBy("trade_date").select(*SMALL.derived_columns).collect()]

    assert past(known) == past(changed)


def test_one_shuffle_by_ticker_and_shared_windows(spark, tmp_path):
    """Plan guard: the windows share an exchange, the reference side is broadcast."""
    bars(spark, REF=walk(1, 5), AAA=walk(2, 5)).write.parquet(str(tmp_path / "bars"))
    plan = silver_features(spark.read.parquet(str(tmp_path / "bars")), SMALL)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 2  # all tickers, reference ticker only
    assert text.count("BroadcastHashJoin") == 1
    assert "SortMergeJoin" not in text
    assert text.count("+- Window ") + text.count(":- Window ") == 3  # lag, rolling, reference lag
    assert "PushedFilters: [IsNotNull(ticker), EqualTo(ticker,REF)]" in text


def test_repeated_reference_days_repeat_no_rows(spark):
    df = bars(spark, AAA=[10.0 + k % 5 for k in range(30)], REF=[20.0 + k % 7 for k in range(30)])
    config = FeatureConfig(reference_ticker="REF", correlation_window=5)
    once = silver_features(df, config)
    doubled = df.unionByName(df.filter("ticker = 'REF'"))
    assert silver_features(doubled, config).count() == 90
    assert silver_features(doubled, config).filter("ticker = 'AAA'").count() == once.filter("ticker = 'AAA'").count()
