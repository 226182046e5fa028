"""Silver layer: flags, returns, rolling indicators, cross-asset correlation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.indicators import log_ratio, nan_to_null, rsi
from tapeloom.functions.moments import (
    block_rows,
    lag_columns,
    moment_columns,
    pair_columns,
    pooled_corr,
    pooled_deviation,
    pooling_steps,
)
from tapeloom.operators.asof import asof_value
from tapeloom.plans.series import Layout, Series, lay_out

_REFERENCE = "_reference_return"
_BEFORE = "_time_before"


@dataclass(frozen=True)
class FeatureConfig:
    """Parameters of the feature layer."""

    volume_exempt_tickers: tuple[str, ...] = ("^VIX",)
    illiquid_volume_threshold: int = 0
    price_column: str = "adj_close"
    # None: ``price_column``
    return_column: str | None = None
    ma_column: str | None = None
    rsi_column: str | None = None
    volatility_windows: tuple[int, ...] = (20, 60)
    ma_windows: tuple[int, ...] = (20, 50, 200)
    rsi_window: int = 14
    reference_ticker: str = "^VIX"
    reference_name: str = "vix"
    correlation_window: int = 60
    # "exact": the reference's return at the same time; "asof": its newest at or before
    reference_match: str = "exact"

    def __post_init__(self) -> None:
        if self.reference_match not in ("exact", "asof"):
            raise ValueError(f"unknown reference_match {self.reference_match!r}")

    @property
    def return_price(self) -> str:
        return self.return_column or self.price_column

    @property
    def ma_price(self) -> str:
        return self.ma_column or self.price_column

    @property
    def rsi_price(self) -> str:
        return self.rsi_column or self.price_column

    @property
    def correlation_column(self) -> str:
        return f"corr_{self.reference_name}_{self.correlation_window}d"

    @property
    def derived_columns(self) -> list[str]:
        return [
            "log_return",
            *(f"volatility_{n}d" for n in self.volatility_windows),
            *(f"ma_{n}" for n in self.ma_windows),
            "rsi",
            self.correlation_column,
        ]

    @property
    def reach(self) -> int:
        """Rows before the current one that any feature depends on."""
        # volatility, RSI and correlation start from a difference with the row before
        return max(
            *self.volatility_windows,
            *(n - 1 for n in self.ma_windows),
            self.rsi_window,
            self.correlation_window,
        )


DEFAULT_CONFIG = FeatureConfig()
DAILY = Series()


def illiquid_flag(df: DataFrame, config: FeatureConfig = DEFAULT_CONFIG, key: str = "ticker") -> DataFrame:
    """``is_illiquid``: volume at or below the threshold, never for exempt tickers."""
    return df.withColumn("is_illiquid", _illiquid(config, key))


def log_returns(
    df: DataFrame, config: FeatureConfig = DEFAULT_CONFIG, series: Series = DAILY
) -> DataFrame:
    """``log_return`` against the previous row of the same ticker."""
    layout = lay_out(df, series, before=1)
    frame = _with_previous(layout.frame, layout, config.return_price)
    return layout.close(_with_return(frame, config).drop(_previous(config.return_price)))


def rolling_volatility(
    df: DataFrame, config: FeatureConfig = DEFAULT_CONFIG, series: Series = DAILY
) -> DataFrame:
    """``volatility_{N}d``: sample deviation of the last N returns."""
    layout = lay_out(df, series, before=max(config.volatility_windows) - 1)
    block = block_rows(config.volatility_windows)
    return layout.close(_add(layout.frame, _volatility(layout, config, block)))


def moving_averages(
    df: DataFrame, config: FeatureConfig = DEFAULT_CONFIG, series: Series = DAILY
) -> DataFrame:
    """``ma_{N}``: mean price of the last N rows."""
    layout = lay_out(df, series, before=max(config.ma_windows) - 1)
    return layout.close(_add(layout.frame, _averages(layout, config)))


def relative_strength(
    df: DataFrame, config: FeatureConfig = DEFAULT_CONFIG, series: Series = DAILY
) -> DataFrame:
    """``rsi`` over the last N price changes."""
    layout = lay_out(df, series, before=config.rsi_window)
    frame = _with_previous(layout.frame, layout, config.rsi_price)
    return layout.close(_add(frame, _strength(layout, config)).drop(_previous(config.rsi_price)))


def reference_correlation(
    df: DataFrame, config: FeatureConfig = DEFAULT_CONFIG, series: Series = DAILY
) -> DataFrame:
    """Rolling correlation of ``log_return`` with the reference ticker's return."""
    layout = lay_out(df, series, before=config.correlation_window - 1)
    reference = _reference_rows(layout, config, series)
    frame = _with_reference(layout.frame, reference, layout, config, series)
    block = block_rows([config.correlation_window])
    return layout.close(_add(frame, _correlation(layout, config, block)).drop(_REFERENCE))


def clean_nan(
    df: DataFrame, columns: Sequence[str] | None = None, config: FeatureConfig = DEFAULT_CONFIG
) -> DataFrame:
    """NaN -> NULL in the derived columns, or in ``columns``; absent names are ignored."""
    wanted = config.derived_columns if columns is None else columns
    present = [name for name in wanted if name in df.columns]
    return df.withColumns({name: nan_to_null(F.col(name)) for name in present})


def silver_features(
    bars: DataFrame, config: FeatureConfig = DEFAULT_CONFIG, series: Series = DAILY
) -> DataFrame:
    """All features in one layout: one shuffle by ticker, three window passes.

    The passes are the price lag, all sliding frames, and the lags of blocks.
    The reference return is joined before the second one (broadcast at DATE
    grain, so the rows stay where they are), reduced to one row per time, so
    repeated times repeat no rows. ``bars`` is read
    twice (once filtered to the reference ticker): pass a table, not a long
    chain of transformations. Write the result before filtering on a feature:
    a filter would repeat the feature's whole expression below the projection.
    """
    layout = lay_out(bars, series, before=config.reach)
    frame = with_reference_returns(layout, config, series)
    rows = window_features(frame, layout, config, series)
    return rows.select(*bars.columns, "is_illiquid", *config.derived_columns)


def with_reference_returns(layout: Layout, config: FeatureConfig, series: Series) -> DataFrame:
    """The rows of a layout with their previous prices, return, and the reference's return at their time."""
    frame = _with_previous(layout.frame, layout, config.return_price, config.rsi_price)
    frame = _with_return(frame, config)
    reference = _with_previous(_reference_rows(layout, config, series), layout, config.return_price)
    reference = _with_return(reference, config)
    return _with_reference(frame, reference, layout, config, series)


def window_features(frame: DataFrame, layout: Layout, config: FeatureConfig, series: Series) -> DataFrame:
    """All sliding features over ``with_reference_returns``; the layout is closed and NaN becomes NULL."""
    block = block_rows([*config.volatility_windows, config.correlation_window])
    frame = _add(
        frame.withColumn("is_illiquid", _illiquid(config, series.key)),
        _volatility(layout, config, block),
        _averages(layout, config),
        _strength(layout, config),
        _correlation(layout, config, block),
    )
    return clean_nan(layout.close(frame), config=config)


@dataclass
class _Feature:
    """Columns of a feature by pass; only ``values`` stay in the result."""

    values: dict[str, Column] = field(default_factory=dict)
    frames: dict[str, Column] = field(default_factory=dict)
    lags: dict[str, Column] = field(default_factory=dict)
    pooled: dict[str, Column] = field(default_factory=dict)
    gaps: dict[str, Column] = field(default_factory=dict)

    def pool(self, count: str, means: Sequence[str], size: int, block: int) -> None:
        for step, columns in zip(
            (self.pooled, self.gaps), pooling_steps(count, means, size, block)
        ):
            step.update(columns)


def _add(df: DataFrame, *features: _Feature) -> DataFrame:
    """Add features so that equal window passes become one Window node."""
    helpers: list[str] = []
    for step in ("frames", "lags", "pooled", "gaps", "values"):
        columns = {name: c for f in features for name, c in getattr(f, step).items()}
        df = df.withColumns(columns) if columns else df
        helpers += [] if step == "values" else columns
    return df.drop(*helpers)


def _illiquid(config: FeatureConfig, key: str) -> Column:
    exempt = F.col(key).isin(list(config.volume_exempt_tickers))
    return F.when(exempt, F.lit(False)).otherwise(
        F.col("volume") <= config.illiquid_volume_threshold
    )


def _previous(price: str) -> str:
    return f"_previous_{price}"


def _with_previous(df: DataFrame, layout: Layout, *prices: str) -> DataFrame:
    return df.withColumns({_previous(p): F.lag(p).over(layout.window) for p in prices})


def _with_return(df: DataFrame, config: FeatureConfig) -> DataFrame:
    price = config.return_price
    return df.withColumn("log_return", log_ratio(F.col(price), F.col(_previous(price))))


def _volatility(layout: Layout, config: FeatureConfig, block: int | None) -> _Feature:
    feature = _Feature()
    for size in config.volatility_windows:
        rows = block or size
        name = f"_return_{rows}"
        frames = moment_columns(name, F.col("log_return"), layout.rows(rows))
        feature.frames |= frames
        feature.lags |= lag_columns(list(frames), size, rows, layout.window)
        feature.pool(f"{name}_n", [f"{name}_mean"], size, rows)
        feature.values[f"volatility_{size}d"] = pooled_deviation(name, size, rows)
    return feature


def _averages(layout: Layout, config: FeatureConfig) -> _Feature:
    price = config.ma_price
    return _Feature(
        {f"ma_{n}": F.col(f"_mean_{n}") for n in config.ma_windows},
        {f"_mean_{n}": F.avg(price).over(layout.rows(n)) for n in config.ma_windows},
    )


def _strength(layout: Layout, config: FeatureConfig) -> _Feature:
    change = F.col(config.rsi_price) - F.col(_previous(config.rsi_price))
    frame = layout.rows(config.rsi_window)
    gain = F.avg(F.when(change > 0, change).otherwise(0.0)).over(frame)
    loss = F.avg(F.when(change < 0, -change).otherwise(0.0)).over(frame)
    return _Feature(
        {"rsi": rsi(F.col("_mean_gain"), F.col("_mean_loss"))},
        {"_mean_gain": gain, "_mean_loss": loss},
    )


def _correlation(layout: Layout, config: FeatureConfig, block: int | None) -> _Feature:
    size = config.correlation_window
    rows = block or size
    frames = pair_columns("_pair", F.col("log_return"), F.col(_REFERENCE), layout.rows(rows))
    feature = _Feature(
        {config.correlation_column: pooled_corr("_pair", size, rows)},
        frames,
        lag_columns(list(frames), size, rows, layout.window),
    )
    feature.pool("_pair_n", ["_pair_x_mean", "_pair_y_mean"], size, rows)
    return feature


def _reference_rows(layout: Layout, config: FeatureConfig, series: Series) -> DataFrame:
    """Rows of the reference ticker, each with the time of the row before it."""
    rows = layout.frame.filter(F.col(series.key) == config.reference_ticker)
    return rows.withColumn(_BEFORE, F.lag(series.order).over(layout.window))


def _with_reference(
    df: DataFrame, source: DataFrame, layout: Layout, config: FeatureConfig, series: Series
) -> DataFrame:
    """Add the reference's return at the same time, or as of it; the number of rows never changes.

    Of several reference rows at one time the first in the order of the series
    counts. The row before is always at hand (in a chunk as halo), so this needs no
    shuffle of its own.
    """
    first = ~F.col(_BEFORE).eqNullSafe(F.col(series.order))
    reference = layout.own(source).filter(first).select(
        F.col(series.order), F.col("log_return").alias(_REFERENCE)
    )
    if config.reference_match == "asof":
        return asof_value(df, reference, series.order, _REFERENCE, _REFERENCE)
    if series.calendar_bound(df):
        # one row per day, by the filter: the DATE domain bounds the broadcast
        reference = F.broadcast(reference)
    return df.join(reference, series.order, "left")
