"""Small bar frames and a plain Python model of the rolling features."""

from __future__ import annotations

import math
from datetime import date, timedelta
from statistics import mean, stdev

START = date(2024, 1, 1)
BAR_TYPE = "ticker string, trade_date date, adj_close double, volume bigint"


def day(n: int) -> date:
    return START + timedelta(days=n)


def bars(spark, **series):
    """One row per price and consecutive day; a price may be a (price, volume) pair."""
    rows = []
    for ticker, prices in series.items():
        for n, price in enumerate(prices):
            price, volume = price if isinstance(price, tuple) else (price, 100)
            rows.append((ticker, day(n), price, volume))
    return spark.createDataFrame(rows, BAR_TYPE)


def column(df, name, order=("ticker", "trade_date")):
    return [row[name] for row in df.orderBy(*order).select(name).collect()]


def returns(prices):
    out = []
    for i, price in enumerate(prices):
        previous = prices[i - 1] if i else None
        usable = None not in (price, previous) and previous > 0 and price > 0
        out.append(math.log(price / previous) if usable else None)
    return out


def rolling(values, size, function):
    """``function`` over the non-NULL values of the last ``size`` entries."""
    frames = [[v for v in values[max(0, i - size + 1) : i + 1] if v is not None] for i in range(len(values))]
    return [function(frame) for frame in frames]


def deviation(frame):
    return stdev(frame) if len(frame) > 1 else None


def average(frame):
    return mean(frame) if frame else None


def rsi(prices, size):
    change = [None] + [b - a for a, b in zip(prices, prices[1:])]
    gain = [c if c is not None and c > 0 else 0.0 for c in change]
    loss = [-c if c is not None and c < 0 else 0.0 for c in change]
    pairs = zip(rolling(gain, size, average), rolling(loss, size, average))
    return [100.0 if down == 0 else 100 - 100 / (1 + up / down) for up, down in pairs]


def pearson(frame):
    pairs = [(x, y) for x, y in frame if x is not None and y is not None]
    if len(pairs) < 2:
        return None
    mx, my = mean(x for x, _ in pairs), mean(y for _, y in pairs)
    sx = math.sqrt(sum((x - mx) ** 2 for x, _ in pairs))
    sy = math.sqrt(sum((y - my) ** 2 for _, y in pairs))
    if sx * sy == 0:
        return None
    return sum((x - mx) * (y - my) for x, y in pairs) / (sx * sy)


def close_to(actual, expected, tolerance=1e-9):
    assert len(actual) == len(expected)
    for a, e in zip(actual, expected):
        assert (a is None) == (e is None), (actual, expected)
        assert a is None or math.isclose(a, e, rel_tol=tolerance, abs_tol=tolerance), (a, e)
