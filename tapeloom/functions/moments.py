"""Deviation and correlation over long sliding frames, put together from blocks.

Spark re-aggregates a sliding frame for every row, so a frame of N rows costs N
updates per row. Here a short frame of d rows (d divides N) collects count,
mean and squared deviations, and the moments of N rows are pooled from that
frame at the current row and its lags d, 2d, ... N - d. Pooling works on
deviations from the means, so it is as stable as a single pass.

The built-in corr raises DIVIDE_BY_ZERO on a constant side under ANSI mode;
``pooled_corr`` gives NULL there.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

# pooling one more block costs about as much as this many frame updates
_POOLING_COST = 4

# block means closer than this (relative to their mean) are equal but for rounding
_SAME_MEAN = 1e-14


def block_rows(sizes: Sequence[int]) -> int | None:
    """Rows per block that serves frames of all ``sizes``, None if blocks do not pay."""
    common, longest = math.gcd(*sizes), max(sizes)
    costs = {
        d: d + _POOLING_COST * (longest // d) for d in range(1, common + 1) if common % d == 0
    }
    best = min(costs, key=costs.get)
    return best if costs[best] < longest else None


def moment_columns(name: str, x: Column, frame: WindowSpec) -> dict[str, Column]:
    """Count, mean and sum of squared deviations of ``x`` over ``frame``."""
    count = F.count(x).over(frame)
    return {
        f"{name}_n": count,
        f"{name}_mean": F.coalesce(F.avg(x).over(frame), F.lit(0.0)),
        f"{name}_m2": F.coalesce(count * F.var_pop(x).over(frame), F.lit(0.0)),
    }


def pair_columns(name: str, x: Column, y: Column, frame: WindowSpec) -> dict[str, Column]:
    """Moments of both sides over the rows where both are present, and their cross sum."""
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    count = F.count(x).over(frame)

    def scaled(moment: Column) -> Column:
        return F.coalesce(count * moment.over(frame), F.lit(0.0))

    return {
        f"{name}_n": count,
        f"{name}_x_mean": F.coalesce(F.avg(x).over(frame), F.lit(0.0)),
        f"{name}_y_mean": F.coalesce(F.avg(y).over(frame), F.lit(0.0)),
        f"{name}_x_m2": scaled(F.var_pop(x)),
        f"{name}_y_m2": scaled(F.var_pop(y)),
        f"{name}_cross": scaled(F.covar_pop(x, y)),
    }


def lag_columns(
    names: Sequence[str], size: int, block: int, window: WindowSpec
) -> dict[str, Column]:
    """The block columns of the ``size // block - 1`` blocks before the current one."""
    return {
        f"{name}_{back}": F.lag(name, back, 0 if name.endswith("_n") else 0.0).over(window)
        for name in names
        for back in range(block, size, block)
    }


def _blocks(name: str, size: int, block: int) -> list[Column]:
    return [F.col(name), *(F.col(f"{name}_{back}") for back in range(block, size, block))]


def _total(columns: Sequence[Column]) -> Column:
    return reduce(add, columns)


def pooling_steps(
    count: str, means: Sequence[str], size: int, block: int
) -> list[dict[str, Column]]:
    """Columns to add one after the other: pooled means, then every block's gap from them.

    Two projections instead of one long expression: generated code stays small
    enough for the JVM to compile. A single block needs no pooling.
    """
    if size == block:
        return []
    counts = _blocks(count, size, block)
    pooled, gaps = {}, {}
    for mean in means:
        blocks = _blocks(mean, size, block)
        middle = f"{mean}_pooled{size}"
        weighted = _total([n * m for n, m in zip(counts, blocks)])
        pooled[middle] = F.try_divide(weighted, _total(counts))
        for i, m in enumerate(blocks):
            gap = m - F.col(middle)
            apart = F.abs(gap) > F.abs(middle) * _SAME_MEAN
            gaps[f"{mean}_gap{size}_{i}"] = F.when(apart, gap).otherwise(0.0)
    return [pooled, gaps]


def _pooled(count: str, sums: str, x: str, y: str, size: int, block: int) -> Column:
    """Sum of (products of) deviations over ``size`` rows."""
    parts = _blocks(sums, size, block)
    if size > block:
        parts += [
            n * F.col(f"{x}_gap{size}_{i}") * F.col(f"{y}_gap{size}_{i}")
            for i, n in enumerate(_blocks(count, size, block))
        ]
    return _total(parts)


def pooled_deviation(name: str, size: int, block: int) -> Column:
    """Sample standard deviation over ``size`` rows; NULL below two values."""
    mean = f"{name}_mean"
    squares = _pooled(f"{name}_n", f"{name}_m2", mean, mean, size, block)
    count = _total(_blocks(f"{name}_n", size, block))
    return F.when(count > 1, F.sqrt(squares / (count - 1)))


def pooled_corr(name: str, size: int, block: int) -> Column:
    """Pearson correlation over ``size`` rows; NULL below two pairs or if a side is constant."""
    count, x, y = f"{name}_n", f"{name}_x_mean", f"{name}_y_mean"
    cross = _pooled(count, f"{name}_cross", x, y, size, block)
    x_squares = _pooled(count, f"{name}_x_m2", x, x, size, block)
    y_squares = _pooled(count, f"{name}_y_m2", y, y, size, block)
    return F.try_divide(cross, F.sqrt(x_squares) * F.sqrt(y_squares))
