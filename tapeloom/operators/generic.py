"""Small table operators: pass-through, first rows, grouped sum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_rows(df: DataFrame, order: Sequence[str | Column], count: int = 5) -> DataFrame:
    """The first ``count`` rows of a total order (planned as a distributed top-k)."""
    return df.orderBy(*order).limit(count)


def group_sum(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias(name))
