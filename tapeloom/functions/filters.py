"""Row filters that reach the file scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def between(df: DataFrame, column: str, start: str | None, end: str | None) -> DataFrame:
    """Rows with ``column`` in the half-open range ``[start, end)``; None leaves it open.

    The bounds take the column's own type, so no cast hides the column from
    the filters pushed into the scan.
    """
    kind = df.schema[column].dataType
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start).cast(kind))
    if end is not None:
        df = df.filter(F.col(column) < F.lit(end).cast(kind))
    return df
