"""How the rows of a keyed, ordered series are laid out for window functions.

Two layouts give identical results:

* **calendar**: one window partition per key. Used when the order column is a
  DATE. The grain is one row per key and date, so a partition can never hold
  more rows than the calendar has days, however skewed the keys are.
* **chunked**: for every other order type a key has no row bound (one
  instrument may own a third of all ticks). Rows get their global position in
  (key, order), are cut into equal chunks, and the rows next to a cut are
  copied into the neighbouring chunk as halo. Windows run per (key, chunk) and
  the halo is dropped afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.plans.ordering import with_position

DEFAULT_CHUNK_ROWS = 50_000

_CHUNK = "_chunk"
_OWN = "_own"


@dataclass(frozen=True)
class Series:
    """Column roles of a series; ``tie`` makes the order total."""

    key: str = "ticker"
    order: str = "trade_date"
    tie: tuple[str, ...] = ()
    chunk_rows: int | None = None

    @property
    def ordering(self) -> list[str]:
        return [self.order, *self.tie]

    def calendar_bound(self, df: DataFrame) -> bool:
        """True if at most one row per calendar day exists for a key."""
        return not self.tie and isinstance(df.schema[self.order].dataType, T.DateType)


@dataclass(frozen=True)
class Layout:
    """A frame with the window to use on it; ``close`` removes helper rows and columns."""

    frame: DataFrame
    window: WindowSpec
    chunked: bool

    def rows(self, size: int) -> WindowSpec:
        """The current row and the ``size - 1`` rows before it."""
        return self.window.rowsBetween(-(size - 1), 0)

    def own(self, df: DataFrame) -> DataFrame:
        return df.filter(_OWN) if self.chunked else df

    def close(self, df: DataFrame) -> DataFrame:
        return self.own(df).drop(_CHUNK, _OWN)


def lay_out(df: DataFrame, series: Series, before: int = 0, after: int = 0) -> Layout:
    """Prepare ``df`` for windows reaching ``before`` rows back and ``after`` rows ahead."""
    if series.chunk_rows is None and series.calendar_bound(df):
        window = Window.partitionBy(series.key).orderBy(*series.ordering)
        return Layout(df, window, chunked=False)

    size = series.chunk_rows or max(DEFAULT_CHUNK_ROWS, before, after)
    if max(before, after) > size:
        raise ValueError(f"a chunk of {size} rows cannot serve a reach of {max(before, after)}")

    positioned = with_position(df, [series.key, *series.ordering], "_position")
    home = F.expr(f"_position div {size}")
    offset = F.col("_position") % size
    copies = F.array_compact(
        F.array(
            F.lit(0),
            F.when(offset >= size - before, F.lit(1)),
            F.when(offset < after, F.lit(-1)),
        )
    )
    frame = (
        positioned.withColumn("_shift", F.explode(copies))
        .withColumn(_CHUNK, home + F.col("_shift"))
        .withColumn(_OWN, F.col("_shift") == 0)
        .drop("_position", "_shift")
    )
    window = Window.partitionBy(series.key, _CHUNK).orderBy(*series.ordering)
    return Layout(frame, window, chunked=True)
