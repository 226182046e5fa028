"""Silver in increments: features of new rows from the stored end of every series.

Beside Silver a *tail* is kept: the last ``config.reach`` rows of each ticker as bars, each with the
reference's return at its time. It is all that the features of later rows depend on, so an increment
reads the tail and the new bars and nothing else, whatever the length of the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeloom.operators import features
from tapeloom.operators.features import DAILY, DEFAULT_CONFIG, FeatureConfig
from tapeloom.plans.series import Series, lay_out
from tapeloom.plans.staging import stage
from tapeloom.sources.versions import Version, VersionedTable

TAIL_REFERENCE = "reference_return"
_FRESH = "_fresh"

SILVER, TAIL = "rows", "tail"


class LateRows(ValueError):
    """New bars that stored features already depend on the absence of."""


def empty_tail(bars: DataFrame) -> DataFrame:
    """The tail of no history, for bars of this schema."""
    return bars.limit(0).withColumn(TAIL_REFERENCE, F.lit(None).cast("double"))


def late_rows(
    tail: DataFrame, fresh: DataFrame, config: FeatureConfig = DEFAULT_CONFIG, series: Series = DAILY
) -> DataFrame:
    """Rows of ``fresh`` that do not lie after what is stored.

    A row is late if its ticker has a stored row at its time or later; a row of the reference ticker also
    if any ticker has, because stored correlations were made without it.
    """
    key, time = series.key, series.order
    ends = tail.groupBy(key).agg(F.max(time).alias("_end"))
    own = fresh.join(ends, key).where(F.col(time) <= F.col("_end")).drop("_end")
    last = tail.agg(F.max(time).alias("_end"))
    reference = fresh.where(F.col(key) == config.reference_ticker).join(last, F.col(time) <= F.col("_end"))
    return own.select(*fresh.columns).union(reference.select(*fresh.columns)).distinct()


def silver_increment(
    tail: DataFrame, fresh: DataFrame, config: FeatureConfig = DEFAULT_CONFIG, series: Series = DAILY
) -> tuple[DataFrame, DataFrame]:
    """(Silver rows of ``fresh``, the tail after them); ``fresh`` must hold no late rows.

    The rows are those that ``silver_features`` gives over the whole history.
    """
    columns = fresh.columns
    both = tail.select(*columns, TAIL_REFERENCE, F.lit(False).alias(_FRESH)).unionByName(
        fresh.select(*columns, F.lit(None).cast("double").alias(TAIL_REFERENCE), F.lit(True).alias(_FRESH))
    )
    layout = lay_out(stage(both), series, before=config.reach)
    known = F.when(F.col(_FRESH), F.col(features._REFERENCE)).otherwise(F.col(TAIL_REFERENCE))
    frame = features.with_reference_returns(layout, config, series).withColumn(features._REFERENCE, known)
    rows = features.window_features(frame.drop(TAIL_REFERENCE), layout, config, series)
    rows = rows.where(_FRESH).select(*columns, "is_illiquid", *config.derived_columns)

    # a rank below a constant is cut off before the shuffle as well: a long increment sends few rows
    newest = Window.partitionBy(series.key).orderBy(*[F.desc(c) for c in series.ordering])
    ends = layout.close(frame).select(*columns, F.col(features._REFERENCE).alias(TAIL_REFERENCE))
    ends = ends.withColumn("_back", F.row_number().over(newest)).where(F.col("_back") <= config.reach)
    return rows, ends.drop("_back")


def tail_before(
    silver: DataFrame, columns: list[str], since, config: FeatureConfig = DEFAULT_CONFIG, series: Series = DAILY
) -> DataFrame:
    """The tail as it was before ``since``, from stored Silver rows (their bar ``columns``)."""
    day = silver.schema[series.order].dataType
    kept = stage(silver.where(F.col(series.order) < F.lit(since).cast(day)).select(*columns))
    layout = lay_out(kept, series, before=config.reach)
    frame = features.with_reference_returns(layout, config, series)
    newest = Window.partitionBy(series.key).orderBy(*[F.desc(c) for c in series.ordering])
    ends = layout.close(frame).select(*columns, F.col(features._REFERENCE).alias(TAIL_REFERENCE))
    ends = ends.withColumn("_back", F.row_number().over(newest)).where(F.col("_back") <= config.reach)
    return ends.drop("_back")


class SilverStore:
    """Silver and its tail under one path, changed together in one commit.

    A run that fails leaves the version before it, so an increment can simply be
    run again; of two concurrent increments the later one fails.
    """

    def __init__(
        self, spark: SparkSession, path: str, config: FeatureConfig = DEFAULT_CONFIG, series: Series = DAILY
    ):
        self.table = VersionedTable(spark, path)
        self.config, self.series = config, series

    def read(self) -> DataFrame:
        return self.table.read(SILVER)

    def append(self, bars: DataFrame) -> Version:
        """Add the features of ``bars``, all of which must lie after the stored rows (else ``LateRows``)."""
        base = self.table.current()
        tail = self.table.read(TAIL, base.number) if TAIL in base.folders else empty_tail(bars)
        late = late_rows(tail, bars, self.config, self.series).first()
        if late is not None:
            at = f"{late[self.series.key]} at {late[self.series.order]}"
            raise LateRows(f"{at} is not after the stored rows: amend Silver since then")
        rows, tail = silver_increment(tail, bars, self.config, self.series)
        return self.table.commit(append={SILVER: rows}, replace={TAIL: tail}, based_on=base.number)

    def amend(self, bars: DataFrame, since) -> Version:
        """Replace everything from ``since`` on by the features of ``bars`` (those before ``since`` are not read).

        For late or corrected bars: pass all bars since the first of them. Stored rows before ``since`` stay.
        """
        base = self.table.current()
        stored = self.table.read(SILVER, base.number)
        time = F.col(self.series.order)
        cut = F.lit(since).cast(bars.schema[self.series.order].dataType)
        tail = tail_before(stored, bars.columns, since, self.config, self.series)
        rows, tail = silver_increment(tail, bars.where(time >= cut), self.config, self.series)
        kept = stored.where(time < cut)
        return self.table.commit(replace={SILVER: kept.unionByName(rows), TAIL: tail}, based_on=base.number)
