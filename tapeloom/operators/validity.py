"""Facts to the dimension version that was valid on their day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PERIOD = "_period"


def valid_versions(
    facts: DataFrame,
    dim: DataFrame,
    key: str = "ticker",
    day: str = "trade_date",
    start: str = "effective_from",
    end: str = "effective_to",
    period: str = "year",
) -> DataFrame:
    """``facts`` with the columns of the version of ``dim`` valid on their day, ``[start, end)``.

    A version takes part once for every period (year or month) that it covers up to the last day of the facts, so the join is
    an equality on key and period, and only versions of one period are compared with a row. A NULL
    ``end`` is open, a NULL ``start`` or an empty interval covers nothing. Rows that no version covers have NULL there; columns
    of ``dim`` replace those of the facts with their name. If versions of a key overlap, a row appears once for each: dimensions made by ``scd2_apply`` do not.
    """
    if period not in ("year", "month"):
        raise ValueError(f"unknown period {period!r}")
    last = facts.agg(F.max(day)).scalar()
    stop = F.least(F.coalesce(F.date_sub(end, 1), last), last)
    step = F.expr(f"interval 1 {period}")
    covered = (
        dim.withColumn("_stop", stop)
        .where(F.col(start) <= F.col("_stop"))
        .withColumn(_PERIOD, F.explode(F.sequence(F.trunc(start, period), F.trunc("_stop", period), step)))
        .drop("_stop")
    )
    rows = facts.withColumn(_PERIOD, F.trunc(day, period))
    names = {c: f"_dim_{c}" for c in covered.columns if c not in (key, _PERIOD)}
    covered = covered.withColumnsRenamed(names)
    at = F.col(day)
    inside = (at >= F.col(names[start])) & (F.col(names[end]).isNull() | (at < F.col(names[end])))
    same = (rows[key] == covered[key]) & (rows[_PERIOD] == covered[_PERIOD])
    joined = rows.join(covered, same & inside, "left")
    kept = [rows[c] for c in facts.columns if c not in names]
    return joined.select(*kept, *[covered[held].alias(c) for c, held in names.items()])
