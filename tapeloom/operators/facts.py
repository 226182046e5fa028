"""Gold facts: bar fact table, referential integrity, quality profiles."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.operators.dims import with_inferred_members
from tapeloom.operators.features import DEFAULT_CONFIG, FeatureConfig
from tapeloom.plans.staging import stage

PRICE_MEASURES = ["open", "high", "low", "close", "adj_close", "volume"]


def fact_bars(
    silver: DataFrame,
    dim_ticker: DataFrame,
    dim_date: DataFrame,
    as_of: date | str,
    config: FeatureConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """The fact of ``fact_and_dimension`` alone."""
    return fact_and_dimension(silver, dim_ticker, dim_date, as_of, config)[0]


def fact_and_dimension(
    silver: DataFrame,
    dim_ticker: DataFrame,
    dim_date: DataFrame,
    as_of: date | str,
    config: FeatureConfig = DEFAULT_CONFIG,
) -> tuple[DataFrame, DataFrame]:
    """(bars with both surrogate keys, ticker dimension completed by the inferred members).

    Store both: the fact uses keys that only the completed dimension has. It is
    staged here, so its keys are drawn once. Every row joins the *current* version of its ticker. Days outside the
    calendar have no key and are left out. Catalyst decides between broadcast and
    shuffle from the staged dimension's real size; in the shuffle case AQE splits
    a hot ticker (one dimension row per ticker).
    """
    members = stage(with_inferred_members(silver, dim_ticker, as_of))
    tickers = members.filter("is_current").select("ticker", "ticker_sk")
    # one row per calendar day: the DATE domain bounds the broadcast
    days = F.broadcast(dim_date.select(F.col("full_date").alias("trade_date"), "date_sk"))
    measures = [*PRICE_MEASURES, "is_illiquid", *config.derived_columns]
    fact = (
        silver.join(days, "trade_date")
        .join(tickers, "ticker")
        .select("ticker_sk", "date_sk", "ticker", "trade_date", *measures)
    )
    return fact, members


def new_fact_rows(fact: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of ``fact`` whose ticker and day are not stored yet (insert-only append)."""
    return fact.join(stored.select("ticker", "trade_date"), ["ticker", "trade_date"], "left_anti")


def referential_integrity(
    fact: DataFrame, dim_ticker: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """One row: orphan ticker keys, orphan date keys, and whether both are zero.

    Each branch reads only its own key column and reduces it to distinct
    values before the anti join.
    """

    def orphans(dim: DataFrame, column: str) -> DataFrame:
        lost = fact.select(column).distinct().join(dim.select(column), column, "left_anti")
        return lost.agg(F.count(F.lit(1)).alias("orphans")).withColumn("key", F.lit(column))

    both = orphans(dim_ticker, "ticker_sk").unionByName(orphans(dim_date, "date_sk"))
    return both.agg(
        F.sum(F.when(F.col("key") == "ticker_sk", F.col("orphans"))).alias("orphan_ticker_keys"),
        F.sum(F.when(F.col("key") == "date_sk", F.col("orphans"))).alias("orphan_date_keys"),
        (F.sum("orphans") == 0).alias("is_healthy"),
    )


def quality_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row, NULL and NaN counts per column, from a single aggregation."""
    numeric = dict(df.dtypes)
    counts = [F.count(F.lit(1)).alias("row_count")]
    for name in columns:
        value = F.col(name)
        floating = numeric[name] in ("double", "float")
        counts.append(F.count_if(value.isNull()).alias(f"{name}_nulls"))
        counts.append(F.count_if(F.isnan(value) if floating else F.lit(False)).alias(f"{name}_nans"))
    cells = ", ".join(f"'{name}', `{name}_nulls`, `{name}_nans`" for name in columns)
    return df.agg(*counts).selectExpr(
        f"stack({len(columns)}, {cells}) as (column_name, null_count, nan_count)", "row_count"
    )


def flag_profile(
    silver: DataFrame, config: FeatureConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Whether low-volume rows carry the illiquid flag and exempt tickers never do."""
    exempt = F.col("ticker").isin(list(config.volume_exempt_tickers))
    low = F.col("volume") <= config.illiquid_volume_threshold
    return silver.agg(
        F.count_if(low & ~exempt).alias("low_volume_rows"),
        F.count_if(low & ~exempt & F.col("is_illiquid")).alias("low_volume_flagged"),
        F.count_if(exempt & F.col("is_illiquid")).alias("exempt_flagged"),
    )
