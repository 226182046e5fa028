"""Gold dimensions: calendar and type 2 slowly changing instrument dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.functions.indicators import monday_week, price_band, valid_number
from tapeloom.plans.ordering import with_dense_key

# Columns of the ticker dimension, in order.
DIM_COLUMNS = [
    "ticker_sk",
    "ticker",
    "company_name",
    "sector",
    "market_cap_category",
    "effective_from",
    "effective_to",
    "is_current",
    "is_inferred",
]


def _calendar(days: DataFrame) -> DataFrame:
    day = F.col("full_date")
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_sk"),
        day,
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.dayofmonth(day).alias("day_of_month"),
        monday_week(day).alias("week_of_year"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )


def calendar_dim(
    spark: SparkSession, start_date: str = "2015-01-01", end_date: str = "2030-12-31"
) -> DataFrame:
    """One row per calendar day, both ends included."""
    count = (date.fromisoformat(end_date) - date.fromisoformat(start_date)).days + 1
    first = F.lit(start_date).cast("date")
    return _calendar(spark.range(count).select(F.date_add(first, F.col("id").cast("int")).alias("full_date")))


def calendar_dim_for(df: DataFrame, day: str = "trade_date") -> DataFrame:
    """The calendar of every whole year that ``df`` touches."""
    bounds = df.agg(
        F.trunc(F.min(day), "year").alias("first"),
        F.last_day(F.add_months(F.trunc(F.max(day), "year"), 11)).alias("last"),
    )
    return _calendar(bounds.select(F.explode(F.sequence("first", "last")).alias("full_date")))


def price_bands(df: DataFrame, price: str = "adj_close", **bands) -> DataFrame:
    """Add ``market_cap_category`` from the price (see ``price_band``)."""
    return df.withColumn("market_cap_category", price_band(F.col(price), **bands))


def latest_price(
    df: DataFrame, key: str = "ticker", order: str = "trade_date", price: str = "adj_close"
) -> DataFrame:
    """Newest non-NULL, non-NaN price per key: a map-side combined aggregate, no sort."""
    valid = df.filter(valid_number(F.col(price)))
    return valid.groupBy(key).agg(F.max_by(price, order).alias(price))


def _versions(df: DataFrame, **values: Column) -> DataFrame:
    """Complete rows of the instrument dimension; unset attributes become NULL."""
    defaults = {
        "company_name": F.lit(None).cast("string"),
        "sector": F.lit(None).cast("string"),
        "market_cap_category": F.lit(None).cast("string"),
        "effective_to": F.lit(None).cast("date"),
        "is_current": F.lit(True),
        "is_inferred": F.lit(False),
    }
    present = {name: F.col(name) for name in df.columns}
    return df.withColumns({**defaults, **present, **values}).select(*DIM_COLUMNS)


def _last_key(dim: DataFrame) -> Column:
    return dim.agg(F.coalesce(F.max("ticker_sk"), F.lit(0)).alias("last_key")).scalar()


def scd2_initial(silver: DataFrame, key_type: str = "int", **bands) -> DataFrame:
    """First version of every validly priced ticker, keys dense in ticker order.

    First day and latest valid price come from one aggregate over the features.
    """
    valid_day = F.when(valid_number(F.col("adj_close")), F.col("trade_date"))
    members = (
        silver.groupBy("ticker")
        .agg(
            F.min("trade_date").alias("effective_from"),
            F.max_by("adj_close", valid_day).alias("adj_close"),
        )
        .filter(F.col("adj_close").isNotNull())
    )
    keyed = with_dense_key(members, ["ticker"], "ticker_sk", key_type=key_type)
    return _versions(keyed, market_cap_category=price_band(F.col("adj_close"), **bands))


def current_state(silver: DataFrame, **bands) -> DataFrame:
    """(ticker, new_category) from the latest valid price."""
    return latest_price(silver).select(
        "ticker", price_band(F.col("adj_close"), **bands).alias("new_category")
    )


def scd2_changes(dim: DataFrame, state: DataFrame, null_safe: bool = False) -> DataFrame:
    """Current dimension rows whose category differs from the new state.

    By default a NULL category (inferred member) never counts as changed;
    ``null_safe`` lets the first known category complete such a member.
    """
    old, new = F.col("market_cap_category"), F.col("new_category")
    differs = ~old.eqNullSafe(new) if null_safe else old != new
    return (
        dim.filter("is_current")
        .join(state, "ticker")
        .filter(differs)
        .select("ticker_sk", "ticker", "company_name", "sector", "market_cap_category", "new_category")
    )


def scd2_apply(
    dim: DataFrame,
    state: DataFrame,
    as_of: date | str,
    null_safe: bool = False,
) -> DataFrame:
    """Close changed versions at ``as_of`` and add their successors.

    Validity intervals are half-open: the old version ends on the day the new
    one starts. Descriptive columns are carried forward. New keys follow the
    largest existing one in ticker order.
    """
    day = F.lit(as_of).cast("date")
    changes = scd2_changes(dim, state, null_safe).withColumnRenamed("ticker_sk", "old_sk")
    key_type = dim.schema["ticker_sk"].dataType.simpleString()
    keyed = with_dense_key(changes, ["ticker"], "ticker_sk", _last_key(dim), key_type)

    ended = keyed.select(F.col("old_sk").alias("ticker_sk"), F.lit(True).alias("_ended"))
    closed = dim.join(ended, "ticker_sk", "left").select(
        *(c for c in DIM_COLUMNS if c not in ("effective_to", "is_current", "is_inferred")),
        F.when(F.col("_ended"), day).otherwise(F.col("effective_to")).alias("effective_to"),
        (F.col("is_current") & F.col("_ended").isNull()).alias("is_current"),
        "is_inferred",
    )
    successors = _versions(keyed.drop("market_cap_category"), market_cap_category=F.col("new_category"), effective_from=day)
    return closed.unionByName(successors)


def inferred_members(facts: DataFrame, dim: DataFrame, as_of: date | str) -> DataFrame:
    """Skeleton rows for fact tickers the dimension has never seen."""
    unknown = facts.select("ticker").distinct().join(
        dim.select("ticker").distinct(), "ticker", "left_anti"
    )
    key_type = dim.schema["ticker_sk"].dataType.simpleString()
    keyed = with_dense_key(unknown, ["ticker"], "ticker_sk", _last_key(dim), key_type)
    return _versions(
        keyed, effective_from=F.lit(as_of).cast("date"), is_inferred=F.lit(True)
    )


def with_inferred_members(facts: DataFrame, dim: DataFrame, as_of: date | str) -> DataFrame:
    return dim.unionByName(inferred_members(facts, dim, as_of))
