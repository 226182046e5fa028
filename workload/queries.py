"""Every operator as a query over the test tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeloom.operators import bars as bar_ops
from tapeloom.operators import classify, dims, facts, features, generic, regimes
from tapeloom.functions.filters import between
from tapeloom.operators.bar_states import BarStore
from tapeloom.operators.incremental import SilverStore
from tapeloom.operators.lloyd import sweep
from tapeloom.operators.validity import valid_versions
from tapeloom.plans.series import Series
from tapeloom.plans.staging import scratch_path, stage
from tapeloom.sources.landing import bar_rules, read_checked
from tapeloom.sources.partitioned import read_days, write_years
from tapeloom.sources.tables import write_profiled
from workload.adapters import (
    ASOF_CONFIG,
    BRAND_CONFIG,
    EVENT_CONFIG,
    TICK_CONFIG,
    brand_bars,
    brand_ticks,
    event_ticks,
    hourly_bars,
    part_bars,
    segment_bars,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]

# digits kept where two engines may differ in the last bits of a double; the nudge
# keeps means of cents, which can end exactly on a rounding border, off that border
DIGITS = 6
NUDGE = 1e-7 / 3

UNIVERSE = {
    "focus": ["Brand#2", "Brand#3", "Brand#5", "Brand#7", "Brand#11", "Brand#13", "Brand#97"],
    "reference": ["Brand#17", "Brand#19", "Brand#23", "Brand#98"],
    "volatility": ["Brand#1"],
}
BANDS = ((1000, "microcap"), (3000, "smallcap"))
OLD_STATE_END = "1998-12-31"
AS_OF = "2001-12-31"
DIM_CUTOFF = "1995-01-03"
PART_DIM_CUTOFF = "1995-01-31"
CALENDAR_GAP_END = "2000-12-31"
# small chunks, so that the checks at small scale cut every series
CHECK_CHUNK_ROWS = 250
TRAIN_END = "2000-12-31"
CALM_LIMIT = 1.75
# increments of Silver begin here; late ticks come in so many batches
INCREMENTS = ("1996-06-03", "1998-12-31", "2000-03-15")
TICK_BATCHES = 3
LANDED_SCHEMA = (
    "ticker string, trade_date date, open double, high double, low double, close double, adj_close double, volume long"
)
FACT_START = "1997-03-01"
FACT_BUCKETS = 8
# the ticker dimension as it was made, and the days of two later runs over it
LLOYD_STEPS = 3
VERSION_CUTS = ("1996-12-31", "1998-06-30", "2000-06-30")
# given centres in z-scored space, off any value a row could be equally far from
CENTRES = (
    (0.0313, -0.7171, 0.0517, 0.1319),
    (0.8719, 0.6113, 0.9337, -0.2171),
    (-0.9173, 0.5779, -0.8931, 0.0791),
    (0.1117, 1.9373, -0.1733, 0.4513),
)
# rule-based regime names in the order of their class index
RULE_LABELS = ["calm", "momentum", "selloff"]


def rounded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({name: F.round(F.col(name) + NUDGE, DIGITS) for name in columns})


def with_nan_prices(bars: DataFrame) -> DataFrame:
    """NaN as adjusted close on every 13 December, as from a broken vendor day."""
    broken = (F.month("trade_date") == 12) & (F.dayofmonth("trade_date") == 13)
    return bars.withColumn(
        "adj_close", F.when(broken, F.lit(float("nan"))).otherwise(F.col("adj_close"))
    )


def broken_bars(bars: DataFrame) -> DataFrame:
    """NaN prices on 13 December, NULL prices on every 7th and NULL volumes on every 21st."""
    day = F.dayofmonth("trade_date")
    return with_nan_prices(bars).withColumns(
        {
            "adj_close": F.when(day != 7, F.col("adj_close")),
            "volume": F.when(day != 21, F.col("volume")),
        }
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.silver_features(stage(brand_bars(spark, sf_dir)), BRAND_CONFIG)


def rule_regimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows with a deterministic regime, so label operators compare with SQL."""
    rows = stage(silver(spark, sf_dir))
    calm = F.col("volatility_20d") <= CALM_LIMIT
    regime = (
        F.when(calm, RULE_LABELS[0])
        .when(F.col("log_return") >= 0, RULE_LABELS[1])
        .otherwise(RULE_LABELS[2])
    )
    return rows.dropna(subset=list(regimes.CLUSTER_FEATURES)).withColumn("regime_label", regime)


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = classify.next_day_target(rule_regimes(spark, sf_dir))
    return classify.time_split(rows, TRAIN_END, BRAND_CONFIG.volume_exempt_tickers)


def daily_bars(spark, sf_dir):
    return brand_bars(spark, sf_dir)


def daily_bars_range(spark, sf_dir):
    return brand_bars(spark, sf_dir, start_date="1996-01-01", end_date="1999-01-01")


def weekly_bars(spark, sf_dir):
    return brand_bars(spark, sf_dir, interval="1wk")


def conform_bars(spark, sf_dir):
    """Bars renamed to vendor columns, without adjusted close and with NaN volumes."""
    day = F.col("trade_date")
    volume = F.when(F.dayofmonth(day) == 13, F.lit(float("nan"))).otherwise(
        F.col("volume").cast("double")
    )
    vendor = brand_bars(spark, sf_dir).select(
        "ticker",
        day.cast("timestamp_ntz").alias("Date"),
        F.col("open").alias("Open"),
        F.col("high").alias("High"),
        F.col("low").alias("Low"),
        F.col("close").alias("Close"),
        volume.alias("Volume"),
    )
    return bar_ops.conform_bars(vendor).drop("ingestion_timestamp")


def universe_filter(spark, sf_dir):
    universe = bar_ops.universe_table(spark, UNIVERSE)
    return bar_ops.filter_universe(brand_bars(spark, sf_dir), universe)


def missing_tickers(spark, sf_dir):
    universe = bar_ops.universe_table(spark, UNIVERSE)
    return bar_ops.missing_tickers(brand_bars(spark, sf_dir), universe)


def illiquid_flag(spark, sf_dir):
    flagged = features.illiquid_flag(brand_bars(spark, sf_dir), BRAND_CONFIG)
    return flagged.select("ticker", "trade_date", "volume", "is_illiquid")


def log_returns(spark, sf_dir):
    rows = features.log_returns(brand_bars(spark, sf_dir), BRAND_CONFIG)
    return rounded(rows.select("ticker", "trade_date", "log_return"), ["log_return"])


def rolling_volatility(spark, sf_dir):
    rows = features.log_returns(brand_bars(spark, sf_dir), BRAND_CONFIG)
    rows = features.rolling_volatility(rows, BRAND_CONFIG)
    names = ["volatility_20d", "volatility_60d"]
    return rounded(rows.select("ticker", "trade_date", *names), names)


def moving_averages(spark, sf_dir):
    rows = features.moving_averages(brand_bars(spark, sf_dir), BRAND_CONFIG)
    names = ["ma_20", "ma_50", "ma_200"]
    return rounded(rows.select("ticker", "trade_date", *names), names)


def rsi(spark, sf_dir):
    rows = features.relative_strength(brand_bars(spark, sf_dir), BRAND_CONFIG)
    return rounded(rows.select("ticker", "trade_date", "rsi"), ["rsi"])


def rolling_corr(spark, sf_dir):
    rows = features.log_returns(stage(brand_bars(spark, sf_dir)), BRAND_CONFIG)
    rows = features.reference_correlation(rows, BRAND_CONFIG)
    return rounded(rows.select("ticker", "trade_date", "corr_vix_60d"), ["corr_vix_60d"])


def clean_nan(spark, sf_dir):
    rows = with_nan_prices(brand_bars(spark, sf_dir))
    rows = features.log_returns(rows, BRAND_CONFIG)
    rows = features.rolling_volatility(rows, BRAND_CONFIG)
    rows = features.clean_nan(rows, config=BRAND_CONFIG)
    names = ["log_return", "volatility_20d"]
    return rounded(rows.select("ticker", "trade_date", *names), names)


def silver_features(spark, sf_dir):
    return rounded(silver(spark, sf_dir), BRAND_CONFIG.derived_columns)


def silver_features_parts(spark, sf_dir):
    """Many short series: every part is an instrument."""
    rows = features.silver_features(stage(part_bars(spark, sf_dir)), BRAND_CONFIG)
    return rounded(rows, BRAND_CONFIG.derived_columns)


def hourly_features(spark, sf_dir):
    """Timestamp grain: series without a row bound take the chunked layout."""
    rows = features.silver_features(
        stage(hourly_bars(spark, sf_dir)), EVENT_CONFIG, Series(order="bar_start", chunk_rows=CHECK_CHUNK_ROWS)
    )
    return rounded(rows, EVENT_CONFIG.derived_columns)


def tick_features(spark, sf_dir):
    """All features over raw ticks: few, very long series without a row bound."""
    ticks = event_ticks(spark, sf_dir).withColumnRenamed("size", "volume")
    rows = features.silver_features(ticks, TICK_CONFIG, Series(order="ts", tie=("event_id",), chunk_rows=CHECK_CHUNK_ROWS))
    return rounded(rows, TICK_CONFIG.derived_columns)


def tick_features_asof(spark, sf_dir):
    """Ticks against the newest reference return at or before each of them."""
    ticks = event_ticks(spark, sf_dir).withColumnRenamed("size", "volume")
    series = Series(order="ts", tie=("event_id",), chunk_rows=CHECK_CHUNK_ROWS)
    return rounded(features.silver_features(stage(ticks), ASOF_CONFIG, series), ASOF_CONFIG.derived_columns)


def silver_incremental(spark, sf_dir):
    """Silver from four increments, each from the stored tail and new bars."""
    bars = stage(brand_bars(spark, sf_dir))
    store = SilverStore(spark, scratch_path(spark), BRAND_CONFIG)
    for first, end in zip((None, *INCREMENTS), (*INCREMENTS, None)):
        store.append(between(bars, "trade_date", first, end))
    return rounded(store.read(), BRAND_CONFIG.derived_columns)


def late_bars(spark, sf_dir):
    """Bars from batches of ticks, each with ticks of every bar."""
    ticks = brand_ticks(spark, sf_dir)
    batch = F.pmod(F.hash("place"), F.lit(TICK_BATCHES))
    store = BarStore(spark, scratch_path(spark), ["place"])
    for n in range(TICK_BATCHES):
        store.append(ticks.where(batch == n))
    return store.read()


def fact_by_year(spark, sf_dir):
    """The stored fact: two years overwritten, some years read, a window by ticker without a shuffle."""
    fact = stage(_star(spark, sf_dir)[0])
    table_name = f"fact_{uuid.uuid4().hex}"
    write_years(fact, table_name, buckets=FACT_BUCKETS, path=scratch_path(spark))
    write_years(fact.where(F.year("trade_date").between(1998, 1999)), table_name)
    rows = read_days(spark, table_name, FACT_START)
    order = Window.partitionBy("ticker").orderBy("trade_date")
    return rows.select(
        "ticker",
        "trade_date",
        "close",
        F.lag("close").over(order).alias("previous_close"),
        F.row_number().over(order).alias("day_number"),
    )


def fact_versions(spark, sf_dir):
    """Bars with the band their part was in on the day, from a dimension with several versions."""
    bars = stage(part_bars(spark, sf_dir))
    upto = lambda day: bars.where(F.col("trade_date") <= F.lit(day).cast("date"))
    dim = dims.scd2_initial(upto(VERSION_CUTS[0]), "bigint", bands=BANDS)
    for cut in VERSION_CUTS[1:]:
        dim = dims.scd2_apply(stage(dim), dims.current_state(upto(cut), bands=BANDS), cut)
    found = valid_versions(bars, stage(dim))
    return found.select("ticker", "trade_date", "adj_close", "market_cap_category", "effective_from", "effective_to")


def dim_date(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("trade_date"))
    return dims.calendar_dim_for(days)


def price_bands(spark, sf_dir):
    rows = dims.price_bands(brand_bars(spark, sf_dir), bands=BANDS)
    return rows.select("ticker", "trade_date", "market_cap_category")


def latest_price(spark, sf_dir):
    return dims.latest_price(with_nan_prices(part_bars(spark, sf_dir)))


def scd2_initial(spark, sf_dir):
    return dims.scd2_initial(with_nan_prices(part_bars(spark, sf_dir)), "bigint", bands=BANDS)


def _scd2(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Dimension of the old state and the categories of the new one."""
    bars = stage(part_bars(spark, sf_dir))
    old = bars.filter(F.col("trade_date") <= F.lit(OLD_STATE_END).cast("date"))
    dim = dims.scd2_initial(old, "bigint", bands=BANDS)
    return dim, dims.current_state(bars, bands=BANDS)


def scd2_changes(spark, sf_dir):
    changes = dims.scd2_changes(*_scd2(spark, sf_dir))
    return changes.drop("company_name", "sector")


def scd2_apply(spark, sf_dir):
    dim, state = _scd2(spark, sf_dir)
    return dims.scd2_apply(stage(dim), state, AS_OF)


def inferred_members(spark, sf_dir):
    bars = stage(part_bars(spark, sf_dir))
    early = bars.filter(F.col("trade_date") <= F.lit(PART_DIM_CUTOFF).cast("date"))
    dim = stage(dims.scd2_initial(early, "bigint", bands=BANDS))
    return dims.inferred_members(bars, dim, AS_OF)


def _star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(fact, ticker dimension before the fact run, calendar, completed dimension)."""
    rows = stage(silver(spark, sf_dir))
    day = F.col("trade_date")
    early = rows.filter(day <= F.lit(DIM_CUTOFF).cast("date"))
    dim_ticker = stage(dims.scd2_initial(early, bands=BANDS))
    dim_date = dims.calendar_dim_for(rows)
    fact, completed = facts.fact_and_dimension(rows, dim_ticker, dim_date, AS_OF, BRAND_CONFIG)
    return fact, dim_ticker, dim_date, completed


def fact_bars(spark, sf_dir):
    fact, *_ = _star(spark, sf_dir)
    return rounded(fact, BRAND_CONFIG.derived_columns)


def fact_append(spark, sf_dir):
    fact = stage(_star(spark, sf_dir)[0])
    stored = fact.filter(F.col("trade_date") <= F.lit(OLD_STATE_END).cast("date"))
    fresh = facts.new_fact_rows(fact, stored)
    return fresh.select("ticker_sk", "date_sk", "ticker", "trade_date", *facts.PRICE_MEASURES)


def referential_integrity(spark, sf_dir):
    """The fact against the dimension before inference and a shorter calendar."""
    fact, dim_ticker, dim_date, _ = _star(spark, sf_dir)
    return facts.referential_integrity(stage(fact), dim_ticker, dim_date.filter(F.col("year") < 2000))


def fact_integrity(spark, sf_dir):
    """The fact against the completed dimension and the whole calendar: healthy."""
    fact, _, dim_date, completed = _star(spark, sf_dir)
    return facts.referential_integrity(stage(fact), completed, dim_date)


def fact_calendar_gap(spark, sf_dir):
    """Days that a calendar ending early leaves out of the fact."""
    rows = stage(silver(spark, sf_dir))
    early = rows.filter(F.col("trade_date") <= F.lit(CALENDAR_GAP_END).cast("date"))
    dim_ticker = stage(dims.scd2_initial(rows, bands=BANDS))
    fact = facts.fact_bars(rows, dim_ticker, dims.calendar_dim_for(early), AS_OF, BRAND_CONFIG)
    return rows.join(fact, ["ticker", "trade_date"], "left_anti").select("ticker", "trade_date")


def silver_features_nan(spark, sf_dir):
    """All features over NaN and NULL prices and NULL volumes."""
    return rounded(
        features.silver_features(stage(broken_bars(brand_bars(spark, sf_dir))), BRAND_CONFIG),
        BRAND_CONFIG.derived_columns,
    )


def quality_profile(spark, sf_dir):
    bars = with_nan_prices(brand_bars(spark, sf_dir))
    rows = features.log_returns(bars, BRAND_CONFIG)
    names = ["ticker", "trade_date", *facts.PRICE_MEASURES, "log_return"]
    return facts.quality_profile(rows, names)


def profiled_write(spark, sf_dir):
    """Silver written once, its NULL, NaN and flag counts taken during the write."""
    rows = features.silver_features(stage(broken_bars(brand_bars(spark, sf_dir))), BRAND_CONFIG)
    names = ["ticker", "trade_date", *facts.PRICE_MEASURES, *BRAND_CONFIG.derived_columns]
    return write_profiled(rows, scratch_path(spark), names, {"is_illiquid": F.col("is_illiquid")})


def quarantine(spark, sf_dir):
    """Bars landed as text, some of them broken: kept and rejected rows by reason."""
    day = F.dayofmonth("trade_date")
    bars = brand_bars(spark, sf_dir).select(
        F.when(day != 19, F.col("ticker")).otherwise("").alias("ticker"),
        "trade_date",
        "open",
        F.when(day != 11, F.col("high")).otherwise(F.col("low")).alias("high"),
        F.when(day != 11, F.col("low")).otherwise(F.col("high")).alias("low"),
        "close",
        "adj_close",
        F.when(day == 7, "n/a").when(day == 23, F.concat(F.lit("-"), "volume")).otherwise(F.col("volume").cast("string")).alias("volume"),
    )
    landed = scratch_path(spark)
    bars.select(F.concat_ws(",", *bars.columns).alias("value")).write.text(landed)
    found = read_checked(spark, landed, LANDED_SCHEMA, rules=bar_rules())
    kept = found.rows.agg(F.lit("kept").alias("reason"), F.count(F.lit(1)).alias("rows"), F.sum("volume").alias("volume"))
    return kept.union(found.rejected.groupBy("reason").agg(F.count(F.lit(1)), F.sum("volume")))


def flag_profile(spark, sf_dir):
    flagged = features.illiquid_flag(brand_bars(spark, sf_dir), BRAND_CONFIG)
    return facts.flag_profile(flagged, BRAND_CONFIG)


def zscore_features(spark, sf_dir):
    scaled, _ = regimes.standardise(stage(silver(spark, sf_dir)))
    values = vector_to_array(regimes.SCALED)
    names = [f"z_{name}" for name in regimes.CLUSTER_FEATURES]
    columns = [values[i].alias(name) for i, name in enumerate(names)]
    return rounded(scaled.select("ticker", "trade_date", *columns), names)


def kmeans_regimes(spark, sf_dir):
    run = regimes.kmeans_regimes(stage(silver(spark, sf_dir)))
    return run.regimes


def k_sweep(spark, sf_dir):
    return regimes.k_sweep(stage(silver(spark, sf_dir)))


def kmeans_assign(spark, sf_dir):
    """The assignment step of the clustering, for given centres."""
    scaled, _ = regimes.standardise(stage(silver(spark, sf_dir)))
    return regimes.nearest_centre(scaled, CENTRES).select("ticker", "trade_date", "cluster")


def silhouette_sweep(spark, sf_dir):
    """The score of the sweep over k, for the first k of given centres."""
    scaled, _ = regimes.standardise(stage(silver(spark, sf_dir)))
    scaled = stage(scaled.select(regimes.SCALED))
    scores = [
        (k, regimes.silhouette(regimes.nearest_centre(scaled, CENTRES[:k]))) for k in (2, 3, 4)
    ]
    return rounded(spark.createDataFrame(scores, "k int, silhouette double"), ["silhouette"])


def kmeans_fit(spark, sf_dir):
    """A fit checked over all its rows: away from the nearest centre, named against the centres."""
    run = regimes.kmeans_regimes(stage(silver(spark, sf_dir)))
    centres = [[float(x) for x in c] for c in run.model.clusterCenters()]
    moments = zip(regimes.CLUSTER_FEATURES, run.scaler.mean.toArray(), run.scaler.std.toArray())
    values = [(F.col(c) - F.lit(float(m))) / F.lit(float(s)) for c, m, s in moments]
    distances = F.array(*(regimes.squared_distance(values, c) for c in centres))
    away = F.get(distances, F.col("cluster")) > F.array_min(distances) + 1e-9
    volatility = regimes.CLUSTER_FEATURES.index("volatility_20d")
    calmest = min(range(len(centres)), key=lambda i: centres[i][volatility])
    calm = F.col("regime_label") == regimes.REGIME_LABELS[0]
    return run.regimes.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(away).alias("away"),
        F.count_if(calm != (F.col("cluster") == calmest)).alias("misnamed"),
        F.count_distinct("cluster").alias("clusters"),
    )


def lloyd_sweep(spark, sf_dir):
    """Three steps of the clustering from given starts, for k = 2, 3 and 4 in shared scans."""
    scaled, _ = regimes.standardise(stage(silver(spark, sf_dir)))
    fits = sweep(scaled, {k: CENTRES[:k] for k in (2, 3, 4)}, LLOYD_STEPS, tolerance=0.0)
    names = [f"c_{name}" for name in regimes.CLUSTER_FEATURES]
    rows = [(f.k, i, n, *c) for f in fits for i, (n, c) in enumerate(zip(f.members, f.centres))]
    kinds = ", ".join(f"{name} double" for name in names)
    # one row per centre
    return rounded(spark.createDataFrame(rows, f"k int, cluster int, members long, {kinds}"), names)


def label_regimes(spark, sf_dir):
    """Given cluster ids (the quarter of the day), the last of them without a name."""
    rows = brand_bars(spark, sf_dir).select(
        "ticker", "trade_date", (F.quarter("trade_date") - 1).alias("cluster")
    )
    return regimes.label_regimes(rows)


def next_day_target(spark, sf_dir):
    rows = classify.next_day_target(rule_regimes(spark, sf_dir))
    return rows.select("ticker", "trade_date", "regime_label", "next_day_regime")


def time_split(spark, sf_dir):
    train, test = train_test(spark, sf_dir)
    parts = train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test"))
    )
    return parts.select("ticker", "trade_date", "next_day_regime", "split")


def label_index(spark, sf_dir):
    train, _ = train_test(spark, sf_dir)
    return classify.label_index(train)


def class_weights(spark, sf_dir):
    train, _ = train_test(spark, sf_dir)
    return rounded(classify.class_weights(classify.label_index(train)), ["class_weight"])


def rf_predictions(spark, sf_dir):
    rows = rule_regimes(spark, sf_dir)
    exempt = BRAND_CONFIG.volume_exempt_tickers
    return classify.rf_predictions(rows, train_end=TRAIN_END, exclude=exempt).predictions


def feature_importance(spark, sf_dir):
    rows = rule_regimes(spark, sf_dir)
    exempt = BRAND_CONFIG.volume_exempt_tickers
    return classify.rf_predictions(rows, train_end=TRAIN_END, exclude=exempt).importance


def forest_fit(spark, sf_dir):
    """A forest checked over its stored predictions: rows, names, metrics, importances."""
    exempt = BRAND_CONFIG.volume_exempt_tickers
    run = classify.rf_predictions(rule_regimes(spark, sf_dir), train_end=TRAIN_END, exclude=exempt)
    hit = (F.col("prediction") == F.col("label")).cast("double")
    named = F.col("predicted_regime").isNotNull()
    right = (F.col("predicted_regime") == F.col("next_day_regime")) == (hit == 1.0)
    seen = run.predictions.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~(named & right)).alias("misnamed"),
        F.avg(hit).alias("hits"),
    )
    total = run.importance.agg(F.sum("importance").alias("total"))
    # three one-row frames
    found = seen.join(run.metrics.select("accuracy")).join(total)
    return found.select(
        "rows",
        "misnamed",
        (F.abs(F.col("hits") - F.col("accuracy")) < 1e-9).alias("accuracy_agrees"),
        (F.abs(F.col("total") - 1) < 1e-9).alias("importances_add_up"),
    )


def _rule_index(regime: Column) -> Column:
    index = F.array_position(F.array(*map(F.lit, RULE_LABELS)), regime) - 1
    return index.cast("double")


def _persistence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows under the forecast "tomorrow is like today" (deterministic)."""
    _, test = train_test(spark, sf_dir)
    return test.select(
        "ticker",
        "trade_date",
        "next_day_regime",
        _rule_index(F.col("next_day_regime")).alias("label"),
        _rule_index(F.col("regime_label")).alias("prediction"),
    )


def confusion_table(spark, sf_dir):
    return classify.confusion_table(_persistence(spark, sf_dir))


def class_metrics(spark, sf_dir):
    confusion = classify.confusion_table(_persistence(spark, sf_dir))
    return rounded(classify.class_metrics(confusion), ["precision", "recall", "f1"])


def classification_metrics(spark, sf_dir):
    confusion = classify.confusion_table(_persistence(spark, sf_dir))
    metrics = classify.classification_metrics(confusion)
    return rounded(metrics, metrics.columns)


def decode_prediction(spark, sf_dir):
    """Only the first two class names are known, the third index decodes to NULL."""
    return classify.decode_prediction(_persistence(spark, sf_dir), RULE_LABELS[:2])


def group_sum(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey"
    )
    orders = table(spark, sf_dir, "orders").join(customers, "o_custkey")
    # cents as decimals: exact in any summation order
    orders = orders.select("c_nationkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    total = generic.group_sum(orders, "c_nationkey", "price", "total_price")
    return total.withColumn("total_price", F.col("total_price").cast("double"))


def table_scan(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


def limit_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return generic.first_rows(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 5)


QUERIES: dict[str, Query] = {
    "daily_bars": daily_bars,
    "daily_bars_range": daily_bars_range,
    "weekly_bars": weekly_bars,
    "segment_bars": segment_bars,
    "hourly_bars": hourly_bars,
    "conform_bars": conform_bars,
    "universe_filter": universe_filter,
    "missing_tickers": missing_tickers,
    "illiquid_flag": illiquid_flag,
    "log_returns": log_returns,
    "rolling_volatility": rolling_volatility,
    "moving_averages": moving_averages,
    "rsi": rsi,
    "rolling_corr": rolling_corr,
    "clean_nan": clean_nan,
    "silver_features": silver_features,
    "silver_features_parts": silver_features_parts,
    "hourly_features": hourly_features,
    "tick_features": tick_features,
    "tick_features_asof": tick_features_asof,
    "silver_incremental": silver_incremental,
    "late_bars": late_bars,
    "fact_by_year": fact_by_year,
    "fact_versions": fact_versions,
    "dim_date": dim_date,
    "price_band": price_bands,
    "latest_price": latest_price,
    "scd2_initial": scd2_initial,
    "scd2_changes": scd2_changes,
    "scd2_apply": scd2_apply,
    "inferred_members": inferred_members,
    "fact_bars": fact_bars,
    "fact_append": fact_append,
    "referential_integrity": referential_integrity,
    "fact_integrity": fact_integrity,
    "fact_calendar_gap": fact_calendar_gap,
    "silver_features_nan": silver_features_nan,
    "quality_profile": quality_profile,
    "profiled_write": profiled_write,
    "quarantine": quarantine,
    "flag_profile": flag_profile,
    "zscore_features": zscore_features,
    "kmeans_regimes": kmeans_regimes,
    "k_sweep": k_sweep,
    "kmeans_assign": kmeans_assign,
    "silhouette_sweep": silhouette_sweep,
    "kmeans_fit": kmeans_fit,
    "lloyd_sweep": lloyd_sweep,
    "label_regimes": label_regimes,
    "next_day_target": next_day_target,
    "time_split": time_split,
    "label_index": label_index,
    "class_weights": class_weights,
    "rf_predictions": rf_predictions,
    "feature_importance": feature_importance,
    "forest_fit": forest_fit,
    "confusion_table": confusion_table,
    "class_metrics": class_metrics,
    "classification_metrics": classification_metrics,
    "decode_prediction": decode_prediction,
    "group_sum": group_sum,
    "table_scan": table_scan,
    "limit_rows": limit_rows,
}
