"""Incremental Silver, mergeable bars, as-of references, stored facts and versions by day."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tapeloom.operators.asof import asof_value
from tapeloom.operators.bar_states import BarStore, bar_states, bars_of_states, merge_states
from tapeloom.operators.bars import price_bars
from tapeloom.operators.features import FeatureConfig, silver_features
from tapeloom.operators.incremental import LateRows, SilverStore, empty_tail, late_rows, silver_increment
from tapeloom.operators.validity import valid_versions
from tapeloom.plans.series import Series
from tapeloom.plans.staging import stage
from tapeloom.sources.partitioned import YEAR, read_days, write_years

CONFIG = FeatureConfig(
    volume_exempt_tickers=("REF",), reference_ticker="REF", volatility_windows=(5, 10), ma_windows=(3, 7), rsi_window=4, correlation_window=10
)
BAR = "ticker string, trade_date date, adj_close double, volume long"
START = date(2020, 1, 1)


def made_bars(spark, days=90, seed=1):
    """REF trades on most days, A daily, B rarely, C from the middle on; some prices are NaN, NULL or constant."""
    draw = random.Random(seed)
    rows = []
    for n in range(days):
        for ticker, share in (("REF", 0.9), ("A", 1.0), ("B", 0.15), ("C", 1.0 if n > days // 2 else 0.0)):
            if draw.random() < share:
                price = 50.0 if 20 < n < 35 and ticker == "A" else draw.uniform(10, 90)
                price = float("nan") if n % 41 == 40 else None if n % 37 == 36 else price
                rows.append((ticker, START + timedelta(n), price, draw.choice([0, 5, None])))
    return spark.createDataFrame(rows, BAR)


def rows_of(df):
    shown = lambda v: f"{v:.9f}" if isinstance(v, float) else str(v)
    return sorted(tuple(shown(r[c]) for c in sorted(df.columns)) for r in df.collect())


def between(df, first, last):
    return df.where((F.col("trade_date") >= START + timedelta(first)) & (F.col("trade_date") < START + timedelta(last)))


@pytest.mark.parametrize("cuts", [(0, 90), (0, 30, 31, 60, 90), (0, 3, 6, 9, 90), (0, 45, 45, 90)])
def test_increments_equal_full_recomputation(spark, tmp_path, cuts):
    bars = made_bars(spark)
    store = SilverStore(spark, str(tmp_path / "silver"), CONFIG)
    for first, last in zip(cuts, cuts[1:]):
        store.append(between(bars, first, last))
    assert rows_of(store.read()) == rows_of(silver_features(bars, CONFIG))
    # no tail is longer than what the features reach back
    assert store.table.read("tail").groupBy("ticker").count().agg(F.max("count")).first()[0] <= CONFIG.reach


def test_an_increment_reads_the_tail_and_the_new_bars_alone(spark, tmp_path):
    bars = made_bars(spark)
    store = SilverStore(spark, str(tmp_path / "silver"), CONFIG)
    store.append(between(bars, 0, 80))
    fresh = str(tmp_path / "fresh")
    between(bars, 80, 90).write.parquet(fresh)
    tail, new = store.table.read("tail"), spark.read.parquet(fresh)
    rows, _ = silver_increment(tail, new, CONFIG)
    # the rows come from one staged frame, which was made of these files
    folders = {f.rsplit("/", 1)[0] for f in [*tail.inputFiles(), *new.inputFiles()]}
    silver = {f.rsplit("/", 1)[0] for f in store.read().inputFiles()}
    assert not folders & silver and not {f.rsplit("/", 1)[0] for f in rows.inputFiles()} & silver
    assert tail.count() < store.read().count() / 2


def test_chunked_series_in_increments(spark, tmp_path):
    """Ticks of one moment, a reference with repeated times, chunks smaller than an increment."""
    draw = random.Random(5)
    at = datetime(2020, 1, 1)
    ticks = []
    for n in range(400):
        at += timedelta(seconds=draw.choice([0, 0, 1, 5]))
        ticks.append((draw.choice(["REF", "A", "A", "B"]), at, n, draw.uniform(1, 9), 1))
    df = spark.createDataFrame(ticks, "ticker string, ts timestamp_ntz, seq long, price double, volume long")
    series = Series(order="ts", tie=("seq",), chunk_rows=40)
    # an increment begins with a new moment
    cuts = [0, *(next(n for n in range(m, 400) if ticks[n][1] > ticks[n - 1][1]) for m in (150, 157, 300)), 400]
    for match in ("exact", "asof"):
        config = replace(CONFIG, price_column="price", reference_match=match)
        whole = rows_of(silver_features(df, config, series))
        store = SilverStore(spark, str(tmp_path / match), config, series)
        for first, last in zip(cuts, cuts[1:]):
            store.append(df.where(F.col("seq").between(first, last - 1)))
        assert rows_of(store.read()) == whole
        store.amend(df.where(F.col("ts") >= ticks[cuts[2]][1]), ticks[cuts[2]][1])
        assert rows_of(store.read()) == whole


def test_late_rows_are_refused_and_amended(spark, tmp_path):
    bars = made_bars(spark)
    store = SilverStore(spark, str(tmp_path / "silver"), CONFIG)
    late_day = START + timedelta(50)
    held_back = (F.col("ticker") == "A") & (F.col("trade_date") == late_day)
    store.append(between(bars, 0, 70).where(~held_back))
    with pytest.raises(LateRows, match="A at 2020-02-20"):
        store.append(bars.where(held_back).unionByName(between(bars, 70, 90)))
    assert store.table.current().number == 1
    store.amend(bars.where(F.col("trade_date") >= late_day), late_day)
    assert rows_of(store.read()) == rows_of(silver_features(bars, CONFIG))
    # a late reference row would change the correlations of every ticker
    reference = spark.createDataFrame([("REF", START + timedelta(89), 1.0, 1)], BAR)
    tail = store.table.read("tail").where("ticker <> 'REF'")
    assert late_rows(tail, reference, CONFIG).count() == 1
    assert late_rows(empty_tail(bars), bars, CONFIG).count() == 0


def test_a_failed_increment_changes_nothing(spark, tmp_path):
    bars = made_bars(spark)
    store = SilverStore(spark, str(tmp_path / "silver"), CONFIG)
    store.append(between(bars, 0, 40))
    broken = between(bars, 40, 90).withColumn("adj_close", F.raise_error(F.lit("feed")).cast("double"))
    with pytest.raises(Exception, match="feed"):
        store.append(broken)
    store.append(between(bars, 40, 90))
    assert rows_of(store.read()) == rows_of(silver_features(bars, CONFIG))


TICK = "ticker string, ts timestamp_ntz, seq long, price double, size double"


def made_ticks(spark):
    draw = random.Random(2)
    rows = [
        (draw.choice(["A", "A", "B"]), datetime(2020, 1, 1) + timedelta(hours=draw.randint(0, 200)), n, draw.choice([None, 1.5, 2.5, 9.0]), float(draw.randint(1, 9)))
        for n in range(600)
    ]
    return spark.createDataFrame(rows, TICK)


def test_late_ticks_give_the_bars_of_all_ticks(spark, tmp_path):
    ticks = made_ticks(spark)
    store = BarStore(spark, str(tmp_path / "bars"), ["seq"])
    for n in range(4):
        store.append(ticks.where(F.pmod(F.col("seq") * 7, F.lit(4)) == n))
    want = rows_of(price_bars(ticks, ["seq"]))
    assert rows_of(store.read()) == want and store.table.read("states").count() > len(want)
    store.append(ticks.limit(0))
    store.compact()
    assert rows_of(store.read()) == want and store.table.read("states").count() == len(want)
    version = store.table.current().number
    assert store.touched(version).count() == 0
    more = spark.createDataFrame([("A", datetime(2020, 1, 2), 10_000, 99.0, 1.0), ("Z", datetime(2021, 1, 1), 1, 1.0, 2.0)], TICK)
    store.append(more)
    assert sorted((r.ticker, str(r.trade_date)) for r in store.touched(version).collect()) == [("A", "2020-01-02"), ("Z", "2021-01-01")]
    assert rows_of(store.read()) == rows_of(price_bars(ticks.union(more), ["seq"]))


def test_states_merge_in_any_order(spark):
    ticks = made_ticks(spark)
    parts = [bar_states(ticks.where(F.pmod("seq", F.lit(3)) == n), ["ts", "seq"], interval="1h", order="hour") for n in range(3)]
    want = rows_of(price_bars(ticks, ["ts", "seq"], interval="1h", order="hour"))
    names = {"key": "ticker", "order": "hour"}
    for a, b, c in ((0, 1, 2), (2, 0, 1)):
        first = merge_states(parts[a].union(parts[b]), **names)
        assert rows_of(bars_of_states(first.union(parts[c]), **names)) == want
    whole = ticks.withColumn("size", F.col("size").cast("int"))
    assert dict(bars_of_states(bar_states(whole, ["seq"])).dtypes)["volume"] == "bigint"


@pytest.mark.parametrize("chunk_rows", [1, 7, 50_000])
def test_asof_equals_a_search(spark, chunk_rows):
    draw = random.Random(3)
    times = [None, *range(40)]
    values = [(t, draw.choice([None, float(t)])) for t in draw.sample(range(2, 40), 12)] + [(None, 5.0)]
    rows = [(draw.choice(times) if n % 3 else 17, n) for n in range(200)]
    left = spark.createDataFrame(rows, "t int, n int").withColumn("_chunk", F.lit("mine"))
    right = spark.createDataFrame(values, "t int, v double")
    found = {r.n: r.newest for r in asof_value(left, right, "t", "v", "newest", chunk_rows).collect()}
    known = sorted((t, v) for t, v in values if t is not None)
    for t, n in rows:
        before = [v for at, v in known if t is not None and at <= t]
        assert found[n] == (before[-1] if before else None)
    assert asof_value(left.limit(0), right, "t", "v", "newest").count() == 0
    assert {r.newest for r in asof_value(left, right.limit(0), "t", "v", "newest").collect()} == {None}


def test_asof_reference_of_a_day_without_one(spark):
    bars = made_bars(spark)
    exact = silver_features(bars, CONFIG)
    asof = silver_features(bars, replace(CONFIG, reference_match="asof"))
    # the same but for the correlation, which now has a reference on every day after the first
    assert rows_of(asof.drop("corr_vix_10d")) == rows_of(exact.drop("corr_vix_10d"))
    assert rows_of(asof) != rows_of(exact)
    with pytest.raises(ValueError):
        replace(CONFIG, reference_match="nearest")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_by_year(spark):
    bars = made_bars(spark, days=800)
    name = "facts_by_year"
    spark.sql(f"drop table if exists {name}")
    try:
        write_years(bars, name, buckets=3)
        rows = read_days(spark, name, "2021-02-01", "2022-01-01")
        want = bars.where("trade_date >= '2021-02-01' and trade_date < '2022-01-01'")
        assert rows.columns == bars.columns and rows_of(rows) == rows_of(want)
        plan = plan_of(rows.withColumn("before", F.lag("adj_close").over(Window.partitionBy("ticker").orderBy("trade_date"))))
        assert "Exchange" not in plan and "Bucketed: true" in plan and YEAR in plan.split("PartitionFilters")[1].split("]")[0]
        both = rows.join(read_days(spark, name, "2020-01-01", "2021-01-01").groupBy("ticker").count(), "ticker")
        assert plan_of(both).count("Exchange hashpartitioning") == 0
        # one year again, with other values and fewer rows; the others stay
        year = bars.where("year(trade_date) = 2021 and ticker <> 'B'").withColumn("adj_close", F.lit(1.0))
        write_years(year, name)
        rest = bars.where("year(trade_date) <> 2021")
        assert rows_of(spark.read.table(name).drop(YEAR)) == rows_of(rest.unionByName(year))
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
        write_years(bars.limit(0), name)
        assert spark.read.table(name).count() == rest.count() + year.count()
    finally:
        spark.sql(f"drop table if exists {name}")


@pytest.mark.parametrize("period", ["year", "month"])
def test_versions_by_day(spark, period):
    d = date.fromisoformat
    versions = [
        ("A", 1, d("2019-12-31"), d("2020-03-01")),
        ("A", 2, d("2020-03-01"), d("2020-03-01")),
        ("A", 3, d("2020-03-01"), None),
        ("B", 4, d("2020-02-10"), d("2030-01-01")),
        ("C", 5, d("2021-01-01"), None),
        ("C", 6, None, None),
    ]
    dim = spark.createDataFrame(versions, "ticker string, sk int, effective_from date, effective_to date")
    facts = made_bars(spark).withColumn("sk", F.lit(-1)).unionByName(
        spark.createDataFrame([("A", None, 1.0, 1, -1), ("Z", START, 1.0, 1, -1)], f"{BAR}, sk int")
    )
    found = valid_versions(stage(facts), dim, period=period)
    assert found.columns.count("sk") == 1 and found.count() == facts.count()
    for r in found.collect():
        fit = [v for v in versions if v[0] == r.ticker and r.trade_date and v[2] and v[2] <= r.trade_date and (v[3] is None or r.trade_date < v[3])]
        assert [r.sk] == ([v[1] for v in fit] or [None])
    assert "CartesianProduct" not in plan_of(found) and "NestedLoop" not in plan_of(found)
    with pytest.raises(ValueError):
        valid_versions(facts, dim, period="week")
