from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import bars, column, day
from tapeloom.functions.indicators import price_band
from tapeloom.operators.dims import (
    DIM_COLUMNS,
    calendar_dim,
    calendar_dim_for,
    current_state,
    inferred_members,
    latest_price,
    price_bands,
    scd2_apply,
    scd2_changes,
    scd2_initial,
    with_inferred_members,
)
from tapeloom.operators.facts import (
    fact_bars,
    flag_profile,
    new_fact_rows,
    quality_profile,
    referential_integrity,
)
from tapeloom.operators.features import illiquid_flag, silver_features
from tapeloom.plans.staging import stage

NAN = float("nan")


def test_calendar_matches_python(spark):
    rows = calendar_dim(spark).orderBy("full_date").collect()
    assert len(rows) == 5844
    by_key = {row["date_sk"]: tuple(row)[1:] for row in rows}
    assert by_key[20150101] == (date(2015, 1, 1), "Thursday", 1, 0, 1, "January", 1, 2015, False)
    assert by_key[20200229] == (date(2020, 2, 29), "Saturday", 29, 8, 2, "February", 1, 2020, True)
    assert by_key[20240630] == (date(2024, 6, 30), "Sunday", 30, 26, 6, "June", 2, 2024, True)
    assert by_key[20241231] == (date(2024, 12, 31), "Tuesday", 31, 53, 12, "December", 4, 2024, False)
    for before, row in zip(rows, rows[1:]):
        assert row["full_date"] - before["full_date"] == timedelta(days=1)
        if row["year"] == before["year"]:
            grown = row["week_of_year"] - before["week_of_year"]
            assert grown == (row["day_of_week"] == "Monday")


def test_calendar_of_the_data_covers_whole_years(spark):
    df = bars(spark, AAA=[1.0]).withColumn("trade_date", F.lit("2019-07-04").cast("date"))
    days = column(calendar_dim_for(df), "full_date", ("full_date",))
    assert (days[0], days[-1], len(days)) == (date(2019, 1, 1), date(2019, 12, 31), 365)


def test_price_bands(spark):
    df = bars(spark, AAA=[4.99, 5.0, 19.99, 20.0, None, NAN])
    assert column(price_bands(df), "market_cap_category") == [
        "microcap",
        "smallcap",
        "smallcap",
        "midcap_plus",
        "midcap_plus",
        "midcap_plus",
    ]
    own = price_band(F.col("adj_close"), ((5, "low"),), "high")
    assert column(df.withColumn("b", own), "b")[:2] == ["low", "high"]
    assert column(df.withColumn("b", price_band(F.col("adj_close"), ())), "b")[0] == "midcap_plus"


def test_latest_price_skips_null_and_nan(spark):
    df = bars(spark, AAA=[1.0, 2.0, None, NAN], BBB=[NAN], CCC=[3.0])
    assert [tuple(r) for r in latest_price(df).orderBy("ticker").collect()] == [
        ("AAA", 2.0),
        ("CCC", 3.0),
    ]


def test_initial_load(spark):
    dim = scd2_initial(bars(spark, BBB=[NAN, 30.0], AAA=[1.0, NAN], NEVER=[None, NAN]))
    assert dim.columns == DIM_COLUMNS
    assert [tuple(r) for r in dim.orderBy("ticker_sk").collect()] == [
        (1, "AAA", None, None, "microcap", day(0), None, True, False),
        (2, "BBB", None, None, "midcap_plus", day(0), None, True, False),
    ]
    assert dict(dim.dtypes)["ticker_sk"] == "int"


def state(spark, **categories):
    rows = list(categories.items())
    return spark.createDataFrame(rows, "ticker string, new_category string")


@pytest.fixture(scope="module")
def dim(spark):
    first = scd2_initial(bars(spark, AAA=[1.0], BBB=[10.0], CCC=[50.0]))
    named = first.withColumn("sector", F.lit("tech"))
    return stage(named)


def test_changes(spark, dim):
    changes = scd2_changes(dim, state(spark, AAA="smallcap", BBB="smallcap", NEW="microcap"))
    assert [(r["ticker"], r["market_cap_category"], r["new_category"]) for r in changes.collect()] == [
        ("AAA", "microcap", "smallcap")
    ]


def test_apply_twice_with_two_changes(spark, dim):
    first = stage(scd2_apply(dim, state(spark, AAA="smallcap", BBB="smallcap", CCC="microcap"), "2024-05-01"))
    rows = {r["ticker_sk"]: r for r in first.collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5]
    assert (rows[1]["effective_to"], rows[1]["is_current"]) == (date(2024, 5, 1), False)
    assert (rows[2]["effective_to"], rows[2]["is_current"]) == (None, True)
    assert (rows[4]["ticker"], rows[5]["ticker"]) == ("AAA", "CCC")
    assert (rows[4]["effective_from"], rows[4]["sector"]) == (date(2024, 5, 1), "tech")
    assert (rows[4]["is_current"], rows[4]["is_inferred"]) == (True, False)

    second = scd2_apply(first, state(spark, AAA="midcap_plus"), "2024-06-01").filter("ticker = 'AAA'")
    history = [
        (r["ticker_sk"], r["market_cap_category"], r["effective_from"], r["effective_to"], r["is_current"])
        for r in second.orderBy("ticker_sk").collect()
    ]
    assert history == [
        (1, "microcap", day(0), date(2024, 5, 1), False),
        (4, "smallcap", date(2024, 5, 1), date(2024, 6, 1), False),
        (6, "midcap_plus", date(2024, 6, 1), None, True),
    ]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.dictionaries(
            st.sampled_from(["AAA", "BBB", "CCC", "XXX"]),
            st.sampled_from(["microcap", "smallcap", "midcap_plus"]),
            min_size=1,
        ),
        min_size=1,
        max_size=2,
    )
)
def test_scd2_invariants(spark, dim, states):
    for n, categories in enumerate(states):
        new = state(spark, **categories)
        before = dim.count()
        changed = scd2_changes(dim, new).count()
        dim = stage(scd2_apply(dim, new, date(2024, 5, 1) + timedelta(days=n)))
        assert dim.count() == before + changed
        assert dim.select("ticker_sk").distinct().count() == dim.count()
        current = dim.filter("is_current").groupBy("ticker").count()
        assert current.filter("count <> 1").isEmpty() and current.count() == 3
        assert dim.filter("is_current <> isnull(effective_to)").isEmpty()
        again = scd2_apply(dim, new, "2024-07-01")
        assert sorted(map(str, again.collect())) == sorted(map(str, dim.collect()))


def test_inferred_members(spark, dim):
    facts = bars(spark, ZZZ=[1.0, 2.0], AAA=[1.0], MMM=[1.0])
    skeletons = inferred_members(facts, dim, "2024-05-01").orderBy("ticker_sk").collect()
    assert [tuple(r) for r in skeletons] == [
        (4, "MMM", None, None, None, date(2024, 5, 1), None, True, True),
        (5, "ZZZ", None, None, None, date(2024, 5, 1), None, True, True),
    ]
    assert inferred_members(bars(spark, AAA=[1.0]), dim, "2024-05-01").isEmpty()


def test_first_key_of_an_empty_dimension_is_one(spark, dim):
    skeletons = inferred_members(bars(spark, AAA=[1.0]), dim.filter("false"), "2024-05-01")
    assert [r["ticker_sk"] for r in skeletons.collect()] == [1]


def test_inferred_member_changes_only_null_safely(spark, dim):
    full = stage(with_inferred_members(bars(spark, MMM=[1.0]), dim, "2024-05-01"))
    new = state(spark, MMM="smallcap")
    assert scd2_changes(full, new).isEmpty()
    assert [r["ticker"] for r in scd2_changes(full, new, null_safe=True).collect()] == ["MMM"]


@pytest.fixture(scope="module")
def star(spark):
    df = bars(spark, AAA=[1.0, 2.0, 3.0], NEW=[4.0])
    df = df.select("ticker", "trade_date", *(F.col("adj_close").alias(c) for c in ("open", "high", "low", "close")), "adj_close", "volume")
    silver = stage(silver_features(df))
    dim = stage(scd2_initial(silver.filter("ticker = 'AAA'")))
    calendar = calendar_dim(spark, "2024-01-01", "2024-01-02")
    return silver, dim, calendar, stage(fact_bars(silver, dim, calendar, "2024-05-01"))


def test_fact_has_both_keys_and_drops_days_outside_the_calendar(star):
    _, _, _, fact = star
    assert fact.columns == [
        "ticker_sk",
        "date_sk",
        "ticker",
        "trade_date",
        "open",
        "high",
        "low",
        "close",
        "adj_close",
        "volume",
        "is_illiquid",
        "log_return",
        "volatility_20d",
        "volatility_60d",
        "ma_20",
        "ma_50",
        "ma_200",
        "rsi",
        "corr_vix_60d",
    ]
    keys = sorted((r["ticker"], r["ticker_sk"], r["date_sk"]) for r in fact.collect())
    assert keys == [("AAA", 1, 20240101), ("AAA", 1, 20240102), ("NEW", 2, 20240101)]


def test_fact_uses_the_current_version(spark, star):
    silver, dim, calendar, _ = star
    newer = stage(scd2_apply(dim, state(spark, AAA="midcap_plus"), "2024-03-01"))
    fact = fact_bars(silver, newer, calendar, "2024-05-01").filter("ticker = 'AAA'")
    assert {r["ticker_sk"] for r in fact.collect()} == {2}


def test_integrity(star):
    silver, dim, calendar, fact = star
    full = with_inferred_members(silver, dim, "2024-05-01")
    assert tuple(referential_integrity(fact, full, calendar).first()) == (0, 0, True)
    short = calendar.filter("day_of_month = 1")
    assert tuple(referential_integrity(fact, dim, short).first()) == (1, 1, False)


def test_append_only_new_rows(star):
    _, _, _, fact = star
    stored = fact.filter("ticker = 'NEW' or trade_date = '2024-01-01'")
    assert [(r["ticker"], r["date_sk"]) for r in new_fact_rows(fact, stored).collect()] == [
        ("AAA", 20240102)
    ]


def test_quality_profile(spark):
    df = bars(spark, AAA=[1.0, None, NAN, (NAN, None)])
    rows = {r["column_name"]: r for r in quality_profile(df, ["ticker", "adj_close", "volume"]).collect()}
    assert {n: (r["null_count"], r["nan_count"], r["row_count"]) for n, r in rows.items()} == {
        "ticker": (0, 0, 4),
        "adj_close": (1, 2, 4),
        "volume": (1, 0, 4),
    }


def test_flag_profile(spark):
    df = bars(spark, **{"AAA": [(1.0, 0), (1.0, 0), (1.0, 5)], "^VIX": [(1.0, 0)]})
    assert tuple(flag_profile(illiquid_flag(df)).first()) == (2, 2, 0)
