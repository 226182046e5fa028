"""K-means by row keys in shared scans, quarantine of landed rows, counts taken during a write."""

from __future__ import annotations

import random

import numpy as np
import pytest
from helpers import bars
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from tapeloom.operators import regimes
from tapeloom.operators.facts import quality_profile
from tapeloom.operators.lloyd import keyed_regimes, keyed_start, keyed_sweep, sweep
from tapeloom.sources.landing import MALFORMED, bar_rules, read_checked
from tapeloom.sources.tables import read_table, write_profiled

FEATURES = ("log_return", "volatility_20d")


@pytest.fixture(scope="module")
def clouds(spark):
    draw = random.Random(7)
    rows = []
    for n in range(300):
        x, y = [(0.0, 0.0), (8.0, 8.0), (-8.0, 8.0)][n % 3]
        rows.append((f"T{n % 11}", n, draw.gauss(x, 1), draw.gauss(y, 1), n % 3))
    rows += [("T0", 1000, None, 1.0, 0), ("T0", 1001, float("nan"), 1.0, 0)]
    return spark.createDataFrame(rows, "ticker string, trade_date int, log_return double, volatility_20d double, cloud int")


def test_the_same_fit_for_any_partitioning(clouds):
    fits, ids = [], []
    for df in (clouds.repartition(4), clouds.repartition(8, "cloud"), clouds.repartition(16).orderBy(F.desc("trade_date"))):
        rows, fit = keyed_regimes(df, k=4, features=FEATURES)
        fits.append(fit)
        ids.append(sorted((r.ticker, r.trade_date, r.cluster, r.regime_label) for r in rows.collect()))
    for fit in fits[1:]:
        assert np.allclose(fit.centres, fits[0].centres, rtol=0, atol=1e-9) and fit.members == fits[0].members
    assert ids[0] == ids[1] == ids[2] and len(ids[0]) == 300


def test_a_sweep_equals_single_fits_and_finds_the_clouds(clouds):
    fits = {f.k: f for f in keyed_sweep(clouds, (2, 3, 4), FEATURES)}
    assert max(fits, key=lambda k: fits[k].silhouette) == 3
    scaled, _ = regimes.standardise(clouds, FEATURES)
    start = keyed_start(scaled, 4, features=2)
    assert len(start) == 4 and np.allclose(keyed_start(scaled.repartition(7), 4, features=2), start)
    for k, fit in [(3, fits[3]), (4, fits[4])]:
        alone = sweep(scaled, {k: start[:k]})[0]
        assert np.allclose(alone.centres, fit.centres, atol=1e-9) and alone.silhouette == pytest.approx(fit.silhouette)
        placed = regimes.nearest_centre(scaled, fit.centres)
        assert regimes.silhouette(placed) == pytest.approx(fit.silhouette, abs=1e-9)
        assert sum(fit.members) == 300
    by = keyed_regimes(clouds, 3, FEATURES)[0].groupBy("cloud", "cluster").count().collect()
    assert len(by) == 3 and {r.cluster for r in by} == {0, 1, 2}
    # as good as the built-in fit
    model = KMeans(featuresCol=regimes.SCALED, k=3, seed=1).fit(scaled)
    assert fits[3].silhouette >= regimes.silhouette(model.transform(scaled).withColumnRenamed("prediction", "cluster")) - 1e-6


def test_few_different_rows(spark):
    df = spark.createDataFrame([("A", n, 1.0 if n % 2 else 3.0, 2.0 + n % 2) for n in range(10)], "ticker string, trade_date int, log_return double, volatility_20d double")
    scaled, _ = regimes.standardise(df, FEATURES)
    assert len(keyed_start(scaled, 5, features=2)) == 2
    one, two = sweep(scaled, {1: [[0.0, 0.0]], 3: [[0.0, 0.0], [9.0, 9.0], [-1.0, 1.0]]})
    assert one.silhouette is None and one.members == [10]
    # an empty cluster keeps its centre and no member
    assert sum(two.members) == 10 and 0 in two.members


BAR = "ticker string, trade_date date, open double, high double, low double, close double, adj_close double, volume long"


def test_every_landed_row_is_kept_or_rejected(spark, tmp_path):
    good = "AAA,2024-01-02,1,2,0.5,1.5,1.5,100"
    lines = [
        good, good,
        "AAA,2024-01-03,1,2,0.5,1.5,1.5,n/a", "AAA,not a day,1,2,0.5,1.5,1.5,1", "AAA,2024-01-03,1",
        "AAA,2024-01-03,1,2,0.5,1.5,1.5,1,extra", ",2024-01-03,1,2,0.5,1.5,1.5,1",
        "AAA,2024-01-04,1,0.5,2,1.5,1.5,-1", "AAA,2024-01-04,1,2,0.5,1.5,1.5,-1", "AAA,2024-01-05,1,,0.5,1.5,1.5,",
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join(lines[:6]))
    (tmp_path / "in" / "b.csv").write_text("\n".join(lines[6:]))
    found = read_checked(spark, str(tmp_path / "in"), BAR, rules=bar_rules())
    assert found.counts == {"read": 10, "kept": 3, MALFORMED: 4, "no_key": 1, "crossed_range": 1, "negative_volume": 1}
    assert found.rows.columns == [f.split()[0] for f in BAR.split(", ")] and found.rows.count() == 3
    assert found.counts["read"] == found.rows.count() + found.rejected.count()
    reasons = {r.raw: r.reason for r in found.rejected.where("raw is not null").collect()}
    assert reasons == {line: MALFORMED for line in lines[2:6]}
    crossed = found.rejected.where("reason = 'crossed_range'").first()
    assert (crossed.high, crossed.low, crossed.volume) == (0.5, 2.0, -1)
    # a reader of the kept rows does not open the others
    assert all("_set=0" in f for f in found.rows.inputFiles()) or "PartitionFilters" in found.rows._jdf.queryExecution().toString()


def test_quarantine_of_json_and_of_nothing(spark, tmp_path):
    path = tmp_path / "x.json"
    path.write_text('{"ticker": "A", "n": 1}\n{"ticker": "A", "n": "x"}\n{broken\n{"ticker": "B", "n": 3}\n')
    found = read_checked(spark, str(path), "ticker string, n long", "json", {"large": F.col("n") > 2})
    assert found.counts == {"read": 4, "kept": 1, MALFORMED: 2, "large": 1}
    (tmp_path / "empty.csv").write_text("")
    none = read_checked(spark, str(tmp_path / "empty.csv"), BAR)
    assert none.counts["read"] == 0 and none.rows.count() == 0 and none.rejected.count() == 0
    with pytest.raises(ValueError):
        read_checked(spark, str(path), "_raw_line string")
    with pytest.raises(ValueError):
        read_checked(spark, str(path), "n long", rules={"kept": F.col("n") > 1})


def test_a_profile_comes_with_the_write(spark, tmp_path):
    df = bars(spark, AAA=[1.0, float("nan"), (2.0, None)], BBB=[None, 4.0]).withColumn("odd.name", F.col("adj_close"))
    names = ["ticker", "trade_date", "adj_close", "volume"]
    path = str(tmp_path / "t")
    found = write_profiled(df, path, [*names, "odd.name"], {"cheap": F.col("adj_close") < 3})
    got = {r.column_name: (r.null_count, r.nan_count, r.row_count) for r in found.collect()}
    assert got.pop("cheap") == (2, 0, 5) and got.pop("odd.name") == got["adj_close"]
    want = quality_profile(read_table(spark, path), names)
    assert got == {r.column_name: (r.null_count, r.nan_count, r.row_count) for r in want.collect()}
    # the profile reads no table
    assert "Scan parquet" not in found._jdf.queryExecution().executedPlan().toString()
    assert write_profiled(df.limit(0), path, names).select("row_count").distinct().collect()[0][0] == 0
