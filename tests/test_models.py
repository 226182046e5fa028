import math
import random
from datetime import date, timedelta

import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from helpers import close_to, column, day
from tapeloom.operators import classify, regimes
from tapeloom.plans.staging import stage
from tapeloom.sources.runs import load_model, save_model

FEATURES = ["log_return", "volatility_20d"]
NAN = float("nan")


@pytest.fixture(scope="module")
def blobs(spark):
    """Three separated clouds: calm, rising, falling."""
    rng = random.Random(5)
    rows = []
    for ticker in ("AAA", "BBB", "^VIX"):
        for n in range(90):
            ret, vol = [(0.0, 0.1), (2.0, 2.0), (-2.0, 2.5)][n % 3]
            rows.append((ticker, day(n), ret + rng.gauss(0, 0.05), vol + rng.gauss(0, 0.05)))
    schema = "ticker string, trade_date date, log_return double, volatility_20d double"
    return stage(spark.createDataFrame(rows, schema))


def test_standardise_drops_incomplete_rows(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0), (3.0, 6.0), (5.0, 10.0), (None, 1.0), (NAN, 1.0)],
        "log_return double, volatility_20d double",
    )
    scaled, model = regimes.standardise(df, FEATURES)
    rows = scaled.select(vector_to_array(regimes.SCALED).alias("z")).collect()
    assert sorted(r["z"][0] for r in rows) == pytest.approx([-1.0, 0.0, 1.0])
    assert list(model.mean) == [3.0, 6.0] and list(model.std) == pytest.approx([2.0, 4.0])


def test_kmeans_finds_and_names_the_clouds(blobs):
    run = regimes.kmeans_regimes(blobs, k=3, features=FEATURES)
    assert run.silhouette > 0.8
    named = run.regimes.withColumn(
        "expected",
        F.when(F.col("volatility_20d") < 1, "calm_low_vol")
        .when(F.col("log_return") > 0, "high_vol_momentum")
        .otherwise("high_vol_selloff"),
    )
    assert named.count() == blobs.count()
    assert named.filter("regime_label <> expected").isEmpty()
    assert regimes.RAW not in named.columns and "cluster" in named.columns


def test_kmeans_does_not_depend_on_the_input_layout(blobs):
    def clusters(df):
        run = regimes.kmeans_regimes(df, k=4, features=FEATURES)
        return column(run.regimes, "cluster")

    assert clusters(blobs) == clusters(blobs.orderBy(F.desc("log_return")).repartition(5))


def test_nearest_centre_prefers_the_lower_id_of_equals(spark):
    rows = spark.createDataFrame([(Vectors.dense(0.0, 0.0),), (Vectors.dense(0.9, 0.0),)], [regimes.SCALED])
    found = regimes.nearest_centre(rows, [(5.0, 5.0), (1.0, 0.0), (-1.0, 0.0)])
    assert [r["cluster"] for r in found.collect()] == [1, 1]


def test_fixed_labels_leave_other_clusters_unknown(blobs):
    run = regimes.kmeans_regimes(blobs, k=4, features=FEATURES, labels=regimes.REGIME_LABELS)
    rows = run.regimes.select("cluster", "regime_label").distinct().collect()
    names = {r["cluster"]: r["regime_label"] for r in rows}
    assert names == {**regimes.REGIME_LABELS, 3: "unknown"}


def test_label_map_without_names(spark):
    assert column(regimes.label_regimes(spark.range(1).withColumn("cluster", F.lit(0)), {}), "regime_label", ("id",)) == ["unknown"]


def test_k_sweep_prefers_the_true_count(blobs):
    scores = {r["k"]: r["silhouette"] for r in regimes.k_sweep(blobs, (2, 3, 4), FEATURES).collect()}
    assert list(scores) == [2, 3, 4] and max(scores, key=scores.get) == 3


def labelled(spark, **series):
    rows = [(t, day(n), name, 1.0) for t, names in series.items() for n, name in enumerate(names)]
    return spark.createDataFrame(rows, "ticker string, trade_date date, regime_label string, x double")


def test_target_is_the_next_kept_row(spark):
    df = labelled(spark, AAA=["a", "b", "c"], BBB=["z"])
    out = classify.next_day_target(df, ["x"])
    assert column(out, "next_day_regime") == ["b", "c"]
    gap = classify.next_day_target(df.filter("regime_label <> 'b'"), ["x"])
    assert column(gap, "next_day_regime") == ["c"]


def test_target_drops_incomplete_features(spark):
    df = labelled(spark, AAA=["a", "b", "c"]).withColumn("x", F.when(F.col("regime_label") == "a", NAN).otherwise(1.0))
    assert column(classify.next_day_target(df, ["x"]), "regime_label") == ["b"]


def test_split_border_belongs_to_training(spark):
    df = labelled(spark, **{"AAA": "abcd", "^VIX": "abcd"})
    train, test = classify.time_split(df, day(1))
    assert column(train, "regime_label") == ["a", "b"] and column(test, "regime_label") == ["c", "d"]
    assert {r["ticker"] for r in train.union(test).collect()} == {"AAA"}


@pytest.fixture(scope="module")
def targets(spark):
    names = ["calm"] * 6 + ["up"] * 2 + ["down"] * 2 + ["rare"]
    return spark.createDataFrame([(n,) for n in names], "next_day_regime string")


def test_label_index_equals_string_indexer(targets):
    index = {r["next_day_regime"]: r["label"] for r in classify.label_index(targets).collect()}
    labels = StringIndexer(inputCol="next_day_regime", outputCol="label").fit(targets).labels
    assert index == {name: float(i) for i, name in enumerate(labels)}


def test_class_weights(targets):
    rows = classify.class_weights(classify.label_index(targets)).orderBy("label").collect()
    close_to([r["class_weight"] for r in rows], [11 / 24, 11 / 8, 11 / 8, 11 / 4])


def test_unseen_label_is_skipped(spark, targets):
    index = classify.label_index(targets)
    test = spark.createDataFrame([("up",), ("never seen",)], "next_day_regime string")
    assert column(classify.attach_labels(test, index), "next_day_regime", ("label",)) == ["up"]


def test_decode(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (7.0,)], "prediction double")
    out = classify.decode_prediction(df, ["calm", "up"])
    assert column(out, "predicted_regime", ("prediction",)) == ["calm", "up", None]


def test_metrics_equal_spark_evaluator(spark):
    rng = random.Random(3)
    # class 3 is never predicted, class 4 never true
    rows = [(float(rng.choice([0, 0, 0, 1, 2, 3])), float(rng.choice([0, 0, 1, 2, 4]))) for _ in range(300)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    metrics = classify.classification_metrics(classify.confusion_table(df)).first()
    evaluator = MulticlassClassificationEvaluator()
    for name, theirs in {
        "accuracy": "accuracy",
        "f1_weighted": "f1",
        "weighted_precision": "weightedPrecision",
        "weighted_recall": "weightedRecall",
    }.items():
        assert metrics[name] == pytest.approx(evaluator.evaluate(df, {evaluator.metricName: theirs}), abs=1e-12)
    per_class = {r["label"]: r for r in classify.class_metrics(classify.confusion_table(df)).collect()}
    assert per_class[3.0]["precision"] == 0.0 and per_class[4.0]["support"] == 0
    assert per_class[0.0]["recall"] == pytest.approx(
        evaluator.evaluate(df, {evaluator.metricName: "recallByLabel", evaluator.metricLabel: 0.0})
    )


@pytest.fixture(scope="module")
def forest(blobs):
    rows = regimes.kmeans_regimes(blobs, k=3, features=FEATURES).regimes
    return classify.rf_predictions(rows, FEATURES, train_end=day(59), trees=10)


def test_forest_learns_the_cycle(forest):
    assert forest.predictions.columns == [
        "ticker",
        "trade_date",
        "regime_label",
        "next_day_regime",
        "predicted_regime",
        "prediction",
        "label",
        *FEATURES,
    ]
    assert forest.metrics.first()["accuracy"] == 1.0
    assert forest.predictions.filter("predicted_regime <> next_day_regime").isEmpty()
    assert forest.predictions.filter(F.col("trade_date") <= F.lit(day(59))).isEmpty()
    assert {r["ticker"] for r in forest.predictions.collect()} == {"AAA", "BBB"}
    importance = {r["feature"]: r["importance"] for r in forest.importance.collect()}
    assert set(importance) == set(FEATURES) and math.isclose(sum(importance.values()), 1.0)


def test_models_survive_a_round_trip(spark, blobs, forest, tmp_path):
    save_model(forest.model, str(tmp_path / "forest"))
    save_model(forest.model, str(tmp_path / "forest"))
    again = load_model(RandomForestClassificationModel, str(tmp_path / "forest"))
    assert again.getNumTrees == forest.model.getNumTrees
    run = regimes.kmeans_regimes(blobs, k=3, features=FEATURES)
    save_model(run.model, str(tmp_path / "kmeans"))
    loaded = load_model(KMeansModel, str(tmp_path / "kmeans"))
    scaled = run.scaler.transform(
        regimes.VectorAssembler(inputCols=FEATURES, outputCol=regimes.RAW).transform(blobs)
    )
    assert column(loaded.transform(scaled), "cluster") == column(run.regimes, "cluster")


def test_forest_takes_more_classes_than_a_hundred(spark):
    from tapeloom.operators.classify import rf_predictions

    rows = [
        (f"T{c:03d}", date(2024, 1, 1) + timedelta(days=d), f"class{c:03d}", float(c))
        for c in range(120)
        for d in range(6)
    ]
    frame = spark.createDataFrame(rows, "ticker string, trade_date date, regime_label string, level double")
    run = rf_predictions(frame, ["level"], train_end="2024-01-03", exclude=(), trees=2, depth=2)
    assert run.labels.count() == 120
    assert run.predictions.where("predicted_regime is not null").count() == 240


def test_split_by_timestamp_and_other_key(spark):
    from tapeloom.operators.classify import time_split

    frame = spark.sql(
        "select * from values ('a', timestamp_ntz'2024-12-31 10:00:00'), ('a', timestamp_ntz'2025-01-01 00:00:00'),"
        " ('x', timestamp_ntz'2024-01-01 00:00:00') as t(name, at)"
    )
    train, test = time_split(frame, "2024-12-31", ["x"], day="at", key="name")
    assert [train.count(), test.count()] == [1, 1]


def test_decoding_beyond_the_known_names(spark):
    from tapeloom.operators.classify import decode_prediction

    rows = spark.createDataFrame([(0.0,), (1.0,), (5.0,), (None,)], "prediction double")
    decoded = decode_prediction(rows, ["a", "b"]).collect()
    assert [r["predicted_regime"] for r in decoded] == ["a", "b", None, None]


def test_seeded_fit_does_not_depend_on_the_session(spark):
    from tapeloom.operators.regimes import kmeans_regimes

    rows = [
        (f"T{k % 9}", date(2024, 1, 1) + timedelta(days=k), (k * 37 % 11) / 10, (k * 13 % 7) / 5, float(k % 100), (k % 3) / 3)
        for k in range(400)
    ]
    names = "ticker string, trade_date date, log_return double, volatility_20d double, rsi double, corr_vix_60d double"
    frame, seen = spark.createDataFrame(rows, names), []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (3, 7):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            run = kmeans_regimes(frame)
            seen.append((run.silhouette, sorted(map(tuple, run.regimes.select("ticker", "trade_date", "cluster").collect()))))
            assert run.partitions == 16 and "features_scaled" not in run.regimes.columns
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1]
