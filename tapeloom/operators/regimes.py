"""Market regimes: standardised features, K-means, silhouette sweep, labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.plans.staging import stage

# Features of the clustering and names of the first three clusters.
CLUSTER_FEATURES = ("log_return", "volatility_20d", "rsi", "corr_vix_60d")
REGIME_LABELS = {0: "calm_low_vol", 1: "high_vol_momentum", 2: "high_vol_selloff"}
UNKNOWN_REGIME = "unknown"

RAW, SCALED = "features_raw", "features_scaled"


def standardise(
    df: DataFrame, features: Sequence[str] = CLUSTER_FEATURES
) -> tuple[DataFrame, StandardScalerModel]:
    """Rows without NULL/NaN features plus their raw and z-scored vectors.

    The fit reads ``df`` once before the result does: pass a table.
    """
    complete = df.dropna(subset=list(features))
    stages = [
        VectorAssembler(inputCols=list(features), outputCol=RAW),
        StandardScaler(inputCol=RAW, outputCol=SCALED, withMean=True, withStd=True),
    ]
    fitted = Pipeline(stages=stages).fit(complete)
    return fitted.transform(complete), fitted.stages[-1]


# partitions that a seeded fit sees: part of its parameters, not of the session
FIT_PARTITIONS = 16


def settle_rows(df: DataFrame, order: Sequence[str], partitions: int = FIT_PARTITIONS) -> DataFrame:
    """Same rows in the same partitions and order on every run.

    Seeded ML estimators draw per partition, so their result depends on the
    layout. Hashing the whole key spreads a hot ticker over all partitions. More
    data needs more ``partitions``; the number belongs to the fit's parameters.
    """
    return df.repartition(partitions, *order).sortWithinPartitions(*order)


def label_regimes(
    df: DataFrame,
    labels: Mapping[int, str] = REGIME_LABELS,
    cluster: str = "cluster",
) -> DataFrame:
    """``regime_label`` from the cluster id, ``unknown`` for ids without a name."""
    return df.withColumn("regime_label", _label(F.col(cluster), labels))


def _label(cluster: Column, labels: Mapping[int, str]) -> Column:
    if not labels:
        return F.lit(UNKNOWN_REGIME)
    names = F.create_map(*(F.lit(part) for pair in labels.items() for part in pair))
    return F.coalesce(F.try_element_at(names, cluster), F.lit(UNKNOWN_REGIME))


def labels_from_centres(
    model: KMeansModel, features: Sequence[str] = CLUSTER_FEATURES
) -> dict[int, str]:
    """Names by what the centres mean, whatever ids the fit has drawn.

    Lowest volatility is calm; of the others the highest return is momentum
    and the lowest is selloff. Works on z-scored centres, order is preserved.
    """
    return names_of_centres(model.clusterCenters(), features)


def names_of_centres(
    centres: Sequence[Sequence[float]], features: Sequence[str] = CLUSTER_FEATURES
) -> dict[int, str]:
    """``labels_from_centres`` for centres that are at hand."""
    ret, vol = features.index("log_return"), features.index("volatility_20d")
    centres = list(enumerate(centres))
    calm = min(centres, key=lambda c: c[1][vol])[0]
    rest = sorted((c for c in centres if c[0] != calm), key=lambda c: c[1][ret])
    labels = {calm: REGIME_LABELS[0]}
    if rest:
        labels[rest[-1][0]] = REGIME_LABELS[1]
    if len(rest) > 1:
        labels[rest[0][0]] = REGIME_LABELS[2]
    return labels


def _kmeans(k: int) -> KMeans:
    return KMeans(featuresCol=SCALED, predictionCol="cluster", k=k, seed=42)


def squared_distance(values: Sequence[Column], centre: Sequence[float]) -> Column:
    parts = [(v - F.lit(float(c))) * (v - F.lit(float(c))) for v, c in zip(values, centre)]
    return reduce(Column.__add__, parts)


def nearest_centre(scaled: DataFrame, centres: Sequence[Sequence[float]]) -> DataFrame:
    """``cluster``: the nearest of given centres in z-scored space, the lower id of equals."""
    vector = vector_to_array(SCALED)
    values = [vector[i] for i in range(len(centres[0]))]
    ranked = [
        F.struct(squared_distance(values, c).alias("distance"), F.lit(i).alias("id"))
        for i, c in enumerate(centres)
    ]
    return scaled.withColumn("cluster", F.array_min(F.array(*ranked)).getField("id"))


def silhouette(clustered: DataFrame) -> float:
    evaluator = ClusteringEvaluator(
        featuresCol=SCALED, predictionCol="cluster", metricName="silhouette"
    )
    return evaluator.evaluate(clustered)


@dataclass(frozen=True)
class RegimeRun:
    """Clustered rows with the fitted models and the fit's quality."""

    regimes: DataFrame
    model: KMeansModel
    scaler: StandardScalerModel
    silhouette: float
    labels: dict[int, str]
    partitions: int


def kmeans_regimes(
    silver: DataFrame,
    k: int = 4,
    features: Sequence[str] = CLUSTER_FEATURES,
    order: Sequence[str] = ("ticker", "trade_date"),
    labels: Mapping[int, str] | None = None,
    partitions: int = FIT_PARTITIONS,
) -> RegimeRun:
    """Cluster standardised features; names come from the centres or from ``labels``.

    Only keys and vectors are settled and cached for the fit and its silhouette; all
    other columns stay where they are and no vector is written.
    """
    scaled, scaler = standardise(silver, features)
    narrow = settle_rows(scaled.select(*order, SCALED), order, partitions).persist()
    try:
        model = _kmeans(k).fit(narrow)
        score = silhouette(model.transform(narrow))
    finally:
        narrow.unpersist()
    names = labels_from_centres(model, features) if labels is None else dict(labels)
    regimes = label_regimes(stage(model.transform(scaled).drop(RAW, SCALED)), names)
    return RegimeRun(regimes, model, scaler, score, names, partitions)


def k_sweep(
    silver: DataFrame,
    k_range: Sequence[int] = (2, 3, 4, 5, 6, 7, 8),
    features: Sequence[str] = CLUSTER_FEATURES,
    order: Sequence[str] = ("ticker", "trade_date"),
    partitions: int = FIT_PARTITIONS,
) -> DataFrame:
    """(k, silhouette) for every k, fitted on one cached standardised frame."""
    scaled, _ = standardise(silver, features)
    scaled = settle_rows(scaled.select(*order, SCALED), order, partitions).persist()
    try:
        scores = [(k, silhouette(_kmeans(k).fit(scaled).transform(scaled))) for k in k_range]
    finally:
        scaled.unpersist()
    return silver.sparkSession.createDataFrame(scores, "k int, silhouette double")
