"""K-means whose result depends on the rows alone, for many k in shared scans.

**Start.** Centres are drawn one after the other, each row with a weight of its squared distance
to the nearest centre so far (all alike for the first). The draw takes the least ``-ln(u) / weight``, where u is a hash of
the row's key: no random generator, so no dependence on partitions. The first k centres of one
drawing serve every k of a sweep.

**Steps.** One pass assigns every row under all centre sets at once and sums the members of
each cluster, combined map-side into one row per centre. Sums are of whole numbers
(coordinates in units of ``UNIT``), so their order does not matter. An empty cluster keeps its centre.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.operators.regimes import (
    CLUSTER_FEATURES,
    SCALED,
    label_regimes,
    names_of_centres,
    nearest_centre,
    squared_distance,
    standardise,
)
from tapeloom.plans.staging import stage

# 2^-20: a sum of z-scores stays a long up to billions of rows, beyond it the query fails
UNIT = 1 << 20

Centres = Sequence[Sequence[float]]


@dataclass(frozen=True)
class Fit:
    """Centres of one k after ``steps`` passes, with the members of each and the mean silhouette."""

    k: int
    centres: list[list[float]]
    members: list[int]
    silhouette: float | None
    steps: int


def _values(features: int) -> list[Column]:
    return [F.col(f"x{i}") for i in range(features)]


def _narrow(scaled: DataFrame, features: int, keys: Sequence[str] = ()) -> DataFrame:
    vector = vector_to_array(SCALED)
    return scaled.select(*keys, *[vector[i].alias(f"x{i}") for i in range(features)])


def _nearest(values: Sequence[Column], centres: Centres) -> Column:
    ranked = [F.struct(squared_distance(values, c).alias("d"), F.lit(i).alias("id")) for i, c in enumerate(centres)]
    return F.array_min(F.array(*ranked)).getField("id")


def _memberships(rows: DataFrame, sets: Mapping[int, Centres], values: Sequence[Column]) -> DataFrame:
    """Every row once per centre set, with the set's k and the row's cluster."""
    found = [F.struct(F.lit(k).alias("k"), _nearest(values, c).alias("cluster")) for k, c in sets.items()]
    return rows.select(*values, F.inline(F.array(*found)))


def keyed_start(
    scaled: DataFrame, k: int, key: Sequence[str] = ("ticker", "trade_date"), features: int = len(CLUSTER_FEATURES)
) -> list[list[float]]:
    """``k`` centres drawn by the hash of each row's ``key``, fewer if there are fewer different rows."""
    values = _values(features)
    rows = stage(_narrow(scaled, features, key))
    centres: list[list[float]] = []
    for step in range(k):
        # 53 bits of a hash as a number in (0, 1)
        u = (F.shiftrightunsigned(F.xxhash64(*key, F.lit(step)), 11) + 0.5) / float(1 << 53)
        weight = F.array_min(F.array(*[squared_distance(values, c) for c in centres])) if centres else F.lit(1.0)
        drawn = rows.withColumn("_weight", weight).where("_weight > 0")
        rank = F.struct((-F.log(u) / F.col("_weight")).alias("rank"), *key)
        found = drawn.agg(F.min_by(F.array(*values), rank).alias("centre")).first()["centre"]
        if found is None:
            break
        centres.append([float(x) for x in found])
    return centres


def _sums(rows: DataFrame, sets: Mapping[int, Centres], values: Sequence[Column]) -> dict[tuple[int, int], tuple[int, list[float]]]:
    """Members and mean of every cluster of every set, from one scan."""
    whole = [F.sum(F.round(v * UNIT).cast("long")).alias(f"s{i}") for i, v in enumerate(values)]
    found = _memberships(rows, sets, values).groupBy("k", "cluster").agg(F.count(F.lit(1)).alias("n"), *whole)
    # one row per centre
    return {
        (r["k"], r["cluster"]): (r["n"], [r[f"s{i}"] / UNIT / r["n"] for i in range(len(values))]) for r in found.collect()
    }


def _silhouettes(rows: DataFrame, sets: Mapping[int, Centres], values: Sequence[Column]) -> dict[int, float | None]:
    """Mean silhouette by squared distances of every set: one scan for the clusters' sums, one for the rows."""
    norm = squared_distance(values, [0.0] * len(values))
    sums = [F.sum(v).alias(f"s{i}") for i, v in enumerate(values)]
    found = _memberships(rows, sets, values).groupBy("k", "cluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum(norm).alias("squares"), *sums
    )
    clusters: dict[int, list] = {k: [] for k in sets}
    for r in found.orderBy("k", "cluster").collect():
        clusters[r["k"]].append(r)
    scored = {k: clusters[k] for k in sets if len(clusters[k]) > 1}
    if not scored:
        return dict.fromkeys(sets)
    # a column of its own: each row's cluster is found once, not once for every use
    placed = rows.withColumns({f"own{k}": _nearest(values, sets[k]) for k in scored}).withColumn("norm", norm)
    means = {}
    for k, found in scored.items():
        own = F.col(f"own{k}")
        inside, outside, alone = F.lit(None), [], F.lit(False)
        for r in found:
            dot = sum((v * F.lit(r[f"s{i}"]) for i, v in enumerate(values)), F.lit(0.0))
            apart = F.col("norm") * r["n"] + F.lit(r["squares"]) - 2 * dot
            # to the other members of the own cluster, and to the nearest other cluster
            inside = F.when(own == r["cluster"], apart / max(r["n"] - 1, 1)).otherwise(inside)
            outside.append(F.when(own != r["cluster"], apart / r["n"]))
            alone = F.when(own == r["cluster"], r["n"] == 1).otherwise(alone)
        means |= {f"in{k}": inside, f"out{k}": F.array_min(F.array(*outside)), f"alone{k}": alone}
    placed = placed.withColumns(means)
    score = lambda k: F.when(F.col(f"alone{k}"), 0.0).otherwise(
        (F.col(f"out{k}") - F.col(f"in{k}")) / F.greatest(f"out{k}", f"in{k}")
    )
    found = placed.agg(*[F.avg(score(k)).alias(f"k{k}") for k in scored]).first()
    return {k: found[f"k{k}"] if k in scored else None for k in sets}


def sweep(
    scaled: DataFrame, starts: Mapping[int, Centres], steps: int = 20, tolerance: float = 1e-4
) -> list[Fit]:
    """Lloyd's algorithm for every k of ``starts`` in shared scans of ``scaled``.

    A k whose centres all move by ``tolerance`` or less is finished and takes no part in later scans.
    """
    features = len(next(iter(starts.values()))[0])
    values = _values(features)
    rows = stage(_narrow(scaled, features))
    sets = {k: [list(map(float, c)) for c in centres] for k, centres in starts.items()}
    taken, moving = dict.fromkeys(sets, 0), set(sets)
    for _ in range(steps):
        if not moving:
            break
        found = _sums(rows, {k: sets[k] for k in moving}, values)
        for k in sorted(moving):
            fresh = [found.get((k, i), (0, c))[1] for i, c in enumerate(sets[k])]
            if all(math.dist(a, b) <= tolerance for a, b in zip(sets[k], fresh)):
                moving.discard(k)
            sets[k], taken[k] = fresh, taken[k] + 1
    found = _sums(rows, sets, values)
    scores = _silhouettes(rows, sets, values)
    return [
        Fit(k, c, [found.get((k, i), (0, None))[0] for i in range(len(c))], scores[k], taken[k]) for k, c in sets.items()
    ]


def keyed_sweep(
    silver: DataFrame,
    k_range: Sequence[int] = (2, 3, 4, 5, 6, 7, 8),
    features: Sequence[str] = CLUSTER_FEATURES,
    key: Sequence[str] = ("ticker", "trade_date"),
    steps: int = 20,
) -> list[Fit]:
    """The sweep from centres drawn by row keys: the same for any partitioning of ``silver``."""
    scaled, _ = standardise(silver, features)
    scaled = stage(scaled.select(*key, SCALED))
    drawn = keyed_start(scaled, max(k_range), key, len(features))
    return sweep(scaled, {k: drawn[:k] for k in k_range}, steps)


def keyed_regimes(
    silver: DataFrame,
    k: int = 4,
    features: Sequence[str] = CLUSTER_FEATURES,
    key: Sequence[str] = ("ticker", "trade_date"),
    labels: Mapping[int, str] | None = None,
    steps: int = 20,
) -> tuple[DataFrame, Fit]:
    """(``silver`` rows with ``cluster`` and ``regime_label``, the fit); ids and centres come from row keys alone."""
    scaled, _ = standardise(silver, features)
    drawn = keyed_start(scaled, k, key, len(features))
    fit = sweep(scaled.select(SCALED), {k: drawn}, steps)[0]
    names = names_of_centres(fit.centres, features) if labels is None else dict(labels)
    placed = nearest_centre(scaled, fit.centres)
    return label_regimes(placed.drop("features_raw", SCALED), names), fit
