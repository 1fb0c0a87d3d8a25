"""K-means and diagonal Gaussian mixtures on array<double> features."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.vectors import literal_vector, squared_distance
from cohortlens.session import kept


@dataclass(frozen=True)
class Centres:
    """Fitted k-means: label i belongs to ``points[i]``."""

    points: tuple[tuple[float, ...], ...]
    inertia: float | None = None

    def label(self) -> Column:
        """Index of the nearest centre; the lower index wins ties."""
        distances = [
            F.struct(
                squared_distance(F.col("features"), literal_vector(p)).alias("distance"),
                F.lit(i).alias("label"),
            )
            for i, p in enumerate(self.points)
        ]
        return F.array_min(F.array(*distances))["label"]

    def reordered(self, order: list[int]) -> "Centres":
        return Centres(tuple(self.points[i] for i in order), self.inertia)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "Centres":
        raw = json.loads(text)
        return Centres(tuple(tuple(p) for p in raw["points"]), raw["inertia"])


def fit_kmeans(
    points: DataFrame, k: int, seed: int = 42, order_by: str | None = None
) -> Centres:
    """K-means with numbered clusters made repeatable.

    Cluster numbers of a fit are arbitrary, so clusters are renumbered by the
    mean of ``order_by`` (falling), or by their centres without it.
    """
    estimator = KMeans(k=k, seed=seed, maxIter=300, tol=1e-4, featuresCol="vector")
    with kept(points.select(array_to_vector("features").alias("vector"))) as vectors:
        model = estimator.fit(vectors)
        centres = Centres(
            tuple(tuple(float(x) for x in c) for c in model.clusterCenters()),
            float(model.summary.trainingCost),
        )
    return in_order(points, centres, order_by)


def in_order(points: DataFrame, centres: Centres, order_by: str | None) -> Centres:
    """Clusters renumbered by the mean of ``order_by`` (falling), or by their centres without it."""
    if order_by is None:
        order = sorted(range(len(centres.points)), key=lambda i: centres.points[i], reverse=True)
    else:
        means = (
            points.groupBy(centres.label().alias("label"))
            .agg(F.avg(order_by).alias("mean"))
            .collect()  # one row per cluster
        )
        by_label = {r["label"]: r["mean"] for r in means}
        order = sorted(
            range(len(centres.points)),
            key=lambda i: (-(by_label.get(i) if by_label.get(i) is not None else -np.inf), i),
        )
    return centres.reordered(order)


def assign(points: DataFrame, model) -> DataFrame:
    """Adds ``cluster``; never fits."""
    return points.withColumn("cluster", model.label())


def inertia(points: DataFrame, centres: Centres) -> DataFrame:
    """One row: sum of squared distances to the nearest centre."""
    distances = [squared_distance(F.col("features"), literal_vector(p)) for p in centres.points]
    return points.agg(F.sum(F.array_min(F.array(*distances))).alias("inertia"))


@dataclass(frozen=True)
class DiagonalMixture:
    """Fitted mixture; ``history`` is the mean log-likelihood per round."""

    weights: tuple[float, ...]
    means: tuple[tuple[float, ...], ...]
    variances: tuple[tuple[float, ...], ...]
    history: tuple[float, ...] = ()

    def label(self) -> Column:
        """Index of the component with the highest density at ``features``."""
        scores = []
        for i, (w, mean, variance) in enumerate(zip(self.weights, self.means, self.variances)):
            constant = np.log(w) - 0.5 * np.sum(np.log(2 * np.pi * np.asarray(variance)))
            spread = F.zip_with(
                F.zip_with(F.col("features"), literal_vector(mean), lambda x, m: (x - m) * (x - m)),
                literal_vector(variance),
                lambda square, v: square / v,
            )
            half = F.aggregate(spread, F.lit(0.0), lambda total, x: total + x) / 2
            scores.append(
                F.struct((half - F.lit(float(constant))).alias("cost"), F.lit(i).alias("label"))
            )
        return F.array_min(F.array(*scores))["label"]


FLOOR = 1e-6  # added to each variance, as a regulariser


def log_densities(x, weights, means, variances):
    """Rows x components: log(weight * density)."""
    constant = np.log(weights) - 0.5 * np.log(2 * np.pi * variances).sum(axis=1)
    precision = 1.0 / variances
    quadratic = (
        (x * x) @ precision.T - 2 * x @ (means * precision).T + (means * means * precision).sum(axis=1)
    )
    return constant - 0.5 * quadratic


def _expectation(points: DataFrame, weights, means, variances):
    """Sums of responsibilities, moments and log-likelihood over all rows.

    Each task reduces its rows to one row per component; Spark adds those up.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k, d = means.shape
        total = np.zeros((k, 2 + 2 * d))
        for batch in batches:
            if batch.empty:
                continue
            x = np.vstack(batch["features"].to_numpy())
            joint = log_densities(x, weights, means, variances)
            top = joint.max(axis=1, keepdims=True)
            norm = top + np.log(np.exp(joint - top).sum(axis=1, keepdims=True))
            share = np.exp(joint - norm)
            total[:, 0] += share.sum(axis=0)
            total[0, 1] += norm.sum()
            total[:, 2 : 2 + d] += share.T @ x
            total[:, 2 + d :] += share.T @ (x * x)
        yield pd.DataFrame(
            [(i, place, value) for i in range(k) for place, value in enumerate(total[i])],
            columns=["component", "place", "value"],
        )

    k, d = means.shape
    summed = (
        points.select("features")
        .mapInPandas(partial, "component int, place int, value double")
        .groupBy("component", "place")
        .agg(F.sum("value").alias("value"))
        .collect()  # components x (2 + 2 * dimensions) rows
    )
    total = np.zeros((k, 2 + 2 * d))
    for row in summed:
        total[row["component"], row["place"]] = row["value"]
    return total


def fit_diagonal_mixture(
    points: DataFrame, n_components: int, seed: int = 42, max_iter: int = 100, tol: float = 1e-3
) -> DiagonalMixture:
    """Expectation maximisation with diagonal covariances, started from k-means."""
    with kept(points.select("features")) as rows:
        return _fit_mixture(rows, n_components, seed, max_iter, tol)


def _moments(points: DataFrame, label: str):
    """Share, mean and variance of each group, in order of the label."""
    d = points.agg(F.max(F.size("features"))).first()[0]
    rows = (
        points.groupBy(label)
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.avg(F.col("features")[i]).alias(f"m{i}") for i in range(d)],
            *[F.var_pop(F.col("features")[i]).alias(f"v{i}") for i in range(d)],
        )
        .orderBy(label)
        .collect()  # one row per component
    )
    n = sum(r["n"] for r in rows)
    weights = np.array([r["n"] / n for r in rows])
    means = np.array([[r[f"m{i}"] for i in range(d)] for r in rows])
    variances = np.array([[r[f"v{i}"] for i in range(d)] for r in rows]) + FLOOR
    return n, [r[label] for r in rows], weights, means, variances


def maximised(total: np.ndarray):
    """New weights, means and variances from the sums of one expectation."""
    d = (total.shape[1] - 2) // 2
    share = total[:, :1] + 10 * np.finfo(float).eps
    means = total[:, 2 : 2 + d] / share
    variances = np.maximum(total[:, 2 + d :] / share - means**2, 0.0) + FLOOR
    return (share / share.sum()).ravel(), means, variances


def mixture_round(points: DataFrame, label: str) -> DataFrame:
    """(label, share, mean_sum, variance_sum) after one round from the groups' moments."""
    _, labels, *start = _moments(points, label)
    weights, means, variances = maximised(_expectation(points, *start))
    rows = [
        (int(c), float(w), float(m.sum()), float(v.sum()))
        for c, w, m, v in zip(labels, weights, means, variances)
    ]
    return points.sparkSession.createDataFrame(
        rows, f"{label} long, share double, mean_sum double, variance_sum double"
    )


def _fit_mixture(
    points: DataFrame, n_components: int, seed: int, max_iter: int, tol: float
) -> DiagonalMixture:
    centres = fit_kmeans(points, n_components, seed)
    n, _, weights, means, variances = _moments(assign(points, centres), "cluster")
    history: list[float] = []
    for _ in range(max_iter):
        total = _expectation(points, weights, means, variances)
        history.append(float(total[0, 1] / n))
        weights, means, variances = maximised(total)
        if len(history) > 1 and abs(history[-1] - history[-2]) < tol:
            break
    by_weight = np.argsort(-weights, kind="stable")
    return DiagonalMixture(
        tuple(float(w) for w in weights[by_weight]),
        tuple(tuple(float(x) for x in means[i]) for i in by_weight),
        tuple(tuple(float(x) for x in variances[i]) for i in by_weight),
        tuple(history),
    )
