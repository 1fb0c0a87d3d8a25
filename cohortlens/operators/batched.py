"""Many k-means and mixture fits at once: one scan of the points for each round of all of them.

Every task adds up, for each model and cluster, what its rows contribute; Spark adds
the tasks' sums, and only those (a few numbers for each cluster) reach the driver. A
model that has settled leaves the round. A cluster that loses all its points is put
where a point is farthest from its centre.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.clustering import (
    FLOOR,
    Centres,
    DiagonalMixture,
    maximised,
)
from cohortlens.session import kept

#: Points, in hashed order, among which the first centres are chosen; fits count all points.
START_POINTS = 4096
START_VALUES = 500_000


@dataclass(frozen=True)
class Fit:
    """What to fit: ``kind`` is kmeans or mixture."""

    kind: str
    k: int
    seed: int = 42


def _first_centres(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Far apart from each other: each drawn by its squared distance to those before."""
    rng = np.random.default_rng(seed)
    picked = [int(rng.integers(len(x)))]
    gap = ((x - x[picked[0]]) ** 2).sum(1)
    for _ in range(k - 1):
        if gap.sum() > 0:
            # the best of a few draws
            draws = rng.choice(len(x), 2 + int(np.log(k)), p=gap / gap.sum())
            new = [np.minimum(gap, ((x - x[i]) ** 2).sum(1)) for i in draws]
            best = int(np.argmin([g.sum() for g in new]))
            picked.append(int(draws[best]))
            gap = new[best]
        else:
            picked.append(picked[-1])
    return x[picked].copy()


def _summed(rows: DataFrame, task) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """By model and cluster the sum of the parts that ``task`` yields, and the part of greatest ``far``."""
    found = (
        rows.mapInArrow(task, "model int, cluster int, part array<double>, far double")
        .groupBy("model", "cluster")
        .agg(
            vector_to_array(Summarizer.sum(array_to_vector("part"))).alias("part"),
            F.max_by("part", "far").alias("spot"),
        )
        .collect()  # a row for each cluster of each model, and one for each model
    )
    return {(r["model"], r["cluster"]): (np.array(r["part"]), r["spot"]) for r in found}


def _matrices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    for batch in batches:
        x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        for at in range(0, len(x), 8192):
            yield x[at : at + 8192]


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    model, cluster, part, far = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(model, pa.int32()),
            pa.array(cluster, pa.int32()),
            pa.array(part, pa.list_(pa.float64())),
            pa.array(far, pa.float64()),
        ],
        names=["model", "cluster", "part", "far"],
    )


def _nearest(gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the least of each column, the first on a tie, and its value."""
    label, least = np.zeros(gap.shape[1], np.int64), gap[0].copy()
    for c in range(1, len(gap)):
        less = gap[c] < least
        label[less] = c
        np.copyto(least, gap[c], where=less)
    return label, least


def _lloyd(rows: DataFrame, centres: dict[int, np.ndarray], tol: float, most: int):
    """Centres, sum of squared distances, and (n, sum, squared distances) by cluster of each model."""
    d = next(iter(centres.values())).shape[1]
    done: dict[int, tuple] = {}
    active = dict(centres)
    for step in range(most):
        stacked = np.vstack(list(active.values()))
        bounds = np.cumsum([0] + [len(c) for c in active.values()])
        names = list(active)

        def partial(batches, stacked=stacked, bounds=bounds, names=names):
            sums = np.zeros((len(stacked), 2 + d))
            far = np.full(len(names), -1.0)
            far_x = np.zeros((len(names), d))
            for x, own, near in _owners(batches, stacked, bounds, d):
                sums[:, :-1] += own @ np.hstack([np.ones((len(x), 1)), x])
                for i in range(len(names)):
                    mine = slice(bounds[i], bounds[i + 1])
                    sums[mine, -1] += own[mine] @ near[i]
                    if near[i].max() > far[i]:
                        far[i], far_x[i] = near[i].max(), x[near[i].argmax()]
            out = [
                (names[i], c, sums[bounds[i] + c], None)
                for i in range(len(names))
                for c in range(bounds[i + 1] - bounds[i])
            ]
            # under -1 the farthest point of each model, for a cluster that has become empty
            out += [(names[i], -1, np.append(far_x[i], [0.0, 0.0]), far[i]) for i in range(len(names))]
            yield _parts(out)

        total = _summed(rows, partial)
        for name in names:
            old = active[name]
            sums = np.vstack([total[name, c][0] for c in range(len(old))])
            n = sums[:, 0]
            new = np.where(n[:, None] > 0, sums[:, 1 : 1 + d] / np.maximum(n, 1)[:, None], old)
            empty = np.flatnonzero(n == 0)
            if len(empty):
                new[empty[0]] = total[name, -1][1][:d]  # others follow in the next rounds
            if ((new - old) ** 2).sum(1).max() <= tol * tol or step == most - 1:
                done[name] = (old, float(sums[:, -1].sum()), sums)
                del active[name]
            else:
                active[name] = new
        if not active:
            break
    return done


def _owners(batches, stacked: np.ndarray, bounds: np.ndarray, d: int):
    """Points, their membership of the nearest centre of each model, and their squared distances to it."""
    norms = (stacked * stacked).sum(1)
    for x in _matrices(batches, d):
        gap = norms[:, None] - 2 * stacked @ x.T
        length, place = (x * x).sum(1), np.arange(len(x))
        own, nears = np.zeros(gap.shape), []
        for a, b in zip(bounds, bounds[1:]):
            label, near = _nearest(gap[a:b])
            own[a + label, place] = 1.0
            nears.append(np.maximum(near + length, 0.0))
        yield x, own, nears


def _group_moments(rows: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Count, sum and sum of squares of the points of each cluster, in one scan."""
    stacked = np.vstack(list(centres.values()))
    bounds = np.cumsum([0] + [len(c) for c in centres.values()])
    names, d = list(centres), stacked.shape[1]

    def partial(batches):
        sums = np.zeros((len(stacked), 1 + 2 * d))
        for x, own, _ in _owners(batches, stacked, bounds, d):
            sums += own @ np.hstack([np.ones((len(x), 1)), x, x * x])
        yield _parts(
            [(names[i], c - a, sums[c], None) for i, (a, b) in enumerate(zip(bounds, bounds[1:])) for c in range(a, b)]
        )

    found = _summed(rows, partial)
    return {i: np.vstack([found[i, c][0] for c in range(len(m))]) for i, m in centres.items()}


def _expectations(rows: DataFrame, models: dict[int, tuple], d: int) -> dict[int, np.ndarray]:
    """Sums of responsibilities, moments and log-likelihood of each mixture in one scan."""
    weights, means, variances = (np.concatenate(part) for part in zip(*models.values()))
    bounds = np.cumsum([0] + [len(m[0]) for m in models.values()])
    precision = 1.0 / variances
    turned = means * precision
    constant = np.log(weights) - 0.5 * np.log(2 * np.pi * variances).sum(1) - 0.5 * (means * turned).sum(1)

    def partial(batches):
        total = np.zeros((len(weights), 2 + 2 * d))
        for x in _matrices(batches, d):
            squares = x * x
            share = turned @ x.T
            share -= 0.5 * precision @ squares.T
            share += constant[:, None]
            for a, b in zip(bounds, bounds[1:]):
                joint = share[a:b]
                top = joint.max(axis=0)
                np.exp(np.subtract(joint, top, out=joint), out=joint)
                mass = joint.sum(axis=0)
                joint /= mass
                total[a, 1] += (top + np.log(mass)).sum()
            total[:, 0] += share.sum(axis=1)
            total[:, 2 : 2 + d] += share @ x
            total[:, 2 + d :] += share @ squares
        yield _parts(
            [(i, c - a, total[c], None) for i, a, b in zip(models, bounds, bounds[1:]) for c in range(a, b)]
        )

    found = _summed(rows, partial)
    return {i: np.vstack([found[i, c][0] for c in range(len(m[0]))]) for i, m in models.items()}


def fit_many(
    points: DataFrame,
    fits: list[Fit],
    tol: float = 1e-6,
    max_rounds: int = 300,
    mixture_tol: float = 1e-3,
    mixture_rounds: int = 100,
) -> list[Centres | DiagonalMixture]:
    """One model for each of ``fits``, in their order; equal fits are fitted once.

    Clusters are numbered by their centres (falling), components by their weight. A
    fit depends on its own k and seed only, not on its company.
    """
    with kept(points.select(F.col("features").cast("array<double>").alias("features"))) as rows:
        shape = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("d")).first()
        n, d = shape["n"], shape["d"]
        if not n:
            raise ValueError("there are no points to fit")
        start = (
            rows.orderBy(F.xxhash64("features"), "features")
            .limit(max(64, min(START_POINTS, START_VALUES // d)))
            .collect()
        )
        x = np.array([r["features"] for r in start])
        wanted = list(dict.fromkeys((f.k, f.seed) for f in fits))
        firsts = {i: _first_centres(x, k, seed) for i, (k, seed) in enumerate(wanted)}
        settled = _lloyd(rows, firsts, tol, max_rounds)
        centres = {}
        for i, key in enumerate(wanted):
            points_, cost, _ = settled[i]
            order = sorted(range(len(points_)), key=lambda c: tuple(points_[c]), reverse=True)
            centres[key] = Centres(tuple(tuple(float(v) for v in points_[c]) for c in order), cost)

        mixtures = list(dict.fromkeys((f.k, f.seed) for f in fits if f.kind == "mixture"))
        state = {}
        starts = {i: np.array(centres[key].points) for i, key in enumerate(mixtures)}
        for i, sums in _group_moments(rows, starts).items() if starts else ():
            sums = sums[sums[:, 0] > 0]
            share = sums[:, :1]
            means = sums[:, 1 : 1 + d] / share
            variances = np.maximum(sums[:, 1 + d : 1 + 2 * d] / share - means**2, 0.0) + FLOOR
            state[i] = ((share / n).ravel(), means, variances)
        history: dict[int, list[float]] = {i: [] for i in state}
        finished = {}
        for _ in range(mixture_rounds):
            if not state:
                break
            for i, total in _expectations(rows, state, d).items():
                history[i].append(float(total[0, 1] / n))
                state[i] = maximised(total)
                if len(history[i]) > 1 and abs(history[i][-1] - history[i][-2]) < mixture_tol:
                    finished[i] = state.pop(i)
        finished.update(state)

    def mixture(i: int) -> DiagonalMixture:
        weights, means, variances = finished[i]
        by_weight = np.argsort(-weights, kind="stable")
        return DiagonalMixture(
            tuple(float(weights[c]) for c in by_weight),
            tuple(tuple(float(v) for v in means[c]) for c in by_weight),
            tuple(tuple(float(v) for v in variances[c]) for c in by_weight),
            tuple(history[i]),
        )

    return [
        mixture(mixtures.index((f.k, f.seed))) if f.kind == "mixture" else centres[f.k, f.seed]
        for f in fits
    ]


def kmeans_inertia(points: DataFrame, counts: list[int], seed: int = 42) -> DataFrame:
    """(n_clusters, inertia) of one fit per cluster count."""
    models = fit_many(points, [Fit("kmeans", k, seed) for k in counts])
    rows = [(k, m.inertia) for k, m in zip(counts, models)]
    return points.sparkSession.createDataFrame(rows, "n_clusters int, inertia double")
