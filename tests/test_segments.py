"""Segmentation against plain numpy, and the rules of selection."""

import numpy as np
import pytest
from brute import brute_density, brute_ward, pairwise
from pyspark.sql import functions as F

from cohortlens.functions.order import numbered
from cohortlens.operators import (
    batched,
    clustering,
    hierarchy,
    microclusters,
    neighbours,
    quality,
    scaling,
    scoring,
    selection,
    summaries,
)
from cohortlens.operators.density import density_clusters
from cohortlens.operators.linkage import ward_clusters
from cohortlens.session import cut_lineage


def frame(spark, x, labels=None, step=1):
    rows = [
        (i * step, [float(v) for v in row], int(labels[i]) if labels is not None else 0)
        for i, row in enumerate(x)
    ]
    return spark.createDataFrame(rows, "id long, features array<double>, cluster long")


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(c, s, (n, 2)) for c, s, n in (((0, 0), 0.3, 30), ((4, 0), 0.4, 25), ((2, 5), 1.2, 12))])
    x[3] = x[4]
    return x


def test_silhouette_with_equal_points_and_a_singleton(spark, blobs):
    labels = np.array([0] * 30 + [1] * 25 + [2] * 11 + [3])
    gap = pairwise(blobs)
    expected = []
    for i, own in enumerate(labels):
        size = (labels == own).sum()
        if size == 1:
            expected.append(0.0)
            continue
        a = gap[i][labels == own].sum() / (size - 1)
        b = min(gap[i][labels == other].mean() for other in set(labels) - {own})
        expected.append((b - a) / max(a, b))
    points = frame(spark, blobs, labels)
    assert quality.silhouette(points).first()[0] == pytest.approx(np.mean(expected))
    with pytest.raises(ValueError):
        quality.silhouette(frame(spark, blobs))


def test_neighbours_in_a_crowd_of_equal_points(spark):
    rng = np.random.default_rng(1)
    x = np.vstack([np.zeros((40, 3)), rng.normal(0, 1, (60, 3))])
    rows = neighbours.knn_graph(frame(spark, x), 4).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r["src"], r["rank"])):
        found.setdefault(r["src"], []).append(r["dst"])
    gap = pairwise(x)
    for i in range(len(x)):
        order = [j for j in np.lexsort((np.arange(len(x)), gap[i])) if j != i]
        assert found[i] == order[:4]


@pytest.mark.parametrize("most", [None, 4096])
def test_ward_equals_greedy_merging(spark, blobs, most):
    x = blobs[np.r_[0:3, 4:20, 30:45, 55:67]]
    ids = [i * 2 for i in range(len(x))]
    labelled = ward_clusters(frame(spark, x, step=2), [2, 3, 5], 4, most=most).collect()
    expected = brute_ward(x, ids, 4, (2, 3, 5))
    for k in (2, 3, 5):
        groups = {}
        for r in labelled:
            groups.setdefault(r[f"ward_{k}"], []).append(r["id"])
        if k in expected:
            assert sorted(sorted(g) for g in groups.values()) == expected[k]
        assert len(groups) == k


def test_features_add_up(spark):
    rng = np.random.default_rng(8)
    x = np.vstack([rng.normal(1e6, 1, (400, 3)), np.full((200, 3), 1e6)])
    points = frame(spark, x)
    tree = microclusters.fit_micro_tree(
        points.groupBy("features").agg(F.count(F.lit(1)).alias("weight")), 16
    )
    placed = microclusters.place_points(points, tree)
    halves = [placed.filter(F.col("id") % 2 == r) for r in (0, 1)]
    merged = microclusters.merge_features(*map(microclusters.clustering_features, halves))
    leaf = {r["id"]: r["leaf"] for r in placed.collect()}
    rows = microclusters.micro_clusters(merged, tree).collect()
    assert 1 < len(rows) <= 16 and sum(r["n"] for r in rows) == len(x)
    for r in rows:
        own = [i for i in range(len(x)) if leaf[i] == r["leaf"]]
        assert (r["cluster"], r["n"]) == (own[0], len(own))
        assert np.allclose(r["centre"], x[own].mean(0), atol=1e-6)
        scatter = ((x[own] - x[own].mean(0)) ** 2).sum()
        assert r["scatter"] == pytest.approx(scatter, rel=1e-6, abs=1e-6)


def test_ward_on_micro_clusters(spark, blobs):
    few = ward_clusters(frame(spark, blobs), [3], 4, most=16).collect()
    exact = ward_clusters(frame(spark, blobs), [3], 4, most=len(blobs)).collect()
    assert {r["id"] for r in few} == set(range(len(blobs)))
    both = [{tuple(sorted(r["id"] for r in rows if r["ward_3"] == c)) for c in range(3)} for rows in (few, exact)]
    assert both[0] == both[1]


def test_ward_of_many_points(spark):
    """A hundred thousand points, a third of them equal, against the places they were drawn from."""
    places = np.array([(0, 0, 0), (9, 0, 0), (0, 9, 0), (0, 0, 9)], float)
    rows = spark.range(100_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 4).alias("own"),
    )
    centre = F.array(*[F.array(*[F.lit(v) for v in p]) for p in places.tolist()])[F.col("own")]
    noise = F.array(*[F.randn(7 + i) for i in range(3)])
    points = cut_lineage(
        rows.select(
            "id", "own",
            F.when(F.col("id") % 3 == 0, centre)
            .otherwise(F.zip_with(centre, noise, lambda x, e: x + e)).alias("features"),
        )
    )
    labelled = ward_clusters(points, [4]).join(points.select("id", "own"), "id")
    counts = labelled.groupBy("ward_4", "own").count().collect()
    assert sum(r["count"] for r in counts) == 100_000
    assert sum(max(r["count"] for r in counts if r["ward_4"] == c) for c in range(4)) > 99_900


def test_density_equals_single_linkage_by_hand(spark, blobs):
    labelled = density_clusters(frame(spark, blobs), 6).orderBy("id").collect()
    assert [r["cluster"] for r in labelled] == brute_density(blobs, 6)


def test_density_hierarchy_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(hierarchy, "BLOCK_MERGES", 4)
    rng = np.random.default_rng(12)
    x = np.vstack([rng.normal(c, s, (n, 2)) for c, s, n in zip(rng.normal(0, 3, (9, 2)), (0.1, 0.3, 1) * 3, (8, 12, 15) * 3)])
    labelled = density_clusters(frame(spark, x), 4).orderBy("id").collect()
    expected = brute_density(x, 4)
    assert [r["cluster"] for r in labelled] == expected and max(expected) >= 4


def _assigned(x, model):
    return ((x[:, None] - np.array(model.points)[None]) ** 2).sum(-1)


def test_fits_at_once(spark, blobs):
    points = frame(spark, blobs)
    fits = [batched.Fit("kmeans", k, seed) for k in (2, 3, 5) for seed in (1, 2)]
    fits += [batched.Fit("mixture", 3, 1), batched.Fit("kmeans", 3, 1)]
    models = batched.fit_many(points, fits)
    for fit, model in zip(fits, models):
        if fit.kind == "kmeans":
            gap = _assigned(blobs, model)
            label = gap.argmin(1)
            # a fixed point: each centre is the mean of the points it is nearest to
            assert set(label) == set(range(fit.k))
            means = [blobs[label == c].mean(0) for c in range(fit.k)]
            assert np.allclose(means, model.points, atol=1e-5)
            assert model.inertia == pytest.approx(gap.min(1).sum())
    assert models[2] == models[-1]
    # a model does not depend on its company
    assert batched.fit_many(points, [fits[4]])[0] == models[4]
    steps = np.diff(models[6].history)
    assert (steps > -1e-6).all() and sum(models[6].weights) == pytest.approx(1.0)


def test_an_empty_cluster_is_moved(spark):
    x = np.array([[0.0], [0.1], [5.0], [9.0]])
    rows = frame(spark, x)
    found = batched._lloyd(rows, {0: np.array([[0.0], [100.0], [4.0]])}, 1e-9, 50)
    centres, cost, _ = found[0]
    assert sorted(c[0] for c in centres) == pytest.approx([0.05, 5.0, 9.0]) and cost == pytest.approx(0.005)
    # more clusters than different points: some stay empty, and the fit ends
    model, = batched.fit_many(frame(spark, np.zeros((5, 2))), [batched.Fit("kmeans", 3)])
    assert model.inertia == 0.0


def test_many_labelings_at_once(spark, blobs, monkeypatch):
    rng = np.random.default_rng(0)
    labels = np.column_stack([rng.integers(0, k, len(blobs)) for k in (2, 3, 1, 4)])
    labels[:, 3] = [0] * 66 + [9]
    rows = [([float(v) for v in x], *map(int, l)) for x, l in zip(blobs, labels)]
    df = spark.createDataFrame(rows, "features array<double>, a long, b long, c long, d long")
    found = quality.quality_many(df, ["a", "b", "c", "d"])
    assert found[2] is None
    for name, scores in zip("abd", [found[0], found[1], found[3]]):
        want = quality.quality(df, name)
        for key, value in want.items():
            assert scores[key] == pytest.approx(value)
    monkeypatch.setattr(summaries, "EXACT_POINTS", 10)
    far = quality.quality_many(df, ["a", "b"], tolerance=0.01)
    low, high = far[0]["silhouette_low"] - 1e-9, far[0]["silhouette_high"] + 1e-9
    assert low <= found[0]["silhouette_score"] <= high


def test_one_pass_over_the_distances_for_all_labelings(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(0, 1, (700, 3)), 1)
    x[:40] = x[0]
    labels = np.column_stack([rng.integers(0, k, len(x)) for k in (2, 5)] + [x[:, 0] > 0, [7] * 699 + [9]])
    rows = [([float(v) for v in p], *map(int, l)) for p, l in zip(x, labels)]
    df = spark.createDataFrame(rows, "features array<double>, a long, b long, c long, d long")
    want = [quality.silhouette(df, c).first()[0] for c in "abcd"]
    monkeypatch.setattr(summaries, "EXACT_POINTS", 10)
    # no labeling is taken by itself, with or without a tolerance
    monkeypatch.setattr(quality, "quality_of", None)
    for tolerance in (None, 0.1):
        found = quality.quality_many(df, list("abcd"), tolerance)
        assert [r["silhouette_score"] for r in found] == pytest.approx(want, abs=1e-12)
        assert all(r["silhouette_low"] == r["silhouette_high"] for r in found)


def test_one_cluster_is_a_row_with_a_reason(spark):
    scores = selection.score_table(spark, [
        {"model_name": m, "seed": s, "silhouette_score": v, "davies_bouldin_score": v}
        for m, s, v in (("a", 1, 0.5), ("a", 2, 0.5), ("b", 1, 0.9), ("b", 2, None))
    ])
    chosen = selection.select_stable(selection.seed_stability(scores, "model_name"), "model_name")
    rows = {r.model_name: r for r in chosen.collect()}
    assert rows["b"].reason == selection.ONE_CLUSTER and not rows["b"].is_winner
    assert rows["a"].is_winner and selection.winner(chosen).model_name == "a"


def test_climbing_a_chain():
    # leaf 0 meets 1, 2, .. one after another: 40 merges above each other
    rows = [{"place": i, "first": 0, "second": i + 1, "level": float(i + 1)} for i in range(40)]
    merges, moved = hierarchy._merged(rows, 41)
    assert [m[1] for m in merges] == [0, *range(41, 80)] and set(moved.values()) == {80}
    climb = hierarchy._Climb(merges)
    level = np.arange(0.5, 42.0, 0.5)
    got = climb.place(np.zeros(len(level), int), level)
    # a point that joins where two clusters meet stays with its own
    assert got.tolist() == [0 if v <= 1 else 40 + int(np.ceil(v)) - 1 for v in np.minimum(level, 41)]
    assert climb.place(np.array([7, 500]), np.array([3.0, 9.0])).tolist() == [7, 500]


def test_numbers_follow_the_order(spark):
    rng = np.random.default_rng(3)
    values = rng.permutation(5_000).tolist()
    df = spark.createDataFrame([(v, v % 7) for v in values], "v long, w int").repartition(13)
    rows = numbered(df, "w", "v").collect()
    assert [r.place for r in sorted(rows, key=lambda r: (r.w, r.v))] == list(range(5_000))
    assert numbered(df.limit(0), "v").collect() == []


def test_mixture_likelihood_never_falls(spark, blobs):
    model = clustering.fit_diagonal_mixture(frame(spark, blobs), 3, 1, max_iter=12, tol=0.0)
    steps = np.diff(model.history)
    assert (steps > -1e-6).all() and sum(model.weights) == pytest.approx(1.0)


def test_pca_is_centred_and_matches_the_covariance(spark):
    rng = np.random.default_rng(2)
    columns = scaling.STANDARD_COLUMNS + scaling.SKEWED_COLUMNS
    raw = np.abs(rng.normal(5, 2, (80, len(columns))))
    df = spark.createDataFrame([tuple(map(float, r)) for r in raw], ", ".join(f"{c} double" for c in columns))
    fitted = scaling.fit_feature_map(df, "pca", 2)
    got = np.array([r["features"] for r in fitted.transform(df).collect()])
    scaled = raw.copy()
    scaled[:, 7:] = np.log1p(scaled[:, 7:])
    scaled = (scaled - scaled.mean(0)) / scaled.std(0)
    values, vectors = np.linalg.eigh(np.cov(scaled.T))
    order = np.argsort(-values)[:2]
    assert got.mean(0) == pytest.approx([0, 0], abs=1e-9)
    expected = np.abs(scaled @ vectors[:, order])
    assert np.sort(np.abs(got), axis=0) == pytest.approx(np.sort(expected, axis=0), abs=1e-8)
    assert fitted.explained_variance_ratio == pytest.approx(list(values[order] / values.sum()))
    assert scaling.FeatureMap.from_json(fitted.to_json()) == fitted


def stable(spark, rows):
    return spark.createDataFrame(
        rows, "model_name string, place int, silhouette_mean double, silhouette_std double"
    )


def test_selection_limit_and_ties(spark):
    table = stable(spark, [("a", 0, 0.9, 0.0501), ("b", 1, 0.50, 0.05), ("c", 2, 0.45, 0.0)])
    rows = {r["model_name"]: r for r in selection.select_stable(table, "place").collect()}
    assert rows["a"]["reason"] and not rows["b"]["reason"]
    assert rows["b"]["is_winner"] and not rows["c"]["is_winner"]
    with pytest.raises(ValueError):
        selection.winner(selection.select_stable(stable(spark, [("a", 0, 0.9, 0.2)]), "place"))


def test_promotion(spark):
    def scores(s, d):
        return spark.createDataFrame([(s, d)], scoring.METRICS_SCHEMA)

    for candidate, stored, expected in (
        ((0.5, 1.0), None, True),
        ((0.5, 1.0), (0.4, 0.1), True),
        ((0.4, 0.1), (0.5, 1.0), False),
        ((0.5, 0.9), (0.5, 1.0), True),
        ((0.5, 1.0), (0.5, 1.0), False),
        ((0.5, 1.0), (None, 1.0), True),
    ):
        held = scores(*stored) if stored else None
        assert selection.promote_if_better(scores(*candidate), held).first()[0] is expected


def test_published_size_diagnostics(spark):
    # the published one-versus-rest share per seed, scaled to 10,000 rows
    shares = {42: 5200, 43: 9997, 44: 5200, 45: 5210, 46: 9997}
    labels = None
    for seed, first in shares.items():
        one = spark.range(10000).select(F.lit(seed).alias("seed"), (F.col("id") >= first).cast("int").alias("cluster"))
        labels = one if labels is None else labels.unionByName(one)
    report = selection.cluster_size_diagnostics(labels)
    assert {r["seed"] for r in report.filter("is_degenerate").collect()} == {43, 46}
    assert selection.any_degenerate(report).first()[0]


def test_missing_profile_is_an_error(spark):
    labels = spark.createDataFrame([(1, 0), (2, 7)], "customer_id int, cluster int")
    profile = spark.createDataFrame([(0, 1, None)], "cluster int, cluster_size int, preferred_category string")
    ok = scoring.attach_profile(labels.filter("cluster = 0"), profile).first()
    assert ok["preferred_category"] == ""
    with pytest.raises(Exception, match="no cluster profile for 7"):
        scoring.attach_profile(labels, profile).collect()


def test_first_failing_stage_is_named(spark, tmp_path):
    from cohortlens.plans.stages import run_stages

    bad = spark.createDataFrame([(1,)], "order_id int")
    result = run_stages(bad, str(tmp_path))
    assert result.status == "failed" and result.failed_stage == "prepare"
