"""Crowded keys are split, approximations keep their bounds, written models survive."""

import json

import numpy as np
import pandas as pd
import pytest
from brute import pairwise
from pyspark.ml.feature import Normalizer
from pyspark.sql import functions as F

from cohortlens.operators import (
    batched,
    clustering,
    density,
    neighbours,
    profiling,
    quality,
    scaling,
    scoring,
    selection,
    splits,
    summaries,
    validation,
)
from cohortlens.plans.compare import Grid, run_comparison
from cohortlens.plans.stages import Options, run_stages
from cohortlens.session import clear_scratch, cut_lineage
from cohortlens.sources.contract import CONTRACT
from cohortlens.sources.tables import write_report


def _frame(spark, x, labels=None):
    rows = [
        (i, [float(v) for v in row], int(labels[i]) if labels is not None else 0)
        for i, row in enumerate(x)
    ]
    return spark.createDataFrame(rows, "id long, features array<double>, cluster long")


@pytest.fixture(scope="module")
def crowd():
    """Nine tenths of the points lie in one tight place."""
    rng = np.random.default_rng(8)
    return np.vstack([rng.normal(0, 1e-3, (1_350, 3)), rng.normal(0, 5, (150, 3))])


def test_crowded_cell_meets_in_many_keys(spark, crowd):
    rows = _frame(spark, crowd).select(
        F.col("id").alias("key"), "features", F.array("id").alias("ids"),
        F.when(F.col("id") < 1_350, 0).otherwise(F.col("id") % 9 + 1).alias("cell"),
    )
    packed = neighbours._packed(rows, 32, "a", answers=True)
    sizes = packed.select("cell", "block", F.size("a_counts").alias("n")).collect()
    blocks = [r["n"] for r in sizes if r["cell"] == 0]
    assert sum(blocks) == 1_350 and len(blocks) > 30 and max(blocks) < 100
    assert len({(r["cell"], r["block"]) for r in sizes}) == len(sizes)


def test_neighbour_work_grows_slowly(spark):
    """Distances computed at 5, 20 and 80 thousand points, and the rows against all pairs."""
    rng = np.random.default_rng(7)
    every = rng.normal(0, 1, (80_000, 3))
    counts = []
    for n in (5_000, 20_000, 80_000):
        x = every[:n]
        counter = spark.sparkContext.accumulator(0)
        rows = [(i, v) for i, v in enumerate(x.tolist())]
        df = cut_lineage(spark.createDataFrame(rows, "id long, features array<double>"))
        lists = cut_lineage(neighbours.nearest_lists(df, 4, counter=counter))
        counts.append(counter.value)
        assert lists.count() == n
        some = df.filter("id % 997 = 0").join(lists, "features").select("id", "neighbours").collect()
        for r in some:
            gap = np.sqrt(((x - x[r["id"]]) ** 2).sum(1))
            order = np.lexsort((np.arange(n), gap))[:5]
            assert [v["id"] for v in r["neighbours"]] == order.tolist()
    slope = np.log(counts[2] / counts[0]) / np.log(16)
    assert slope < 1.6 and counts[2] < 0.1 * 80_000**2, counts


def test_neighbour_search_sends_vectors_to_few_shards(spark):
    """Where distances prune nothing a vector met each cell by itself, one copy for each."""
    pivots, sizes = np.eye(50), {r: 2_000 for r in range(50)} | {7: 60_000}
    first, parts = neighbours._shards(pivots, sizes, 12)
    assert parts[7] == 5 and (first + parts).max() <= 24
    of_shard = np.zeros(int((first + parts).max()))
    for r, n in sizes.items():
        of_shard[first[r] : first[r] + parts[r]] += n / parts[r]
    assert of_shard.min() > 0 and of_shard.max() <= -(-sum(sizes.values()) // 12)
    x = np.random.default_rng(9).normal(0, 1, (900, 24))
    got = {}
    for r in neighbours.knn_graph(_frame(spark, x), 5).collect():
        got.setdefault(r["src"], {})[r["rank"]] = (r["dst"], r["distance"])
    gap = pairwise(x)
    for i in range(len(x)):
        order = [j for j in np.lexsort((np.arange(len(x)), gap[i])) if j != i][:5]
        assert [got[i][k][0] for k in range(1, 6)] == order
        np.testing.assert_allclose([got[i][k][1] for k in range(1, 6)], gap[i][order])


def test_neighbours_of_a_crowded_cell(spark, crowd):
    got = {}
    for r in neighbours.knn_graph(_frame(spark, crowd), 3).collect():
        got.setdefault(r["src"], {})[r["rank"]] = r["dst"]
    gap = pairwise(crowd)
    for i in range(0, len(crowd), 37):
        order = [j for j in np.lexsort((np.arange(len(crowd)), gap[i])) if j != i][:3]
        assert [got[i][k] for k in (1, 2, 3)] == order


@pytest.mark.parametrize("blocks", [3, 24])
def test_silhouette_moves_each_point_few_times(spark, monkeypatch, blocks):
    # 100,000 vectors of 64 numbers were 391 blocks, each sent to all the others
    assert quality._block_count(100_000, 64, 10) == 24
    monkeypatch.setattr(quality, "_BLOCKS", blocks)
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (1_500, 4))
    labels = rng.integers(0, 3, len(x))
    points = _frame(spark, x, labels)
    packed = quality._blocks(quality.distinct_points(points, "cluster"), blocks)
    pairs = quality._block_pairs(packed, blocks).select("block", "block_right").collect()
    assert sorted(map(tuple, pairs)) == [(a, b) for a in range(blocks) for b in range(a, blocks)]
    gap, rows = pairwise(x), np.arange(len(x))
    share = np.eye(3)[labels]
    sums, sizes = gap @ share, share.sum(0)
    a = sums[rows, labels] / (sizes[labels] - 1)
    others = sums / sizes
    others[rows, labels] = np.inf
    b = others.min(1)
    assert quality.silhouette(points).first()[0] == pytest.approx(np.mean((b - a) / np.maximum(a, b)))


@pytest.fixture
def few_exact(monkeypatch):
    monkeypatch.setattr(summaries, "EXACT_POINTS", 50)


@pytest.mark.parametrize("d", [2, 9, 20])
def test_silhouette_by_summaries(spark, few_exact, d):
    rng = np.random.default_rng(d)
    parts = [rng.normal(0, 1, (1_200, d)), rng.normal(2.5 / d**0.5, 1, (600, d)), rng.normal(9, 0.3, (200, d))]
    x, labels = np.vstack(parts), [0] * 1_200 + [1] * 600 + [2] * 200
    x[:100] = x[0]
    points = _frame(spark, x, labels)
    exact = quality.silhouette(points).first()[0]
    widths = []
    for nodes in (24, 400):
        row = quality.bounded_silhouette(points, tolerance=1e-6, most_nodes=nodes).first()
        assert row.nodes <= nodes
        assert row.silhouette_low <= exact <= row.silhouette_high
        widths.append(row.silhouette_high - row.silhouette_low)
    assert widths[1] < widths[0]
    assert row.silhouette_score == pytest.approx(exact, abs=0.005)
    # coarse trees do when the tolerance allows
    assert quality.bounded_silhouette(points, tolerance=2.0, most_nodes=400).first().nodes <= 50


def test_each_point_has_its_interval():
    rng = np.random.default_rng(0)
    x, weight = rng.normal(0, 1, (500, 6)) * [5, 1, 1, 1, 0.1, 0] + 1e3, rng.integers(1, 4, 500).astype(float)
    tree = summaries.grow(x, np.zeros(500, int), weight, 20)
    leaf = tree.leaves(x, np.zeros(500, int))
    assert len(np.unique(leaf)) == 20
    means, moments = [], []
    for i in range(20):
        rows, w = x[leaf == i], weight[leaf == i]
        c = w @ rows / w.sum()
        v, q = rows - c, ((rows - c) ** 2).sum(1)
        covariance = (v * w[:, None]).T @ v / w.sum()
        moments.append((w.sum(), c, w @ q / w.sum(), covariance.ravel(), (w * q) @ v / w.sum(), w @ q**2 / w.sum() - (w @ q / w.sum()) ** 2))
        means.append(pairwise(np.vstack([x, rows]))[:500, 500:] @ w / w.sum())
    leaves = summaries.Leaves(np.zeros(20, int), *(np.array(m) for m in zip(*moments)))
    estimate, low, high = leaves.distances(x)
    exact = np.array(means).T
    assert (low <= exact + 1e-6).all() and (exact <= high + 1e-6).all()
    assert abs(estimate - exact).mean() < abs(high - exact).mean()


def test_summaries_count_every_point(spark):
    rng = np.random.default_rng(1)
    x, labels = np.vstack([rng.normal(0, 1, (900, 3)), np.full((50, 3), 7.0)]), [0] * 900 + [1] * 50
    rows = quality.distinct_points(_frame(spark, x, labels), "cluster")
    tree = summaries.grow(x[::9], np.array(labels)[::9], np.ones(len(x[::9])), 30)
    leaves = summaries.summarise(rows, tree, 3)
    assert leaves.weight.sum() == 950
    assert np.allclose(leaves.weight @ leaves.centre, x.sum(0))
    total = leaves.weight @ (leaves.spread + ((leaves.centre - x.mean(0)) ** 2).sum(1))
    assert total == pytest.approx(((x - x.mean(0)) ** 2).sum())
    assert leaves.spread[leaves.label == 1] == pytest.approx([0.0], abs=1e-9)


def test_repeated_row_is_folded_before_the_shuffle(spark):
    df = spark.range(5_000).select(F.lit("same").alias("a"), F.lit(None).cast("int").alias("b"))
    df = df.union(spark.createDataFrame([("other", 1), ("other", 2)], "a string, b int"))
    assert validation.check_duplicates(df).first()[0] == 4_999


def test_few_valued_columns(spark):
    """Columns at, below and above the limit; unique columns never reach the exact count."""
    n = 20_000
    df = spark.range(n).select(
        *[(F.col("id") % m).cast("double").alias(f"m{m}") for m in (1, 2, 19, 20, 21, 30, 99, 100, 101)],
        F.col("id").alias("unique"),
        F.when(F.col("id") % 2 == 0, -0.0).otherwise(0.0).alias("zeros"),
        F.lit(None).cast("double").alias("empty"),
    )
    for limit in (1, 20, 100, 150):
        got = {r["column"]: r["distinct_values"] for r in profiling.few_valued(df, limit).collect()}
        expected = {f"m{m}": m for m in (1, 2, 19, 20, 21, 30, 99, 100, 101) if m <= limit}
        assert got == {**expected, "zeros": 1, "empty": 0}
    assert profiling.few_valued(df.select("unique"), 20).isEmpty()


def test_hundred_thousand_levels(spark):
    """Sparse rows, a hot level and an unknown one, and a fit on the vectors."""
    rows = spark.range(200_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("level "), F.col("id"))).alias("a"),
        F.when(F.col("id") % 2 == 0, F.lit("even")).alias("b"),
        (F.col("id") % 10).cast("double").alias("x"),
    )
    levels = scaling.level_table(rows.filter("id <> 100000"), ["a", "b"])
    known = 133_333 - 1 + 2  # ids that 3 does not divide but one, "hot" and "even"
    width = 1 + known
    assert levels.count() == known
    scales = scaling.fit_standard(rows, ["x"])
    hot = scaling.sparse_features(rows, scales, levels, ["a", "b"], "id")
    picked = {r["id"]: r["features"] for r in hot.filter("id in (0, 1, 100000)").collect()}
    place = {r["level"]: r["place"] + 1 for r in levels.filter("level in ('hot', 'level 1', 'even')").collect()}
    assert picked[0]["indices"] == [0, place["hot"], place["even"]]
    assert picked[1]["indices"] == [0, place["level 1"]] and picked[1]["values"][1:] == [1.0]
    assert picked[100_000]["indices"] == [0, place["even"]] and picked[1]["size"] == width
    vectors = scaling.as_vectors(hot)
    one = vectors.filter("id = 0").first()["features"]
    assert one.size == width and one.indices.tolist() == picked[0]["indices"]
    norms = Normalizer(inputCol="features", outputCol="unit").transform(vectors.limit(5)).collect()
    assert all(abs(r["unit"].norm(2) - 1) < 1e-9 for r in norms)


def test_many_category_levels(spark):
    df = spark.range(3_000).select(F.concat(F.lit("level "), "id").alias("c"), F.col("id").cast("double"))
    (name, levels), = scaling.fit_levels(df, ["c"])
    assert name == "c" and len(levels) == 3_000
    fitted = scaling.FeatureMap("full", scaling.fit_standard(df, ["id"]), ((name, levels),))
    row = fitted.transform(df.filter("id = 7"), "c").first()
    assert sum(row["features"][1:]) == 1.0 and row["features"][1 + levels.index("level 7")] == 1.0


def _bundle(spark, silhouette):
    profile = spark.createDataFrame([(0, 5, "x")], "cluster int, cluster_size long, name string")
    fitted = scaling.FeatureMap("given", (scaling.Scale("v", 0.0, 1.0),))
    metrics = {"silhouette_score": silhouette, "davies_bouldin_score": 1.0}
    return scoring.Bundle(fitted, clustering.Centres(((0.0,),)), metrics, profile, "now")


def test_promotion_adds_versions(spark, tmp_path):
    path = str(tmp_path / "best")
    with pytest.raises(FileNotFoundError):
        scoring.load_model(spark, path)
    assert scoring.promote(_bundle(spark, 0.3), path)
    assert not scoring.promote(_bundle(spark, 0.2), path)
    first = scoring.load_model(spark, path)
    # a run that ended between the profile and the model's row leaves the old version
    first.profile.limit(0).write.parquet(f"{path}/profile/99999999999999999999-broken")
    assert scoring.load_model(spark, path).metrics == first.metrics
    # the loaded bundle reads from the path it is promoted to
    better = scoring.Bundle(first.feature_map, first.centres, {**first.metrics, "silhouette_score": 0.9}, first.profile)
    assert scoring.promote(better, path)
    assert scoring.load_model(spark, path).metrics["silhouette_score"] == 0.9
    assert scoring.load_model(spark, path).profile.count() == 1


def test_profile_lookup_renames_and_fills(spark):
    labels = spark.createDataFrame([("a", 0, 1.0)], "id string, cluster int, x double")
    profile = spark.createDataFrame([(0, 2.0, None)], "cluster int, x double, name string")
    row = scoring.attach_profile(labels, profile).first().asDict()
    assert row == {"cluster": 0, "id": "a", "x": 1.0, "profile_x": 2.0, "name": ""}


def test_failed_gate_leaves_its_report(spark, tmp_path):
    source = spark.createDataFrame([(None, "x"), (1.0, "y")], "net_sales_usd double, coupon_code string")
    options = Options(contract=CONTRACT.restricted_to(source.columns), allowed_categories={})
    result = run_stages(source, str(tmp_path), options)
    assert (result.status, result.failed_stage) == ("failed", "prepare")
    folder = f"{tmp_path}/reports/validation"
    assert spark.read.json(f"{folder}/summary").first()["passed"] is False
    assert spark.read.json(f"{folder}/failure_cases").first()["column"] == "net_sales_usd"
    assert spark.read.json(f"{folder}/issues").count() >= 1


def test_comparison_is_written_with_the_run_before(spark, folder, tmp_path):
    from cohortlens.plans.segment_queries import feature_table

    parts = splits.frames(splits.split_random(feature_table(spark, folder)))
    grid = Grid(
        kmeans_counts=(3,), mixture_counts=(), ward_counts=(), pca_options=(2,), pca2_counts=(),
        density_sizes=(), seeds=(42,),
    )
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    earlier = [{"model_name": "kmeans_3", "representation": "pca", "silhouette_score": 0.5}]
    write_report({"scores": selection.score_table(spark, earlier)}, first)
    run_comparison(parts["train"], parts["validation"], second, previous=first, grid=grid)
    both = spark.read.json(f"{second}/before_after")
    assert {r["run"]: r["count"] for r in both.groupBy("run").count().collect()} == {"before": 1, "after": 6}
    assert spark.read.json(f"{second}/selection").count() >= 1


def test_plans_of_a_representation_share_fits_and_distances(spark, folder, monkeypatch):
    from cohortlens.plans.segment_queries import feature_table

    parts = splits.frames(splits.split_random(feature_table(spark, folder)))
    plans = [("a", "pca", 2, 2), ("b", "robust_pca", 2, 2), ("c", "pca", 2, 3), ("d", "pca", 2, 2)]
    plans = [(name, v, n, selection.kmeans_candidate(k, 42)) for name, v, n, k in plans]
    alone = [
        selection.evaluate_candidates(
            [(name, fit)], scaling.fit_feature_map(parts["train"], v, n), parts["train"], parts["validation"], f"{v}_{n}"
        )
        for name, v, n, fit in plans
    ]
    asked, fit_many = [], selection.fit_many
    monkeypatch.setattr(selection, "fit_many", lambda p, fits: asked.append(len(fits)) or fit_many(p, fits))
    rows, made = selection.evaluate_plans(plans, parts["train"], parts["validation"])
    assert sorted(asked) == [1, 2]
    for row, (fitted, model), ((want,), (same,)) in zip(rows, made, alone):
        assert {k: v for k, v in row.items() if isinstance(v, str)} == {k: v for k, v in want.items() if isinstance(v, str)}
        assert row["silhouette_score"] == pytest.approx(want["silhouette_score"])
        assert np.ravel(model.points) == pytest.approx(np.ravel(same.points))


def test_training_report(spark):
    report = scoring.training_report(
        _bundle(spark, 0.5), spark.range(5), seed=1
    ).first()
    assert report["rows"] == 5 and report["feature_columns"] == ["v"]
    assert report["cluster_sizes"] == {0: 5} and json.loads(report["parameters"]) == {"seed": 1}


def test_scratch_is_cleared(spark):
    kept = cut_lineage(spark.range(3))
    assert kept.count() == 3 and clear_scratch(spark) >= 1
    with pytest.raises(Exception):
        spark.read.parquet(kept.inputFiles()[0]).count()


def test_duplicates_are_looked_for_among_few_rows(spark, monkeypatch):
    rows = [(i, f"text {i}", float(i), {"a": i}) for i in range(500)]
    rows += [(None, "x", 0.0, {"a": 1}), (None, "x", -0.0, {"a": 1}), (None, "x", 0.0, {"a": 2})]
    rows += [(1, None, float("nan"), None)] * 3 + [(None, None, None, None)] * 2
    df = spark.createDataFrame(rows, "id long, text string, v double, m map<string,long>")
    held = []
    monkeypatch.setattr(validation, "cut_lineage", lambda d: held.append(cut_lineage(d)) or held[-1])
    # the third row of "x" has the hash of the first two, but another map
    assert validation.check_duplicates(df).first()[0] == 1 + 2 + 1
    assert held[0].columns == ["_row_hash"] and held[0].count() == 3
    assert validation.check_duplicates(df.filter("id < 0")).first()[0] == 0


def test_tree_where_nothing_is_pruned(spark, monkeypatch):
    """The same tree from pairs of blocks, with many equal distances, as from pruned rounds."""
    x = np.random.default_rng(3).integers(0, 4, (260, 4)).astype(float)
    _, vectors = density._vectors(_frame(spark, x), 4, "id")
    trees = []
    for unpruned in (2, -1):
        monkeypatch.setattr(density, "UNPRUNED", unpruned)
        trees.append(sorted(map(tuple, density.spanning_tree(vectors).select("a", "b", "level").collect())))
    assert len(trees[0]) == len(np.unique(x, axis=0)) - 1 and trees[0] == trees[1]
    # an edge is kept by its own pair of blocks only, and each pair keeps a forest
    edges = density._pair_trees(vectors, vectors.count()).select("a", "b").collect()
    assert len(edges) == len(set(map(tuple, edges))) and set(t[:2] for t in trees[0]) <= set(map(tuple, edges))


def test_distance_totals_by_products(spark):
    """A pair's distance was taken axis by axis, 60 numpy passes for 64 numbers."""
    rng = np.random.default_rng(12)
    x = np.vstack([rng.normal(5, 1, (700, 12)), rng.normal(-5, 30, (300, 12))])
    x[50:60] = x[0] + 1e-9 * rng.normal(0, 1, (10, 12))
    x[300:400, 1:] = 0.25
    weight = rng.integers(1, 4, len(x)).astype(float)
    place = np.column_stack([rng.integers(0, 3, len(x)), 3 + rng.integers(0, 2, len(x))])
    block = quality._Totals(x[:600], place[:600], weight[:600], 5)
    for at in (0, 430):
        to = slice(at, 430 if at == 0 else None)
        block.add(x[to], place[to], weight[to])
    share = np.zeros((len(x), 5))
    np.put_along_axis(share, place, weight[:, None], 1)
    order = np.lexsort((*block.place.T, block.x[:, 0]))
    mine = np.lexsort((*place[:600].T, x[:600, 0] - x[:600, 0].mean()))
    np.testing.assert_allclose(block.totals[order], (pairwise(x) @ share)[:600][mine], rtol=1e-9)


def test_many_labels_take_the_exact_pass(spark, few_exact, monkeypatch):
    """Beyond EXACT_PASS points each label had trees of its own, however many labels."""
    monkeypatch.setattr(quality, "EXACT_PASS", 400)
    rng = np.random.default_rng(13)
    x = rng.normal(0, 1, (600, 3))
    labels = rng.integers(0, 3, (600, 3))
    rows = [(v, *map(int, c)) for v, c in zip(x.tolist(), labels)]
    df = cut_lineage(spark.createDataFrame(rows, "features array<double>, a int, b int, c int"))
    gap, at = pairwise(x), np.arange(len(x))
    for found, own in zip(quality.quality_many(df, ["a", "b", "c"], 0.005), labels.T):
        share = np.eye(3)[own]
        sums, sizes = gap @ share, share.sum(0)
        others = sums / sizes
        others[at, own] = np.inf
        a, b = sums[at, own] / (sizes[own] - 1), others.min(1)
        assert found["silhouette_low"] == found["silhouette_high"]
        assert found["silhouette_score"] == pytest.approx(np.mean((b - a) / np.maximum(a, b)), abs=1e-9)


def test_features_are_made_once_for_both_halves(spark, folder, monkeypatch):
    """The split counted, cut and wrote a table that every step made again."""
    from cohortlens.plans import segment_queries

    made = spark.sparkContext.accumulator(0)
    table = segment_queries.feature_table

    def counted(spark, folder):
        rows = table(spark, folder)

        def seen(batches):
            for batch in batches:
                made.add(len(batch))
                yield batch

        return rows.mapInPandas(seen, rows.schema)

    monkeypatch.setattr(segment_queries, "feature_table", counted)
    halves = segment_queries._halves(spark, folder)
    n = sum(half.count() for half in halves.values())
    assert made.value == n == table(spark, folder).count()


def test_group_moments_in_one_scan(spark):
    rng = np.random.default_rng(14)
    x = rng.normal(0, 1, (500, 3))
    centres = {0: x[:2], 7: x[10:15]}
    found = batched._group_moments(_frame(spark, x).select("features"), centres)
    for i, c in centres.items():
        own = pairwise(np.vstack([c, x]))[len(c) :, : len(c)].argmin(1)
        for k in range(len(c)):
            mine = x[own == k]
            np.testing.assert_allclose(
                found[i][k], np.hstack([len(mine), mine.sum(0), (mine * mine).sum(0)])
            )


def test_neighbours_by_products(spark):
    """A pair of vectors of 64 numbers cost 64 numpy passes, and each shard sent a list to be merged."""
    rng = np.random.default_rng(15)
    x = rng.normal(3, 1, (900, 20))
    x[100:140] = x[0]
    x[200:260, :] = x[0] + 1e-9 * rng.normal(0, 1, (60, 20))
    gap = neighbours.distances(x[:300], x)
    block = neighbours._Block(x[:300], np.arange(300) // 40, np.sort(gap, axis=1)[:, 60], 6, None)
    ids = rng.permutation(len(x))
    for at in (0, 500):
        part = slice(at, 500 if at == 0 else None)
        n = len(x[part])
        block.meet(x[part], np.arange(n) // 64, ids[part], np.ones(n, int))
    lists = [row for batch in block.lists() for row in batch.to_pylist()]
    for i, row in enumerate(lists):
        order = np.lexsort((ids, gap[i]))[:7]
        assert [v["id"] for v in row["neighbours"]] == ids[order].tolist()
        assert [v["distance"] for v in row["neighbours"]] == gap[i][order].tolist()
        assert row["features"] == x[i].tolist()
    assert len(lists) == 300


@pytest.mark.parametrize("whole", [True, False])
def test_block_tree_follows_the_order_of_edges(whole):
    """Each round of the tree went over all pairs again: 394 ns a pair of 64 numbers, now about 60."""
    rng = np.random.default_rng(16)
    x = rng.integers(0, 3, (90, 3)).astype(float) if whole else rng.normal(9, 1, (90, 7))
    core = np.round(rng.random(90) * 2) if whole else rng.random(90) * 3
    keys = np.sort(rng.choice(1_000, 90, replace=False))
    sides = rng.random(90) < 0.4
    for a, b in ((sides, ~sides), (sides, sides)):
        reach, turned = density._reaches(x[a], core[a], x[b], core[b], a is b)
        exact = np.maximum(neighbours.distances(x[a], x[b]), np.maximum(core[a][:, None], core[b]))
        np.testing.assert_allclose(reach, exact, rtol=1e-12)
        np.testing.assert_allclose(turned.T, exact, rtol=1e-12)
        assert not whole or np.array_equal(reach, exact)
        one = {"l_x": x[a].ravel(), "l_key": keys[a], "l_core": core[a]}
        one |= {"r_x": x[b].ravel(), "r_key": keys[b], "r_core": core[b]}
        found = pd.concat(density._block_tree([pd.DataFrame([one])]))
        got = {(r.a, r.b) for r in found.itertuples()}
        edges = sorted(
            (exact[i, j], min(p, q), max(p, q))
            for i, p in enumerate(keys[a]) for j, q in enumerate(keys[b]) if p != q
        )
        up = {k: k for k in keys}

        def root(k):
            return k if up[k] == k else root(up[k])

        wanted = set()
        for _, p, q in edges:
            if root(p) != root(q):
                up[root(p)] = root(q)
                wanted.add((p, q))
        assert got == wanted and len(found) == len(wanted)
        level = {(min(p, q), max(p, q)): v for v, p, q in edges}
        assert all(level[r.a, r.b] == r.level for r in found.itertuples())
