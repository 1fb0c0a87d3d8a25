"""Model comparison: candidates, sweeps, stability and the stable winner.

Uses the train and validation splits only. All fits of a representation share their
scans; the score rows are bounded by the grid, and all decisions are made on the score table.

    spark-submit --py-files cohortlens.zip cohortlens/plans/compare.py \\
        --splits FOLDER/splits/customer --output REPORTS [--previous EARLIER_REPORTS]
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators import selection
from cohortlens.operators.batched import kmeans_inertia
from cohortlens.operators.clustering import assign, in_order
from cohortlens.operators.density import density_clusters
from cohortlens.operators.linkage import ward_clusters
from cohortlens.operators.microclusters import MOST_MICRO
from cohortlens.operators.profiling import flag_correlated_pairs, pearson_matrix
from cohortlens.operators.profiles import NUMERIC_COLUMNS, cluster_profile
from cohortlens.operators.scaling import fit_feature_map, pca_loadings
from cohortlens.operators.summaries import TOLERANCE
from cohortlens.session import build_session, clear_scratch, cut_lineage, kept
from cohortlens.sources.tables import read_features, write_report


# The published grid.
@dataclass(frozen=True)
class Grid:
    """What to fit; the defaults are the full comparison."""

    seed: int = 42
    baseline_clusters: int = 2
    kmeans_counts: tuple[int, ...] = (3, 4, 5, 6, 7)
    mixture_counts: tuple[int, ...] = (3, 4, 5, 6, 7)
    ward_counts: tuple[int, ...] = (3, 4, 5, 6, 7)
    ward_neighbours: int = 10
    ward_most: int | None = MOST_MICRO  # distinct points beyond which micro-clusters are linked
    pca_components: int = 3
    pca_options: tuple[int, ...] = (2, 3, 4)
    pca2_counts: tuple[int, ...] = (3, 4, 5)
    density_sizes: tuple[int, ...] = (200, 500, 1000)
    seeds: tuple[int, ...] = (42, 43, 44, 45, 46)
    max_std: float = selection.MAX_STD
    tolerance: float | None = TOLERANCE


def _stable_grid(grid: Grid) -> list[tuple[str, str, int | None, int]]:
    """(key, variant, components, clusters) of every stability candidate, in order."""
    options = dict.fromkeys((grid.pca_components, *grid.pca_options))
    rows = [(f"pca_{n}_baseline_kmeans_2", "pca", n, 2) for n in options]
    rows += [(f"pca_2_kmeans_{k}", "pca", 2, k) for k in grid.pca2_counts]
    rows.append(("robust_numeric_baseline_kmeans_2", "robust_numeric", None, 2))
    rows.append(("robust_pca_baseline_kmeans_2", "robust_pca", grid.pca_components, 2))
    return rows


def compare(train: DataFrame, validation: DataFrame, grid: Grid = Grid()) -> dict[str, DataFrame]:
    """Score tables and reports by name, and the winner's cluster profile."""
    with kept(train) as train, kept(validation) as validation:
        return _compare(train, validation, grid)


def _compare(train: DataFrame, validation: DataFrame, grid: Grid) -> dict[str, DataFrame]:
    spark = train.sparkSession
    reports: dict[str, DataFrame] = {}

    candidates = [
        (f"baseline_kmeans_{k}", selection.kmeans_candidate(k, grid.seed))
        for k in (grid.baseline_clusters,)
    ]
    candidates += [(f"kmeans_{k}", selection.kmeans_candidate(k, grid.seed)) for k in grid.kmeans_counts]
    candidates += [
        (f"gaussian_mixture_{k}", selection.mixture_candidate(k, grid.seed))
        for k in grid.mixture_counts
    ]

    # one fit per candidate and representation, then one per stability candidate and seed
    spaces = (("full", None), ("numeric_only", None), ("pca", grid.pca_components))
    plans = [(name, variant, n, fit) for variant, n in spaces for name, fit in candidates]
    stable = _stable_grid(grid)
    first_stable = len(plans)
    plans += [
        (key, variant, n, selection.kmeans_candidate(k, seed))
        for key, variant, n, k in stable
        for seed in grid.seeds
    ]
    found, models = selection.evaluate_plans(plans, train, validation, grid.tolerance)
    rows = [
        {**row, "representation": variant}
        for row, (_, variant, _, _) in zip(found[:first_stable], plans)
    ]
    stable_rows, seed_labels, winners = found[first_stable:], None, {}
    order = {}
    for i, (key, variant, _, _) in enumerate(stable):
        order[key] = i
        mine = models[first_stable + i * len(grid.seeds) :][: len(grid.seeds)]
        winners[key] = mine[0]
        if variant == "robust_pca":
            for seed, (fitted, centres) in zip(grid.seeds, mine):
                labels = assign(fitted.transform(validation), centres).select(
                    F.lit(seed).alias("seed"), "cluster"
                )
                seed_labels = labels if seed_labels is None else seed_labels.unionByName(labels)

    matrix = pearson_matrix(train, list(NUMERIC_COLUMNS))
    reports["customer_correlation"] = matrix
    reports["correlated_pairs"] = flag_correlated_pairs(
        matrix, list(NUMERIC_COLUMNS), 0.80, inclusive=False
    )
    reports["pca_loadings"] = pca_loadings(spark, fit_feature_map(train, "pca", 2))

    numeric = fit_feature_map(train, "numeric_only")
    # written down once, so the row numbers stay the same in every job
    points = cut_lineage(
        train.select(
            F.monotonically_increasing_id().alias("id"),
            "customer_id",
            numeric.features().alias("features"),
        )
    )
    density_rows, density_labels = [], {}
    with kept(points):
        if grid.ward_counts:
            ward = ward_clusters(
                points, list(grid.ward_counts), grid.ward_neighbours, most=grid.ward_most
            )
            rows += selection.evaluate_fit_scope(
                points.join(ward, "id"),
                {f"agglomerative_{k}": f"ward_{k}" for k in grid.ward_counts},
                "numeric_only",
                grid.tolerance,
            )
        for size in grid.density_sizes:
            labelled = points.join(density_clusters(points, size), "id")
            name = f"hdbscan_min_cluster_size_{size}"
            row = {
                "model_name": name,
                "representation": "numeric_only",
                "scoring_scope": "train_fit_non_noise",
            }
            counts = labelled.agg(
                F.count_if(F.col("cluster") >= 0).alias("retained_rows"),
                F.count_if(F.col("cluster") < 0).alias("noise_rows"),
                F.countDistinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).alias("n"),
            ).first()
            row.update(n_clusters_or_components=counts["n"], retained_rows=counts["retained_rows"])
            row["noise_rows"] = counts["noise_rows"]
            if counts["n"] < 2:
                row["reason"] = selection.ONE_CLUSTER
            else:
                scored = selection.evaluate_non_noise(labelled, "cluster", grid.tolerance).first()
                for c in ("silhouette_score", "davies_bouldin_score"):
                    row[c] = scored[c]
                density_labels[name] = labelled.select("customer_id", "cluster")
            density_rows.append(row)
        reports["inertia"] = kmeans_inertia(points, list(grid.kmeans_counts), grid.seed)

    for row in density_rows:
        # no seed: the same score stands for every seed, with deviation 0
        order[row["model_name"]] = len(order)
        stable_rows += [{**row, "seed": seed} for seed in grid.seeds]

    reports["scores"] = selection.score_table(spark, rows + density_rows)
    reports["margins"] = selection.baseline_margins(
        reports["scores"].filter("representation = 'pca'")
    )
    reports["representations"] = selection.representation_comparison(
        reports["scores"].filter("scoring_scope = 'validation'")
    )
    stable_scores = selection.score_table(spark, stable_rows)
    reports["stability_scores"] = stable_scores
    ranked = spark.createDataFrame(list(order.items()), "model_name string, place int")
    stability = selection.seed_stability(stable_scores, "model_name").join(ranked, "model_name")
    reports["selection"] = selection.select_stable(stability, "place", grid.max_std)
    reports["candidate_table"] = selection.candidate_table(
        reports["scores"].filter("representation = 'pca'"),
        stable_scores.filter(F.col("seed") == grid.seed).filter("representation = 'pca_2'"),
    )
    if seed_labels is not None:
        reports["size_diagnostics"] = selection.cluster_size_diagnostics(seed_labels)

    best = selection.winner(reports["selection"])["model_name"]
    if best in density_labels:
        labels = density_labels[best].withColumnRenamed("customer_id", "_customer")
        same = F.col("customer_id").eqNullSafe(F.col("_customer"))
        reports["winner_profile"] = cluster_profile(train.join(labels, same).drop("_customer"))
    if best in winners:
        fitted, centres = winners[best]
        points = train.withColumn("features", fitted.features())
        centres = in_order(points, centres, "monetary_value")
        reports["winner_profile"] = cluster_profile(assign(points, centres))
    return reports


def run_comparison(
    train: DataFrame,
    validation: DataFrame,
    out: str,
    previous: str | None = None,
    grid: Grid = Grid(),
) -> dict[str, DataFrame]:
    """Writes every report of a comparison, with the scores of an earlier one beside them."""
    reports = compare(train, validation, grid)
    if previous:
        scores = reports["scores"]
        earlier = scores.sparkSession.read.schema(scores.schema).json(f"{previous}/scores")
        reports["before_after"] = selection.before_after(earlier, scores)
    write_report(reports, out)
    return reports


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--splits", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--previous")
    parser.add_argument("--seed", type=int, default=Grid.seed)
    parser.add_argument("--density-sizes", type=int, nargs="*", default=list(Grid.density_sizes))
    given = parser.parse_args()
    spark = build_session("cohortlens-compare")
    train, validation = (
        read_features(spark, f"{given.splits}/{part}") for part in ("train", "validation")
    )
    grid = Grid(seed=given.seed, density_sizes=tuple(given.density_sizes))
    run_comparison(train, validation, given.output, given.previous, grid)
    clear_scratch(spark)


if __name__ == "__main__":
    main()
