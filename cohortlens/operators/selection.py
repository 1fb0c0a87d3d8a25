"""Comparing, diagnosing and selecting segmentation candidates.

Fits are jobs of their own; everything after them works on score tables
(model_name, representation, scoring_scope, seed, position, scores).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.operators.batched import Fit, fit_many
from cohortlens.operators.quality import davies_bouldin, quality_many, silhouette
from cohortlens.operators.scaling import FeatureMap, fit_feature_map
from cohortlens.session import kept

SCORE_SCHEMA = (
    "position int, model_name string, representation string, scoring_scope string, seed int, "
    "n_clusters_or_components int, silhouette_score double, davies_bouldin_score double, "
    "retained_rows long, noise_rows long, reason string"
)
MAX_STD = 0.05
#: Representations whose jobs run side by side; most of their rounds are too small to fill a cluster.
AT_ONCE = 4


#: Why a candidate has no scores.
ONE_CLUSTER = "fewer than two clusters among the scored rows"


def kmeans_candidate(k: int, seed: int) -> Fit:
    return Fit("kmeans", k, seed)


def mixture_candidate(k: int, seed: int) -> Fit:
    return Fit("mixture", k, seed)


def score_table(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Score rows in fit order; missing entries are null."""
    names = [part.split()[0] for part in SCORE_SCHEMA.split(", ")]
    return spark.createDataFrame(
        [tuple({**row, "position": i}.get(n) for n in names) for i, row in enumerate(rows)],
        SCORE_SCHEMA,
    )


def evaluate_candidates(
    candidates: list[tuple[str, Fit]],
    fitted: FeatureMap,
    train: DataFrame,
    validation: DataFrame,
    representation: str,
    tolerance: float | None = None,
) -> tuple[list[dict], list]:
    """Score rows and models: fits on train, scores the labels of the validation rows.

    ``fitted`` was fitted on train only. All candidates are fitted together, and
    scored together. One that puts all validation rows into one cluster has no
    scores but a reason.
    """
    fits = [fit for _, fit in candidates]
    with kept(fitted.transform(train)) as points:
        models = fit_many(points, fits)
    unseen = fitted.transform(validation).select(
        "features", *(m.label().alias(f"label_{i}") for i, m in enumerate(models))
    )
    with kept(unseen):
        scores = quality_many(unseen, [f"label_{i}" for i in range(len(models))], tolerance)
    rows = [
        {
            "model_name": name,
            "representation": representation,
            "scoring_scope": "validation",
            "seed": fit.seed,
            "n_clusters_or_components": fit.k,
            **(found or {"reason": ONE_CLUSTER}),
        }
        for (name, fit), found in zip(candidates, scores)
    ]
    return rows, models


def evaluate_plans(
    plans: list[tuple[str, str, int | None, Fit]],
    train: DataFrame,
    validation: DataFrame,
    tolerance: float | None = None,
) -> tuple[list[dict], list[tuple[FeatureMap, object]]]:
    """Score rows, and feature map and model, for each (name, variant, components, fit) in order.

    All plans of one representation share its fits' scans and the pass over its distances, and
    a fit or labeling that occurs twice there is made once. Representations run side by side.
    """
    places: dict[tuple[str, int | None], list[int]] = {}
    for i, (_, variant, n, _) in enumerate(plans):
        places.setdefault((variant, n), []).append(i)

    def one(key: tuple[str, int | None]):
        variant, n = key
        fitted = fit_feature_map(train, variant, n)
        fits = list(dict.fromkeys(plans[i][3] for i in places[key]))
        rows, models = evaluate_candidates(
            [("", fit) for fit in fits],
            fitted,
            train,
            validation,
            variant if n is None else f"{variant}_{n}",
            tolerance,
        )
        return fitted, dict(zip(fits, zip(rows, models)))

    with kept(train) as train, kept(validation) as validation:
        # filled before the representations ask for them at once
        train.count(), validation.count()
        with ThreadPoolExecutor(AT_ONCE) as pool:
            done = dict(zip(places, pool.map(one, places)))
    scored, made = [], []
    for name, variant, n, fit in plans:
        fitted, found = done[variant, n]
        row, model = found[fit]
        scored.append({**row, "model_name": name})
        made.append((fitted, model))
    return scored, made


def evaluate_fit_scope(
    labelled: DataFrame,
    label_columns: dict[str, str],
    representation: str,
    tolerance: float | None = None,
) -> list[dict]:
    """Scores labels on the rows they were fitted on, one row per label column."""
    columns = list(label_columns.values())
    scores = quality_many(labelled, columns, tolerance)
    counts = labelled.agg(*(F.countDistinct(c).alias(c) for c in columns)).first()
    return [
        {
            "model_name": name,
            "representation": representation,
            "scoring_scope": "train_fit",
            "n_clusters_or_components": counts[column],
            **(found or {"reason": ONE_CLUSTER}),
        }
        for (name, column), found in zip(label_columns.items(), scores)
    ]


def evaluate_non_noise(
    labelled: DataFrame, label: str = "cluster", tolerance: float | None = None
) -> DataFrame:
    """One row of scores after leaving out noise (label -1), with both counts."""
    kept = labelled.filter(F.col(label) != -1)
    counts = labelled.agg(
        F.count_if(F.col(label) != -1).alias("retained_rows"),
        F.count_if(F.col(label) == -1).alias("noise_rows"),
        F.countDistinct(F.when(F.col(label) != -1, F.col(label))).alias("n_clusters"),
    )
    return counts.select(
        "*",
        silhouette(kept, label, tolerance).scalar().alias("silhouette_score"),
        davies_bouldin(kept, label).scalar().alias("davies_bouldin_score"),
        F.lit("train_fit_non_noise").alias("scoring_scope"),
    )


def seed_stability(scores: DataFrame, *by: str) -> DataFrame:
    """Mean and population deviation of both scores per candidate over its seeds.

    Without a score for one of them there is no mean and no deviation.
    """
    whole = F.count("silhouette_score") == F.count(F.lit(1))
    return scores.groupBy(*by).agg(
        F.count(F.lit(1)).alias("seeds"),
        F.when(whole, F.avg("silhouette_score")).alias("silhouette_mean"),
        F.when(whole, F.stddev_pop("silhouette_score")).alias("silhouette_std"),
        F.avg("davies_bouldin_score").alias("davies_bouldin_mean"),
        F.stddev_pop("davies_bouldin_score").alias("davies_bouldin_std"),
    )


def select_stable(stability: DataFrame, order: str, max_std: float = MAX_STD) -> DataFrame:
    """Adds selection_score, exclusion reason and the winner flag.

    A candidate is excluded when its deviation is above ``max_std``; the winner
    has the highest mean minus deviation, the first in ``order`` on a tie.
    """
    # deviations are compared as they are: 0.05 itself is still eligible
    excluded = F.col("silhouette_std") > max_std
    scored = stability.withColumn(
        "selection_score",
        F.when(~excluded, F.col("silhouette_mean") - F.col("silhouette_std")),
    ).withColumn(
        "reason",
        F.when(excluded, F.lit(f"silhouette standard deviation exceeds {max_std}")).when(
            F.col("silhouette_mean").isNull(), F.lit(ONE_CLUSTER)
        ),
    )
    best = scored.filter("selection_score is not null").agg(
        F.min(F.struct((-F.col("selection_score")).alias("s"), F.col(order).alias("o")))["o"]
    )
    return scored.withColumn(
        "is_winner", F.coalesce(F.col(order) == best.scalar(), F.lit(False))
    )


def winner(selection: DataFrame):
    """The winning row; an error if no candidate was eligible."""
    row = selection.filter("is_winner").first()
    if row is None:
        raise ValueError("no segmentation candidate passed the stability limit")
    return row


def baseline_margins(scores: DataFrame) -> DataFrame:
    """Margins over the first baseline row, and the best validation candidate."""
    baseline = scores.filter(F.col("model_name").startswith("baseline_"))
    first = baseline.agg(
        F.min_by(F.struct("silhouette_score", "davies_bouldin_score"), "position")
    )
    best = scores.filter("scoring_scope = 'validation'").agg(
        F.min(F.struct((-F.col("silhouette_score")).alias("s"), F.col("position").alias("p")))["p"]
    )
    silhouette_margin = F.col("silhouette_score") - F.col("_baseline.silhouette_score")
    improvement = F.col("_baseline.davies_bouldin_score") - F.col("davies_bouldin_score")
    return (
        scores.withColumn("_baseline", first.scalar())
        .select(
            "position",
            "model_name",
            silhouette_margin.alias("silhouette_margin"),
            improvement.alias("davies_bouldin_improvement"),
            ((silhouette_margin > 0) & (improvement > 0)).alias("beats_baseline_on_both"),
            (F.col("position") == best.scalar()).alias("is_best_by_validation_silhouette"),
        )
    )


def representation_comparison(scores: DataFrame) -> DataFrame:
    """Scores of each model side by side for ``full`` and ``numeric_only``."""
    sides = ["full", "numeric_only"]
    return (
        scores.filter(F.col("representation").isin(sides))
        .groupBy("model_name")
        .pivot("representation", sides)
        .agg(
            F.max("silhouette_score").alias("silhouette"),
            F.max("davies_bouldin_score").alias("davies_bouldin"),
        )
    )


def before_after(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Both runs in one table, tagged ``before`` and ``after``."""
    return previous.withColumn("run", F.lit("before")).unionByName(
        current.withColumn("run", F.lit("after"))
    )


def candidate_table(*tables: DataFrame) -> DataFrame:
    """Union of score tables, first row per (model, representation), best first."""
    merged = tables[0].withColumn("_table", F.lit(0))
    for i, table in enumerate(tables[1:], 1):
        merged = merged.unionByName(table.withColumn("_table", F.lit(i)))
    first = W.partitionBy("model_name", "representation").orderBy("_table", "position")
    return (
        merged.withColumn("_place", F.row_number().over(first))
        .filter("_place = 1")
        .drop("_place", "_table", "position")
        .orderBy(F.desc("silhouette_score"), "model_name", "representation")
    )


def cluster_size_diagnostics(
    labels: DataFrame,
    seed: str = "seed",
    label: str = "cluster",
    dominance_threshold: float = 0.90,
) -> DataFrame:
    """Per seed: clusters, rows, largest share, and the one-versus-rest flag."""
    if not 0.0 < dominance_threshold <= 1.0:
        raise ValueError("dominance_threshold must lie in (0, 1]")
    sizes = labels.groupBy(seed, label).agg(F.count(F.lit(1)).alias("size"))
    per_seed = sizes.groupBy(seed).agg(
        F.count(F.lit(1)).alias("cluster_count"),
        F.sum("size").alias("total_rows"),
        (F.max("size") / F.sum("size")).alias("largest_cluster_share"),
    )
    degenerate = (F.col("cluster_count") == 2) & (
        F.col("largest_cluster_share") >= dominance_threshold
    )
    return per_seed.withColumn("is_degenerate", degenerate)


def any_degenerate(diagnostics: DataFrame) -> DataFrame:
    return diagnostics.agg(
        F.coalesce(F.bool_or("is_degenerate"), F.lit(False)).alias("any_degenerate")
    )


def promote_if_better(candidate: DataFrame, stored: DataFrame | None) -> DataFrame:
    """One row ``promote``: higher silhouette, then lower Davies-Bouldin.

    ``stored`` without a row (or with unreadable scores) never holds back.
    """
    if stored is None:
        return candidate.select(F.lit(True).alias("promote"))
    held = stored.agg(F.first(F.struct("silhouette_score", "davies_bouldin_score"))).scalar()
    judged = candidate.withColumn("_stored", held)
    old_s = F.col("_stored.silhouette_score")
    old_d = F.col("_stored.davies_bouldin_score")
    better = (F.col("silhouette_score") > old_s) | (
        (F.col("silhouette_score") == old_s) & (F.col("davies_bouldin_score") < old_d)
    )
    return judged.select(
        F.when(old_s.isNull() | old_d.isNull(), F.lit(True)).otherwise(better).alias("promote")
    )
