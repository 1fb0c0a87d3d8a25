"""Fitted segmentation models: train, keep, load, promote and apply."""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.functions.columns import seeded_key
from cohortlens.operators.clustering import Centres, assign, fit_kmeans
from cohortlens.operators.profiles import cluster_profile
from cohortlens.operators.quality import quality
from cohortlens.operators.scaling import FeatureMap, fit_feature_map
from cohortlens.operators.selection import promote_if_better
from cohortlens.operators.summaries import TOLERANCE
from cohortlens.session import cut_lineage, kept

METRICS_SCHEMA = "silhouette_score double, davies_bouldin_score double"


@dataclass(frozen=True)
class Bundle:
    """A fitted model: transform, centres, scores and the profile table."""

    feature_map: FeatureMap
    centres: Centres
    metrics: dict[str, float]
    profile: DataFrame
    trained_at: str = ""

    def label(self, features: DataFrame) -> DataFrame:
        """All feature columns plus ``features`` and ``cluster``."""
        return assign(features.withColumn("features", self.feature_map.features()), self.centres)


def train_segmentation(
    customer_features: DataFrame,
    seed: int = 42,
    n_components: int = 2,
    k: int = 2,
    tolerance: float | None = TOLERANCE,
) -> Bundle:
    """PCA and k-means on all rows; the scores are therefore in-sample.

    Beyond some thousand distinct points the silhouette is taken over summaries, so that its
    work does not grow with the square of the rows; ``silhouette_low`` and
    ``silhouette_high`` bound the exact value. Without ``tolerance`` it is exact.
    """
    with kept(customer_features):
        fitted = fit_feature_map(customer_features, "pca", n_components)
        points = customer_features.select("monetary_value", fitted.features().alias("features"))
        with kept(points):
            centres = fit_kmeans(points, k, seed, order_by="monetary_value")
            metrics = quality(assign(points, centres), "cluster", tolerance)
        labelled = assign(customer_features.withColumn("features", fitted.features()), centres)
        # written while the features are kept: a row per cluster, read by every later use
        profile = cut_lineage(cluster_profile(labelled))
    stamp = dt.datetime.now(dt.timezone.utc).isoformat()
    return Bundle(fitted, centres, metrics, profile, stamp)


def training_report(bundle: Bundle, customer_features: DataFrame, **parameters) -> DataFrame:
    """One row: rows, feature columns, parameters, scores and cluster sizes of a fit."""
    sizes = F.map_from_entries(
        F.array_sort(F.collect_list(F.struct("cluster", F.col("cluster_size"))))
    )
    return bundle.profile.agg(sizes.alias("cluster_sizes")).select(
        customer_features.agg(F.count(F.lit(1))).scalar().alias("rows"),
        F.lit(bundle.feature_map.feature_names()).alias("feature_columns"),
        F.lit(json.dumps(parameters, sort_keys=True)).alias("parameters"),
        F.lit(json.dumps(bundle.metrics, sort_keys=True)).alias("metrics"),
        "cluster_sizes",
        F.lit(bundle.trained_at).alias("trained_at"),
    )


def save_model(bundle: Bundle, path: str) -> None:
    """Adds the bundle as the newest version at ``path``.

    The profile is written first, under the version's own name. The version then
    counts from the moment its one row is committed to the ``model`` table, to
    which rows are only ever added: a run that ends in between changes nothing,
    and a bundle loaded from the same path is never overwritten.
    """
    spark = bundle.profile.sparkSession
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    bundle.profile.write.parquet(f"{path}/profile/{version}")
    spark.createDataFrame(
        [
            (
                version,
                bundle.feature_map.to_json(),
                bundle.centres.to_json(),
                json.dumps(bundle.metrics),
                bundle.trained_at,
            )
        ],
        "version string, feature_map string, centres string, metrics string, trained_at string",
    ).coalesce(1).write.mode("append").parquet(f"{path}/model")


def load_model(spark: SparkSession, path: str) -> Bundle:
    """The newest version; fails if the model or its profile is absent."""
    try:
        row = spark.read.parquet(f"{path}/model").orderBy(F.desc("version")).first()
        profile = spark.read.parquet(f"{path}/profile/{row['version']}")
    except (AnalysisException, TypeError) as error:
        raise FileNotFoundError(f"no complete model at {path}") from error
    return Bundle(
        FeatureMap.from_json(row["feature_map"]),
        Centres.from_json(row["centres"]),
        json.loads(row["metrics"]),
        profile,
        row["trained_at"],
    )


def promote(bundle: Bundle, path: str) -> bool:
    """Saves the bundle at ``path`` if it beats the model stored there."""
    spark = bundle.profile.sparkSession
    try:
        stored = load_model(spark, path).metrics
    except (FileNotFoundError, ValueError, TypeError):
        stored = None
    columns = ("silhouette_score", "davies_bouldin_score")

    def table(metrics):
        rows = [] if metrics is None else [tuple(metrics.get(c) for c in columns)]
        return spark.createDataFrame(rows, METRICS_SCHEMA)

    decision = promote_if_better(table(bundle.metrics), table(stored)).first()["promote"]
    if decision:
        save_model(bundle, path)
    return decision


def assign_clusters(features: DataFrame, bundle: Bundle, id_column: str = "customer_id") -> DataFrame:
    return bundle.label(features).select(id_column, "cluster")


def attach_profile(labels: DataFrame, profile: DataFrame) -> DataFrame:
    """Label rows with their profile; a label without a profile is an error.

    Missing text in a profile reads as the empty string. The profile, one row
    per cluster, is looked up in each label row; a join on the cluster would put
    all rows of a large cluster into one task.
    """
    texts = [f.name for f in profile.schema.fields if f.dataType.simpleString() == "string"]
    known = profile.fillna("", texts)
    columns = [c for c in profile.columns if c != "cluster"]
    names = {c: f"profile_{c}" if c in labels.columns else c for c in columns}
    row = F.struct(*[F.col(f"`{c}`").alias(names[c]) for c in columns])
    rows = known.agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("cluster"), row))).alias("rows")
    ).scalar()
    found = labels.withColumn("_profile", F.try_element_at(rows, F.col("cluster")))
    checked = F.when(
        F.col("_profile").isNull(),
        F.raise_error(F.concat(F.lit("no cluster profile for "), F.col("cluster").cast("string"))),
    ).otherwise(F.col("cluster"))
    others = [c for c in labels.columns if c != "cluster"]
    return found.select(
        checked.alias("cluster"),
        *[F.col(f"`{c}`") for c in others],
        *[F.col(f"_profile.`{n}`").alias(n) for n in names.values()],
    )


def score_feature_table(
    features: DataFrame, bundle: Bundle, id_column: str = "customer_id"
) -> DataFrame:
    """(id, cluster, component_1, component_2)."""
    return bundle.label(features).select(
        id_column,
        "cluster",
        F.get("features", F.lit(0)).alias("component_1"),
        F.get("features", F.lit(1)).alias("component_2"),
    )


def cluster_distribution(assignments: DataFrame, label: str = "cluster") -> DataFrame:
    """(cluster, size, share); the window sees one row per cluster."""
    sizes = assignments.groupBy(label).agg(F.count(F.lit(1)).alias("size"))
    return sizes.withColumn("share", F.col("size") / F.sum("size").over(W.partitionBy()))


def sample_map(points: DataFrame, id_column: str, n: int = 12000, seed: int = 42) -> DataFrame:
    """A repeatable sample of at most ``n`` points for a scatter map."""
    return points.orderBy(seeded_key(seed, id_column), id_column).limit(n)


def customer_lookup(
    features: DataFrame, labels: DataFrame, profile: DataFrame, customer_id
) -> DataFrame:
    """One customer's features, cluster and cluster profile."""
    one = features.filter(F.col("customer_id") == F.lit(customer_id))
    labelled = one.join(labels.filter(F.col("customer_id") == F.lit(customer_id)), "customer_id")
    return attach_profile(labelled, profile)
