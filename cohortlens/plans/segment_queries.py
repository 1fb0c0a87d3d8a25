"""Segmentation: transforms, clusters, quality, selection and scoring.

Fitted results differ between engines, so operators that fit are registered
without a SQL twin. Everything that takes labels, centres or scores as given is
compared: labels come with the vectors, centres are their means, and score
tables are aggregates of the events.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.operators import (
    batched,
    clustering,
    microclusters,
    neighbours,
    quality,
    scaling,
    scoring,
    selection,
)
from cohortlens.operators.density import density_clusters
from cohortlens.operators.linkage import ward_clusters
from cohortlens.operators.profiles import cluster_profile
from cohortlens.operators.splits import frames, split_random
from cohortlens.plans.compare import Grid, compare
from cohortlens.plans.customer_queries import FEATURES_SQL, feature_table
from cohortlens.plans.registry import Query
from cohortlens.plans.stages import Options, run_stages
from cohortlens.session import cut_lineage, scratch_path
from cohortlens.sources.contract import CONTRACT
from cohortlens.sources.transactions import star_transactions


def _sql(select: str, *ctes: str) -> str:
    """``select`` over the customer features and further CTEs."""
    head, tail = FEATURES_SQL.rsplit("SELECT * FROM features", 1)
    return ",\n".join([head.rstrip(), *ctes]) + "\n" + select + tail


# --- transforms of the customer features ---


def _standard(spark, folder):
    df = feature_table(spark, folder)
    return scaling.scaled_columns(
        df, scaling.fit_standard(df, scaling.STANDARD_COLUMNS), "customer_id"
    )


def _log1p(spark, folder):
    df = feature_table(spark, folder)
    return scaling.scaled_columns(
        df, scaling.fit_standard(df, scaling.SKEWED_COLUMNS, log=True), "customer_id"
    )


def _robust(spark, folder):
    df = feature_table(spark, folder)
    return scaling.scaled_columns(
        df, scaling.fit_robust(df, scaling.STANDARD_COLUMNS), "customer_id"
    )


def _one_hot_sparse(spark, folder):
    """Orders by customer and day: as many levels as there are customers and days."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").cast("string").alias("day"),
        F.col("o_totalprice").cast("double"),
    )
    columns = ("day", "o_custkey")
    # levels come from most orders, so that some levels of the others are unknown
    levels = scaling.level_table(orders.filter("o_orderkey % 5 <> 0"), columns)
    scales = (scaling.Scale("o_totalprice", 1000.0, 10.0),)
    hot = scaling.sparse_features(orders, scales, levels, columns, "o_orderkey")
    ones = F.expr("slice(features.indices, 2, 2)")
    return hot.select(
        "o_orderkey",
        F.col("features.size").alias("width"),
        F.col("features.values")[0].alias("price"),
        F.size(ones).alias("known"),
        F.aggregate(ones, F.lit(0), lambda total, place: total + place).alias("places"),
    )


def _one_hot(spark, folder):
    df = feature_table(spark, folder).select("customer_id", *scaling.CATEGORY_COLUMNS)
    hot = scaling.one_hot_columns(
        df, scaling.fit_levels(df, scaling.CATEGORY_COLUMNS), "customer_id"
    )
    names = [c for c in hot.columns if c != "customer_id"]
    return hot.unpivot("customer_id", names, "level", "flag").filter("flag = 1").drop("flag")


def _long_features(variant):
    def build(spark, folder):
        df = feature_table(spark, folder)
        fitted = scaling.fit_feature_map(df, variant)
        names = F.array(*[F.lit(n) for n in fitted.feature_names()])
        return fitted.transform(df, "customer_id").select(
            "customer_id", F.posexplode("features").alias("place", "value")
        ).select("customer_id", F.get(names, F.col("place")).alias("feature"), "value")

    return build


def _scaled_sql(columns, expression) -> str:
    return ", ".join(f"{expression.format(c=c)} AS {c}" for c in columns)


_Z = "({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1)"
_ZLOG = _Z.replace("{c}", "ln(1 + {c})")
_LEVEL = "lower(replace(replace({c}, ' ', '_'), '-', '_'))"

_LONG_NUMERIC = " UNION ALL ".join(
    f"SELECT customer_id, '{c}' AS feature, {e.format(c=c)} AS value FROM features"
    for columns, e in ((scaling.STANDARD_COLUMNS, _Z), (scaling.SKEWED_COLUMNS, _ZLOG))
    for c in columns
)
_LONG_HOT = " UNION ALL ".join(
    f"SELECT f.customer_id, '{c}=' || l.level, CASE WHEN f.{c} = l.level THEN 1.0 ELSE 0.0 END "
    f"FROM features f, (SELECT DISTINCT {c} AS level FROM features) l"
    for c in scaling.CATEGORY_COLUMNS
)
_MEDIANS = "medians AS (SELECT " + ", ".join(
    f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m_{c}, coalesce(nullif(quantile_cont(CAST({c} AS DOUBLE), 0.75) - "
    f"quantile_cont(CAST({c} AS DOUBLE), 0.25), 0), 1) AS s_{c}"
    for c in scaling.STANDARD_COLUMNS
) + " FROM features)"


# Principal axes in SQL: the covariance matrix is squared until it is a projection on its
# first axis, which is then taken out of the matrix for the second one.
_N = len(scaling.STANDARD_COLUMNS) + len(scaling.SKEWED_COLUMNS)


def _axes_ctes(scaled: str) -> list[str]:
    """``axes`` (matrix, first, second, first_share, second_share) of ``scaled`` rows of (id, z)."""
    covariance = ", ".join(
        "[" + ", ".join(f"covar_samp(z[{i}], z[{j}])" for j in range(1, _N + 1)) + "]"
        for i in range(1, _N + 1)
    )
    diagonal = ", ".join(f"m[{i}][{i}]" for i in range(1, _N + 1))

    def first_axis(name: str, source: str) -> list[str]:
        place = f"list_position([{diagonal}], list_max([{diagonal}]))"
        vector = f"list_transform(m[{place}], lambda x: x / sqrt(m[{place}][{place}]))"
        signed = (
            "list_transform(v, lambda x: x * CASE WHEN list_max(v) >= -list_min(v) "
            "THEN 1 ELSE -1 END)"
        )
        return [
            f"""{name}_power AS (
              SELECT 0 AS t, m FROM {source} UNION ALL
              SELECT t + 1, [[list_dot_product(r, c) / list_sum([list_dot_product(d, d) FOR d IN m])
                              FOR c IN m] FOR r IN m]
              FROM {name}_power WHERE t < 45)""",
            f"""{name}_axis AS (SELECT {signed} AS v FROM (
              SELECT {vector} AS v FROM {name}_power WHERE t = 45))""",
            f"""{name}_value AS (SELECT v, list_dot_product(v, [list_dot_product(r, v) FOR r IN m])
                                AS value, m FROM {name}_axis, {source})""",
        ]

    return [
        f"matrix AS (SELECT [{covariance}] AS m FROM {scaled})",
        *first_axis("one", "matrix"),
        """rest AS (SELECT [[m[i][j] - value * v[i] * v[j] FOR j IN range(1, len(v) + 1)]
                            FOR i IN range(1, len(v) + 1)] AS m FROM one_value)""",
        *first_axis("two", "rest"),
        f"""axes AS (SELECT one_value.v AS first, two_value.v AS second,
                       one_value.value / list_sum([{diagonal.replace("m[", "matrix.m[")}]) AS first_share,
                       two_value.value / list_sum([{diagonal.replace("m[", "matrix.m[")}]) AS second_share
                FROM one_value, two_value, matrix)""",
    ]


def _loadings_sql(scaled: str) -> str:
    names = ", ".join(f"'{c}'" for c in (*scaling.STANDARD_COLUMNS, *scaling.SKEWED_COLUMNS))
    return " UNION ALL ".join(
        f"""SELECT {k} AS component, {axis}_share AS explained_variance_ratio,
                   unnest([{names}]) AS feature, unnest({axis}) AS loading FROM axes"""
        for k, axis in ((1, "first"), (2, "second"))
    )


_SCALED = "scaled AS (SELECT customer_id, [" + ", ".join(
    f"CAST({e.format(c=c)} AS DOUBLE)"
    for columns, e in ((scaling.STANDARD_COLUMNS, _Z), (scaling.SKEWED_COLUMNS, _ZLOG))
    for c in columns
) + "] AS z FROM features)"
_ROBUST_SCALED = "scaled AS (SELECT customer_id, [" + ", ".join(
    [f"CAST(({c} - m_{c}) / s_{c} AS DOUBLE)" for c in scaling.STANDARD_COLUMNS]
    + [f"CAST({_ZLOG.format(c=c)} AS DOUBLE)" for c in scaling.SKEWED_COLUMNS]
) + "] AS z FROM features, medians)"
_MEAN = "centre AS (SELECT [" + ", ".join(f"avg(z[{i}])" for i in range(1, _N + 1)) + "] AS c FROM scaled)"


def _recursive(sql: str) -> str:
    """Recursive CTEs are named as such at the head of their list."""
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def _pca(spark, folder):
    df = feature_table(spark, folder)
    fitted = scaling.fit_feature_map(df, "pca", 2)
    return fitted.transform(df, "customer_id").select(
        "customer_id",
        F.get("features", F.lit(0)).alias("component_1"),
        F.get("features", F.lit(1)).alias("component_2"),
    )


def _loadings(variant):
    def build(spark, folder):
        df = feature_table(spark, folder)
        return scaling.pca_loadings(spark, scaling.fit_feature_map(df, variant, 2))

    return build


# --- fits on the customer features ---


def _points(spark, folder, variant="pca", n_components=2):
    df = feature_table(spark, folder)
    fitted = scaling.fit_feature_map(df, variant, n_components)
    return fitted.transform(df, "customer_id", "monetary_value")


def _kmeans(spark, folder):
    points = _points(spark, folder)
    centres = clustering.fit_kmeans(points, 2, 42, "monetary_value")
    return clustering.assign(points, centres).select("customer_id", "cluster")


def _inertias(spark, folder):
    return batched.kmeans_inertia(_points(spark, folder, "numeric_only"), [3, 4, 5, 6, 7])


def _mixture(spark, folder):
    points = _points(spark, folder)
    labelled = []
    for n in (3, 4, 5, 6, 7):
        model = clustering.fit_diagonal_mixture(points, n, 42)
        labelled.append(
            clustering.assign(points, model).select(
                "customer_id", F.lit(n).alias("components"), "cluster"
            )
        )
    return reduce(DataFrame.unionByName, labelled)


def _halves(spark, folder):
    # written once: the split counts and cuts it by itself, and every part would make it again
    return frames(split_random(cut_lineage(feature_table(spark, folder))))


def _candidates(spark, folder):
    split = _halves(spark, folder)
    fitted = scaling.fit_feature_map(split["train"], "pca", 2)
    candidates = [("baseline_kmeans_2", selection.kmeans_candidate(2, 42))]
    candidates += [(f"kmeans_{k}", selection.kmeans_candidate(k, 42)) for k in range(3, 8)]
    candidates += [
        (f"gaussian_mixture_{k}", selection.mixture_candidate(k, 42)) for k in range(3, 8)
    ]
    rows, _ = selection.evaluate_candidates(
        candidates, fitted, split["train"], split["validation"], "pca"
    )
    return selection.score_table(spark, rows)


def _sweep(spark, folder):
    """The sweeps of the comparison: axes, clusters on two axes, robust scales."""
    split = _halves(spark, folder)
    plans = [("pca", n, 2) for n in (2, 3, 4)] + [("pca", 2, k) for k in (3, 4, 5)]
    plans += [("robust_numeric", None, 2), ("robust_pca", 3, 2)]
    rows, _ = selection.evaluate_plans(
        [(f"kmeans_{k}", variant, n, selection.kmeans_candidate(k, 42)) for variant, n, k in plans],
        split["train"],
        split["validation"],
    )
    return selection.score_table(spark, rows)


def _trained(spark, folder):
    bundle = scoring.train_segmentation(feature_table(spark, folder))
    return bundle.profile


def _scored(spark, folder):
    features = feature_table(spark, folder)
    return scoring.score_feature_table(features, scoring.train_segmentation(features))


def _reloaded(spark, folder):
    features = feature_table(spark, folder)
    path = scratch_path(spark, "model")
    scoring.promote(scoring.train_segmentation(features), path)
    return scoring.score_feature_table(features, scoring.load_model(spark, path))


# A model whose axes and centres are given instead of fitted.
_GIVEN_AXES = tuple(
    tuple((-1.0) ** (i // (1 + a)) / 3.0 for i in range(_N)) for a in (0, 1)
)
_GIVEN_CENTRES = ((0.5, 0.5), (-0.5, 0.0), (0.0, -1.0))


def _given_bundle(spark, folder):
    features = feature_table(spark, folder)
    scales = scaling.fit_standard(features, scaling.STANDARD_COLUMNS) + scaling.fit_standard(
        features, scaling.SKEWED_COLUMNS, log=True
    )
    fitted = scaling.FeatureMap(
        "given", scales, means=(0.0,) * _N, components=_GIVEN_AXES, explained_variance_ratio=(0.0,) * 2
    )
    centres = clustering.Centres(_GIVEN_CENTRES)
    labelled = clustering.assign(features.withColumn("features", fitted.features()), centres)
    metrics = {"silhouette_score": 0.0, "davies_bouldin_score": 0.0}
    return features, scoring.Bundle(fitted, centres, metrics, cluster_profile(labelled))


def _scored_by_given(spark, folder):
    return scoring.score_feature_table(*_given_bundle(spark, folder))


def _reloaded_given(spark, folder):
    """Two versions are saved; the newer one is loaded, scored with and profiled."""
    features, bundle = _given_bundle(spark, folder)
    path = scratch_path(spark, "model")
    scoring.save_model(replace(bundle, centres=clustering.Centres(((9.0, 9.0),))), path)
    scoring.save_model(bundle, path)
    loaded = scoring.load_model(spark, path)
    labels = scoring.assign_clusters(features, loaded)
    return scoring.attach_profile(labels, loaded.profile).select(
        "customer_id", "cluster", "cluster_size"
    )


_GIVEN_SQL = [
    _SCALED,
    "placed AS (SELECT customer_id, "
    + ", ".join(
        f"list_dot_product(z, [{', '.join(f'CAST({x!r} AS DOUBLE)' for x in axis)}]) AS component_{i}"
        for i, axis in enumerate(_GIVEN_AXES, 1)
    )
    + " FROM scaled)",
    "given_labels AS (SELECT *, CASE "
    + " ".join(
        f"WHEN d{i} <= least(d0, d1, d2) THEN {i}" for i in range(len(_GIVEN_CENTRES))
    )
    + " END AS cluster FROM (SELECT *, "
    + ", ".join(
        f"(component_1 - ({x})) ** 2 + (component_2 - ({y})) ** 2 AS d{i}"
        for i, (x, y) in enumerate(_GIVEN_CENTRES)
    )
    + " FROM placed))",
]


def _mixture_round(spark, folder):
    """One round of expectation and maximisation from the moments of the given labels."""
    return clustering.mixture_round(_vectors(spark, folder), "cluster")


def _unlabelled(spark, folder):
    return spark.read.parquet(f"{folder}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features")
    )


def _ward(spark, folder):
    return ward_clusters(_unlabelled(spark, folder), [3, 4, 5, 6, 7])


def _micro_moments(spark, folder):
    """Mean and variance of each axis of all vectors, from the features of two halves."""
    rows = _unlabelled(spark, folder)
    weighted = rows.groupBy("features").agg(F.count(F.lit(1)).alias("weight"))
    tree = microclusters.fit_micro_tree(weighted, 64)
    placed = microclusters.place_points(rows, tree)
    even = F.col("id") % 2 == 0
    halves = [placed.filter(even), placed.filter(~even)]
    features = microclusters.merge_features(
        *[microclusters.clustering_features(half) for half in halves]
    )
    found = microclusters.micro_clusters(features, tree)
    squares = F.col("scatter") + F.col("n") * F.aggregate(
        "centre", F.lit(0.0), lambda total, x: total + x * x
    )
    total = found.agg(
        F.sum("n").cast("bigint").alias("n"),
        F.min("cluster").alias("first_id"),
        F.sum(squares).alias("squares"),
    )
    axes = (
        found.select("n", F.posexplode("centre").alias("axis", "x"))
        .groupBy("axis")
        .agg((F.sum(F.col("n") * F.col("x")) / F.sum("n")).alias("mean"))
    )
    return total.join(axes).select("axis", "mean", "n", "first_id", "squares")


def _density(spark, folder):
    return density_clusters(_unlabelled(spark, folder), 5)


def _stage_run(spark, folder):
    df = star_transactions(spark, folder)
    ids = ("order_id", "customer_id", "product_id")
    source = df.withColumns({c: F.col(c).cast("string") for c in ids})
    out = scratch_path(spark, "run")
    result = run_stages(
        source,
        out,
        Options(
            contract=CONTRACT.restricted_to(source.columns),
            allowed_categories={"return_status": ["No Return", "Returned"]},
            allow_duplicate_rows=True,
            as_of="2000-01-01",
        ),
    )
    if result.status != "succeeded":
        raise RuntimeError(f"{result.failed_stage}: {result.error}")
    bundle = scoring.load_model(spark, f"{out}/models/best")
    features = spark.read.parquet(f"{out}/customer_features")
    return scoring.attach_profile(
        scoring.assign_clusters(features, bundle), bundle.profile
    ).select("customer_id", "cluster", "cluster_size", "preferred_category")


def _comparison_run(spark, folder):
    split = _halves(spark, folder)
    # density, whose rounds are slow on small tables, is a query of its own
    grid = Grid(density_sizes=())
    return compare(split["train"], split["validation"], grid)["selection"]


# --- given labels: the vectors ---


def _vectors(spark, folder):
    return spark.read.parquet(f"{folder}/embeddings.parquet").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("features"),
        F.col("label").cast("bigint").alias("cluster"),
    )


_V = """v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x, CAST(label AS BIGINT) AS cluster
              FROM embeddings)"""


def _silhouette_ctes(source: str, prefix: str = "") -> list[str]:
    return [
        f"""{prefix}gaps AS (SELECT a.id, a.cluster AS own, b.cluster AS other, sum(list_distance(a.x, b.x)) AS total,
              count(*) AS n FROM {source} a, {source} b GROUP BY ALL)""",
        f"""{prefix}sides AS (SELECT id, max(CASE WHEN own = other THEN total / nullif(n - 1, 0) END) AS a,
              min(CASE WHEN own <> other THEN total / n END) AS b FROM {prefix}gaps GROUP BY id)""",
        f"""{prefix}sil AS (SELECT avg(CASE WHEN a IS NULL THEN 0.0
              ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0.0) END) AS silhouette_score FROM {prefix}sides)""",
    ]


def _bouldin_ctes(source: str, prefix: str = "") -> list[str]:
    return [
        f"""{prefix}centres AS (SELECT cluster, list(m ORDER BY pos) AS c FROM (
              SELECT cluster, pos, avg(val) AS m FROM (SELECT cluster, unnest(x) AS val,
                unnest(generate_series(1, len(x))) AS pos FROM {source}) GROUP BY cluster, pos) GROUP BY cluster)""",
        f"""{prefix}spreads AS (SELECT cluster, avg(list_distance(x, c)) AS s, any_value(c) AS c
              FROM {source} JOIN {prefix}centres USING (cluster) GROUP BY cluster)""",
        f"""{prefix}db AS (SELECT avg(w) AS davies_bouldin_score FROM (
              SELECT a.cluster, max((a.s + b.s) / list_distance(a.c, b.c)) AS w
              FROM {prefix}spreads a JOIN {prefix}spreads b ON a.cluster <> b.cluster GROUP BY a.cluster))""",
    ]


def _with(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


_NON_NOISE = "kept AS (SELECT id, x, cluster FROM v WHERE cluster <> 0)"


def _non_noise(spark, folder):
    labelled = _vectors(spark, folder).withColumn(
        "cluster", F.when(F.col("cluster") == 0, -1).otherwise(F.col("cluster"))
    )
    return selection.evaluate_non_noise(labelled)


def _fit_scope(spark, folder):
    labelled = _vectors(spark, folder).withColumn("half", (F.col("cluster") >= 5).cast("int"))
    rows = selection.evaluate_fit_scope(
        labelled, {"ten": "cluster", "two": "half"}, "vectors"
    )
    return selection.score_table(spark, rows).select(
        "model_name", "scoring_scope", "n_clusters_or_components", "silhouette_score", "davies_bouldin_score"
    )


def _mean_centres(spark, folder):
    """Centres as given numbers: the mean vector of each label."""
    rows = (
        _vectors(spark, folder)
        .groupBy("cluster")
        .agg(vector_to_array(Summarizer.mean(array_to_vector("features"))).alias("c"))
        .orderBy("cluster")
        .collect()  # one row per label
    )
    return clustering.Centres(tuple(tuple(r["c"]) for r in rows))


def _assigned(spark, folder):
    points = _vectors(spark, folder).drop("cluster")
    return clustering.assign(points, _mean_centres(spark, folder)).select("id", "cluster")


_NEAREST = """SELECT id, cluster FROM (SELECT v.id, c.cluster, row_number() OVER (PARTITION BY v.id
   ORDER BY list_distance(v.x, c.c), c.cluster) AS place FROM v, centres c) WHERE place = 1"""


# --- given labels: customers split by a rule ---

_RULE = "CAST(frequency > 10 AS INT) + CAST(monetary_value > 400000 AS INT)"


def _labelled_customers(spark, folder):
    return feature_table(spark, folder).withColumn("cluster", F.expr(_RULE))


_L = f"labelled AS (SELECT *, {_RULE} AS cluster FROM features)"
_MEANS = [c for c in (
    "recency_days", "frequency", "monetary_value", "avg_order_value", "order_value_std",
    "product_diversity", "purchase_velocity", "return_rate", "coupon_usage_rate")]


def _profile_mode(c: str) -> str:
    return f"""p_{c} AS (SELECT cluster, {c} FROM (SELECT cluster, {c}, row_number() OVER (PARTITION BY cluster
        ORDER BY count(*) DESC, {c} NULLS LAST) AS place FROM labelled GROUP BY cluster, {c}) WHERE place = 1)"""


_PROFILE = (
    "profile AS (SELECT cluster, count(*) AS cluster_size, "
    + ", ".join(f"avg({c}) AS {c}" for c in _MEANS)
    + """, min(customer_id) AS customer_id, any_value(p1.preferred_category) AS preferred_category,
        any_value(p2.preferred_payment_method) AS preferred_payment_method
      FROM labelled l JOIN p_preferred_category p1 USING (cluster)
      JOIN p_preferred_payment_method p2 USING (cluster) GROUP BY cluster)"""
)
_PROFILE_CTES = [
    _L,
    _profile_mode("preferred_category"),
    _profile_mode("preferred_payment_method"),
    _PROFILE,
]
_PROFILE_DIGITS = {c: (2 if c in ("monetary_value", "avg_order_value", "order_value_std") else 6) for c in _MEANS}


def _profile(spark, folder):
    return cluster_profile(_labelled_customers(spark, folder))


def _attached(spark, folder):
    labelled = _labelled_customers(spark, folder)
    labels = labelled.select("customer_id", "cluster")
    return scoring.attach_profile(labels, cluster_profile(labelled)).select(
        "customer_id", "cluster", "cluster_size", "monetary_value", "preferred_category"
    )


def _lookup(spark, folder):
    labelled = _labelled_customers(spark, folder)
    features = labelled.drop("cluster")
    labels = labelled.select("customer_id", "cluster")
    # the customer with the most orders, ties to the smaller id
    who = features.agg(F.min_by("customer_id", F.struct(-F.col("frequency"), F.col("customer_id"))))
    return scoring.customer_lookup(
        features, labels, cluster_profile(labelled), who.first()[0]
    ).select(
        "customer_id", "frequency", "monetary_value", "cluster", "cluster_size",
        "profile_frequency", "profile_monetary_value", "profile_preferred_category",
    )


# --- given scores: aggregates of the events ---

_MODEL = "CASE WHEN event_type = 'view' THEN 'baseline_view' ELSE event_type END"
_SCORES = f"""scores AS (SELECT *, row_number() OVER (ORDER BY model_name, representation, seed) AS position FROM (
   SELECT {_MODEL} AS model_name,
          CASE WHEN hour(ts) < 12 THEN 'full' ELSE 'numeric_only' END AS representation,
          CASE WHEN event_type = 'error' THEN 'train_fit' ELSE 'validation' END AS scoring_scope,
          41 + day(ts) AS seed, avg(value) / 100 AS silhouette_score,
          stddev_samp(value) / 10 AS davies_bouldin_score
   FROM events GROUP BY ALL))"""
_STABLE = """stable AS (SELECT model_name, representation, count(*) AS seeds, avg(silhouette_score) AS silhouette_mean,
   stddev_pop(silhouette_score) AS silhouette_std, avg(davies_bouldin_score) AS davies_bouldin_mean,
   stddev_pop(davies_bouldin_score) AS davies_bouldin_std FROM scores GROUP BY ALL)"""
_STABLE_DIGITS = {
    "silhouette_mean": 6,
    "silhouette_std": 6,
    "davies_bouldin_mean": 6,
    "davies_bouldin_std": 6,
}
_LIMIT = 0.03


def _scores(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    grouped = events.groupBy(
        F.expr(_MODEL).alias("model_name"),
        F.when(F.hour("ts") < 12, "full").otherwise("numeric_only").alias("representation"),
        F.when(F.col("event_type") == "error", "train_fit").otherwise("validation").alias(
            "scoring_scope"
        ),
        (F.dayofmonth("ts") + 41).alias("seed"),
    ).agg(
        (F.avg("value") / 100).alias("silhouette_score"),
        (F.stddev_samp("value") / 10).alias("davies_bouldin_score"),
    )
    # one row per model, representation and day
    return grouped.withColumn(
        "position",
        F.row_number().over(W.orderBy("model_name", "representation", "seed")),
    )


def _stability(spark, folder):
    return selection.seed_stability(_scores(spark, folder), "model_name", "representation")


def _selected(spark, folder):
    stable = _stability(spark, folder).withColumn(
        "place", F.concat_ws("/", "model_name", "representation")
    )
    return selection.select_stable(stable, "place", _LIMIT).select(
        "model_name", "representation", "selection_score", "is_winner",
        F.col("reason").isNotNull().alias("is_excluded"),
    )


_SCORE_DIGITS = {"silhouette_score": 6, "davies_bouldin_score": 6}


def _candidate_table(spark, folder):
    scores = _scores(spark, folder)
    first = scores.filter("representation = 'full'")
    second = scores.select(
        *[F.lit("full").alias(c) if c == "representation" else F.col(c) for c in scores.columns]
    )
    return selection.candidate_table(first, scores, second).drop("seed")


def _promotion(spark, folder):
    table = _scores(spark, folder).groupBy("model_name").agg(
        F.avg("silhouette_score").alias("silhouette_score"),
        F.avg("davies_bouldin_score").alias("davies_bouldin_score"),
    )
    stored = table.filter("model_name = 'baseline_view'")
    result = None
    for name in ("click", "error", "purchase", "signup"):
        one = selection.promote_if_better(
            table.filter(F.col("model_name") == name), stored
        ).withColumn("model_name", F.lit(name))
        result = one if result is None else result.unionByName(one)
    return result


def _comparison(spark, folder):
    return selection.representation_comparison(
        _scores(spark, folder).groupBy("model_name", "representation").agg(
            F.avg("silhouette_score").alias("silhouette_score"),
            F.avg("davies_bouldin_score").alias("davies_bouldin_score"),
        )
    )


def _two_runs(spark, folder):
    scores = _scores(spark, folder).select(
        "model_name", "representation", "seed", "silhouette_score"
    )
    return selection.before_after(
        scores.filter("representation = 'full'"), scores.filter("representation <> 'full'")
    )


def _seed_labels(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    # two clusters per seed; for seeds above 45 almost all rows share one
    cut = F.when(F.col("l_linenumber") > 3, 0.005).otherwise(0.05)
    return lines.select(
        (F.col("l_linenumber") + 41).alias("seed"),
        (F.col("l_discount") > cut).cast("int").alias("cluster"),
    )


_SIZES_SQL = """diag AS (SELECT seed, count(*) AS cluster_count, CAST(sum(n) AS BIGINT) AS total_rows, max(n) / sum(n) AS largest_cluster_share,
     count(*) = 2 AND max(n) / sum(n) >= 0.90 AS is_degenerate
   FROM (SELECT l_linenumber + 41 AS seed, l_discount > CASE WHEN l_linenumber > 3 THEN 0.005 ELSE 0.05 END AS c,
                count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY seed)"""


QUERIES = [
    Query(
        "standard_scale",
        _standard,
        _sql(f"SELECT customer_id, {_scaled_sql(scaling.STANDARD_COLUMNS, _Z)} FROM features"),
        {c: 6 for c in scaling.STANDARD_COLUMNS},
    ),
    Query(
        "log1p_scale",
        _log1p,
        _sql(f"SELECT customer_id, {_scaled_sql(scaling.SKEWED_COLUMNS, _ZLOG)} FROM features"),
        {c: 6 for c in scaling.SKEWED_COLUMNS},
    ),
    Query(
        "robust_scale",
        _robust,
        _sql(
            f"SELECT customer_id, {_scaled_sql(scaling.STANDARD_COLUMNS, '({c} - m_{c}) / s_{c}')} "
            "FROM features, medians",
            _MEDIANS,
        ),
        {c: 6 for c in scaling.STANDARD_COLUMNS},
    ),
    Query(
        "one_hot_sparse",
        _one_hot_sparse,
        """WITH o AS (SELECT o_orderkey, o_totalprice, CAST(o_custkey AS VARCHAR) AS c,
                             CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d FROM orders),
                found AS (SELECT 0 AS k, d AS level FROM o WHERE o_orderkey % 5 <> 0
                          UNION SELECT 1, c FROM o WHERE o_orderkey % 5 <> 0),
                l AS (SELECT *, row_number() OVER (ORDER BY k, level) AS place FROM found)
           SELECT o_orderkey, (SELECT count(*) + 1 FROM l) AS width,
                  (o_totalprice - 1000) / 10 AS price,
                  CAST((a.place IS NOT NULL) AS BIGINT) + CAST((b.place IS NOT NULL) AS BIGINT) AS known,
                  coalesce(a.place, 0) + coalesce(b.place, 0) AS places
           FROM o LEFT JOIN l a ON a.k = 0 AND a.level = d
                  LEFT JOIN l b ON b.k = 1 AND b.level = c""",
        {"price": 4},
    ),
    Query(
        "one_hot",
        _one_hot,
        _sql(
            " UNION ALL ".join(
                f"SELECT customer_id, '{c}_' || {_LEVEL.format(c=c)} AS level FROM features"
                for c in scaling.CATEGORY_COLUMNS
            )
        ),
    ),
    Query("feature_map_numeric", _long_features("numeric_only"), _sql(_LONG_NUMERIC), {"value": 6}),
    Query(
        "feature_map_full",
        _long_features("full"),
        _sql(f"{_LONG_NUMERIC} UNION ALL {_LONG_HOT}"),
        {"value": 6},
    ),
    Query(
        "pca",
        _pca,
        _recursive(
            _sql(
                """SELECT customer_id,
                     list_dot_product(first, z) - list_dot_product(first, c) AS component_1,
                     list_dot_product(second, z) - list_dot_product(second, c) AS component_2
                   FROM scaled, axes, centre""",
                _SCALED,
                _MEAN,
                *_axes_ctes("scaled"),
            )
        ),
        {"component_1": 5, "component_2": 5},
    ),
    Query(
        "pca_loadings",
        _loadings("pca"),
        _recursive(_sql(_loadings_sql("scaled"), _SCALED, *_axes_ctes("scaled"))),
        {"explained_variance_ratio": 6, "loading": 5},
    ),
    Query(
        "robust_pca_loadings",
        _loadings("robust_pca"),
        _recursive(
            _sql(_loadings_sql("scaled"), _MEDIANS, _ROBUST_SCALED, *_axes_ctes("scaled"))
        ),
        {"explained_variance_ratio": 6, "loading": 5},
    ),
    Query("kmeans", _kmeans),
    Query("kmeans_inertia", _inertias),
    Query(
        "inertia_given_centres",
        lambda s, f: clustering.inertia(_vectors(s, f), _mean_centres(s, f)),
        _with(
            """SELECT sum(d * d) AS inertia FROM (SELECT v.id, min(list_distance(v.x, c.c)) AS d
               FROM v, centres c GROUP BY v.id)""",
            _V,
            *_bouldin_ctes("v"),
        ),
        {"inertia": 4},
    ),
    Query("gaussian_mixture_diag", _mixture),
    Query(
        "gaussian_mixture_round",
        _mixture_round,
        _with(
            """SELECT cluster, share, mean_sum, variance_sum FROM new_sums""",
            _V,
            """u AS (SELECT id, cluster, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS y FROM v)""",
            """start AS (SELECT cluster, i, avg(y) AS m, var_pop(y) + 1e-6 AS s,
                           count(*) / (SELECT count(*) FROM v) AS w FROM u GROUP BY cluster, i)""",
            """joint AS (SELECT u.id, start.cluster,
                           ln(any_value(w)) - 0.5 * sum(ln(2 * pi() * s) + (y - m) ** 2 / s) AS g
                         FROM u JOIN start USING (i) GROUP BY u.id, start.cluster)""",
            """top AS (SELECT id, cluster, exp(g - max(g) OVER (PARTITION BY id)) AS e FROM joint)""",
            """resp AS (SELECT id, cluster, e / sum(e) OVER (PARTITION BY id) AS r FROM top)""",
            """moments AS (SELECT resp.cluster, i, sum(r) AS n, sum(r * y) / sum(r) AS m,
                             sum(r * y * y) / sum(r) AS q
                           FROM resp JOIN u USING (id) GROUP BY resp.cluster, i)""",
            """new_sums AS (SELECT cluster, any_value(n) / (SELECT count(*) FROM v) AS share,
                              sum(m) AS mean_sum, sum(greatest(q - m * m, 0) + 1e-6) AS variance_sum
                            FROM moments GROUP BY cluster)""",
        ),
        {"share": 6, "mean_sum": 5, "variance_sum": 5},
    ),
    Query(
        "knn_graph",
        lambda s, f: neighbours.knn_graph(_vectors(s, f), 10),
        _with(
            """SELECT src, rank, dst, distance FROM (SELECT a.id AS src, b.id AS dst, list_distance(a.x, b.x) AS distance,
                 row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.x, b.x), b.id) AS rank
               FROM v a JOIN v b ON a.id <> b.id) WHERE rank <= 10""",
            _V,
        ),
        {"distance": 6},
    ),
    Query(
        "core_distances",
        lambda s, f: neighbours.core_distances(_vectors(s, f), 5),
        _with(
            """SELECT id, core_distance FROM (SELECT a.id, list_distance(a.x, b.x) AS core_distance,
                 row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.x, b.x), b.id) AS rank
               FROM v a JOIN v b ON a.id <> b.id) WHERE rank = 4""",
            _V,
        ),
        {"core_distance": 6},
    ),
    Query(
        "silhouette",
        lambda s, f: quality.silhouette(_vectors(s, f)),
        _with("SELECT * FROM sil", _V, *_silhouette_ctes("v")),
        {"silhouette_score": 6},
    ),
    Query(
        "silhouette_squared",
        lambda s, f: s.createDataFrame(
            [(quality.silhouette_squared(_vectors(s, f)),)], "silhouette_squared double"
        ),
        _with(
            "SELECT silhouette_score AS silhouette_squared FROM sil",
            _V,
            *[
                c.replace("sum(list_distance(a.x, b.x))", "sum(list_distance(a.x, b.x) ** 2)")
                for c in _silhouette_ctes("v")
            ],
        ),
        {"silhouette_squared": 6},
    ),
    Query(
        "davies_bouldin",
        lambda s, f: quality.davies_bouldin(_vectors(s, f)),
        _with("SELECT * FROM db", _V, *_bouldin_ctes("v")),
        {"davies_bouldin_score": 6},
    ),
    Query("ward_clusters", _ward),
    Query(
        "micro_cluster_moments",
        _micro_moments,
        """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
                cells AS (SELECT unnest(x) AS x, generate_subscripts(x, 1) - 1 AS axis FROM v)
           SELECT CAST(axis AS INTEGER) AS axis, avg(x) AS mean,
                  (SELECT count(*) FROM v) AS n, (SELECT min(vec_id) FROM v) AS first_id,
                  (SELECT sum(x * x) FROM cells) AS squares
           FROM cells GROUP BY axis""",
        {"mean": 6, "squares": 6},
    ),
    Query("density_clusters", _density),
    Query("evaluate_candidates", _candidates),
    Query(
        "evaluate_fit_scope",
        _fit_scope,
        _with(
            """SELECT 'ten' AS model_name, 'train_fit' AS scoring_scope, 10 AS n_clusters_or_components, *
               FROM sil, db UNION ALL SELECT 'two', 'train_fit', 2, * FROM h_sil, h_db""",
            _V,
            "h AS (SELECT id, x, CAST(cluster >= 5 AS BIGINT) AS cluster FROM v)",
            *_silhouette_ctes("v"),
            *_bouldin_ctes("v"),
            *_silhouette_ctes("h", "h_"),
            *_bouldin_ctes("h", "h_"),
        ),
        _SCORE_DIGITS,
    ),
    Query(
        "evaluate_non_noise",
        _non_noise,
        _with(
            """SELECT (SELECT count(*) FROM kept) AS retained_rows,
                 (SELECT count(*) FROM v WHERE cluster = 0) AS noise_rows,
                 (SELECT count(DISTINCT cluster) FROM kept) AS n_clusters,
                 silhouette_score, davies_bouldin_score, 'train_fit_non_noise' AS scoring_scope FROM sil, db""",
            _V,
            _NON_NOISE,
            *_silhouette_ctes("kept"),
            *_bouldin_ctes("kept"),
        ),
        _SCORE_DIGITS,
    ),
    Query("seed_stability", _stability, _with("SELECT * FROM stable", _SCORES, _STABLE), _STABLE_DIGITS),
    Query(
        "select_stable",
        _selected,
        _with(
            f"""SELECT model_name, representation, selection_score,
                 selection_score IS NOT NULL AND row_number() OVER (ORDER BY selection_score DESC NULLS LAST,
                   model_name || '/' || representation) = 1 AS is_winner,
                 selection_score IS NULL AS is_excluded
               FROM (SELECT *, CASE WHEN silhouette_std <= {_LIMIT} THEN silhouette_mean - silhouette_std END
                     AS selection_score FROM stable)""",
            _SCORES,
            _STABLE,
        ),
        {"selection_score": 6},
    ),
    Query(
        "baseline_margins",
        lambda s, f: selection.baseline_margins(_scores(s, f)),
        _with(
            """SELECT position, model_name, silhouette_score - bs AS silhouette_margin,
                 bd - davies_bouldin_score AS davies_bouldin_improvement,
                 silhouette_score > bs AND davies_bouldin_score < bd AS beats_baseline_on_both,
                 position = (SELECT position FROM scores WHERE scoring_scope = 'validation'
                             ORDER BY silhouette_score DESC, position LIMIT 1) AS is_best_by_validation_silhouette
               FROM scores, (SELECT silhouette_score AS bs, davies_bouldin_score AS bd FROM scores
                             WHERE model_name LIKE 'baseline_%' ORDER BY position LIMIT 1)""",
            _SCORES,
        ),
        {"silhouette_margin": 6, "davies_bouldin_improvement": 6},
    ),
    Query(
        "representation_comparison",
        _comparison,
        _with(
            """SELECT model_name,
                 avg(silhouette_score) FILTER (WHERE representation = 'full') AS full_silhouette,
                 avg(davies_bouldin_score) FILTER (WHERE representation = 'full') AS full_davies_bouldin,
                 avg(silhouette_score) FILTER (WHERE representation <> 'full') AS numeric_only_silhouette,
                 avg(davies_bouldin_score) FILTER (WHERE representation <> 'full') AS numeric_only_davies_bouldin
               FROM scores GROUP BY model_name""",
            _SCORES,
        ),
        {
            "full_silhouette": 6,
            "full_davies_bouldin": 6,
            "numeric_only_silhouette": 6,
            "numeric_only_davies_bouldin": 6,
        },
    ),
    Query(
        "before_after",
        _two_runs,
        _with(
            """SELECT model_name, representation, seed, silhouette_score,
                 CASE WHEN representation = 'full' THEN 'before' ELSE 'after' END AS run FROM scores""",
            _SCORES,
        ),
        {"silhouette_score": 6},
    ),
    Query("candidate_sweeps", _sweep),
    Query(
        "candidate_table",
        _candidate_table,
        _with(
            """SELECT model_name, representation, scoring_scope, silhouette_score, davies_bouldin_score
               FROM (SELECT *, row_number() OVER (PARTITION BY model_name, representation
                                                  ORDER BY source, position) AS place
                     FROM (SELECT 0 AS source, * FROM scores WHERE representation = 'full'
                           UNION ALL SELECT 1, * FROM scores
                           UNION ALL SELECT 2, * REPLACE ('full' AS representation) FROM scores))
               WHERE place = 1""",
            _SCORES,
        ),
        _SCORE_DIGITS,
    ),
    Query(
        "cluster_size_diagnostics",
        lambda s, f: selection.cluster_size_diagnostics(_seed_labels(s, f)),
        _with("SELECT * FROM diag", _SIZES_SQL),
        {"largest_cluster_share": 6},
    ),
    Query(
        "any_degenerate",
        lambda s, f: selection.any_degenerate(
            selection.cluster_size_diagnostics(_seed_labels(s, f))
        ),
        _with("SELECT bool_or(is_degenerate) AS any_degenerate FROM diag", _SIZES_SQL),
    ),
    Query("cluster_profile", _profile, _sql("SELECT * FROM profile", *_PROFILE_CTES), _PROFILE_DIGITS),
    Query("train_segmentation", _trained),
    Query("promote_if_better", _promotion, _with(
        """SELECT a.model_name, a.s > b.s OR (a.s = b.s AND a.d < b.d) AS promote FROM m a, m b
           WHERE b.model_name = 'baseline_view' AND a.model_name <> 'baseline_view'""",
        _SCORES,
        """m AS (SELECT model_name, avg(silhouette_score) AS s, avg(davies_bouldin_score) AS d
                 FROM scores GROUP BY model_name)""",
    )),
    Query("save_and_load_model", _reloaded),
    Query("run_stages", _stage_run),
    Query("compare_models", _comparison_run),
    Query("assign_clusters", _assigned, _with(_NEAREST, _V, *_bouldin_ctes("v"))),
    Query(
        "attach_profile",
        _attached,
        _sql(
            """SELECT l.customer_id, l.cluster, p.cluster_size, p.monetary_value, p.preferred_category
               FROM labelled l JOIN profile p USING (cluster)""",
            *_PROFILE_CTES,
        ),
        {"monetary_value": 2},
    ),
    Query("score_feature_table", _scored),
    Query(
        "score_with_given_model",
        _scored_by_given,
        _sql(
            "SELECT customer_id, cluster, component_1, component_2 FROM given_labels", *_GIVEN_SQL
        ),
        {"component_1": 6, "component_2": 6},
    ),
    Query(
        "save_and_load_given_model",
        _reloaded_given,
        _sql(
            """SELECT customer_id, cluster, count(*) OVER (PARTITION BY cluster) AS cluster_size
               FROM given_labels""",
            *_GIVEN_SQL,
        ),
    ),
    Query(
        "cluster_distribution",
        lambda s, f: scoring.cluster_distribution(_vectors(s, f)),
        _with(
            "SELECT cluster, count(*) AS size, count(*) / sum(count(*)) OVER () AS share FROM v GROUP BY cluster",
            _V,
        ),
        {"share": 6},
    ),
    Query(
        "sample_map",
        lambda s, f: scoring.sample_map(
            s.read.parquet(f"{f}/orders.parquet").select("o_orderkey", "o_totalprice"), "o_orderkey"
        ),
        "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('42:' || o_orderkey), o_orderkey LIMIT 12000",
    ),
    Query(
        "customer_lookup",
        _lookup,
        _sql(
            """SELECT l.customer_id, l.frequency, l.monetary_value, l.cluster, p.cluster_size,
                 p.frequency AS profile_frequency, p.monetary_value AS profile_monetary_value,
                 p.preferred_category AS profile_preferred_category
               FROM labelled l JOIN profile p USING (cluster)
               ORDER BY l.frequency DESC, l.customer_id LIMIT 1""",
            *_PROFILE_CTES,
        ),
        {"monetary_value": 2, "profile_frequency": 6, "profile_monetary_value": 2},
    ),
]
