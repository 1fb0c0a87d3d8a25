"""Clustering features: count, sum and sum of squares of micro-clusters, which add up.

A partition tree, shaped by a bounded sample, gives every point one of a bounded
number of micro-clusters. What is kept of a micro-cluster is its number of points,
the sum of their offsets from the leaf's place in the tree and the sum of their squared
offsets (offsets lose no digits far from the origin). Features of two sets of points
under one tree are merged by addition, so new points never need the old ones.

Ward's cost of a merge depends on counts and centres alone, so linkage on features is
Ward's linkage that starts from the micro-clusters instead of the points.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.summaries import MOST_VALUES, Tree, grow, sample

#: Micro-clusters at most, unless the caller asks for another number.
MOST_MICRO = 4096


def fit_micro_tree(weighted: DataFrame, most: int = MOST_MICRO) -> Tree:
    """A tree of at most ``most`` leaves from distinct points (features, weight).

    It is grown on the driver from a sample of bounded size in the order of a hash; the
    leaves have at most MOST_VALUES numbers together, so wide points get fewer of them.
    """
    first = weighted.select(F.size("features").alias("d")).first()
    if first is None:
        raise ValueError("at least one point is required")
    x, label, weight = sample(weighted.withColumn("label", F.lit(0)), 1, first["d"])
    return grow(x, label, weight, max(1, min(most, MOST_VALUES // max(first["d"], 1))))


def place_points(points: DataFrame, tree: Tree) -> DataFrame:
    """(id, leaf, offset) of points (id, features), by tasks without a shuffle."""
    reference = tree.leaf_centre

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.iloc[at : at + 4096]
                x = np.vstack(part["features"].to_numpy())
                leaf = tree.leaves(x, np.full(len(x), tree.labels[0]))
                yield pd.DataFrame(
                    {"id": part["id"], "leaf": leaf, "offset": list(x - reference[leaf])}
                )

    return points.select("id", "features").mapInPandas(
        placed, "id bigint, leaf int, offset array<double>"
    )


def clustering_features(placed: DataFrame) -> DataFrame:
    """(leaf, first_id, n, sums, squares): one row for each micro-cluster that has points.

    Tasks add up their own points first, so a micro-cluster that holds most of the
    table is one row of each task.
    """
    square = F.aggregate("offset", F.lit(0.0), lambda total, x: total + x * x)
    return placed.groupBy("leaf").agg(
        F.min("id").alias("first_id"),
        F.count(F.lit(1)).alias("n"),
        vector_to_array(Summarizer.sum(array_to_vector("offset"))).alias("sums"),
        F.sum(square).alias("squares"),
    )


def merge_features(*parts: DataFrame) -> DataFrame:
    """Features of all points of the parts, which were placed by one tree."""
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("leaf")
        .agg(
            F.min("first_id").alias("first_id"),
            F.sum("n").alias("n"),
            vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"),
            F.sum("squares").alias("squares"),
        )
    )


def micro_clusters(features: DataFrame, tree: Tree) -> DataFrame:
    """(leaf, cluster, n, centre, scatter) of merged features.

    ``cluster`` is the smallest id, ``scatter`` the sum of squared distances from the
    centre. What a cut into clusters loses on the points is what it loses on the centres,
    weighted by n, plus the sum of all scatters.
    """
    reference = features.sparkSession.createDataFrame(
        [(i, [float(v) for v in row]) for i, row in enumerate(tree.leaf_centre)],
        "leaf int, reference array<double>",
    )
    mean = F.transform("sums", lambda x: x / F.col("n"))
    shift = F.aggregate("sums", F.lit(0.0), lambda total, x: total + x * x) / F.col("n")
    return features.join(reference, "leaf").select(
        "leaf",
        F.col("first_id").alias("cluster"),
        F.col("n").cast("double").alias("n"),
        F.zip_with("reference", mean, lambda x, y: x + y).alias("centre"),
        F.greatest(F.col("squares") - shift, F.lit(0.0)).alias("scatter"),
    )
