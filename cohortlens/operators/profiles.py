"""Cluster profiles on the untransformed customer features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMERIC_COLUMNS = (
    "recency_days",
    "frequency",
    "monetary_value",
    "avg_order_value",
    "order_value_std",
    "product_diversity",
    "purchase_velocity",
    "return_rate",
    "coupon_usage_rate",
)
MODE_COLUMNS = ("preferred_category", "preferred_payment_method")


def cluster_profile(
    labelled: DataFrame,
    numeric=NUMERIC_COLUMNS,
    modes=MODE_COLUMNS,
    id_column: str | None = "customer_id",
    label: str = "cluster",
) -> DataFrame:
    """Size, numeric means, smallest id and smallest mode per cluster.

    One scan: grouping sets count each category value per cluster next to the
    cluster's own aggregates, and a second group-by folds them.
    """
    sets = [[label]] + [[label, c] for c in modes]
    whole = F.grouping_id()
    aggregates = [whole.alias("_set"), F.count(F.lit(1)).alias("_n")]
    aggregates += [F.avg(c).alias(f"_avg_{c}") for c in numeric]
    if id_column:
        aggregates.append(F.min(id_column).alias("_id"))
    grouped = labelled.groupingSets(sets, label, *modes).agg(*aggregates)
    everything = (1 << len(modes)) - 1
    is_cluster = F.col("_set") == everything

    def mode_of(place: int, c: str) -> Column:
        bit = everything ^ (1 << (len(modes) - 1 - place))
        rank = F.struct(
            (-F.col("_n")).alias("minus_n"), F.col(c).isNull().alias("absent"), F.col(c).alias("value")
        )
        return F.min(F.when(F.col("_set") == bit, rank))["value"].alias(c)

    folded = [F.max(F.when(is_cluster, F.col("_n"))).alias("cluster_size")]
    folded += [F.max(F.when(is_cluster, F.col(f"_avg_{c}"))).alias(c) for c in numeric]
    if id_column:
        folded.append(F.min("_id").alias(id_column))
    folded += [mode_of(i, c) for i, c in enumerate(modes)]
    return grouped.groupBy(label).agg(*folded)
