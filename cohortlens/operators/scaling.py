"""Customer feature transforms: scaling, one-hot columns and principal components.

Fitting is one aggregate whose result is a handful of numbers per column; a
fitted transform is a set of column expressions over those numbers.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, replace

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions.order import numbered
from cohortlens.functions.quantiles import exact_quantiles
from cohortlens.functions.vectors import dot, literal_vector
from cohortlens.session import cut_lineage, scratch_path

# The columns of each kind, in their published order.
STANDARD_COLUMNS = (
    "recency_days",
    "frequency",
    "order_value_std",
    "product_diversity",
    "purchase_velocity",
    "return_rate",
    "coupon_usage_rate",
)
SKEWED_COLUMNS = ("monetary_value", "avg_order_value")
CATEGORY_COLUMNS = ("preferred_category", "preferred_payment_method")


@dataclass(frozen=True)
class Scale:
    """(x - centre) / spread, of log1p(x) where ``log`` is set."""

    column: str
    centre: float
    spread: float
    log: bool = False

    def expression(self) -> Column:
        value = F.col(self.column).cast("double")
        if self.log:
            value = F.log1p(value)
        return (value - F.lit(self.centre)) / F.lit(self.spread)


@dataclass(frozen=True)
class FeatureMap:
    """A fitted transform: scales, category levels, optional components."""

    variant: str
    scales: tuple[Scale, ...]
    levels: tuple[tuple[str, tuple[str, ...]], ...] = ()
    means: tuple[float, ...] = ()
    components: tuple[tuple[float, ...], ...] = ()
    explained_variance_ratio: tuple[float, ...] = ()

    def feature_names(self) -> list[str]:
        names = [s.column for s in self.scales]
        names += [f"{c}={level}" for c, levels in self.levels for level in levels]
        return names

    def inputs(self) -> Column:
        """array<double>: scaled and one-hot values, before any projection.

        A category column is one expression, whatever the number of its levels.
        """
        parts = [F.array(*[s.expression() for s in self.scales])]
        for c, levels in self.levels:
            if levels:
                parts.append(F.transform(F.lit(list(levels)), _is_level(c)))
        return F.concat(*parts)

    def features(self) -> Column:
        """array<double>: the inputs, or their centred projection."""
        inputs = self.inputs()
        if not self.components:
            return inputs
        centred = F.zip_with(inputs, literal_vector(self.means), lambda x, m: x - m)
        axes = F.array(*[literal_vector(c) for c in self.components])
        return F.transform(axes, lambda axis: dot(centred, axis))

    def transform(self, df: DataFrame, *keep: str) -> DataFrame:
        return df.select(*keep, self.features().alias("features"))

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "FeatureMap":
        raw = json.loads(text)
        return FeatureMap(
            raw["variant"],
            tuple(Scale(**s) for s in raw["scales"]),
            tuple((c, tuple(levels)) for c, levels in raw["levels"]),
            tuple(raw["means"]),
            tuple(tuple(c) for c in raw["components"]),
            tuple(raw["explained_variance_ratio"]),
        )


def _is_level(name: str):
    return lambda level: F.coalesce((F.col(name) == level).cast("double"), F.lit(0.0))


def _spread(value: float | None) -> float:
    return value if value else 1.0


def fit_standard(df: DataFrame, columns, log: bool = False) -> tuple[Scale, ...]:
    """Mean and population deviation; a constant column is only centred."""
    aggregates = []
    for i, c in enumerate(columns):
        value = F.col(c).cast("double")
        value = F.log1p(value) if log else value
        aggregates += [F.avg(value).alias(f"m{i}"), F.stddev_pop(value).alias(f"s{i}")]
    row = df.agg(*aggregates).first()
    return tuple(
        Scale(c, row[f"m{i}"], _spread(row[f"s{i}"]), log) for i, c in enumerate(columns)
    )


def fit_robust(df: DataFrame, columns) -> tuple[Scale, ...]:
    """Median and interquartile range; a column without values stays without."""
    scales = []
    for c, (q1, q2, q3) in exact_quantiles(df, list(columns), [0.25, 0.5, 0.75]).items():
        scales.append(Scale(c, q2, _spread(None if q1 is None else q3 - q1)))
    return tuple(scales)


def fit_levels(df: DataFrame, columns) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """Sorted levels per category column; the fitted transform holds one entry for each.

    For the few levels of the published columns: ``level_table`` serves any number.
    """
    found = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("level")) for c in columns]))
    ).filter(F.col("level").isNotNull())
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for row in found.distinct().collect():
        levels[row["name"]].append(row["level"])
    return tuple((c, tuple(sorted(levels[c]))) for c in columns)


def level_table(df: DataFrame, columns) -> DataFrame:
    """(column, level, place): all levels in the order of column and level, places from 0.

    A table for any number of levels: each task reduces its rows to levels first, and places come from
    sorted ranges. Missing values are no level.
    """
    found = (
        df.select(
            F.inline(
                F.array(
                    *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in columns]
                )
            )
        )
        .filter(F.col("level").isNotNull())
        .distinct()
    )
    return cut_lineage(numbered(found, "column", "level"))


def sparse_features(
    df: DataFrame, scales: tuple[Scale, ...], levels: DataFrame, columns, *keep: str
) -> DataFrame:
    """``keep`` and features (size, indices, values): scaled columns first, then one-hot places.

    ``levels`` is a ``level_table`` of the fitting rows. A row holds one entry for each scaled
    column and each known level, however many levels there are; a missing or unknown level
    has none. Each category column is one join that Spark broadcasts or shuffles by size.
    """
    first = len(scales)
    rows = df.select(
        F.struct(*keep).alias("_kept") if keep else F.lit(0).alias("_kept"),
        F.array(*[s.expression() for s in scales]).cast("array<double>").alias("_scaled"),
        *[F.col(c).cast("string").alias(f"_level{i}") for i, c in enumerate(columns)],
    )
    for i, c in enumerate(columns):
        own = levels.filter(F.col("column") == c).select(
            F.col("level").alias(f"_level{i}"),
            (F.col("place") + first).cast("int").alias(f"_place{i}"),
        )
        rows = rows.join(own, f"_level{i}", "left")
    places = F.array_sort(F.array_compact(F.array(*[F.col(f"_place{i}") for i in range(len(columns))])))
    numbers = F.sequence(F.lit(0), F.lit(first - 1)) if first else F.array().cast("array<int>")
    size = levels.agg((F.count(F.lit(1)) + first).cast("int").alias("_size"))
    return rows.join(size).select(
        *[F.col(f"_kept.`{c}`").alias(c) for c in keep],
        F.struct(
            F.col("_size").alias("size"),
            F.concat(numbers, places).alias("indices"),
            F.concat("_scaled", F.transform(places, lambda _: F.lit(1.0))).alias("values"),
        ).alias("features"),
    )


def as_vectors(df: DataFrame) -> DataFrame:
    """``df`` with its sparse features as vectors, as the fits of Spark take them.

    A vector is stored as a structure of these very fields, so the frame is written as a
    table and read back with the vector's type: no row passes through Python.
    """
    stored = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.col("features.size").alias("size"),
        F.col("features.indices").alias("indices"),
        F.col("features.values").alias("values"),
    )
    path = scratch_path(df.sparkSession, "vectors")
    df.withColumn("features", stored).write.parquet(path)
    fields = [
        T.StructField("features", VectorUDT()) if f.name == "features" else f for f in df.schema
    ]
    return df.sparkSession.read.schema(T.StructType(fields)).parquet(path)


def fit_pca(df: DataFrame, fitted: FeatureMap, n_components: int) -> FeatureMap:
    """Adds a centred projection; the largest loading of each axis is positive."""
    if n_components <= 0:
        raise ValueError("n_components must be positive")
    rows = df.select(fitted.inputs().alias("inputs"))
    width = len(fitted.feature_names())
    means = rows.agg(*[F.avg(F.col("inputs")[i]) for i in range(width)]).first()
    model = PCA(k=n_components, inputCol="vector", outputCol="projected").fit(
        rows.select(array_to_vector("inputs").alias("vector"))
    )
    axes = model.pc.toArray().T
    components = []
    for axis in axes:
        sign = 1.0 if axis[abs(axis).argmax()] > 0 else -1.0
        components.append(tuple(float(sign * x) for x in axis))
    return replace(
        fitted,
        variant=f"{fitted.variant}_pca_{n_components}",
        means=tuple(float(m) for m in means),
        components=tuple(components),
        explained_variance_ratio=tuple(float(v) for v in model.explainedVariance.toArray()),
    )


def fit_feature_map(
    df: DataFrame, variant: str = "numeric_only", n_components: int | None = None
) -> FeatureMap:
    """One of ``full``, ``numeric_only``, ``pca``, ``robust_numeric``, ``robust_pca``."""
    known = ("full", "numeric_only", "pca", "robust_numeric", "robust_pca")
    if variant not in known:
        raise ValueError(f"variant must be one of {known}")
    robust = variant.startswith("robust")
    main = fit_robust(df, STANDARD_COLUMNS) if robust else fit_standard(df, STANDARD_COLUMNS)
    scales = main + fit_standard(df, SKEWED_COLUMNS, log=True)
    levels = fit_levels(df, CATEGORY_COLUMNS) if variant == "full" else ()
    if variant.endswith("pca"):
        base = FeatureMap("robust" if robust else "standard", scales)
        return fit_pca(df, base, n_components or 0)
    return FeatureMap(variant, scales, levels)


def scaled_columns(df: DataFrame, scales: tuple[Scale, ...], *keep: str) -> DataFrame:
    """The scaled columns under their own names."""
    return df.select(*keep, *[s.expression().alias(s.column) for s in scales])


def one_hot_columns(df: DataFrame, levels, *keep: str) -> DataFrame:
    """One 0/1 column per level; an unknown level gives all zeros."""
    columns = []
    for c, values in levels:
        for level in values:
            name = f"{c}_{level}".lower().replace(" ", "_").replace("-", "_")
            columns.append(
                F.coalesce((F.col(c) == F.lit(level)).cast("double"), F.lit(0.0)).alias(name)
            )
    return df.select(*keep, *columns)


def pca_loadings(spark: SparkSession, fitted: FeatureMap) -> DataFrame:
    """(component, explained_variance_ratio, feature, loading)."""
    rows = [
        (i + 1, fitted.explained_variance_ratio[i], name, loading)
        for i, axis in enumerate(fitted.components)
        for name, loading in zip(fitted.feature_names(), axis)
    ]
    return spark.createDataFrame(
        rows, "component int, explained_variance_ratio double, feature string, loading double"
    )
