"""Profiles of a table: overview, distributions, categories, correlations, products."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.functions.columns import (
    categorical_columns,
    nan_to_null,
    numeric_columns,
    rows_from_aggregates,
    unpivot_values,
)
from cohortlens.functions.quantiles import exact_quantiles
from cohortlens.operators.validation import check_duplicates, null_rates
from cohortlens.sources.contract import POST_OUTCOME, snake

ID_COLUMNS = ("customer_id", "order_id", "product_id")
# Fixed value: the amounts checked for negative values.
AMOUNT_COLUMNS = ("gross_sales_usd", "net_sales_usd", "total_order_value_usd")


def dataset_overview(
    df: DataFrame,
    as_of,
    date_column: str = "order_date",
    again: DataFrame | None = None,
    orders: DataFrame | None = None,
) -> DataFrame:
    """One row of shape, date range, distinct ids, duplicates and sanity counts.

    ``again`` may bring the ``validation.repeated_hashes`` of ``df``, ``orders`` its
    ``sales.distinct_orders``.
    """
    amounts = [c for c in AMOUNT_COLUMNS if c in df.columns]
    ids = [c for c in ID_COLUMNS if c in df.columns]
    after = F.lit(as_of).cast("date") if as_of is not None else F.current_date()
    plain = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.min(date_column).alias("date_min"),
        F.max(date_column).alias("date_max"),
        *[F.count_if(F.col(c) < 0).alias(f"negative_{c}") for c in amounts],
        F.count_if(F.col(date_column) > after).alias("future_dates"),
    )
    # One distinct count per subquery: no row is expanded once per id column.
    return plain.select(
        "*",
        *[
            (df if orders is None or c not in orders.columns else orders)
            .select(c)
            .agg(F.countDistinct(c))
            .scalar()
            .alias(f"distinct_{c}")
            for c in ids
        ],
        check_duplicates(df, again).scalar().alias("duplicate_rows"),
        F.lit(",".join(c for c in snake(POST_OUTCOME) if c in df.columns)).alias(
            "possible_leakage_columns"
        ),
    )


def column_types(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.dtypes, "column string, type string")


def missing_profile(df: DataFrame, threshold: float = 0.20) -> DataFrame:
    """(column, null_count, null_rate, is_flagged), highest rate first."""
    return (
        null_rates(df)
        .withColumn("is_flagged", F.col("null_rate") > threshold)
        .orderBy(F.desc("null_rate"), "column")
    )


Quartiles = dict[str, list[float | None]]


def quartiles(df: DataFrame, columns: list[str] | None = None) -> Quartiles:
    """Exact quartiles of numeric columns, for the operators below to share."""
    df = nan_to_null(df)
    return exact_quantiles(df, columns or numeric_columns(df), [0.25, 0.5, 0.75])


def numeric_summary(
    df: DataFrame, columns: list[str] | None = None, known: Quartiles | None = None
) -> DataFrame:
    """(column, count, mean, std, min, q1, q2, q3, max) per numeric column."""
    df = nan_to_null(df)
    columns = columns or numeric_columns(df)
    known = known or quartiles(df, columns)
    aggregates, rows = [], []
    for i, c in enumerate(columns):
        value = F.col(c).cast("double")
        aggregates += [
            F.count(value).alias(f"n{i}"),
            F.avg(value).alias(f"a{i}"),
            F.stddev_samp(value).alias(f"s{i}"),
            F.min(value).alias(f"l{i}"),
            F.max(value).alias(f"h{i}"),
        ]
        q1, q2, q3 = (F.lit(q).cast("double") for q in known[c])
        rows.append(
            {
                "column": F.lit(c),
                "count": F.col(f"n{i}"),
                "mean": F.col(f"a{i}"),
                "std": F.col(f"s{i}"),
                "min": F.col(f"l{i}"),
                "q1": q1,
                "q2": q2,
                "q3": q3,
                "max": F.col(f"h{i}"),
            }
        )
    return rows_from_aggregates(df.agg(*aggregates), rows)


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) for every distinct value, nulls counted as a value."""
    return (
        unpivot_values(df, columns)
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def categorical_counts(
    df: DataFrame, low_cardinality_max: int = 20, columns: list[str] | None = None
) -> DataFrame:
    """Value counts of text and boolean columns with few distinct values."""
    if low_cardinality_max <= 0:
        raise ValueError("low_cardinality_max must be positive")
    counts = value_counts(df, columns or categorical_columns(df))
    narrow = (
        counts.groupBy("column")
        .agg(F.count(F.lit(1)).alias("cardinality"))
        .filter(F.col("cardinality") <= low_cardinality_max)
        .select("column")
    )
    return counts.join(narrow, "column", "left_semi")


def iqr_outliers(
    df: DataFrame, columns: list[str] | None = None, known: Quartiles | None = None
) -> DataFrame:
    """(column, outliers): values strictly outside 1.5 IQR of the quartiles."""
    df = nan_to_null(df)
    columns = columns or numeric_columns(df)
    known = known or quartiles(df, columns)
    counts = []
    for i, c in enumerate(columns):
        q1, _, q3 = known[c]
        if q1 is None:
            counts.append(F.count_if(F.lit(False)).alias(f"o{i}"))
            continue
        reach = 1.5 * (q3 - q1)
        value = F.col(c).cast("double")
        counts.append(
            F.count_if((value < F.lit(q1 - reach)) | (value > F.lit(q3 + reach))).alias(f"o{i}")
        )
    return rows_from_aggregates(
        df.agg(*counts),
        [{"column": F.lit(c), "outliers": F.col(f"o{i}")} for i, c in enumerate(columns)],
    )


def distinct_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, distinct_values) of numeric columns, missing cells left out.

    Values are de-duplicated per column before and after one shuffle, so no
    task holds all values of a column.
    """
    df = nan_to_null(df)
    columns = columns or numeric_columns(df)
    # columns go by their number, which is shorter than a name beside each value;
    # -0.0 and 0.0 are one value, as they are for a numeric distinct count
    cells = [
        F.struct(F.lit(i).alias("number"), F.col(c).cast("double").alias("value"))
        for i, c in enumerate(columns)
    ]
    names = F.array(*map(F.lit, columns))
    return (
        df.select(F.inline(F.array(*cells)))
        .distinct()
        .groupBy("number")
        .agg(F.count("value").alias("distinct_values"))
        .select(F.get(names, F.col("number")).alias("column"), "distinct_values")
    )


#: Up to this many values a sketch of 512 registers cannot overrate a column beyond SKETCH_SLACK.
SKETCHED_LIMIT, SKETCH_SLACK = 100, 2


def few_valued(df: DataFrame, limit: int, columns: list[str] | None = None) -> DataFrame:
    """(column, distinct_values) of the numeric columns with at most ``limit`` values.

    One pass of mergeable sketches rules out columns of many values, so that those are never
    shuffled; the others are counted exactly. The first pass cannot lose a column: n values
    set n of its 512 registers at most, which it reads as 512 ln(512 / (512 - n)) values or
    fewer, and that is below twice n up to SKETCHED_LIMIT. Beyond that limit all are counted.
    """
    df = nan_to_null(df)
    columns = columns or numeric_columns(df)
    if columns and limit <= SKETCHED_LIMIT:
        sketches = [
            F.approx_count_distinct(F.col(c).cast("double"), 0.05).alias(f"c{i}")
            for i, c in enumerate(columns)
        ]
        seen = df.agg(*sketches).first()
        columns = [c for c, n in zip(columns, seen) if n <= SKETCH_SLACK * (limit + 1)]
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, distinct_values bigint")
    return distinct_counts(df, columns).filter(F.col("distinct_values") <= limit)


def near_zero_variance(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return few_valued(df, 1, columns).select("column")


def numeric_categorical_candidates(
    df: DataFrame, low_cardinality_max: int = 20, columns: list[str] | None = None
) -> DataFrame:
    return few_valued(df, low_cardinality_max, columns)


def categorical_profile(
    df: DataFrame, top_n: int = 10, columns: list[str] | None = None
) -> DataFrame:
    """(column, cardinality, rank, value, n): the top values of each column.

    ``row_number() <= top_n`` is applied before the shuffle as well, so a
    column with very many values sends only its leaders.
    """
    if top_n <= 0:
        raise ValueError("top_n must be positive")
    counts = value_counts(df, columns or categorical_columns(df))
    # reads n as the ranks do, so that both take the counts from one shuffle
    cardinality = counts.groupBy("column").agg(F.count_if(F.col("n") > 0).alias("cardinality"))
    leaders = W.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_first("value"))
    return (
        counts.withColumn("rank", F.row_number().over(leaders))
        .filter(F.col("rank") <= top_n)
        .join(cardinality, "column")
        .select("column", "cardinality", "rank", "value", "n")
    )


def pearson_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(left, right, pearson) for each pair of columns; null for a constant side.

    A first pass finds each column's mean, deviation and completeness. Pairs of
    complete columns then need a single sum of centred products each; a pair
    with missing cells is restricted to the rows where both are present.
    """
    df = nan_to_null(df)
    columns = columns or numeric_columns(df)
    value = {c: F.col(c).cast("double") for c in columns}
    first = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[
            aggregate(value[c]).alias(f"{name}{i}")
            for i, c in enumerate(columns)
            for name, aggregate in (
                ("n", F.count),
                ("mean", F.avg),
                ("low", F.min),
                ("high", F.max),
                ("std", F.stddev_pop),
            )
        ],
    ).first()
    place = {c: i for i, c in enumerate(columns)}

    def known(c: str, name: str):
        return first[f"{name}{place[c]}"]

    aggregates, results = [], {}
    for pair in combinations_with_replacement(columns, 2):
        if any(known(c, "n") == 0 or known(c, "low") == known(c, "high") for c in pair):
            results[pair] = F.lit(None).cast("double")
            continue
        centred = [value[c] - F.lit(known(c, "mean")) for c in pair]
        key = f"p{len(results)}"
        if all(known(c, "n") == first["n"] for c in pair):
            aggregates.append(F.sum(centred[0] * centred[1]).alias(key))
            scale = first["n"] * known(pair[0], "std") * known(pair[1], "std")
            results[pair] = F.col(key) / F.lit(scale)
            continue
        both = centred[0].isNotNull() & centred[1].isNotNull()
        x, y = (F.when(both, c) for c in centred)
        aggregates += [
            F.covar_pop(x, y).alias(f"{key}c"),
            F.stddev_pop(x).alias(f"{key}x"),
            F.stddev_pop(y).alias(f"{key}y"),
            (F.min(x) < F.max(x)).alias(f"{key}vx"),
            (F.min(y) < F.max(y)).alias(f"{key}vy"),
        ]
        results[pair] = F.when(
            F.col(f"{key}vx") & F.col(f"{key}vy"),
            F.try_divide(F.col(f"{key}c"), F.col(f"{key}x") * F.col(f"{key}y")),
        )
    rows = []
    for (a, b), pearson in results.items():
        for left, right in dict.fromkeys(((a, b), (b, a))):
            rows.append({"left": F.lit(left), "right": F.lit(right), "pearson": pearson})
    return rows_from_aggregates(df.agg(F.count(F.lit(1)), *aggregates), rows)


def flag_correlated_pairs(
    matrix: DataFrame, columns: list[str], threshold: float = 0.80, inclusive: bool = True
) -> DataFrame:
    """Pairs of the upper triangle whose absolute correlation reaches the threshold."""
    if not 0 <= threshold <= 1:
        raise ValueError("threshold must lie in [0, 1]")
    order = F.array(*[F.lit(c) for c in columns])
    size = F.abs("pearson")
    return matrix.filter(
        (F.array_position(order, F.col("left")) < F.array_position(order, F.col("right")))
        & (size >= threshold if inclusive else size > threshold)
    )


def customer_summary(df: DataFrame) -> DataFrame:
    """Orders, revenue, first and last date and recency per customer."""
    last_date = df.agg(F.max("order_date")).scalar()
    # lines -> orders -> customers: no row is expanded for the distinct count
    per_order = df.groupBy("customer_id", "order_id").agg(
        F.sum("net_sales_usd").alias("revenue"),
        F.min("order_date").alias("first"),
        F.max("order_date").alias("last"),
    )
    return per_order.groupBy("customer_id").agg(
        F.count("order_id").alias("order_frequency"),
        F.sum("revenue").alias("monetary_value"),
        F.min("first").alias("first_order_date"),
        F.max("last").alias("last_order_date"),
    ).withColumn(
        "recency_days", F.datediff(last_date, F.col("last_order_date")).cast("bigint")
    )


def repeat_purchase_rate(df: DataFrame) -> DataFrame:
    """One row: share of customers with more than one order (0 without customers)."""
    orders = (
        df.select("customer_id", "order_id")
        .distinct()
        .groupBy("customer_id")
        .agg(F.count("order_id").alias("orders"))
    )
    return orders.agg(
        F.coalesce(F.avg((F.col("orders") > 1).cast("double")), F.lit(0.0)).alias(
            "repeat_purchase_rate"
        )
    )


def product_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("product_id", "product_name").agg(
        F.sum("quantity").alias("volume"), F.sum("net_sales_usd").alias("revenue")
    )


def top_products(
    df: DataFrame, top_n: int = 10, by: str = "revenue", totals: DataFrame | None = None
) -> DataFrame:
    """The top products by ``revenue`` or ``volume``; ties go to the smaller id.

    ``totals`` may bring the ``product_totals`` of ``df``.
    """
    if top_n <= 0:
        raise ValueError("top_n must be positive")
    totals = product_totals(df) if totals is None else totals
    return totals.orderBy(F.desc(by), "product_id", "product_name").limit(top_n)


def category_mix(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("product_category")
        .agg(F.sum("quantity").alias("volume"), F.sum("net_sales_usd").alias("revenue"))
        .orderBy(F.desc("revenue"), "product_category")
    )


def histogram(df: DataFrame, columns: list[str], bins: int = 20) -> DataFrame:
    """(column, bin, n): equal-width bins, the last one closed on the right."""
    df = nan_to_null(df).select(*[F.col(c).cast("double").alias(c) for c in columns])
    edges = rows_from_aggregates(
        df.agg(
            *[F.min(c).alias(f"l{i}") for i, c in enumerate(columns)],
            *[F.max(c).alias(f"h{i}") for i, c in enumerate(columns)],
        ),
        [
            {"column": F.lit(c), "low": F.col(f"l{i}"), "high": F.col(f"h{i}")}
            for i, c in enumerate(columns)
        ],
    )
    # Bounds come back as one small row per column and become literals.
    bounds = {r["column"]: (r["low"], r["high"]) for r in edges.collect()}
    used = [c for c in columns if bounds[c][0] is not None]
    if not used:
        return df.sparkSession.createDataFrame([], "column string, bin long, n long")

    def bin_of(c: str) -> Column:
        low, high = bounds[c]
        if low == high:
            # a constant column is spread over one unit around its value
            low, high = low - 0.5, high + 0.5
        return F.least(
            F.floor((F.col(c) - F.lit(low)) / F.lit((high - low) / bins)), F.lit(bins - 1)
        ).cast("bigint")

    return (
        df.select(*[bin_of(c).alias(c) for c in used])
        .unpivot([], used, "column", "bin")
        .filter(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_values(df: DataFrame, column: str, n: int = 15) -> DataFrame:
    """(value, n): the most common values of one column, as text."""
    return (
        df.groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc_nulls_first("value"))
        .limit(n)
    )


def missing_with_pct(profile: DataFrame) -> DataFrame:
    return profile.withColumn("null_pct", F.col("null_rate") * 100)


def top_outliers(outliers: DataFrame, n: int = 12) -> DataFrame:
    return outliers.orderBy(F.desc("outliers"), "column").limit(n)
