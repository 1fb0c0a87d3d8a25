"""Profiles of the transaction rows and of the event stream's table."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from cohortlens.operators import profiling
from cohortlens.plans.customer_queries import FEATURES_SQL, feature_table
from cohortlens.plans.registry import Query, over_t
from cohortlens.sources.transactions import star_transactions

NUMERIC = [
    "quantity",
    "unit_price_usd",
    "gross_sales_usd",
    "discount_percentage",
    "discount_amount_usd",
    "net_sales_usd",
    "tax_rate_percentage",
    "tax_usd",
    "total_order_value_usd",
    "delivery_days",
]
CATEGORICAL = [
    "customer_segment",
    "customer_country",
    "sales_region",
    "product_name",
    "product_category",
    "brand",
    "payment_method",
    "order_status",
    "return_status",
    "return_reason",
    "coupon_used",
    "coupon_code",
]
CUSTOMER_NUMERIC = [
    "recency_days",
    "frequency",
    "monetary_value",
    "avg_order_value",
    "order_value_std",
    "product_diversity",
    "purchase_velocity",
    "return_rate",
    "coupon_usage_rate",
]
AS_OF = "2000-01-01"
_OVERVIEW = [
    "customer_id",
    "order_id",
    "product_id",
    "order_date",
    "gross_sales_usd",
    "net_sales_usd",
    "total_order_value_usd",
    "return_status",
    "return_reason",
]
# price and discount at coarse values: few distinct numbers
_NARROW = ["discount_percentage", "tax_rate_percentage", "quantity", "delivery_days"]


def _numeric(spark, folder):
    return star_transactions(spark, folder, NUMERIC)


def _categorical(spark, folder):
    return star_transactions(spark, folder, CATEGORICAL)


def _summary_sql(columns, source="t"):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
              CAST(min({c}) AS DOUBLE) AS min, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1,
              quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q2,
              quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3, CAST(max({c}) AS DOUBLE) AS max FROM {source}"""
        for c in columns
    )


_SUMMARY_DIGITS = {"mean": 4, "std": 4, "min": 4, "q1": 4, "q2": 4, "q3": 4, "max": 4}


def _outliers_sql(columns):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1)
              OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers
            FROM t, (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1,
                            quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM t)"""
        for c in columns
    )


_COUNTS_CTE = "counts AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM t GROUP BY {c}"
    for c in CATEGORICAL
) + ")"


def _distinct_sql(columns):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM t" for c in columns
    )


def _pearson_sql(columns, source):
    parts = []
    for a, b in combinations(columns, 2):
        for left, right in ((a, b), (b, a)):
            parts.append((left, right, a, b))
    parts += [(c, c, c, c) for c in columns]
    pairs = {(a, b) for _, _, a, b in parts}
    computed = ", ".join(
        f"covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0) AS p_{i}"
        for i, (a, b) in enumerate(sorted(pairs))
    )
    place = {pair: i for i, pair in enumerate(sorted(pairs))}
    rows = " UNION ALL ".join(
        f"SELECT '{left}' AS \"left\", '{right}' AS \"right\", p_{place[a, b]} AS pearson FROM m"
        for left, right, a, b in parts
    )
    return f"m AS (SELECT {computed} FROM {source})", rows


_M_CTE, _M_ROWS = _pearson_sql(NUMERIC, "t")
_C_CTE, _C_ROWS = _pearson_sql(CUSTOMER_NUMERIC, "features")


def _upper(columns, rows, comparison):
    order = "[" + ", ".join(f"'{c}'" for c in columns) + "]"
    return (
        f"SELECT * FROM ({rows}) WHERE list_position({order}, \"left\") < "
        f"list_position({order}, \"right\") AND abs(pearson) {comparison}"
    )


def _with_features(cte: str, select: str) -> str:
    head, tail = FEATURES_SQL.rsplit("SELECT * FROM features", 1)
    return head.rstrip() + ",\n" + cte + "\n" + select + tail


def _bins_sql(columns, bins, source="t"):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(least(floor((v - lo) / ((hi - lo) / {bins})), {bins - 1}) AS BIGINT) AS bin,
              count(*) AS n FROM (SELECT CAST({c} AS DOUBLE) AS v, min(CAST({c} AS DOUBLE)) OVER () AS lo,
              max(CAST({c} AS DOUBLE)) OVER () AS hi FROM {source}) GROUP BY ALL"""
        for c in columns
    )


def _events(spark, folder):
    return spark.read.parquet(f"{folder}/events.parquet")


_PRODUCTS_SQL = """SELECT product_id, product_name, CAST(sum(quantity) AS BIGINT) AS volume,
       sum(net_sales_usd) AS revenue FROM t GROUP BY product_id, product_name
       ORDER BY {by} DESC, product_id, product_name LIMIT {n}"""
_PRODUCT_COLUMNS = ["product_id", "product_name", "quantity", "net_sales_usd"]

_CUSTOMER_SQL = """SELECT customer_id, count(DISTINCT order_id) AS order_frequency,
       sum(net_sales_usd) AS monetary_value, max(order_date) AS last_order_date,
       min(order_date) AS first_order_date,
       date_diff('day', max(order_date), (SELECT max(order_date) FROM t)) AS recency_days
       FROM t GROUP BY customer_id"""

_MISSING_COLUMNS = ["order_id", "return_reason", "coupon_code", "coupon_used", "net_sales_usd"]
_MISSING_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS null_rate FROM t"
    for c in _MISSING_COLUMNS
)


def _missing(spark, folder):
    return profiling.missing_profile(star_transactions(spark, folder, _MISSING_COLUMNS), 0.20)


QUERIES = [
    Query(
        "dataset_overview",
        lambda s, f: profiling.dataset_overview(star_transactions(s, f, _OVERVIEW), AS_OF),
        over_t(
            f"""SELECT count(*) AS row_count, {len(_OVERVIEW)} AS column_count, min(order_date) AS date_min,
                  max(order_date) AS date_max,
                  count(*) FILTER (WHERE gross_sales_usd < 0) AS negative_gross_sales_usd,
                  count(*) FILTER (WHERE net_sales_usd < 0) AS negative_net_sales_usd,
                  count(*) FILTER (WHERE total_order_value_usd < 0) AS negative_total_order_value_usd,
                  count(*) FILTER (WHERE order_date > DATE '{AS_OF}') AS future_dates,
                  count(DISTINCT customer_id) AS distinct_customer_id,
                  count(DISTINCT order_id) AS distinct_order_id,
                  count(DISTINCT product_id) AS distinct_product_id,
                  count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(_OVERVIEW)} FROM t)) AS duplicate_rows,
                  'return_status,return_reason' AS possible_leakage_columns FROM t"""
        ),
    ),
    Query(
        "missing_profile",
        _missing,
        over_t(f"SELECT *, null_rate > 0.20 AS is_flagged FROM ({_MISSING_SQL})"),
        {"null_rate": 6},
    ),
    Query("numeric_summary", lambda s, f: profiling.numeric_summary(_numeric(s, f)),
          over_t(_summary_sql(NUMERIC)), _SUMMARY_DIGITS),
    Query(
        "numeric_summary_events",
        lambda s, f: profiling.numeric_summary(_events(s, f), ["value"]),
        _summary_sql(["value"], "events"),
        _SUMMARY_DIGITS,
    ),
    Query(
        "categorical_counts",
        lambda s, f: profiling.categorical_counts(_categorical(s, f), 20),
        over_t(
            'SELECT * FROM counts WHERE "column" IN (SELECT "column" FROM counts GROUP BY ALL '
            "HAVING count(*) <= 20)",
            _COUNTS_CTE,
        ),
    ),
    Query("iqr_outliers", lambda s, f: profiling.iqr_outliers(_numeric(s, f)),
          over_t(_outliers_sql(NUMERIC))),
    Query(
        "near_zero_variance",
        lambda s, f: profiling.near_zero_variance(
            # a column that is the same in every row beside the table's own
            star_transactions(s, f, _NARROW).withColumn(
                "row_share", F.col("quantity") / F.col("quantity")
            )
        ),
        over_t(
            "SELECT \"column\" FROM ("
            + _distinct_sql([*_NARROW, "row_share"]).replace(
                "FROM t", "FROM (SELECT *, quantity / quantity AS row_share FROM t)"
            )
            + ") WHERE distinct_values <= 1"
        ),
    ),
    Query(
        "distinct_counts",
        lambda s, f: profiling.distinct_counts(_numeric(s, f)),
        over_t(_distinct_sql(NUMERIC)),
    ),
    Query(
        "numeric_categorical_candidates",
        lambda s, f: profiling.numeric_categorical_candidates(
            star_transactions(s, f, _NARROW), 20
        ),
        over_t(f"SELECT * FROM ({_distinct_sql(_NARROW)}) WHERE distinct_values <= 20"),
    ),
    Query(
        "categorical_profile",
        lambda s, f: profiling.categorical_profile(_categorical(s, f), 10),
        over_t(
            """SELECT * FROM (SELECT "column", count(*) OVER (PARTITION BY "column") AS cardinality,
                 row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value NULLS FIRST) AS rank,
                 value, n FROM counts) WHERE rank <= 10""",
            _COUNTS_CTE,
        ),
    ),
    Query("pearson_matrix", lambda s, f: profiling.pearson_matrix(_numeric(s, f)),
          over_t(_M_ROWS, _M_CTE), {"pearson": 6}),
    Query(
        "flag_correlated_pairs",
        lambda s, f: profiling.flag_correlated_pairs(
            profiling.pearson_matrix(_numeric(s, f)), NUMERIC, 0.80
        ),
        over_t(_upper(NUMERIC, _M_ROWS, ">= 0.80"), _M_CTE),
        {"pearson": 6},
    ),
    Query(
        "customer_pearson_matrix",
        lambda s, f: profiling.pearson_matrix(feature_table(s, f), CUSTOMER_NUMERIC),
        _with_features(_C_CTE, _C_ROWS),
        {"pearson": 6},
    ),
    Query(
        "customer_flag_correlated_pairs",
        lambda s, f: profiling.flag_correlated_pairs(
            profiling.pearson_matrix(feature_table(s, f), CUSTOMER_NUMERIC),
            CUSTOMER_NUMERIC,
            0.50,
            inclusive=False,
        ),
        _with_features(_C_CTE, _upper(CUSTOMER_NUMERIC, _C_ROWS, "> 0.50")),
        {"pearson": 6},
    ),
    Query(
        "customer_summary",
        lambda s, f: profiling.customer_summary(
            star_transactions(s, f, ["customer_id", "order_id", "order_date", "net_sales_usd"])
        ),
        over_t(_CUSTOMER_SQL),
        {"monetary_value": 2},
    ),
    Query(
        "repeat_purchase_rate",
        lambda s, f: profiling.repeat_purchase_rate(
            star_transactions(s, f, ["customer_id", "order_id"])
        ),
        over_t(
            "SELECT avg(CASE WHEN n > 1 THEN 1.0 ELSE 0.0 END) AS repeat_purchase_rate FROM "
            "(SELECT count(DISTINCT order_id) AS n FROM t GROUP BY customer_id)"
        ),
        {"repeat_purchase_rate": 6},
    ),
    Query(
        "top_products_by_revenue",
        lambda s, f: profiling.top_products(star_transactions(s, f, _PRODUCT_COLUMNS), 10),
        over_t(_PRODUCTS_SQL.format(by="revenue", n=10)),
        {"revenue": 2},
    ),
    Query(
        "top_products_by_volume",
        lambda s, f: profiling.top_products(
            star_transactions(s, f, _PRODUCT_COLUMNS), 10, "volume"
        ),
        over_t(_PRODUCTS_SQL.format(by="volume", n=10)),
        {"revenue": 2},
    ),
    Query(
        "category_mix",
        lambda s, f: profiling.category_mix(
            star_transactions(s, f, ["product_category", "quantity", "net_sales_usd"])
        ),
        over_t(
            "SELECT product_category, CAST(sum(quantity) AS BIGINT) AS volume, "
            "sum(net_sales_usd) AS revenue FROM t GROUP BY product_category"
        ),
        {"revenue": 2},
    ),
    Query(
        "histogram",
        lambda s, f: profiling.histogram(
            star_transactions(s, f, ["quantity", "gross_sales_usd", "delivery_days"]),
            ["quantity", "gross_sales_usd", "delivery_days"],
        ),
        over_t(_bins_sql(["quantity", "gross_sales_usd", "delivery_days"], 20)),
    ),
    Query(
        "histogram_events",
        lambda s, f: profiling.histogram(_events(s, f), ["value"], 50),
        _bins_sql(["value"], 50, "events"),
    ),
    Query(
        "top_values",
        lambda s, f: profiling.top_values(star_transactions(s, f, ["product_name"]), "product_name"),
        over_t(
            "SELECT product_name AS value, count(*) AS n FROM t GROUP BY ALL "
            "ORDER BY n DESC, value NULLS FIRST LIMIT 15"
        ),
    ),
    Query(
        "missing_with_pct",
        lambda s, f: profiling.missing_with_pct(_missing(s, f)),
        over_t(
            f"SELECT *, null_rate > 0.20 AS is_flagged, null_rate * 100 AS null_pct FROM ({_MISSING_SQL})"
        ),
        {"null_rate": 6, "null_pct": 4},
    ),
    Query(
        "top_outliers",
        lambda s, f: profiling.top_outliers(profiling.iqr_outliers(_numeric(s, f)), 5),
        over_t(f"SELECT * FROM ({_outliers_sql(NUMERIC)}) ORDER BY outliers DESC, \"column\" LIMIT 5"),
    ),
]
