"""Validation and cleaning over the transaction rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import cleaning, validation
from cohortlens.operators.profiling import iqr_outliers
from cohortlens.plans.customer_queries import feature_table, features_sql
from cohortlens.plans.registry import Query, over_t
from cohortlens.sources.contract import CONTRACT, FILL_VALUES, RANGES, snake
from cohortlens.sources.transactions import STAR_COLUMNS, star_transactions

AS_OF = "2000-01-01"
_ALL_COLUMNS = list(STAR_COLUMNS)
_ALLOWED = {
    "return_status": ["No Return"],
    "order_status": ["F", "O"],
    "customer_segment": ["BUILDING", "MACHINERY"],
    "coupon_used": [True],
}
_FILL = snake(FILL_VALUES)
_RANGES = snake(RANGES)
_CASE_RULES = {"delivery_days": (0, 365), "quantity": (1, 40)}


def _counts_sql(conditions: dict[str, str], name: str, value: str) -> str:
    """One row per entry with the number of rows that meet its condition."""
    counted = ", ".join(f'count(*) FILTER (WHERE {c}) AS "{n}"' for n, c in conditions.items())
    return (
        f"SELECT * FROM (UNPIVOT (SELECT {counted} FROM t) ON COLUMNS(*) "
        f'INTO NAME "{name}" VALUE {value})'
    )


def _failures_sql(rules: dict[tuple[str, str], str]) -> str:
    listed = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{k}' AS \"check\", "
        f"count(*) FILTER (WHERE {cond}) AS failures FROM t"
        for (c, k), cond in rules.items()
    )
    return over_t(listed)


_DOMAIN = {
    ("quantity", "> 0"): "quantity <= 0",
    ("discount_percentage", "in [0, 100]"): "NOT discount_percentage BETWEEN 0 AND 100",
    ("tax_rate_percentage", "in [0, 100]"): "NOT tax_rate_percentage BETWEEN 0 AND 100",
}
_RANGE_CHECKS = {
    ("quantity", "in [1, 100000]"): "NOT quantity BETWEEN 1 AND 100000",
    ("discount_percentage", "in [0, 100]"): "NOT discount_percentage BETWEEN 0 AND 100",
    ("tax_rate_percentage", "in [0, 100]"): "NOT tax_rate_percentage BETWEEN 0 AND 100",
    ("delivery_days", "in [0, 365]"): "NOT delivery_days BETWEEN 0 AND 365",
}


def _failure_cases(spark, folder):
    df = star_transactions(
        spark, folder, ["order_id", "product_id", "delivery_days", "quantity", "return_reason"]
    )
    rules = validation.domain_rules(within=_CASE_RULES)
    rules += validation.not_null_rules(df, ["return_reason"])
    return validation.check_failure_cases(df, rules, ["order_id", "product_id"])


def _null_rate_view(spark, folder):
    return star_transactions(
        spark,
        folder,
        ["order_id", "return_reason", "coupon_code", "coupon_used", "net_sales_usd"],
    )


def _duplicates_view(spark, folder):
    """A narrow projection of the lines, which does hold repeated rows."""
    return star_transactions(
        spark, folder, ["customer_id", "product_category", "return_status", "coupon_used"]
    )


def _contract_view(spark, folder):
    return star_transactions(
        spark, folder, [c for c in _ALL_COLUMNS if c in CONTRACT.columns]
    )


def _issues(spark, folder):
    df = _contract_view(spark, folder)
    return validation.find_issues(
        df,
        contract=CONTRACT.restricted_to(set(df.columns) - {"supplier", "brand"}),
        nullable_columns=("return_reason",),
        allowed_categories=_ALLOWED,
        ranges=_RANGES,
    )


def _summary(spark, folder):
    df = _duplicates_view(spark, folder)
    return validation.validation_report(
        df,
        contract=CONTRACT.restricted_to(df.columns),
        allowed_categories={"return_status": ["No Return"]},
    )


def _scoring_input(spark, folder):
    features = feature_table(spark, folder, AS_OF)
    accepted, rejected = validation.check_scoring_input(features)
    return accepted.select(
        "customer_id", F.lit("accepted").alias("outcome"), F.lit("").alias("failed_columns")
    ).unionByName(
        rejected.select(
            "customer_id",
            F.lit("rejected").alias("outcome"),
            F.array_join("failed_columns", ",").alias("failed_columns"),
        )
    )


def _filled(spark, folder):
    df = star_transactions(spark, folder, ["order_id", "product_id", "return_reason", "coupon_code"])
    return cleaning.fill_not_applicable(df, _FILL)


def _remaining(spark, folder):
    df = cleaning.fill_not_applicable(
        _null_rate_view(spark, folder), {"return_reason": _FILL["return_reason"]}
    )
    return cleaning.remaining_missing(df, 0.20)


def _retained(spark, folder):
    columns = ["quantity", "gross_sales_usd", "net_sales_usd", "tax_usd", "delivery_days"]
    outliers = iqr_outliers(star_transactions(spark, folder, columns))
    return cleaning.outlier_retention_report(outliers).drop("decision")


def _modeling_view(spark, folder):
    df = star_transactions(
        spark,
        folder,
        ["order_id", "product_id", "quantity", "return_status", "return_reason", "coupon_used"],
    )
    return cleaning.modeling_view(df)


def _outlier_sql(columns):
    parts = []
    for c in columns:
        parts.append(
            f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) "
            f"OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers FROM t, (SELECT "
            f"quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, "
            f"quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM t)"
        )
    return " UNION ALL ".join(parts)


QUERIES = [
    Query(
        "check_not_null",
        lambda s, f: validation.check_not_null(star_transactions(s, f), _ALL_COLUMNS),
        over_t(
            "SELECT \"column\", 'not_null' AS \"check\", failures FROM ("
            + _counts_sql({c: f"{c} IS NULL" for c in _ALL_COLUMNS}, "column", "failures")
            + ")"
        ),
    ),
    Query(
        "check_domain",
        lambda s, f: validation.check_domain(
            star_transactions(s, f, ["quantity", "discount_percentage", "tax_rate_percentage"]),
            greater_than={"quantity": 0},
            within={"discount_percentage": (0, 100), "tax_rate_percentage": (0, 100)},
        ),
        _failures_sql(_DOMAIN),
    ),
    Query(
        "check_ranges",
        lambda s, f: validation.check_ranges(
            star_transactions(
                s, f, ["quantity", "discount_percentage", "tax_rate_percentage", "delivery_days"]
            ),
            _RANGES,
        ),
        _failures_sql(_RANGE_CHECKS),
    ),
    Query(
        "check_failure_cases",
        _failure_cases,
        over_t(
            """SELECT order_id, product_id, 'delivery_days' AS "column", 'in [0, 365]' AS "check",
                      CAST(delivery_days AS VARCHAR) AS value
               FROM t WHERE delivery_days NOT BETWEEN 0 AND 365
               UNION ALL
               SELECT order_id, product_id, 'quantity', 'in [1, 40]', CAST(quantity AS VARCHAR)
               FROM t WHERE quantity NOT BETWEEN 1 AND 40
               UNION ALL
               SELECT order_id, product_id, 'return_reason', 'not_null', NULL
               FROM t WHERE return_reason IS NULL"""
        ),
    ),
    Query(
        "check_duplicates",
        lambda s, f: validation.check_duplicates(_duplicates_view(s, f)),
        over_t(
            """SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM (
                 SELECT count(*) AS n FROM t
                 GROUP BY customer_id, product_category, return_status, coupon_used)"""
        ),
    ),
    Query(
        "check_null_rate",
        lambda s, f: validation.check_null_rate(
            _null_rate_view(s, f), 0.20, ("return_reason",)
        ),
        over_t(
            """SELECT 'coupon_code' AS "column", count(*) FILTER (WHERE coupon_code IS NULL) AS null_count,
                      avg(CASE WHEN coupon_code IS NULL THEN 1.0 ELSE 0.0 END) AS null_rate
               FROM t HAVING null_rate > 0.20"""
        ),
        {"null_rate": 6},
    ),
    Query(
        "check_categories",
        lambda s, f: validation.check_categories(
            star_transactions(s, f, list(_ALLOWED)), _ALLOWED
        ),
        over_t(
            """SELECT 'return_status' AS "column", return_status AS value, count(*) AS failures
               FROM t WHERE return_status <> 'No Return' GROUP BY return_status
               UNION ALL
               SELECT 'order_status', order_status, count(*) FROM t
               WHERE order_status NOT IN ('F', 'O') GROUP BY order_status
               UNION ALL
               SELECT 'customer_segment', customer_segment, count(*) FROM t
               WHERE customer_segment NOT IN ('BUILDING', 'MACHINERY') GROUP BY customer_segment
               UNION ALL
               SELECT 'coupon_used', 'false', count(*) FROM t WHERE NOT coupon_used HAVING count(*) > 0"""
        ),
    ),
    Query(
        "validation_issues",
        _issues,
        over_t(
            """SELECT * FROM (
                 SELECT 'unexpected_columns' AS code, unnest(['brand', 'supplier']) AS "column", 1 AS failures
                 UNION ALL
                 SELECT 'schema_type', unnest(['customer_id', 'order_id', 'product_id']), 1
                 UNION ALL
                 SELECT 'range', 'delivery_days', count(*) FROM t WHERE delivery_days NOT BETWEEN 0 AND 365
                 UNION ALL
                 SELECT 'range', 'quantity', count(*) FROM t WHERE quantity NOT BETWEEN 1 AND 100000
                 UNION ALL
                 SELECT 'duplicate_rows', NULL, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (ship) FROM (
                     SELECT *, 1 AS ship FROM t))) FROM t
                 UNION ALL
                 SELECT 'null_rate', 'coupon_code', count(*) FILTER (WHERE coupon_code IS NULL) FROM t
                 HAVING avg(CASE WHEN coupon_code IS NULL THEN 1.0 ELSE 0.0 END) > 0.2
                 UNION ALL
                 SELECT 'category', 'return_status', count(*) FROM t WHERE return_status <> 'No Return'
                 UNION ALL
                 SELECT 'category', 'order_status', count(*) FROM t WHERE order_status NOT IN ('F', 'O')
                 UNION ALL
                 SELECT 'category', 'customer_segment', count(*) FROM t
                 WHERE customer_segment NOT IN ('BUILDING', 'MACHINERY')
                 UNION ALL
                 SELECT 'category', 'coupon_used', count(*) FROM t WHERE NOT coupon_used
               ) WHERE failures > 0"""
        ),
    ),
    Query(
        "validation_report",
        _summary,
        over_t(
            # the id column is a number here but text in the contract; repeated rows; one bad status
            """SELECT false AS passed, 1 + CAST(repeated > 0 AS BIGINT) + CAST(bad > 0 AS BIGINT) AS issue_count,
                      row_count, 4 AS column_count
               FROM (SELECT count(*) AS row_count,
                            count(*) - (SELECT count(*) FROM (SELECT DISTINCT customer_id,
                              product_category, return_status, coupon_used FROM t)) AS repeated,
                            count(*) FILTER (WHERE return_status <> 'No Return') AS bad FROM t)"""
        ),
    ),
    Query(
        "check_scoring_input",
        _scoring_input,
        features_sql(
            """SELECT customer_id, CASE WHEN recency_days < 0 THEN 'rejected' ELSE 'accepted' END AS outcome,
                      CASE WHEN recency_days < 0 THEN 'recency_days' ELSE '' END AS failed_columns
               FROM features""",
            f"DATE '{AS_OF}'",
        ),
    ),
    Query(
        "drop_exact_duplicates",
        lambda s, f: cleaning.drop_exact_duplicates(_duplicates_view(s, f)),
        over_t("SELECT DISTINCT customer_id, product_category, return_status, coupon_used FROM t"),
    ),
    Query(
        "fix_dtypes",
        lambda s, f: cleaning.fix_dtypes(
            s.read.parquet(f"{f}/events.parquet").select("event_id", "ts"), "ts"
        ),
        "SELECT event_id, CAST(ts AS DATE) AS ts FROM events",
    ),
    Query(
        "flag_future_dates",
        lambda s, f: cleaning.flag_future_dates(
            star_transactions(s, f, ["order_id", "order_date"]), as_of=AS_OF
        ),
        over_t(f"SELECT order_id, order_date, order_date > DATE '{AS_OF}' AS is_future FROM t"),
    ),
    Query(
        "future_date_report",
        lambda s, f: cleaning.future_date_report(
            star_transactions(s, f, ["order_date"]), as_of=AS_OF
        ).drop("decision"),
        over_t(
            f"SELECT count(*) FILTER (WHERE order_date > DATE '{AS_OF}') AS future_count, "
            f"DATE '{AS_OF}' AS as_of FROM t"
        ),
    ),
    Query(
        "fill_not_applicable",
        _filled,
        over_t(
            """SELECT order_id, product_id, coalesce(return_reason, 'Not Returned') AS return_reason,
                      coalesce(coupon_code, 'No Coupon') AS coupon_code FROM t"""
        ),
    ),
    Query(
        "count_filled",
        lambda s, f: cleaning.count_filled(
            star_transactions(s, f, ["return_reason", "coupon_code"]), _FILL
        ),
        over_t(
            _counts_sql({c: f"{c} IS NULL" for c in _FILL}, "column", "filled")
        ),
    ),
    Query(
        "remaining_missing",
        _remaining,
        over_t(
            """SELECT 'coupon_code' AS "column", count(*) FILTER (WHERE coupon_code IS NULL) AS null_count,
                      avg(CASE WHEN coupon_code IS NULL THEN 1.0 ELSE 0.0 END) AS null_rate
               FROM t HAVING null_rate > 0.20"""
        ),
        {"null_rate": 6},
    ),
    Query(
        "outlier_retention_report",
        _retained,
        over_t(
            "SELECT *, \"column\" IN ('gross_sales_usd', 'net_sales_usd', 'tax_usd') "
            "AS is_untouched_amount FROM ("
            + _outlier_sql(
                ["quantity", "gross_sales_usd", "net_sales_usd", "tax_usd", "delivery_days"]
            )
            + ")"
        ),
    ),
    Query(
        "modeling_exclusions",
        _modeling_view,
        over_t("SELECT order_id, product_id, quantity, coupon_used FROM t"),
    ),
]
