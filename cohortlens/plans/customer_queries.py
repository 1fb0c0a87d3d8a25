"""Customer features and splits."""

from __future__ import annotations

from cohortlens.operators import customers, splits
from cohortlens.operators.daily import daily_sales, fill_calendar
from cohortlens.plans.registry import Query, over_t
from cohortlens.session import cut_lineage
from cohortlens.sources.transactions import star_transactions

_REFERENCE = "(SELECT max(order_date) FROM t)"


def _mode_sql(column: str, name: str) -> str:
    return f"""{name} AS (
      SELECT customer_id, {column} AS {name} FROM (
        SELECT customer_id, {column}, row_number() OVER (
          PARTITION BY customer_id ORDER BY count(*) DESC, coalesce(CAST({column} AS VARCHAR), 'nan')) AS place
        FROM t GROUP BY customer_id, {column}) WHERE place = 1)"""


def _features_cte(reference: str) -> str:
    return f"""features AS (
      SELECT customer_id,
        date_diff('day', max(order_date), any_value(reference)) AS recency_days,
        count(DISTINCT order_id) AS frequency,
        sum(net_sales_usd) AS monetary_value,
        sum(net_sales_usd) / count(DISTINCT order_id) AS avg_order_value,
        any_value(order_value_std) AS order_value_std,
        count(DISTINCT product_id) AS product_diversity,
        count(DISTINCT order_id) / greatest(1, date_diff('day', min(order_date), any_value(reference)))
          AS purchase_velocity,
        any_value(preferred_category) AS preferred_category,
        any_value(preferred_payment_method) AS preferred_payment_method,
        avg(CASE WHEN return_status = 'Returned' THEN 1.0 ELSE 0.0 END) AS return_rate,
        avg(CASE WHEN coupon_used THEN 1.0 ELSE 0.0 END) AS coupon_usage_rate
      FROM t
      JOIN (SELECT customer_id, coalesce(stddev_samp(v), 0.0) AS order_value_std
            FROM (SELECT customer_id, order_id, sum(net_sales_usd) AS v FROM t GROUP BY ALL)
            GROUP BY customer_id) USING (customer_id)
      JOIN preferred_category USING (customer_id)
      JOIN preferred_payment_method USING (customer_id)
      CROSS JOIN (SELECT {reference} AS reference)
      GROUP BY customer_id)"""


def features_sql(select: str, reference: str = _REFERENCE, *ctes: str) -> str:
    """``select`` over the customer features as of ``reference``."""
    return over_t(
        select,
        _mode_sql("product_category", "preferred_category"),
        _mode_sql("payment_method", "preferred_payment_method"),
        _features_cte(reference),
        *ctes,
    )


FEATURES_SQL = features_sql("SELECT * FROM features")
FEATURE_DIGITS = {
    "monetary_value": 2,
    "avg_order_value": 2,
    "order_value_std": 2,
    "purchase_velocity": 6,
    "return_rate": 6,
    "coupon_usage_rate": 6,
}
_RFM = ["customer_id", "order_id", "order_date", "product_id", "net_sales_usd"]
_FIXED_DAY = "2002-01-01"


def rfm_rows(spark, folder):
    return customers.rfm_base(star_transactions(spark, folder, _RFM))


def feature_rows(spark, folder):
    return customers.customer_features(star_transactions(spark, folder))


def feature_table(spark, folder, reference_date=None):
    """Customer features as a written table, as the stages hand them on.

    What takes several passes then reads the table and not the lines.
    """
    return cut_lineage(customers.customer_features(star_transactions(spark, folder), reference_date))


def _velocity(spark, folder):
    df = star_transactions(spark, folder, _RFM)
    base = customers.rfm_base(df)
    return customers.purchase_velocity(base, customers.reference_day(df)).select(
        "customer_id", "purchase_velocity"
    )


_RFM_SQL = """SELECT customer_id, min(order_date) AS first_order_date, max(order_date) AS last_order_date,
       count(DISTINCT order_id) AS frequency, sum(net_sales_usd) AS monetary_value,
       count(DISTINCT product_id) AS product_diversity FROM t GROUP BY customer_id"""


def _split_sql(source: str, key: str, train: str, validation: str, seed: int = 42) -> str:
    return f"""SELECT {key}, CASE WHEN place <= train THEN 'train'
                         WHEN place <= train + validation THEN 'validation' ELSE 'test' END AS split
               FROM (SELECT {key}, row_number() OVER (ORDER BY md5('{seed}:' || {key}), {key}) AS place,
                            {train} AS train, {validation} AS validation
                     FROM (SELECT {key}, count(*) OVER () AS n FROM {source}))"""


def _ids(spark, folder):
    return star_transactions(spark, folder, ["customer_id"]).distinct()


def _days(spark, folder):
    return fill_calendar(
        daily_sales(star_transactions(spark, folder, ["order_date", "order_id", "net_sales_usd"]))
    )


_DAYS_CTE = """days AS (SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS DATE)
     AS order_date FROM t)"""
_CHRONO = """SELECT order_date, CASE WHEN place <= floor(n * 0.7e0) THEN 'train'
              WHEN place <= floor(n * 0.7e0) + floor(n * 0.15e0) THEN 'validation' ELSE 'test' END AS split
            FROM (SELECT order_date, row_number() OVER (ORDER BY order_date) AS place,
                         count(*) OVER () AS n FROM days)"""

QUERIES = [
    Query("rfm_base", rfm_rows, over_t(_RFM_SQL), {"monetary_value": 2}),
    Query(
        "order_value_std",
        lambda s, f: customers.order_value_std(star_transactions(s, f, _RFM)),
        features_sql("SELECT customer_id, order_value_std FROM features"),
        {"order_value_std": 2},
    ),
    Query(
        "recency_days",
        lambda s, f: customers.recency_days(
            star_transactions(s, f, ["customer_id", "order_date"])
        ),
        over_t(
            f"SELECT customer_id, date_diff('day', max(order_date), {_REFERENCE}) AS recency_days "
            "FROM t GROUP BY customer_id"
        ),
    ),
    Query(
        "recency_days_fixed_reference",
        lambda s, f: customers.recency_days(
            star_transactions(s, f, ["customer_id", "order_date"]), _FIXED_DAY
        ),
        over_t(
            f"SELECT customer_id, date_diff('day', max(order_date), DATE '{_FIXED_DAY}') AS recency_days "
            "FROM t GROUP BY customer_id"
        ),
    ),
    Query(
        "avg_order_value",
        lambda s, f: customers.avg_order_value(rfm_rows(s, f)).select(
            "customer_id", "avg_order_value"
        ),
        over_t(
            "SELECT customer_id, sum(net_sales_usd) / count(DISTINCT order_id) AS avg_order_value "
            "FROM t GROUP BY customer_id"
        ),
        {"avg_order_value": 2},
    ),
    Query(
        "purchase_velocity",
        _velocity,
        features_sql("SELECT customer_id, purchase_velocity FROM features"),
        {"purchase_velocity": 6},
    ),
    Query(
        "alphabetical_mode",
        lambda s, f: customers.alphabetical_mode(
            star_transactions(s, f, ["product_id", "return_reason"]), "product_id", "return_reason"
        ),
        over_t(
            """SELECT product_id, return_reason FROM (
                 SELECT product_id, return_reason, row_number() OVER (
                   PARTITION BY product_id ORDER BY count(*) DESC, coalesce(return_reason, 'nan')) AS place
                 FROM t GROUP BY product_id, return_reason) WHERE place = 1"""
        ),
    ),
    Query(
        "preferred_category",
        lambda s, f: customers.preferred(
            star_transactions(s, f, ["customer_id", "product_category"]),
            "product_category",
            "preferred_category",
        ),
        over_t(
            "SELECT * FROM preferred_category", _mode_sql("product_category", "preferred_category")
        ),
    ),
    Query(
        "preferred_payment_method",
        lambda s, f: customers.preferred(
            star_transactions(s, f, ["customer_id", "payment_method"]),
            "payment_method",
            "preferred_payment_method",
        ),
        over_t(
            "SELECT * FROM preferred_payment_method",
            _mode_sql("payment_method", "preferred_payment_method"),
        ),
    ),
    Query(
        "return_rate",
        lambda s, f: customers.return_rate(
            star_transactions(s, f, ["customer_id", "return_status"])
        ),
        over_t(
            "SELECT customer_id, avg(CASE WHEN return_status = 'Returned' THEN 1.0 ELSE 0.0 END) "
            "AS return_rate FROM t GROUP BY customer_id"
        ),
        {"return_rate": 6},
    ),
    Query(
        "coupon_usage_rate",
        lambda s, f: customers.coupon_usage_rate(
            star_transactions(s, f, ["customer_id", "coupon_used"])
        ),
        over_t(
            "SELECT customer_id, avg(CASE WHEN coupon_used THEN 1.0 ELSE 0.0 END) "
            "AS coupon_usage_rate FROM t GROUP BY customer_id"
        ),
        {"coupon_usage_rate": 6},
    ),
    Query("customer_features", feature_rows, FEATURES_SQL, FEATURE_DIGITS),
    Query(
        "customer_features_fixed_reference",
        lambda s, f: customers.customer_features(star_transactions(s, f), _FIXED_DAY),
        features_sql("SELECT * FROM features", f"DATE '{_FIXED_DAY}'"),
        FEATURE_DIGITS,
    ),
    Query(
        "split_random",
        lambda s, f: splits.split_random(_ids(s, f)),
        over_t(
            _split_sql(
                "(SELECT DISTINCT customer_id FROM t)", "customer_id", "floor(n * 0.7e0)", "floor(n * 0.15e0)"
            )
        ),
    ),
    Query(
        "split_random_events",
        lambda s, f: splits.split_random(
            s.read.parquet(f"{f}/events.parquet").select("event_id"), 0.6, 0.25, 7, "event_id"
        ),
        _split_sql("events", "event_id", "floor(n * 0.6e0)", "floor(n * 0.25e0)", 7),
    ),
    Query(
        "split_two_stage",
        lambda s, f: splits.split_two_stage(_ids(s, f)),
        over_t(
            _split_sql(
                "(SELECT DISTINCT customer_id FROM t)",
                "customer_id",
                "floor(n * 0.7e0)",
                "floor((n - floor(n * 0.7e0)) * 0.5)",
            )
        ),
    ),
    Query(
        "split_chronological",
        lambda s, f: splits.split_chronological(_days(s, f)).select("order_date", "split"),
        over_t(_CHRONO, _DAYS_CTE),
    ),
    Query(
        "split_report",
        lambda s, f: splits.split_report(splits.split_chronological(_days(s, f)), "order_date"),
        over_t(
            "SELECT split, count(*) AS rows, 5 AS columns, min(order_date) AS date_min, "
            f"max(order_date) AS date_max FROM ({_CHRONO}) GROUP BY split",
            _DAYS_CTE,
        ),
    ),
]
