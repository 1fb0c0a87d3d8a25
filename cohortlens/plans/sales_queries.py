"""Sales over time, daily features and the dashboard's filtered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.operators import daily, dashboard, sales
from cohortlens.plans.customer_queries import feature_rows
from cohortlens.plans.registry import Query, over_t
from cohortlens.session import scratch_path
from cohortlens.sources.tables import read_date_range, write_by_month
from cohortlens.sources.transactions import star_transactions

_COLUMNS = ["order_date", "order_id", "net_sales_usd"]
START, END = "1996-03-10", "1997-08-20"


def _sales(spark, folder):
    return star_transactions(spark, folder, _COLUMNS)


def daily_rows(spark, folder):
    return daily.interpolate_gaps(daily.fill_calendar(daily.daily_sales(_sales(spark, folder))))


def _in_range(spark, folder):
    return dashboard.filter_date_range(daily_rows(spark, folder), START, END)


def _by_month(spark, folder):
    """The sales written by month, and the range read back from its months only."""
    rows, path = _sales(spark, folder), scratch_path(spark, "months")
    write_by_month(rows, path)
    return read_date_range(spark, path, rows.schema, START, END)


GAPS = """gaps AS (
  SELECT order_date FROM (SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY))
    AS DATE) AS order_date FROM t)
  WHERE order_date NOT IN (SELECT order_date FROM t))"""
DAYS = """days AS (
  SELECT c.order_date, coalesce(total_sales, 0.0) AS total_sales, coalesce(order_count, 0) AS order_count,
         coalesce(average_order_value, 0.0) AS average_order_value, o.order_date IS NULL AS is_gap_day,
         row_number() OVER (ORDER BY c.order_date) AS place
  FROM (SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS DATE)
        AS order_date FROM t) c
  LEFT JOIN (SELECT order_date, sum(net_sales_usd) AS total_sales, count(DISTINCT order_id) AS order_count,
                    avg(net_sales_usd) AS average_order_value FROM t GROUP BY order_date) o
    ON c.order_date = o.order_date)"""
FILLED = """filled AS (
  SELECT order_date, total_sales, order_count, average_order_value, is_gap_day,
    CASE WHEN NOT is_gap_day THEN total_sales
         WHEN nxt IS NULL THEN before_sales
         ELSE before_sales + (after_sales - before_sales) * (place - prv) / (nxt - prv) END AS gap_filled_sales
  FROM (SELECT d.*,
      max(CASE WHEN NOT is_gap_day THEN place END) OVER (ORDER BY place) AS prv,
      min(CASE WHEN NOT is_gap_day THEN place END) OVER (ORDER BY place DESC) AS nxt,
      FROM days d) d
  LEFT JOIN (SELECT place AS p1, total_sales AS before_sales FROM days) ON p1 = prv
  LEFT JOIN (SELECT place AS p2, total_sales AS after_sales FROM days) ON p2 = nxt)"""
_DAY_DIGITS = {"total_sales": 2, "average_order_value": 2}
_FILL_DIGITS = {**_DAY_DIGITS, "gap_filled_sales": 2}
_MONTHS = """months AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month,
   sum(net_sales_usd) AS total_sales, count(DISTINCT order_id) AS order_count FROM t GROUP BY 1)"""


def _resample_sql(bucket: str, step: str, window: int = 7) -> str:
    return over_t(
        f"""SELECT period_start, coalesce(sales, 0.0) AS sales, coalesce(orders, 0) AS orders,
              avg(coalesce(sales, 0.0)) OVER (ORDER BY period_start ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)
                AS rolling_mean,
              (coalesce(sales, 0.0) - lag(coalesce(sales, 0.0)) OVER (ORDER BY period_start))
                / nullif(lag(coalesce(sales, 0.0)) OVER (ORDER BY period_start), 0) AS period_over_period_change
            FROM (SELECT CAST(unnest(generate_series(min(b), max(b), INTERVAL {step})) AS DATE) AS period_start
                  FROM buckets)
            LEFT JOIN (SELECT b AS period_start, sum(net_sales_usd) AS sales, count(net_sales_usd) AS orders
                       FROM buckets GROUP BY b) USING (period_start)""",
        f"buckets AS (SELECT CAST({bucket} AS DATE) AS b, net_sales_usd FROM t)",
    )


_RESAMPLE_DIGITS = {"sales": 2, "rolling_mean": 2, "period_over_period_change": 6}


def _pattern(spark, folder):
    gaps = sales.zero_transaction_days(
        star_transactions(spark, folder, ["order_date"])
    )
    return sales.zero_day_pattern(gaps).select(
        "gap_count",
        F.array_join("day_of_week", ",").alias("day_of_week"),
        F.array_join(F.col("day_of_month").cast("array<string>"), ",").alias("day_of_month"),
        F.array_join(F.col("days_from_month_end").cast("array<string>"), ",").alias(
            "days_from_month_end"
        ),
        "all_within_final_three_days_of_month",
        F.array_join(F.col("spacing_days").cast("array<string>"), ",").alias("spacing_days"),
        "spacing_is_even",
    )


_PATTERN_SQL = over_t(
    """SELECT count(*) AS gap_count,
         coalesce((SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT DISTINCT dayname(order_date) AS x FROM gaps)), '') AS day_of_week,
         coalesce((SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT DISTINCT day(order_date) AS x FROM gaps)), '') AS day_of_month,
         coalesce((SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT DISTINCT date_diff('day', order_date, last_day(order_date)) AS x
            FROM gaps)), '') AS days_from_month_end,
         coalesce(bool_and(date_diff('day', order_date, last_day(order_date)) <= 2), true)
           AS all_within_final_three_days_of_month,
         coalesce(string_agg(spacing, ',' ORDER BY order_date) FILTER (WHERE spacing IS NOT NULL), '') AS spacing_days,
         count(DISTINCT spacing) <= 1 AS spacing_is_even
       FROM (SELECT order_date, date_diff('day', lag(order_date) OVER (ORDER BY order_date), order_date) AS spacing
             FROM gaps)""",
    GAPS,
)


def _report(spark, folder):
    return daily.feature_report(
        feature_rows(spark, folder), daily.sales_features(_sales(spark, folder))
    )


def _overview(spark, folder):
    df = star_transactions(spark, folder)
    # clusters of the given vectors stand in for fitted segments
    labels = spark.read.parquet(f"{folder}/embeddings.parquet").select(
        F.col("label").alias("cluster")
    )
    return dashboard.executive_overview(
        sales.sales_kpis(df), feature_rows(spark, folder), df, labels
    )


_WEEKDAY = (
    "CAST(isodow(order_date) - 1 AS BIGINT) AS weekday_number, dayname(order_date) AS weekday"
)

QUERIES = [
    Query(
        "zero_transaction_days",
        lambda s, f: sales.zero_transaction_days(star_transactions(s, f, ["order_date"])),
        over_t("SELECT * FROM gaps", GAPS),
    ),
    Query("zero_day_pattern", _pattern, _PATTERN_SQL),
    Query(
        "sales_kpis",
        lambda s, f: sales.sales_kpis(_sales(s, f)),
        over_t(
            """SELECT sum(net_sales_usd) AS total_revenue, count(DISTINCT order_id) AS total_orders,
                 sum(net_sales_usd) / count(DISTINCT order_id) AS average_order_value,
                 (SELECT coalesce(total_sales / lag(total_sales) OVER (ORDER BY month) - 1, 0) FROM months
                  ORDER BY month DESC LIMIT 1) AS period_over_period_growth_rate FROM t""",
            _MONTHS,
        ),
        {"total_revenue": 2, "average_order_value": 2, "period_over_period_growth_rate": 6},
    ),
    Query(
        "monthly_trend",
        lambda s, f: sales.monthly_trend(_sales(s, f)),
        over_t(
            """SELECT month, total_sales, order_count, (total_sales - lag(total_sales) OVER (ORDER BY month))
                 / nullif(lag(total_sales) OVER (ORDER BY month), 0) AS month_over_month_change FROM months""",
            _MONTHS,
        ),
        {"total_sales": 2, "month_over_month_change": 6},
    ),
    Query(
        "weekday_pattern",
        lambda s, f: sales.weekday_pattern(_sales(s, f)),
        over_t(
            f"""SELECT {_WEEKDAY}, avg(v) AS average_daily_sales FROM
               (SELECT order_date, sum(net_sales_usd) AS v FROM t GROUP BY order_date) GROUP BY ALL"""
        ),
        {"average_daily_sales": 2},
    ),
    Query(
        "resample_sales_daily",
        lambda s, f: sales.resample_sales(_sales(s, f), "daily"),
        _resample_sql("order_date", "1 DAY"),
        _RESAMPLE_DIGITS,
    ),
    Query(
        "resample_sales_weekly",
        lambda s, f: sales.resample_sales(_sales(s, f), "weekly"),
        _resample_sql("date_trunc('week', order_date) + INTERVAL 6 DAY", "7 DAY"),
        _RESAMPLE_DIGITS,
    ),
    Query(
        "resample_sales_monthly",
        lambda s, f: sales.resample_sales(_sales(s, f), "monthly", 3),
        _resample_sql("date_trunc('month', order_date)", "1 MONTH", 3),
        _RESAMPLE_DIGITS,
    ),
    Query(
        "daily_sales",
        lambda s, f: daily.daily_sales(_sales(s, f)),
        over_t(
            """SELECT order_date, sum(net_sales_usd) AS total_sales, count(DISTINCT order_id) AS order_count,
                 avg(net_sales_usd) AS average_order_value FROM t GROUP BY order_date"""
        ),
        _DAY_DIGITS,
    ),
    Query(
        "fill_calendar",
        lambda s, f: daily.fill_calendar(daily.daily_sales(_sales(s, f))),
        over_t("SELECT * EXCLUDE (place) FROM days", DAYS),
        _DAY_DIGITS,
    ),
    Query(
        "flag_gap_days",
        lambda s, f: daily.fill_calendar(daily.daily_sales(_sales(s, f))).select(
            "order_date", "is_gap_day"
        ),
        over_t(
            """SELECT order_date, order_date IN (SELECT order_date FROM gaps) AS is_gap_day FROM days""",
            GAPS,
            DAYS,
        ),
    ),
    Query(
        "interpolate_gaps", daily_rows, over_t("SELECT * FROM filled", DAYS, FILLED), _FILL_DIGITS
    ),
    Query(
        "calendar_features",
        lambda s, f: daily.calendar_features(
            s.read.parquet(f"{f}/orders.parquet").select(
                "o_orderkey", F.col("o_orderdate").cast("date").alias("order_date")
            )
        ),
        """SELECT o_orderkey, d AS order_date, year(d) AS year, month(d) AS month,
             isodow(d) - 1 AS day_of_week, isodow(d) >= 6 AS is_weekend, quarter(d) AS quarter,
             date_diff('day', (SELECT min(CAST(o_orderdate AS DATE)) FROM orders), d) AS day_index
           FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
    ),
    Query(
        "cyclical_encoding",
        lambda s, f: daily.cyclical_encoding(
            s.read.parquet(f"{f}/events.parquet").select(
                "event_id", F.month("ts").alias("month"), F.weekday("ts").alias("day_of_week")
            )
        ),
        """SELECT event_id, m AS month, w AS day_of_week, sin(2 * pi() * m / 12) AS month_sin,
             cos(2 * pi() * m / 12) AS month_cos, sin(2 * pi() * w / 7) AS day_of_week_sin,
             cos(2 * pi() * w / 7) AS day_of_week_cos
           FROM (SELECT event_id, month(ts) AS m, isodow(ts) - 1 AS w FROM events)""",
        {"month_sin": 6, "month_cos": 6, "day_of_week_sin": 6, "day_of_week_cos": 6},
    ),
    Query(
        "sales_features",
        lambda s, f: daily.sales_features(_sales(s, f)),
        over_t(
            """SELECT order_date, year(order_date) AS year, month(order_date) AS month,
                 isodow(order_date) - 1 AS day_of_week, isodow(order_date) >= 6 AS is_weekend,
                 quarter(order_date) AS quarter,
                 date_diff('day', (SELECT min(order_date) FROM t), order_date) AS day_index,
                 sin(2 * pi() * month(order_date) / 12) AS month_sin,
                 cos(2 * pi() * month(order_date) / 12) AS month_cos,
                 sin(2 * pi() * (isodow(order_date) - 1) / 7) AS day_of_week_sin,
                 cos(2 * pi() * (isodow(order_date) - 1) / 7) AS day_of_week_cos,
                 total_sales, order_count, average_order_value, is_gap_day, gap_filled_sales FROM filled""",
            DAYS,
            FILLED,
        ),
        {
            "month_sin": 6,
            "month_cos": 6,
            "day_of_week_sin": 6,
            "day_of_week_cos": 6,
            **_FILL_DIGITS,
        },
    ),
    Query(
        "feature_report",
        _report,
        over_t(
            """SELECT (SELECT count(DISTINCT customer_id) FROM t) AS customer_rows, 12 AS customer_columns,
                 count(*) AS sales_rows, 16 AS sales_columns,
                 count(*) FILTER (WHERE is_gap_day) AS zero_transaction_days FROM days""",
            DAYS,
        ),
    ),
    Query(
        "filter_date_range",
        lambda s, f: dashboard.filter_date_range(_sales(s, f), START, END),
        over_t(
            f"SELECT order_date, order_id, net_sales_usd FROM t "
            f"WHERE order_date BETWEEN DATE '{START}' AND DATE '{END}'"
        ),
        {"net_sales_usd": 4},
    ),
    Query(
        "read_date_range",
        _by_month,
        over_t(
            f"SELECT order_date, order_id, net_sales_usd FROM t "
            f"WHERE order_date BETWEEN DATE '{START}' AND DATE '{END}'"
        ),
        {"net_sales_usd": 4},
    ),
    Query(
        "range_kpis",
        lambda s, f: dashboard.range_kpis(_in_range(s, f)),
        over_t(
            f"""SELECT sum(total_sales) AS total_revenue, CAST(sum(order_count) AS BIGINT) AS total_orders,
                 sum(total_sales) / sum(order_count) AS average_order_value,
                 (SELECT s / nullif(lag(s) OVER (ORDER BY m), 0) - 1 FROM
                   (SELECT date_trunc('month', order_date) AS m, sum(total_sales) AS s FROM days
                    WHERE order_date BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY 1)
                  ORDER BY m DESC LIMIT 1) AS latest_month_over_month
               FROM days WHERE order_date BETWEEN DATE '{START}' AND DATE '{END}'""",
            DAYS,
        ),
        {"total_revenue": 2, "average_order_value": 2, "latest_month_over_month": 6},
    ),
    Query(
        "monthly_from_daily",
        lambda s, f: dashboard.monthly_from_daily(daily_rows(s, f)),
        over_t(
            "SELECT strftime(order_date, '%Y-%m') AS month, sum(total_sales) AS total_sales "
            "FROM days GROUP BY 1",
            DAYS,
        ),
        {"total_sales": 2},
    ),
    Query(
        "weekday_from_daily",
        lambda s, f: dashboard.weekday_from_daily(daily_rows(s, f)),
        over_t(
            f"SELECT {_WEEKDAY}, avg(total_sales) AS total_sales FROM days GROUP BY ALL", DAYS
        ),
        {"total_sales": 2},
    ),
    Query(
        "list_categories",
        lambda s, f: dashboard.list_categories(star_transactions(s, f, ["product_category"])),
        over_t("SELECT DISTINCT product_category AS category FROM t"),
    ),
    Query(
        "top_products_filtered",
        lambda s, f: dashboard.top_products_filtered(
            star_transactions(
                s,
                f,
                ["order_date", "product_id", "product_name", "product_category", "quantity", "net_sales_usd"],
            ),
            START,
            END,
            "ECONOMY",
        ),
        over_t(
            f"""SELECT product_id, product_name, CAST(sum(quantity) AS BIGINT) AS volume,
                 sum(net_sales_usd) AS revenue FROM t
               WHERE order_date BETWEEN DATE '{START}' AND DATE '{END}' AND product_category = 'ECONOMY'
               GROUP BY product_id, product_name ORDER BY revenue DESC, product_id LIMIT 10"""
        ),
        {"revenue": 2},
    ),
    Query(
        "gap_days_in_range",
        lambda s, f: dashboard.gap_days_in_range(daily_rows(s, f)),
        over_t(
            "SELECT order_date, is_gap_day, gap_filled_sales FROM filled WHERE is_gap_day",
            DAYS,
            FILLED,
        ),
        {"gap_filled_sales": 2},
    ),
    Query(
        "executive_overview",
        _overview,
        over_t(
            """SELECT sum(net_sales_usd) AS total_revenue, count(DISTINCT order_id) AS total_orders,
                 count(DISTINCT customer_id) AS customers, count(DISTINCT product_id) AS products,
                 (SELECT count(DISTINCT label) FROM embeddings) AS clusters,
                 sum(net_sales_usd) / count(DISTINCT order_id) AS average_order_value FROM t"""
        ),
        {"total_revenue": 2, "average_order_value": 2},
    ),
]
