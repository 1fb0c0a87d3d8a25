"""Filtered queries behind the sales and overview pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.functions.columns import change_from
from cohortlens.operators.profiling import top_products
from cohortlens.operators.sales import weekday_name


def filter_date_range(df: DataFrame, start, end, date_column: str = "order_date") -> DataFrame:
    """Rows whose date lies in the closed range; pushed down to the scan."""
    return df.filter(
        F.col(date_column).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )


def monthly_from_daily(daily: DataFrame) -> DataFrame:
    """(month as yyyy-MM, total_sales) in month order."""
    return (
        daily.groupBy(F.date_format("order_date", "yyyy-MM").alias("month"))
        .agg(F.sum("total_sales").alias("total_sales"))
        .orderBy("month")
    )


def range_kpis(daily: DataFrame) -> DataFrame:
    """One row: revenue, sum of daily distinct orders, their ratio, last change."""
    before = F.lag("total_sales").over(W.orderBy("month"))
    growth = (
        monthly_from_daily(daily)
        .select("month", change_from(F.col("total_sales"), before).alias("change"))
        .agg(F.max_by("change", "month"))
    )
    totals = daily.agg(
        F.coalesce(F.sum("total_sales"), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(F.sum("order_count"), F.lit(0)).alias("total_orders"),
    )
    return totals.select(
        "*",
        F.coalesce(F.try_divide("total_revenue", "total_orders"), F.lit(0.0)).alias(
            "average_order_value"
        ),
        growth.scalar().alias("latest_month_over_month"),
    )


def weekday_from_daily(daily: DataFrame) -> DataFrame:
    """Mean over all calendar days, gap zeros included, Monday to Sunday."""
    return (
        daily.groupBy(F.weekday("order_date").alias("weekday_number"))
        .agg(F.avg("total_sales").alias("total_sales"))
        .select(
            "weekday_number", weekday_name(F.col("weekday_number")).alias("weekday"), "total_sales"
        )
        .orderBy("weekday_number")
    )


def list_categories(df: DataFrame, column: str = "product_category") -> DataFrame:
    return (
        df.select(F.col(column).cast("string").alias("category"))
        .filter("category is not null")
        .distinct()
        .orderBy("category")
    )


def top_products_filtered(
    df: DataFrame, start, end, category: str = "All", n: int = 10
) -> DataFrame:
    rows = filter_date_range(df, start, end)
    if category != "All":
        rows = rows.filter(F.col("product_category").cast("string") == category)
    return top_products(rows, n)


def gap_days_in_range(daily: DataFrame) -> DataFrame:
    return daily.filter("is_gap_day").select("order_date", "is_gap_day", "gap_filled_sales")


def executive_overview(
    kpis: DataFrame, customer_features: DataFrame, df: DataFrame, clusters: DataFrame
) -> DataFrame:
    """One row: revenue, orders, customers, products, clusters, revenue per order.

    The one-row parts are scalar subqueries of the KPI row, not joins.
    """
    return kpis.select(
        "total_revenue",
        "total_orders",
        customer_features.agg(F.count(F.lit(1))).scalar().alias("customers"),
        df.select("product_id").agg(F.countDistinct("product_id")).scalar().alias("products"),
        clusters.select("cluster").agg(F.countDistinct("cluster")).scalar().alias("clusters"),
        "average_order_value",
    )
