"""Daily sales features: one row per calendar day."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.operators.sales import calendar

FEATURE_COLUMNS = (
    "order_date",
    "year",
    "month",
    "day_of_week",
    "is_weekend",
    "quarter",
    "day_index",
    "month_sin",
    "month_cos",
    "day_of_week_sin",
    "day_of_week_cos",
    "total_sales",
    "order_count",
    "average_order_value",
    "is_gap_day",
    "gap_filled_sales",
)


def daily_sales(df: DataFrame) -> DataFrame:
    """Revenue, distinct orders and the mean over lines, per observed day."""
    # (day, order) first: the distinct count then needs no row expansion
    per_order = df.groupBy("order_date", "order_id").agg(
        F.sum("net_sales_usd").alias("sales"), F.count("net_sales_usd").alias("lines")
    )
    return (
        per_order.filter("order_date is not null")
        .groupBy("order_date")
        .agg(
            F.sum("sales").alias("total_sales"),
            F.count("order_id").alias("order_count"),
            F.try_divide(F.sum("sales"), F.sum("lines")).alias("average_order_value"),
        )
    )


def fill_calendar(daily: DataFrame) -> DataFrame:
    """Every day between first and last; unobserved days are zero and flagged."""
    observed = daily.withColumn("_observed", F.lit(True))
    return (
        calendar(daily, "order_date")
        .join(observed, "order_date", "left")
        .select(
            "order_date",
            F.coalesce("total_sales", F.lit(0.0)).alias("total_sales"),
            F.coalesce("order_count", F.lit(0)).alias("order_count"),
            F.coalesce("average_order_value", F.lit(0.0)).alias("average_order_value"),
            F.col("_observed").isNull().alias("is_gap_day"),
        )
    )


def interpolate_gaps(daily: DataFrame) -> DataFrame:
    """Adds ``gap_filled_sales``: linear between the neighbouring observed days.

    A trailing gap repeats the last observed value; a leading gap stays null.
    The windows run over one row per calendar day.
    """
    order = W.orderBy("order_date")
    upto = order.rowsBetween(W.unboundedPreceding, 0)
    onward = order.rowsBetween(0, W.unboundedFollowing)
    seen = F.when(~F.col("is_gap_day"), F.struct("_row", "total_sales"))
    marked = (
        daily.withColumn("_row", F.row_number().over(order))
        .withColumn("_before", F.last(seen, ignorenulls=True).over(upto))
        .withColumn("_after", F.first(seen, ignorenulls=True).over(onward))
    )
    share = F.try_divide(
        F.col("_row") - F.col("_before._row"), F.col("_after._row") - F.col("_before._row")
    )
    rise = F.col("_after.total_sales") - F.col("_before.total_sales")
    filled = (
        F.when(~F.col("is_gap_day"), F.col("total_sales"))
        .when(F.col("_after").isNull(), F.col("_before.total_sales"))
        .otherwise(F.col("_before.total_sales") + rise * share)
    )
    return marked.withColumn("gap_filled_sales", filled).drop("_row", "_before", "_after")


def calendar_features(df: DataFrame, date_column: str = "order_date") -> DataFrame:
    """Adds year, month, weekday (Monday = 0), weekend, quarter and day index."""
    day = F.col(date_column)
    first = df.agg(F.min(date_column)).scalar()
    return df.select(
        "*",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.weekday(day).alias("day_of_week"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        F.quarter(day).alias("quarter"),
        F.datediff(day, first).alias("day_index"),
    )


def cyclical_encoding(df: DataFrame) -> DataFrame:
    """Adds sine and cosine of month and weekday."""
    month = F.col("month") * F.lit(2 * math.pi) / 12
    weekday = F.col("day_of_week") * F.lit(2 * math.pi) / 7
    return df.select(
        "*",
        F.sin(month).alias("month_sin"),
        F.cos(month).alias("month_cos"),
        F.sin(weekday).alias("day_of_week_sin"),
        F.cos(weekday).alias("day_of_week_cos"),
    )


def sales_features(df: DataFrame) -> DataFrame:
    """The sixteen daily columns, in date order.

    Calendar columns are added to the daily rows in place, so the join of the
    two halves on the date is not needed.
    """
    daily = interpolate_gaps(fill_calendar(daily_sales(df)))
    return cyclical_encoding(calendar_features(daily)).select(*FEATURE_COLUMNS).orderBy("order_date")


def feature_report(customer_features: DataFrame, sales_features: DataFrame) -> DataFrame:
    """One row: sizes of both feature tables and the number of gap days."""
    return sales_features.agg(
        F.count(F.lit(1)).alias("sales_rows"),
        F.count_if("is_gap_day").alias("zero_transaction_days"),
    ).select(
        customer_features.agg(F.count(F.lit(1))).scalar().alias("customer_rows"),
        F.lit(len(customer_features.columns)).cast("bigint").alias("customer_columns"),
        "sales_rows",
        F.lit(len(sales_features.columns)).cast("bigint").alias("sales_columns"),
        "zero_transaction_days",
    )
