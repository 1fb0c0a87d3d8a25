"""Descriptive sales over time.

Rows are reduced to one per day or period before any window runs, so the
windows without a partition only ever see a calendar, never transactions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.functions.columns import change_from

# Weekday names in the order of ``weekday()``, Monday = 0.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def weekday_name(day: Column) -> Column:
    """English weekday name for a 0-based weekday number (Monday = 0)."""
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), day + 1)


def calendar(dates: DataFrame, date_column: str, step: str = "1 day") -> DataFrame:
    """Every period start from the first to the last value of ``date_column``."""
    span = dates.agg(F.min(date_column).alias("lo"), F.max(date_column).alias("hi"))
    return span.filter("lo is not null").select(
        F.explode(F.expr(f"sequence(lo, hi, interval {step})")).alias(date_column)
    )


def zero_transaction_days(df: DataFrame, date_column: str = "order_date") -> DataFrame:
    """Calendar dates between the first and last date that have no row."""
    observed = df.select(date_column).filter(F.col(date_column).isNotNull()).distinct()
    return calendar(observed, date_column).join(observed, date_column, "left_anti")


def zero_day_pattern(gaps: DataFrame, date_column: str = "order_date") -> DataFrame:
    """One row describing how the gap days lie in week and month."""
    day = F.col(date_column)
    to_month_end = F.datediff(F.last_day(day), day)
    ordered = W.orderBy(date_column)
    described = gaps.select(
        day.alias("day"),
        F.dayofmonth(day).alias("dom"),
        weekday_name(F.weekday(day)).alias("dow"),
        to_month_end.alias("to_end"),
        F.datediff(day, F.lag(day).over(ordered)).alias("spacing"),
    )
    return described.agg(
        F.count("day").alias("gap_count"),
        F.array_sort(F.collect_set("dow")).alias("day_of_week"),
        F.array_sort(F.collect_set("dom")).alias("day_of_month"),
        F.array_sort(F.collect_set("to_end")).alias("days_from_month_end"),
        F.coalesce(F.bool_and(F.col("to_end") <= 2), F.lit(True)).alias(
            "all_within_final_three_days_of_month"
        ),
        F.transform(
            F.array_sort(
                F.collect_list(F.when(F.col("spacing").isNotNull(), F.struct("day", "spacing")))
            ),
            lambda s: s["spacing"],
        ).alias("spacing_days"),
        (F.countDistinct("spacing") <= 1).alias("spacing_is_even"),
    )


def distinct_orders(df: DataFrame) -> DataFrame:
    """Distinct (order_id, customer_id, order_date), an order's in one task.

    Whatever is grouped by order and more needs no shuffle if this frame is kept.
    """
    columns = df.select("order_id", "customer_id", "order_date")
    return columns.repartition("order_id").distinct()


def monthly_trend(df: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Revenue, distinct orders and change versus the previous observed month.

    ``orders`` may bring the ``distinct_orders`` of ``df``.
    """
    month = F.trunc("order_date", "month").alias("month")
    if orders is None:
        # (month, order) first: the distinct count then needs no row expansion
        per_order = (
            df.select(month, "order_id", "net_sales_usd")
            .groupBy("month", "order_id")
            .agg(F.sum("net_sales_usd").alias("sales"))
        )
        monthly = per_order.groupBy("month").agg(
            F.sum("sales").alias("total_sales"), F.count("order_id").alias("order_count")
        )
    else:
        counted = orders.select(month, "order_id").distinct().groupBy("month")
        sums = df.groupBy(month).agg(F.sum("net_sales_usd").alias("total_sales"))
        monthly = sums.join(counted.agg(F.count("order_id").alias("order_count")), "month")
    before = F.lag("total_sales").over(W.orderBy("month"))
    return (
        monthly.filter("month is not null")
        .withColumn("month_over_month_change", change_from(F.col("total_sales"), before))
        .orderBy("month")
    )


def sales_kpis(df: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """One row: revenue, distinct orders, revenue per order, latest monthly growth.

    ``orders`` may bring the ``distinct_orders`` of ``df``.
    """
    if orders is None:
        per_order = df.groupBy("order_id").agg(F.sum("net_sales_usd").alias("sales"))
        totals = per_order.agg(
            F.sum("sales").alias("total_revenue"), F.count("order_id").alias("total_orders")
        )
    else:
        counted = orders.agg(F.countDistinct("order_id")).scalar()
        totals = df.agg(F.sum("net_sales_usd").alias("total_revenue")).select(
            "total_revenue", counted.alias("total_orders")
        )
    growth = (
        df.groupBy(F.trunc("order_date", "month").alias("month"))
        .agg(F.sum("net_sales_usd").alias("total_sales"))
        .filter("month is not null")
        .select(
            "month",
            change_from(
                F.col("total_sales"), F.lag("total_sales").over(W.orderBy("month"))
            ).alias("change"),
        )
        .agg(F.max_by("change", "month").alias("change"))
    )
    return totals.select(
        "total_revenue",
        "total_orders",
        F.coalesce(F.try_divide("total_revenue", "total_orders"), F.lit(0.0)).alias(
            "average_order_value"
        ),
        F.coalesce(growth.scalar(), F.lit(0.0)).alias("period_over_period_growth_rate"),
    )


def weekday_pattern(df: DataFrame) -> DataFrame:
    """Mean daily revenue over observed days, Monday to Sunday, 0 if none."""
    daily = df.groupBy("order_date").agg(F.sum("net_sales_usd").alias("sales"))
    means = daily.groupBy(F.weekday("order_date").alias("weekday_number")).agg(
        F.avg("sales").alias("sales")
    )
    week = df.sparkSession.range(7).select(F.col("id").cast("int").alias("weekday_number"))
    return (
        means.join(week, "weekday_number", "right")
        .select(
            "weekday_number",
            weekday_name(F.col("weekday_number")).alias("weekday"),
            F.coalesce("sales", F.lit(0.0)).alias("average_daily_sales"),
        )
        .orderBy("weekday_number")
    )


_PERIODS = {
    "daily": (lambda day: day, "1 day"),
    # a week is labelled by the Sunday that ends it
    "weekly": (lambda day: F.date_add(F.date_trunc("week", day).cast("date"), 6), "7 days"),
    "monthly": (lambda day: F.trunc(day, "month"), "1 month"),
}


def resample_sales(df: DataFrame, period: str, rolling_window: int = 7) -> DataFrame:
    """(period_start, sales, orders, rolling_mean, period_over_period_change).

    ``orders`` counts rows with a sales value. Periods without rows appear with
    zero; the rolling mean looks back over ``rolling_window`` periods.
    """
    if rolling_window <= 0:
        raise ValueError("rolling_window must be positive")
    bucket, step = _PERIODS[period]
    observed = (
        df.filter("order_date is not null")
        .groupBy(bucket(F.col("order_date")).alias("period_start"))
        .agg(F.sum("net_sales_usd").alias("sales"), F.count("net_sales_usd").alias("orders"))
    )
    full = calendar(observed, "period_start", step).join(observed, "period_start", "left")
    full = full.select(
        "period_start",
        F.coalesce("sales", F.lit(0.0)).alias("sales"),
        F.coalesce("orders", F.lit(0)).alias("orders"),
    )
    ordered = W.orderBy("period_start")
    return full.select(
        "*",
        F.avg("sales")
        .over(ordered.rowsBetween(1 - rolling_window, 0))
        .alias("rolling_mean"),
        change_from(F.col("sales"), F.lag("sales").over(ordered)).alias(
            "period_over_period_change"
        ),
    ).orderBy("period_start")
