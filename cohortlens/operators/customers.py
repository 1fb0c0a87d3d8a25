"""Customer features: one row per customer from one pass over the lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.session import cut_lineage

FEATURE_COLUMNS = (
    "customer_id",
    "recency_days",
    "frequency",
    "monetary_value",
    "avg_order_value",
    "order_value_std",
    "product_diversity",
    "purchase_velocity",
    "preferred_category",
    "preferred_payment_method",
    "return_rate",
    "coupon_usage_rate",
)


def reference_day(df: DataFrame, reference_date=None) -> Column:
    """The configured date, or the latest order date as a scalar subquery."""
    if reference_date is not None:
        return F.lit(reference_date).cast("date")
    return df.agg(F.max("order_date")).scalar()


def _order_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("customer_id", "order_id").agg(
        F.sum("net_sales_usd").alias("order_value"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
    )


def rfm_base(df: DataFrame) -> DataFrame:
    """First and last date, distinct orders, revenue, distinct products."""
    sets = [["customer_id", "order_id"], ["customer_id", "product_id"]]
    grouped = df.groupingSets(sets, "customer_id", "order_id", "product_id").agg(
        F.grouping("order_id").alias("no_order"),
        F.sum("net_sales_usd").alias("value"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
    )
    of_order = F.col("no_order") == 0
    return grouped.groupBy("customer_id").agg(
        F.min("first_date").alias("first_order_date"),
        F.max("last_date").alias("last_order_date"),
        F.count_if(of_order & F.col("order_id").isNotNull()).alias("frequency"),
        F.sum(F.when(of_order, F.col("value"))).alias("monetary_value"),
        F.count_if(~of_order & F.col("product_id").isNotNull()).alias("product_diversity"),
    )


def _value_std(order_value: Column) -> Column:
    # customers without an id are not compared with each other
    return F.when(F.col("customer_id").isNull(), F.lit(0.0)).otherwise(
        F.coalesce(F.stddev_samp(order_value), F.lit(0.0))
    )


def order_value_std(df: DataFrame) -> DataFrame:
    """Sample standard deviation of order totals; a single order gives 0."""
    return (
        _order_totals(df)
        .groupBy("customer_id")
        .agg(_value_std(F.col("order_value")).alias("order_value_std"))
    )


def recency_days(df: DataFrame, reference_date=None) -> DataFrame:
    last = df.groupBy("customer_id").agg(F.max("order_date").alias("last_order_date"))
    return last.select(
        "customer_id",
        F.datediff(reference_day(df, reference_date), F.col("last_order_date"))
        .cast("bigint")
        .alias("recency_days"),
    )


def avg_order_value(base: DataFrame) -> DataFrame:
    """Adds revenue per distinct order to ``rfm_base`` rows."""
    return base.withColumn("avg_order_value", F.try_divide("monetary_value", "frequency"))


def _velocity(reference: Column) -> Column:
    tenure = F.greatest(F.datediff(reference, F.col("first_order_date")), F.lit(1))
    return F.col("frequency") / tenure


def purchase_velocity(base: DataFrame, reference: Column) -> DataFrame:
    """Adds orders per day since the first order to ``rfm_base`` rows."""
    return base.withColumn("purchase_velocity", _velocity(reference))


def _mode_rank(value: Column, n: Column) -> Column:
    """Smaller is better: higher count first, then the text of the value."""
    return F.struct(
        (-n).alias("minus_n"),
        F.coalesce(value.cast("string"), F.lit("nan")).alias("text"),
        value.alias("value"),
    )


def alphabetical_mode(df: DataFrame, key: str, column: str) -> DataFrame:
    """Most frequent value per key, nulls included; ties go to the smaller text.

    Counting and the minimum both combine map-side; no group is collected.
    """
    counts = df.groupBy(key, column).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(key).agg(
        F.min(_mode_rank(F.col(column), F.col("n")))["value"].alias(column)
    )


def preferred(df: DataFrame, column: str, name: str) -> DataFrame:
    return alphabetical_mode(df, "customer_id", column).withColumnRenamed(column, name)


def return_rate(df: DataFrame) -> DataFrame:
    """Share of returned lines; a line without a status counts as not returned."""
    return df.groupBy("customer_id").agg(
        F.avg(F.coalesce(F.col("return_status") == "Returned", F.lit(False)).cast("double")).alias(
            "return_rate"
        )
    )


def coupon_usage_rate(df: DataFrame) -> DataFrame:
    return df.groupBy("customer_id").agg(
        F.avg(F.col("coupon_used").cast("double")).alias("coupon_usage_rate")
    )


#: Lines of a customer that one task takes whole.
LARGE_CUSTOMER = 100_000


def large_customers(df: DataFrame, lines: int = LARGE_CUSTOMER) -> DataFrame:
    """(customer_id) of customers with more than ``lines`` lines; few, as each has so many."""
    counted = df.groupBy("customer_id").agg(F.count(F.lit(1)).alias("lines"))
    return cut_lineage(counted.filter(F.col("lines") > lines).select("customer_id"))


def customer_features(
    df: DataFrame, reference_date=None, large: DataFrame | None = None
) -> DataFrame:
    """All twelve feature columns per customer.

    Without ``large`` every customer is aggregated in parts. With it (``large_customers``)
    only those are: each line of the others is shuffled once, to its customer.
    """
    reference = reference_day(df, reference_date)
    if large is None:
        return _features(_measured(df), reference)
    same = df["customer_id"].eqNullSafe(large["customer_id"])
    others = df.join(F.broadcast(large), same, "left_anti")
    in_parts = df.join(F.broadcast(large), same, "left_semi")
    whole = _measured(others).repartition("customer_id")
    return _features(whole, reference).unionByName(_features(_measured(in_parts), reference))


_KEYS = ("order_id", "product_id", "product_category", "payment_method")


def _measured(df: DataFrame) -> DataFrame:
    """What the features need of each line."""
    returned = (F.col("return_status") == "Returned").alias("returned")
    return df.select(
        "customer_id", *_KEYS, "net_sales_usd", "order_date", returned, "coupon_used"
    )


def _features(df: DataFrame, reference: Column) -> DataFrame:
    """The columns of ``customer_features`` from ``_measured`` lines.

    Lines are aggregated per (customer, order), (customer, product), (customer,
    category) and (customer, payment method) in a single scan and shuffle, where
    measures go along with the order only; a second, combining group-by folds those
    into one row per customer. There is no join, and neither a customer holding a large share of
    the lines nor a large order ends up as raw rows in one task.
    """
    kinds = {c: kind for c, kind in df.dtypes if c != "customer_id"}
    measures = {c: F.col(c) for c in kinds if c not in _KEYS}

    def entry(key: str) -> Column:
        """A line under one of its keys; its measures count under the order only."""
        own = {key: F.col(key), **(measures if key == "order_id" else {})}
        return F.struct(
            F.lit(key).alias("of"),
            *(own.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()),
        )

    grouped = (
        df.select("customer_id", F.inline(F.array(*map(entry, _KEYS))))
        .groupBy("customer_id", "of", *_KEYS)
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("net_sales_usd").alias("value"),
            F.min("order_date").alias("first_date"),
            F.max("order_date").alias("last_date"),
            F.count_if("returned").alias("returned"),
            F.count_if("coupon_used").alias("with_coupon"),
            F.count("coupon_used").alias("coupon_known"),
        )
    )

    def of(key: str, value: Column) -> Column:
        return F.when(F.col("of") == key, value)

    folded = grouped.groupBy("customer_id").agg(
        F.min("first_date").alias("first_order_date"),
        F.max("last_date").alias("last_order_date"),
        F.count(of("order_id", F.col("order_id"))).alias("frequency"),
        F.sum(of("order_id", F.col("value"))).alias("monetary_value"),
        _value_std(of("order_id", F.col("value"))).alias("order_value_std"),
        F.count(of("product_id", F.col("product_id"))).alias("product_diversity"),
        F.min(of("product_category", _mode_rank(F.col("product_category"), F.col("lines"))))[
            "value"
        ].alias("preferred_category"),
        F.min(of("payment_method", _mode_rank(F.col("payment_method"), F.col("lines"))))[
            "value"
        ].alias("preferred_payment_method"),
        F.sum(of("order_id", F.col("lines"))).alias("lines"),
        F.sum(of("order_id", F.col("returned"))).alias("returned"),
        F.sum(of("order_id", F.col("with_coupon"))).alias("with_coupon"),
        F.sum(of("order_id", F.col("coupon_known"))).alias("coupon_known"),
    )
    return folded.select(
        "customer_id",
        F.datediff(reference, F.col("last_order_date")).cast("bigint").alias("recency_days"),
        "frequency",
        "monetary_value",
        F.try_divide("monetary_value", "frequency").alias("avg_order_value"),
        "order_value_std",
        "product_diversity",
        _velocity(reference).alias("purchase_velocity"),
        "preferred_category",
        "preferred_payment_method",
        F.try_divide("returned", "lines").alias("return_rate"),
        F.try_divide("with_coupon", "coupon_known").alias("coupon_usage_rate"),
    )
