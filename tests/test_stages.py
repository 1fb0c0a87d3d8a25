"""A run of all stages makes its source once and shuffles little; results stay as they were."""

import datetime as dt

from pyspark.sql import functions as F

from cohortlens.operators import cleaning, customers, profiling, sales, validation
from cohortlens.plans.stages import Options, run_stages
from cohortlens.session import cut_lineage
from cohortlens.sources.contract import CONTRACT


def _lines(spark):
    """Lines with ids that are null or shared between customers and days, some of them twice."""
    rows = [
        (
            None if i % 17 == 0 else f"o{i // 3}", None if i % 13 == 0 else f"c{i % 7}", f"p{i % 11}",
            f"name {i % 11}", f"k{i % 4}", f"m{i % 3}", None if i % 19 == 0 else float(i % 23),
            None if i % 29 == 0 else dt.date(2024, 1 + i % 3, 1 + i % 27), "Returned" if i % 5 == 0 else "No Return",
            None if i % 31 == 0 else i % 2 == 0, i % 6, "x" if i % 4 else None,
        )
        for i in range(200)
    ]
    return spark.createDataFrame(
        rows + rows[:15],
        "order_id string, customer_id string, product_id string, product_name string, product_category string,"
        " payment_method string, net_sales_usd double, order_date date, return_status string, coupon_used boolean,"
        " quantity long, coupon_code string",
    )


def _sorted(df):
    plain = [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()]
    return sorted(plain, key=repr)


def test_a_run_makes_its_source_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def made_one(value):
        made.add(1)
        return value

    df = _lines(spark).filter("order_id is not null").coalesce(2)
    df = df.withColumn("order_id", F.udf(made_one, "string")("order_id"))
    contract = CONTRACT.restricted_to(df.columns)
    options = Options(contract=contract, allowed_categories={}, allow_duplicate_rows=True)
    result = run_stages(df, str(tmp_path), options)
    # null customers do not pass the gate, after all rules and the failing cells were read
    assert (result.status, result.failed_stage) == ("failed", "prepare")
    assert "schema customer_id" in result.error
    assert made.value == _lines(spark).filter("order_id is not null").count()
    assert not (tmp_path / "received").exists() and not (tmp_path / "validated").exists()


def test_rows_that_occur_once_are_not_shuffled(spark, monkeypatch):
    df = _lines(spark)
    want = _sorted(df.dropDuplicates())
    assert _sorted(cleaning.drop_exact_duplicates(df)) == want
    distinct = cut_lineage(df.dropDuplicates())
    assert "Exchange" not in cleaning.drop_exact_duplicates(distinct)._jdf.queryExecution().toString()
    monkeypatch.setattr(cleaning, "SENT_HASHES", 3)
    assert _sorted(cleaning.drop_exact_duplicates(df)) == want
    again = cut_lineage(validation.repeated_hashes(df))
    assert again.count() == 15
    assert validation.check_duplicates(df, again).first()[0] == 15


def test_customers_that_come_whole_have_the_same_features(spark):
    df = cut_lineage(_lines(spark))
    want = _sorted(customers.customer_features(df))
    for lines in (0, 20, 28, 1000):
        large = customers.large_customers(df, lines)
        assert _sorted(customers.customer_features(df, None, large)) == want
    assert customers.large_customers(df, 20).count() < 8


def test_distinct_orders_serve_all_that_counts_them(spark):
    df = cut_lineage(_lines(spark))
    orders = sales.distinct_orders(df).persist()
    orders.count()
    try:
        for with_orders, without in (
            (sales.sales_kpis(df, orders), sales.sales_kpis(df)),
            (sales.monthly_trend(df, orders), sales.monthly_trend(df)),
            (profiling.repeat_purchase_rate(orders), profiling.repeat_purchase_rate(df)),
            (profiling.dataset_overview(df, "2024-02-02", orders=orders), profiling.dataset_overview(df, "2024-02-02")),
        ):
            assert _sorted(with_orders) == _sorted(without)
        # an order's rows are in one task already
        plan = orders.select("order_id").distinct()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan.split("InMemoryTableScan")[0]
    finally:
        orders.unpersist()


def test_categories_are_counted_in_one_shuffle(spark):
    df = cut_lineage(_lines(spark))
    found = profiling.categorical_profile(df, 3)
    rows = {(r["column"], r["rank"]): r for r in found.collect()}
    assert rows["product_id", 1]["cardinality"] == 11
    assert rows["coupon_code", 1]["value"] == "x" and rows["coupon_code", 1]["cardinality"] == 2
    assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()
