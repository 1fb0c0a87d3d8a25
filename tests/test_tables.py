"""Small frames with nulls, NaN, ties, gaps and bad cells."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from cohortlens.functions.quantiles import exact_quantiles
from cohortlens.operators import (
    cleaning,
    customers,
    daily,
    profiling,
    sales,
    scaling,
    splits,
    validation,
)
from cohortlens.sources.contract import (
    COLUMNS,
    CONTRACT,
    FLAG,
    FLOAT,
    INTEGER,
    TEXT,
    Contract,
)
from cohortlens.sources.records import csv_records
from cohortlens.sources.tables import CSV_FORMAT, read_date_range, write_by_month, write_table
from cohortlens.sources.transactions import (
    CoercionError,
    read_cells,
    read_transactions,
    read_transactions_strict,
)

LINES = (
    "customer_id string, order_id string, order_date date, product_id string, "
    "product_category string, payment_method string, net_sales_usd double, "
    "return_status string, coupon_used boolean"
)


def day(text):
    return dt.date.fromisoformat(text)


@pytest.fixture(scope="module")
def lines(spark):
    rows = [
        ("c1", "o1", day("2024-01-01"), "p1", "B", "card", 10.0, "Returned", True),
        ("c1", "o1", day("2024-01-01"), "p2", "A", "card", 20.0, None, False),
        ("c1", "o2", day("2024-01-11"), "p1", "A", "cash", 50.0, "No Return", False),
        ("c1", "o2", day("2024-01-11"), "p3", "B", "cash", 0.0, "No Return", False),
        ("c2", "o3", day("2024-01-04"), "p1", None, "card", 5.0, "No Return", True),
        ("c2", "o3", day("2024-01-04"), "p1", None, "card", 5.0, "No Return", True),
        ("c2", "o3", day("2024-01-04"), "p1", "Z", "card", 5.0, "No Return", True),
        (None, "o4", day("2024-01-04"), "p1", "A", "card", 7.0, "No Return", False),
        (None, "o5", day("2024-01-05"), "p1", "A", "card", 9.0, "No Return", False),
    ]
    return spark.createDataFrame(rows, LINES)


def test_contract_has_fifty_columns():
    assert len(COLUMNS) == 50 and len(CONTRACT.columns) == 50


def test_customer_features(lines):
    rows = {r["customer_id"]: r for r in customers.customer_features(lines).collect()}
    c1 = rows["c1"]
    assert (c1["frequency"], c1["product_diversity"], c1["recency_days"]) == (2, 3, 0)
    assert c1["monetary_value"] == 80.0 and c1["avg_order_value"] == 40.0
    assert c1["order_value_std"] == pytest.approx(math.sqrt(200.0))
    assert c1["purchase_velocity"] == pytest.approx(0.2)
    # ties go to the smaller text; a null status is not a return
    assert (c1["preferred_category"], c1["preferred_payment_method"]) == ("A", "card")
    assert c1["return_rate"] == 0.25 and c1["coupon_usage_rate"] == 0.25
    # a single order has no spread; null is a value and may be the mode
    assert rows["c2"]["order_value_std"] == 0.0 and rows["c2"]["preferred_category"] is None
    # the customer without an id stays, without a spread
    assert rows[None]["frequency"] == 2 and rows[None]["order_value_std"] == 0.0


def test_single_operators_agree_with_the_fused_table(lines):
    fused = {r["customer_id"]: r for r in customers.customer_features(lines).collect()}
    base = customers.rfm_base(lines)
    reference = customers.reference_day(lines)
    for df, column in (
        (customers.order_value_std(lines), "order_value_std"),
        (customers.recency_days(lines), "recency_days"),
        (customers.avg_order_value(base), "avg_order_value"),
        (customers.purchase_velocity(base, reference), "purchase_velocity"),
        (customers.return_rate(lines), "return_rate"),
        (customers.preferred(lines, "product_category", "preferred_category"), "preferred_category"),
    ):
        for row in df.collect():
            assert row[column] == fused[row["customer_id"]][column], column


def test_gaps_and_interpolation(lines):
    rows = daily.sales_features(lines).collect()
    assert [r["order_date"].day for r in rows] == list(range(1, 12))
    by_day = {r["order_date"].day: r for r in rows}
    assert by_day[2]["is_gap_day"] and by_day[2]["total_sales"] == 0.0
    assert by_day[2]["gap_filled_sales"] == pytest.approx(30 + (22 - 30) / 3)
    assert by_day[6]["gap_filled_sales"] == pytest.approx(9 + 41 / 6)
    assert by_day[1]["average_order_value"] == 15.0 and by_day[1]["order_count"] == 1
    assert len(rows[0]) == 16


def test_trailing_and_leading_gap(spark):
    df = spark.createDataFrame(
        [
            (day("2024-01-01"), 0.0, True),
            (day("2024-01-02"), 4.0, False),
            (day("2024-01-03"), 0.0, True),
        ],
        "order_date date, total_sales double, is_gap_day boolean",
    )
    filled = [r["gap_filled_sales"] for r in daily.interpolate_gaps(df).orderBy("order_date").collect()]
    assert filled == [None, 4.0, 4.0]


def test_resample_keeps_empty_periods_and_null_change_after_zero(spark):
    df = spark.createDataFrame(
        [(day("2024-01-01"), 2.0), (day("2024-01-22"), 6.0)], "order_date date, net_sales_usd double"
    )
    weekly = sales.resample_sales(df, "weekly", 2).collect()
    assert [r["period_start"] for r in weekly] == [
        day("2024-01-07"), day("2024-01-14"), day("2024-01-21"), day("2024-01-28"),
    ]
    assert [r["sales"] for r in weekly] == [2.0, 0.0, 0.0, 6.0]
    assert [r["period_over_period_change"] for r in weekly] == [None, -1.0, None, None]
    assert [r["rolling_mean"] for r in weekly] == [2.0, 1.0, 0.0, 3.0]


def test_gap_pattern_at_month_end(spark):
    # three days that end a month
    dates = ["03-29", "03-30", "03-31"]
    gaps = spark.createDataFrame([(day(f"2024-{d}"),) for d in dates], "order_date date")
    row = sales.zero_day_pattern(gaps).first()
    assert row["gap_count"] == 3 and row["days_from_month_end"] == [0, 1, 2]
    assert row["all_within_final_three_days_of_month"] and row["spacing_is_even"]
    assert row["spacing_days"] == [1, 1] and row["day_of_week"] == ["Friday", "Saturday", "Sunday"]


def test_validation_gate_collects_everything(spark):
    df = spark.createDataFrame(
        [(1, 5.0, "x"), (1, 5.0, "x"), (-1, float("nan"), "y")], "quantity long, discount_percentage double, extra string"
    )
    contract = Contract(
        {"quantity": INTEGER, "discount_percentage": FLOAT},
        greater_than={"quantity": 0},
        within={"discount_percentage": (0, 100)},
    )
    with pytest.raises(validation.DataValidationError) as error:
        validation.validate(df, contract=contract, allowed_categories={"extra": ["x"]})
    codes = {(i["code"], i["column"]) for i in error.value.issues}
    assert codes == {
        ("unexpected_columns", "extra"),
        ("schema", "quantity"),
        ("schema", "discount_percentage"),
        ("duplicate_rows", None),
        ("null_rate", "discount_percentage"),
        ("category", "extra"),
    }


def test_null_rate_limit_is_strict(spark):
    df = spark.createDataFrame([(None,), (1,), (2,), (3,), (4,)], "a int")
    assert validation.check_null_rate(df, 0.20).count() == 0
    assert validation.check_null_rate(df, 0.19).count() == 1


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 1.0), (2, float("nan")), (2, float("nan"))], "a int, b double")
    assert validation.check_duplicates(df).first()[0] == 2
    assert cleaning.drop_exact_duplicates(df).count() == 2


def test_csv_loses_nothing(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "one.csv").write_text(
        'text,n\n"say ""hi"", ok",1\n"two\nlines",2\nx,3,extra\nshort\n" kept ",4\nNA,5\n'
    )
    contract = Contract({"text": TEXT, "n": INTEGER})
    typed, rejects = read_transactions(spark, str(folder), contract, multi_line=True)
    assert sorted(map(tuple, typed.collect()), key=lambda r: r[1]) == [
        ('say "hi", ok', 1), ("two\nlines", 2), (" kept ", 4), (None, 5),
    ]
    assert sorted(r["value"] for r in rejects.collect()) == ["short", "x,3,extra"]
    assert {r["reason"] for r in rejects.collect()} == {"wrong number of cells"}
    with pytest.raises(CoercionError, match="wrong number of cells"):
        read_transactions_strict(spark, str(folder), contract, multi_line=True)
    back = str(tmp_path / "back")
    write_table(typed, back, "csv")
    again, none = read_transactions(spark, back, contract, multi_line=True)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, typed.collect()), key=str)
    assert none.count() == 0


def _one_task(spark, path, names):
    """The cells as one task reads them from the whole file."""
    schema = ", ".join(f"`{c}` string" for c in names)
    df = spark.read.options(**CSV_FORMAT).schema(schema).option("header", True)
    return df.option("multiLine", True).csv(path)


def test_csv_records_in_byte_ranges(spark, tmp_path, monkeypatch):
    """Records meet across the ends of byte ranges, in every way a range can start."""
    rng = random.Random(4)
    pieces = ["a", "bb ", "\n", ",", '"', '""', "\n\n", "long text of a cell", "\r\n", ',"', '",', " "]
    for number, end in enumerate(("\n", "\r\n")):
        path = tmp_path / f"{number}.csv"
        with open(path, "w", newline="") as out:
            out.write("id,text,more" + end)
            for i in range(400):
                cells = ["".join(rng.choices(pieces, k=rng.randint(0, 5))) for _ in range(2)]
                if end == "\n":
                    cells = [c.replace("\r\n", "") for c in cells]
                else:
                    cells = [c.replace("\r\n", "\n").replace("\n", end) for c in cells]
                quoted = ['"' + c.replace('"', '""') + '"' for c in cells]
                if i % 9 == 0:
                    quoted[1] = 'six 6" inch'
                out.write(",".join([str(i), *quoted]) + end)
    size = 200
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        records = csv_records(spark, str(tmp_path))
        cells, malformed = read_cells(spark, str(tmp_path), multi_line=True, missing_cells=("",))
        got = sorted(map(str, cells.collect()))
        assert records.filter("not closed").isEmpty() and malformed.isEmpty()
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 50
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    expected = _one_task(spark, str(tmp_path), ["id", "text", "more"]).fillna("").collect()
    assert got == sorted(str(type(r)(**{k: v or None for k, v in r.asDict().items()})) for r in expected)
    assert len(got) == 800


def test_csv_quote_that_never_closes(spark, tmp_path):
    path = tmp_path / "open.csv"
    path.write_text('n,text\n1,a\n\n2,"b\nc"\n3,"d\n4,e\n5,f\n')
    cells, malformed = read_cells(spark, str(path), multi_line=True)
    assert sorted(map(tuple, cells.collect())) == [("1", "a"), ("2", "b\nc")]
    assert sorted(r["record"] for r in malformed.collect()) == ['3,"d', "4,e", "5,f"]
    empty = tmp_path / "header.csv"
    empty.write_text("n,text\n")
    cells, malformed = read_cells(spark, str(empty), multi_line=True)
    assert cells.isEmpty() and malformed.isEmpty() and cells.columns == ["n", "text"]


def test_csv_cells(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("n,x,f,note\n1.5,2.5,TRUE,a\nbad,nan,0,b\n,oops,maybe,c\n")
    contract = Contract({"n": INTEGER, "x": FLOAT, "f": FLAG})
    typed, rejects = read_transactions(spark, str(path), contract)
    rows = {r["note"]: r for r in typed.collect()}
    assert (rows["a"]["n"], rows["a"]["x"], rows["a"]["f"]) == (1, 2.5, True)
    assert rows["b"]["x"] is None and rows["b"]["f"] is False
    found = {(r["column"], r["value"], r["reason"]) for r in rejects.collect()}
    assert found == {
        ("n", "bad", "not a valid integer"),
        ("n", None, "empty"),
        ("x", "oops", "not a valid float"),
        ("f", "maybe", "not a valid flag"),
    }
    with pytest.raises(CoercionError):
        read_transactions_strict(spark, str(path), contract)


def test_profile_of_constants_and_missing_columns(spark):
    df = spark.createDataFrame(
        [(1.0, None, 1.0), (1.0, None, 3.0), (1.0, None, float("nan")), (1.0, None, 2.0)],
        "constant double, empty double, x double",
    )
    summary = {r["column"]: r for r in profiling.numeric_summary(df).collect()}
    assert summary["empty"]["count"] == 0 and summary["empty"]["q2"] is None
    assert summary["x"]["count"] == 3 and summary["x"]["q2"] == 2.0
    assert {r[0] for r in profiling.near_zero_variance(df).collect()} == {"constant", "empty"}
    outliers = {r["column"]: r["outliers"] for r in profiling.iqr_outliers(df).collect()}
    assert outliers == {"constant": 0, "empty": 0, "x": 0}
    matrix = {(r["left"], r["right"]): r["pearson"] for r in profiling.pearson_matrix(df).collect()}
    assert matrix["constant", "x"] is None and matrix["x", "x"] == pytest.approx(1.0)


def test_pearson_uses_rows_where_both_are_present(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0), (2.0, 1.0), (3.0, 5.0), (100.0, None)], "a double, b double"
    )
    matrix = {(r["left"], r["right"]): r["pearson"] for r in profiling.pearson_matrix(df).collect()}
    assert matrix["a", "b"] == pytest.approx(0.7205766921228921)


def test_quantiles_are_the_same_at_every_interval_size(spark):
    # a third of the values are equal, the rest are spread widely
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.pow(F.col("id"), 2) / 7).alias("v"),
        (F.xxhash64("id") % 1000).cast("double").alias("w"),
        F.when(F.col("id") < 1800, float("-inf")).otherwise(F.col("id") * 1.0).alias("low"),
        F.when(F.col("id") < 20, float("inf")).when(F.col("id") < 40, float("nan"))
        .when(F.col("id") < 60, float("-inf")).otherwise(F.col("id") % 2 * 1.0).alias("ends"),
        F.lit(None).cast("double").alias("nothing"),
        F.lit(3).alias("same"),
    )
    probabilities = [0.0, 0.1, 0.25, 0.333, 0.5, 0.75, 0.999, 1.0]
    rows = df.toPandas()
    for size in (1, 20, 700, 100_000):
        found = exact_quantiles(df, df.columns, probabilities, interval_values=size)
        for c in df.columns:
            values = sorted(x for x in rows[c] if x is not None and not math.isnan(x))
            for p, q in zip(probabilities, found[c]):
                if not values:
                    assert q is None
                    continue
                place = (len(values) - 1) * p
                lo, hi = values[math.floor(place)], values[math.ceil(place)]
                assert q == (lo if lo == hi else pytest.approx(lo + (hi - lo) * (place % 1)))


def test_robust_scale_of_an_empty_column(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "x double, nothing double")
    scales = scaling.fit_robust(df, ["x", "nothing"])
    rows = scaling.scaled_columns(df, scales).orderBy("x").collect()
    assert [tuple(r) for r in rows] == [(-1.0, None), (1.0, None)]


def test_split_sizes(spark):
    # the published split sizes
    ids = spark.range(69728).withColumnRenamed("id", "customer_id")
    report = {r["split"]: r["rows"] for r in splits.split_report(splits.split_random(ids)).collect()}
    assert report == {"train": 48809, "validation": 10459, "test": 10460}
    days = spark.range(365).select(F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).alias("order_date"))
    labelled = splits.split_chronological(days)
    report = {r["split"]: (r["rows"], r["date_min"]) for r in splits.split_report(labelled, "order_date").collect()}
    assert {k: v[0] for k, v in report.items()} == {"train": 255, "validation": 54, "test": 56}
    assert report["test"][1] > report["validation"][1] > report["train"][1]


def test_split_arguments(spark):
    for train, validation_part in ((0, 0.5), (0.5, 0.5), (0.9, 0.2)):
        with pytest.raises(ValueError):
            splits.validate_fractions(train, validation_part)
    with pytest.raises(ValueError):
        splits.split_random(spark.range(0), id_column="id")
    with pytest.raises(ValueError):
        splits.split_two_stage(spark.range(2), id_column="id")


def test_one_month_is_read_from_its_files_only(spark, tmp_path):
    path = tmp_path / "sales"
    days = "date_add(date'2024-01-01', cast(id % 120 as int))"
    rows = spark.range(6_000).selectExpr(
        "id", f"case when id % 50 = 0 then null when id % 3 = 0 then date'2024-02-10' else {days} end order_date"
    )
    # so few rows would be put into one task
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_by_month(rows, str(path))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    folders = sorted(p.name for p in path.iterdir() if p.name.startswith("_month="))
    assert folders == [f"_month=2024-0{m}" for m in (1, 2, 3, 4)] + ["_month=__HIVE_DEFAULT_PARTITION__"]
    # a day that holds a third of the rows is written by several tasks
    assert len(list((path / "_month=2024-02").glob("*.parquet"))) > 1
    everything = spark.read.parquet(str(path)).drop("_month")
    assert sorted(map(tuple, everything.collect())) and everything.exceptAll(rows).count() == 0
    assert everything.count() == 6_000
    # other months cannot be read any more, and need not be
    for file in path.glob("_month=*/*.parquet"):
        if "2024-02" not in str(file):
            file.write_bytes(b"no parquet")
    for start, end in (("2024-02-01", "2024-02-29"), ("2024-02-05", "2024-02-10"), ("2024-02-20", "2024-02-01")):
        got = read_date_range(spark, str(path), rows.schema, start, end)
        assert got.columns == ["id", "order_date"]
        assert got.exceptAll(rows).count() == 0
        assert got.count() == rows.where(f"order_date between '{start}' and '{end}'").count()
    plan = got._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_month" in plan and "PushedFilters: [IsNotNull(order_date)" in plan


@pytest.mark.parametrize(
    "name",
    ["customer_pearson_matrix", "customer_flag_correlated_pairs", "customer_lookup", "attach_profile", "check_scoring_input"],
)
def test_features_are_made_once(spark, folder, name, monkeypatch):
    import __spark_entry__ as entry
    from cohortlens.operators import customers

    made = []
    original = customers.customer_features
    monkeypatch.setattr(customers, "customer_features", lambda *a: made.append(a) or original(*a))
    result = entry.queries()[name](spark, folder)
    # every pass reads the written features; the lines are not joined and grouped again
    assert len(made) == 1 and not any("lineitem" in f for f in result.inputFiles())
