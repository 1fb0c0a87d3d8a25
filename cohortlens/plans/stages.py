"""The batch job: validate, profile, clean, build features, split, train.

One Spark application. Each stage writes its tables and the next one reads
them, so a stage never depends on state held by executors of an earlier one.
The first failing stage ends the run and names itself.

    zip -r cohortlens.zip cohortlens
    spark-submit --py-files cohortlens.zip cohortlens/plans/stages.py --input RAW.csv --output FOLDER
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from cohortlens.operators import cleaning, customers, daily, profiling, sales, splits, validation
from cohortlens.operators.scoring import (
    promote,
    save_model,
    train_segmentation,
    training_report,
)
from cohortlens.operators.summaries import TOLERANCE
from cohortlens.session import build_session, clear_scratch, kept
from cohortlens.sources.contract import CATEGORIES, CONTRACT, FILL_VALUES, NULLABLE, snake
from cohortlens.sources.tables import drop_table, move_table, read_features, write_report, write_table
from cohortlens.sources.transactions import read_transactions_strict


@dataclass(frozen=True)
class Options:
    """Parameters of a run; the defaults suit the full transaction contract."""

    seed: int = 42
    max_null_rate: float = 0.20
    allowed_categories: dict = field(default_factory=lambda: snake(CATEGORIES))
    nullable_columns: tuple = snake(NULLABLE)
    fill_values: dict = field(default_factory=lambda: snake(FILL_VALUES))
    contract: object = CONTRACT
    allow_duplicate_rows: bool = False
    as_of: str | None = None
    reference_date: str | None = None
    train_fraction: float = 0.70
    validation_fraction: float = 0.15
    rolling_window: int = 7
    top_n: int = 10
    silhouette_tolerance: float | None = TOLERANCE


@dataclass(frozen=True)
class RunResult:
    status: str
    failed_stage: str | None = None
    error: str | None = None
    metrics: dict = field(default_factory=dict)


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A raw CSV under snake-case column names."""
    df = read_transactions_strict(spark, path, multi_line=multi_line)
    return df.toDF(*[c.lower() for c in df.columns])


def prepare(spark, source: DataFrame, out: str, o: Options) -> dict:
    """The report is written whether the gate opens or not; then failing cells too."""
    rules = dict(
        contract=o.contract,
        max_null_rate=o.max_null_rate,
        allowed_categories=o.allowed_categories,
        allow_duplicate_rows=o.allow_duplicate_rows,
        nullable_columns=o.nullable_columns,
    )
    folder, received = f"{out}/reports/validation", f"{out}/received"
    fits = not (
        validation.check_missing_columns(source, o.contract.columns)
        or validation.check_unexpected_columns(source, o.contract.columns)
        or validation.check_types(source, o.contract)
    )
    try:
        if fits:
            # made once; every rule reads what becomes the validated table
            write_table(source, received)
            source = read_features(spark, received, schema=source.schema)
        write_report({"issues": validation.find_issues(source, **rules)}, folder)
        issues = spark.read.schema(validation.ISSUE_SCHEMA).json(f"{folder}/issues")
        write_report({"summary": validation.summarize_issues(source, issues)}, folder)
        found = issues.collect()  # one row per rule and column at most
        if found:
            if not validation.check_missing_columns(source, o.contract.columns):
                cases = validation.check_failure_cases(
                    source, validation.contract_rules(source, o.contract), []
                )
                write_report({"failure_cases": cases}, folder)
            raise validation.DataValidationError(found)
        move_table(spark, received, f"{out}/validated")
    finally:
        drop_table(spark, received)
    return {}


def profile(spark, _, out: str, o: Options) -> dict:
    df = read_features(spark, f"{out}/validated")
    numeric = [c for c in profiling.numeric_columns(df) if not c.endswith("_id")]
    quartiles = profiling.quartiles(df, numeric)
    matrix = profiling.pearson_matrix(df, numeric)
    gaps = sales.zero_transaction_days(df)
    # for this stage and the next one
    write_table(validation.repeated_hashes(df), f"{out}/repeated_hashes")
    again = read_features(spark, f"{out}/repeated_hashes")
    with kept(sales.distinct_orders(df)) as orders, kept(profiling.product_totals(df)) as totals:
        orders.count()  # from now on Spark knows that it need not be shuffled
        sections = {
            "overview": profiling.dataset_overview(df, o.as_of, again=again, orders=orders),
            "column_types": profiling.column_types(df),
            "missing": profiling.missing_profile(df, o.max_null_rate),
            "numeric_summary": profiling.numeric_summary(df, numeric, quartiles),
            "outliers": profiling.iqr_outliers(df, numeric, quartiles),
            "distinct_counts": profiling.distinct_counts(df, numeric),
            "categories": profiling.categorical_profile(df, o.top_n),
            "pearson": matrix,
            "correlated_pairs": profiling.flag_correlated_pairs(matrix, numeric),
            "repeat_purchase_rate": profiling.repeat_purchase_rate(orders),
            "top_by_revenue": profiling.top_products(df, o.top_n, totals=totals),
            "top_by_volume": profiling.top_products(df, o.top_n, "volume", totals),
            "category_mix": profiling.category_mix(df),
            "zero_days": gaps,
            "zero_day_pattern": sales.zero_day_pattern(gaps),
            "kpis": sales.sales_kpis(df, orders),
            "weekday_pattern": sales.weekday_pattern(df),
            "monthly_trend": sales.monthly_trend(df, orders),
            **{
                f"sales_{p}": sales.resample_sales(df, p, o.rolling_window)
                for p in ("daily", "weekly", "monthly")
            },
        }
        write_report(sections, f"{out}/reports/profile")
    return {}


def clean(spark, _, out: str, o: Options) -> dict:
    validated = read_features(spark, f"{out}/validated")
    again = read_features(spark, f"{out}/repeated_hashes")
    df = cleaning.fix_dtypes(cleaning.drop_exact_duplicates(validated, again))
    write_table(cleaning.fill_not_applicable(df, o.fill_values), f"{out}/preprocessed")
    written = read_features(spark, f"{out}/preprocessed")
    outliers = spark.read.json(f"{out}/reports/profile/outliers")
    write_report(
        {
            "removed_duplicates": spark.createDataFrame(
                [(validated.count() - written.count(),)], "duplicate_rows bigint"
            ),
            "filled": cleaning.count_filled(df, o.fill_values),
            "remaining_missing": cleaning.remaining_missing(written, o.max_null_rate),
            "future_dates": cleaning.future_date_report(written, as_of=o.as_of),
            "outliers_kept": cleaning.outlier_retention_report(outliers),
            "modeling_exclusions": spark.createDataFrame(
                [(c,) for c in cleaning.modeling_exclusions(written)], "column string"
            ),
        },
        f"{out}/reports/cleaning",
    )
    return {}


def features(spark, _, out: str, o: Options) -> dict:
    df = read_features(spark, f"{out}/preprocessed")
    large = customers.large_customers(df)
    write_table(
        customers.customer_features(df, o.reference_date, large), f"{out}/customer_features"
    )
    write_table(daily.sales_features(df), f"{out}/sales_features")
    report = daily.feature_report(
        read_features(spark, f"{out}/customer_features"),
        read_features(spark, f"{out}/sales_features"),
    )
    write_report({"features": report}, f"{out}/reports")
    return report.first().asDict()


def split(spark, _, out: str, o: Options) -> dict:
    by_customer = splits.split_random(
        read_features(spark, f"{out}/customer_features"),
        o.train_fraction,
        o.validation_fraction,
        o.seed,
    )
    by_day = splits.split_chronological(
        read_features(spark, f"{out}/sales_features"), o.train_fraction, o.validation_fraction
    )
    for name, labelled in (("customer", by_customer), ("sales", by_day)):
        for part, frame in splits.frames(labelled).items():
            write_table(frame, f"{out}/splits/{name}/{part}")
    write_report(
        {
            "customer": splits.split_report(by_customer),
            "sales": splits.split_report(by_day, "order_date"),
        },
        f"{out}/reports/splits",
    )
    return {}


def train(spark, _, out: str, o: Options) -> dict:
    table = read_features(spark, f"{out}/customer_features")
    bundle = train_segmentation(table, o.seed, tolerance=o.silhouette_tolerance)
    save_model(bundle, f"{out}/models/candidate")
    report = training_report(
        bundle, table, seed=o.seed, components=2, clusters=2, tolerance=o.silhouette_tolerance
    )
    write_report({"training": report}, f"{out}/reports")
    promoted = promote(bundle, f"{out}/models/best")
    return {**bundle.metrics, "promoted": promoted}


STAGES: tuple[tuple[str, Callable], ...] = (
    ("prepare", prepare),
    ("profile", profile),
    ("clean", clean),
    ("features", features),
    ("splits", split),
    ("train", train),
)


def run_stages(source: DataFrame, out: str, options: Options = Options()) -> RunResult:
    """Runs all stages in order; the first failure ends the run."""
    spark = source.sparkSession
    metrics: dict = {}
    for name, stage in STAGES:
        try:
            metrics.update(stage(spark, source, out, options))
        except Exception as error:  # the result names the stage, whatever went wrong
            return RunResult("failed", name, str(error).splitlines()[0], metrics)
    return RunResult("succeeded", metrics=metrics)


def main() -> int:
    defaults = Options()
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--multi-line", action="store_true", help="cells may hold line breaks")
    for name in (
        "seed",
        "max_null_rate",
        "train_fraction",
        "validation_fraction",
        "rolling_window",
        "top_n",
        "silhouette_tolerance",
    ):
        value = getattr(defaults, name)
        parser.add_argument(f"--{name.replace('_', '-')}", type=type(value), default=value)
    for name in ("as_of", "reference_date"):
        parser.add_argument(f"--{name.replace('_', '-')}")
    parser.add_argument("--allow-duplicate-rows", action="store_true")
    given = vars(parser.parse_args())
    source, out, multi_line = given.pop("input"), given.pop("output"), given.pop("multi_line")
    # 0 asks for the exact silhouette, whose work grows with the square of the rows
    options = Options(**{**given, "silhouette_tolerance": given["silhouette_tolerance"] or None})
    spark = build_session("cohortlens-stages")
    result = run_stages(read_raw_csv(spark, source, multi_line), out, options)
    clear_scratch(spark)
    print(result)
    return 0 if result.status == "succeeded" else 1


if __name__ == "__main__":
    sys.exit(main())
