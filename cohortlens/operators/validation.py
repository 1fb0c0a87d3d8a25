"""Validation: every rule of a table is counted in one pass over it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.columns import is_missing, rows_from_aggregates
from cohortlens.session import cut_lineage
from cohortlens.sources.contract import CONTRACT, SPARK_TYPES, Contract

ISSUE_SCHEMA = "code string, column string, failures long"


@dataclass(frozen=True)
class Rule:
    """A named check of one column; ``failing`` is true for a bad cell."""

    column: str
    check: str
    failing: Column


class DataValidationError(ValueError):
    """Raised by the gate after all issues have been collected."""

    def __init__(self, issues: list) -> None:
        self.issues = issues
        listed = "; ".join(f"{i['code']} {i['column'] or ''} ({i['failures']})" for i in issues)
        super().__init__(f"validation failed with {len(issues)} issue(s): {listed}")


def check_missing_columns(df: DataFrame, required) -> list[str]:
    return [c for c in required if c not in df.columns]


def check_unexpected_columns(df: DataFrame, required) -> list[str]:
    return sorted(set(df.columns) - set(required))


def check_types(df: DataFrame, contract: Contract = CONTRACT) -> list[dict[str, str]]:
    """Columns whose Spark type differs from the contract, without coercion."""
    return [
        {
            "column": name,
            "expected": SPARK_TYPES[kind].simpleString(),
            "actual": df.schema[name].dataType.simpleString(),
        }
        for name, kind in contract.columns.items()
        if name in df.columns and df.schema[name].dataType != SPARK_TYPES[kind]
    ]


def not_null_rules(df: DataFrame, columns) -> list[Rule]:
    return [Rule(c, "not_null", is_missing(df, c)) for c in columns if c in df.columns]


def domain_rules(
    at_least: dict | None = None,
    greater_than: dict | None = None,
    within: dict | None = None,
) -> list[Rule]:
    """Bounds on columns. Missing cells are the business of ``not_null`` rules."""
    rules = []
    for c, low in (at_least or {}).items():
        rules.append(Rule(c, f">= {low}", F.col(c) < low))
    for c, low in (greater_than or {}).items():
        rules.append(Rule(c, f"> {low}", F.col(c) <= low))
    for c, (low, high) in (within or {}).items():
        rules.append(Rule(c, f"in [{low}, {high}]", ~F.col(c).between(low, high)))
    return rules


def contract_rules(df: DataFrame, contract: Contract = CONTRACT) -> list[Rule]:
    """Nullability and domain rules of the contract's columns found in ``df``."""
    contract = contract.restricted_to(df.columns)
    required = [c for c in contract.columns if c not in contract.nullable]
    return not_null_rules(df, required) + domain_rules(
        contract.at_least, contract.greater_than, contract.within
    )


def count_failures(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(column, check, failures) for all rules, from one aggregate."""
    counted = df.agg(
        *[F.count_if(rule.failing).alias(f"r{i}") for i, rule in enumerate(rules)]
    )
    return rows_from_aggregates(
        counted,
        [
            {
                "column": F.lit(rule.column),
                "check": F.lit(rule.check),
                "failures": F.col(f"r{i}"),
            }
            for i, rule in enumerate(rules)
        ],
    )


def check_not_null(df: DataFrame, columns) -> DataFrame:
    return count_failures(df, not_null_rules(df, columns))


def check_domain(df: DataFrame, at_least=None, greater_than=None, within=None) -> DataFrame:
    return count_failures(df, domain_rules(at_least, greater_than, within))


def check_ranges(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Opt-in closed ranges, counted for the columns that are present."""
    present = {c: r for c, r in ranges.items() if c in df.columns}
    return check_domain(df, within=present)


def check_failure_cases(df: DataFrame, rules: list[Rule], key: list[str]) -> DataFrame:
    """One row per failing cell: the key columns, column, check and value.

    A projection that fans out only failing cells; nothing is shuffled.
    """
    cases = [
        F.when(
            rule.failing,
            F.struct(
                F.lit(rule.column).alias("column"),
                F.lit(rule.check).alias("check"),
                F.col(rule.column).cast("string").alias("value"),
            ),
        )
        for rule in rules
    ]
    return df.select(*key, F.inline(F.array_compact(F.array(*cases))))


def with_row_hash(df: DataFrame) -> DataFrame:
    """Adds ``_row_hash``, which is equal for identical rows."""
    # maps, and what holds them, cannot be hashed; the comparison covers them
    hashed = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    return df.withColumn("_row_hash", F.xxhash64(F.lit(0), *hashed))


def repeated_hashes(df: DataFrame) -> DataFrame:
    """(_row_hash) of rows whose hash occurs again: all that may be identical to another row."""
    counted = with_row_hash(df).groupBy("_row_hash").agg(F.count(F.lit(1)).alias("_rows"))
    return counted.filter("_rows > 1").select("_row_hash")


def check_duplicates(df: DataFrame, again: DataFrame | None = None) -> DataFrame:
    """Number of rows that repeat an earlier identical row (nulls are equal).

    Hashes of rows are counted first, so that tasks hold numbers instead of whole rows;
    only rows whose hash occurs again are compared. Copies are counted before the
    shuffle, so a much repeated row is one entry per task. ``again`` may bring the
    ``repeated_hashes`` of ``df``.
    """
    # written, so that the join knows how few they are
    again = cut_lineage(repeated_hashes(df)) if again is None else again
    return (
        with_row_hash(df)
        .join(again, "_row_hash", "left_semi")
        .groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"))
    )


def null_rates(df: DataFrame) -> DataFrame:
    """(column, null_count, null_rate) in column order, from one aggregate."""
    counted = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)],
    )
    return rows_from_aggregates(
        counted,
        [
            {
                "column": F.lit(c),
                "null_count": F.col(f"m{i}"),
                "null_rate": F.coalesce(F.try_divide(F.col(f"m{i}"), F.col("n")), F.lit(0.0)),
            }
            for i, c in enumerate(df.columns)
        ],
    )


def check_null_rate(
    df: DataFrame, max_null_rate: float = 0.20, nullable_columns: tuple[str, ...] = ()
) -> DataFrame:
    """Columns whose null rate exceeds the limit, exempt columns aside."""
    judged = [c for c in df.columns if c not in nullable_columns]
    return null_rates(df.select(*judged)).filter(F.col("null_rate") > max_null_rate)


def check_categories(df: DataFrame, allowed: dict[str, list]) -> DataFrame:
    """(column, value, failures) for non-null values outside their allow-list.

    Values are counted per column first; the anti join sees distinct values.
    """
    present = [c for c in allowed if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "column string, value string, failures long")
    values = (
        df.select(*[F.col(c).cast("string").alias(c) for c in present])
        .unpivot([], present, "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("failures"))
    )
    listed = df.sparkSession.createDataFrame(
        [
            (c, str(v).lower() if isinstance(v, bool) else str(v))
            for c in present
            for v in allowed[c]
        ],
        "column string, value string",
    )
    return values.join(listed, ["column", "value"], "left_anti")


def find_issues(
    df: DataFrame,
    contract: Contract = CONTRACT,
    max_null_rate: float = 0.20,
    allowed_categories: dict[str, list] | None = None,
    allow_duplicate_rows: bool = False,
    nullable_columns: tuple[str, ...] = (),
    ranges: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """All issues as rows (code, column, failures)."""
    spark = df.sparkSession
    missing = check_missing_columns(df, contract.columns)
    found = [("missing_columns", c, 1) for c in missing]
    found += [
        ("unexpected_columns", c, 1) for c in check_unexpected_columns(df, contract.columns)
    ]
    parts = []
    if not missing:
        found += [("schema_type", t["column"], 1) for t in check_types(df, contract)]
        rules = contract_rules(df, contract)
        parts.append(
            count_failures(df, rules).select(
                F.lit("schema").alias("code"), "column", "failures"
            )
        )
    if ranges:
        parts.append(
            check_ranges(df, ranges).select(F.lit("range").alias("code"), "column", "failures")
        )
    if not allow_duplicate_rows:
        parts.append(
            check_duplicates(df).select(
                F.lit("duplicate_rows").alias("code"),
                F.lit(None).cast("string").alias("column"),
                F.col("duplicate_rows").alias("failures"),
            )
        )
    parts.append(
        check_null_rate(df, max_null_rate, nullable_columns).select(
            F.lit("null_rate").alias("code"), "column", F.col("null_count").alias("failures")
        )
    )
    parts.append(
        check_categories(df, allowed_categories or {})
        .groupBy("column")
        .agg(F.sum("failures").alias("failures"))
        .select(F.lit("category").alias("code"), "column", "failures")
    )
    issues = spark.createDataFrame(found, ISSUE_SCHEMA)
    for part in parts:
        issues = issues.unionByName(part)
    return issues.filter("failures > 0")


def validation_report(df: DataFrame, **options) -> DataFrame:
    """One row: passed, issue_count, row_count, column_count."""
    return summarize_issues(df, find_issues(df, **options))


def summarize_issues(df: DataFrame, issues: DataFrame) -> DataFrame:
    """The report row of issues that were found before."""
    return issues.agg(F.count(F.lit(1)).alias("issue_count")).select(
        (F.col("issue_count") == 0).alias("passed"),
        "issue_count",
        df.agg(F.count(F.lit(1))).scalar().alias("row_count"),
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
    )


def validate(df: DataFrame, **options) -> DataFrame:
    """The gate: returns ``df`` unchanged, or raises with every issue listed."""
    issues = find_issues(df, **options).collect()  # one row per rule at most
    if issues:
        raise DataValidationError(issues)
    return df


NON_NEGATIVE_FEATURES = (
    "recency_days",
    "frequency",
    "monetary_value",
    "avg_order_value",
    "order_value_std",
    "product_diversity",
    "purchase_velocity",
)
RATE_FEATURES = ("return_rate", "coupon_usage_rate")
LABEL_FEATURES = ("preferred_category", "preferred_payment_method")


def check_scoring_input(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows fit for scoring, and the rejected rest with the failing columns."""
    failing = []
    for c in NON_NEGATIVE_FEATURES:
        failing.append(F.when(is_missing(features, c) | (F.col(c) < 0), F.lit(c)))
    for c in RATE_FEATURES:
        failing.append(
            F.when(is_missing(features, c) | ~F.col(c).between(0, 1), F.lit(c))
        )
    for c in LABEL_FEATURES:
        failing.append(F.when(F.col(c).isNull(), F.lit(c)))
    judged = features.withColumn("failed_columns", F.array_compact(F.array(*failing)))
    clean = F.size("failed_columns") == 0
    return judged.filter(clean).drop("failed_columns"), judged.filter(~clean)
