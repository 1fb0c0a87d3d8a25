"""Transaction rows from headered CSV files or from a star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.sources.contract import (
    DATE,
    FLAG,
    FLOAT,
    INTEGER,
    RAW_CONTRACT,
    TEXT,
    Contract,
)
from cohortlens.sources.records import csv_records
from cohortlens.sources.tables import CSV_FORMAT


class CoercionError(ValueError):
    """A cell or column could not be brought to its contract type."""


# The cell texts read as a flag, in any case.
TRUE_CELLS = ("true", "1", "1.0")
FALSE_CELLS = ("false", "0", "0.0")


def _cast(name: str, kind: str) -> Column:
    raw = F.trim(F.col(name))
    if kind == TEXT:
        return F.col(name)
    if kind == INTEGER:
        # whole numbers directly; fractions are cut off, as an int64 cast does
        return F.coalesce(
            raw.try_cast("bigint"),
            raw.try_cast("double").try_cast("bigint"),
        )
    if kind == FLOAT:
        return raw.try_cast("double")
    if kind == FLAG:
        return F.when(F.lower(raw).isin(*TRUE_CELLS), True).when(
            F.lower(raw).isin(*FALSE_CELLS), False
        )
    if kind == DATE:
        return raw.try_cast("date")
    raise ValueError(f"unknown column kind: {kind}")


# The cell texts read as missing.
MISSING_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
_MALFORMED = "_malformed_record"


def _parsed_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records as cells; the first of each file is its header."""
    records = csv_records(spark, path).filter(F.col("record") > 1)
    options = {**CSV_FORMAT, "columnNameOfCorruptRecord": _MALFORMED}
    cells = F.from_csv("text", schema.toDDL(), options)
    parsed = records.withColumn("cells", cells)
    lost = F.when(F.col("closed"), F.col(f"cells.`{_MALFORMED}`")).otherwise(F.col("text"))
    return parsed.select(
        *[F.col(f"cells.`{c}`").alias(c) for c in schema.names if c != _MALFORMED],
        lost.alias(_MALFORMED),
    )


def read_cells(
    spark: SparkSession,
    path: str,
    multi_line: bool = False,
    missing_cells: tuple[str, ...] = MISSING_CELLS,
) -> tuple[DataFrame, DataFrame]:
    """Text cells of a headered CSV, and its malformed records.

    Quotes inside quoted cells are doubled. Quoted line breaks need
    ``multi_line``, which writes the lines to a scratch table and puts records together
    there (``records.csv_records``). A record with more or fewer cells than the header is
    malformed: it is in the second frame (record) only, as it was written. With
    ``multi_line`` so is each line after a quote that is never closed.
    """
    names = spark.read.options(**CSV_FORMAT).option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*names, _MALFORMED)])
    if multi_line:
        raw = _parsed_records(spark, path, schema)
    else:
        raw = (
            spark.read.options(**CSV_FORMAT)
            .schema(schema)
            .option("header", True)
            .option("columnNameOfCorruptRecord", _MALFORMED)
            # with fewer columns to read the parser would not notice extra or absent cells
            .option("columnPruning", False)
            .csv(path)
        )
    malformed = F.col(_MALFORMED).isNotNull()
    cells = raw.filter(~malformed).select(
        *[F.when(~F.col(f"`{c}`").isin(*missing_cells), F.col(f"`{c}`")).alias(c) for c in names]
    )
    # a condition on the cells that always holds: Spark refuses to read the record alone
    read = F.length(F.concat_ws("", *[F.col(f"`{c}`") for c in names])) >= 0
    records = raw.filter(malformed & read).select(F.col(_MALFORMED).alias("record"))
    return cells, records


def read_transactions(
    spark: SparkSession,
    path: str,
    contract: Contract = RAW_CONTRACT,
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Typed rows and rejects of a headered CSV.

    Every cell is read as text and cast with ``try_cast``, so a bad cell turns
    into one row of the rejects frame (column, value, reason) instead of
    ending the job. Empty cells of integer and flag columns are rejects too. A
    record with too many or too few cells is one reject without a column, and
    no row.
    """
    raw, records = read_cells(spark, path, multi_line)
    missing = [c for c in contract.columns if c not in raw.columns]
    if missing:
        raise CoercionError(f"columns missing from {path}: {missing}")
    typed = raw.select(
        *[
            _cast(c, contract.columns[c]).alias(c) if c in contract.columns else F.col(c)
            for c in raw.columns
        ]
    )
    cells = []
    for name, kind in contract.columns.items():
        if kind == TEXT:
            continue
        failed = F.col(name).isNotNull() & _cast(name, kind).isNull()
        reason = F.when(failed, F.lit(f"not a valid {kind}"))
        if kind in (INTEGER, FLAG):
            reason = F.when(F.col(name).isNull(), F.lit("empty")).otherwise(reason)
        cells.append(
            F.when(
                reason.isNotNull(),
                F.struct(
                    F.lit(name).alias("column"),
                    F.col(name).alias("value"),
                    reason.alias("reason"),
                ),
            )
        )
    rejects = records.select(
        F.lit(None).cast("string").alias("column"),
        F.col("record").alias("value"),
        F.lit("wrong number of cells").alias("reason"),
    )
    if cells:
        rejects = raw.select(F.inline(F.array_compact(F.array(*cells)))).unionByName(rejects)
    return typed, rejects


def read_transactions_strict(
    spark: SparkSession,
    path: str,
    contract: Contract = RAW_CONTRACT,
    multi_line: bool = False,
) -> DataFrame:
    """Typed rows; the first rejected cell ends the load with one error."""
    typed, rejects = read_transactions(spark, path, contract, multi_line)
    first = rejects.limit(1).collect()
    if first:
        column, value, reason = first[0]
        where = f"column {column} " if column else ""
        raise CoercionError(f"{path}: {where}{reason}: {value!r}")
    return typed


# Transaction column -> (table it is computed from, expression).
_NET = "l_extendedprice * (1 - l_discount)"
STAR_COLUMNS: dict[str, tuple[str, str]] = {
    "order_id": ("lineitem", "l_orderkey"),
    "order_date": ("orders", "cast(o_orderdate as date)"),
    "customer_id": ("orders", "o_custkey"),
    "customer_segment": ("customer", "c_mktsegment"),
    "customer_country": ("nation", "n_name"),
    "sales_region": ("region", "r_name"),
    "product_id": ("lineitem", "l_partkey"),
    "product_name": ("part", "p_name"),
    "product_category": ("part", "p_type"),
    "brand": ("part", "p_brand"),
    "quantity": ("lineitem", "cast(l_quantity as bigint)"),
    "unit_price_usd": ("lineitem", "l_extendedprice / l_quantity"),
    "gross_sales_usd": ("lineitem", "l_extendedprice"),
    "discount_percentage": ("lineitem", "l_discount * 100"),
    "discount_amount_usd": ("lineitem", "l_extendedprice * l_discount"),
    "net_sales_usd": ("lineitem", _NET),
    "tax_rate_percentage": ("lineitem", "l_tax * 100"),
    "tax_usd": ("lineitem", f"{_NET} * l_tax"),
    "total_order_value_usd": ("lineitem", f"{_NET} * (1 + l_tax)"),
    "payment_method": ("orders", "o_orderpriority"),
    "order_status": ("orders", "o_orderstatus"),
    "delivery_days": ("orders", "cast(datediff(cast(l_shipdate as date), cast(o_orderdate as date)) as bigint)"),
    "return_status": ("lineitem", "case when l_returnflag = 'R' then 'Returned' else 'No Return' end"),
    "return_reason": ("lineitem", "case when l_returnflag = 'R' then l_linestatus end"),
    "coupon_used": ("lineitem", "l_discount > 0.075"),
    "coupon_code": ("part", "case when l_discount > 0.075 then p_brand end"),
    "supplier": ("supplier", "s_name"),
}

# Lookup table -> (table that holds the foreign key, foreign key, key).
_LOOKUPS: dict[str, tuple[str, str, str]] = {
    "orders": ("lineitem", "l_orderkey", "o_orderkey"),
    "customer": ("orders", "o_custkey", "c_custkey"),
    "nation": ("customer", "c_nationkey", "n_nationkey"),
    "region": ("nation", "n_regionkey", "r_regionkey"),
    "part": ("lineitem", "l_partkey", "p_partkey"),
    "supplier": ("lineitem", "l_suppkey", "s_suppkey"),
}


def star_transactions(
    spark: SparkSession, folder: str, columns: list[str] | None = None
) -> DataFrame:
    """One row per order line, joined from the star schema's tables.

    Lookups are left joins on unique keys: no line is ever lost or repeated,
    so a lookup whose columns are not asked for need not be joined at all and
    is left out. No broadcast is forced; Spark decides from table sizes.
    """
    columns = list(columns or STAR_COLUMNS)
    unknown = [c for c in columns if c not in STAR_COLUMNS]
    if unknown:
        raise KeyError(f"unknown transaction columns: {unknown}")
    needed: set[str] = set()
    for table in {STAR_COLUMNS[c][0] for c in columns}:
        while table != "lineitem":
            needed.add(table)
            table = _LOOKUPS[table][0]
    df = spark.read.parquet(f"{folder}/lineitem.parquet")
    for table, (_, foreign, key) in _LOOKUPS.items():
        if table in needed:
            lookup = spark.read.parquet(f"{folder}/{table}.parquet")
            df = df.join(lookup, df[foreign] == lookup[key], "left")
    return df.select(*[F.expr(STAR_COLUMNS[c][1]).alias(c) for c in columns])
