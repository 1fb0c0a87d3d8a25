"""Column expressions used by several operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating column."""
    missing = F.col(name).isNull()
    if is_floating(df, name):
        missing = missing | F.isnan(name)
    return missing


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes null, so that Spark's aggregates skip it."""
    floating = [f.name for f in df.schema.fields if is_floating(df, f.name)]
    if not floating:
        return df
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floating})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def categorical_columns(df: DataFrame) -> list[str]:
    """Text and boolean columns."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.StringType, T.BooleanType))
    ]


def change_from(current: Column, previous: Column) -> Column:
    """Relative change; null where there is no previous value or it is zero."""
    return F.try_divide(current - previous, previous)


def seeded_key(seed: int, id_column: str) -> Column:
    """A repeatable pseudo-random sort key for a row id."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")))


def unpivot_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value as text) for each cell of the given columns, nulls kept."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], columns, "column", "value"
    )


def rows_from_aggregates(row: DataFrame, rows: list[dict[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into several rows without a second pass."""
    structs = [F.struct(*[value.alias(key) for key, value in entry.items()]) for entry in rows]
    return row.select(F.inline(F.array(*structs)))


def settle(value: Column, digits: int) -> Column:
    """Round for comparison with another engine.

    Sums of doubles differ in their last bits with the order of addition, so a
    value that lies exactly half-way between two roundings could go either
    way. The small shift moves such halves off the edge.
    """
    return F.round(value + F.lit(float(f"1.234567e-{digits + 3}")) + F.lit(0.0), digits)
