"""Tables and reports between stages."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: How CSV is written and read: quotes are doubled inside quotes, blanks belong to the cell.
CSV_FORMAT = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

#: Folder column of tables by month.
MONTH = "_month"


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite ``path`` with the frame, as parquet or headered CSV."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.options(**CSV_FORMAT).option("header", True).csv(path)
    elif fmt == "parquet":
        # about half the bytes of the default codec on transaction lines
        writer.option("compression", "zstd").parquet(path)
    else:
        raise ValueError(f"unsupported format: {fmt}")


def move_table(spark: SparkSession, path: str, target: str) -> None:
    """Puts a written table in the place of ``target``, on the same file system."""
    name = spark._jvm.org.apache.hadoop.fs.Path
    files = name(path).getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(name(target), True)
    if not files.rename(name(path), name(target)):
        raise OSError(f"{path} could not be moved to {target}")


def drop_table(spark: SparkSession, path: str) -> None:
    """Deletes a written table, if it is there."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    name.getFileSystem(spark._jsc.hadoopConfiguration()).delete(name, True)


def read_features(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema=None,
    parse_dates: tuple[str, ...] = (),
) -> DataFrame | None:
    """A feature or split table; unparsable dates become null, no path gives None."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    try:
        if fmt == "csv":
            df = reader.options(**CSV_FORMAT).option("header", True).csv(path)
        else:
            df = reader.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise
    for name in parse_dates:
        df = df.withColumn(name, F.col(name).try_cast("date"))
    return df


def write_by_month(df: DataFrame, path: str, date_column: str = "order_date") -> None:
    """Overwrite ``path`` with the frame as parquet, one folder for each month, sorted by date.

    Rows are dealt out by ranges of date and a hash of the row, so a month, or a day, that holds
    most rows is written by many tasks, and a task writes few months. Rows without a date
    have a folder of their own. The months are folder names, not a column of the frame.
    """
    spread = F.xxhash64(*df.columns)
    (
        df.withColumn(MONTH, F.date_format(date_column, "yyyy-MM"))
        .repartitionByRange(date_column, spread)
        .sortWithinPartitions(MONTH, date_column)
        .write.mode("overwrite")
        .partitionBy(MONTH)
        .parquet(path)
    )


def read_date_range(
    spark: SparkSession, path: str, schema, start, end, date_column: str = "order_date"
) -> DataFrame:
    """Rows of a ``write_by_month`` table whose date lies in the closed range.

    Only the folders of the range's months are read, and in their files only the row
    groups whose dates can match. ``schema`` is that of the frame.
    """
    first, last = (F.lit(d).cast("date") for d in (start, end))
    names = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema
    )
    rows = spark.read.schema(f"{names}, {MONTH} string").parquet(path)
    months = F.col(MONTH).between(F.date_format(first, "yyyy-MM"), F.date_format(last, "yyyy-MM"))
    return rows.filter(months & F.col(date_column).between(first, last)).drop(MONTH)


def write_report(sections: dict[str, DataFrame], path: str) -> None:
    """One JSON folder per report section; sections are bounded tables."""
    for name, section in sections.items():
        section.write.mode("overwrite").json(f"{path}/{name}")
