"""CSV records with line breaks in quoted cells, read from byte ranges by many tasks.

Spark hands out a file in byte ranges; a task cannot know whether its range starts
inside a quoted cell. But each line has a known effect on that state: it keeps it, turns
it over, or ends outside or inside whatever it was before. Effects are composed along
the lines of a range, and ranges along their file (one row each), which gives every line
its state and the number of its record. Only lines of records that span
several lines are then brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.session import cut_lineage


def _ends() -> Column:
    """Whether the line ends inside a quoted cell: started outside, and started inside.

    Doubled quotes change nothing. Another quote closes a quoted cell, opens one at the
    start of a cell, and is a plain character elsewhere.
    """
    parts = F.split(F.replace("value", F.lit('""'), F.lit("")), '"', -1)
    before = F.slice(parts, 1, F.size(parts) - 1)
    opens = F.transform(before, lambda p, i: p.endswith(",") | ((i == 0) & (p == "")))
    after = F.aggregate(
        opens,
        F.struct(F.lit(False).alias("outside"), F.lit(True).alias("inside")),
        lambda at, start: F.struct(
            (~at["outside"] & start).alias("outside"), (~at["inside"] & start).alias("inside")
        ),
    )
    return F.when(F.col("value").contains('"'), after)


def _with_effects(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds ``base`` and ``turned``: the state after a row is base, or the start, xor turned.

    Rows have ``fixed`` (the end whatever the state was before, or null) and ``turns`` (0 or
    1). ``base`` is the last fixed end, turned back by all turns up to it.
    """
    along = W.partitionBy(*keys).orderBy(order)
    run = along.rowsBetween(W.unboundedPreceding, W.currentRow)
    turned = F.sum("turns").over(run) % 2 == 1
    rows = rows.withColumn("turned", turned).withColumn(
        "_at_fixed", F.when(F.col("fixed").isNotNull(), F.col("fixed") != F.col("turned"))
    )
    return rows.withColumn("base", F.last("_at_fixed", ignorenulls=True).over(run)).drop("_at_fixed")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, text, closed): the records of CSV files, numbered from 1 in each file.

    Lines end with a line feed, with or without a carriage return; line breaks inside cells
    come back as line feeds. Empty lines between records are none. A quote that is never closed makes a
    record of each line from there to the end of the file, with ``closed`` false, so that
    no record grows with the file. Empty files have no records.
    """
    # written once: the byte ranges of two scans need not be the same
    lines = cut_lineage(
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
            F.regexp_replace("value", r"\r$", "").alias("value"),
        )
        .withColumn("ends", _ends())
        .withColumn("fixed", F.when(F.expr("ends.outside = ends.inside"), F.col("ends.outside")))
        .withColumn(
            "turns",
            F.coalesce(F.expr("ends.outside and not ends.inside"), F.lit(False)).cast("int"),
        )
        .drop("ends")
    )
    moved = _with_effects(lines, ["file", "block"], "place")
    # one row for each byte range: its effect, and by that the state at its start
    last = F.max_by(F.struct("base", "turned"), "place").alias("last")
    ranges = (
        moved.groupBy("file", "block")
        .agg(last)
        .select(
            "file",
            "block",
            (F.col("last.base") != F.col("last.turned")).alias("fixed"),
            F.when(F.col("last.base").isNull(), F.col("last.turned").cast("int"))
            .otherwise(F.lit(0))
            .alias("turns"),
        )
    )
    of_file = W.partitionBy("file").orderBy("block")
    ended = F.coalesce("base", F.lit(False)) != F.col("turned")
    ranges = cut_lineage(
        _with_effects(ranges, ["file"], "block")
        .withColumn("start", F.coalesce(F.lag(ended).over(of_file), F.lit(False)))
        .withColumn("open_end", F.last(ended).over(of_file.rowsBetween(0, W.unboundedFollowing)))
        .select("file", "block", "start", "open_end")
    )
    in_range = W.partitionBy("file", "block").orderBy("place")
    after = F.coalesce("base", "start") != F.col("turned")
    states = (
        moved.join(ranges, ["file", "block"])
        .withColumn("after", after)
        .withColumn("before", F.coalesce(F.lag("after").over(in_range), F.col("start")))
        .filter(F.col("before") | (F.col("value") != ""))
        .withColumn("first", (~F.col("before")).cast("bigint"))
    )
    firsts = states.groupBy("file", "block").agg(F.sum("first").alias("n"))
    earlier = of_file.rowsBetween(W.unboundedPreceding, -1)
    offsets = firsts.select(
        "file",
        "block",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"),
        F.sum("n").over(W.partitionBy("file")).alias("all_records"),
    )
    run = in_range.rowsBetween(W.unboundedPreceding, W.currentRow)
    numbered = (
        states.withColumn("in_range", F.sum("first").over(run))
        .join(offsets, ["file", "block"])
        .withColumn("record", F.col("offset") + F.col("in_range"))
        .withColumn("lost", F.col("open_end") & (F.col("record") == F.col("all_records")))
    )
    alone = F.col("lost") | ~(F.col("before") | F.col("after"))
    single = numbered.filter(alone).select(
        "file", "record", F.col("value").alias("text"), (~F.col("lost")).alias("closed")
    )
    pieces = F.array_sort(F.collect_list(F.struct("block", "place", "value")))
    spanning = (
        numbered.filter(~alone)
        .groupBy("file", "record")
        .agg(pieces.alias("pieces"))
        .select(
            "file",
            "record",
            F.array_join("pieces.value", "\n").alias("text"),
            F.lit(True).alias("closed"),
        )
    )
    return single.unionByName(spanning)
