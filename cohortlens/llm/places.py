"""Places of rows within ordered groups, and groups handed to tasks in order."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import cut_lineage


def placed(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """``rows`` with ``n``, the place within the group from 0, and ``size``, the group's rows.

    Places follow ``order``, nulls first; rows equal in it are placed in any order,
    which is then fixed. A null group is a group. Rows are range-partitioned by
    group and order, so a group of any size is sorted by many tasks: each counts
    its part, and prefix sums of those counts, one row for each part of a group, give
    the rest. ``rows`` must come from tables, since sampling reads it twice.
    """
    spread = F.xxhash64(*rows.columns), F.rand(7)  # equal rows need not share a task
    ordered = (
        rows.withColumn("_tie", spread[0])
        .withColumn("_any", spread[1])
        .repartitionByRange(group, *order, "_tie", "_any")
        .sortWithinPartitions(group, *order, "_tie", "_any")
        .withColumn("_at", F.monotonically_increasing_id())
        .drop("_tie", "_any")
    )
    ordered = cut_lineage(ordered).withColumn("_part", F.shiftright("_at", 33))
    parts = ordered.groupBy("_part", group).agg(
        F.count(F.lit(1)).alias("rows"), F.min("_at").alias("first")
    )
    whole = Window.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        F.col("_part").alias("s_part"),
        F.col(group).alias("s_group"),
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(whole).alias("size"),
    )
    same = (F.col("_part") == F.col("s_part")) & F.col(group).eqNullSafe(F.col("s_group"))
    return ordered.join(starts, same).select(
        *rows.columns, (F.col("_at") + F.col("shift")).alias("n"), "size"
    )


def in_groups(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` with equal keys side by side in one partition, sorted by keys and then by ``n``.

    For groups of bounded size, which ``runs`` then hands out one by one.
    """
    return rows.repartition(*keys).sortWithinPartitions(*keys, "n")


def runs(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """(key, rows) for each run of rows equal in the first ``keys`` columns; one run is held."""
    key, held = None, []
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            part = batch.slice(start, 4096)
            for row in zip(*(c.to_pylist() for c in part.columns)):
                if row[:keys] != key:
                    if held:
                        yield key, held
                    key, held = row[:keys], []
                held.append(row[keys:])
    if held:
        yield key, held


def batched(rows: Iterable[tuple], schema: pa.Schema, most: int = 2048) -> Iterator[pa.RecordBatch]:
    """``rows`` as record batches of at most ``most`` rows."""
    held = []

    def batch() -> pa.RecordBatch:
        columns = zip(*held)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema
        )

    for row in rows:
        held.append(row)
        if len(held) == most:
            yield batch()
            held = []
    if held:
        yield batch()
