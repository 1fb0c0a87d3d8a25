"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Arrow batches are cut to this many rows and bytes of text before Python holds them as lists.
SLICE_ROWS, SLICE_BYTES = 256, 2 * 1024 * 1024

#: Byte table of the word rule: A-Z lower-cased, other ASCII but letters and digits is a gap.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else untouched; the quick built-in serves plain ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def word_list(text: Column) -> Column:
    """Words of ``text``: runs of ASCII letters, digits and non-ASCII; null has none."""
    gaps = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    parts = F.split(F.coalesce(text, F.lit("")), gaps)
    return F.transform(F.array_remove(parts, ""), ascii_lower)


def byte_words(text: str | None) -> list[bytes]:
    """The same words as ``word_list``, as UTF-8."""
    return text.encode().translate(WORD_BYTES).split() if text else []


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with few rows and little text each.

    Python lists of texts and words stay small, however long the texts are; a
    row that is longer than SLICE_BYTES is a part by itself.
    """
    for batch in batches:
        size = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
                size += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(size.tolist()):
            if i > start and (total + n > SLICE_BYTES or i - start >= SLICE_ROWS):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if batch.num_rows:
            yield batch.slice(start)

#: A text of more than this part of a sample's characters is too long for the sample.
LONG_PART = 5


def bounded_sample(rows: DataFrame, key: str, most_rows: int, most_chars: int) -> DataFrame:
    """For each value of ``key`` at most ``most_rows`` rows with at most ``most_chars`` of text.

    Rows (doc_id, text, key) are chosen by a hash of their id: a threshold from
    the value's row count keeps about twice the bound, and the smallest hashes of
    those, up to both bounds, are returned. Texts of more than ``most_chars`` /
    LONG_PART characters are left out beforehand, so they take no room from
    others; a value that has no shorter text gives the starts of its long ones.
    Null texts are left out. Few distinct values are expected.
    """
    longest = max(1, most_chars // LONG_PART)
    length = F.length("text")
    counts = rows.groupBy(key).agg(
        F.count(F.when(length <= longest, 1)).alias("short"), F.count("text").alias("all")
    )
    order = F.xxhash64(F.col("doc_id").cast("string"))
    keep = F.lit(False)
    for r in counts.collect():
        every = max(1, (r["short"] or r["all"]) // (2 * most_rows))
        fits = (length <= longest) if r["short"] else F.col("text").isNotNull()
        keep = keep | ((F.col(key) == F.lit(r[key])) & fits & (F.pmod(order, F.lit(every)) == 0))
    by = Window.partitionBy(key).orderBy("_order", "text")
    size = F.sum(F.length("text")).over(by.rowsBetween(Window.unboundedPreceding, 0))
    return (
        rows.where(keep)
        .withColumn("text", F.substring("text", 1, longest))
        .withColumn("_order", order)
        .withColumn("_row", F.row_number().over(by))
        .where(F.col("_row") <= most_rows)
        .withColumn("_size", size)
        .where(F.col("_size") <= most_chars)
        .select(key, "text")
    )
