"""Benchmark decontamination with a broadcast hash set of normalised test n-grams.

Every word window of a document probes the hash relation of the benchmark's
windows; the relation holds the windows themselves, so a hit is verified by
equality and not by a hash alone. All of it is built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import word_list

#: Fixed value: words of a window.
WINDOW = 13
#: Text bytes of the distinct test windows up to which they are broadcast. Beyond it the
#: same join is left to Spark, which shuffles both sides.
BROADCAST_BYTES = 64 * 1024 * 1024


def _windows(words: Column, n_words: Column, length: int) -> Column:
    """(pos, len, window) of every run of ``length`` words; positions count from 1."""
    starts = F.when(n_words >= length, F.sequence(F.lit(1), n_words - (length - 1)))
    return F.coalesce(
        F.transform(
            starts,
            lambda i: F.struct(
                i.alias("pos"),
                F.lit(length).alias("len"),
                F.array_join(F.slice(words, i, length), " ").alias("window"),
            ),
        ),
        F.expr("array()").cast("array<struct<pos:int,len:int,window:string>>"),
    )


def test_windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """(window, len, items): each distinct window and the sorted ids it occurs in.

    An item shorter than ``n`` words is one window; an item without words has none.
    """
    words = benchmark.select(
        F.col("item_id").cast("string").alias("item"), word_list(F.col("text")).alias("words")
    ).withColumn("size", F.size("words"))
    short = F.array(
        F.struct(
            F.lit(1).alias("pos"),
            F.col("size").alias("len"),
            F.array_join("words", " ").alias("window"),
        )
    )
    spans = F.when(F.col("size") < n, short).otherwise(_windows(F.col("words"), F.col("size"), n))
    return (
        words.where(F.col("size") > 0)
        .select("item", F.explode(spans).alias("w"))
        .groupBy(F.col("w.window").alias("window"), F.col("w.len").alias("len"))
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_words, n_hit, items, spans, contaminated.

    ``spans`` are the hit word ranges, merged (start from 1, end inclusive).
    ``contaminated``: n_hit > 0 and 20 * n_hit >= n_words. Null and empty texts
    have no words and are clean. Rows that are equal in id and text are returned
    as often as they occur; a null id is an id of its own; ids of one value with
    different texts are told apart by ``text_hash``. Items with a null id have
    windows but no name. Other columns are ignored; empty tables give no hits or
    no rows.
    """
    found = test_windows(benchmark, n)
    bounds = found.agg(
        F.collect_set("len").alias("lengths"), F.sum(F.octet_length("window")).alias("bytes")
    ).first()
    # a row without window stands for each document, so that clean ones come through the join
    nothing = "select '' as window, 0 as len, cast(array() as array<string>) as items"
    known = found.unionByName(docs.sparkSession.sql(nothing)).select("window", "items")
    if (bounds["bytes"] or 0) <= BROADCAST_BYTES:
        known = F.broadcast(known)

    words, size = F.col("words"), F.col("n_words")
    stand_in = F.array(
        F.struct(F.lit(0).alias("pos"), F.lit(0).alias("len"), F.lit("").alias("window"))
    )
    spans = F.concat(stand_in, *(_windows(words, size, k) for k in sorted(bounds["lengths"])))
    scanned = (
        docs.select(
            "doc_id",
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
            word_list(F.col("text")).alias("words"),
        )
        .withColumn("n_words", F.size("words"))
        .select("doc_id", "text_hash", "n_words", F.explode(spans).alias("w"))
        .select("doc_id", "text_hash", "n_words", "w.pos", "w.len", "w.window")
    )
    hit = F.col("pos") > 0
    per_text = (
        scanned.join(known, "window")
        .groupBy("doc_id", "text_hash")
        .agg(
            F.max("n_words").alias("n_words"),
            F.count_if(~hit).alias("copies"),
            F.array_sort(F.collect_set(F.when(hit, F.struct("pos", "len")))).alias("hits"),
            F.collect_set(F.when(hit, F.col("items"))).alias("items"),
        )
    )
    merged = F.aggregate(
        "hits",
        F.expr("array()").cast("array<struct<start:int,end:int>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] + 1 >= x["pos"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(
                    F.struct(
                        F.element_at(acc, -1)["start"].alias("start"),
                        F.greatest(F.element_at(acc, -1)["end"], x["pos"] + x["len"] - 1).alias(
                            "end"
                        ),
                    )
                ),
            ),
        ).otherwise(
            F.concat(
                acc,
                F.array(
                    F.struct(x["pos"].alias("start"), (x["pos"] + x["len"] - 1).alias("end"))
                ),
            )
        ),
    )
    n_hit = F.aggregate("spans", F.lit(0), lambda a, s: a + s["end"] - s["start"] + 1)
    return (
        per_text.withColumn("spans", merged)
        .withColumn("n_hit", n_hit.cast("long"))
        .withColumn("n_words", F.col("n_words").cast("long"))
        .withColumn("items", F.array_sort(F.array_distinct(F.flatten("items"))))
        .withColumn(
            "contaminated",
            (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")),
        )
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select("doc_id", "text_hash", "n_words", "n_hit", "items", "spans", "contaminated")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated rows; all other rows unchanged, with columns of any name."""
    bad = (
        contamination(docs, benchmark, n)
        .where("contaminated")
        .select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash"))
        .distinct()
    )
    packed = docs.select(
        docs["doc_id"].alias("id"),
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("hash"),
        F.struct(*(docs[c] for c in docs.columns)).alias("row"),
    )
    same = F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("hash") == F.col("bad_hash"))
    return packed.join(bad, same, "left_anti").select("row.*")
