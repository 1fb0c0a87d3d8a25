"""Mixing sources to target weights by Pfair scheduling; rows pass built-in expressions only.

Each source is cut into blocks of equal size. With share w of the weights, block
i (from 0) is released at floor(i / w) and due at ceil((i + 1) / w); in each slot
the released block with the earliest deadline goes out. After any number of slots
each source is less than one block away from its share, as long as no source has
run out. The driver holds one number for each block.

With a period P, weights are first rounded to whole slots of P, one slot set
aside for each source. Releases and deadlines then repeat after P slots, so the
schedule of one period serves for all blocks; it is kept to the rounded weights,
and from the given ones a source departs by the same error in each period.
"""

from __future__ import annotations

import heapq
from array import array
from fractions import Fraction
from math import lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slots of a period: weights are rounded to multiples of 1 / PERIOD, 1 at least.
PERIOD = 1000
#: Without a period: sources that the driver schedules at most.
MOST_SOURCES = 100_000
#: Slots of a source that stand in one row of the schedule.
STRETCH = 1024
#: Characters of a block.
BLOCK_CHARS = 65_536
#: Rows of a source are dealt to this many ranges of their hash, so that running sums of a
#: large source are taken in parallel.
RANGE_DIGITS = 3


def smoothed_weights(sized: DataFrame, power: float = 0.5) -> DataFrame:
    """(source, weight): each source's share in characters to ``power``."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("size"))
    return sums.select("source", F.pow(F.greatest("size", F.lit(1)), F.lit(power)).alias("weight"))


def shares(weights: DataFrame, period: int) -> DataFrame:
    """(source, share): whole numbers that sum to ``period``, each 1 at least.

    One slot goes to each source, the rest by largest remainder.
    """
    everyone = Window.partitionBy()
    by_rest = everyone.orderBy(F.desc("rest"), F.col("source").asc_nulls_first())
    return (
        weights.withColumn("n", F.count(F.lit(1)).over(everyone))
        .withColumn(
            "quota", (period - F.col("n")) * F.col("weight") / F.sum("weight").over(everyone)
        )
        .withColumn("whole", F.floor("quota"))
        .withColumn("rest", F.round(F.col("quota") - F.col("whole"), 9))
        .withColumn("left", period - F.col("n") - F.sum("whole").over(everyone))
        .withColumn("extra", (F.row_number().over(by_rest) <= F.col("left")).cast("long"))
        .select("source", (F.col("whole") + F.col("extra") + 1).alias("share"))
    )


def period_schedule(shares_: DataFrame, period: int) -> DataFrame:
    """(source, share, turn, slot) of one period, by earliest deadline first.

    At most ``period`` rows go in, as one array, and ``period`` rows come out.
    """
    one = shares_.agg(
        F.array_sort(F.collect_list(F.struct("source", "share"))).alias("s")
    ).where(F.size("s") > 0)
    state = "named_struct('done', transform(s, x -> 0L), 'out', cast(array() as array<struct<j:int,turn:bigint>>))"
    # deadline and place of each source whose next block is released
    ready = f"""array_min(transform(s, (x, j) -> if(
        acc.done[j] < x.share and (acc.done[j] * {period}) div x.share <= t,
        named_struct('due', ((acc.done[j] + 1) * {period} + x.share - 1) div x.share, 'j', j),
        null)))"""
    step = f"""transform(array({ready}), pick -> named_struct(
        'done', transform(acc.done, (d, j) -> if(j = pick.j, d + 1L, d)),
        'out', concat(acc.out, array(named_struct('j', pick.j, 'turn', acc.done[pick.j])))))[0]"""
    return (
        one.withColumn(
            "out",
            F.expr(f"aggregate(sequence(0, {period - 1}), {state}, (acc, t) -> {step}).out"),
        )
        .select("s", F.posexplode("out").alias("slot", "o"))
        .select(
            F.expr("s[o.j].source").alias("source"),
            F.expr("s[o.j].share").alias("share"),
            F.col("o.turn").alias("turn"),
            F.col("slot").cast("long").alias("slot"),
        )
    )


def weighted_schedule(weights: list[float], blocks: list[int]) -> list[array]:
    """For each source the slots of its blocks, by earliest deadline first.

    Releases and deadlines come from the weights themselves, in whole numbers. When
    a source has no blocks left, the others start anew with their own weights.
    """
    parts = [Fraction(w) for w in weights]
    scale = lcm(*(f.denominator for f in parts))
    size = [int(f * scale) for f in parts]
    out, slot = [array("q") for _ in weights], 0
    alive = [j for j, n in enumerate(blocks) if n > 0]
    while alive:
        every, done, start = sum(size[j] for j in alive), dict.fromkeys(alive, 0), slot
        waiting, ready, ended = [(0, j) for j in alive], [], None
        while ended is None:
            while waiting and waiting[0][0] <= slot - start:
                j = heapq.heappop(waiting)[1]
                heapq.heappush(ready, (-(-(done[j] + 1) * every // size[j]), j))
            j = heapq.heappop(ready)[1]
            out[j].append(slot)
            slot += 1
            done[j] += 1
            heapq.heappush(waiting, (done[j] * every // size[j], j))
            if len(out[j]) == blocks[j]:
                ended = j
        alive.remove(ended)
    return out


def _named() -> list[Column]:
    """The source as two columns without nulls, to be joined and partitioned alike."""
    name = F.coalesce(F.col("source").cast("string"), F.lit(""))
    return [name.alias("_name"), F.col("source").isNull().alias("_nameless")]


def mix_sources(
    docs: DataFrame,
    weights: DataFrame | None = None,
    period: int | None = None,
    block_chars: int = BLOCK_CHARS,
    seed: int = 0,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Every row of ``docs`` once, with its place in the mixture.

    Returns doc_id, source, size (characters), block (number within the source,
    from 0), slot (place of that block in the mixture) and the columns named in
    ``carry``. Rows of a source stand in the order of a hash of id and seed;
    a row belongs to the block in which it starts. Training reads by slot.
    When a source has no blocks left the others go on in the shares of their own
    weights, so no row is dropped; with ``period`` its slots are left out.

    ``weights`` (source, weight > 0) names the target; without it the square
    root of each source's characters is taken. A source without a weight, and
    one with a null or non-positive weight, counts with the smallest weight
    given. A null source is a source; null and empty texts have size 0;
    repeated rows are all kept; an empty table gives an empty result. More
    sources than ``period``, or than MOST_SOURCES without one, are an error.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = docs.select(
        "doc_id",
        "source",
        F.length(text).cast("long").alias("size"),
        key.alias("_key"),
        F.md5(text).alias("_text_key"),
        F.substring(key, 1, RANGE_DIGITS).alias("_range"),
        F.struct(*(docs[c] for c in carry)).alias("_carry") if carry else F.lit(0).alias("_carry"),
    )
    sums = (
        docs.select("source", F.length(text).cast("long").alias("size"),
                    F.substring(key, 1, RANGE_DIGITS).alias("_range"))
        .groupBy("source", "_range")
        .agg(F.sum("size").alias("size"))
    )
    target = smoothed_weights(sums)
    if weights is not None:
        given = weights.where(F.col("weight") > 0).select(
            F.col("source").alias("_source"), F.col("weight").cast("double").alias("given")
        )
        least = given.agg(F.min("given").alias("least"))
        target = (
            target.join(given, F.col("source").eqNullSafe(F.col("_source")), "left")
            .join(least)
            .select("source", F.coalesce("given", "least", F.lit(1.0)).alias("weight"))
        )
    most = period or MOST_SOURCES
    if period:
        n_sources = target.limit(most + 1).count()
    else:
        of_source = sums.groupBy("source").agg(F.sum("size").alias("size")).select(
            F.col("source").alias("_sized"), "size"
        )
        known = target.join(of_source, F.col("source").eqNullSafe(F.col("_sized")))
        name = F.col("source").cast("string").alias("name")
        found = known.select(name, "weight", "size").limit(most + 1).collect()
        n_sources = len(found)
    if n_sources > most:
        raise ValueError(f"more than {most} sources: raise period or join sources first")

    before = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    place = ["_name", "_nameless", "_range"]
    offsets = sums.select(
        *_named(),
        "_range",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("_offset"),
    )
    inside = (
        Window.partitionBy(*place)
        .orderBy("_key", "_text_key")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # the rows, and the columns they carry, are dealt out once for window and join
    placed = (
        rows.select("*", *_named())
        .withColumn("_run", F.sum("size").over(inside))
        .join(offsets, place)
        .withColumn(
            "block",
            F.floor((F.col("_offset") + F.col("_run") - F.col("size")) / F.lit(block_chars)),
        )
    )
    # each source's slots by block: one row for each STRETCH of them, or one for a whole period
    if period:
        slots = period_schedule(shares(target, period), period).select(
            F.col("source").alias("_p"), "share", "turn", F.col("slot").alias("_slot")
        )
        by_source = slots.groupBy("_p", "share").agg(
            F.array_sort(F.collect_list(F.struct("turn", "_slot"))).alias("slots")
        )
        matches = F.col("source").eqNullSafe(F.col("_p"))
        turn = F.element_at("slots", (F.col("block") % F.col("share") + 1).cast("int"))["_slot"]
        slot = F.floor(F.col("block") / F.col("share")) * period + turn
    else:
        found.sort(key=lambda r: (r["name"] is not None, r["name"]))
        plan = weighted_schedule(
            [r["weight"] for r in found], [r["size"] // block_chars + 1 for r in found]
        )
        at = [(j, k) for j, own in enumerate(plan) for k in range(0, len(own), STRETCH)]
        by_source = docs.sparkSession.createDataFrame(
            pa.table(
                {
                    "_p": pa.array([found[j]["name"] for j, _ in at], pa.string()),
                    "_stretch": pa.array([k // STRETCH for _, k in at], pa.int64()),
                    "slots": pa.array(
                        [plan[j][k : k + STRETCH].tolist() for j, k in at], pa.list_(pa.int64())
                    ),
                }
            )
        )
        matches = F.col("source").cast("string").eqNullSafe(F.col("_p")) & (
            F.floor(F.col("block") / STRETCH) == F.col("_stretch")
        )
        slot = F.element_at("slots", (F.col("block") % STRETCH + 1).cast("int"))
    out = placed.join(F.broadcast(by_source), matches).withColumn("slot", slot)
    carried = [F.col(f"_carry.`{c}`").alias(c) for c in carry]
    return out.select("doc_id", "source", "size", "block", "slot", *carried)
