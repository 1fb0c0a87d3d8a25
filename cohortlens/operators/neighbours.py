"""Exact k-nearest neighbours, pruned by distance to pivots.

Vectors are assigned to the region of their nearest pivot, and within it to the
cell of the nearest of the region's own pivots, which tasks choose, so cells stay
small while the driver knows the first level only. A vector first meets the
members of its own cell; the distance of its k-th neighbour found there,
together with the triangle inequality, tells which other regions, and which of
their cells, can still hold a nearer one, and only those are visited. (The scheme
is the pivot-based partitioning known from k-nearest-neighbour joins on MapReduce.)

Hot spots are split, not dropped: equal vectors are folded into one vector
with its few smallest ids, and a crowded cell is cut into blocks of bounded
size on both the asking and the answering side.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.functions.columns import seeded_key
from cohortlens.session import cut_lineage

#: Pivots of the first level, and of each region.
MAX_PIVOTS = 1024
#: Up to this many vectors the first level alone gives small cells, so each region is one.
ONE_LEVEL = 50_000
#: Fewest vectors that a cell of a region is made for.
CELL_ROWS = 64
BLOCK_VALUES = 16_384  # doubles per block, about 128 KB
BLOCK_ROWS = (32, 1024)
#: Blocks of whole regions that ask: fewest (if there are vectors for them), and doubles in one.
SHARDS, SHARD_VALUES, SHARD_ROWS = 24, 1 << 20, 64
TILE = 256  # asking vectors taken at a time
#: Share of the pairs within reach from which on all of them are taken by matrix products.
DENSE = 1 / 8
SLACK = 1e-9  # relative widening of bounds against rounding
#: Squared distances below this share of the squared lengths lose digits in a matrix product.
NEAR = 1e-6


def _distinct_vectors(points: DataFrame, id_column: str, k: int) -> DataFrame:
    """(key, features, ids): one row per vector with its k + 1 smallest ids."""
    rows = points.select(
        F.col("features").cast("array<double>").alias("features"),
        F.col(id_column).cast("bigint").alias("id"),
    )
    first_ids = W.partitionBy("features").orderBy("id")
    return (
        rows.withColumn("_place", F.row_number().over(first_ids))
        .filter(F.col("_place") <= k + 1)
        .groupBy("features")
        .agg(F.array_sort(F.collect_list("id")).alias("ids"))
        .select(F.col("ids")[0].alias("key"), "features", "ids")
    )


def _pivots(vectors: DataFrame, n: int) -> np.ndarray:
    """Vectors in hashed order, the square or cube root of n of them; bounded, so held by the driver."""
    wanted = min(MAX_PIVOTS, max(1, round(n ** (1 / 2 if n <= ONE_LEVEL else 1 / 3))))
    rows = vectors.select("key", "features").orderBy(seeded_key(1, "key"), "key").limit(wanted)
    return np.array([r["features"] for r in rows.collect()])


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All Euclidean distances, axis by axis and in place."""
    axes = zip(np.ascontiguousarray(left.T), np.ascontiguousarray(right.T))
    total = step = None
    for x, y in axes:
        step = np.subtract(x[:, None], y[None, :], out=step)
        np.multiply(step, step, out=step)
        if total is None:
            total, step = step, None
        else:
            total += step
    if total is None:
        return np.zeros((len(left), len(right)))
    return np.sqrt(total, out=total)


def paired_distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Distances of rows to rows of the same place, to the last bit those of ``distances``."""
    gap = np.ascontiguousarray((left - right).T)
    gap *= gap
    for step in gap[1:]:
        gap[0] += step
    return np.sqrt(gap[0]) if len(gap) else np.zeros(len(left))


def product_sides(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Matrices whose product ``a @ b.T`` holds all squared distances.

    Rows should lie about the origin: rounding is in proportion to their squared lengths.
    """
    a = np.column_stack([left * -2.0, (left * left).sum(1), np.ones(len(left))])
    return a, np.column_stack([right, np.ones(len(right)), (right * right).sum(1)])


def rooted(total: np.ndarray, far: float, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Distances from squared ones in place, to nine digits; ``far`` is the greatest sum of two squared lengths.

    Pairs so near that rounding would show are taken axis by axis.
    """
    flat = total.reshape(-1)
    near = np.flatnonzero(flat <= NEAR * far)
    if len(near) > len(flat) // 8:
        total[:] = distances(left, right)
        return total
    flat[near] = 0.0
    np.sqrt(total, out=total)
    if len(near):
        at, to = np.divmod(near, len(right))
        flat[near] = paired_distances(left[at], right[to])
    return total


def _to_regions(vectors: DataFrame, pivots: np.ndarray, counter) -> DataFrame:
    """Adds the nearest pivot's number and distance."""

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            regions, radii = [], []
            for start in range(0, len(batch), 1024):
                x = np.vstack(batch["features"].iloc[start : start + 1024].to_numpy())
                gap = distances(x, pivots)
                regions.append(gap.argmin(axis=1))
                radii.append(gap.min(axis=1))
            if regions:
                _add(counter, len(batch) * len(pivots))
                yield batch.assign(region=np.concatenate(regions), radius=np.concatenate(radii))

    return vectors.mapInPandas(
        nearest, "key long, features array<double>, ids array<long>, region int, radius double"
    )


def _add(counter, n: int) -> None:
    if counter is not None:
        counter.add(n)


def _by_region(rows: DataFrame, block_rows: int, *columns: str) -> DataFrame:
    """Rows per region in blocks of bounded size: region, x (flat) and arrays of columns."""
    packed = (
        rows.join(block_counts(rows, block_rows, "region"), "region")
        .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")))
        .groupBy("region", "block")
        .agg(F.collect_list(F.struct("features", *columns)).alias("rows"))
    )
    return packed.select(
        "region", F.flatten("rows.features").alias("x"), *(F.col(f"rows.{c}").alias(c) for c in columns)
    )


def _second_pivots(regions: DataFrame, sizes: dict[int, int], cell_rows: int) -> DataFrame:
    """(region, s_x): vectors in hashed order, one for about ``cell_rows`` of the region's."""
    wanted = F.create_map(
        *(F.lit(v) for r, n in sizes.items() for v in (r, min(MAX_PIVOTS, max(1, n // cell_rows))))
    )
    order = seeded_key(2, "key")
    by = W.partitionBy("region").orderBy(order, "key")
    return (
        regions.withColumn("_place", F.row_number().over(by))
        .filter((F.col("_place") <= MAX_PIVOTS) & (F.col("_place") <= wanted[F.col("region")]))
        .groupBy("region")
        .agg(F.array_sort(F.collect_list(F.struct("_place", "features"))).alias("s"))
        .select("region", F.flatten("s.features").alias("s_x"))
    )


def _to_cells(regions: DataFrame, pivots: DataFrame, block_rows: int, counter) -> DataFrame:
    """(key, cell, radius): the nearest second-level pivot of each vector's region."""

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                x = row.x.reshape(len(row.key), -1)
                gap = distances(x, row.s_x.reshape(-1, x.shape[1]))
                _add(counter, gap.size)
                cell = np.int64(row.region) * MAX_PIVOTS + gap.argmin(axis=1)
                yield pd.DataFrame({"key": row.key, "cell": cell, "radius": gap.min(axis=1)})

    return (
        _by_region(regions, block_rows, "key")
        .join(pivots, "region")
        .mapInPandas(nearest, "key long, cell long, radius double")
    )


def block_counts(rows: DataFrame, block_rows: int, by: str = "cell") -> DataFrame:
    """(by, blocks): one row per first-level pivot, so at most MAX_PIVOTS rows to broadcast."""
    return F.broadcast(
        rows.groupBy(by).agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("blocks"))
    )


def _crowded(rows: DataFrame, block_rows: int) -> DataFrame:
    """(cell, blocks) of the cells with more rows than a block; Spark decides how to join it."""
    return (
        rows.groupBy("cell")
        .agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("blocks"))
        .filter("blocks > 1")
    )


def _packed(rows: DataFrame, block_rows: int, prefix: str, answers: bool) -> DataFrame:
    """Rows of one cell packed into blocks of about ``block_rows``.

    The number of blocks per cell follows from its row count, so a cell that
    holds most of the rows becomes many blocks.
    """
    packed = (
        rows.join(_crowded(rows, block_rows), "cell", "left")
        .withColumn("block", F.pmod(F.xxhash64("key"), F.coalesce("blocks", F.lit(1))))
        .groupBy("cell", "block")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("key", "features", *(["ids"] if answers else [])))
            ).alias("rows")
        )
    )
    columns = [
        "cell",
        "block",
        F.transform("rows", lambda r: r["key"]).alias(f"{prefix}_keys"),
        F.flatten(F.transform("rows", lambda r: r["features"])).alias(f"{prefix}_x"),
    ]
    if answers:
        columns += [
            F.flatten(F.transform("rows", lambda r: r["ids"])).alias(f"{prefix}_ids"),
            F.transform("rows", lambda r: F.size(r["ids"])).alias(f"{prefix}_counts"),
        ]
    return packed.select(*columns)


def _nearest_in_block(k: int, counter):
    """Kernel: the k + 1 nearest ids of each asking vector within one block."""

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                asking = row.q_x.reshape(len(row.q_keys), -1)
                answering = row.a_x.reshape(len(row.a_counts), -1)
                gap = np.repeat(distances(asking, answering), row.a_counts, axis=1)
                _add(counter, len(asking) * len(answering))
                if gap.shape[1] > k + 1:
                    # ties at the k + 1st distance stay in until ids decide
                    bound = np.partition(gap, k, axis=1)[:, k]
                else:
                    bound = np.full(len(gap), np.inf)
                at, place = np.nonzero(gap <= bound[:, None])
                ids, near = row.a_ids[place], gap[at, place]
                order = np.lexsort((ids, near, at))
                ids, near = ids[order], near[order]
                starts = np.searchsorted(at, np.arange(len(gap)))
                ends = np.minimum(starts + k + 1, np.append(starts[1:], len(at)))
                for key, a, b in zip(row.q_keys, starts, ends):
                    out.append((key, ids[a:b], near[a:b]))
            yield pd.DataFrame(out, columns=["key", "ids", "distances"])

    return nearest


def _best(found: DataFrame, k: int) -> DataFrame:
    """(key, neighbours): the k + 1 nearest over all visited blocks.

    ``row_number() <= k + 1`` is applied before the shuffle as well.
    """
    pairs = found.select(
        "key", F.inline(F.arrays_zip(F.col("distances").alias("distance"), F.col("ids").alias("id")))
    )
    order = W.partitionBy("key").orderBy("distance", "id")
    return (
        pairs.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= k + 1)
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("distance", "id"))).alias("neighbours"))
    )


def _shards(pivots: np.ndarray, sizes: dict[int, int], count: int) -> tuple[np.ndarray, np.ndarray]:
    """First shard of each region and its number of them, about ``count`` even shards in all.

    Small regions share a shard with others near them, a large one is several shards.
    """
    first, parts = np.zeros(len(pivots), np.int64), np.ones(len(pivots), np.int64)
    target, shard, held = -(-sum(sizes.values()) // count), 0, 0
    for r in np.argsort(((pivots - pivots[0]) ** 2).sum(1), kind="stable"):
        n = sizes.get(int(r), 0)
        if held and held + n > target:
            shard, held = shard + 1, 0
        first[r], parts[r] = shard, max(1, -(-n // target))
        held += n
        if parts[r] > 1:
            shard, held = shard + parts[r], 0
    return first, parts


def _reached(pivots: np.ndarray, radii: np.ndarray, counter):
    """Kernel: (block, region) of regions that may hold a neighbour of a block within its known bounds."""

    def reached(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 1024):
                part = batch.iloc[start : start + 1024]
                least = distances(np.vstack(part["features"].to_numpy()), pivots) - radii
                _add(counter, least.size)
                bound = part["bound"].to_numpy() * (1 + SLACK)
                at, region = np.nonzero((least <= bound[:, None] + SLACK) & (radii >= 0))
                found = pd.DataFrame({"block": part["block"].to_numpy()[at], "region": region})
                yield found.drop_duplicates()

    return reached


def _least(at, ids, near, k: int):
    """The k + 1 nearest (then least) ids of each asking row, in order."""
    order = np.lexsort((ids, near, at))
    at, ids, near = at[order], ids[order], near[order]
    place = np.arange(len(at)) - np.searchsorted(at, at)
    kept = place <= k
    return at[kept], ids[kept], near[kept], place[kept]


def _nearest_to_block(k: int, counter):
    """Kernel: the k + 1 nearest ids of each vector of a block, while others pass by cell.

    The block's own vectors come first, each with a bound that its neighbours do not exceed.
    """

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        block = None
        for batch in batches:
            passing = batch.column("passing").to_numpy(zero_copy_only=False)
            for side in (False, True):
                part = batch.filter(pa.array(passing == side))
                if not part.num_rows:
                    continue
                x = part.column("features").flatten().to_numpy(zero_copy_only=False)
                x, cell = x.reshape(part.num_rows, -1), part.column("cell").to_numpy()
                if not side:
                    held.append((x, cell, part.column("bound").to_numpy(zero_copy_only=False)))
                    continue
                if block is None:
                    block = _Block(*map(np.concatenate, zip(*held)), k, counter)
                ids = part.column("ids")
                counts = np.diff(ids.offsets.to_numpy())
                block.meet(x, cell, ids.flatten().to_numpy(), counts)
        if block is not None:
            yield from block.lists()

    return nearest


class _Block:
    """Asking vectors, the neighbours found for them so far, and bounds that shrink with those."""

    def __init__(self, x: np.ndarray, cell: np.ndarray, bound: np.ndarray, k: int, counter) -> None:
        order = np.argsort(cell, kind="stable")
        self.x, self.bound, self.k, self.counter = x[order], bound[order].copy(), k, counter
        self.centre = x.mean(axis=0)
        near = self.x - self.centre
        self.left, _ = product_sides(near, near[:0])
        self.tiles = [slice(t, t + TILE) for t in range(0, len(x), TILE)]
        self.found: list[list[tuple]] = [[] for _ in self.tiles]
        self.held = np.zeros(len(self.tiles), np.int64)
        self.gap = np.empty(2 * TILE * TILE)

    def meet(self, y: np.ndarray, cell: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Looks for neighbours among vectors ``y``, which lie by cell."""
        firsts = np.cumsum(counts) - counts
        starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        sizes = np.diff(np.append(starts, len(y)))
        centres = np.add.reduceat(y, starts) / sizes[:, None]
        off = np.sqrt(((y - np.repeat(centres, sizes, axis=0)) ** 2).sum(1))
        radii = np.maximum.reduceat(off, starts)
        radii += SLACK * (1 + radii + np.abs(centres).max(axis=1))
        _, right = product_sides(self.left[:0, :-2], y - self.centre)
        for t, mine in enumerate(self.tiles):
            x, bound = self.x[mine], self.bound[mine]
            reach = distances(x, centres) - radii <= bound[:, None] * (1 + SLACK) + SLACK
            _add(self.counter, reach.size)
            some = np.flatnonzero(reach.any(axis=0))
            if not len(some):
                continue
            if (reach @ sizes).sum() > DENSE * len(x) * len(y):
                for lo in range(0, len(y), 2 * TILE):
                    part = slice(lo, lo + 2 * TILE)
                    _add(self.counter, len(x) * len(y[part]))
                    at, to = self._candidates(self.left[mine], right[part], bound)
                    self._keep(t, x, bound, y, at, lo + to, ids, firsts, counts)
            else:
                for c in some:
                    asking = np.flatnonzero(reach[:, c])
                    for lo in range(starts[c], starts[c] + sizes[c], TILE):
                        hi = min(lo + TILE, starts[c] + sizes[c])
                        gap = distances(x[asking], y[lo:hi])
                        _add(self.counter, gap.size)
                        at, to = np.nonzero(gap <= bound[asking, None])
                        self._keep(t, x, bound, y, asking[at], lo + to, ids, firsts, counts)

    def _candidates(self, left: np.ndarray, right: np.ndarray, bound: np.ndarray):
        """Pairs whose squared distance by a product is within the bound, or above by rounding at most."""
        far = left[:, -2].max() + right[:, -1].max()
        wide = bound * bound * (1 + SLACK) + 4 * np.finfo(float).eps * (right.shape[1] + 4) * far
        left = left.copy()
        left[:, -2] -= wide
        gap = self.gap[: len(left) * len(right)]
        np.matmul(left, right.T, out=gap.reshape(len(left), -1))
        return np.divmod(np.flatnonzero(gap <= 0), len(right))

    def _keep(self, t: int, x, bound, y, at, to, ids, firsts, counts) -> None:
        near = paired_distances(x[at], y[to])
        within = near <= bound[at]
        at, to, near = at[within], to[within], near[within]
        times = counts[to]
        found = self.found[t]
        found.append((np.repeat(at, times), ids[_spans(firsts[to], times)], np.repeat(near, times)))
        self.held[t] += times.sum()
        if self.held[t] > 4 * TILE * (self.k + 1):
            self._settle(t, bound)

    def _settle(self, t: int, bound: np.ndarray) -> tuple:
        at, ids, near, place = _least(*map(np.concatenate, zip(*self.found[t])), self.k)
        full = place == self.k
        bound[at[full]] = np.minimum(bound[at[full]], near[full])
        self.found[t], self.held[t] = [(at, ids, near)], 0
        return at, ids, near

    def lists(self) -> Iterator[pa.RecordBatch]:
        for t, mine in enumerate(self.tiles):
            if not self.found[t]:
                continue
            at, ids, near = self._settle(t, self.bound[mine])
            x = self.x[mine]
            width = x.shape[1]
            ends = np.searchsorted(at, np.arange(len(x) + 1))
            pairs = pa.StructArray.from_arrays(
                [pa.array(near, pa.float64()), pa.array(ids, pa.int64())], names=["distance", "id"]
            )
            vectors = pa.ListArray.from_arrays(
                np.arange(0, (len(x) + 1) * width, max(width, 1), dtype=np.int32)[: len(x) + 1], x.reshape(-1)
            )
            yield pa.RecordBatch.from_arrays(
                [vectors, pa.ListArray.from_arrays(ends.astype(np.int32), pairs)],
                names=["features", "neighbours"],
            )


def _spans(firsts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """firsts[0], .., firsts[0] + lengths[0] - 1, firsts[1], .."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(firsts - before, lengths) + np.arange(lengths.sum())


def nearest_lists(
    points: DataFrame, k: int, id_column: str = "id", counter: Accumulator | None = None
) -> DataFrame:
    """(features, neighbours): per distinct vector its k + 1 nearest (distance, id).

    The list includes the vector's own ids at distance 0; ties go to the
    smaller id. ``counter`` adds up the distances that were computed.
    """
    vectors = _distinct_vectors(points, id_column, k)
    shape = vectors.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("d")
    ).first()
    low, high = BLOCK_ROWS
    block_rows = min(high, max(low, BLOCK_VALUES // max(shape["d"] or 1, 1)))
    pivots = _pivots(vectors, shape["n"])
    # all tables below are read several times, so they are written once
    regions = cut_lineage(_to_regions(vectors, pivots, counter))
    radii, sizes = np.full(len(pivots), -1.0), {}
    for row in regions.groupBy("region").agg(
        F.max("radius").alias("radius"), F.count(F.lit(1)).alias("rows")
    ).collect():  # one row per pivot
        radii[row["region"]], sizes[row["region"]] = row["radius"], row["rows"]
    if not sizes:
        return vectors.select(
            "features", F.expr("cast(array() as array<struct<distance:double,id:bigint>>)").alias("neighbours")
        )
    two_levels = shape["n"] > ONE_LEVEL
    cells = regions.withColumn("cell", F.col("region").cast("long") * MAX_PIVOTS)
    if two_levels:
        cell_rows = max(CELL_ROWS, round(shape["n"] ** (1 / 3)))
        inner = cut_lineage(_second_pivots(regions, sizes, cell_rows))
        cells = cut_lineage(
            regions.drop("radius").join(_to_cells(regions, inner, block_rows, counter), "key")
        )

    answers = _packed(cells, block_rows, "a", answers=True)
    kernel = _nearest_in_block(k, counter)
    schema = "key long, ids array<long>, distances array<double>"

    def visit(asking: DataFrame) -> DataFrame:
        # every block of a cell that asks meets every block that answers as a pair of its
        # own key, so that the pairs of a crowded cell spread over the tasks
        asked = (
            _packed(asking, block_rows, "q", answers=False)
            .drop("block")
            .join(_crowded(cells, block_rows), "cell", "left")
            .withColumn(
                "block", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
            )
            .drop("blocks")
        )
        return (
            asked.join(answers, ["cell", "block"])
            .drop("cell", "block")
            .mapInPandas(kernel, schema)
        )

    own = cut_lineage(_best(visit(cells), k))
    bounded = cells.join(own, "key").select(
        "key",
        "features",
        "cell",
        "region",
        F.when(
            F.size("neighbours") > k, F.element_at("neighbours", -1)["distance"]
        ).otherwise(F.lit(math.inf)).alias("bound"),
    )
    count = max(
        -(-shape["n"] * max(shape["d"], 1) // SHARD_VALUES), min(SHARDS, -(-shape["n"] // SHARD_ROWS))
    )
    first, parts = _shards(pivots, sizes, count)
    firsts, splits = (F.array(*map(F.lit, v.tolist())) for v in (first, parts))
    part = F.pmod(F.xxhash64("cell" if two_levels else "key"), splits[F.col("region")])
    asking = bounded.withColumn("block", firsts[F.col("region")] + part)
    # one row per block and region at most
    reached = cut_lineage(
        asking.select("block", "features", "bound")
        .mapInPandas(_reached(pivots, radii, counter), "block long, region int")
        .distinct()
    )
    no_ids = F.lit(None).cast("array<long>").alias("ids")
    held = asking.select("block", F.lit(False).alias("passing"), "cell", "features", "bound", no_ids)
    passing = cells.join(F.broadcast(reached), "region").select(
        "block",
        F.lit(True).alias("passing"),
        "cell",
        "features",
        F.lit(None).cast("double").alias("bound"),
        "ids",
    )
    return (
        held.unionByName(passing)
        # a partition for each block
        .repartitionById(int((first + parts).max()), F.col("block").cast("int"))
        .sortWithinPartitions("passing", "cell")
        .drop("block")
        .mapInArrow(
            _nearest_to_block(k, counter),
            "features array<double>, neighbours array<struct<distance:double,id:bigint>>",
        )
    )


def _per_point(points: DataFrame, k: int, id_column: str) -> tuple[DataFrame, Column]:
    rows = points.select(
        F.col(id_column).cast("bigint").alias("src"),
        F.col("features").cast("array<double>").alias("features"),
    )
    others = F.slice(F.filter("neighbours", lambda x: x["id"] != F.col("src")), 1, k)
    return rows.join(nearest_lists(points, k, id_column), "features"), others


def knn_graph(points: DataFrame, k: int = 10, id_column: str = "id") -> DataFrame:
    """(src, rank, dst, distance): the k nearest other points of each point."""
    if k <= 0:
        raise ValueError("k must be positive")
    joined, others = _per_point(points, k, id_column)
    return joined.select("src", F.posexplode(others)).select(
        "src",
        (F.col("pos") + 1).alias("rank"),
        F.col("col.id").alias("dst"),
        F.col("col.distance").alias("distance"),
    )


def core_distances(points: DataFrame, k: int, id_column: str = "id") -> DataFrame:
    """(id, core_distance): distance to the k-th nearest point, itself counted."""
    joined, others = _per_point(points, k, id_column)
    if k == 1:
        return joined.select(F.col("src").alias("id"), F.lit(0.0).alias("core_distance"))
    return joined.select(
        F.col("src").alias("id"), F.element_at(others, k - 1)["distance"].alias("core_distance")
    )
