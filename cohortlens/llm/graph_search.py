"""Nearest neighbours by hierarchical navigable small-world graphs, one per shard.

Rows are dealt to shards of bounded size by a hash. In a shard, equal vectors
are one node; every node has a random top level, and on each level the nodes
are linked to diverse near neighbours, kept as flat arrays. A query descends
greedily from the top and searches the ground level with a bounded beam. Shards
are searched independently by all queries, block by block, and the results merged.

Inner products become distances by one more dimension, sqrt(max norm^2 - norm^2),
so that the graph's geometry agrees with the order that is asked for.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import slices
from cohortlens.session import cut_lineage

#: Rows of a shard, and queries that search it at once.
SHARD_ROWS = 8_192
QUERY_BLOCK = 512
#: Links of a node on the upper levels (twice as many on the ground) and of random ones there.
LINKS, RANDOM_LINKS = 16, 4
#: Near nodes among which a node's links are chosen.
CANDIDATES = 64
#: Nodes a search keeps in view.
BEAM = 160


def usable(vector: str) -> Column:
    """Not null, not empty, no null or non-finite component, not zero."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return F.coalesce(
        (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False)
    )


class Graph:
    """Levels of a navigable small world over the rows of ``vectors``."""

    def __init__(self, vectors: np.ndarray, seed: int = 0) -> None:
        self.vectors = vectors
        n = len(vectors)
        rng = np.random.default_rng(seed)
        norms = (vectors * vectors).sum(1)
        lifted = np.sqrt(np.maximum(norms.max() - norms, 0))
        self.points = np.hstack([vectors, lifted[:, None]]).astype(np.float32)
        top = (-np.log(rng.random(n)) / np.log(LINKS)).astype(int)
        order = np.argsort(-top, kind="stable")
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        for level in range(int(top.max()), -1, -1):
            members = order[top[order] >= level]
            self.levels.append(self._linked(members, LINKS * (1 if level else 2), rng, level == 0))
        self.entry = int(order[0])

    def _linked(self, members: np.ndarray, most: int, rng, ground: bool):
        """(row of each node or -1, flat neighbour table padded with -1) of one level."""
        n, points = len(members), self.points[members]
        squares = (points * points).sum(1)
        chosen = np.full((n, most), -1, np.int64)
        reach = min(CANDIDATES, n - 1)
        for at in range(0, n if reach else 0, 256):
            part = points[at : at + 256]
            d = squares[at : at + 256, None] + squares[None] - 2 * part @ points.T
            d[np.arange(len(part)), np.arange(at, at + len(part))] = np.inf
            near = np.argpartition(d, reach - 1, 1)[:, :reach]
            near_d = np.take_along_axis(d, near, 1)
            by = np.argsort(near_d, 1, kind="stable")
            near, near_d = np.take_along_axis(near, by, 1), np.take_along_axis(near_d, by, 1)
            chosen[at : at + 256] = self._diverse(points, near, near_d, most // 2)
        # links go both ways as far as there is room, nearest first
        a, k = np.nonzero(chosen >= 0)
        b = chosen[a, k]
        pairs = np.concatenate([np.stack([a, b], 1), np.stack([b, a], 1)])
        if ground and n > RANDOM_LINKS + 1:
            far = rng.integers(0, n, (n, RANDOM_LINKS))
            more = np.stack([np.repeat(np.arange(n), RANDOM_LINKS), far.ravel()], 1)
            pairs = np.concatenate([pairs, more[more[:, 0] != more[:, 1]]])
        pairs = np.unique(pairs, axis=0)
        d = ((points[pairs[:, 0]] - points[pairs[:, 1]]) ** 2).sum(1)
        pairs = pairs[np.lexsort((d, pairs[:, 0]))]
        rank = np.arange(len(pairs)) - np.searchsorted(pairs[:, 0], pairs[:, 0])
        room = most + (RANDOM_LINKS if ground else 0)
        # of too many links the far ones stay too: every second beyond half of the room
        count = np.bincount(pairs[:, 0], minlength=n)[pairs[:, 0]]
        late = rank - (count - room // 2)
        slot = np.where(rank < room - room // 2, rank, np.where(late >= 0, room - room // 2 + late, -1))
        slot = np.where(count <= room, rank, slot)
        keep = slot >= 0
        table = np.full((n, room), -1, np.int64)
        table[pairs[keep, 0], slot[keep]] = members[pairs[keep, 1]]
        row = np.full(len(self.points), -1, np.int64)
        row[members] = np.arange(n)
        return row, table

    @staticmethod
    def _diverse(points, near, near_d, most) -> np.ndarray:
        """Of each row's near nodes, in order, those nearer to it than to any chosen before."""
        n, reach = near.shape
        out = np.full((n, most * 2), -1, np.int64)
        taken = np.zeros(n, np.int64)
        blocked = ~np.isfinite(near_d)
        v = points[near]
        for k in range(reach):
            pick = ~blocked[:, k] & (taken < most)
            if not pick.any():
                continue
            rows = np.flatnonzero(pick)
            out[rows, taken[rows]] = near[rows, k]
            taken[rows] += 1
            between = ((v[rows] - v[rows, k][:, None]) ** 2).sum(2)
            blocked[rows] |= between < near_d[rows]
        return out

    def search(self, queries: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(node, inner product) of the best found for each query, best first, -1 for none."""
        q = queries.astype(np.float32)
        at = np.full(len(q), self.entry)
        best = (q * self.vectors[at]).sum(1)
        for row, table in self.levels[:-1]:
            moving = np.arange(len(q))
            while len(moving):
                around = table[row[at[moving]]]
                score = np.einsum("qd,qnd->qn", q[moving], self.vectors[around])
                score[around < 0] = -np.inf
                pick = score.argmax(1) if around.shape[1] else None
                value = score[np.arange(len(moving)), pick]
                better = value > best[moving]
                moved = moving[better]
                at[moved] = around[better, pick[better]]
                best[moved] = value[better]
                moving = moved
        return self._ground(q, at, best, max(beam, k), k)

    def _ground(self, q, entry, entry_score, beam, k):
        """Beam search of all queries in step: each expands its best open node."""
        table = self.levels[-1][1][self.levels[-1][0]]
        n, m = len(q), len(self.vectors)
        beam = min(beam, m)
        nodes = np.full((n, beam), -1, np.int64)
        scores = np.full((n, beam), -np.inf, np.float32)
        open_ = np.zeros((n, beam), bool)
        nodes[:, 0], scores[:, 0], open_[:, 0] = entry, entry_score, True
        seen = np.zeros((n, m), bool)
        seen[np.arange(n), entry] = True
        active = np.arange(n)
        while len(active):
            ranked = np.where(open_[active], scores[active], -np.inf)
            pick = ranked.argmax(1)
            active_ok = open_[active, pick]
            active, pick = active[active_ok], pick[active_ok]
            if not len(active):
                break
            open_[active, pick] = False
            around = table[nodes[active, pick]]
            fresh = (around >= 0) & ~seen[active[:, None], around]
            seen[np.broadcast_to(active[:, None], around.shape)[fresh], around[fresh]] = True
            value = np.einsum("qd,qnd->qn", q[active], self.vectors[np.maximum(around, 0)])
            value[~fresh] = -np.inf
            all_nodes = np.hstack([nodes[active], around])
            all_scores = np.hstack([scores[active], value.astype(np.float32)])
            all_open = np.hstack([open_[active], fresh])
            top = np.argpartition(-all_scores, beam - 1, 1)[:, :beam]
            nodes[active] = np.take_along_axis(all_nodes, top, 1)
            scores[active] = np.take_along_axis(all_scores, top, 1)
            open_[active] = np.take_along_axis(all_open, top, 1) & np.isfinite(scores[active])
            active = active[open_[active].any(1)]
        by = np.argsort(-scores, 1, kind="stable")[:, :k]
        nodes, scores = np.take_along_axis(nodes, by, 1), np.take_along_axis(scores, by, 1)
        return np.where(np.isfinite(scores), nodes, -1), scores


def search(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 20,
    beam: int = BEAM,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """The ``k`` rows (vec_id, embedding) of largest inner product for each query row.

    Returns query_id, rank (from 1), vec_id and score, the inner product of the
    vectors as given, in double precision; best first, ties to the smaller
    vec_id. A row whose id is the query's own is no candidate. Rows and queries
    with a null id, or a vector that is null, empty, zero or holds a null or
    non-finite component, take no part; rows of another length than a query are
    no candidates of it. A repeated id counts once (its smallest vector). With
    fewer candidates than ``k`` all that are found are returned. Other columns
    are ignored; empty tables give no rows.

    Every row is indexed; the result is approximate in that a search may miss a
    row. Of equal vectors the ``k`` + 1 smallest ids of a shard answer, which is
    all that can be asked for.
    """

    def clean(df: DataFrame) -> DataFrame:
        return (
            df.where(usable("embedding") & F.col("vec_id").isNotNull())
            .select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
            .groupBy("vec_id")
            .agg(F.min("embedding").alias("embedding"))
        )

    base = cut_lineage(clean(rows))
    asked = cut_lineage(clean(queries))
    shards = max(1, -(-base.count() // shard_rows))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    dealt = base.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"),
        F.lit(-1).cast("long").alias("block"),
        "vec_id",
        "embedding",
    )
    # queries go to every shard as one unit for each block, searched after the rows have come
    spread = asked.select(
        F.explode(F.expr(f"sequence(0L, {shards - 1}L)")).alias("shard"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).alias("block"),
        "vec_id",
        "embedding",
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, block, graphs = None, [], None, {}

        def built(vectors: list[tuple[int, np.ndarray]]) -> dict:
            out = {}
            for size in {len(v) for _, v in vectors}:
                ids = np.array([i for i, v in vectors if len(v) == size])
                x = np.array([v for _, v in vectors if len(v) == size])
                order = np.lexsort((ids, *x.T[::-1]))
                ids, x = ids[order], x[order]
                new = np.append(True, (x[1:] != x[:-1]).any(1))
                start = np.append(np.flatnonzero(new), len(x))
                out[size] = (Graph(x[new].astype(np.float32), seed=len(x)), x[new], ids, start)
            return out

        def found(asked: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
            out = ([], [], [])
            for size, (graph, x, ids, start) in graphs.items():
                mine = [(i, v) for i, v in asked if len(v) == size]
                if not mine:
                    continue
                q = np.array([v for _, v in mine])
                nodes, _ = graph.search(q, k + 1, beam)
                for (query, v), near in zip(mine, nodes):
                    near = near[near >= 0]
                    for node, score in zip(near, x[near] @ v):
                        some = ids[start[node] : min(start[node + 1], start[node] + k + 1)]
                        some = some[some != query]
                        out[0].extend([query] * len(some))
                        out[1].extend(some.tolist())
                        out[2].extend([float(score)] * len(some))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(out[0], pa.int64()),
                    pa.array(out[1], pa.int64()),
                    pa.array(out[2], pa.float64()),
                ],
                names=["query_id", "vec_id", "score"],
            )

        for batch in slices(batches):
            columns = (batch.column(i).to_pylist() for i in range(3))
            vectors = batch.column(3)
            flat = vectors.flatten().to_numpy()
            ends = np.cumsum(vectors.value_lengths().to_numpy())
            for s, b, i, v in zip(*columns, np.split(flat, ends[:-1])):
                if (s, b) != (shard, block):
                    if block is not None and block >= 0:
                        yield found(held)
                    elif held and s == shard:
                        graphs = built(held)
                    held = []
                    if s != shard:
                        graphs = {}
                    shard, block = s, b
                held.append((i, np.array(v)))
        if held and block >= 0:
            yield found(held)

    merged = (
        dealt.unionByName(spread)
        # a task for each shard: hashed to partitions, several would share one
        .repartitionById(shards, F.col("shard").cast("int"))
        .sortWithinPartitions("shard", "block", "vec_id")
        .mapInArrow(run, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        merged.withColumn("rank", F.row_number().over(order).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
