"""Merkle manifest of a data set, by time-forward processing.

Nodes carry labels: the place of their last leaf, then their level. A sweep
over ascending labels meets every child before its parent; a node's digest waits
in a priority queue, ordered by label, until the sweep reaches the parent. The
reversed sweep meets every parent before its children and delivers to each
child the suffix of its proof. Blocks of 8**4 consecutive nodes are swept by
one task each. Messages across blocks are rows, which Spark's external sort brings
to the receiving block in the order of their labels; so no task holds more than a
block, whatever the size of a tree.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cohortlens.llm.places import batched, in_groups, placed, runs
from cohortlens.session import cut_lineage

#: Fixed value: children of a node.
ARITY = 8
#: Levels that one task climbs; a block has ARITY ** LEVELS nodes.
LEVELS = 4
#: Characters of a digest.
WIDTH = 64

Path = tuple[str, tuple[int, ...]]


def _digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")
    )


def leaf_digest(*values: Column) -> Column:
    """sha256 of the values, each ``-`` if null, else byte count, ``:`` and value."""
    return F.sha2(F.concat(*(_field(v) for v in values)), 256)


def height(size: int, most: int) -> int:
    """Levels above ``size`` nodes, ``most`` of them at most."""
    levels = 0
    while levels < most and ARITY**levels < size:
        levels += 1
    return levels


def sweep_up(digests: list[str], levels: int) -> tuple[str, dict[tuple[int, int], list[str]]]:
    """The top of a block's nodes and the children of each inner node (level, place)."""
    last_leaf = len(digests) - 1
    queue: list[tuple[int, int, int, str]] = []
    children: dict[tuple[int, int], list[str]] = {}
    top = digests[0]

    def send(level: int, place: int, digest: str) -> None:
        parent, span = place // ARITY, ARITY ** (level + 1)
        label = min((parent + 1) * span - 1, last_leaf)
        heapq.heappush(queue, (label, level + 1, place, digest))

    for leaf, digest in enumerate(digests):
        if levels:
            send(0, leaf, digest)
        # all nodes whose last leaf has been seen
        while queue and queue[0][0] <= leaf:
            label, level, place, _ = queue[0]
            run = []
            while queue and queue[0][:2] == (label, level):
                run.append(heapq.heappop(queue)[3])
            node = place // ARITY
            children[level, node] = run
            top = _digest("".join(run))
            if level < levels:
                send(level, node, top)
    return top, children


def sweep_down(digests: list[str], levels: int, path: Path) -> Iterator[tuple[int, Path]]:
    """(place, path) of each of a block's nodes, last first; ``path`` is that of their top.

    A path is the siblings' digests from the node up, in one string, and for each
    level the node's slot and the number of children there.
    """
    _, children = sweep_up(digests, levels)
    last_leaf = len(digests) - 1
    queue: list[tuple[int, int, int, Path]] = [(-last_leaf, -levels, 0, path)]
    while queue:
        _, level, place, (suffix, shape) = heapq.heappop(queue)
        if level == 0:
            yield place, (suffix, shape)
            continue
        run = children[-level, place]
        whole, span = "".join(run), ARITY ** (-level - 1)
        for slot in range(len(run)):
            child = place * ARITY + slot
            siblings = whole[: slot * WIDTH] + whole[(slot + 1) * WIDTH :]
            label = min((child + 1) * span - 1, last_leaf)
            message = (siblings + suffix, (slot, len(run), *shape))
            heapq.heappush(queue, (-label, level + 1, child, message))


def fold(digest: str, proof: str, shape: Iterable[int]) -> str:
    """The root that ``digest`` and a path lead to."""
    shape, at = list(shape), 0
    for slot, count in zip(shape[::2], shape[1::2]):
        left, right = at + slot * WIDTH, at + (count - 1) * WIDTH
        digest = _digest(proof[at:left] + digest + proof[left:right])
        at = right
    return digest


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def _climb(nodes: DataFrame, kind: str, levels: int) -> DataFrame:
    """The tops of all blocks of ``nodes`` (tree, n, size, digest), again as nodes."""
    span = ARITY**levels
    schema = f"tree {kind}, n long, size long, digest string"
    out = _arrow(schema)

    def tops(batches):
        for (tree, block), rows in runs(batches, 2):
            size = rows[0][1]
            top, _ = sweep_up([r[2] for r in rows], height(size, levels))
            yield tree, block, -(-size // span), top

    keyed = nodes.select("tree", F.expr(f"n div {span}").alias("block"), "n", "size", "digest")
    return in_groups(keyed, "tree", "block").mapInArrow(lambda b: batched(tops(b), out), schema)


def _descend(
    nodes: DataFrame, paths: DataFrame, kind: str, carried: str, levels: int
) -> DataFrame:
    """Paths of ``nodes`` (tree, n, size, digest, claim, carry) from those of their blocks' tops.

    ``paths`` has tree, n (the block), proof, shape, subroot, root. A null
    subroot makes each node the subroot of a tree of its own. ``folded`` is the
    root that ``claim`` leads to along the path.
    """
    span = ARITY**levels
    columns = (
        f"tree {kind}, n long, digest string, proof string, shape array<int>, "
        f"subroot string, root string, folded string, carry {carried}"
    )
    out = _arrow(columns)
    header = paths.select(
        "tree", F.col("n").alias("block"), F.lit(-1).cast("long").alias("n"), "proof", "shape",
        "subroot", "root",
    )
    keyed = nodes.select(
        "tree", F.expr(f"n div {span}").alias("block"), "n", "size", "digest", "claim", "carry"
    )
    both = header.unionByName(keyed, allowMissingColumns=True).select(
        "tree", "block", "n", "proof", "shape", "subroot", "root", "size", "digest", "claim", "carry"
    )

    def found(batches):
        for (tree, _), ((_, proof, shape, subroot, root, *_), *rows) in runs(batches, 2):
            digests = [r[6] for r in rows]
            above = (proof, tuple(shape))
            for place, (proof_, shape_) in sweep_down(digests, height(rows[0][5], levels), above):
                n, *_, digest, claim, carry = rows[place]
                yield (
                    tree, n, digest, proof_, list(shape_), subroot or digest, root,
                    fold(claim, proof_, shape_), carry,
                )

    # a path of a few thousand characters goes with each row
    return in_groups(both, "tree", "block").mapInArrow(
        lambda b: batched(found(b), out, most=512), columns
    )


def prove(
    leaves: DataFrame,
    tree: str = "lang",
    order: tuple[str, ...] = ("doc_id",),
    levels: int = LEVELS,
) -> DataFrame:
    """For each row of ``leaves`` its place in the manifest and its proof.

    ``leaves`` has the columns of ``tree`` and ``order``, ``leaf`` (a digest) and
    ``claim`` (a digest to check, often the same). Returns carry (the row as a struct), n
    (place in its tree), proof, shape, subroot, root and folded. The leaves of each
    tree value ascend by ``order`` (nulls first), then by digest; runs of ARITY nodes
    become their digest until one is left, the subroot, a lone leaf itself.
    Subroots, ordered by tree value (null first), likewise give the root. ``proof`` holds
    the siblings' digests from the leaf to the root, ``shape`` slot and number
    of children for each level; ``folded`` is the root that ``claim`` leads to.

    Repeated rows are leaves side by side; ties in the order never change
    digests of a tree, as they are settled by the leaf digest. A tree of any size is
    cut into blocks, a tree value that holds most rows too. Text is read once, to make
    the leaf digests, and its length does not matter here. All columns come back
    within ``carry``, so no name can clash. An empty table gives no rows.
    """
    kind = leaves.schema[tree].dataType.simpleString()
    carried = f"struct<{', '.join(f'`{f.name}`: {f.dataType.simpleString()}' for f in leaves.schema)}>"
    rows = cut_lineage(
        leaves.select(
            F.col(tree).alias("tree"),
            *(F.col(c).alias(f"o{i}") for i, c in enumerate(order)),
            F.col("leaf").alias("digest"),
            "claim",
            F.struct(*(leaves[c] for c in leaves.columns)).alias("carry"),
        )
    )
    nodes = placed(rows, "tree", *(f"o{i}" for i in range(len(order))), "digest")
    nodes = cut_lineage(nodes.select("tree", "n", "size", "digest", "claim", "carry"))
    plain = nodes.select("tree", "n", "size", "digest")
    rounds = _all_rounds(plain, kind, levels)

    # the tree over the subroots has no tree value; its leaves keep theirs as what they carry
    subroots = rounds.pop().select(F.lit(0).alias("tree"), F.col("tree").alias("carry"), "digest")
    over = placed(subroots, "tree", "carry")
    over = cut_lineage(over.withColumn("claim", F.col("digest")))
    above = _all_rounds(over.select("tree", "n", "size", "digest"), "int", levels)

    root = above.pop()
    paths = root.select(
        "tree", "n", F.lit("").alias("proof"), F.expr("cast(array() as array<int>)").alias("shape"),
        F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"),
    )
    message = "tree", "n", "proof", "shape", "subroot", "root"
    for level in reversed(above[1:]):
        # within the tree over the subroots nothing is a subroot yet
        down = _descend(_bare(level), paths, "int", "int", levels)
        down = down.withColumn("subroot", F.lit(None).cast("string"))
        paths = cut_lineage(down.select(*message))
    down = _descend(over, paths, "int", kind, levels)
    paths = cut_lineage(
        down.select(
            F.col("carry").alias("tree"), F.lit(0).cast("long").alias("n"), "proof", "shape",
            "subroot", "root",
        )
    )
    for level in reversed(rounds[1:]):
        paths = cut_lineage(_descend(_bare(level), paths, kind, "int", levels).select(*message))
    return _descend(nodes, paths, kind, carried, levels).select(
        "carry", "n", "proof", "shape", "subroot", "root", "folded"
    )


def _bare(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("claim", F.col("digest")).withColumn("carry", F.lit(None).cast("int"))


def _all_rounds(nodes: DataFrame, kind: str, levels: int) -> list[DataFrame]:
    """``nodes``, their blocks' tops, the tops of those, and so on to one node for each tree."""
    rounds = [nodes]
    while True:
        rounds.append(cut_lineage(_climb(rounds[-1], kind, levels)))
        if (rounds[-1].agg(F.max("size")).first()[0] or 1) <= 1:
            return rounds
