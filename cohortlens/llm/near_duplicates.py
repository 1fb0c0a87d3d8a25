"""N-gram Jaccard join with a MinHash LSH forest and exact verification.

A text is the set of its five-word shingles. Each tree of the forest sorts the
texts by a sequence of min-hashes; texts meet where they share a prefix of it.
Prefixes start at full depth and are shortened until a pair at the threshold
meets in some tree with the target recall. What meets is compared exactly, on
the shingle sets.

Equal sets are folded to one first, so copies cost nothing beyond that. A
crowded prefix is cut into blocks by a hash of the text, and pairs of blocks are
compared in tasks of bounded size: no pair is ever written out, only each text's
number of links and the links that hold a block's groups together. A pair that
meets in several trees is counted in the first of them.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import byte_words, slices
from cohortlens.session import cut_lineage

SHINGLE = 5
THRESHOLD = 0.8
TREES, DEPTH = 16, 8
TARGET_RECALL = 0.99998
#: Expected texts of a block of a crowded prefix.
BLOCK = 192
#: Words whose hashes a task keeps.
MEMO = 500_000

_MASK = (1 << 64) - 1
_ODD = np.array(
    [int.from_bytes(hashlib.blake2b(b"%d" % i, digest_size=8).digest(), "little") | 1
     for i in range(SHINGLE + TREES * DEPTH)],
    np.uint64,
)


def depth_for_recall(threshold: float, trees: int, depth: int, target: float) -> int:
    """Longest prefix at which a pair at ``threshold`` meets in some tree with ``target``."""
    for d in range(depth, 0, -1):
        if 1 - (1 - threshold**d) ** trees >= target:
            return d
    raise ValueError("even a prefix of one misses the target recall: use more trees")


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = h
        return h


def shingle_set(words: list[bytes], hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word runs; fewer than five words are one run."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - SHINGLE + 1)
    k = min(SHINGLE, len(h))
    return np.unique(_mix(sum(h[i : i + n] * _ODD[i] for i in range(k)) + np.uint64(k)))


def prefixes(shingles: np.ndarray, depth: int) -> np.ndarray:
    """Min-hash prefix of each tree as one number, with the tree in its lowest bits."""
    odd = _ODD[SHINGLE : SHINGLE + TREES * depth]
    least = np.full(len(odd), _MASK, np.uint64)
    for at in range(0, len(shingles), 2_048):
        part = shingles[at : at + 2_048, None] * odd
        part ^= part >> np.uint64(32)
        part *= np.uint64(0x9E3779B97F4A7C15)
        np.minimum(least, part.min(0), out=least)
    values = _mix(least.reshape(TREES, depth))
    out = np.zeros(TREES, np.uint64)
    for i in range(depth):
        out = _mix(out * np.uint64(31) + values[:, i])
    return (out & ~np.uint64(TREES - 1)) | np.arange(TREES, dtype=np.uint64)


def _read(docs: DataFrame, depth: int) -> DataFrame:
    """(rid, doc_id, text_hash, set_id, prefixes) of every row; the last two null without words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in slices(batches):
            ids, trees = [], []
            for text in batch.column(2).to_pylist():
                s = shingle_set(byte_words(text), hashes)
                digest = hashlib.blake2b(s.tobytes(), digest_size=8).digest()
                ids.append(int.from_bytes(digest, "little", signed=True) if len(s) else None)
                trees.append(prefixes(s, depth).view(np.int64).tolist() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(ids, pa.int64()),
                    pa.array(trees, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_hash", "set_id", "prefixes"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return (
        docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
        .mapInArrow(
            run, f"doc_id {id_type}, text_hash long, set_id long, prefixes array<bigint>"
        )
        .withColumn("rid", F.monotonically_increasing_id())
    )


def _shingled(texts: DataFrame) -> DataFrame:
    """(set_id, prefixes, shingles) of rows (set_id, prefixes, text).

    Equal rows, which a join on their key brings to one task, are one row here: else every
    copy of a row would go on to the key that its set is compared under.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        known: set[int] = set()
        for batch in slices(batches):
            ids = batch.column(0).to_pylist()
            new = [i for i, s in enumerate(ids) if s not in known and ids.index(s) == i]
            known.update(ids)
            if len(new) < len(ids):
                batch = batch.take(pa.array(new, pa.int32()))
            sets = [
                shingle_set(byte_words(t), hashes).tobytes() for t in batch.column(2).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sets, pa.binary())],
                names=["set_id", "prefixes", "shingles"],
            )

    return texts.select("set_id", "prefixes", "text").mapInArrow(
        run, "set_id long, prefixes array<bigint>, shingles binary"
    )


class _Group:
    """Texts that meet: up to two blocks of one prefix of one tree."""

    def __init__(self, tree: int, first: int, second: int, threshold: float) -> None:
        self.tree, self.first, self.second, self.threshold = tree, first, second, threshold
        self.ids, self.blocks, self.trees, self.sets = [], [], [], []
        self.seen: set[int] = set()

    def add(self, set_id: int, block: int, trees: list[int], shingles: bytes) -> None:
        if set_id in self.seen:  # a repeated row
            return
        self.seen.add(set_id)
        self.ids.append(set_id)
        self.blocks.append(block)
        self.trees.append(trees)
        self.sets.append(np.frombuffer(shingles, np.uint64))

    def _common(self) -> np.ndarray:
        """Number of shingles that each two sets share."""
        n = len(self.sets)
        if n == 2:
            a, b = self.sets
            shared = len(np.intersect1d(a, b, assume_unique=True))
            return np.array([[len(a), shared], [shared, len(b)]])
        owner = np.repeat(np.arange(n), [len(s) for s in self.sets])
        values = np.concatenate(self.sets)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        starts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        column = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(values))))
        often = np.diff(np.append(starts, len(values)))[column] > 1
        column, owner = column[often], owner[often]
        if len(column):
            column = np.cumsum(np.append(0, column[1:] != column[:-1]))
        out = np.zeros((n, n), np.float32)
        width = 4_096
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            lo, hi = np.searchsorted(column, [at, at + width])
            part = np.zeros((n, width), np.float32)
            part[owner[lo:hi], column[lo:hi] - at] = 1
            out += part @ part.T
        return np.rint(out).astype(np.int64)

    def links(self) -> tuple[list[int], list[int], list[int]]:
        """(set_id, n_links, leader): links new in this tree, and the least set each is joined to."""
        n = len(self.ids)
        if n < 2:
            return [], [], []
        sizes = np.array([len(s) for s in self.sets])
        shared = self._common()
        a, b = np.nonzero(np.triu(shared, 1))
        union = sizes[a] + sizes[b] - shared[a, b]
        # in whole numbers where the threshold allows: ties at the threshold count
        like = shared[a, b] >= self.threshold * union - 1e-9
        block = np.array(self.blocks)
        lo, hi = np.minimum(block[a], block[b]), np.maximum(block[a], block[b])
        like &= (lo == self.first) & (hi == self.second)
        a, b = a[like], b[like]
        if not len(a):
            return [], [], []
        trees = np.array(self.trees)
        new = (trees[a] == trees[b]).argmax(1) == self.tree
        a, b = a[new], b[new]
        if not len(a):
            return [], [], []
        count = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
        ids = np.array(self.ids)
        least = ids.copy()
        while True:
            before = least.copy()
            np.minimum.at(least, a, before[b])
            np.minimum.at(least, b, before[a])
            if (least == before).all():
                break
        some = np.flatnonzero(count)
        return ids[some].tolist(), count[some].tolist(), least[some].tolist()


def _compare(members: DataFrame, threshold: float) -> DataFrame:
    """(set_id, n_links, leader) from members sorted by (prefix, first, second)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group, out = None, None, ([], [], [])

        def ready() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in out], names=["set_id", "n_links", "leader"]
            )
            for c in out:
                c.clear()
            return batch

        def end() -> None:
            if group:
                for c, values in zip(out, group.links()):
                    c.extend(values)

        for batch in slices(batches):
            columns = [batch.column(i).to_pylist() for i in range(7)]
            for prefix, first, second, block, set_id, trees, shingles in zip(*columns):
                if now != (prefix, first, second):
                    end()
                    now = (prefix, first, second)
                    group = _Group(prefix & (TREES - 1), first, second, threshold)
                group.add(set_id, block, trees, shingles)
            if len(out[0]) > 50_000:
                yield ready()
        end()
        yield ready()

    return members.mapInArrow(run, "set_id long, n_links long, leader long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each connected component of ``edges`` (a, b), b <= a.

    Each round every node takes the least label around it, then the label of
    that label; chains shrink by half or more. Only nodes with an edge appear.
    """
    both = cut_lineage(
        edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .union(edges.select("b", "a"))
        .distinct()
    )
    labels = cut_lineage(
        both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("root"))
    )
    while True:
        around = both.join(
            labels.select(F.col("node").alias("other"), F.col("root").alias("seen")), "other"
        )
        least = around.groupBy("node").agg(F.min("seen").alias("seen"))
        hooked = labels.join(least, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "seen").alias("root")
        )
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("further"))
        moved = cut_lineage(
            hooked.join(jump, "root", "left").select(
                "node", "old", F.coalesce("further", "root").alias("root")
            )
        )
        labels = moved.select("node", "root")
        if moved.where("root <> old").limit(1).count() == 0:
            return labels


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    target_recall: float = TARGET_RECALL,
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text_hash, class_id, n_links, n_copies, first
    and worded (whether the text has a word).

    ``class_id`` is the least doc_id of the row's class: texts joined, over any
    number of steps, by a Jaccard similarity of ``threshold`` or more between
    their sets of five-word shingles. ``n_links`` counts the different sets the
    row's set is directly linked to, ``n_copies`` the rows with that very set;
    ``first`` marks one row of each class, one with its least doc_id.

    Words are runs of ASCII letters (A-Z lower-cased), digits and non-ASCII
    characters; a text of one to four words is one shingle. Null and wordless
    texts are alike to nothing: each is its own class. Repeated rows and ids are
    rows of one class; null ids come last, and a class of nothing else has a
    null class_id. Other columns are ignored; an empty table gives no rows.
    """
    depth = depth_for_recall(threshold, TREES, DEPTH, target_recall)
    rows = cut_lineage(_read(docs, depth))
    worded = rows.where("set_id is not null")

    # one row for each set and tree: the copies of a set fold on the map side
    trees = cut_lineage(
        worded.select(F.explode("prefixes").alias("prefix"), "set_id").distinct()
    )
    # texts that met in an earlier tree, all of them and no others, need not meet again
    crowds = (
        trees.groupBy("prefix")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.expr("bit_xor(xxhash64(set_id))").alias("who"),
            F.expr("bit_xor(xxhash64(set_id, 1))").alias("too"),
        )
        .where("n > 1")
        .groupBy("n", "who", "too")
        .agg(F.min_by("prefix", F.col("prefix").bitwiseAND(TREES - 1)).alias("prefix"))
        .select(
            "prefix",
            F.when(F.col("n") <= 2 * BLOCK, 1)
            .otherwise(2 * F.ceil(F.col("n") / F.lit(2 * BLOCK)))
            .cast("int")
            .alias("blocks"),
        )
    )
    met = cut_lineage(
        trees.join(crowds, "prefix")
        .withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "prefix",
            F.least("block", "other").alias("first"),
            F.greatest("block", "other").alias("second"),
            "block",
            "set_id",
        )
    )
    # one row with its text for each set that met another
    known = F.struct(F.col("doc_id").isNull(), "doc_id", "rid")
    sets = worded.groupBy("set_id").agg(
        F.min(known).alias("least"),
        F.min_by(F.struct("doc_id", "text_hash", "prefixes"), known).alias("one"),
        F.count(F.lit(1)).alias("n_copies"),
    )
    sets = cut_lineage(sets)
    wanted = (
        sets.join(met.select("set_id").distinct(), "set_id", "left_semi")
        .select(
            "set_id",
            F.col("one.doc_id").alias("w_id"),
            F.col("one.text_hash").alias("w_hash"),
            F.col("one.prefixes").alias("prefixes"),
        )
    )
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).join(
        wanted,
        F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_hash") == F.col("w_hash")),
    )
    key = ["prefix", "first", "second"]
    members = (
        met.join(_shingled(texts).withColumnRenamed("prefixes", "trees"), "set_id")
        .select(*key, "block", "set_id", "trees", "shingles")
        .repartition(*key)
        .sortWithinPartitions(*key)
    )
    found = cut_lineage(_compare(members, threshold))

    links = found.groupBy("set_id").agg(F.sum("n_links").alias("n_links"))
    roots = components(found.where("set_id <> leader").selectExpr("set_id a", "leader b"))
    marked = cut_lineage(
        sets.join(links, "set_id", "left")
        .join(roots.withColumnRenamed("node", "set_id"), "set_id", "left")
        .select(
            "set_id",
            "least",
            "n_copies",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("root", "set_id").alias("root"),
        )
    )
    classes = marked.groupBy("root").agg(F.min("least").alias("chief"))
    of_set = marked.join(classes, "root").select("set_id", "chief", "n_links", "n_copies")
    placed = (
        worded.select("rid", "doc_id", "text_hash", "set_id")
        .join(of_set, "set_id")
        .select(
            "doc_id",
            "text_hash",
            F.col("chief.doc_id").alias("class_id"),
            "n_links",
            "n_copies",
            (F.col("rid") == F.col("chief.rid")).alias("first"),
            F.lit(True).alias("worded"),
        )
    )
    alone = rows.where("set_id is null").select(
        "doc_id",
        "text_hash",
        F.col("doc_id").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"),
        F.lit(1).cast("long").alias("n_copies"),
        F.lit(True).alias("first"),
        F.lit(False).alias("worded"),
    )
    return placed.unionByName(alone)


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class of ``docs``, with all its columns; see ``near_duplicates``.

    Rows equal in id and text cannot be told apart, so any one of them stays;
    rows without words all stay. Columns of any name come back as they were.
    """

    def key(doc_id: Column, text_hash: Column) -> list[Column]:
        return [
            F.coalesce(doc_id.cast("string"), F.lit("")).alias("id"),
            F.xxhash64(text_hash, doc_id.isNull()).alias("hash"),
        ]

    stay = (
        near_duplicates(docs, threshold)
        .where("first")
        .select(*key(F.col("doc_id"), F.col("text_hash")), "worded")
        .groupBy("id", "hash")
        .agg(F.min("worded").alias("one"))
    )
    packed = docs.select(
        *key(docs["doc_id"], F.xxhash64(docs["text"])),
        F.struct(*(docs[c] for c in docs.columns)).alias("row"),
    )
    # joined and numbered on the same key: one shuffle of the texts
    nth = F.row_number().over(Window.partitionBy("id", "hash").orderBy("id", "hash"))
    return (
        packed.join(stay, ["id", "hash"])
        .withColumn("nth", nth)
        .where(~F.col("one") | (F.col("nth") == 1))
        .select("row.*")
    )
