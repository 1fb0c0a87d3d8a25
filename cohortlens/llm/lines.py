"""Line dedup that can be undone, with sharded cuckoo filters over exact counts.

An index of lines keeps, as tables in a folder,

* ``refs``: which document holds which line key, one row for each pair;
* ``counts``: for each key in how many documents it is, and the largest id;
* ``filters``: cuckoo filters for each shard of the keys, at two levels: of all keys that
  occur, and of those that occur in enough documents to be dropped elsewhere.

A key that misses a filter is certain to be new, or certain to stay, and needs no
look-up; one that hits is settled by the exact counts. Each distinct key stands in a
filter once, so the deletion of documents takes exactly their keys out again.
Updates are versions; a version counts once its row is in ``log``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cohortlens.llm.common import ascii_lower, slices
from cohortlens.llm.places import batched, in_groups
from cohortlens.session import cut_lineage, scratch_path

#: White space around a line, code points of a key that counts, and
#: documents from which on it is dropped.
BLANKS = " \t\n\x0b\x0c\r"
LEAST_CHARS, LEAST_DOCS = 20, 3
#: Entries of a bucket, moves of a displaced entry, and the load beyond which a filter grows.
SLOTS, MOVES, LOAD = 4, 500, 0.85
#: Keys that a shard is made for.
SHARD_KEYS = 1 << 16
#: Bytes of all filters of the second level up to which every task gets them.
FILTER_BYTES = 64 * 1024 * 1024
#: Keys so frequent that there cannot be more than this many are joined by broadcast.
HEAVY_KEYS = 50_000

_U = np.uint64


class Cuckoo:
    """Buckets of 16-bit fingerprints; each key has two buckets and an entry in one of them."""

    def __init__(self, table: np.ndarray) -> None:
        self.table = table

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        buckets = 4
        while buckets * SLOTS * LOAD < keys:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def read(cls, cells: bytes) -> Cuckoo:
        return cls(np.frombuffer(cells, np.uint16).reshape(-1, SLOTS).copy())

    def write(self) -> bytes:
        return self.table.tobytes()

    @property
    def room(self) -> int:
        return int(self.table.size * LOAD)

    def _marks(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint (never 0) and first bucket of each key."""
        marks = (keys >> _U(48)).astype(np.uint16)
        marks[marks == 0] = 1
        return marks, (keys & _U(len(self.table) - 1)).astype(np.int64)

    def _other(self, marks: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """The second bucket of an entry; the first one, given the second."""
        spread = (marks.astype(_U) * _U(0x9E3779B97F4A7C15)) >> _U(32)
        return bucket ^ (spread & _U(len(self.table) - 1)).astype(np.int64)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        marks, bucket = self._marks(keys)
        found = (self.table[bucket] == marks[:, None]).any(1)
        return found | (self.table[self._other(marks, bucket)] == marks[:, None]).any(1)

    def _settle(self, marks: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Puts entries into free places of their buckets; returns which found none."""
        order = np.argsort(bucket, kind="stable")
        at, first = np.unique(bucket[order], return_index=True)
        rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        free = self.table[bucket[order]] == 0
        place = np.cumsum(free, axis=1) == (rank + 1)[:, None]
        place &= free
        ok = place.any(1)
        self.table[bucket[order][ok], place[ok].argmax(1)] = marks[order][ok]
        left = np.ones(len(order), bool)
        left[order[ok]] = False
        return left

    def insert(self, keys: np.ndarray) -> bool:
        """Adds distinct keys; False, with the table unusable, if no way was found for one."""
        marks, bucket = self._marks(keys)
        left = self._settle(marks, bucket)
        marks, bucket = marks[left], self._other(marks[left], bucket[left])
        rng = np.random.default_rng(len(keys))
        for _ in range(MOVES):
            if not len(marks):
                return True
            left = self._settle(marks, bucket)
            marks, bucket = marks[left], bucket[left]
            # one entry for each full bucket takes the place of another, which moves on
            _, one = np.unique(bucket, return_index=True)
            slot = rng.integers(0, SLOTS, len(one))
            out = self.table[bucket[one], slot]
            self.table[bucket[one], slot] = marks[one]
            marks[one] = out
            bucket[one] = self._other(out, bucket[one])
        return not len(marks)

    def remove(self, keys: np.ndarray) -> None:
        """Takes one entry of each key out; the keys must have been added."""
        for mark, bucket in zip(*self._marks(keys)):
            other = self._other(np.array([mark]), np.array([bucket]))[0]
            for b in (bucket, other):
                slot = np.flatnonzero(self.table[b] == mark)
                if len(slot):
                    self.table[b, slot[0]] = 0
                    break

    @classmethod
    def of(cls, keys: np.ndarray) -> Cuckoo:
        """A filter of ``keys``, as large as it takes."""
        size = len(keys)
        while True:
            new = cls.sized(size)
            if new.insert(keys):
                return new
            size = 2 * max(size, new.room)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(_U)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _lines(docs: DataFrame, *columns: str) -> DataFrame:
    """(columns, pos, h1, h2): each line that is long enough, by two 64-bit hashes of its key."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (
        docs.select(*columns, F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
        .where(F.length("line") >= LEAST_CHARS)
        .withColumn("line", line_key(F.col("line")))
        .where(F.length("line") >= LEAST_CHARS)
        .select(
            *columns,
            "pos",
            F.xxhash64("line").alias("h1"),
            F.xxhash64(F.lit(1), "line").alias("h2"),
        )
    )


def _screen(batches: Iterable[pa.RecordBatch], filters: dict[int, Cuckoo], out: pa.Schema):
    """The rows (.., h1, h2) whose keys one of the filters may hold."""
    for batch in batches:
        h1, h2 = (_numbers(batch.column(i)) for i in (-2, -1))
        hit = np.zeros(batch.num_rows, bool)
        shard = (h1 & _U(len(filters) - 1)).astype(np.int64)
        for s in np.unique(shard):
            rows = np.flatnonzero(shard == s)
            hit[rows] = filters[int(s)].holds(h2[rows])
        if hit.any():
            kept = batch.filter(pa.array(hit))
            yield pa.RecordBatch.from_arrays(kept.columns, schema=out)


def _by_shard(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """((level, shard), part) of batches sorted by both; a key may come in several parts."""
    for batch in batches:
        level, shard = (batch.column(i).to_numpy() for i in (0, 1))
        cuts = np.flatnonzero((np.diff(level) != 0) | (np.diff(shard) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if b > a:
                yield (int(level[a]), int(shard[a])), batch.slice(a, b - a)


_FILTERS = "level int, shard int, n_keys long, cells binary"


def _filtered(batches: Iterable[pa.RecordBatch], out: pa.Schema) -> Iterator[pa.RecordBatch]:
    """New filters from (level, shard, n, n_keys, cells, h2): the old one, removals, additions.

    A filter that would be overfull comes without cells, to be made anew.
    """
    key, old, changes = None, None, {-1: [], 1: []}

    def made() -> pa.RecordBatch:
        less, more = (np.concatenate([np.empty(0, _U), *changes[s]]) for s in (-1, 1))
        if old is None:
            n, new = len(more), Cuckoo.of(more)
        else:
            n, new = old[0] + len(more) - len(less), Cuckoo.read(old[1])
            new.remove(less)
            new = new if n <= new.room and new.insert(more) else None
        row = [*key, n, new and new.write()]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip(row, out)], schema=out
        )

    for this, part in _by_shard(batches):
        if this != key:
            if key is not None:
                yield made()
            key, old, changes = this, None, {-1: [], 1: []}
        order = part.column(2).to_numpy()
        if order[0] == -2:
            old = part.column(3)[0].as_py(), part.column(4)[0].as_py()
        keys = _numbers(part.column(5).fill_null(0))
        for sign in (-1, 1):
            changes[sign].append(keys[order == sign])
    if key is not None:
        yield made()


def _probed(batches: Iterable[pa.RecordBatch], out: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows (level, shard, n, cells, h1, h2, docs, last) with whether their filter may hold them."""
    key, cuckoo = None, None
    for this, part in _by_shard(batches):
        if this != key:
            key, cuckoo = this, None
        if part.column(2)[0].as_py() == -2:
            cuckoo, part = Cuckoo.read(part.column(3)[0].as_py()), part.slice(1)
        keys = _numbers(part.column(5))
        maybe = cuckoo.holds(keys) if cuckoo else np.zeros(len(keys), bool)
        yield pa.RecordBatch.from_arrays([*part.columns[4:], pa.array(maybe)], schema=out)


class LineIndex:
    """The lines of a set of documents, kept as tables in ``folder``.

    ``insert`` and ``delete`` change the set; ``clean`` drops repeated lines from texts.
    Inserting documents and deleting them again leaves every answer as it was. Opening a
    folder that holds an index goes on with it; one writer at a time.
    """

    def __init__(self, spark: SparkSession, folder: str, id_type: str = "bigint") -> None:
        self.spark, self.folder, self.id_type = spark, folder.rstrip("/"), id_type
        self.log: list[dict] = []
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/log")
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            rows = spark.read.schema(self._LOG).parquet(f"{self.folder}/log").collect()
            self.log = sorted((r.asDict() for r in rows), key=lambda r: r["version"])

    _LOG = "version int, shards int, refs boolean, gone boolean, remade boolean"

    def _path(self, name: str, version: int) -> str:
        return f"{self.folder}/{name}/version={version}"

    def _schema(self, name: str) -> str:
        return {
            "refs": f"doc_id {self.id_type}, h1 long, h2 long",
            "gone": f"doc_id {self.id_type}",
            "counts": f"h1 long, h2 long, n_docs long, last {self.id_type}",
            "filters": _FILTERS,
        }[name]

    def _table(self, name: str, versions: list[int]) -> DataFrame:
        """The rows of committed versions, with their version."""
        schema = self._schema(name)
        if not versions:
            return self.spark.createDataFrame([], f"{schema}, version int")
        read = self.spark.read.schema(f"{schema}, version int").option("basePath", f"{self.folder}/{name}")
        return read.parquet(*(self._path(name, v) for v in versions))

    def _write(self, df: DataFrame, name: str, version: int) -> DataFrame:
        """Writes a version's rows (again, if a run before broke off) and reads them back."""
        df.write.mode("overwrite").parquet(self._path(name, version))
        return self._table(name, [version]).drop("version")

    def _commit(self, **row) -> None:
        self.spark.createDataFrame([row], self._LOG).coalesce(1).write.mode("append").parquet(
            f"{self.folder}/log"
        )
        self.log.append(row)

    @property
    def _shards(self) -> int:
        return self.log[-1]["shards"] if self.log else 0

    def refs(self) -> DataFrame:
        """(doc_id, h1, h2) of the documents that are in the index."""
        refs = self._table("refs", [r["version"] for r in self.log if r["refs"]])
        gone = self._table("gone", [r["version"] for r in self.log if r["gone"]]).select(
            F.col("doc_id").alias("g_id"), F.col("version").alias("g_version")
        )
        later = (F.col("doc_id") == F.col("g_id")) & (F.col("version") < F.col("g_version"))
        return refs.join(gone, later, "left_anti").drop("version")

    def counts(self) -> DataFrame:
        """(h1, h2, n_docs, last) of the keys that occur."""
        versions = [r["version"] for r in self.log]
        rows = self._table("counts", versions)
        if len(versions) > 1:
            rows = (
                rows.groupBy("h1", "h2")
                .agg(F.max_by(F.struct("n_docs", "last"), "version").alias("c"))
                .select("h1", "h2", "c.n_docs", "c.last")
            )
        return rows.drop("version").where("n_docs > 0")

    def filters(self) -> DataFrame:
        """(level, shard, n_keys, cells) as of now."""
        made = max((r["version"] for r in self.log if r["remade"]), default=0)
        rows = self._table("filters", [r["version"] for r in self.log if r["version"] >= made])
        return (
            rows.groupBy("level", "shard")
            .agg(F.max_by(F.struct("n_keys", "cells"), "version").alias("f"))
            .select("level", "shard", "f.n_keys", "f.cells")
        )

    def _shard(self, shards: int) -> Column:
        return F.col("h1").bitwiseAND(F.lit(shards - 1)).cast("int").alias("shard")

    def _update(self, changed: DataFrame, version: int, **kinds: bool) -> None:
        """Writes ``changed`` (h1, h2, n_docs, last, before), brings filters up to date, commits."""
        changed = cut_lineage(changed)
        self._write(changed.drop("before"), "counts", version)
        live = changed.agg(F.count_if(F.col("n_docs") > 0).alias("more")).first()["more"]
        total = live + (self.filters().where("level = 1").agg(F.sum("n_keys")).first()[0] or 0)
        shards, remade = self._shards, False
        if not shards or total > 4 * SHARD_KEYS * shards:
            shards, remade = 1, True
            while SHARD_KEYS * shards < total:
                shards *= 2
        now = {"version": version, "shards": shards, "remade": remade, **kinds}

        def crossing(rows, least: int, level: int) -> DataFrame:
            up = (F.col("n_docs") >= least) & (F.col("before") < least)
            down = (F.col("n_docs") < least) & (F.col("before") >= least)
            return rows.where(up | down).select(
                F.lit(level).alias("level"), self._shard(shards),
                F.when(up, 1).otherwise(-1).alias("n"), "h2",
            )

        def both(rows) -> DataFrame:
            return crossing(rows, 1, 1).unionByName(crossing(rows, LEAST_DOCS, 2))

        out = _arrow(_FILTERS)

        def make(rows) -> DataFrame:
            columns = "level", "shard", "n", "n_keys", "cells", "h2"
            keyed = rows.select(*(F.col(c) if c in rows.columns else F.lit(None).alias(c) for c in columns))
            typed = keyed.select(
                "level", "shard", "n", F.col("n_keys").cast("long"), F.col("cells").cast("binary"), "h2"
            )
            return in_groups(typed, "level", "shard").mapInArrow(lambda b: _filtered(b, out), _FILTERS)

        def everything() -> DataFrame:
            """All keys, as if none had been there; the log as it will be after this version."""
            self.log.append(now)
            try:
                return both(self.counts().withColumn("before", F.lit(0)))
            finally:
                self.log.pop()

        if remade:
            new = make(everything())
        else:
            head = self.filters().withColumn("n", F.lit(-2))
            changes = both(changed)
            touched = changes.select("level", "shard").distinct()
            head = head.join(touched, ["level", "shard"], "left_semi")
            new = cut_lineage(make(head.unionByName(changes, allowMissingColumns=True)))
            full = new.where("cells is null").select("level", "shard")
            if full.count():
                again = make(everything().join(F.broadcast(full), ["level", "shard"]))
                new = new.where("cells is not null").unionByName(again)
        self._write(new, "filters", version)
        self._commit(**now)

    def insert(self, docs: DataFrame) -> None:
        """Adds ``docs`` (doc_id, text). An id that is there already is replaced.

        Rows without an id are left out; rows that share an id are one document.
        """
        if self.log:
            self.delete(docs.select("doc_id"))
        version = len(self.log) + 1
        found = _lines(docs.where(F.col("doc_id").isNotNull()), "doc_id")
        refs = self._write(found.select("doc_id", "h1", "h2").distinct(), "refs", version)
        batch = refs.groupBy("h1", "h2").agg(
            F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("last")
        )
        if not self.log:
            changed = batch.select("h1", "h2", F.col("docs").alias("n_docs"), "last", F.lit(0).alias("before"))
            return self._update(changed, version, refs=True, gone=False)

        head = self.filters().where("level = 1").select("level", "shard", F.lit(-2).alias("n"), "cells")
        rows = batch.select(
            F.lit(1).alias("level"), self._shard(self._shards), F.lit(0).alias("n"), "h1", "h2", "docs", "last"
        )
        schema = f"h1 long, h2 long, docs long, last {self.id_type}, maybe boolean"
        out = _arrow(schema)
        both = head.unionByName(rows, allowMissingColumns=True)
        probed = cut_lineage(
            in_groups(both, "level", "shard").mapInArrow(lambda b: _probed(b, out), schema)
        )
        # only keys that the filter may hold are looked up
        old = self.counts().select("h1", "h2", F.col("n_docs").alias("before"), F.col("last").alias("old"))
        known = probed.where("maybe").join(old, ["h1", "h2"], "left")
        fresh = probed.where("not maybe").select(
            "*", F.lit(0).cast("long").alias("before"), F.lit(None).cast(self.id_type).alias("old")
        )
        before = F.coalesce("before", F.lit(0))
        changed = known.select(*fresh.columns).unionByName(fresh).select(
            "h1", "h2", (before + F.col("docs")).alias("n_docs"),
            F.greatest("last", "old").alias("last"), before.alias("before"),
        )
        return self._update(changed, version, refs=True, gone=False)

    def delete(self, ids: DataFrame) -> None:
        """Takes the documents of ``ids`` (doc_id) out; unknown ids are ignored."""
        if not self.log:
            return
        version = len(self.log) + 1
        refs = self.refs()
        ids = ids.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
        # a document without a long line has no reference and needs no deletion
        leaving = cut_lineage(refs.join(ids, "doc_id", "left_semi"))
        if leaving.isEmpty():
            return
        gone = self._write(leaving.select("doc_id").distinct(), "gone", version)
        touched = leaving.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("less"))
        left = (
            refs.join(gone, "doc_id", "left_anti")
            .join(touched, ["h1", "h2"], "left_semi")
            .groupBy("h1", "h2")
            .agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last"))
        )
        n_docs = F.coalesce("n_docs", F.lit(0).cast("long"))
        changed = touched.join(left, ["h1", "h2"], "left").select(
            "h1", "h2", n_docs.alias("n_docs"), "last", (n_docs + F.col("less")).alias("before")
        )
        self._update(changed, version, refs=False, gone=True)

    def clean(self, docs: DataFrame) -> DataFrame:
        """Per row of ``docs`` (doc_id, text): doc_id, n_lines, n_dropped and text, what stays.

        A line is dropped if its key has LEAST_CHARS code points or more and stands in at
        least LEAST_DOCS documents of the index, unless this is the one with the largest id.
        A key is the line without white space at its ends, A-Z lower-cased; keys count
        as equal if 128 bits of hashes are. Null and empty texts are one empty line. A row without
        an id keeps all its lines, and counts for no other. Rows that share an id are one
        document and each lose the same lines. A text's length is no matter: it is read
        and moved once, and its lines are numbers until then. Other columns are ignored; an
        empty table gives no rows, an empty index drops nothing.
        """
        docs = docs.select("doc_id", "text").withColumn(
            "text_hash", F.xxhash64(F.coalesce("text", F.lit("")))
        )
        kind = docs.schema["doc_id"].dataType.simpleString()
        drops = cut_lineage(self._drops(docs.where(F.col("doc_id").isNotNull()), kind))
        schema = f"doc_id {kind}, n_lines long, n_dropped long, text string"
        out = _arrow(schema)

        def kept(batches):
            for batch in slices(batches):
                rows = []
                for doc, text, at in zip(*(c.to_pylist() for c in batch.columns)):
                    lines = (text or "").split("\n")
                    if at:
                        at = set(at)
                        text = "\n".join(l for i, l in enumerate(lines) if i not in at)
                    rows.append((doc, len(lines), len(at or ()), text or ""))
                yield from batched(rows, out)

        same = (docs["doc_id"] == drops["d_id"]) & (docs["text_hash"] == drops["d_hash"])
        return docs.join(drops, same, "left").select("doc_id", "text", "at").mapInArrow(kept, schema)

    def _drops(self, docs: DataFrame, kind: str) -> DataFrame:
        """(d_id, d_hash, at): the numbers of the lines that a document loses."""
        lines = _lines(docs, "doc_id", "text_hash")
        filters = self.filters().where("level = 2")
        size = filters.agg(F.sum(F.octet_length("cells"))).first()[0] or 0
        if size <= FILTER_BYTES:
            schema = f"doc_id {kind}, text_hash long, pos int, h1 long, h2 long"
            out, shards = _arrow(schema), max(self._shards, 1)
            cells = {r["shard"]: bytes(r["cells"]) for r in filters.collect()}
            shared = self.spark.sparkContext.broadcast(cells)

            def screened(batches):
                nothing = Cuckoo.sized(0)
                found = shared.value
                by_shard = {s: Cuckoo.read(found[s]) if s in found else nothing for s in range(shards)}
                yield from _screen(batches, by_shard, out)

            # lines that miss the filter stay, and go no further
            lines = lines.mapInArrow(screened, schema)
        repeated = self.counts().where(F.col("n_docs") >= LEAST_DOCS)
        # frequent keys, few by arithmetic, are broadcast, so no task gets all lines of one
        bound = (repeated.agg(F.sum("n_docs")).first()[0] or 0) // HEAVY_KEYS
        heavy = F.broadcast(repeated.where(F.col("n_docs") > bound))
        rare = repeated.where(F.col("n_docs") <= bound)
        lost, sides = None, (heavy,)
        if bound >= LEAST_DOCS:
            lines, sides = cut_lineage(lines), (heavy, rare)
        for keys in sides:
            met = lines.join(keys, ["h1", "h2"]).where(F.col("doc_id") != F.col("last"))
            lost = met if lost is None else lost.unionByName(met)
        return lost.groupBy(F.col("doc_id").alias("d_id"), F.col("text_hash").alias("d_hash")).agg(
            F.collect_set("pos").alias("at")
        )


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``LineIndex.clean`` of ``docs`` by an index of ``docs`` themselves, in the shared folder."""
    spark = docs.sparkSession
    index = LineIndex(
        spark, scratch_path(spark, "lines"), docs.schema["doc_id"].dataType.simpleString()
    )
    index.insert(docs)
    return index.clean(docs)
