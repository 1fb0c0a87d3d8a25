"""Scores of texts under a model of prediction by partial matching (PPM).

The byte trie holds, for every context of up to ``order`` bytes, how often each
next byte (or the end of the text) followed in the learning texts. A symbol is
coded in the longest known context; where it is new there, the escape takes as
much mass as the context has distinct symbols, and shorter contexts exclude the
symbols already ruled out, down to equal shares of what is left.

The trie grows with the corpus, so it is a set of tables: paths (context and
symbol) are counted on the map side and summed by key, one table for each order.
The model is pretrained, so the code length of a path depends on the trie alone.
The most frequent paths are broadcast with theirs; all other paths of a text are
joined, once for each text. Paths that no learning text took go down through the
tables order by order, each distinct path once.

A unigram baseline comes with it: the most frequent words are broadcast, all
others are joined.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import id_remainder, slices
from cohortlens.session import cut_lineage

#: Symbols: the bytes, then the end of the text.
SYMBOLS, END = 257, 256
#: Stands before the text in a path, whose symbols have BITS each; of ORDER bytes the query's contexts.
START, BITS, ORDER = 257, 9, 4
#: Words broadcast with their counts, and the longest of them in bytes.
FREQUENT_WORDS, FREQUENT_BYTES = 200_000, 64
#: Positions and distinct words that a task gathers before it hands them on.
TALLY_POSITIONS, TALLY_WORDS = 4_000_000, 400_000
#: Paths broadcast with their code lengths (16 bytes each), and paths a task holds before it hands them on.
FREQUENT_PATHS, TALLY_PATHS = 1 << 20, 2_000_000
#: Steps of a doubling by which counts are told apart when the frequent paths are chosen.
COUNT_STEPS = 16


def _lower(text: str | None) -> bytes:
    """UTF-8 of ``text`` with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower() if text else b""


def _keys(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """For each symbol of each text its path, and where each text starts.

    A path holds the ``order`` symbols before and then the symbol itself, which has the
    lowest bits; before the text there is START.
    """
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.cumsum(lengths) - lengths
    # every text is followed by one place for its end
    symbols = np.frombuffer(b"\0".join([*texts, b""]), np.uint8).astype(np.int64)
    symbols[starts + lengths - 1] = END
    keys = symbols.copy()
    back = symbols
    for step in range(1, order + 1):
        back = np.roll(back, 1)
        back[starts] = START  # and moves on with the next step
        keys |= back << (BITS * step)
    return keys, starts


def _path_counts(docs: DataFrame, order: int) -> DataFrame:
    """(key, n): how often each path was taken, contexts as long as the text allows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen = (np.empty(0, np.int64), np.empty(0, np.int64))

        def fold() -> tuple[np.ndarray, np.ndarray]:
            new = pc.value_counts(pa.array(np.concatenate(held)))
            held.clear()
            keys, place = np.unique(
                np.concatenate([seen[0], new.field("values").to_numpy()]), return_inverse=True
            )
            total = np.bincount(
                place, np.concatenate([seen[1], new.field("counts").to_numpy()]), len(keys)
            )
            return keys, total.astype(np.int64)

        def out() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(seen[0]), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seen[0][at : at + 100_000]), pa.array(seen[1][at : at + 100_000])],
                    names=["key", "n"],
                )

        positions = 0
        for batch in slices(batches):
            held.append(_keys([_lower(t) for t in batch.column(0).to_pylist()], order)[0])
            positions += len(held[-1])
            if positions > TALLY_POSITIONS:
                seen, positions = fold(), 0
                if len(seen[0]) > TALLY_PATHS:
                    yield from out()
                    seen = (np.empty(0, np.int64), np.empty(0, np.int64))
        if held:
            seen = fold()
        yield from out()

    counted = docs.select("text").mapInArrow(run, "key long, n long")
    return counted.groupBy("key").agg(F.sum("n").alias("n"))


def _word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all texts; words are runs of bytes other than ASCII white space."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                names=["word", "c"],
            )
            seen.clear()
            return batch

        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                seen.update(_lower(text).split())
            if len(seen) > TALLY_WORDS:
                yield out()
        yield out()

    counted = docs.select("text").mapInArrow(run, "word binary, c long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


class Trie:
    """Tables by order: ``paths[k]`` (key, n) and ``contexts[k]`` (context, total, kinds, inner).

    A context's row has the sum of its counts, the number of its symbols, and the sum of
    the counts that these symbols have in the context one byte shorter, which must not
    count there once this context has ruled them out.
    """

    def __init__(self, docs: DataFrame, order: int) -> None:
        self.order = order
        every = cut_lineage(_path_counts(docs, order))
        self.paths: dict[int, DataFrame] = {}
        self.contexts: dict[int, DataFrame] = {}
        for k in range(order, -1, -1):
            if k < order:
                # shorter contexts saw all that the longer ones saw, and the starts
                shorter = every.groupBy(_suffix("key", k).alias("key")).agg(F.sum("n").alias("n"))
                every = cut_lineage(shorter)
            self.paths[k] = every.where(_within("key", k))
        for k, paths in self.paths.items():
            if k:
                inner = self.paths[k - 1].select(
                    F.col("key").alias("_suffix"), F.col("n").alias("inner")
                )
                paths = paths.join(inner, _suffix("key", k - 1) == F.col("_suffix"))
            else:
                paths = paths.withColumn("inner", F.lit(0).cast("long"))
            self.contexts[k] = cut_lineage(
                paths.groupBy(F.shiftright("key", BITS).alias("context")).agg(
                    F.sum("n").alias("total"),
                    F.count(F.lit(1)).alias("kinds"),
                    F.sum("inner").alias("inner"),
                )
            )

    def known(self) -> DataFrame:
        """(key, n, code): log10 share of each path of full order that was taken in learning."""
        k = self.order
        found = self.paths[k].withColumn("context", F.shiftright("key", BITS))
        mass = F.col("total") + F.when(F.col("kinds") < SYMBOLS, F.col("kinds")).otherwise(0)
        return found.join(self.contexts[k], "context").select(
            "key", "n", F.log10(F.col("n") / mass).alias("code")
        )

    def codes(self, keys: DataFrame) -> DataFrame:
        """(key, code): log10 share of the last symbol of each of the distinct paths."""
        zero = F.lit(0).cast("long")
        state = keys.select(
            "key",
            F.lit(0.0).alias("code"),
            F.lit(False).alias("done"),
            # what the longer context has ruled out: counts here, and symbols
            zero.alias("out_n"),
            zero.alias("out_kinds"),
        )
        for k in range(self.order, -1, -1):
            path = _suffix("key", k)
            context = F.shiftright(path, BITS)
            taken = self.paths[k].select(F.col("key").alias("_path"), F.col("n").alias("_n"))
            at = self.contexts[k].withColumnRenamed("context", "_context")
            state = state.join(taken, path == F.col("_path"), "left")
            state = state.join(at, context == F.col("_context"), "left")
            total = F.col("total") - F.col("out_n")
            kinds = F.col("kinds") - F.col("out_kinds")
            mass = total + F.when(F.col("kinds") < SYMBOLS, kinds).otherwise(zero)
            # a context whose symbols are all ruled out passes the escape on whole
            step = F.when(F.col("_n").isNotNull(), F.log10(F.col("_n") / mass)).when(
                F.col("total").isNotNull() & (kinds > 0), F.log10(kinds / mass)
            )
            open_ = ~F.col("done")
            state = state.select(
                "key",
                F.when(open_, F.col("code") + F.coalesce(step, F.lit(0.0)))
                .otherwise(F.col("code"))
                .alias("code"),
                (F.col("done") | F.col("_n").isNotNull()).alias("done"),
                F.coalesce("inner", zero).alias("out_n"),
                F.coalesce("kinds", zero).alias("out_kinds"),
            )
        # equal shares of what no context has
        rest = -F.log10(F.lit(float(SYMBOLS)) - F.col("out_kinds"))
        return state.select(
            "key", F.when(F.col("done"), F.col("code")).otherwise(F.col("code") + rest).alias("code")
        )


def _suffix(key: str, k: int) -> Column:
    """The path of ``k`` bytes of context that ``key`` ends with."""
    return F.col(key).bitwiseAND(F.lit((1 << (BITS * (k + 1))) - 1))


def _within(key: str, k: int) -> Column:
    """Whether the path's ``k`` bytes of context lie within the text."""
    return F.lit(True) if not k else F.shiftright(_suffix(key, k), BITS * k) != START


def _most_frequent(known: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys (rising) and codes of at most FREQUENT_PATHS paths, all above one count.

    A few counts of counts say which; no rows are sorted for it.
    """
    step = F.floor(F.log2("n") * COUNT_STEPS).alias("step")
    least, total = None, 0
    for r in known.groupBy(step).count().orderBy(F.desc("step")).collect():
        total += r["count"]
        if total > FREQUENT_PATHS:
            break
        least = r["step"]
    if least is None:
        return np.empty(0, np.int64), np.empty(0)
    top = known.where(step >= least).select("key", "code").toArrow().sort_by("key")
    return top["key"].to_numpy(), top["code"].to_numpy()


def _path_codes(texts: list[bytes], order: int, keys: np.ndarray, codes: np.ndarray):
    """Each text's total over the paths in ``keys``, and (text, path, n) of all others."""
    paths, starts = _keys(texts, order)
    coded = pa.array(paths).dictionary_encode()
    distinct, place = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    at = np.minimum(np.searchsorted(keys, distinct), max(len(keys) - 1, 0))
    found = keys[at] == distinct if len(keys) else np.zeros(len(distinct), bool)
    value = np.zeros(len(distinct))
    value[found] = codes[at[found]]
    total = np.add.reduceat(value[place], starts)
    others = np.flatnonzero(~found[place])
    text = np.searchsorted(starts, others, "right") - 1
    # once for each text and path
    pairs, n = np.unique(text * len(distinct) + place[others], return_counts=True)
    text, rare = np.divmod(pairs, max(len(distinct), 1))
    return total, text, distinct[rare], n


def _scan(docs: DataFrame, order: int, paths, frequent: dict[bytes, float], folds: int, fold: int):
    """Per row: id, fold, counts, the known parts of both scores, other words and other paths."""
    shared = docs.sparkSession.sparkContext.broadcast((paths, frequent))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (keys, codes), frequent = shared.value
        for batch in slices(batches):
            texts = [_lower(t) for t in batch.column(2).to_pylist()]
            n, known, total, other = [], [], [], []
            for text in texts:
                words = text.split()
                values = list(map(frequent.get, words))
                new = [w for w, v in zip(words, values) if v is None]
                n.append(len(words))
                known.append(len(words) - len(new))
                total.append(sum(v for v in values if v is not None))
                other.append([{"word": w, "n": k} for w, k in Counter(new).items()])
            score, text, rare, times = _path_codes(texts, order, keys, codes)
            rare = pa.StructArray.from_arrays(
                [pa.array(rare, pa.int64()), pa.array(times, pa.int64())], ["key", "n"]
            )
            offsets = np.searchsorted(text, np.arange(len(texts) + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(n, pa.int64()),
                    pa.array(known, pa.int64()),
                    pa.array(total, pa.float64()),
                    pa.array(score, pa.float64()),
                    pa.array(
                        other, pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
                    ),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rare),
                ],
                names=["doc_id", "held_out", "n", "known", "total", "score", "other", "rare"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    held = (id_remainder("doc_id", folds) == fold).alias("held_out")
    return docs.select("doc_id", held, "text").mapInArrow(
        run,
        f"doc_id {id_type}, held_out boolean, n long, known long, total double, score double, "
        "other array<struct<word:binary,n:bigint>>, rare array<struct<key:bigint,n:bigint>>",
    )


def score_texts(docs: DataFrame, folds: int = 7, fold: int = 2, order: int = 2) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): the baseline's and the PPM model's log10 probability.

    Learned from the texts whose crc32(doc_id) mod ``folds`` is not ``fold``.
    Returns doc_id, held_out, n_tokens (words and one end), n_known (tokens
    seen in learning), train_tokens, base_score (sum of log10((c + 1) / (N + V +
    1)) over the tokens) and score. A null text is empty: its only token is the
    end. A null id counts as empty text. Repeated rows are learned and scored
    each; other columns are ignored; an empty table gives no rows. With nothing
    to learn every token has the baseline's share 1, every byte 1/257. ``order`` is the
    number of bytes in the longest contexts, at most six.
    """
    if not 0 <= order <= 6:
        raise ValueError("order must be between 0 and 6")
    train = docs.where(id_remainder("doc_id", folds) != fold).select("text")
    vocabulary = cut_lineage(_word_counts(train))
    size = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    ends = train.count()
    n_train, distinct = size[0] + ends, size[1] + (ends > 0)
    top = (
        vocabulary.where(F.octet_length("word") <= FREQUENT_BYTES)
        .orderBy(F.desc("c"), "word")
        .limit(FREQUENT_WORDS)
        .toArrow()
    )
    logs = np.log10(top["c"].to_numpy() + 1.0) if top.num_rows else []
    frequent = dict(zip(top["word"].to_pylist(), map(float, logs)))

    trie = Trie(train, order)
    known = cut_lineage(trie.known())
    rows = cut_lineage(
        _scan(docs, order, _most_frequent(known), frequent, folds, fold).withColumn(
            "rid", F.monotonically_increasing_id()
        )
    )
    # words beyond the broadcast ones: once for each text, so never a hot key by repetition
    other = (
        rows.select("rid", F.explode("other").alias("o"))
        .select("rid", "o.word", "o.n")
        .join(vocabulary, "word")
        .groupBy("rid")
        .agg(
            F.sum("n").alias("o_known"),
            F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("o_total"),
        )
    )
    # paths beyond the broadcast ones: likewise; those never taken in learning are coded once each
    rare = rows.select("rid", F.explode("rare").alias("r")).select("rid", "r.key", "r.n")
    coded = cut_lineage(
        rare.groupBy("key")
        .agg(F.lit(True).alias("_asked"))
        .join(known.select("key", "code"), "key", "left")
        .select("key", "code")
    )
    unseen = cut_lineage(trie.codes(coded.where("code is null").select("key")))
    lengths = coded.where("code is not null").unionByName(unseen)
    scored = (
        rare.join(lengths, "key")
        .groupBy("rid")
        .agg(F.sum(F.col("n") * F.col("code")).alias("r_total"))
    )
    zero = F.lit(0)
    base = (
        F.col("total")
        + F.coalesce("o_total", zero)
        + F.lit(float(np.log10(ends + 1.0)))
        - (F.col("n") + 1) * F.lit(float(np.log10(n_train + distinct + 1.0)))
    )
    return (
        rows.drop("other", "rare")
        .join(other, "rid", "left")
        .join(scored, "rid", "left")
        .select(
            "doc_id",
            "held_out",
            (F.col("n") + 1).alias("n_tokens"),
            (F.col("known") + F.coalesce("o_known", zero) + F.lit(int(ends > 0))).alias("n_known"),
            F.lit(n_train).cast("long").alias("train_tokens"),
            base.alias("base_score"),
            (F.col("score") + F.coalesce("r_total", F.lit(0.0))).alias("score"),
        )
    )
