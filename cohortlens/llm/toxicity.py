"""Toxicity by a support vector machine on a gap-weighted subsequence kernel.

The kernel compares two strings by the three-character subsequences they share,
each occurrence weighted by DECAY to the length it spans, gaps included (up to
SPAN characters), so that "id.iot" or "i d i o t" stay close to "idiot".
Nyström landmarks turn it into a linear machine; since the kernel is an inner
product of subsequence counts, the learned landmark weights fold into one weight
for each subsequence, and a string is scored by summing those.

Labels belong to texts, insults to words. A sentence is scored by its strongest
string (a word, a stretch of a long word, or spaced-out letters), a text by its
strongest ones; learning picks the strings of toxic texts that carry the label,
round by round. Learning takes a bounded sample, scoring every whole text.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import bounded_sample, id_remainder, slices

#: Bounds of the learning sample, for each label.
SAMPLE_ROWS = 1_500
SAMPLE_CHARS = 8_000_000
DECAY, SPAN = 0.7, 5
LANDMARKS = 400
ROUNDS = 5
#: Share of clean texts whose strongest string a toxic text's must beat to be learned from.
CLEAN_SHARE = 0.95
#: Share of the clean texts it learned from that a model may predict as toxic.
MOST_ALARMS = 0.015
#: Characters of a string that is compared at once; longer words are cut into stretches.
WIDTH, STRIDE = 16, 8
#: Strings of each text that carry its label, and on which a text's score rests.
WITNESSES = 2
#: Strings whose scores a task keeps.
MEMO = 400_000

#: Letters a-z, digits, signs, and shares of all other letters, accented ones too.
SYMBOLS, PAD = 40, 40
_SPACED = re.compile(r"(?<!\w)\w(?:[\W_]{1,3}\w(?!\w)){2,}")
_SIGNS = re.compile(r"[\W_]+")
#: Neighbouring pieces of a few characters, which may be one word that a blank has split.
_PIECES = re.compile(r"(?<!\S)(?=(\S{1,4}[^\S\n]+\S{1,4})(?!\S))")
_PATTERNS = [(j, k) for k in range(2, SPAN) for j in range(1, k)]


def _symbol_table() -> np.ndarray:
    """Symbol of each character of the basic plane."""
    out = np.empty(0x10000, np.int32)
    for code in range(0x10000):
        base = chr(code).lower()[0]
        if "a" <= base <= "z":
            out[code] = ord(base) - 97
        elif base.isdigit():
            out[code] = 26
        elif base.isalpha():
            out[code] = 28 + code % (SYMBOLS - 28)
        else:
            out[code] = 27
    return out


def strings(text: str) -> list[str]:
    """Words of ``text`` in lower case, stretches of spaced-out letters, pairs of short pieces."""
    text = text.lower()
    return text.split() + _SPACED.findall(text) + _PIECES.findall(text)


def plain(word: str) -> str:
    """Letters and digits of ``word``."""
    return word if word.isalnum() else _SIGNS.sub("", word)


class Kernel:
    """Subsequences of strings, as symbol triples with their weights."""

    def __init__(self) -> None:
        self.table = _symbol_table()

    def windows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of each window, padded to WIDTH, and the word each belongs to."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = np.where(codes < 0x10000, self.table[np.minimum(codes, 0xFFFF)], 28)
        lengths = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(lengths) - lengths
        n = np.maximum(1, -(-(lengths - WIDTH) // STRIDE) + 1)
        owner = np.repeat(np.arange(len(words)), n)
        at = (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * STRIDE
        place = starts[owner][:, None] + at[:, None] + np.arange(WIDTH)
        inside = at[:, None] + np.arange(WIDTH) < lengths[owner][:, None]
        symbols = np.append(symbols, PAD)
        return np.where(inside, symbols[np.minimum(place, len(symbols) - 1)], PAD), owner

    def triples(self, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """(index, valid, weight) for each gap pattern; index is rows x places."""
        for j, k in _PATTERNS:
            a, b, c = symbols[:, : WIDTH - k], symbols[:, j : WIDTH - k + j], symbols[:, k:]
            valid = c != PAD
            index = np.where(valid, (a * SYMBOLS + b) * SYMBOLS + c, 0)
            yield index, valid, DECAY ** (k + 1)

    def norms(self, symbols: np.ndarray) -> np.ndarray:
        """Length by which a window's weights are divided; a function of its width only."""
        total = np.zeros(len(symbols))
        for _, valid, weight in self.triples(symbols):
            total += valid.sum(1) * weight * weight
        return np.sqrt(np.maximum(total, 1e-12))

    def sums(self, symbols: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Inner products of the normed windows with ``weights`` (one or many columns)."""
        out = np.zeros((len(symbols), *weights.shape[1:]), np.float32)
        for index, valid, weight in self.triples(symbols):
            for place in range(index.shape[1]):
                some = valid[:, place]
                if some.any():
                    out[some] += weight * weights[index[some, place]]
        return out / self.norms(symbols).reshape(-1, *[1] * (out.ndim - 1))

    def features(self, words: list[str]) -> np.ndarray:
        """Subsequence weights of the first window of each word, one column a word."""
        symbols, owner = self.windows(words)
        symbols = symbols[np.searchsorted(owner, np.arange(len(words)))]
        out = np.zeros((SYMBOLS**3, len(words)), np.float32)
        for index, valid, weight in self.triples(symbols):
            row, place = np.nonzero(valid)
            np.add.at(out, (index[row, place], row), np.float32(weight))
        return out / self.norms(symbols).astype(np.float32)


class Model:
    """One weight for each subsequence, an offset, and the coefficients of a text's score."""

    def __init__(self, weights: np.ndarray, offset: float) -> None:
        self.weights, self.offset = weights, offset
        self.slopes, self.shift = np.ones(WITNESSES) / WITNESSES, 0.0

    def margins(self, kernel: Kernel, words: list[str]) -> np.ndarray:
        """Of each word: that of its strongest window."""
        out = np.full(len(words), -np.inf)
        for at in range(0, len(words), 20_000):
            symbols, owner = kernel.windows([plain(w) for w in words[at : at + 20_000]])
            value = kernel.sums(symbols, self.weights) + self.offset
            np.maximum.at(out, owner + at, value)
        return out

    def probability(self, margins: np.ndarray) -> float:
        z = float(self.slopes @ _strongest(margins)) + self.shift
        return float(1 / (1 + np.exp(-z))) if z > -30 else float(np.exp(max(z, -700.0)))


def _squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Primal support vector machine by Newton steps on the violated margins."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(25):
        inside = y * (x @ w) < 1
        xi = x[inside] * weight[inside, None]
        step = np.linalg.solve(x[inside].T @ xi + ridge * np.eye(len(w)), xi.T @ y[inside])
        if np.abs(step - w).max() < 1e-6:
            return step
        w = step
    return w


def _strongest(margins: np.ndarray) -> np.ndarray:
    """Margins of a text's WITNESSES strongest strings, falling; a missing one counts as -2."""
    top = np.sort(margins)[: -WITNESSES - 1 : -1]
    return np.append(top, [-2.0] * (WITNESSES - len(top)))


def learn(texts: list[tuple[int, str]], kernel: Kernel) -> Model | None:
    """A model from (label, text)."""
    bags = [(y, sorted({plain(w) for w in strings(t)} - {""})) for y, t in texts]
    bags = [(y, b) for y, b in bags if b]
    toxic = [b for y, b in bags if y == 1]
    clean = [b for y, b in bags if y == 0]
    if not toxic or not clean:
        return None
    in_toxic, in_clean = Counter(w for b in toxic for w in b), Counter(w for b in clean for w in b)
    words = sorted(set(in_toxic) | set(in_clean))
    place = {w: i for i, w in enumerate(words)}
    t = np.array([in_toxic[w] for w in words]) / len(toxic)
    c = np.array([in_clean[w] for w in words]) / len(clean)
    suspicion = t - 2 * c
    # landmarks: the strings that tell most, from both sides
    by_side = np.lexsort((np.arange(len(words)), -suspicion))
    half = LANDMARKS // 2
    usual = np.argsort(-c, kind="stable")[:half]
    picked = sorted({*by_side[:half].tolist(), *usual.tolist()})
    columns = kernel.features([words[i] for i in picked])
    values, vectors = np.linalg.eigh((columns.T @ columns).astype(np.float64))
    good = values > 1e-5 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    basis = (columns @ whiten).astype(np.float32)

    symbols, owner = kernel.windows(words)

    def values(weights: np.ndarray) -> np.ndarray:
        parts = range(0, len(symbols), 20_000)
        return np.concatenate([kernel.sums(symbols[i : i + 20_000], weights) for i in parts])

    window_clean = np.repeat(c > 0, np.bincount(owner, minlength=len(words)))
    toxic_at = [np.array([place[w] for w in b]) for b in toxic]
    clean_at = [np.array([place[w] for w in b]) for b in clean]
    first = np.searchsorted(owner, np.arange(len(words)))

    # how much a string carries the label; to begin with, by how many more toxic texts than
    # expected have it, in standard deviations
    expected = c * len(toxic)
    margin = (t * len(toxic) - expected) / np.sqrt(expected + 1)
    value = margin[owner]
    # labels err: a text first has to beat the strongest strings of most clean texts
    bar = np.quantile([margin[bag].max() for bag in clean_at], CLEAN_SHARE)
    trusted = [margin[bag].max() > bar for bag in toxic_at]
    model = None
    for _ in range(ROUNDS):
        positive = Counter()
        for k, bag in enumerate(toxic_at):
            trusted[k] |= model is not None and margin[bag].max() > 0
            free = bag[c[bag] <= t[bag] / 4]
            if not trusted[k]:
                continue
            for i in free[np.argsort(-margin[free], kind="stable")[:WITNESSES]]:
                positive[int(i)] += 1
        if not positive:
            return None
        # the strongest windows of clean texts are the ones to push back
        rows = np.flatnonzero(window_clean)
        hard = rows[np.argsort(-value[rows], kind="stable")[:8_000]]
        some = rows[:: max(1, len(rows) // 8_000)]
        negative = np.setdiff1d(np.union1d(hard, some), first[list(positive)])
        best = np.array(
            [
                f + int(np.argmax(value[f : f + n]))
                for f, n in ((first[i], np.searchsorted(owner, i, "right") - first[i]) for i in positive)
            ]
        )
        rows = np.concatenate([best, negative])
        y = np.concatenate([np.ones(len(best)), -np.ones(len(negative))])
        # a string weighs as much as the texts that have it: one of many clean texts costs more
        weight = np.concatenate(
            [np.array(list(positive.values()), float), c[owner[negative]] * len(clean)]
        )
        weight[: len(best)] *= weight[len(best) :].sum() / weight[: len(best)].sum()
        weight *= len(negative) / weight[len(best) :].sum()
        x = np.concatenate(
            [kernel.sums(symbols[rows[i : i + 2_000]], basis) for i in range(0, len(rows), 2_000)]
        )
        model = _squared_hinge(x.astype(np.float64), y, weight, ridge=1.0)
        value = values((basis @ model[:-1]).astype(np.float32)) + model[-1]
        margin = np.full(len(words), -np.inf)
        np.maximum.at(margin, owner, value)

    out = Model((basis @ model[:-1]).astype(np.float32), float(model[-1]))
    # a text's probability from its strongest margins: logistic, with a little ridge
    m = np.array([[*_strongest(margin[b]), 1.0] for b in toxic_at + clean_at])
    y = np.concatenate([np.ones(len(toxic_at)), np.zeros(len(clean_at))])
    weight = np.where(y == 1, 0.5 / len(toxic_at), 0.5 / len(clean_at))
    ridge = np.append(np.full(WITNESSES, 1e-4), 1e-9)
    w = np.zeros(len(ridge))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(m @ w, -30, 30)))
        gradient = m.T @ (weight * (p - y)) + ridge * w
        step = np.linalg.solve((m.T * (weight * p * (1 - p))) @ m + np.diag(ridge), gradient)
        w -= step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
    # a stronger string never lowers the score
    out.slopes, out.shift = np.maximum(w[:-1], 0.0), float(w[-1])
    # nor are more clean texts predicted as toxic than the stated share
    known = m[len(toxic_at) :, :-1] @ out.slopes + out.shift
    out.shift -= max(0.0, float(np.quantile(known, 1 - MOST_ALARMS)))
    return out


def score(docs: DataFrame, model: Model | None, *carry: str) -> DataFrame:
    """(doc_id, score, *carry) of each row of ``docs``; without a model every score is 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, kernel, memo = shared.value, Kernel(), {}
        for batch in slices(batches):
            scores = [0.0] * batch.num_rows
            if model:
                found = [strings(t) if t else [] for t in batch.column(1).to_pylist()]
                new = list({w for words in found for w in words if w not in memo})
                if len(memo) + len(new) > MEMO:
                    memo.clear()
                    new = list({w for words in found for w in words})
                memo.update(zip(new, model.margins(kernel, new).tolist()))
                for i, words in enumerate(found):
                    top = np.array([memo[w] for w in set(words)])
                    scores[i] = model.probability(top)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), *batch.columns[2:]],
                names=["doc_id", "score", *carry],
            )

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", *carry).mapInArrow(
        run, ", ".join([f"doc_id {id_type}", "score double", *kinds])
    )


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5) -> Model | None:
    """Learned from labelled texts whose crc32(doc_id) mod ``folds`` is not 0.

    At most SAMPLE_ROWS texts and SAMPLE_CHARS characters of each label; null
    labels, ids and texts teach nothing, and an id with both labels is left out.
    None if a label is missing.
    """
    marked = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most"))
        .where(F.col("toxic") == F.col("_most"))
        .drop("_most")
        .where(id_remainder("doc_id", folds) != 0)
    )
    chosen = bounded_ids(marked)
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    sample = bounded_sample(texts.join(chosen, "doc_id"), "toxic", SAMPLE_ROWS, SAMPLE_CHARS)

    def learned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((y, t) for b in batches for y, t in zip(*(c.to_pylist() for c in b.columns)))
        model = pickle.dumps(learn(rows, Kernel()))
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    # the sample is bounded, so one task learns from it; only the model comes to the driver
    one = sample.select(F.col("toxic").cast("int"), "text").repartition(1)
    found = one.mapInArrow(learned, "model binary").first()
    return pickle.loads(found["model"]) if found else None


def bounded_ids(marked: DataFrame) -> DataFrame:
    """The ids of ``marked`` that ``bounded_sample`` may take, so that few texts are joined."""
    order = F.xxhash64(F.col("doc_id").cast("string"))
    keep = F.lit(False)
    for r in marked.groupBy("toxic").count().collect():
        every = max(1, r["count"] // (2 * SAMPLE_ROWS))
        keep = keep | ((F.col("toxic") == r["toxic"]) & (F.pmod(order, F.lit(every)) == 0))
    return F.broadcast(marked.where(keep))


def rate(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    ``score`` (0 to 1) is the text's probability of label 1, ``predicted`` is 1
    from 0.5 on. Null and empty texts are scored as texts without a string, so
    low; repeated rows each; a null id counts as held out. With no labelled text
    of one kind every score is 0. Other columns are ignored; an empty table
    gives no rows.
    """
    return score(docs, fit(docs, labels, folds)).select(
        "doc_id",
        (id_remainder("doc_id", folds) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """``docs`` without rows predicted as toxic; all columns unchanged."""
    packed = docs.select("doc_id", "text", F.struct(*(docs[c] for c in docs.columns)).alias("_row"))
    rated = score(packed, fit(docs, labels, folds), "_row")
    return rated.where("score < 0.5").select("_row.*")
