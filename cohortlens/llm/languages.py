"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of the 1- to 3-grams inside words, with word ends
marked. Weights are learned with follow-the-regularised-leader (per-coordinate
rates, elastic net), then the logits are divided by one fitted temperature.
Weights are learned from a bounded sample; the n-grams' document frequencies are
counted over all learning texts. Prediction reads every whole text in one pass.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import bounded_sample, id_remainder, slices

#: Bounds of the learning sample, for each language.
SAMPLE_ROWS = 400
SAMPLE_CHARS = 1_000_000
GRAMS = (1, 2, 3)
#: Words of a learning example, so that short texts are learned too.
EXAMPLE_WORDS = (2, 6, 16)
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.1
EPOCHS = 2
#: Words whose weights a task keeps.
MEMO = 400_000
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def _marked(word: str) -> list[str]:
    """Runs of letters in ``word``, each between marks."""
    return [f"<{letters}>" for letters in _LETTERS.findall(word)]


def _grams(word: str) -> list[str]:
    """n-grams of the letters in ``word``; none if it has no letter."""
    return [
        marked[i : i + n]
        for marked in _marked(word)
        for n in GRAMS
        for i in range(len(marked) - n + 1)
    ]


def _key(gram: str) -> int:
    """The characters of a gram in one number; 21 bits each, so grams never share one."""
    out = 0
    for c in gram:
        out = out << 21 | ord(c)
    return out


def _word_keys(words: list[str]) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
    """The keys of all n-grams of ``words``, one array for each n.

    Of the words that have a letter: their place, and where their stretch of the
    arrays starts. -1 stands where no n-gram starts.
    """
    marked = ["".join(_marked(w)) for w in words]
    some = np.flatnonzero([len(m) > 0 for m in marked])
    lengths = np.array([len(marked[i]) for i in some], np.int64)
    starts = np.cumsum(lengths) - lengths
    one = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
    one = one.astype(np.int64)
    # a run of letters ends at its closing mark: no n-gram goes on beyond that
    inside = one != ord(">")
    two = np.where(inside, one << 21 | np.append(one[1:], 0), -1)
    three = np.where(
        inside & np.append(inside[1:], False), two << 21 | np.append(one[2:], [0, 0])[: len(one)], -1
    )
    return some, starts, (one, two, three)


class _WordGrams:
    """Of the words that a task has met, which of the given n-grams they hold: one flat list."""

    def __init__(self, grams: list[str]) -> None:
        keys = np.array([_key(g) for g in grams], np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.gram = np.append(order, -1).astype(np.int32)
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.starts, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.held = np.empty(0, np.int32)

    def _add(self, words: list[str]) -> None:
        some, starts, every = _word_keys(words)
        lengths = np.diff(np.append(starts, len(every[0])))
        owners, found = [], []
        owner = np.repeat(some, lengths)
        for keys in every:
            at = np.searchsorted(self.keys, keys)
            hit = self.keys[at] == keys
            owners.append(owner[hit])
            found.append(self.gram[at[hit]])
        owner, grams = np.concatenate(owners), np.concatenate(found)
        counts = np.bincount(owner, minlength=len(words))
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words))))
        self.starts = np.append(self.starts, len(self.held) + np.cumsum(counts) - counts)
        self.counts = np.append(self.counts, counts)
        self.held = np.append(self.held, grams[np.argsort(owner, kind="stable")])

    def of(self, texts: list[set[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(text, n-gram) of all words of the texts, with repetitions."""
        new = list({w for words in texts for w in words if w not in self.place})
        if len(self.place) + len(new) > MEMO:
            self.clear()
            new = list({w for words in texts for w in words})
        if new:
            self._add(new)
        sizes = [len(words) for words in texts]
        ids = np.fromiter((self.place[w] for words in texts for w in words), np.int64, sum(sizes))
        counts = self.counts[ids]
        text = np.repeat(np.repeat(np.arange(len(texts)), sizes), counts)
        ends = np.cumsum(counts)
        at = np.arange(len(text)) + np.repeat(self.starts[ids] - (ends - counts), counts)
        return text, self.held[at]


class Model:
    """Languages, and for each n-gram its weights, already multiplied by its idf."""

    def __init__(self, langs: list[str], bias: np.ndarray, weights: dict[str, np.ndarray]) -> None:
        self.langs, self.bias, self.temperature = langs, bias, 1.0
        keys = np.array([_key(g) for g in weights], np.int64)
        order = np.argsort(keys)
        # a last row of zeros stands for n-grams without weight
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        rows = [*weights.values(), np.zeros(len(langs))]
        self.weights = np.array(rows)[np.append(order, len(keys)).astype(int)]

    def words(self, words: list[str]) -> np.ndarray:
        """For each word the sum of its n-grams' weights, then their number."""
        out = np.zeros((len(words), len(self.langs) + 1))
        some, starts, every = _word_keys(words)
        if not len(some):
            return out
        for keys in every:
            place = np.searchsorted(self.keys, keys)
            place[self.keys[place] != keys] = len(self.keys) - 1
            out[some, :-1] += np.add.reduceat(self.weights[place], starts)
            out[some, -1] += np.add.reduceat(keys >= 0, starts, dtype=np.int64)
        return out

    def probabilities(self, total: np.ndarray) -> np.ndarray:
        """Of a text whose words sum up to ``total``."""
        logits = (self.bias + total[:-1] / max(total[-1], 1.0)) / self.temperature
        e = np.exp(logits - logits.max())
        return e / e.sum()


def _examples(texts: list[tuple[str, str]], rng: random.Random) -> list[tuple[str, Counter]]:
    """Runs of words of each text, in lengths that take turns."""
    out = []
    for lang, text in texts:
        words, at = text.lower().split(), 0
        while at < len(words):
            n = rng.choice(EXAMPLE_WORDS)
            grams = Counter(g for w in words[at : at + n] for g in _grams(w))
            if grams:
                out.append((lang, grams))
            at += n * rng.randint(1, 8)
    rng.shuffle(out)
    return out


def sample_grams(texts: list[tuple[str, str]]) -> list[str]:
    """The distinct n-grams of (lang, text), in order."""
    words = {w for _, text in texts for w in text.lower().split()}
    return sorted({g for w in words for g in _grams(w)})


def document_frequencies(docs: DataFrame, grams: list[str]) -> tuple[Counter, int]:
    """In how many texts of ``docs`` each of ``grams`` stands, and the number of texts."""
    shared = docs.sparkSession.sparkContext.broadcast(grams)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordGrams(shared.value)
        # a last place counts the texts
        n = np.zeros(len(shared.value) + 1, np.int64)
        for batch in slices(batches):
            texts = [set(text.lower().split()) for text in batch.column(0).to_pylist()]
            for at in range(0, len(texts), 32):
                part = texts[at : at + 32]
                text, gram = known.of(part)
                found = np.zeros((len(part), len(n)), bool)
                found[text, gram] = True
                found[:, -1] = True
                n += found.sum(0)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], names=["i", "n"])

    counted = docs.select("text").mapInArrow(run, "i long, n long")
    rows = counted.groupBy("i").agg(F.sum("n").alias("n")).collect()
    total = sum(r["n"] for r in rows if r["i"] == len(grams))
    return Counter({grams[r["i"]]: r["n"] for r in rows if r["i"] < len(grams)}), total


def learn(
    texts: list[tuple[str, str]], seed: int = 1, frequencies: tuple[Counter, int] | None = None
) -> Model | None:
    """A model from (lang, text); every tenth text only fits the temperature.

    ``frequencies`` (of each n-gram, and the number of texts) are those of the
    learning examples unless given.
    """
    langs = sorted({lang for lang, _ in texts})
    if not langs:
        return None
    rng = random.Random(seed)
    texts = sorted(texts)
    rng.shuffle(texts)
    # each language keeps its first text for learning
    first = {lang: i for i, (lang, _) in reversed(list(enumerate(texts)))}
    apart = [t for i, t in enumerate(texts) if i % 10 == 9 and first[t[0]] != i]
    fitted = [t for i, t in enumerate(texts) if i % 10 != 9 or first[t[0]] == i]
    examples = _examples(fitted, rng)
    if not examples:
        return Model(langs, np.zeros(len(langs)), {})

    learned = {g for _, grams in examples for g in grams}
    seen, every = frequencies or (Counter(g for _, grams in examples for g in grams), len(examples))
    place = {g: i + 1 for i, g in enumerate(sorted(g for g in learned if seen[g] > 1))}
    idf = np.ones(len(place) + 1)  # place 0 is the bias
    for g, i in place.items():
        idf[i] = np.log((1 + every) / (1 + seen[g])) + 1
    z, n = np.zeros((len(idf), len(langs))), np.zeros((len(idf), len(langs)))

    def weights(rows: np.ndarray) -> np.ndarray:
        zr = z[rows]
        w = -(zr - np.sign(zr) * L1) / ((BETA + np.sqrt(n[rows])) / ALPHA + L2)
        return np.where(np.abs(zr) <= L1, 0.0, w)

    for _ in range(EPOCHS):
        for lang, grams in examples:
            known = [(place[g], c) for g, c in grams.items() if g in place]
            rows = np.array([0, *(i for i, _ in known)])
            x = np.array([1.0, *(c for _, c in known)])
            x[1:] *= idf[rows[1:]] * 10 / sum(grams.values())
            w = weights(rows)
            logits = x @ w
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[langs.index(lang)] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[rows] + g * g) - np.sqrt(n[rows])) / ALPHA
            z[rows] += g - sigma * w
            n[rows] += g * g
        rng.shuffle(examples)

    w = weights(np.arange(len(idf)))
    scaled = w * idf[:, None] * 10
    model = Model(langs, w[0], {g: scaled[i] for g, i in place.items() if w[i].any()})
    totals = [
        (langs.index(lang), model.words(text.lower().split()).sum(0)) for lang, text in apart or fitted
    ]

    def loss(temperature: float) -> float:
        model.temperature = temperature
        return -sum(np.log(model.probabilities(t)[k] + 1e-12) for k, t in totals)

    model.temperature = min((float(t) for t in np.geomspace(0.2, 5, 41)), key=loss)
    return model


class _Words:
    """What a task knows of the words it has met: a row each; starts anew when full."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.place: dict[str, int] = {}
        self.rows = np.empty((0, len(model.langs) + 1))

    def totals(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Sum of the rows of each text's words."""
        new = list({w for words in texts for w in words if w not in self.place})
        if len(self.place) + len(new) > MEMO:
            self.place, self.rows = {}, self.rows[:0]
            new = list({w for words in texts for w in words})
        known = len(self.place)
        if known + len(new) > len(self.rows):
            more = np.empty((max(len(new), known), self.rows.shape[1]))
            self.rows = np.concatenate([self.rows[:known], more])
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            self.rows[known + at : known + at + len(part)] = self.model.words(part)
        self.place.update(zip(new, range(known, known + len(new))))
        return [
            self.rows[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))].sum(0)
            for words in texts
        ]


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) of each row; ``und`` with score 0 where there is no letter."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        words = _Words(model) if model else None
        for batch in slices(batches):
            langs, scores = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
            if model:
                texts = [t.lower().split() if t else [] for t in batch.column(1).to_pylist()]
                for i, total in enumerate(words.totals(texts)):
                    if total[-1]:
                        p = model.probabilities(total)
                        langs[i], scores[i] = model.langs[int(p.argmax())], float(p.max())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, lang_pred string, score double"
    )


def identify(docs: DataFrame, folds: int = 5) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score.

    Learned from texts with a language whose crc32(doc_id) mod ``folds`` is not
    0: weights from at most SAMPLE_ROWS rows and SAMPLE_CHARS characters of each
    language, document frequencies from all. A null id counts as empty text, so it is
    held out. Null texts and texts without a letter are ``und`` with score 0; so is everything where nothing
    can be learned. Ties go to the first language in order. Texts are read whole, whatever
    their length. Repeated rows are predicted each; other columns are ignored; an empty table gives no rows.
    """
    train = docs.where(
        (id_remainder("doc_id", folds) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    ).select("doc_id", "text", "lang")
    sample = bounded_sample(train, "lang", SAMPLE_ROWS, SAMPLE_CHARS).collect()
    texts = [(r.lang, r.text) for r in sample]
    counted = document_frequencies(train, sample_grams(texts)) if texts else None
    predicted = predict(docs, learn(texts, frequencies=counted))
    return predicted.select(
        "doc_id", (id_remainder("doc_id", folds) == 0).alias("held_out"), "lang_pred", "score"
    )
