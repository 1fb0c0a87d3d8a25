"""Toxicity: held-out accuracy, gapped insults, edge cases."""

import os
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cohortlens.llm.toxicity import Kernel, drop_toxic, fit, learn, plain, rate, score, strings

SYLLABLES = ["the", "an", "er", "on", "th", "re", "ou", "ha", "in", "nd", "ing", "ed"]
INSULTS = ["idiot", "moron", "scum", "trash", "clown", "loser"]


def _text(rng, insults=0, n=60):
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]
    for _ in range(insults):
        words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    docs = [(i, _text(rng, 3 * (i % 4 == 0))) for i in range(400)]
    return docs, [(i, int(i % 4 == 0)) for i, _ in docs]


def test_kernel_against_definition():
    kernel = Kernel()

    def plain(word):
        out, norm = {}, 0.0
        for i in range(len(word)):
            for j in range(i + 1, len(word)):
                for k in range(j + 1, min(len(word), i + 5)):
                    out[word[i] + word[j] + word[k]] = out.get(word[i] + word[j] + word[k], 0) + 0.7 ** (k - i + 1)
                    norm += 0.7 ** (2 * (k - i + 1))
        return {u: x / norm**0.5 for u, x in out.items()}

    words = ["idiot", "idxiot", "the", "banana", "clown"]
    columns = kernel.features(words)
    got = columns.T @ columns
    parts = [plain(w) for w in words]
    want = [[sum(a[u] * b.get(u, 0) for u in a) for b in parts] for a in parts]
    np.testing.assert_allclose(got, want, rtol=1e-4, atol=1e-6)
    symbols, _ = kernel.windows(words)
    np.testing.assert_allclose(kernel.sums(symbols, columns), want, rtol=1e-4, atol=1e-5)


def test_gaps_and_inserted_characters(corpus):
    kernel = Kernel()
    texts, labels = corpus
    model = learn([(y, t) for (_, t), (_, y) in zip(texts, labels)], kernel)
    hidden = ["idiot", "id.iot", "i-d-i-o-t", "i d i o t", "IDIOT!!", "idiiot", "mo.ron", "longprefixidiottail", "id iot", "mo ron", "cl own"]
    usual = ["thean", "onreou", "hander", "the", "ing", ""]
    assert min(model.margins(kernel, hidden)) > max(model.margins(kernel, usual))


def test_split_insults_are_seen(corpus):
    assert {"id iot", "a, b"} <= set(strings("Some long ID IOT here\nwords a, b"))
    kernel = Kernel()
    texts, labels = corpus
    model = learn([(y, t) for (_, t), (_, y) in zip(texts, labels)], kernel)
    rng = random.Random(5)
    for hidden in ("id iot", "mo ron", "sc um", "i d i o t"):
        text = _text(rng)
        both = [model.probability(model.margins(kernel, sorted(set(strings(t))))) for t in (text, text + f" {hidden} {hidden}")]
        assert both[1] > both[0]


def _plain_score(model, text):
    """From the weights by their definition: triples with gaps, windows, strongest strings."""
    table = Kernel().table
    best = []
    for word in set(strings(text)):
        symbols = [int(table[min(ord(c), 0xFFFF)]) if ord(c) < 0x10000 else 28 for c in plain(word)]
        margins = []
        for start in range(0, max(1, -(-(len(symbols) - 16) // 8) + 1) * 8, 8):
            part = symbols[start : start + 16]
            total = norm = 0.0
            for i in range(len(part)):
                for j in range(i + 1, len(part)):
                    for k in range(j + 1, min(len(part), i + 5)):
                        w = 0.7 ** (k - i + 1)
                        total += w * float(model.weights[(part[i] * 40 + part[j]) * 40 + part[k]])
                        norm += w * w
            margins.append(total / max(norm, 1e-12) ** 0.5 + model.offset)
        best.append(max(margins))
    top = (sorted(best, reverse=True) + [-2.0, -2.0])[:2]
    return 1 / (1 + np.exp(-(model.slopes @ np.array(top) + model.shift)))


def test_scores_against_the_weights(frame, corpus):
    docs, labels = corpus
    rows = docs[:60] + [(-1, ""), (-2, "x" * 70 + " id iot é😀"), (-3, None), (-4, docs[0][1]), (-4, docs[0][1])]
    table, marked = frame(docs, "doc_id long, text string"), frame(labels, "doc_id long, toxic int")
    model = fit(table, marked)
    got = score(frame(rows, "doc_id long, text string"), model).collect()
    for r, (doc, text) in zip(sorted(got, key=lambda r: -r.doc_id), sorted(rows, key=lambda r: -r[0])):
        assert r.doc_id == doc and r.score == pytest.approx(_plain_score(model, text or ""), abs=1e-4)


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.1"), reason="needs the larger table")
def test_larger_table():
    """Held-out labels of the larger table: most toxic texts are found, few clean ones marked."""
    folder = "/root/testdata/sf0.1"
    texts = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    texts = dict(zip(texts["doc_id"], texts["text"]))
    marks = pq.read_table(f"{folder}/labels.parquet", columns=["doc_id", "toxic"]).to_pydict()
    learning, held = [], []
    for doc, y in sorted(zip(marks["doc_id"], marks["toxic"])):
        if doc in texts and y is not None:
            (held if zlib.crc32(str(doc).encode()) % 5 == 0 else learning).append((y, texts[doc] or ""))
    toxic = [x for x in learning if x[0]]
    kernel = Kernel()
    model = learn(toxic + [x for x in learning if not x[0]][:1_500], kernel)
    found = [
        (y, model.probability(model.margins(kernel, sorted(set(strings(t))))) >= 0.5) for y, t in held
    ]
    caught = sum(p for y, p in found if y)
    alarms = sum(p for y, p in found if not y)
    assert caught >= 0.82 * sum(y for y, _ in held), caught
    assert alarms <= 0.03 * sum(1 - y for y, _ in held), alarms


def test_held_out(frame, corpus):
    docs, labels = corpus
    rows = [(i, t, "x", 0) for i, t in docs] + [(-1, None, "x", 0), (-1, None, "x", 0), (-2, "", None, 0)]
    rows += [(None, "some text", "x", 0), (-3, _text(random.Random(1), n=40_000), "x", 0)]
    marked = frame([*labels, (5, None), (None, 1), (400, 1), (400, 0)], "doc_id long, toxic int")
    got = rate(frame(rows, "doc_id long, text string, held_out string, score int"), marked).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0) for r in got)
    truth = dict(labels)
    checked = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(checked) > 50 and sum(r.predicted == truth[r.doc_id] for r in checked) >= 0.97 * len(checked)
    assert all(r.predicted == 0 for r in got if r.doc_id in (-1, -2))


def test_removal_keeps_clean_rows(frame, corpus):
    docs, labels = corpus
    table = frame([(i, t, i * 2) for i, t in docs] + [(-1, None, 3)], "doc_id long, text string, score long")
    kept = drop_toxic(table, frame(labels, "doc_id long, toxic int"))
    assert kept.columns == table.columns
    left = {r.doc_id for r in kept.collect()}
    clean = {i for i, y in labels if y == 0} | {-1}
    assert len(clean - left) <= 6 and len(left - clean) <= 6 and -1 in left


def test_nothing_to_learn(frame):
    labels = frame([(1, 0)], "doc_id long, toxic int")
    docs = frame([(1, "a b c"), (2, None)], "doc_id long, text string")
    assert [r.score for r in rate(docs, labels).collect()] == [0.0, 0.0]
    assert rate(frame([], "doc_id long, text string"), labels).collect() == []


def test_over_long_labelled_texts(frame, corpus, monkeypatch):
    # a toxic text above the bound in the place of the first in the order of the hash
    monkeypatch.setattr("cohortlens.llm.toxicity.SAMPLE_CHARS", 200_000)
    docs, labels = corpus
    long = _text(random.Random(2), 40, 60_000)
    table = frame(docs, "doc_id long, text string")
    order = table.where("doc_id % 4 = 0 and crc32(cast(doc_id as string)) % 5 <> 0").orderBy(
        F.xxhash64(F.col("doc_id").cast("string"))
    )
    first = order.first().doc_id
    rows = [(i, long if i == first else t) for i, t in docs]
    got = rate(frame(rows, "doc_id long, text string"), frame(labels, "doc_id long, toxic int")).collect()
    truth = dict(labels)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert any(r.predicted for r in held)
