"""PPM against a plain coder with explicit contexts, and the baseline against its formula."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from cohortlens.llm.compression import END, SYMBOLS, score_texts

DOCS = [(i, t, 1.0) for i, t in enumerate(
    ["the cat sat", "The cat  ran\n", None, "", "a", "é ça va", "the the the", "zzz\tq", "cat " * 3_000, "x" * 70]
    + ["the cat sat", "unseen wörds here", "the end"] * 4
)] + [(None, "the", 2.0), (3, "again the cat", 3.0), (3, "again the cat", 3.0)]


def _fold(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7


def _bytes(text):
    return (text or "").encode().lower()


def _code(text, counts, most=2):
    """Coder that walks contexts from long to short, with escapes and exclusion."""
    total, data = 0.0, [*_bytes(text), END]
    for i, s in enumerate(data):
        ruled = set()
        for order in range(min(most, i), -1, -1):
            seen = {x: n for x, n in counts[tuple(data[i - order : i])].items() if x not in ruled}
            if not seen:
                continue
            all_, kinds = sum(seen.values()), len(seen)
            last = len(ruled) + kinds == SYMBOLS
            if s in seen:
                total += math.log10(seen[s] / (all_ if last else all_ + kinds))
                break
            total += math.log10(kinds / (all_ + kinds))
            ruled |= set(seen)
        else:
            total += math.log10(1 / (SYMBOLS - len(ruled)))
    return total


def _trie(texts, most=2):
    from collections import defaultdict

    counts = defaultdict(Counter)
    for text in texts:
        data = [*_bytes(text), END]
        for i, s in enumerate(data):
            for order in range(min(most, i) + 1):
                counts[tuple(data[i - order : i])][s] += 1
    return counts


@pytest.mark.parametrize("rows", [DOCS, [d for d in DOCS if _fold(d[0]) == 2], DOCS[:1]])
def test_against_plain(frame, rows):
    got = score_texts(frame(rows, "doc_id long, text string, score double")).collect()
    train = [t for i, t, _ in rows if _fold(i) != 2]
    tokens = Counter(w for t in train for w in [*_bytes(t).split(), "end"])
    n, v = sum(tokens.values()), len(tokens)
    counts = _trie(train)
    want = []
    for i, t, _ in rows:
        words = [*_bytes(t).split(), "end"]
        base = sum(math.log10((tokens[w] + 1) / (n + v + 1)) for w in words)
        want.append((str(i), _fold(i) == 2, len(words), sum(tokens[w] > 0 for w in words), n, base, _code(t, counts)))
    got = sorted((str(r.doc_id), *r[1:]) for r in got)
    assert [r[:5] for r in got] == [r[:5] for r in sorted(want)]
    np.testing.assert_allclose([r[5:] for r in got], [r[5:] for r in sorted(want)], rtol=1e-5, atol=1e-5)


def test_words_beyond_the_broadcast(frame, monkeypatch):
    frames = frame(DOCS, "doc_id long, text string, score double")
    whole = sorted(map(tuple, score_texts(frames).collect()), key=str)
    monkeypatch.setattr("cohortlens.llm.compression.FREQUENT_WORDS", 2)
    few = sorted(map(tuple, score_texts(frames).collect()), key=str)
    assert [r[:5] for r in few] == [r[:5] for r in whole]
    np.testing.assert_allclose([r[5] for r in few], [r[5] for r in whole])


def test_empty_table(frame):
    assert score_texts(frame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("order, most", [(0, 1 << 20), (4, 1 << 20), (5, 40), (4, 0)])
def test_deeper_contexts(frame, monkeypatch, order, most):
    """Code lengths of any order, whether paths are broadcast or joined."""
    monkeypatch.setattr("cohortlens.llm.compression.FREQUENT_PATHS", most)
    got = score_texts(frame(DOCS, "doc_id long, text string, score double"), order=order).collect()
    counts = _trie([t for i, t, _ in DOCS if _fold(i) != 2], order)
    want = sorted((str(i), _code(t, counts, order)) for i, t, _ in DOCS)
    got = sorted((str(r.doc_id), r.score) for r in got)
    assert [r[0] for r in got] == [r[0] for r in want]
    np.testing.assert_allclose([r[1] for r in got], [r[1] for r in want], rtol=1e-9)
