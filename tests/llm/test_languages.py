"""Language identification: held-out accuracy, calibration, edge cases."""

import zlib

import numpy as np
import pytest

from cohortlens.llm.common import bounded_sample, id_remainder
from cohortlens.llm.languages import (
    Model,
    _grams,
    _key,
    _WordGrams,
    document_frequencies,
    identify,
    learn,
    predict,
)
from cohortlens.llm.queries import op6_language_id


def test_held_out_accuracy(spark, folder):
    langs = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect())
    rows = op6_language_id(spark, folder).collect()
    assert len(rows) == len(langs)
    held = [r for r in rows if r.held_out]
    assert held and all(0 < r.score <= 1 for r in held)
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.97 * len(held)


def test_edges(frame):
    texts = {"en": "the cat and the dog with this", "de": "der hund und die katze mit diesem"}
    rows = [(i, " ".join(np.random.RandomState(i).permutation(t.split())), lang, 1)
            for lang, t in texts.items() for i in range(0 if lang == "en" else 100, 60 if lang == "en" else 160)]
    odd = [(1000, None, "en", 1), (1001, "", "en", 1), (1002, "123 !? 😀", None, 1), (1002, "123 !? 😀", None, 1),
           (None, "the dog", "xx", 1), (1003, "und der hund " * 20_000, None, 1), (1004, "日本語", None, 1)]
    docs = frame(rows + odd, "doc_id long, text string, lang string, score int")
    got = identify(docs).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1000, 1001, 1002))
    assert by[1003].lang_pred == "de" and by[None].lang_pred == "en" and by[None].held_out
    assert by[1004].lang_pred in texts and 0 < by[1004].score <= 1


def test_nothing_to_learn(frame):
    docs = frame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in identify(docs).collect()] == [("und", 0.0)]
    assert identify(frame([], "doc_id long, text string, lang string")).collect() == []


def test_weights_are_sparse_and_probabilities_sum():
    model = learn([("a", "aba abb baa " * 9), ("b", "xyx yyx xxy " * 9)] * 10)
    assert 0 < len(model.weights) - 1 < len({g for w in "aba abb baa xyx yyx xxy".split() for g in w} | set("abxy")) * 30
    assert abs(model.probabilities(model.words(["abxy"])[0]).sum() - 1) < 1e-12


def test_word_rows_against_their_grams():
    grams = {g: np.array([i + 1.0, -i]) for i, g in enumerate(_grams("aba,bäb") + ["zzz", "<z", "q"])}
    model = Model(["x", "y"], np.zeros(2), grams)
    words = ["aba", "12", "aba,bäb", "", "q", "zz", "b\U00010400z", "a1b", "é"]
    for word, row in zip(words, model.words(words)):
        parts = [grams.get(g, np.zeros(2)) for g in _grams(word)]
        assert row[-1] == len(parts)
        np.testing.assert_allclose(row[:-1], sum(parts, np.zeros(2)))


@pytest.mark.parametrize("at", range(12))
def test_an_over_long_text_removes_no_other(frame, at):
    # whichever place the long text has in the order of the hash, the others stay
    rows = [(i, "x" * (2_000 if i == at else 20), "a") for i in range(12)] + [(50, "y" * 3_000, "b")]
    got = bounded_sample(frame(rows, "doc_id long, text string, lang string"), "lang", 100, 1_000)
    texts = [(r.lang, r.text) for r in got.collect()]
    assert sorted(texts) == [("a", "x" * 20)] * 11 + [("b", "y" * 200)]


def test_language_with_long_texts_only_is_learned(frame, monkeypatch):
    monkeypatch.setattr("cohortlens.llm.languages.SAMPLE_CHARS", 4_000)
    kinds = {"en": "the cat and the dog with this ", "de": "der hund und die katze mit diesem "}
    rows = [(i, kinds["en"], "en") for i in range(40)] + [(i, kinds["de"] * 200, "de") for i in range(40, 80)]
    got = identify(frame(rows, "doc_id long, text string, lang string")).collect()
    assert {(r.doc_id >= 40, r.lang_pred) for r in got} == {(False, "en"), (True, "de")}


def test_document_frequencies_of_all_texts(frame, monkeypatch):
    texts = ["aba ab", "ab", "ba ba", "", "12"] * 7
    rows = frame([(t,) for t in texts], "text string").repartition(3)
    seen, every = document_frequencies(rows, ["<a", "aba", "b", "zz"])
    assert every == 35 and dict(seen) == {"<a": 14, "aba": 7, "b": 21}
    # the model sees them: a sample of one text a language, frequencies of all
    given = []
    monkeypatch.setattr("cohortlens.llm.languages.SAMPLE_ROWS", 1)
    monkeypatch.setattr(
        "cohortlens.llm.languages.learn", lambda t, frequencies: given.append((len(t), frequencies[1]))
    )
    identify(frame([(i, "some words", "en") for i in range(60)], "doc_id long, text string, lang string"))
    assert given == [(1, sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(60)))]


def test_word_grams_against_their_definition(monkeypatch):
    grams = sorted({*_grams("aba,bäb"), "zz", "q", "\U00010400"})
    monkeypatch.setattr("cohortlens.llm.languages.MEMO", 6)
    known = _WordGrams(grams)
    texts = [{"aba", "12"}, set(), {"aba,bäb", "q", "zz", "a1b"}, {"b\U00010400z", "é", "aba"}, {"", "1"}]
    for part in (texts[:2], texts[1:3], texts, texts[3:]):
        text, gram = known.of(part)
        for i, words in enumerate(part):
            want = {g for w in words for g in _grams(w) if g in grams}
            assert {grams[g] for g in gram[text == i]} == want


def test_scores_against_the_weights(spark, folder):
    """Each whole text by the definition: weights of its n-grams over their number, one temperature."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    train = docs.where(id_remainder("doc_id", 5) != 0)
    model = learn([(r["lang"], r["text"]) for r in train.orderBy("doc_id").limit(60).collect()])
    row = {int(k): w for k, w in zip(model.keys, model.weights)}
    got = {r.doc_id: r for r in predict(docs, model).collect()}
    for r in docs.where("doc_id % 7 = 0").collect():
        grams = [_key(g) for w in r.text.lower().split() for g in _grams(w)]
        logits = model.bias + sum((row[g] for g in grams if g in row), np.zeros(len(model.langs))) / max(len(grams), 1)
        p = np.exp(logits / model.temperature - (logits / model.temperature).max())
        p /= p.sum()
        if grams:
            assert got[r.doc_id].lang_pred == model.langs[int(p.argmax())]
            assert got[r.doc_id].score == pytest.approx(p.max(), abs=1e-9)
