"""Decontamination against a plain scan."""

import re

import pytest

from cohortlens.llm.decontamination import contamination, drop_contaminated

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def _words(text):
    return WORD.findall((text or "").translate(ASCII))


def _plain(text, items):
    words, hit, found = _words(text), set(), set()
    for name, item in items:
        item = _words(item)
        k = min(13, len(item))
        for s in range(len(item) - k + 1) if k else ():
            for i in range(len(words) - k + 1):
                if words[i : i + k] == item[s : s + k]:
                    hit.update(range(i, i + k))
                    found.add(str(name))
    return len(words), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(words)


DOCS = [
    (1, f"x {ITEM.upper()} y", "s"),
    (2, "short É item", "s"),
    (3, "Before short, É!item after " + "pad " * 200, "s"),
    (4, None, "s"),
    (5, "", "s"),
    (5, ITEM, "t"),
    (None, ITEM + " " + ITEM, "t"),
    (6, "short é item", "t"),
    (7, "clean words only", None),
    (7, "clean words only", None),
    (8, " ".join(ITEM.split()[1:]) + " long" * 5_000, "t"),
]
ITEMS = [(10, ITEM), (2, ITEM + " tail"), (3, "Short É item"), (4, None), (5, "!!"), (None, "after pad")]


@pytest.mark.parametrize("items", [ITEMS, ITEMS[:2], []])
def test_against_scan(frame, items):
    docs = frame(DOCS, "doc_id long, text string, items string")
    got = contamination(docs, frame(items, "item_id long, text string")).collect()
    want = []
    for i, text, _ in DOCS:
        named = [(n, t) for n, t in items if n is not None]
        n, _, found, _ = _plain(text, named)
        _, hit, _, bad = _plain(text, items)
        want.append((i, n, hit, found, bad))
    rows = [(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got]
    assert sorted(rows, key=repr) == sorted(want, key=repr)


def test_spans_and_removal(frame):
    docs = frame(DOCS, "doc_id long, text string, items string")
    bench = frame(ITEMS, "item_id long, text string")
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in contamination(docs, bench).collect()}
    assert spans[1] == [(2, 15)] and spans[3] == [(2, 6)]
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4", "5", "6", "7", "7", "8"]


def test_empty_documents(frame):
    empty = frame([], "doc_id long, text string")
    assert contamination(empty, frame(ITEMS, "item_id long, text string")).collect() == []
