"""Secret scans against a plain regular-expression scan."""

import re

from cohortlens.llm.secrets import find_secrets, mask_secrets

KEY = "AKIA" + "ABCDEFGH12345678"
MIXED = "aB3" * 9
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.I | re.A,
)
DOCS = [
    (1, f"é token = \"abcdefghijkl\" and {KEY}, 0123456789abcdef0 x", "a", 1),
    (2, "token=secret:abcdefghijklmnop PassWord: 'short' API_KEY=" + "z" * 40, "a", 2),
    (3, None, "a", 3),
    (4, "", None, 4),
    (5, f"own {MIXED} here 😀 {MIXED}z", "a", 5),
    (6, f"copied {MIXED}z", "b", 6),
    (7, f"copied {MIXED}q", None, 7),
    (7, f"copied {MIXED}q", None, 7),
    (None, "AKIA" + "A" * 13 + " nothing", "c", 8),
    (8, ("deadbeefdeadbeef " * 500) + "x" * 50_000, "c", 9),
    (9, f"secret={MIXED[::-1]}", "d", 10),
]
SCHEMA = "doc_id long, text string, source string, spans int"


def _base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def test_base_spans(frame):
    got = find_secrets(frame(DOCS, SCHEMA)).collect()
    assert len(got) == len(DOCS)
    base = [(r.doc_id, [(s.start, s.rank, s.end) for s in r.spans if s.rank < 3]) for r in got]
    assert sorted(base, key=repr) == sorted(((i, _base(t)) for i, t, *_ in DOCS), key=repr)


def test_ownership(frame):
    rows = {r.doc_id: r.spans for r in find_secrets(frame(DOCS, SCHEMA)).collect()}
    assert [(s.kind, s.n_owners, s.n_texts) for s in rows[5]] == [("owned", 1, 1), ("owned", 2, 2)]
    assert [s.n_owners for s in rows[6]] == [2] and [(s.kind, s.n_texts) for s in rows[7]] == [("owned", 1)]
    assert [s.kind for s in rows[9]] == ["assign"]  # a base span stands for what it covers
    assert {s.n_texts for s in rows[8]} == {1} and len(rows[8]) == 500


def _kinds(frame, rows, **limits):
    docs = frame([(i, t, s, "kept") for i, (t, s) in enumerate(rows)], "doc_id long, text string, source string, repository string")
    found = find_secrets(docs, **limits).collect()
    masked = {r.doc_id: r.text for r in mask_secrets(docs, **limits).collect()}
    for r in found:
        assert ("[owned]" in masked[r.doc_id]) == any(s.kind == "owned" for s in r.spans)
    return [len(r.spans) for r in sorted(found, key=lambda r: r.doc_id)]


def test_widely_copied(frame):
    # three owners with three texts: an example; a copy of one text in many sources is not
    assert _kinds(frame, [(f"{s} {MIXED}", s) for s in "abc"]) == [0, 0, 0]
    assert _kinds(frame, [(f"x {MIXED}", s) for s in "abcdef"] + [(f"x {MIXED}", None)]) == [1] * 7
    assert _kinds(frame, [(f"x {MIXED}", "a"), (f"y {MIXED}", "b"), (f"x {MIXED}", "c")]) == [1] * 3
    # one owner: live up to twenty texts, an example beyond
    assert _kinds(frame, [(f"{i} {MIXED}", "a") for i in range(20)]) == [1] * 20
    assert _kinds(frame, [(f"{i} {MIXED}", "a") for i in range(21)]) == [0] * 21
    assert _kinds(frame, [(f"{i} {MIXED}", "a") for i in range(5)], most_texts=4) == [0] * 5
    # base spans stay, and say so
    base = find_secrets(frame([(i, f"{i} {KEY}", "abc"[i % 3], 0) for i in range(30)], SCHEMA))
    assert {(s.kind, s.live, s.n_texts) for r in base.collect() for s in r.spans} == {("access", False, 30)}


def test_masking(frame):
    docs = frame(DOCS, "doc_id long, text string, source string, n_chars int")
    got = mask_secrets(docs)
    assert got.columns == docs.columns
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[1].text == "é [assign]\" and [access], [hex] x"
    assert rows[1].n_chars == len(rows[1].text)
    assert rows[3].text is None and rows[4].text == "" and rows[6].text == "copied [owned]"
    assert rows[5].text == "own [owned] here 😀 [owned]"
    assert got.count() == len(DOCS)


def test_empty_table(frame):
    assert find_secrets(frame([], SCHEMA)).collect() == []
    assert mask_secrets(frame([], SCHEMA)).collect() == []
