"""Conversation repair against enumeration of all edits, and a plain left-to-right search."""

import hashlib
import itertools
import random
import re
import zlib

from pyspark.sql import functions as F

from cohortlens.llm.queries import op12_conversation_repair
from cohortlens.llm.repair import joined, parsed, repair, row_cell

LEGAL = re.compile(r"(s?(ua)+)?")


def _faults(rows):
    seen, out = set(), []
    for role, text in rows:
        inside = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not inside else "duplicate" if (role, text) in seen
                   else "truncated" if inside[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def _options(role, text, fault):
    """(edit, cost, initials, said) of a row."""
    out = [("D", 3, "", [])]
    if fault not in ("blank", "duplicate"):
        extra = 1 if fault else 0
        out.append(("K", extra, role[:1] or "?", [f"{role}:{text}"]))
        out += [("R", 2 + extra, r[0], [f"{r}:{text}"]) for r in ("user", "assistant")]
    return out


def _all_ways(rows):
    inserted = [[]] + [list(x) for n in (1, 2) for x in itertools.product("ua", repeat=n)]
    names = {"u": "user:", "a": "assistant:"}
    best = None
    options = [_options(*r, f) for r, f in zip(rows, _faults(rows))]
    for picks in itertools.product(*options):
        for gaps in itertools.product(inserted, repeat=len(rows) + 1):
            audit, cost, initials, said = "", 0, "", []
            for i, gap in enumerate(gaps):
                audit, cost, initials = audit + "I" * len(gap), cost + 2 * len(gap), initials + "".join(gap)
                said = said + [names[g] for g in gap]
                if i < len(picks):
                    e, c, x, s = picks[i]
                    audit, cost, initials, said = audit + e, cost + c, initials + x, said + s
            if LEGAL.fullmatch(initials) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, said)
    return best


def _search(rows):
    """Least (cost, audit) row by row, over the places of the pattern."""
    steps = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def insert(now):
        for _ in range(3):
            for (p, x), q in steps.items():
                if x != "s" and p in now:
                    c, a, s = now[p]
                    new = (c + 2, a + "I", s + [{"u": "user:", "a": "assistant:"}[x]])
                    now[q] = min(now.get(q, new), new)
        return now

    now = insert({0: (0, "", [])})
    for row, fault in zip(rows, _faults(rows)):
        after = {}
        for p, (c, a, s) in now.items():
            for e, cost, x, said in _options(*row, fault):
                q = p if e == "D" else steps.get((p, x))
                if q is not None:
                    new = (c + cost, a + e, s + said)
                    after[q] = min(after.get(q, new), new)
        now = insert(after)
    return min(now[p] for p in (0, 3) if p in now)


TEXTS = ["Yes.", "No!", "cut", " \t", "", "Why? \n", "é", "x.", "end.)"]
ROLES = ["user", "assistant", "system", "tool", " ", "", "usher"]


def _random_rows(rng, n):
    return [(rng.choice(ROLES[:3] if rng.random() < 0.8 else ROLES), rng.choice(TEXTS)) for _ in range(n)]


def test_search_is_the_least_of_all_ways():
    rng = random.Random(5)
    for n in (0, 1, 2, 2, 3):
        for _ in range(12 if n < 3 else 3):
            rows = _random_rows(rng, n)
            assert _search(rows) == _all_ways(rows)


def _said(edits):
    out = {}
    for r in edits.collect():
        out.setdefault(r.conv_id, []).append((tuple(r.place), r.edit, f"{r.role}:{r.text}"))
    return {c: [s for _, e, s in sorted(v) if e != "D"] for c, v in out.items()}


def _repaired(frame, convs, **sizes):
    rows = [(c, i, role, text, 1, "x") for c, v in convs.items() for i, (role, text) in enumerate(v)]
    turns = frame(rows, "conv_id long, turn long, role string, text string, n int, uid string")
    whole, edits = repair(turns, **sizes)
    return {r.conv_id: r for r in whole.collect()}, _said(edits)


def test_repair(frame):
    rng = random.Random(2)
    convs = {i: _random_rows(rng, 1 + i % 9) for i in range(60)}
    convs |= {100 + i: _random_rows(rng, n) for i, n in enumerate((16, 17, 40, 300))}
    convs[None] = _random_rows(rng, 4)
    for sizes in ({}, {"block": 3, "fan": 2}):
        whole, said = _repaired(frame, convs, **sizes)
        for conv, rows in convs.items():
            cost, audit, lines = _search(rows)
            r, faults = whole[conv], _faults(rows)
            assert (r.cost, r.audit, said.get(conv, [])) == (cost, audit, lines), conv
            assert [r.blank, r.duplicate, r.truncated] == [
                faults.count(k) for k in ("blank", "duplicate", "truncated")
            ]
            pairs = [a[0][:1] + b[0][:1] for a, b in zip(rows, rows[1:])]
            assert r.illegal == sum(p not in ("su", "ua", "au") for p in pairs)


def test_all_splits_give_the_same():
    rng = random.Random(3)
    for _ in range(20):
        cells = [row_cell(rng.choice("suat"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(9)]
        one = cells[0]
        for c in cells[1:]:
            one = joined(one, c)
        assert parsed(cells) == one


def test_a_long_conversation(frame):
    rng = random.Random(4)
    rows = [(("user", "assistant")[i % 2] if rng.random() < 0.9 else "system", f"{i}.") for i in range(6_000)]
    whole, said = _repaired(frame, {1: rows, 2: rows[:3]})
    assert (whole[1].cost, whole[1].audit) == _search(rows)[:2]
    assert LEGAL.fullmatch("".join(s[0] for s in said[1]))


def test_query(frame, tmp_path):
    """Damage, order, nulls, repeated rows, dropped conversations, very long texts."""
    rng = random.Random(6)
    rows = [(c, t, rng.choice(ROLES[:3]), rng.choice(TEXTS + ["A. b! c?", "Q?"]) * rng.randint(1, 3), 7)
            for c in range(150) for t in range(rng.randint(1, 9))]
    rows += [(None, 1, "user", "a.", 7), (None, None, None, None, 7), (None, 2, "assistant", "b.", 7)]
    rows += [(500, None, "user", "x.", 7), (500, None, "user", "x.", 7), (501, 3, "user", "long " * 50_000 + ".", 7)]
    rows += [rows[0], rows[1]]
    spark = frame([], "x int").sparkSession
    for part in (rows, []):
        folder = str(tmp_path / str(len(part)))
        frame(part, "conv_id long, turn long, role string, text string, size long").write.parquet(
            f"{folder}/conversations.parquet"
        )
        got = {r.conv_id: tuple(r) for r in op12_conversation_repair(spark, folder).collect()}
        assert got == _plain_query([r[:4] for r in part])


def _plain_query(rows):
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        k = zlib.crc32(key.encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        if k:
            kept += [(turn is not None, turn or 0, "user" if k == 4 else role,
                      hashlib.md5(text.encode()).hexdigest(), text)] * (2 if k == 3 else 1)
    out = {}
    for conv, kept in convs.items():
        kept = sorted(kept)
        turns = [t for known, t, *_ in kept if known]
        lines = [(r, t) for _, _, r, _, t in kept]
        faults = _faults(lines)
        cost, audit, said = _search(lines)
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(lines, lines[1:])]
        out[conv] = (
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(said).encode()).hexdigest(),
        )
    return out


def test_empty(frame):
    turns = frame([], "conv_id long, turn long, role string, text string")
    whole, edits = repair(turns)
    assert whole.collect() == [] and edits.collect() == []
    assert turns.where(F.lit(False)).count() == 0
