"""Line dedup against a plain version; what is inserted can be taken out again."""

import random

import numpy as np
import pytest

from cohortlens.llm import lines
from cohortlens.llm.lines import Cuckoo, LineIndex, dedup_lines

SPACE = " \t\n\x0b\x0c\r"


def _key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def _plain(docs, known=None):
    """[(doc_id, n_lines, n_dropped, text)] of ``docs`` by the lines of ``known``."""
    holders = {}
    for doc, text in docs if known is None else known:
        if doc is not None:
            for line in (text or "").split("\n"):
                if len(_key(line)) >= 20:
                    holders.setdefault(_key(line), set()).add(doc)
    out = []
    for doc, text in docs:
        every = (text or "").split("\n")
        kept = [x for x in every if doc is None or len(holders.get(_key(x), ())) < 3
                or doc == max(holders[_key(x)])]
        out.append((doc, len(every), len(every) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def _docs(rng, ids):
    pool = [f"{'Line' if i % 2 else ' line'} number {i} of the pool, é{i}" for i in range(40)]
    pool += ["short", "x" * 19, "y" * 20, " " + "z" * 19 + " ", "É" * 20, "é" * 20, "", "\t" + "W" * 25 + "\r"]
    return [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for i in ids]


SCHEMA = "doc_id long, text string"


def _got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _rows():
    rows = _docs(random.Random(1), range(80))
    rows += [(None, rows[0][1]), (None, None), (200, None), (201, ""), (202, "\n"), rows[3], rows[3]]
    rows += [(5, "w" * 25 + "\n" + rows[7][1]), (300, "W" * 25 + "\n" + "many words here " * 20_000)]
    return rows


def test_against_plain(frame):
    rows = _rows()
    docs = frame([(*r, 1, "c", 2) for r in rows], SCHEMA + ", h1 int, line string, text_hash long")
    assert _got(dedup_lines(docs)) == _plain(rows)


def test_empty(frame):
    assert _got(dedup_lines(frame([], SCHEMA))) == []


def test_insert_and_delete(frame, tmp_path):
    rng = random.Random(2)
    first, second = _docs(rng, range(60)), _docs(rng, range(60, 100))
    every = first + second
    spark = frame([], SCHEMA).sparkSession
    index = LineIndex(spark, str(tmp_path / "index"))
    assert _got(index.clean(frame(first, SCHEMA))) == _plain(first, [])
    index.insert(frame(first, SCHEMA))
    before = _state(index)
    assert _got(index.clean(frame(first, SCHEMA))) == _plain(first)
    index.insert(frame(second, SCHEMA))
    assert _got(index.clean(frame(every, SCHEMA))) == _plain(every)
    # a reader that opens the folder anew sees the same
    index = LineIndex(spark, str(tmp_path / "index"))
    assert _got(index.clean(frame(second, SCHEMA))) == _plain(second, every)
    # replacing documents is deleting and inserting them
    changed = [(i, t.upper()) for i, t in second[:10]] + [(7, "only a line that is new here")]
    index.insert(frame(changed, SCHEMA))
    now = [r for r in every if r[0] not in dict(changed)] + changed
    assert _got(index.clean(frame(every, SCHEMA))) == _plain(every, now)
    index.insert(frame([r for r in every if r[0] == 7], SCHEMA))
    index.delete(frame([(i,) for i, _ in second] + [(10**6,), (None,)], "doc_id long"))
    assert _got(index.clean(frame(first, SCHEMA))) == _plain(first)
    assert _state(index) == before
    index.delete(frame([(i,) for i, _ in every], "doc_id long"))
    assert _state(index) == ([], [], [])


def _state(index):
    """References, counts, and which keys the filters hold, whatever their order inside."""
    refs = sorted(map(tuple, index.refs().collect()))
    counts = sorted(map(tuple, index.counts().collect()))
    entries = []
    for r in index.filters().collect():
        table = np.frombuffer(bytes(r.cells), np.uint16)
        assert np.count_nonzero(table) == r.n_keys
        entries += [(r.level, r["shard"], r.n_keys)] if r.n_keys else []
        mine = [c for c in counts if c[0] & (index.log[-1]["shards"] - 1) == r["shard"]]
        held = np.array([c[1] for c in mine if r.level == 1 or c[2] >= 3], np.int64).view(np.uint64)
        assert not len(held) or Cuckoo.read(bytes(r.cells)).holds(held).all()
    return refs, counts, sorted(entries)


def test_filters_grow(frame, tmp_path, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_KEYS", 32)
    index = LineIndex(frame([], SCHEMA).sparkSession, str(tmp_path / "index"))
    rows, sizes = [], []
    for part in range(3):
        new = [(part * 50 + i, f"a line of its own: {part} {i}\na line of all the documents")
               for i in range(3 * 7**part)]
        rows += new
        index.insert(frame(new, SCHEMA))
        sizes.append(index.log[-1]["shards"])
        _state(index)
        assert _got(index.clean(frame(rows, SCHEMA))) == _plain(rows)
    assert sizes[-1] > sizes[0]


@pytest.mark.parametrize("path", ["screened", "not screened", "frequent keys apart"])
def test_paths_of_the_look_up(frame, tmp_path, monkeypatch, path):
    if path == "not screened":
        monkeypatch.setattr(lines, "FILTER_BYTES", -1)
    if path == "frequent keys apart":
        monkeypatch.setattr(lines, "HEAVY_KEYS", 10)
    rows = _docs(random.Random(4), range(120)) + [(i, "a line that is in each of them") for i in range(200, 400)]
    assert _got(dedup_lines(frame(rows, SCHEMA))) == _plain(rows)


def test_cuckoo():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**64, 50_000, np.uint64))
    filled = Cuckoo.of(keys)
    assert filled.holds(keys).all()
    others = rng.integers(0, 2**64, 100_000, np.uint64)
    assert filled.holds(others).mean() < 0.001
    filled.remove(keys[::2])
    assert filled.holds(keys[1::2]).all() and filled.holds(keys[::2]).mean() < 0.001
    assert filled.insert(keys[::2]) and filled.holds(keys).all()
    assert Cuckoo.read(filled.write()).holds(keys).all()
    filled.remove(keys)
    assert not filled.table.any()
