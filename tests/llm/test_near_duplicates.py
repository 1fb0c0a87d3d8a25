"""The Jaccard join against all pairs."""

import random
from collections import Counter

import pytest

from cohortlens.llm import near_duplicates as nd
from cohortlens.llm.common import byte_words


def _set(text):
    words = byte_words(text)
    k = min(5, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if k else frozenset()


def _plain(rows, threshold=0.8):
    """(id, class, links, copies) of every row, by comparing all pairs of sets."""
    sets = Counter(s for _, t in rows if (s := _set(t)))
    keys = list(sets)
    parent, links = list(range(len(keys))), [0] * len(keys)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(keys):
        for j in range(i):
            both = len(a & keys[j])
            if both >= threshold * (len(a) + len(keys[j]) - both):
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    place = {s: i for i, s in enumerate(keys)}
    least = {}
    for d, t in rows:
        if s := _set(t):
            r = root(place[s])
            least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    out = []
    for d, t in rows:
        if s := _set(t):
            i = place[s]
            out.append((d, least[root(i)], links[i], sets[s]))
        else:
            out.append((d, d, 0, 1))
    return sorted(out, key=repr)


def _rows(seed=2):
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randint(0, 5_000)
    shared = [word() for _ in range(60)]
    rows, n = [], 0
    for _ in range(60):
        base = [word() for _ in range(rng.randint(1, 200))]
        if rng.random() < 0.3:
            base = shared + base
        for _ in range(rng.choice([1, 1, 2, 3, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            rows.append((n, " ".join(copy)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " .,! "), (n + 3, "a b"), (n + 4, "A, b."), (None, "a b")]
    rows += [(n + 5, "x " * 30_000), (n + 6, "X x " * 9_000), rows[0], rows[0], (None, None)]
    rows += [(3, "another text under an id that is taken"), (None, "only nulls here"), (None, "only nulls here")]
    return rows


SCHEMA = "doc_id long, text string, first string, class_id int"


def _frame(frame, rows):
    return frame([(d, t, "f", 1) for d, t in rows], SCHEMA)


def _got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "class_id", "n_links", "n_copies").collect()), key=repr)


def test_against_all_pairs(frame):
    rows = _rows()
    got = nd.near_duplicates(_frame(frame, rows))
    assert _got(got) == _plain(rows)
    firsts = Counter(r.class_id for r in got.where("first and worded").collect())
    assert set(firsts.values()) == {1} or firsts.pop(None) >= 1 and set(firsts.values()) == {1}


def test_crowded_prefix_in_blocks(frame, monkeypatch):
    rng = random.Random(4)
    base = ["w%d" % rng.randint(0, 9_999) for _ in range(120)]
    rows = []
    for i in range(70):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = f"v{i}"
        rows.append((i, " ".join(copy)))
    monkeypatch.setattr(nd, "BLOCK", 5)
    assert _got(nd.near_duplicates(_frame(frame, rows))) == _plain(rows)


def test_one_of_each_class_stays(frame):
    rows = _rows()
    docs = _frame(frame, rows)
    kept = nd.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    left = Counter(r.doc_id for r in kept.collect() if _set(r.text))
    classes = {c for (d, c, _, _) in _plain([r for r in rows if _set(r[1])])}
    assert set(left) == classes and all(n == 1 for d, n in left.items() if d not in (None, 3))
    assert sum(1 for r in kept.collect() if not _set(r.text)) == 4


def test_empty_tables(frame):
    assert nd.near_duplicates(_frame(frame, [])).collect() == []
    assert nd.drop_near_duplicates(_frame(frame, [(1, None)])).count() == 1


@pytest.mark.parametrize("target, depth", [(0.9, 8), (0.9995, 4), (0.99999, 2)])
def test_depth(target, depth):
    got = nd.depth_for_recall(0.8, 16, 8, target)
    assert 1 - (1 - 0.8**got) ** 16 >= target and got <= 8
    assert got == depth


def test_components(spark):
    edges = [(i, i - 1) for i in range(1, 40)] + [(100 + i, 100) for i in range(1, 9)] + [(201, 200)]
    got = dict(nd.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 if i < 40 else 100 if i < 200 else 200 for i in [*range(40), *range(100, 109), 200, 201]}


def test_equal_rows_are_compared_once(frame, monkeypatch):
    """Many equal rows with a near copy: the key that they are compared under gets one row a set."""
    rng = random.Random(4)
    words = ["w%d" % rng.randint(0, 999) for _ in range(80)]
    near = words[:-1] + ["other"]
    spark = frame([], "x int").sparkSession
    copies = spark.range(100_000).selectExpr("cast(null as long) doc_id", f"'{' '.join(words)}' text")
    docs = copies.union(frame([(7, " ".join(near))], "doc_id long, text string"))
    seen = []
    compare = nd._compare
    monkeypatch.setattr(nd, "_compare", lambda m, t: seen.append(m.groupBy("prefix", "first", "second").count()) or compare(m, t))
    got = nd.near_duplicates(docs).groupBy("class_id", "n_links", "n_copies").count().collect()
    assert sorted(map(tuple, got), key=str) == [(7, 1, 1, 1), (7, 1, 100_000, 100_000)]
    # one row for each of the two sets, or one for each task that a broadcast join leaves
    assert max(r["count"] for r in seen[0].collect()) <= 2 * 16
